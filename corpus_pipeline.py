"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

All stages but the last return the columns of ``documents``.  The order of the mixture is the order of the files
and rows that stage writes (part files are numbered in it), and the last stage encodes the documents in that order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm.decontaminate import without_leaks
from tillhouse.llm.near_dedup import without_near_duplicates
from tillhouse.llm.ordinal import kept, train
from tillhouse.llm.pfair import mixed
from tillhouse.llm.queries import TARGETS, importable, tokenizer_path
from tillhouse.llm.token_files import encode_corpus, file_order
from tillhouse.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest grade is likely; what the classifier rejects goes."""
    return kept(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixed(docs, TARGETS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the token files in the order of the mixture, as read back."""
    return encode_corpus(docs, tokenizer_path(), order=file_order(docs))


STAGES = [
    ("quality classifier", quality),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
    ("token files", write_tokens),
]
STAGES = [(name, importable(stage)) for name, stage in STAGES]

#: Several stages have no statement in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
