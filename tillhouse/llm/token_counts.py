"""Token counts by a two-tier lookup inside the map tasks.

Tier one is a broadcast table of the token lengths of frequent pieces of text.  Its size has a fixed
bound: each task sums its own rows up in a frequent-item summary of at most ``table_rows`` counters
(Misra and Gries; summaries of this kind can be merged without losing their guarantee), the summaries
are merged in a tree, and one summary is left.  Tier two, for all other pieces, is the worker's cache
in front of the tokenizer.  Pieces themselves are never shuffled; only one summary row per task is.

Every row gives one row.  A null or empty text has no tokens and no bytes; a repeated row counts each
time; other columns of the input are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.texts import pieces, row_sums, slices, strings, whole
from tillhouse.llm.tokenizing import encoder, lowered

#: Counters of a summary, and so rows of the broadcast table: 2 MB at most for pieces of usual length.
TABLE_ROWS = 16_384
#: A piece longer than this is never kept in a summary, so that the bound on rows is a bound on bytes.
PIECE_CHARS = 64
FAN_IN = 32
SUMMARY = "slot long, summary binary"


def reduced(counts: dict[str, int], rows: int) -> dict[str, int]:
    """Take the (rows + 1)-th count off all counters; those above zero stay, ``rows`` at most."""
    if len(counts) <= rows:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    cut = int(np.partition(values, len(values) - rows - 1)[len(values) - rows - 1])
    return {piece: n - cut for piece, n in counts.items() if n > cut}


def merged(summaries: Iterator[bytes], rows: int) -> dict[str, int]:
    total: dict[str, int] = {}
    for packed in summaries:
        for piece, n in pickle.loads(packed).items():
            total[piece] = total.get(piece, 0) + n
        total = reduced(total, rows)
    return total


def frequent_pieces(docs: DataFrame, rows: int = TABLE_ROWS) -> list[str]:
    """The pieces frequent over all rows of ``docs``, ``rows`` of them at most."""

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                _, codes, vocabulary = pieces(lowered(whole(part.column("text"))))
                for piece, n in zip(strings(vocabulary), np.bincount(codes, minlength=len(vocabulary)).tolist()):
                    if len(piece) <= PIECE_CHARS:
                        counts[piece] = counts.get(piece, 0) + n
                counts = reduced(counts, rows)
        slot = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int64()), "summary": pa.array([pickle.dumps(counts)], pa.binary())})

    def merge(key, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = merged((x.as_py() for b in batches for x in b.column("summary")), rows)
        yield pa.RecordBatch.from_pydict({"slot": pa.array([key[0].as_py()], pa.int64()), "summary": pa.array([pickle.dumps(total)], pa.binary())})

    texts = docs.select(docs["text"].cast("string").alias("text"))
    tasks = texts.rdd.getNumPartitions()
    summaries = texts.mapInArrow(sum_up, SUMMARY)
    while tasks > 1:
        level = summaries.select(F.floor(F.col("slot") / FAN_IN).alias("slot"), "summary")
        summaries = level.groupBy("slot").applyInArrow(_iterating(merge), SUMMARY)
        tasks = -(-tasks // FAN_IN)
    last = summaries.collect()
    return list(merged((bytes(r["summary"]) for r in last), rows))


def _iterating(fn):
    """Tell Spark by the annotations that ``fn`` takes a group batch by batch."""
    fn.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return fn


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, table_rows: int = TABLE_ROWS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs`` (doc_id, text).

    ``tokenizer``: a file of the tokenizers library whose tokens never reach over white space and which
    drops white space.  ``limit``: a text with more tokens is over the limit.
    """
    spark = docs.sparkSession
    pieces_known = frequent_pieces(docs, table_rows)
    lengths = encoder(tokenizer).lengths_of(pa.array(pieces_known, pa.string())).tolist()
    table = spark.sparkContext.broadcast(dict(zip(pieces_known, lengths)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value
        for batch in batches:
            for part in slices(batch):
                counts, codes, vocabulary = pieces(lowered(whole(part.column("text"))))
                length = np.fromiter((frequent.get(p, -1) for p in strings(vocabulary)), np.int64, len(vocabulary))
                missed = np.flatnonzero(length < 0)
                length[missed] = encoder(tokenizer).lengths_of(vocabulary.take(pa.array(missed)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(row_sums(counts, length[codes]), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
        F.coalesce(F.octet_length(docs["text"].cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
