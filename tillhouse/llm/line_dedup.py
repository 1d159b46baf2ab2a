"""Reversible line dedup: exact reference counts of line keys, with sharded cuckoo filters in front.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased;
it is stored as its 128-bit MD5.  Keys of at least ``min_chars`` code points are counted.  A key found in
``min_docs`` documents or more is *repeated*: all its lines go, but for those in the largest doc_id.

A store is a folder with

* ``references``: a row (key, doc_id) per document and key, one folder per inserted batch;
* ``deletions``: the documents taken out, with the last batch a deletion holds for;
* ``counts``: the exact table (key, docs, last_doc) of the live references, one folder per version;
* ``filters``: per shard of the key space, a cuckoo filter of the repeated keys, one folder per version.

A batch that comes or goes changes the counts of its own keys only.  Keys that thereby become repeated are
inserted into their shard's filter, and keys that cease to be are deleted from it.  Documents are resolved by
asking the filters which of their keys may be repeated, and the exact table which are.  Deleting a batch again
therefore gives the results from before it.

Rows without a doc_id hold no references and keep all their lines.  A null text is one empty line.  Several
rows of one doc_id are one document to the counts if their keys are the same, and each row is resolved.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.cuckoo import CuckooFilter
from tillhouse.llm.texts import slices, whole
from tillhouse.session import shared_folder

WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_DOCS = 40, 5
SHARDS = 256
#: Filters are sent to the tasks up to this many bytes (about 10 million repeated keys); beyond, the exact table answers alone.
FILTER_BYTES = 32 << 20

REFERENCES = "key binary, doc_id long"
FILTERS = "shard int, segments array<binary>"


def line_key(line: Column) -> Column:
    """The key of a line as text."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row (key, doc_id) per document and counted key."""
    lines = F.split(F.coalesce(docs["text"].cast("string"), F.lit("")), "\n")
    long_keys = F.filter(F.transform(lines, line_key), lambda k: F.char_length(k) >= min_chars)
    keys = F.array_distinct(F.transform(long_keys, lambda k: F.unhex(F.md5(k.cast("binary")))))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), keys.alias("keys"))
    return rows.where("doc_id is not null").select(F.explode("keys").alias("key"), "doc_id")


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


class LineStore:
    """The store in ``folder``, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.folder, self.min_chars, self.min_docs = spark, folder, min_chars, min_docs
        self.version = self.batches = self.deleted = 0

    def _counts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/counts/{self.version}")

    def filters(self) -> DataFrame:
        """The filter segments of each shard."""
        return self.spark.read.schema(FILTERS).parquet(f"{self.folder}/filters/{self.version}")

    def repeated(self) -> DataFrame:
        """Exact: the repeated keys with the document that keeps each."""
        return self._counts().where(F.col("docs") >= self.min_docs).select("key", "last_doc")

    def live(self) -> DataFrame:
        """The references of all documents inserted and not deleted since."""
        rows = self.spark.read.schema(f"{REFERENCES}, batch int").parquet(f"{self.folder}/references")
        if not self.deleted:
            return rows.select("key", "doc_id")
        gone = self.spark.read.parquet(*[f"{self.folder}/deletions/{i}" for i in range(self.deleted)])
        gone = gone.groupBy("doc_id").agg(F.max("up_to").alias("up_to"))
        return rows.alias("r").join(gone.alias("g"), (F.col("r.doc_id") == F.col("g.doc_id")) & (F.col("r.batch") <= F.col("g.up_to")), "left_anti").select("key", "doc_id")

    def insert(self, docs: DataFrame) -> None:
        """Count the lines of ``docs`` (doc_id, text), which are not in the store yet."""
        path = f"{self.folder}/references/batch={self.batches}"
        references(docs, self.min_chars).write.parquet(path)
        self.batches += 1
        new = self.spark.read.schema(REFERENCES).parquet(path).distinct() if self._repeats_ids(docs) else self.spark.read.schema(REFERENCES).parquet(path)
        change = new.groupBy("key").agg(F.count("*").alias("more"), F.max("doc_id").alias("newest"))
        if self.version:
            held = self._counts().join(change, "key", "full_outer").select(
                "key", F.coalesce("docs", F.lit(0)).alias("was"), (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"),
                F.greatest("last_doc", "newest").alias("last_doc"),
            )
        else:
            held = change.select("key", F.lit(0).cast("long").alias("was"), F.col("more").alias("docs"), F.col("newest").alias("last_doc"))
        self._next(held)

    @staticmethod
    def _repeats_ids(docs: DataFrame) -> bool:
        """Whether a doc_id stands in several rows: only then can a reference come twice."""
        ids = docs.select(docs["doc_id"].cast("long").alias("doc_id")).where("doc_id is not null")
        return bool(ids.groupBy("doc_id").count().where("count > 1").limit(1).count())

    def delete(self, ids: DataFrame) -> None:
        """Take the documents named in ``ids`` (doc_id) out again."""
        gone = ids.select(ids["doc_id"].cast("long").alias("doc_id")).distinct()
        before = self.live()
        path = f"{self.folder}/deletions/{self.deleted}"
        gone.withColumn("up_to", F.lit(self.batches - 1)).write.parquet(path)
        gone = self.spark.read.parquet(path).select("doc_id")
        touched = before.join(gone, "doc_id", "left_semi").select("key").distinct()
        self.deleted += 1
        now = self.live().join(touched, "key", "left_semi").distinct().groupBy("key").agg(F.count("*").alias("left"), F.max("doc_id").alias("latest"))
        held = self._counts().join(touched.withColumn("hit", F.lit(True)), "key", "left").join(now, "key", "left").select(
            "key", F.col("docs").alias("was"),
            F.when(F.col("hit"), F.coalesce("left", F.lit(0))).otherwise(F.col("docs")).alias("docs"),
            F.when(F.col("hit"), F.col("latest")).otherwise(F.col("last_doc")).alias("last_doc"),
        )
        self._next(held)

    def _next(self, held: DataFrame) -> None:
        """Write the next version of the counts, and bring the filters forward by what has changed."""
        version, least = self.version + 1, self.min_docs
        path = f"{self.folder}/counts/{version}"
        held.write.parquet(path)
        held = self.spark.read.schema(held.schema).parquet(path)
        crossed = held.where((F.col("was") >= least) != (F.col("docs") >= least)).select(
            shard_of(F.col("key")).alias("shard"), "key", (F.col("docs") >= least).alias("comes"),
        )
        empty = self.spark.createDataFrame([], FILTERS)
        old = self.filters() if self.version else empty

        def update(key, had: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
            come = [bytes(k) for k in changes.loc[changes["comes"], "key"]]
            go = [bytes(k) for k in changes.loc[~changes["comes"].astype(bool), "key"]]
            held = CuckooFilter.load([bytes(s) for s in had["segments"].iloc[0]]) if len(had) else CuckooFilter.sized(len(come))
            held.delete(go)
            held.insert(come)
            return pd.DataFrame({"shard": [key[0]], "segments": [held.dump()]})

        grouped = old.groupBy("shard").cogroup(crossed.groupBy("shard"))
        grouped.applyInPandas(update, FILTERS).write.parquet(f"{self.folder}/filters/{version}")
        self.version = version

    def candidates(self, docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """References of ``docs`` whose key may be repeated, by the filters."""
        rows = references(docs, self.min_chars)
        size = self.filters().select(F.sum(F.aggregate("segments", F.lit(0).cast("long"), lambda a, s: a + F.length(s)))).first()[0] or 0
        if size > filter_bytes:
            return rows
        shards = {r["shard"]: [bytes(s) for s in r["segments"]] for r in self.filters().collect()}
        sent = self.spark.sparkContext.broadcast(shards)

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {shard: CuckooFilter.load(s) for shard, s in sent.value.items()}
            for batch in batches:
                shard = np.asarray(batch.column("shard"))
                keys = batch.column("key").to_pylist()
                order = np.argsort(shard, kind="stable")
                maybe = np.zeros(len(keys), bool)
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
                for at, stop in zip(cuts, np.append(cuts[1:], len(order))):
                    if shard[order[at]] in held:
                        mine = order[at:stop]
                        maybe[mine] = held[shard[order[at]]].contains([keys[i] for i in mine])
                yield batch.filter(pa.array(maybe)).select(["key", "doc_id"])

        return rows.select("key", "doc_id", shard_of(F.col("key")).alias("shard")).mapInArrow(ask, REFERENCES)

    def resolve(self, docs: DataFrame) -> DataFrame:
        """``doc_id, text, n_lines, n_dropped`` of each row of ``docs``: its text without the lines that go."""
        drops = (
            self.candidates(docs).join(self.repeated(), "key").where(F.col("doc_id") < F.col("last_doc"))
            .groupBy("doc_id").agg(F.collect_set("key").alias("drop_keys"))
        )
        least = self.min_chars

        def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    texts, n_lines, n_dropped = [], [], []
                    for text, keys in zip(whole(part.column("text")).to_pylist(), part.column("drop_keys").to_pylist()):
                        lines = text.split("\n")
                        kept = without(lines, set(keys), least) if keys else lines
                        texts.append("\n".join(kept))
                        n_lines.append(len(lines))
                        n_dropped.append(len(lines) - len(kept))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                        ["doc_id", "text", "n_lines", "n_dropped"],
                    )

        rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
        return rows.join(drops, "doc_id", "left").mapInArrow(strip, "doc_id long, text string, n_lines long, n_dropped long")


def without(lines: list[str], keys: set[bytes], min_chars: int) -> list[str]:
    """The lines whose key is not among ``keys``."""
    kept = []
    for line in lines:
        key = line.strip(WHITE)
        if len(key) >= min_chars and hashlib.md5(key.encode("utf-8").lower()).digest() in keys:
            continue
        kept.append(line)
    return kept


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Put ``docs`` into a store of their own and resolve them: ``doc_id, text, n_lines, n_dropped``."""
    store = LineStore(docs.sparkSession, f"{shared_folder(docs.sparkSession)}/lines-{uuid.uuid4().hex}", min_chars, min_docs)
    store.insert(docs)
    return store.resolve(docs)
