"""Hard negatives by slots: for each anchor and positive, the best rows of other labels whose score lies in a window.

A row's score is its inner product with the anchor, of whole numbers floor(scale * x).  A positive with score p asks for
scores from low * p to high * p.  All windows of an anchor overlap, but their upper limits cut the scores into disjoint
slots: slot i reaches from below limit i down to limit i + 1.  Each task keeps the first ``negatives`` rows of each slot,
the slots of all tasks are merged, and going from the last slot upwards, a slot's rows followed by those of the slots
below, cut to ``negatives``, are the answer of the window that begins there; its lower limit cuts rows off the end.

Anchors are a stated query set.  They are worked on in blocks of ``BLOCK``, one after another; a block's vectors and
limits are sent to the tasks (``BLOCK`` times vector and limits: a few megabytes), rows are read where they lie, and what
tasks return is bounded by block, slots and ``negatives``.  Each block's result is stored before the next begins.

Rows with a null label, a null vector, another number of components, or a null or non-finite component take no part.
A row without ``vec_id`` takes part and comes last among equal scores; it is no anchor.  Rows that repeat are rows of
their own: a copy of an anchor is one of its positives.  Components beyond a limit that keeps scores inside 64 bits count
as that limit.  An anchor without positives, and a window without rows, give no row; so does an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.vectors import listed, matrix, products, scaled
from tillhouse.session import discard, materialise, shared_folder

SIZE, SCALE = 64, 256
POSITIVES, NEGATIVES = 5, 10
#: Lower and upper end of a window, in hundredths of the positive's score.
LOW, HIGH = 30, 90
#: Anchors worked on together.
BLOCK = 8192
#: Scores a task holds at once, and candidates it gathers before it keeps the best.
CELLS, GATHERED = 4_000_000, 1_000_000
#: Stands for a missing id: behind all others.
NO_ID = np.iinfo(np.int64).max

FOUND = "anchor int, slot int, score long, vec_id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_rows(table: DataFrame, label: Column, size: int, scale: int) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    limit = int((2**57 // size) ** 0.5)  # a score is below 2 ** 57, and 90 of it fit

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("label").is_valid())
            right, rows = scaled(batch.column("embedding"), size, scale, limit)
            mask = pa.array(right)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(mask), batch.column("label").filter(mask), listed(rows)], ["vec_id", "label", "vector"])

    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), label.cast("long").alias("label"), table["embedding"].alias("embedding"))
    return rows.mapInArrow(kept, "vec_id long, label long, vector array<int>")


@dataclass
class Best:
    """The first ``k`` rows of each of ``groups`` groups: highest score first, then smallest id."""

    groups: int
    k: int
    least: np.ndarray = field(init=False)  # what a row must have to be among them
    group: list = field(default_factory=list)
    score: list = field(default_factory=list)
    ids: list = field(default_factory=list)
    waiting: int = 0

    def __post_init__(self):
        self.least = np.full(self.groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = score >= self.least[group]
        self.group.append(group[better])
        self.score.append(score[better])
        self.ids.append(ids[better])
        self.waiting += int(better.sum())
        if self.waiting > GATHERED:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keep and return the best."""
        if not self.group:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        group, score, ids = (np.concatenate(x) for x in (self.group, self.score, self.ids))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        kept = place < self.k
        full = place == self.k - 1
        self.least[group[full]] = score[full]
        group, score, ids = group[kept], score[kept], ids[kept]
        self.group, self.score, self.ids, self.waiting = [group], [score], [ids], 0
        return group, score, ids


@dataclass
class Anchors:
    """A block of anchors, in the order of their labels; ``limits`` are the upper limits of each anchor's slots, falling."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray | None = None
    floor: np.ndarray | None = None  # the lowest score any window of the anchor asks for
    last: np.ndarray | None = None  # the last slot of each anchor, as a group

    @classmethod
    def of(cls, table: pa.Table, size: int) -> Anchors:
        labels = np.asarray(table.column("label"))
        order = np.argsort(labels, kind="stable")
        return cls(np.asarray(table.column("vec_id"))[order], labels[order], matrix(table.column("vector"), size)[order])

    def nearest_alike(self, x: np.ndarray, labels: np.ndarray, ids: np.ndarray, best: Best) -> None:
        """Rows of the anchors' own labels into ``best``, one group per anchor."""
        for label in np.unique(labels):
            lo, hi = np.searchsorted(self.labels, label), np.searchsorted(self.labels, label, side="right")
            if lo == hi:
                continue
            rows = np.flatnonzero(labels == label)
            step = max(1, CELLS // (hi - lo))
            for at in (rows[i:i + step] for i in range(0, len(rows), step)):
                score = products(x[at], self.vectors[lo:hi])
                r, a = np.nonzero(score >= best.least[lo:hi])
                best.add(a + lo, score[r, a], ids[at[r]])

    def in_slots(self, x: np.ndarray, labels: np.ndarray, ids: np.ndarray, best: Best) -> None:
        """Rows of other labels into ``best``, one group per anchor and slot."""
        slots = self.limits.shape[1]
        step = max(1, CELLS // len(self.ids))
        for at in range(0, len(x), step):
            score = products(x[at:at + step], self.vectors)
            # a full last slot bounds what is still of use to any slot of the anchor
            least = np.maximum(self.floor, best.least[self.last])
            r, a = np.nonzero((score >= least) & (score <= self.limits[:, 0]) & (labels[at:at + step, None] != self.labels))
            found = score[r, a]
            slot = (found[:, None] <= self.limits[a]).sum(axis=1) - 1
            best.add(a * slots + slot, found, ids[at + r])


def searched(rows: DataFrame, anchors: Anchors, negatives: bool, k: int, size: int) -> DataFrame:
    """``anchor, slot, score, vec_id``: the first ``k`` rows of each group in every task."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)
    slots = anchors.limits.shape[1] if negatives else 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        best = Best(len(block.ids) * slots, k)
        for batch in batches:
            x, labels = matrix(batch.column("vector"), size), np.asarray(batch.column("label"))
            ids = np.asarray(batch.column("vec_id").fill_null(NO_ID))
            (block.in_slots if negatives else block.nearest_alike)(x, labels, ids, best)
        group, score, ids = best.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(group // slots, pa.int32()), pa.array(group % slots, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.int64())],
            ["anchor", "slot", "score", "vec_id"],
        )

    return rows.mapInArrow(search, FOUND)


def first_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot over all tasks, which Spark limits before the shuffle as well."""
    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def positives_of(anchors: Anchors, found: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: how many positives, their scores and ids.  ``found`` may hold the anchor itself, once."""
    n = len(anchors.ids)
    group, place, score, ids = (np.asarray(found.column(c)) for c in ("anchor", "place", "score", "vec_id"))
    order = np.lexsort((place, group))
    group, score, ids = group[order], score[order], ids[order]
    own = (ids == anchors.ids[group]) & (score == (anchors.vectors * anchors.vectors).sum(axis=1)[group])
    first = np.flatnonzero(own)
    first = first[np.unique(group[first], return_index=True)[1]]
    others = np.delete(np.arange(len(group)), first)
    group, score, ids = group[others], score[others], ids[others]
    starts = np.searchsorted(group, np.arange(n + 1))
    count = np.minimum(np.diff(starts), k)
    scores, names = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
    for i in range(k):
        has = count > i
        scores[has, i], names[has, i] = score[starts[:-1][has] + i], ids[starts[:-1][has] + i]
    return count, scores, names


def window_limits(anchors: Anchors, count: np.ndarray, scores: np.ndarray, low: int, high: int) -> np.ndarray:
    """Set the slots' upper limits and the lowest score asked for; return the lower limit of each window."""
    asked = np.arange(scores.shape[1]) < count[:, None]
    lower, upper = -(-low * scores // 100), high * scores // 100
    asked &= lower <= upper  # below zero, a window holds nothing
    none = np.iinfo(np.int64).min
    anchors.limits = np.where(asked, upper, none)
    anchors.last = np.arange(len(count)) * scores.shape[1] + np.maximum(asked.sum(axis=1) - 1, 0)
    anchors.floor = np.where(asked.any(axis=1), np.where(asked, lower, NO_ID).min(axis=1), NO_ID)
    return np.where(asked, lower, NO_ID)


def answers(found: DataFrame, anchors: Anchors, count: np.ndarray, scores: np.ndarray, names: np.ndarray, lower: np.ndarray, k: int) -> DataFrame:
    """A row per anchor, positive and negative: slots merged from the last upwards."""
    spark, slots = found.sparkSession, scores.shape[1]
    per_slot = found.groupBy("anchor").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("slot") == i, F.struct((-F.col("score")).alias("below"), "vec_id")))).alias(f"s{i}") for i in range(slots)
    ])  # at most k entries each
    suffix = [F.col(f"s{slots - 1}")]
    for i in range(slots - 2, -1, -1):
        suffix.insert(0, F.slice(F.concat(F.col(f"s{i}"), suffix[0]), 1, k))
    windows = pa.table({
        "at": pa.array(np.repeat(np.arange(len(count)), count), pa.int32()),
        "anchor_id": pa.array(np.repeat(anchors.ids, count), pa.int64()),
        "nth": pa.array(np.concatenate([np.arange(n) for n in count] or [np.zeros(0)]), pa.int32()),
        **{c: pa.array(v[np.arange(slots) < count[:, None]], pa.int64()) for c, v in (("positive_id", names), ("positive_score", scores), ("lower", lower))},
    })
    merged = per_slot.select("anchor", F.array(*suffix).alias("suffix"))
    asked = spark.createDataFrame(windows).join(merged, F.col("at") == F.col("anchor"))
    negative = F.posexplode(F.filter(F.element_at("suffix", F.col("nth") + 1), lambda e: -e["below"] >= F.col("lower"))).alias("place", "negative")
    named = lambda c: F.when(F.col(c) != F.lit(int(NO_ID)), F.col(c))
    return asked.select("anchor_id", "positive_id", "positive_score", negative).select(
        "anchor_id", named("positive_id").alias("positive_id"), (F.col("place") + 1).cast("int").alias("rank"),
        named("negative.vec_id").alias("negative_id"), "positive_score", (-F.col("negative.below")).alias("negative_score"),
    )


def mined(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    size: int = SIZE, block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``anchors`` against ``rows``, both as ``whole_rows`` gives them."""
    spark = rows.sparkSession
    blocks = -(-anchors.count() // block)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    # A block is a partition dealt out evenly; it is stored, so that it stays the same.
    dealt = materialise(anchors.repartition(blocks).withColumn("block", F.spark_partition_id()), "anchors")
    path = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    for b in range(blocks):
        held = Anchors.of(dealt.where(F.col("block") == b).toArrow(), size)  # about ``block`` rows
        alike = first_of(searched(rows, held, False, positives + 1, size), positives + 1).toArrow()
        count, scores, names = positives_of(held, alike, positives)
        lower = window_limits(held, count, scores, low, high)
        found = first_of(searched(rows, held, True, negatives, size), negatives)
        answers(found, held, count, scores, names, lower, negatives).write.mode("append").parquet(path)
    discard(dealt)
    return spark.read.schema(RESULT).parquet(path)


def hard_negatives(table: DataFrame, label: Column, is_anchor: Column, size: int = SIZE, scale: int = SCALE, **more) -> DataFrame:
    """``mined`` for a table of ``vec_id, embedding``; ``is_anchor`` tests ``vec_id``."""
    rows = materialise(whole_rows(table, label, size, scale), "negative-rows")
    result = mined(rows, rows.where(is_anchor), size=size, **more)
    discard(rows)
    return result
