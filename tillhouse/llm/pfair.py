"""Mixing sources to target weights by Pfair scheduling.

A source's documents are cut into blocks of ``block_docs``.  With weight w, its k-th block (from 0) is released
at slot floor(k / w) and due before slot ceil((k + 1) / w).  Every slot goes to the released block that is due
first; equal deadlines are settled by the order of the sources.  On one sequence of slots this keeps all
deadlines, so that at any slot each source has had its share of the blocks to within less than one block.

Weights are whole numbers in the exact ratio of the targets, and the schedule repeats after their sum of slots.
Only one such period is put together, on the driver, or the stretch of it that a phase needs, if that is shorter;
where a block goes follows from its number by arithmetic, in Spark.  When a source has no blocks left, the others
go on by their weights among themselves, in a new phase.  There are as many phases as target sources at most, and
each has a table of ``SLOTS`` slots at most.

Only where both the period and the blocks of a phase are more than ``SLOTS``, weights are rounded, to ``SLOTS``
parts: in each ``SLOTS`` slots a source then drifts from its target by fewer blocks than there are sources.

All rows are kept.  Sources without a target weight, or with weight 0 or none at all, follow after the last
phase as one source.  Within a source, documents stand in the order of their ids, null first, and repeated
rows next to each other in any order.  An empty table gives no rows.  Other columns are carried along.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import materialise

BLOCK_DOCS = 64
#: Slots put together for a phase at most.
SLOTS = 100_000


def whole_weights(weights: dict) -> dict:
    """Weights as whole numbers in the same ratio, in lowest terms.  A float counts as the decimal number it is written as."""
    exact = {s: Fraction(repr(float(w))) if isinstance(w, float) else Fraction(w) for s, w in weights.items()}
    parts = lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * parts) for s, w in exact.items()}
    common = gcd(*whole.values())
    return {s: w // common for s, w in whole.items()}


def rounded(weights: dict, parts: int) -> dict:
    """Whole weights of sum ``parts``, at least 1: off by less than 1, but for the largest, which pay for those raised to 1."""
    total = sum(weights.values())
    whole = {s: max(1, w * parts // total) for s, w in weights.items()}
    missing = parts - sum(whole.values())
    for s in sorted(weights, key=lambda s: whole[s] * total - weights[s] * parts)[:max(0, missing)]:
        whole[s] += 1
    for _ in range(-missing):
        whole[max(whole, key=whole.get)] -= 1
    return whole


def slots_of(weights: dict, length: int) -> list[tuple]:
    """``source, release, deadline`` of the first ``length`` slots: earliest deadline first among the released blocks."""
    names, period = list(weights), sum(weights.values())
    waiting = [(0, i, 0) for i in range(len(names))]  # release, source, block
    released: list[tuple[int, int, int]] = []  # deadline, source, block
    slots = []
    for t in range(length):
        while waiting and waiting[0][0] <= t:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(released, (-(-(k + 1) * period // weights[names[i]]), i, k))
        due, i, k = heapq.heappop(released)
        w = weights[names[i]]
        slots.append((names[i], k * period // w, due))
        heapq.heappush(waiting, ((k + 1) * period // w, i, k + 1))
    return slots


@dataclass
class Phase:
    """A stretch of the schedule with the same sources, which repeats after ``period`` slots.

    Per source: block from, block to, blocks of a period, and of each of those its slot, release and deadline.
    """

    start: int
    period: int
    members: dict


def phases(weights: dict, blocks: dict, start: int = 0) -> tuple[list[Phase], int]:
    """The phases until all ``blocks`` are placed, and the slot after the last."""
    left = {s: blocks.get(s, 0) for s in weights if blocks.get(s, 0) > 0}
    taken = dict.fromkeys(left, 0)
    out = []
    while left:
        own = {s: weights[s] for s in left}
        common = gcd(*own.values())
        own = {s: w // common for s, w in own.items()}
        # the phase ends with the source whose last block is due first, or before
        longest = min(-(-n * sum(own.values()) // own[s]) for s, n in left.items())
        if min(sum(own.values()), longest) > SLOTS:
            own = rounded(own, SLOTS)
        slots = slots_of(own, min(sum(own.values()), longest))
        at: dict = {s: [] for s in own}
        for t, (s, release, due) in enumerate(slots):
            at[s].append((t, release, due))
        ends = {s: (n - 1) // w * len(slots) + at[s][(n - 1) % w][0] + 1 for s, n in left.items() if (w := len(at[s])) and (n <= w or len(slots) == sum(own.values()))}
        length = min(ends.values())  # the slot after the last block of the source that ends first
        full, rest = divmod(length, len(slots))
        members = {}
        for s, mine in at.items():
            n = full * len(mine) + sum(t < rest for t, _, _ in mine)
            if n:
                members[s] = (taken[s], taken[s] + n, len(mine), *map(list, zip(*mine)))
            taken[s] += n
            left[s] -= n
        out.append(Phase(start, len(slots), members))
        start += length
        left = {s: n for s, n in left.items() if n}
    return out, start


def in_stream(docs: DataFrame, targets: list[str]) -> tuple[DataFrame, DataFrame]:
    """``docs`` as (stream, nth, doc): the place of each row within its target source, or within all others (null).
    With it, the rows of each stream and range.

    Rows are range-partitioned by source and id, numbered inside each range, and moved on by the rows of their
    stream in the ranges before: no source is put into one task.
    """
    source = docs["source"].cast("string")
    rows = docs.select(
        F.when(source.isin(targets), source).alias("stream"), source.alias("source"), docs["doc_id"].cast("long").alias("doc_id"),
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
    )
    keys = ["stream", "source", "doc_id"]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "stream", "doc", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("line"),
    )
    ranged = materialise(ranged, "mix-rows")
    counts = ranged.groupBy("stream", "range").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    before = Window.partitionBy("stream").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("stream").alias("of"), F.col("range").alias("at_range"), "first", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    counts = materialise(counts, "mix-ranges")
    same = F.col("stream").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at_range"))
    return ranged.join(counts, same).select("stream", (F.col("line") - F.col("first") + F.col("ahead")).alias("nth"), "doc"), counts


def mix(docs: DataFrame, weights: dict[str, float], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``doc, stream, block, slot, released, due, place`` of every row of ``docs`` (doc_id, source, ...).

    ``doc`` is the row itself, ``slot`` where its block stands in the mixture, and ``place`` where it stands in
    its block; ordering by slot and place gives the mixture.  ``released`` and ``due`` bound the slot.
    """
    targets = {s: w for s, w in weights.items() if w > 0}
    rows, counts = in_stream(docs, list(targets))
    sizes = {r["stream"]: r["n"] for r in counts.groupBy("of").agg(F.sum("n").alias("n")).select(F.col("of").alias("stream"), "n").collect()}  # a row per target at most
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    plan, after = phases(whole_weights(targets), blocks) if targets else ([], 0)
    plan += phases({None: 1}, blocks, after)[0]
    spans = [(s, p.start, p.period, *member) for p in plan for s, member in p.members.items()]
    table = materialise(docs.sparkSession.createDataFrame(  # stored, so that its true size decides how it is joined
        spans, "of string, start long, period long, lo long, hi long, w long, at array<long>, released_at array<long>, due_at array<long>",
    ), "mix-phases")
    block = rows.withColumn("block", F.floor(F.col("nth") / block_docs)).withColumn("place", F.col("nth") % block_docs)
    k = F.col("block") - F.col("lo")
    repeats, nth = F.expr("(block - lo) div w") * F.col("period") + F.col("start"), (k % F.col("w") + 1).cast("int")
    same = F.col("stream").eqNullSafe(F.col("of")) & (F.col("block") >= F.col("lo")) & (F.col("block") < F.col("hi"))
    return block.join(table, same).select(
        "doc", "stream", "block", (repeats + F.element_at("at", nth)).alias("slot"),
        (repeats + F.element_at("released_at", nth)).alias("released"), (repeats + F.element_at("due_at", nth)).alias("due"), "place",
    )


def mixed(docs: DataFrame, weights: dict[str, float], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of ``docs``, as they are, in the order of the mixture."""
    return mix(docs, weights, block_docs).orderBy("slot", "place").select("doc.*")
