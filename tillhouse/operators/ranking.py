"""Ranks, percentiles and running shares (WIN4-WIN10) that do not need one big task.

A window without PARTITION BY sorts its whole input in one task.  Here every
input, small or large, takes one path: distinct values with their counts are
range-partitioned by Spark from high to low (NULL last), each range is worked on
by itself, and the counts and sums of the ranges before it (one row per range)
are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _running(df: DataFrame, value: str, measures: dict[str, str], materialise, group: list[str], ranges: int | None) -> DataFrame:
    """Per distinct value of a group: totals over all values before it, high to low and NULL last.

    ``df`` has one row per group and value.  ``ranges`` is the number of ranges;
    left out, Spark sets it by its shuffle partitions and the size of the data.
    """
    up_to, zero = (Window.unboundedPreceding, -1), F.lit(0)
    order = [*[F.col(g).asc() for g in group], F.col(value).desc_nulls_last()]
    ranged = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    parts = materialise(ranged.withColumn("_range", F.spark_partition_id()), f"ranges-{value.strip('_')}")
    ahead = Window.partitionBy(*group).orderBy("_range").rowsBetween(*up_to)
    offsets = parts.groupBy(*group, "_range").agg(*[F.sum(m).alias(f"_sum_{a}") for m, a in measures.items()]).select(
        *group, "_range", *[F.coalesce(F.sum(f"_sum_{a}").over(ahead), zero).alias(f"_off_{a}") for a in measures.values()]
    )
    inside = Window.partitionBy(*group, "_range").orderBy(F.col(value).desc_nulls_last()).rowsBetween(*up_to)
    local = parts.select("*", *[F.coalesce(F.sum(m).over(inside), zero).alias(a) for m, a in measures.items()])
    on = F.col("l._range") == F.col("o._range")
    for g in group:
        on = on & F.col(f"l.{g}").eqNullSafe(F.col(f"o.{g}"))
    joined = local.alias("l").join(offsets.alias("o"), on)
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns], *[(F.col(f"l.{a}") + F.col(f"o._off_{a}")).alias(a) for a in measures.values()]
    )


def global_ranks(df: DataFrame, ranks: dict[str, str], materialise, ranges: int | None = None) -> DataFrame:
    """WIN8: ``rank()`` of the whole frame by several integer columns, high to low, NULL last.

    ``ranks`` maps the value column to the name of its rank.  All columns are
    ranked in one pass, on distinct values with their counts, so ties, however
    many, cost one row.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("_rank"), F.col(value).cast("bigint").alias("_v")) for value, name in ranks.items()]))
    levels = df.select(pairs.alias("_p")).groupBy("_p._rank", "_p._v").agg(F.count("*").alias("_n"))
    ranked = materialise(_running(levels, "_v", {"_n": "_before"}, materialise, ["_rank"], ranges), "ranked")
    out = df
    for value, name in ranks.items():
        level = ranked.where(F.col("_rank") == name).select("_v", (F.col("_before") + 1).alias(name))
        out = out.join(level, F.col(value).cast("bigint").eqNullSafe(F.col("_v"))).drop("_v")
    return out


def running_share(df: DataFrame, value: str, name: str, materialise, ranges: int | None = None) -> DataFrame:
    """WIN10: revenue of all better rows and ties, as a share of the total (0-1).

    Tied rows get the same share, so the class of a row does not depend on the
    order of its equals.
    """
    levels = df.groupBy(value).agg((F.col(value) * F.count("*")).alias("_w"))
    running = materialise(_running(levels, value, {"_w": "_before"}, materialise, [], ranges), f"shares-{name.strip('_')}")
    total = running.agg(F.sum("_w").alias("_total"))
    # One aggregated row.
    share = running.crossJoin(F.broadcast(total)).select(
        F.col(value).alias("_v"),
        ((F.col("_before") + F.col("_w")).cast("double") / F.nullif(F.col("_total"), F.lit(0)).cast("double")).alias(name),
    )
    return df.join(share, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")


def rank_in_group(df: DataFrame, group: str, value: str, name: str, materialise, ranges: int | None = None) -> DataFrame:
    """WIN8 within a region or category.

    A group may hold a third of all rows: ranges cut through groups as well.
    """
    levels = df.groupBy(group, value).agg(F.count("*").alias("_n"))
    ranked = _running(levels, value, {"_n": "_before"}, materialise, [group], ranges)
    level = ranked.select(F.col(group).alias("_g"), F.col(value).alias("_v"), (F.col("_before") + 1).alias(name))
    on = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return df.join(level, on).drop("_g", "_v")


def day_change(revenue: str, date: str, back: int) -> Column:
    """WIN5: change against ``back`` days earlier, on a gapless daily series."""
    return F.col(revenue) - F.lag(revenue, back).over(Window.orderBy(date))


def rolling_mean(revenue: str, date: str, days: int) -> Column:
    """WIN6: mean of the last ``days`` rows of a gapless daily series."""
    return F.avg(revenue).over(Window.orderBy(date).rowsBetween(-(days - 1), 0))


def running_total(revenue: str, date: str, *period: str) -> Column:
    """WIN7: month- or year-to-date total."""
    w = Window.partitionBy(*period).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(revenue).over(w)


def share_of_total(df: DataFrame, count: str, name: str) -> DataFrame:
    """WIN4: percent of the total, on an already aggregated frame."""
    total = df.agg(F.sum(count).alias("_total"))
    # One aggregated row.
    return df.crossJoin(F.broadcast(total)).withColumn(name, F.col(count).cast("double") * 100.0 / F.col("_total")).drop("_total")
