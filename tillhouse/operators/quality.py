"""Declarative data checks (DQ1-DQ13) and how they run.

Row-level checks of a table share a scan and an aggregation.  Uniqueness
and foreign keys need a shuffle of their own and are counted from aggregated or
anti-joined keys.  The result is one row per check: failures and status.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.flags import packed_key

# Spark compiles an aggregation of at most about a hundred fields; more row-level
# checks than this are counted in further passes, each reading its own columns.
CHECKS_PER_PASS = 40


@dataclass(frozen=True)
class Check:
    """One check.

    ``fails`` is a SQL condition that is true for a failing row.  ``kind`` is
    'row', 'unique', 'foreign_key' or 'recency'.  A count above ``error_above``
    fails a check of severity 'error', one above ``warn_above`` warns.
    """

    name: str
    kind: str = "row"
    fails: str = ""
    columns: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    days: int = 0
    severity: str = "error"
    warn_above: int = 0
    error_above: int = 0

    def warn(self, above: int = 0) -> Check:
        """The same check, warning only."""
        return replace(self, severity="warn", warn_above=above)


def _named(kind: str, column: str, fails: str, where: str | None = None) -> Check:
    return Check(f"{kind}({column})", fails=f"({where}) and ({fails})" if where else fails)


def not_null(column: str) -> Check:
    """DQ1."""
    return _named("not_null", column, f"{column} is null")


def unique(*columns: str) -> Check:
    """DQ2/DQ3/DQ21/DQ25: counts keys that occur more than once; NULL keys are left out for one column."""
    return Check(f"unique({', '.join(columns)})", kind="unique", columns=columns)


def accepted_values(column: str, values: Iterable, where: str | None = None) -> Check:
    """DQ4: NULL passes."""
    listed = ", ".join(_literal(v) for v in values)
    return _named("accepted_values", column, f"{column} not in ({listed})", where)


def accepted_range(column: str, low=None, high=None, where: str | None = None) -> Check:
    """DQ5: inclusive bounds; NULL passes."""
    tests = ([f"{column} < {low}"] if low is not None else []) + ([f"{column} > {high}"] if high is not None else [])
    return _named("accepted_range", column, " or ".join(tests), where)


def expression(column: str, test: str, where: str | None = None) -> Check:
    """DQ6: ``test`` is the right-hand side, such as '>= 0'; unknown counts as failed."""
    return _named("expression", f"{column} {test}", f"not coalesce({column} {test}, false)", where)


def foreign_key(column: str, parent: str, parent_column: str) -> Check:
    """DQ7: rows whose non-NULL key the parent lacks."""
    return Check(f"foreign_key({column} -> {parent}.{parent_column})", kind="foreign_key", columns=(column,), parent=parent, parent_column=parent_column)


def not_empty_string(column: str) -> Check:
    """DQ8."""
    return _named("not_empty_string", column, f"trim({column}) = ''")


def recency(column: str, days: int) -> Check:
    """DQ9/DQ12: the newest value is at most ``days`` old."""
    return Check(f"recency({column}, {days}d)", kind="recency", columns=(column,), days=days)


def match_regex(column: str, pattern: str) -> Check:
    """DQ10: NULL passes."""
    return _named("match_regex", column, f"not {column} rlike {_literal(pattern)}")


def value_length(column: str, low: int, high: int, where: str | None = None) -> Check:
    """DQ11: NULL passes."""
    return _named("value_length", column, f"length({column}) not between {low} and {high}", where)


def _literal(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int, float)):
        return str(v)
    return "r'" + v.replace("'", "\\'") + "'"


def _status(check: Check, failures):
    """DQ13."""
    verdict = F.when(failures > check.warn_above, "warn").otherwise("pass")
    return verdict if check.severity == "warn" else F.when(failures > check.error_above, "fail").otherwise(verdict)


def _row_results(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One aggregation for all row-level checks, turned into one row per check."""
    counted = df.agg(*[F.count_if(F.expr(c.fails)).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures"), _status(c, F.col(f"c{i}")).alias("status"))
        for i, c in enumerate(checks)
    ])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """DQ2/DQ3: keys that occur more than once, with their counts."""
    columns = list(columns)
    keyed = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return keyed.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """DQ7: rows with a key the parent lacks."""
    keys = parent.select(F.col(parent_column).alias("_key")).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def _packed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns to count repeated keys of: text as packed keys, which differ where the text does."""
    types = dict(df.dtypes)
    return df.select(*[packed_key(F.col(n)).alias(n) if types.get(n) == "string" else F.col(n) for n in columns])


def _single(check: Check, failures: DataFrame) -> DataFrame:
    return failures.select(F.lit(check.name).alias("check"), "failures", _status(check, F.col("failures")).alias("status"))


def columns_read(df: DataFrame, checks: list[Check]) -> list[str]:
    """Columns of ``df`` that the checks name: all that has to be stored for them."""
    named = {n.lower() for c in checks for n in (*c.columns, *re.findall(r"\w+", c.fails))}
    return [n for n in df.columns if n.lower() in named]


def run_checks(df: DataFrame, checks: list[Check], as_of: dt.datetime, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """All checks of one table as (check, failures, status)."""
    parts = []
    row_checks = [c for c in checks if c.kind == "row"]
    for i in range(0, len(row_checks), CHECKS_PER_PASS):
        parts.append(_row_results(df, row_checks[i:i + CHECKS_PER_PASS]))
    for c in checks:
        if c.kind == "unique":
            parts.append(_single(c, duplicate_keys(_packed(df, c.columns), c.columns).agg(F.count("*").alias("failures"))))
        elif c.kind == "foreign_key":
            lost = orphans(df, c.columns[0], (parents or {})[c.parent], c.parent_column)
            parts.append(_single(c, lost.agg(F.count("*").alias("failures"))))
        elif c.kind == "recency":
            edge = F.lit((as_of - dt.timedelta(days=c.days)).isoformat(sep=" ")).cast("timestamp_ntz")
            stale = ~F.coalesce(F.max(c.columns[0]).cast("timestamp_ntz") >= edge, F.lit(False))
            parts.append(_single(c, df.agg(stale.cast("bigint").alias("failures"))))
    return reduce(DataFrame.unionByName, parts)


def freshness(df: DataFrame, loaded_at: str, as_of: dt.datetime, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """DQ12: age of the newest load in hours and its status."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.timestamp_diff("HOUR", F.col("newest"), now)
    status = F.when(age > error_hours, "fail").when(age > warn_hours, "warn").when(age.isNotNull(), "pass").otherwise("fail")
    return df.agg(F.max(loaded_at).cast("timestamp_ntz").alias("newest")).select("newest", age.alias("age_hours"), status.alias("status"))
