"""Values fixed for one run, so that a re-run gives the same rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """``as_of`` replaces today's date, ``run_ts`` the current timestamp."""

    as_of: dt.date = dt.date(2001, 12, 31)
    run_ts: dt.datetime = dt.datetime(2001, 12, 31, 6, 0, 0)
    batch_id: str = "batch-20011231"
    source_system: str = "RETAIL_S3"
    lists: dict[str, list[str]] = field(default_factory=dict)

    @property
    def today(self) -> Column:
        return F.lit(self.as_of)

    @property
    def now(self) -> Column:
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


DEFAULT = RunContext()
