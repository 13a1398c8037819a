"""Run times, given by the caller where a run has to be repeatable."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_time(now: dt.datetime | None = None) -> Column:
    """Time of a run: as given (in UTC), or the time of the query."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def retention_cutoff(days: int, now: dt.datetime | None = None) -> Column:
    """The time of the run minus some days, to the second."""
    return F.date_trunc("second", run_time(now)) - F.expr(f"INTERVAL '{int(days)}' DAY")
