"""Time helpers that do not depend on the session time zone.

Everything is derived from epoch seconds, so a job gives the same days and
strings whatever ``spark.sql.session.timeZone`` the cluster runs with.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def epoch_s(ts="ts") -> Column:
    return F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)


def utc_day(seconds: Column) -> Column:
    """UTC calendar date of an epoch-seconds column."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int"))


def iso_millis(seconds: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.000`` in UTC, the shape of the published result records."""
    sod = F.pmod(seconds, F.lit(SECONDS_PER_DAY))
    return F.concat(
        F.date_format(utc_day(seconds), "yyyy-MM-dd"),
        F.format_string("T%02d:%02d:%02d.000", (sod / 3600).cast("int"),
                        (F.pmod(sod, F.lit(3600)) / 60).cast("int"), F.pmod(sod, F.lit(60)).cast("int")),
    )
