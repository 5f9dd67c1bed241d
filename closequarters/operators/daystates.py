"""Last-seen states by day: mergeable partial aggregates of A5, from which A6, A7
and J6 follow.

A state is a vessel's last report of one day.  The last report of a table is the
maximum of its states, so a table that grows by a day needs the pings of that day
only; the older days are read as states, a row per vessel and day.  Late pings of
a day replace that day's states.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s
from ..sources.readers import read_pings

STATE = ("mmsi", "last_ts_s", "last_lat", "last_lon")


def day_states(pings: DataFrame) -> DataFrame:
    """One row per vessel and day: day, mmsi and its last report of that day
    (ties as in A5).  Pings without timestamp are a day of their own (null)."""
    last = F.max(F.struct(epoch_s("ts").alias("t"), F.col("lat").alias("y"), F.col("lon").alias("x")))
    return (pings.groupBy("day", "mmsi").agg(last.alias("_l"))
            .select("day", "mmsi", F.col("_l.t").alias("last_ts_s"), F.col("_l.y").alias("last_lat"),
                    F.col("_l.x").alias("last_lon")))


def merge_states(states: DataFrame) -> DataFrame:
    """A5 from states: last report per vessel over all days."""
    last = F.max(F.struct(*STATE[1:]))
    return states.groupBy("mmsi").agg(last.alias("_l")).select("mmsi", "_l.*")


def write_states(states: DataFrame, path: str) -> str:
    """Write states by day; days that lie there already are replaced, others stay."""
    (states.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("day").parquet(path))
    return path


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("mmsi long, last_ts_s long, last_lat double, last_lon double, day date").parquet(path)


def add_days(spark: SparkSession, pings_path: str, states_path: str, days: Iterable) -> DataFrame:
    """Bring the states of ``days`` (dates or ISO strings) up to date from a
    day-partitioned ping table, reading only those days' pings, and return all
    states.  A day that has no pings any more keeps its old states."""
    some = read_pings(spark, pings_path).filter(F.col("day").isin(*[F.lit(str(d)).cast("date") for d in days]))
    return read_states(spark, write_states(day_states(some), states_path))
