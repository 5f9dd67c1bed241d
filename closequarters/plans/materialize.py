"""Lineage cuts: persist an intermediate table in the cluster's shared
checkpoint folder and continue from the written copy.

Used where a plan reuses one table many times (the clean table feeds the
self-join, the silence profile, the table end and the trajectories): the
tree below it is computed once, and a lost executor only costs the tasks of
the current stage, not a recomputation of the clean pipeline.  The copies lie
in the application's folder; ``session.clear_shared`` removes them together.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import shared_dir
from ..sources.sinks import write_pings


def persist_pings(df: DataFrame, name: str = "clean") -> DataFrame:
    """Write a ping table day-partitioned (K1 layout: rebalanced by day into
    evenly sized files, sorted by mmsi/ts inside) and read it back (S3).  The
    table is read several times afterwards, so a few large files per day beat
    one small file per task and day."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    write_pings(df, path)
    return spark.read.parquet(path)
