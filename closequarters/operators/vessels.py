"""Per-vessel aggregates and keep-lists.

Every per-vessel statistic is a ``groupBy(mmsi)`` with partial (map-side)
aggregation, so a vessel holding a third of all rows is reduced inside each
map task before the shuffle.  Keep-lists are applied with plain joins: AQE
turns them into broadcast joins when the measured summary is small and
splits skewed partitions otherwise; no unbounded side is hinted to broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s
from ..params import DEFAULTS, Params
from .filters import specific_type_rows
from .projections import backfill_static


def vessel_max_sog(df: DataFrame) -> DataFrame:
    """A1: highest speed over ground per vessel."""
    return df.groupBy("mmsi").agg(F.max("sog").alias("max_sog"))


def vessel_ping_count(df: DataFrame) -> DataFrame:
    """A2: pings per vessel."""
    return df.groupBy("mmsi").agg(F.count(F.lit(1)).alias("n_pings"))


def first_name_expr():
    """Earliest non-null name by (ts, name); deterministic for equal timestamps."""
    key = F.when(F.col("name").isNotNull(), F.struct(epoch_s("ts").alias("t"), F.col("name").alias("n")))
    return F.min(key).getField("n")


def vessel_name(df: DataFrame) -> DataFrame:
    """A3: the vessel's first broadcast name (null if it never sent one)."""
    return df.groupBy("mmsi").agg(first_name_expr().alias("vessel_name"))


def vessel_modal_type(df: DataFrame) -> DataFrame:
    """A4: most frequent specific ship type per vessel; ties -> smallest name.
    Two partial aggregations; the arg-max is a ``min`` over (-count, type)."""
    counts = specific_type_rows(df).groupBy("mmsi", "ship_type").agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("k"), F.col("ship_type").alias("t"))).getField("t")
    return counts.groupBy("mmsi").agg(best.alias("modal_type"))


def moving_vessels(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Keep vessels whose highest speed exceeds the threshold."""
    keep = vessel_max_sog(df).filter(F.col("max_sog") > F.lit(p.min_vessel_max_sog_kn)).select("mmsi")
    return df.join(keep, "mmsi", "left_semi")


def min_pings(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Keep vessels with at least ``min_pings_per_vessel`` pings."""
    keep = vessel_ping_count(df).filter(F.col("n_pings") >= F.lit(p.min_pings_per_vessel)).select("mmsi")
    return df.join(keep, "mmsi", "left_semi")


def vessel_static(df: DataFrame) -> DataFrame:
    """Name and modal type per vessel in one table (one row per vessel)."""
    names = vessel_name(df)
    types = vessel_modal_type(df)
    return names.join(types, "mmsi", "left")


def fill_vessel_static(df: DataFrame) -> DataFrame:
    """Backfill name and ship type from the vessel's own other pings."""
    look = vessel_static(df).select("mmsi", F.col("vessel_name").alias("_vessel_name"),
                                    F.col("modal_type").alias("_vessel_type"))
    return backfill_static(df.join(look, "mmsi", "left"))


def vessel_last_seen(df: DataFrame) -> DataFrame:
    """A5: last report per vessel; ties on ts broken by (lat, lon)."""
    last = F.max(F.struct(epoch_s("ts").alias("t"), F.col("lat").alias("y"), F.col("lon").alias("x")))
    return (df.groupBy("mmsi").agg(last.alias("_l"))
              .select("mmsi", F.col("_l.t").alias("last_ts_s"), F.col("_l.y").alias("last_lat"),
                      F.col("_l.x").alias("last_lon")))
