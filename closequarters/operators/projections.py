"""Column derivations (narrow, codegen'd)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import grid_cell
from ..functions.timecols import epoch_s
from ..params import DEFAULTS, UNDEFINED_SHIP_TYPE, Params


def normalize_sog(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """A speed outside [0, 102.2) kn is 'not available' and becomes 0.0 (NaN
    sorts above every number, so it does too); null stays null."""
    known = (F.col("sog") >= 0) & (F.col("sog") < F.lit(p.sog_not_available_kn))
    return df.withColumn("sog", F.when(~known, 0.0).otherwise(F.col("sog")))


def time_bucket(p: Params = DEFAULTS) -> Column:
    """Epoch seconds truncated to the bucket width."""
    return (epoch_s("ts") / F.lit(p.time_bucket_s)).cast("long")


def bucket_keys(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """(time_bucket, lat_cell, lon_cell) join keys of the encounter grid."""
    return df.withColumns({"time_bucket": time_bucket(p),
                           "lat_cell": grid_cell("lat", p.lat_cell_deg),
                           "lon_cell": grid_cell("lon", p.lon_cell_deg)})


def display_name(name: Column, mmsi: Column) -> Column:
    """A missing name becomes ``MMSI <id>``."""
    return F.coalesce(name, F.format_string("MMSI %d", mmsi))


def backfill_static(df: DataFrame, name_col: str = "_vessel_name", type_col: str = "_vessel_type") -> DataFrame:
    """P5: a ping without a name takes its vessel's; a ping whose type says
    nothing (missing or 'Undefined') takes the vessel's modal specific type,
    and keeps what it had if the vessel never sent a specific one."""
    own = F.col("ship_type")
    says_nothing = own.isNull() | (own == F.lit(UNDEFINED_SHIP_TYPE))
    out = {"name": F.ifnull("name", name_col),
           "ship_type": F.when(says_nothing & F.col(type_col).isNotNull(), F.col(type_col)).otherwise(own)}
    return df.select(*[out[c].alias(c) if c in out else F.col(c)
                       for c in df.columns if c not in (name_col, type_col)])
