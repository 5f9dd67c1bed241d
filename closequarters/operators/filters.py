"""Row filters.  All are narrow (no shuffle) except the MID semi join, whose
build side is a list of three-digit codes (at most 1000 rows, so broadcasting
it is bounded)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_nm
from ..functions.timecols import epoch_s, utc_day
from ..params import DEFAULTS, UNDEFINED_SHIP_TYPE, Params


def in_bbox(p: Params = DEFAULTS) -> Column:
    lat, lon = p.box
    return F.col("lat").between(*lat) & F.col("lon").between(*lon)


def in_circle(p: Params = DEFAULTS) -> Column:
    """Box first (cheap, pushed to Parquet), then the great-circle test; the
    box always holds the circle."""
    d = haversine_nm(F.lit(p.centre_lat), F.lit(p.centre_lon), F.col("lat"), F.col("lon"), p.earth_radius_nm)
    return in_bbox(p) & (d <= F.lit(p.radius_nm))


def bbox_filter(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """latitude and longitude ranges, both inclusive."""
    return df.filter(in_bbox(p))


def within_radius(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """pings within ``radius_nm`` of the centre (inclusive)."""
    return df.filter(in_circle(p))


def mmsi_in_range(p: Params = DEFAULTS) -> Column:
    return F.col("mmsi").isNotNull() & F.col("mmsi").between(p.mmsi_range[0], p.mmsi_range[1])


def valid_mmsi_range(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """id present and inside the ship id range."""
    return df.filter(mmsi_in_range(p))


def mmsi_deny_list(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """drop known placeholder ids."""
    return df.filter(~F.col("mmsi").isin(*p.mmsi_deny_list))


def mmsi_repeated_digit(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """drop ids made of one repeated digit."""
    return df.filter(~F.col("mmsi").isin(*p.mmsi_repeated))


def mid_prefix(mmsi: Column | None = None) -> Column:
    """First three digits of a nine-digit id (truncating division)."""
    return F.floor((F.col("mmsi") if mmsi is None else mmsi) / F.lit(1000000)).cast("int")


def mmsi_mid_filter(df: DataFrame, mids: DataFrame | Sequence[int]) -> DataFrame:
    """the id's country prefix is an allocated one.

    ``mids`` is either a literal list (becomes an ``InSet`` predicate, no join)
    or a one-column DataFrame ``mid`` (left-semi broadcast hash join; three-digit
    codes bound it to 1000 rows)."""
    if isinstance(mids, DataFrame):
        # Only three-digit codes can match a nine-digit id: keeping just those
        # bounds the broadcast side to 1000 rows whatever the caller passes.
        codes = (mids.select(F.col(mids.columns[0]).cast("int").alias("_mid"))
                 .filter(F.col("_mid").between(0, 999)).distinct())
        return df.join(F.broadcast(codes), mid_prefix() == F.col("_mid"), "left_semi")
    return df.filter(mid_prefix().isin(*[int(m) for m in mids]))


def mmsi_checks(df: DataFrame, mids, p: Params = DEFAULTS) -> DataFrame:
    """F3-F6 in one narrow filter (one semi join when ``mids`` is a DataFrame)."""
    ok = (mmsi_in_range(p) & ~F.col("mmsi").isin(*p.mmsi_deny_list) & ~F.col("mmsi").isin(*p.mmsi_repeated))
    if isinstance(mids, DataFrame):
        return mmsi_mid_filter(df.filter(ok), mids)
    return df.filter(ok & mid_prefix().isin(*[int(m) for m in mids]))


def mmsi_filter(df: DataFrame, mids, p: Params = DEFAULTS) -> DataFrame:
    """id checks, then keep vessels that moved faster than the threshold."""
    from .vessels import moving_vessels

    return moving_vessels(mmsi_checks(df, mids, p), p)


def moving_pings(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """F8: per-ping speed above the moving threshold (null speed drops)."""
    return df.filter(F.col("sog") > F.lit(p.min_moving_sog_kn))


def teleport_free(p: Params = DEFAULTS) -> Column:
    """F9 predicate over (speed_prev_kn, speed_next_kn), SQL three-valued: a ping
    is kept only if it is not fast to both neighbours; a missing neighbour makes
    that side unknown, so an end ping is dropped when its one known side is fast
    and a lone ping (both unknown) is dropped."""
    lim = F.lit(p.max_plausible_speed_kn)
    return ~((F.col("speed_prev_kn") > lim) & (F.col("speed_next_kn") > lim))


def not_teleport(df_with_speeds: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """apply the jump predicate to a frame carrying the implied speeds."""
    return df_with_speeds.filter(teleport_free(p))


def encounter_distance(pairs: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """pairs strictly closer than the encounter distance."""
    return pairs.filter(F.col("dist_m") < F.lit(p.encounter_distance_m))


def is_civilian(p: Params = DEFAULTS) -> Column:
    """Neither side has an operational type; a null type makes it unknown (dropped)."""
    ops = list(p.operational_types)
    return ~F.col("ship_type_a").isin(*ops) & ~F.col("ship_type_b").isin(*ops)


def is_operational(p: Params = DEFAULTS) -> Column:
    ops = list(p.operational_types)
    return F.col("ship_type_a").isin(*ops) | F.col("ship_type_b").isin(*ops)


def civilian_pairs(pairs: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """F11."""
    return pairs.filter(is_civilian(p))


def is_silenced() -> Column:
    return F.col("silenced_a") | F.col("silenced_b")


def silenced_pairs(pairs: DataFrame) -> DataFrame:
    """F12."""
    return pairs.filter(is_silenced())


def vessel_time_window(df: DataFrame, ids: Sequence[int], centre_s: int, minutes: int = DEFAULTS.trajectory_half_window_min) -> DataFrame:
    """pings of the given vessels within ``centre ± minutes`` (inclusive).

    The bounds are typed epoch seconds (no driver time zone), and the matching
    ``day`` range is added so a day-partitioned table is pruned to one or two
    partitions instead of being scanned whole."""
    lo, hi = int(centre_s) - 60 * minutes, int(centre_s) + 60 * minutes
    day_lo, day_hi = utc_day(F.lit(lo)), utc_day(F.lit(hi))
    return df.filter(F.col("day").between(day_lo, day_hi)
                     & F.col("mmsi").isin(*[int(i) for i in ids])
                     & epoch_s("ts").between(lo, hi))


def specific_type_rows(df: DataFrame) -> DataFrame:
    """rows whose ship type is present and not the 'Undefined' sentinel."""
    return df.filter(F.col("ship_type").isNotNull() & (F.col("ship_type") != UNDEFINED_SHIP_TYPE))

