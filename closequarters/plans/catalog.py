"""The registered queries: one per operator of the inventory, each running on
the ping table derived from the provided ``events`` table (whole table, no
sampling).  Output columns are plain types (epoch seconds for times, rounded
doubles for trigonometry) so an independent SQL engine can be compared
value for value; see ``oracle.py`` for the SQL twins.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import haversine_nm
from ..functions.timecols import epoch_s
from ..operators import encounters as enc
from ..operators import filters as flt
from ..operators import jumps, projections, ranking, trajectory, vessels
from ..params import DEFAULTS, FIXTURE_MID_CODES
from ..sources.fixture import derived_pings, rough_pings
from .clean import (clean_pings, clean_stages, clean_summary, ingest_summary, stage_funnel, summary_from_vessels,
                    summary_from_write)
from .report import encounter_report

P = DEFAULTS
MIDS = FIXTURE_MID_CODES
PING_OUT = ("ts_s", "mmsi", "lat", "lon", "sog", "cog", "name", "ship_type")
PAIR_OUT = ("mmsi_a", "mmsi_b", "ts_a_s", "ts_b_s", "lat_a", "lat_b", "lon_a", "lon_b", "sog_a", "sog_b",
            "name_a", "name_b", "ship_type_a", "ship_type_b", "dist_m")
SILENCE_OUT = ("silenced_a", "silenced_b")
# Window parameters of the single-pair lookup query (F13): two vessels present
# at every scale of the fixture and a centre five hours into the month.
WINDOW_IDS = (219000003, 265000004)
WINDOW_CENTRE_S = 1638316800 + 5 * 3600
READ_DAYS = ("2021-12-01", "2021-12-02")
# Skew guards at work on tables of any size: every track of more than 8 pings is
# cut at its quantiles, every bucket of more than one ping is dealt over keys.
SHORT_CHUNKS = replace(P, track_chunk_pings=8)
SMALL_CELLS = replace(P, cell_pings=1)


def pings_out(df: DataFrame) -> DataFrame:
    return df.select(epoch_s("ts").alias("ts_s"), "mmsi", "lat", "lon", "sog", "cog", "name", "ship_type")


def full_pings_out(df: DataFrame) -> DataFrame:
    """All columns of the working ping table but the day, which follows from ts."""
    return df.select(epoch_s("ts").alias("ts_s"), *PING_OUT[1:], "nav_status", "mobile_type", "imo", "callsign")


def pairs_out(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    cols = [F.col(c) for c in ("mmsi_a", "mmsi_b")] + [epoch_s("ts_a").alias("ts_a_s"), epoch_s("ts_b").alias("ts_b_s")]
    cols += [F.col(c) for c in PAIR_OUT[4:-1]] + [F.round("dist_m", 6).alias("dist_m")]
    cols += [F.col(c) for c in extra]
    return df.select(*cols)


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return derived_pings(spark, d)


def _stages(spark, d):
    return clean_stages(_raw(spark, d), MIDS, P)


def _rough_stages(spark, d, p=P):
    """Stages over pings with placeholder ids, copies and missing timestamps."""
    return clean_stages(rough_pings(spark, d), MIDS, p)


def _clean(spark, d):
    return _stages(spark, d).clean


def _clean_table(spark, d):
    """The clean table persisted to the shared folder (the input of detection)."""
    from .materialize import persist_pings

    return persist_pings(_clean(spark, d), "clean")


def _detected(spark, d):
    return enc.detect_encounters(_clean_table(spark, d), P)


def _detected_distinct(spark, d):
    """Detected pairs with their multiplicity as a column (nothing re-expanded)."""
    return enc.detect_encounters(_clean_table(spark, d), P, keep_copies=True)


def _ranked(spark, d):
    return ranking.three_rankings(_detected_distinct(spark, d), P)


def _traj(spark, d):
    c = _clean_table(spark, d)
    return trajectory.pair_trajectories(ranking.three_rankings(enc.detect_encounters(c, P), P), c, P)


def _speeds_out(df: DataFrame) -> DataFrame:
    return df.select(epoch_s("ts").alias("ts_s"), "mmsi", "lat", "lon",
                     F.round("speed_prev_kn", 4).alias("speed_prev_kn"),
                     F.round("speed_next_kn", 4).alias("speed_next_kn"))


def _q_haversine(spark, d):
    r = _raw(spark, d)
    dist = haversine_nm(F.lit(P.centre_lat), F.lit(P.centre_lon), F.col("lat"), F.col("lon"), P.earth_radius_nm)
    return r.select(epoch_s("ts").alias("ts_s"), "mmsi", "lat", "lon", F.round(dist, 7).alias("dist_centre_nm"))


def _q_bucket_keys(spark, d):
    m = flt.moving_pings(_clean(spark, d), P)
    return projections.bucket_keys(m, P).select(epoch_s("ts").alias("ts_s"), "mmsi", "lat", "lon",
                                                "time_bucket", "lat_cell", "lon_cell")


def _q_expand_cells(spark, d):
    m = projections.bucket_keys(flt.moving_pings(_clean(spark, d), P), P)
    return enc.expand_cells(m, P).select(epoch_s("ts").alias("ts_s"), "mmsi", "lat", "lon", "lat_cell",
                                         "lon_cell", "cell_lat_v", "cell_lon_v")


def _q_encounter_distance(spark, d):
    moving = flt.moving_pings(_clean(spark, d), P)
    # candidates out to 140 m, which the 150 m grid still covers, then the 100 m test
    cand = enc.encounter_candidates(moving, replace(P, encounter_distance_m=140.0))
    return pairs_out(flt.encounter_distance(cand, P)).select("mmsi_a", "mmsi_b", "ts_a_s", "ts_b_s", "dist_m")


def _q_display_name(spark, d):
    c = _clean(spark, d)
    return c.select(epoch_s("ts").alias("ts_s"), "mmsi", "lat", "lon",
                    projections.display_name(F.col("name"), F.col("mmsi")).alias("display_name"))


def _q_ranked_out(df: DataFrame) -> DataFrame:
    return pairs_out(df, SILENCE_OUT + ("list", "rank")).withColumn("rank", F.col("rank").cast("long"))


def _q_result(df: DataFrame) -> DataFrame:
    out = df.withColumn("distance_m", F.round("distance_m", 6)).withColumn("window_minutes", F.col("window_minutes").cast("long"))
    if "rank" in out.columns:
        out = out.withColumn("rank", F.col("rank").cast("long"))
    return out


def _q_vessel_time_window(spark, d):
    return pings_out(flt.vessel_time_window(_clean(spark, d), WINDOW_IDS, WINDOW_CENTRE_S,
                                            P.trajectory_half_window_min))


def _q_pair_trajectories(spark, d):
    t = _traj(spark, d)
    return t.select("list", F.col("rank").cast("long").alias("rank"), "mmsi", "own_ts_s", "ts_s", "lat", "lon",
                    "sog", "cog", "name", "ship_type")


def _q_nearest(spark, d):
    return trajectory.nearest_ping(_traj(spark, d)).withColumn("rank", F.col("rank").cast("long"))


def _q_label(spark, d):
    return trajectory.trajectory_label(_traj(spark, d)).withColumn("rank", F.col("rank").cast("long"))


def _q_polyline(spark, d):
    return (trajectory.trajectory_polyline(_traj(spark, d)).drop("geojson")
            .withColumn("rank", F.col("rank").cast("long")).withColumn("n_points", F.col("n_points").cast("long"))
            .withColumn("first_ts", epoch_s("first_ts")).withColumn("last_ts", epoch_s("last_ts"))
            .withColumnRenamed("first_ts", "first_ts_s").withColumnRenamed("last_ts", "last_ts_s"))


def _q_geojson(spark, d):
    lines = trajectory.trajectory_polyline(_traj(spark, d))
    return lines.select("list", F.col("rank").cast("long").alias("rank"), "mmsi", "n_points", "geojson")


def _q_path(spark, d):
    """V2 read back from the GeoJSON strings, one row per path point."""
    p = trajectory.path_from_geojson(trajectory.trajectory_polyline(_traj(spark, d)))
    return p.withColumns({"rank": F.col("rank").cast("long"), "pos": F.col("pos").cast("long")})


def _q_extent(spark, d):
    e = trajectory.trajectory_extent(_traj(spark, d))
    return e.select("list", F.col("rank").cast("long").alias("rank"),
                    F.round("centre_lat", 9).alias("centre_lat"), F.round("centre_lon", 9).alias("centre_lon"),
                    F.round("lat_range", 9).alias("lat_range"), F.round("lon_range", 9).alias("lon_range"),
                    F.round("arrow_len", 9).alias("arrow_len"), "n_points")


def _q_headings(spark, d):
    h = trajectory.trajectory_headings(_traj(spark, d))
    return h.select("list", F.col("rank").cast("long").alias("rank"), "mmsi", F.col("k").cast("long").alias("k"),
                    F.col("pos_from").cast("long").alias("pos_from"), F.col("pos_to").cast("long").alias("pos_to"),
                    "lon0", "lat0", F.round("arrow_dlon", 9).alias("arrow_dlon"),
                    F.round("arrow_dlat", 9).alias("arrow_dlat"))


def _q_ingest_summary(spark, d):
    s = ingest_summary(_raw(spark, d))
    return s.select("rows", "days", F.col("first_day").cast("string").alias("first_day"),
                    F.col("last_day").cast("string").alias("last_day"))


def _q_csv_roundtrip(spark, d):
    from ..session import shared_dir
    from ..sources.readers import normalize_pings, read_pings_csv
    from ..sources.sinks import write_pings_csv

    path = shared_dir(spark, "csv-roundtrip")
    write_pings_csv(rough_pings(spark, d), path)
    return full_pings_out(normalize_pings(read_pings_csv(spark, path)))


def _q_parquet_roundtrip(spark, d):
    from ..session import shared_dir
    from ..sources.readers import read_pings
    from ..sources.sinks import write_pings

    path = shared_dir(spark, "pings")
    write_pings(rough_pings(spark, d), path)
    return full_pings_out(read_pings(spark, path))


def _q_read_days(spark, d):
    """S3 with a range of days (partition pruning is the feature)."""
    from ..session import shared_dir
    from ..sources.readers import read_pings
    from ..sources.sinks import write_pings

    path = shared_dir(spark, "pings")
    write_pings(_raw(spark, d), path)
    return pings_out(read_pings(spark, path, days=READ_DAYS))


def _mid_table(spark, d):
    """The country prefixes of all pings, written as a Windows-1252 CSV with
    a text column of such bytes and read back as a reference table."""
    from ..session import shared_dir
    from ..sources.readers import read_mid_codes

    path = shared_dir(spark, "mid-codes")
    codes = _raw(spark, d).select(flt.mid_prefix().alias("Digit")).distinct()
    (codes.select("Digit", F.concat(F.lit("\x80\x8a\xe9 "), F.col("Digit").cast("string")).alias("Allocated to"))
     .write.option("header", True).option("encoding", "iso-8859-1").csv(path))
    return read_mid_codes(spark, path)


def _odd_mids(spark, d):
    """Every second code, so that the filter by a table drops pings."""
    return _mid_table(spark, d).filter(F.col("mid") % 2 == 1)


def _day_states(spark, d):
    """(clean table, last-seen states) with the last day added to the states of
    the days before it, as a daily run does."""
    from ..operators import daystates
    from ..session import shared_dir
    from ..sources.readers import read_pings
    from ..sources.sinks import write_pings

    path = shared_dir(spark, "clean")
    days = write_pings(_clean(spark, d), path)["days"]
    clean, states = read_pings(spark, path), shared_dir(spark, "day-states")
    daystates.write_states(daystates.day_states(clean.filter(F.col("day") < F.lit(days[-1]))), states)
    return clean, daystates.add_days(spark, path, states, days[-1:])


def _q_detect_states(spark, d):
    clean, states = _day_states(spark, d)
    return pairs_out(enc.detect_encounters(clean, P, states=states), SILENCE_OUT)


def _q_observed_summary(spark, d):
    """A9 as observed while the pings were written."""
    from ..session import shared_dir
    from ..sources.sinks import write_pings

    s = summary_from_write(spark, write_pings(_raw(spark, d), shared_dir(spark, "pings")))
    return s.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


def _cut_stages(spark, d):
    return clean_stages(_raw(spark, d), MIDS, P, cut=True)


def _q_observed_funnel(spark, d):
    """A10 from the tables and counts of one clean run."""
    stages = _cut_stages(spark, d)
    return stage_funnel(stages.raw, MIDS, P, stages)


def _q_space_layout(spark, d):
    """K1 along the space-filling curve, read back through the region box (F1)."""
    from ..session import shared_dir
    from ..sources.readers import read_pings
    from ..sources.sinks import write_pings

    path = shared_dir(spark, "pings-space")
    write_pings(rough_pings(spark, d), path, layout="space")
    return full_pings_out(flt.bbox_filter(read_pings(spark, path), P))


def _q_json_roundtrip(spark, d):
    from ..session import shared_dir
    from ..sources.sinks import write_pairs_json

    path = shared_dir(spark, "rankings-json")
    write_pairs_json(_ranked(spark, d), path)
    back = spark.read.schema("list string, rank long, mmsi_a long, mmsi_b long, ts_a string, ts_b string, "
                             "dist_m double, silenced_a boolean, silenced_b boolean").json(path)
    return back.select("list", "rank", "mmsi_a", "mmsi_b", "ts_a", "ts_b", F.round("dist_m", 6).alias("dist_m"),
                       "silenced_a", "silenced_b")


def _q_streaming_ingest(spark, d):
    from ..session import shared_dir
    from ..sources.readers import read_pings
    from ..sources.sinks import write_pings_csv
    from ..streaming.ingest import ingest_stream

    src = shared_dir(spark, "stream-src")
    out = shared_dir(spark, "stream-out")
    write_pings_csv(_raw(spark, d), src)
    ingest_stream(spark, src, out, checkpoint=shared_dir(spark, "stream-ckpt"), available_now=True).awaitTermination()
    return pings_out(read_pings(spark, out))


def _q_normalize(spark, d):
    from ..sources.readers import normalize_pings
    from ..sources.sinks import raw_from_pings

    return full_pings_out(normalize_pings(raw_from_pings(rough_pings(spark, d))))


def _q_backfill(spark, d):
    dense = _stages(spark, d).dense
    look = vessels.vessel_static(dense).select("mmsi", F.col("vessel_name").alias("_vessel_name"),
                                               F.col("modal_type").alias("_vessel_type"))
    return pings_out(projections.backfill_static(dense.join(look, "mmsi", "left")))


def _q_canonical(spark, d):
    """Pairs handed over with the larger id first come out in canonical
    form (smaller id as side a, every attribute on its own side)."""
    pairs = enc.encounter_pairs(_clean(spark, d), P)
    side = {s: F.struct(*[F.col(f"{c}_{s}").alias(c) for c in enc.PAYLOAD]) for s in "ab"}
    return pairs_out(enc.canonical_pairs(pairs.select(side["b"].alias("side_1"), side["a"].alias("side_2"), "dist_m")))


def _q_rank_in_all(spark, d):
    det = _detected(spark, d)
    out = ranking.rank_in_all(det, ranking.three_rankings(det, P), P)
    return out.withColumn("rank", F.col("rank").cast("long"))


def _q_top_encounters(spark, d):
    top = ranking.top_encounters(_detected(spark, d), P.top_n)
    return pairs_out(top, SILENCE_OUT + ("rank",)).withColumn("rank", F.col("rank").cast("long"))


def _q_enrich(spark, d):
    c = _clean_table(spark, d)
    return pairs_out(enc.enrich_silence(enc.encounter_pairs(c, P), c, P), SILENCE_OUT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / sinks
    "read_pings_csv": _q_csv_roundtrip,
    "normalize_pings": _q_normalize,
    "write_pings": _q_parquet_roundtrip,
    "read_pings": _q_read_days,
    "read_mid_codes": lambda s, d: _mid_table(s, d).select(F.col("mid").cast("long").alias("mid")),
    "mmsi_mid_filter_table": lambda s, d: pings_out(flt.mmsi_mid_filter(_raw(s, d), _odd_mids(s, d))),
    "trajectory_path": _q_path,
    "write_pings_space": _q_space_layout,
    "write_pairs_json": _q_json_roundtrip,
    "streaming_ingest": _q_streaming_ingest,
    "ingest_summary": _q_ingest_summary,
    "ingest_summary_observed": _q_observed_summary,
    # scalar
    "haversine": _q_haversine,
    # filters
    "bbox_filter": lambda s, d: pings_out(flt.bbox_filter(_raw(s, d), P)),
    "within_radius": lambda s, d: pings_out(flt.within_radius(_raw(s, d), P)),
    "valid_mmsi_range": lambda s, d: pings_out(flt.valid_mmsi_range(_raw(s, d), P)),
    "mmsi_deny_list": lambda s, d: pings_out(flt.mmsi_deny_list(rough_pings(s, d), P)),
    "mmsi_repeated_digit": lambda s, d: pings_out(flt.mmsi_repeated_digit(_raw(s, d), P)),
    "mmsi_mid_filter": lambda s, d: pings_out(flt.mmsi_mid_filter(_raw(s, d), MIDS)),
    "normalize_sog": lambda s, d: pings_out(projections.normalize_sog(_raw(s, d), P)),
    "mmsi_filter": lambda s, d: pings_out(flt.mmsi_filter(projections.normalize_sog(flt.within_radius(_raw(s, d), P), P), MIDS, P)),
    "vessel_max_sog": lambda s, d: vessels.vessel_max_sog(_stages(s, d).checked),
    "moving_vessels": lambda s, d: pings_out(vessels.moving_vessels(_stages(s, d).checked, P)),
    "implied_speeds": lambda s, d: _speeds_out(jumps.implied_speeds(_stages(s, d).moving, P)),
    "not_teleport": lambda s, d: _speeds_out(flt.not_teleport(jumps.implied_speeds(_stages(s, d).moving, P), P)),
    "gps_jump_filter": lambda s, d: pings_out(jumps.gps_jump_filter(_stages(s, d).moving, P)),
    "gps_jump_filter_depth": lambda s, d: pings_out(jumps.gps_jump_filter(_raw(s, d), SHORT_CHUNKS)),
    "encounter_pairs_dealt": lambda s, d: pairs_out(enc.encounter_pairs(_raw(s, d), SMALL_CELLS)),
    "gps_jump_filter_runs": lambda s, d: pings_out(jumps.gps_jump_filter(_rough_stages(s, d).moving,
                                                                         replace(P, collapse_track_copies=True))),
    "implied_speeds_untimed": lambda s, d: _speeds_out(jumps.implied_speeds(_rough_stages(s, d).moving, P)),
    "vessel_ping_count": lambda s, d: vessels.vessel_ping_count(_stages(s, d).jump_free),
    "min_pings": lambda s, d: pings_out(vessels.min_pings(_stages(s, d).jump_free, P)),
    "specific_type_rows": lambda s, d: pings_out(flt.specific_type_rows(_raw(s, d))),
    "vessel_name": lambda s, d: vessels.vessel_name(_stages(s, d).dense),
    "vessel_modal_type": lambda s, d: vessels.vessel_modal_type(_stages(s, d).dense),
    "fill_vessel_static": lambda s, d: pings_out(vessels.fill_vessel_static(_stages(s, d).dense)),
    "backfill_static": _q_backfill,
    "clean_pings": lambda s, d: pings_out(_clean(s, d)),
    "clean_pings_cut": lambda s, d: pings_out(clean_pings(_raw(s, d), MIDS, P)),
    "clean_pings_rough": lambda s, d: full_pings_out(_rough_stages(s, d).clean),
    "stage_funnel": lambda s, d: stage_funnel(_raw(s, d), MIDS, P),
    "stage_funnel_observed": _q_observed_funnel,
    "clean_summary": lambda s, d: clean_summary(_clean(s, d)),
    "clean_summary_vessels": lambda s, d: summary_from_vessels(_cut_stages(s, d)),
    # detection
    "moving_pings": lambda s, d: pings_out(flt.moving_pings(_clean(s, d), P)),
    "bucket_keys": _q_bucket_keys,
    "expand_cells": _q_expand_cells,
    "encounter_pairs": lambda s, d: pairs_out(enc.encounter_pairs(_clean(s, d), P)),
    "encounter_pairs_copies": lambda s, d: pairs_out(enc.encounter_pairs(_rough_stages(s, d).clean, P)),
    "canonical_pairs": _q_canonical,
    "encounter_distance": _q_encounter_distance,
    "vessel_display_name": _q_display_name,
    "vessel_last_seen": lambda s, d: vessels.vessel_last_seen(_clean(s, d)),
    "dataset_end": lambda s, d: enc.dataset_end(_clean(s, d)),
    "port_cells": lambda s, d: enc.port_cells(_clean(s, d), P),
    "vessels_in_port": lambda s, d: enc.vessels_in_port(_clean(s, d), P),
    "vessels_in_port_states": lambda s, d: enc.vessels_in_port(None, P, _day_states(s, d)[1]),
    "detect_encounters_states": _q_detect_states,
    "detect_encounters": lambda s, d: pairs_out(_detected(s, d), SILENCE_OUT),
    "enrich_silence": _q_enrich,
    "civilian_pairs": lambda s, d: pairs_out(flt.civilian_pairs(_detected(s, d), P), SILENCE_OUT),
    "silenced_pairs": lambda s, d: pairs_out(flt.silenced_pairs(_detected(s, d)), SILENCE_OUT),
    # ranking
    "closest_per_pair": lambda s, d: pairs_out(ranking.closest_per_pair(_detected(s, d)), SILENCE_OUT),
    "top_encounters": _q_top_encounters,
    "three_rankings": lambda s, d: _q_ranked_out(_ranked(s, d)),
    "ranked_pair": lambda s, d: _q_ranked_out(ranking.ranked_pair(_ranked(s, d), "all", 1)),
    "pair_counts": lambda s, d: ranking.pair_counts(_detected_distinct(s, d), P),
    "rank_in_all": _q_rank_in_all,
    "encounter_result": lambda s, d: _q_result(ranking.encounter_result(_ranked(s, d), P)),
    "identified_encounter": lambda s, d: _q_result(ranking.identified_encounter(_ranked(s, d), P)),
    "encounter_report": lambda s, d: _q_result(encounter_report(_raw(s, d), MIDS, P)),
    # trajectories
    "vessel_time_window": _q_vessel_time_window,
    "pair_trajectories": _q_pair_trajectories,
    "nearest_ping": _q_nearest,
    "trajectory_label": _q_label,
    "trajectory_polyline": _q_polyline,
    "trajectory_geojson": _q_geojson,
    "trajectory_extent": _q_extent,
    "trajectory_headings": _q_headings,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
