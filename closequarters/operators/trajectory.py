"""Trajectories around ranked encounters, as Spark tables (the data a map or
plot is drawn from): all pairs of all lists in one job.

The window requests are the rows of the ranked frame, whatever its length
(Spark broadcasts them when they are small, and else filters the pings by a
Bloom filter of the requests' keys before the exchange); the ping table streams
past them with an equi-join on (mmsi, day, time slot) plus a range residual on
the timestamp.  A slot is about as long as a window, so a request touches two
slots, and only the pings of those reach the residual, not a vessel's whole day.
Joining on the ``day`` partition column as well lets dynamic partition pruning
skip every day partition no request touches when the table is day-partitioned
Parquet.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import SECONDS_PER_DAY, epoch_s, iso_millis, utc_day
from ..params import (ARROW_FRACTION, ARROW_MIN_EXTENT_DEG, DEFAULTS, HEADING_ARROWS, HEADING_LOOKAHEAD,
                      HEADING_MIN_STEP_DEG, Params)
from ..sources.schema import TRACK_ORDER

GROUP = ("list", "rank", "mmsi")


def slot_seconds(p: Params = DEFAULTS) -> int:
    """Length of a time slot: the shortest that holds a whole window and divides
    a day (a slot lies in one day then), or a day."""
    window = 2 * 60 * p.trajectory_half_window_min
    return next((s for s in range(max(1, window), SECONDS_PER_DAY) if SECONDS_PER_DAY % s == 0), SECONDS_PER_DAY)


def time_slot(seconds: Column, p: Params = DEFAULTS) -> Column:
    return F.floor(seconds / F.lit(slot_seconds(p)))


def window_requests(ranked: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """One row per (list, rank, vessel, time slot touched), for every row of the
    ranked frame: both vessels' windows are centred on side a's encounter time;
    ``own_ts_s`` is the vessel's own ping.  The predicate ``rank >= 1`` cuts
    nothing; it lets Spark prune the day partitions of the ping table
    dynamically (a build side with a filter)."""
    half = 60 * p.trajectory_half_window_min
    centre = epoch_s("ts_a")
    sides = F.array(F.struct(F.col("mmsi_a").alias("mmsi"), epoch_s("ts_a").alias("own_ts_s")),
                    F.struct(F.col("mmsi_b").alias("mmsi"), epoch_s("ts_b").alias("own_ts_s")))
    r = (ranked.filter(F.col("rank") >= 1)
               .select("list", "rank", (centre - half).alias("t_lo"), (centre + half).alias("t_hi"),
                       F.explode(sides).alias("_s")))
    slots = F.sequence(time_slot(F.col("t_lo"), p), time_slot(F.col("t_hi"), p))
    return (r.select("list", "rank", F.col("_s.mmsi").alias("mmsi"), F.col("_s.own_ts_s").alias("own_ts_s"),
                     "t_lo", "t_hi", F.explode(slots).alias("slot"))
            .withColumn("day", utc_day(F.col("slot") * F.lit(slot_seconds(p)))))


def slot_matches(ranked: DataFrame, pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The equi-join of J8: pings (g) and requests (r) of one vessel and time slot."""
    t = epoch_s("ts")
    g = pings.withColumns({"ts_s": t, "slot": time_slot(t, p)}).alias("g")
    r = window_requests(ranked, p).alias("r")
    return g.join(r, [F.col(f"g.{c}") == F.col(f"r.{c}") for c in ("mmsi", "day", "slot")])


def pair_trajectories(ranked: DataFrame, pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The pings of both vessels within ±window of every ranked encounter."""
    inside = slot_matches(ranked, pings, p).filter(F.col("g.ts_s").between(F.col("r.t_lo"), F.col("r.t_hi")))
    return inside.select(
        "r.list", "r.rank", "r.own_ts_s", *[F.col(f"g.{c}") for c in ("mmsi", "ts", "ts_s", "lat", "lon", "sog", "cog",
                                                                      "name", "ship_type", "nav_status", "mobile_type",
                                                                      "imo", "callsign")])


def _rank_struct(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in TRACK_ORDER if c in df.columns])


def nearest_ping(traj: DataFrame) -> DataFrame:
    """T5: per vessel of a ranked pair, the window ping closest in time to that
    vessel's own encounter ping; the earliest wins a tie."""
    key = F.struct(F.abs(F.col("ts_s") - F.col("own_ts_s")).alias("dt"), _rank_struct(traj).alias("o"))
    row = F.struct("ts_s", "lat", "lon", "sog", "cog")
    return traj.groupBy(*GROUP).agg(F.min_by(row, key).alias("_p")).select(*GROUP, "_p.*")


def trajectory_label(traj: DataFrame) -> DataFrame:
    """V1: ``NAME (id)`` from the first named ping of the window, else ``MMSI id (id)``."""
    first = F.min(F.when(F.col("name").isNotNull(), F.struct(_rank_struct(traj).alias("o"), F.col("name").alias("n"))))
    return (traj.groupBy(*GROUP).agg(first.getField("n").alias("_n"))
            .select(*GROUP, F.format_string("%s (%d)", F.coalesce(F.col("_n"), F.format_string("MMSI %d", F.col("mmsi"))),
                                            F.col("mmsi")).alias("label")))


def trajectory_points(traj: DataFrame) -> DataFrame:
    """Window pings with their 0-based position along the vessel's path and the
    path length (ordered window per (list, rank, vessel); a window spans 20
    minutes of one vessel, so the group is bounded by time)."""
    w = Window.partitionBy(*GROUP).orderBy(*[c for c in TRACK_ORDER if c in traj.columns])
    wn = Window.partitionBy(*GROUP)
    return traj.withColumns({"pos": F.row_number().over(w) - 1, "n_points": F.count(F.lit(1)).over(wn)})


def path_from_geojson(lines: DataFrame) -> DataFrame:
    """V2 read back: one row per path point (list, rank, mmsi, pos, lon, lat,
    ts, sog, cog) parsed from the GeoJSON strings of ``trajectory_polyline``."""
    shape = ("type string, geometry struct<type: string, coordinates: array<array<double>>>, "
             "properties struct<ts: array<string>, sog: array<double>, cog: array<double>>")
    f = F.from_json("geojson", shape)
    points = F.arrays_zip(f["geometry"]["coordinates"].alias("c"), f["properties"]["ts"].alias("ts"),
                          f["properties"]["sog"].alias("sog"), f["properties"]["cog"].alias("cog"))
    one = lines.select(*GROUP, F.posexplode(points).alias("pos", "_p"))
    return one.select(*GROUP, "pos", F.col("_p")["c"][0].alias("lon"), F.col("_p")["c"][1].alias("lat"),
                      F.col("_p")["ts"].alias("ts"), F.col("_p")["sog"].alias("sog"), F.col("_p")["cog"].alias("cog"))


def trajectory_polyline(traj: DataFrame) -> DataFrame:
    """V2: per (list, rank, vessel) the ordered path as a GeoJSON Feature
    (LineString of [lon, lat], with per-report UTC time, SOG and COG as
    properties), plus its length and end points.  The group is one vessel's
    reports in one 20-minute window."""
    pts = F.sort_array(F.collect_list(F.struct(_rank_struct(traj).alias("o"), F.col("lon").alias("x"),
                                               F.col("lat").alias("y"), F.col("ts_s").alias("t"))))
    g = traj.groupBy(*GROUP).agg(pts.alias("_p"))
    p = F.col("_p")
    coords = F.transform(p, lambda s: F.array(s.getField("x"), s.getField("y")))
    props = F.struct(
        F.transform(p, lambda s: iso_millis(s.getField("t"))).alias("ts"),
        F.transform(p, lambda s: s.getField("o").getField("sog")).alias("sog"),
        F.transform(p, lambda s: s.getField("o").getField("cog")).alias("cog"))
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"),
                       props.alias("properties"))
    first, last = F.element_at("_p", 1), F.element_at("_p", -1)
    return g.select(*GROUP, F.size("_p").alias("n_points"),
                    first.getField("o").getField("ts").alias("first_ts"), last.getField("o").getField("ts").alias("last_ts"),
                    first.getField("x").alias("first_lon"), first.getField("y").alias("first_lat"),
                    last.getField("x").alias("last_lon"), last.getField("y").alias("last_lat"),
                    F.to_json(feature).alias("geojson"))


def trajectory_extent(traj: DataFrame) -> DataFrame:
    """Per ranked pair (both vessels): map centre, lat/lon ranges and the
    heading-arrow length (4 % of the larger range, at least 1e-4 degrees)."""
    lat_rng = F.max("lat") - F.min("lat")
    lon_rng = F.max("lon") - F.min("lon")
    return traj.groupBy("list", "rank").agg(
        F.avg("lat").alias("centre_lat"), F.avg("lon").alias("centre_lon"),
        lat_rng.alias("lat_range"), lon_rng.alias("lon_range"),
        (F.greatest(lon_rng, lat_rng, F.lit(ARROW_MIN_EXTENT_DEG)) * F.lit(ARROW_FRACTION)).alias("arrow_len"),
        F.count(F.lit(1)).alias("n_points"))


def trajectory_headings(traj: DataFrame) -> DataFrame:
    """V3: heading arrows.  For a path of n >= 2 points, sample positions
    i_k = floor(k (n-2) / 4), k = 0..4; the arrow at i_k points to the first of
    the next nine positions that is more than 1e-7 degrees away, scaled to the
    pair's arrow length.  Candidates are generated as exact (group, position)
    keys and joined - no pairing inside a group."""
    pts = trajectory_points(traj)
    ext = trajectory_extent(traj).select("list", "rank", "arrow_len")
    groups = traj.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_points")).filter(F.col("n_points") >= 2)
    starts = (groups.select(*GROUP, "n_points", F.explode(F.sequence(F.lit(0), F.lit(HEADING_ARROWS - 1))).alias("k"))
                 .withColumn("i", ((F.col("n_points") - 2) * F.col("k") / F.lit(HEADING_ARROWS - 1)).cast("int")))
    cand = starts.withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.least(F.col("i") + HEADING_LOOKAHEAD,
                                                                                F.col("n_points") - 1))))
    p0 = pts.select(*GROUP, F.col("pos").alias("i"), F.col("lon").alias("x0"), F.col("lat").alias("y0"))
    p1 = pts.select(*GROUP, F.col("pos").alias("j"), F.col("lon").alias("x1"), F.col("lat").alias("y1"))
    c = cand.join(p0, [*GROUP, "i"]).join(p1, [*GROUP, "j"])
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    c = c.withColumns({"dx": dx, "dy": dy, "d": F.sqrt(dx * dx + dy * dy)}) \
         .filter(F.col("d") > F.lit(HEADING_MIN_STEP_DEG))
    first = c.groupBy(*GROUP, "k", "i").agg(F.min_by(F.struct("j", "x0", "y0", "dx", "dy", "d"), F.col("j")).alias("_f"))
    return (first.join(ext, ["list", "rank"])
            .select(*GROUP, "k", F.col("i").alias("pos_from"), F.col("_f.j").alias("pos_to"),
                    F.col("_f.x0").alias("lon0"), F.col("_f.y0").alias("lat0"),
                    (F.col("_f.dx") / F.col("_f.d") * F.col("arrow_len")).alias("arrow_dlon"),
                    (F.col("_f.dy") / F.col("_f.d") * F.col("arrow_len")).alias("arrow_dlat")))


