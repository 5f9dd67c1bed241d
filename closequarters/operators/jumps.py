"""GPS-jump outliers: implied speed to the previous and next ping of a vessel.

Skew-safe layout: a vessel's track is cut into chunks of about equally many
pings (``chunk_bounds``: quantiles of its timestamps from a mergeable sketch) and
the ordered window runs per (track, chunk), so one long, dense or duplicated
track is spread over many tasks.  The first and last ping of each chunk get their
missing neighbour from a small per-chunk edge table, made by a map-side
``min``/``max`` of the order columns (one narrow row per task, track and chunk is
shuffled).  The pings themselves are exchanged once: window and edge join use
the same keys, a track key that is never null and the chunk.  Result = an
unchunked per-vessel lag/lead.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_nm
from ..functions.timecols import epoch_s
from ..params import DEFAULTS, Params
from ..sources.schema import TRACK_ORDER

NO_ID = -(2**63)
NO_TIME_CHUNK = -(2**53)
UNTIMED_CHUNKS = 64


def _order_cols(df: DataFrame) -> list[str]:
    return [c for c in TRACK_ORDER if c in df.columns]


def track_key() -> Column:
    """The vessel id, never null: reports without id are one more track, as in a
    window partition.  Being an ordinary equality, it serves window and join."""
    return F.coalesce(F.col("mmsi").cast("long"), F.lit(NO_ID)).alias("_track")


def chunk_bounds(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``_track``, ``_bounds`` of the long tracks: the ascending timestamps (s) at
    which their second and later chunks begin.

    A track is long if it has more timed pings than a chunk may hold:
    ``track_chunk_pings``, or all pings / ``track_chunks_total`` if that is more,
    so that no table has more than ``track_chunks_total`` bounds (which makes
    them safe to broadcast).  The quantiles are a partial aggregation over long
    tracks only.  Their rank error is a tenth of the finest step (1 /
    ``track_chunk_parts`` of the track); a chunk holds no more pings than that
    allows, whatever the report rate, but those of one second stay together."""
    timed = df.filter(F.col("ts").isNotNull()).select(track_key(), epoch_s("ts").alias("_t"))
    sizes = timed.groupBy("_track").agg(F.count(F.lit(1)).alias("_pings"))
    most = F.greatest(F.lit(p.track_chunk_pings), F.ceil(F.sum("_pings") / F.lit(p.track_chunks_total)))
    long = (sizes.filter(F.col("_pings") > F.lit(p.track_chunk_pings))
            .withColumn("_most", sizes.agg(most).scalar()).filter("_pings > _most"))
    n = p.track_chunk_parts
    steps = F.percentile_approx("_t", [i / n for i in range(1, n)], 10 * n).alias("_steps")
    parts = F.least(F.ceil(F.col("_pings") / F.col("_most")), F.lit(n)).cast("int")
    starts = F.transform(F.sequence(F.lit(1), F.col("_parts") - 1),
                         lambda i: F.get("_steps", F.floor(i * F.lit(n) / F.col("_parts")).cast("int") - 1))
    found = timed.join(F.broadcast(long.select("_track")), "_track", "left_semi").groupBy("_track").agg(steps)
    return (found.join(F.broadcast(long.withColumn("_parts", parts)), "_track")
            .select("_track", F.array_distinct(starts).alias("_bounds")))


def with_chunks(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The pings with their track key and chunk.  Pings without a timestamp have
    no speeds, whatever their neighbours, so they may lie in any order: they are
    dealt by their position over chunks before all others (nulls sort first)."""
    t = epoch_s("ts")
    keyed = df.select("*", track_key())
    if p.track_chunk_s is not None:
        later = F.floor(t / F.lit(p.track_chunk_s))
    else:
        keyed = keyed.join(F.broadcast(chunk_bounds(df, p)), "_track", "left")
        later = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= t)), F.lit(0))
    untimed = F.lit(NO_TIME_CHUNK) - F.pmod(F.xxhash64("lat", "lon"), F.lit(UNTIMED_CHUNKS))
    return keyed.select(*[F.col(c) for c in df.columns], "_track",
                        F.when(t.isNull(), untimed).otherwise(later).cast("long").alias("_chunk"))


def _neighbours(df: DataFrame, p: Params) -> tuple[DataFrame, Column, Column, Column]:
    """The pings with their previous/next report (struct t, y, x) per track."""
    order = _order_cols(df)
    pos = F.struct(epoch_s("ts").alias("t"), F.col("lat").alias("y"), F.col("lon").alias("x"))
    chunked = with_chunks(df, p)
    w = Window.partitionBy("_track", "_chunk").orderBy(*order)
    d = (chunked.select("*", pos.alias("_pos"))
           .select("*", F.lag("_pos").over(w).alias("_prev"), F.lead("_pos").over(w).alias("_next")))

    place = F.struct(F.col("ts"), F.col("lat"), F.col("lon"))  # the leading order columns decide the edge's position
    wc = Window.partitionBy("_m").orderBy("_k")
    edges = (chunked.select(F.col("_track").alias("_m"), F.col("_chunk").alias("_k"), place.alias("_o"))
               .groupBy("_m", "_k").agg(F.min("_o").alias("_first"), F.max("_o").alias("_last")))

    def edge(c):
        return F.when(c.isNotNull(), F.struct(epoch_s(c.getField("ts")).alias("t"), c.getField("lat").alias("y"),
                                              c.getField("lon").alias("x")))

    edges = edges.select("_m", "_k", edge(F.lag("_last").over(wc)).alias("_prev_edge"),
                         edge(F.lead("_first").over(wc)).alias("_next_edge"))
    j = d.join(edges, (F.col("_track") == F.col("_m")) & (F.col("_chunk") == F.col("_k")))
    prev = F.coalesce(F.col("_prev"), F.col("_prev_edge"))
    nxt = F.coalesce(F.col("_next"), F.col("_next_edge"))
    return j, prev, F.col("_pos"), nxt


def _speeds(prev: Column, here: Column, nxt: Column, p: Params) -> tuple[Column, Column]:
    def g(s, f):
        return s.getField(f)

    sp = F.try_divide(haversine_nm(g(prev, "y"), g(prev, "x"), g(here, "y"), g(here, "x"), p.earth_radius_nm)
                      * F.lit(3600.0), g(here, "t") - g(prev, "t"))
    sn = F.try_divide(haversine_nm(g(here, "y"), g(here, "x"), g(nxt, "y"), g(nxt, "x"), p.earth_radius_nm)
                      * F.lit(3600.0), g(nxt, "t") - g(here, "t"))
    return sp.alias("speed_prev_kn"), sn.alias("speed_next_kn")


def implied_speeds(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Adds ``speed_prev_kn`` and ``speed_next_kn`` (null where the
    neighbour is missing or the time step is zero).  Pings without a timestamp
    sort first and get null speeds, as in an unchunked window ordered
    nulls-first."""
    j, prev, here, nxt = _neighbours(df, p)
    return j.select(*[F.col(c) for c in df.columns], *_speeds(prev, here, nxt, p))


RUN_KEY = ("mmsi", "ts", "lat", "lon")


def _jump_filter_runs(df: DataFrame, p: Params) -> DataFrame:
    """W1 over runs of reports sharing (mmsi, ts, lat, lon).

    Such reports are adjacent in the track order and only their first and
    last can survive: inner ones have a zero time step to both neighbours
    (both speeds unknown), the first one's next step and the last one's
    previous step are zero too.  So one row per run goes through the window
    (partial aggregation collapses copies map-side), and the first/last report
    of the run (min/max of the remaining order columns) come back out with
    the verdicts "previous speed within limit" / "next speed within limit"; a
    run of one report gets the usual two-sided rule.  Same rows as the
    unchunked per-report filter."""
    rest = [c for c in TRACK_ORDER if c in df.columns and c not in RUN_KEY]
    rest += [c for c in df.columns if c not in RUN_KEY and c not in rest]
    r = F.struct(*[F.col(c) for c in rest])
    runs = df.groupBy(*RUN_KEY).agg(F.count(F.lit(1)).alias("_k_rows"), F.min(r).alias("_lo"), F.max(r).alias("_hi"))
    j, prev, here, nxt = _neighbours(runs, p)
    sp, sn = _speeds(prev, here, nxt, p)
    lim = F.lit(p.max_plausible_speed_kn)
    single = F.col("_k_rows") == 1
    first_ok = F.when(single, ~((sp > lim) & (sn > lim))).otherwise(sp <= lim)
    last_ok = F.when(single, F.lit(False)).otherwise(sn <= lim)
    cand = j.select(*RUN_KEY, F.explode(F.array(
        F.struct(F.col("_lo").alias("r"), first_ok.alias("ok")),
        F.struct(F.col("_hi").alias("r"), last_ok.alias("ok")))).alias("_c"))
    return cand.filter(F.col("_c.ok")).select(
        *[F.col(c) if c in RUN_KEY else F.col("_c.r").getField(c).alias(c) for c in df.columns])


def gps_jump_filter(df: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Drop pings whose implied speed exceeds the limit to both neighbours."""
    if p.collapse_track_copies:
        return _jump_filter_runs(df, p)
    j, prev, here, nxt = _neighbours(df, p)
    sp, sn = _speeds(prev, here, nxt, p)
    lim = F.lit(p.max_plausible_speed_kn)
    return j.filter(~((sp > lim) & (sn > lim))).select(*[F.col(c) for c in df.columns])
