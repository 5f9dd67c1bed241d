"""Position reports derived from the provided ``events`` table.

The test data has no ship positions, so both Spark and the SQL oracle derive
the same pings from ``events`` with integer and double arithmetic only (bit
identical in both engines).  Vessels sail in groups of five around a grid of
points; "shadow" pings make certain encounters; chosen residues make GPS
teleports, sentinel speeds, bad ids, thin tracks and silent vessels.
The derivation is one scan of ``events``: each event yields one or two pings
through ``explode``, and the table maximum enters as a scalar subquery.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s, utc_day

FIXTURE_SQL = """
WITH hi AS (SELECT max(event_id) AS m FROM events),
base AS (
  SELECT event_id, user_id, event_type, 0 AS shadow FROM events, hi
  WHERE NOT (user_id % 7 = 3 AND event_id * 10 > m * 6)
    AND NOT (user_id % 29 = 4 AND event_id % 5 <> 0)
  UNION ALL
  SELECT event_id, user_id, event_type, 1 AS shadow FROM events, hi
  WHERE user_id % 7 = 3 AND event_id * 10 <= m * 6
),
v AS (
  SELECT event_id, event_type, shadow, user_id + shadow AS vid,
         CAST(floor(user_id / 5e0) AS BIGINT) AS g,
         CAST((event_id * 7919 + user_id * 104729) % 2001 - 1000 AS DOUBLE) / 1e3 AS jx,
         CAST((event_id * 6101 + user_id * 15485863) % 2001 - 1000 AS DOUBLE) / 1e3 AS jy
  FROM base
)
SELECT
  CAST(1638316800 + event_id * 4 + shadow * 8 AS BIGINT) AS ts_s,
  CAST(CASE WHEN vid % 23 = 0 THEN 111000000 + vid
            WHEN vid % 23 = 1 THEN 222222222
            WHEN vid % 23 = 2 THEN 299000000 + vid
            WHEN vid % 3 = 0 THEN 219000000 + vid
            WHEN vid % 3 = 1 THEN 265000000 + vid
            ELSE 232000000 + vid END AS BIGINT) AS mmsi,
  CASE WHEN g % 10 = 9 THEN 58e0 WHEN g % 10 = 8 THEN 5435e-2
       ELSE 549e-1 + CAST(g % 20 AS DOUBLE) * 3e-2 END
    + jx * 3e-3 + CAST(shadow AS DOUBLE) * 15e-5
    + CASE WHEN event_id % 97 = 0 THEN 3e-1 ELSE 0e0 END AS lat,
  CASE WHEN g % 10 = 8 THEN 1275e-2
       ELSE 136e-1 + CAST(CAST(floor(g / 20e0) AS BIGINT) AS DOUBLE) * 8e-2 END
    + jy * 5e-3 + CAST(shadow AS DOUBLE) * 15e-5 AS lon,
  CASE WHEN vid % 19 = 5 THEN 5e-1
       WHEN event_id % 17 = 0 THEN NULL
       WHEN event_id % 13 = 0 THEN -1e0
       WHEN event_id % 11 = 0 THEN 1023e-1
       ELSE CAST(event_id % 120 AS DOUBLE) / 1e1 END AS sog,
  CAST(event_id % 360 AS DOUBLE) AS cog,
  CASE WHEN event_id % 3 = 0 AND vid % 31 <> 6 THEN concat('VESSEL ', CAST(vid AS VARCHAR(20))) END AS name,
  CASE WHEN event_type = 'view' THEN 'Cargo'
       WHEN event_type = 'click' THEN CASE WHEN vid % 4 = 0 THEN 'Tug' ELSE 'Cargo' END
       WHEN event_type = 'purchase' THEN 'Fishing'
       WHEN event_type = 'signup' THEN 'Undefined' END AS ship_type
FROM v
"""

# The same pings with what the view above never has: placeholder ids, values in
# the remaining text columns, exact copies and missing timestamps.
ROUGH_SQL = """
SELECT CASE WHEN ts_s % 172 <> 0 THEN ts_s END AS ts_s,
       CASE WHEN ts_s % 148 = 0 THEN 123456789 WHEN ts_s % 164 = 0 THEN 987654321 ELSE mmsi END AS mmsi,
       lat, lon, sog, cog, name, ship_type,
       CASE WHEN ts_s % 12 = 0 THEN 'Under way using engine' WHEN ts_s % 12 = 4 THEN 'At anchor' END AS nav_status,
       CASE WHEN ts_s % 8 = 0 THEN 'Class A' ELSE 'Class B' END AS mobile_type,
       CASE WHEN ts_s % 20 = 0 THEN concat('IMO', CAST(mmsi AS VARCHAR(20))) END AS imo,
       CASE WHEN ts_s % 28 = 0 THEN concat('OX', CAST(mmsi AS VARCHAR(20))) END AS callsign
FROM fixture, range(3) r(i)
WHERE i = 0 OR ts_s % 52 = 0
"""

EPOCH_2021_12_01 = 1638316800


def _lit(x) -> Column:
    return F.lit(x)


def derived_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The working ping table (13 columns) derived from ``{sf_dir}/events.parquet``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type")
    m = ev.select(F.max("event_id")).scalar()
    e, u = F.col("event_id"), F.col("user_id")
    late = e * 10 > m * 6
    keep_plain = ~((u % 7 == 3) & late) & ~((u % 29 == 4) & (e % 5 != 0))
    keep_shadow = (u % 7 == 3) & (e * 10 <= m * 6)
    both, plain, shadow = F.array(_lit(0), _lit(1)), F.array(_lit(0)), F.array(_lit(1))
    shadows = (F.when(keep_plain & keep_shadow, both).when(keep_plain, plain).when(keep_shadow, shadow)
               .otherwise(F.array().cast("array<int>")))
    base = ev.select("event_id", "user_id", "event_type", F.explode(shadows).alias("shadow"))

    s = F.col("shadow")
    vid = u + s
    g = F.floor(u / _lit(5.0)).cast("bigint")
    jx = ((e * 7919 + u * 104729) % 2001 - 1000).cast("double") / _lit(1e3)
    jy = ((e * 6101 + u * 15485863) % 2001 - 1000).cast("double") / _lit(1e3)
    v = base.select("event_id", "event_type", "shadow", vid.alias("vid"), g.alias("g"),
                    jx.alias("jx"), jy.alias("jy"))

    e, s, vid, g = F.col("event_id"), F.col("shadow"), F.col("vid"), F.col("g")
    sd = s.cast("double")
    ts_s = (_lit(EPOCH_2021_12_01) + e * 4 + s * 8).cast("bigint")
    mmsi = (F.when(vid % 23 == 0, _lit(111000000) + vid)
            .when(vid % 23 == 1, _lit(222222222))
            .when(vid % 23 == 2, _lit(299000000) + vid)
            .when(vid % 3 == 0, _lit(219000000) + vid)
            .when(vid % 3 == 1, _lit(265000000) + vid)
            .otherwise(_lit(232000000) + vid)).cast("bigint")
    lat = (F.when(g % 10 == 9, _lit(58.0)).when(g % 10 == 8, _lit(54.35))
           .otherwise(_lit(54.9) + (g % 20).cast("double") * _lit(0.03))
           + F.col("jx") * _lit(0.003) + sd * _lit(0.00015)
           + F.when(e % 97 == 0, _lit(0.3)).otherwise(_lit(0.0)))
    lon = (F.when(g % 10 == 8, _lit(12.75))
           .otherwise(_lit(13.6) + F.floor(g / _lit(20.0)).cast("bigint").cast("double") * _lit(0.08))
           + F.col("jy") * _lit(0.005) + sd * _lit(0.00015))
    sog = (F.when(vid % 19 == 5, _lit(0.5))
           .when(e % 17 == 0, _lit(None).cast("double"))
           .when(e % 13 == 0, _lit(-1.0))
           .when(e % 11 == 0, _lit(102.3))
           .otherwise((e % 120).cast("double") / _lit(10.0)))
    name = F.when((e % 3 == 0) & (vid % 31 != 6), F.concat(_lit("VESSEL "), vid.cast("string")))
    et = F.col("event_type")
    ship_type = (F.when(et == "view", _lit("Cargo"))
                 .when(et == "click", F.when(vid % 4 == 0, _lit("Tug")).otherwise(_lit("Cargo")))
                 .when(et == "purchase", _lit("Fishing"))
                 .when(et == "signup", _lit("Undefined")))
    null_s = _lit(None).cast("string")
    row = F.struct(
        F.timestamp_seconds(ts_s).alias("ts"), mmsi.alias("mmsi"), lat.alias("lat"), lon.alias("lon"),
        sog.alias("sog"), (F.col("event_id") % 360).cast("double").alias("cog"),
        null_s.alias("nav_status"), null_s.alias("mobile_type"), name.alias("name"),
        ship_type.alias("ship_type"), null_s.alias("imo"), null_s.alias("callsign"),
        utc_day(ts_s).alias("day"),
    )
    # ``inline`` makes the derived columns generator outputs: downstream filters
    # then test the computed value instead of having the whole derivation
    # inlined into every predicate that mentions lat/lon.
    return v.select(F.inline(F.array(row)))


def rough_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``derived_pings`` with placeholder ids, all text columns, copies and
    missing timestamps (``ROUGH_SQL`` in Spark)."""
    t, mmsi = epoch_s("ts"), F.col("mmsi")
    copies = F.explode(F.array_repeat(_lit(0), F.when(t % 52 == 0, 3).otherwise(1)))
    pings = derived_pings(spark, sf_dir).select("*", t.alias("_t"), copies.alias("_copy"))
    t = F.col("_t")
    timed = t % 172 != 0
    return pings.select(
        F.when(timed, F.col("ts")).alias("ts"),
        F.when(t % 148 == 0, _lit(123456789)).when(t % 164 == 0, _lit(987654321)).otherwise(mmsi).alias("mmsi"),
        "lat", "lon", "sog", "cog",
        F.when(t % 12 == 0, _lit("Under way using engine")).when(t % 12 == 4, _lit("At anchor")).alias("nav_status"),
        F.when(t % 8 == 0, _lit("Class A")).otherwise(_lit("Class B")).alias("mobile_type"),
        "name", "ship_type",
        F.when(t % 20 == 0, F.concat(_lit("IMO"), mmsi.cast("string"))).alias("imo"),
        F.when(t % 28 == 0, F.concat(_lit("OX"), mmsi.cast("string"))).alias("callsign"),
        F.when(timed, F.col("day")).alias("day"))
