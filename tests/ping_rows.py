"""Small ping tables for tests."""
from __future__ import annotations

PING_SCHEMA = ("ts timestamp, mmsi bigint, lat double, lon double, sog double, cog double, nav_status string, "
               "mobile_type string, name string, ship_type string, imo string, callsign string, day date")


def pings(spark, rows):
    """rows: dicts with ts_s, mmsi, lat, lon and optional sog/name/ship_type/cog."""
    import datetime as dt

    out = []
    for r in rows:
        ts = None if r.get("ts_s") is None else dt.datetime.fromtimestamp(r["ts_s"], dt.timezone.utc)
        out.append((ts, r.get("mmsi"), r.get("lat"), r.get("lon"), r.get("sog", 5.0), r.get("cog", 0.0), None, None,
                    r.get("name"), r.get("ship_type", "Cargo"), None, None,
                    None if ts is None else ts.date()))
    return spark.createDataFrame(out, PING_SCHEMA)
