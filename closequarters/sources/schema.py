"""Schemas of the position-report tables."""
from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# --- Fixed values: the 26 columns of the raw daily CSV export, in file order ---
RAW_COLUMNS = (
    ("# Timestamp", StringType()),
    ("Type of mobile", StringType()),
    ("MMSI", LongType()),
    ("Latitude", DoubleType()),
    ("Longitude", DoubleType()),
    ("Navigational status", StringType()),
    ("ROT", DoubleType()),
    ("SOG", DoubleType()),
    ("COG", DoubleType()),
    ("Heading", DoubleType()),
    ("IMO", StringType()),
    ("Callsign", StringType()),
    ("Name", StringType()),
    ("Ship type", StringType()),
    ("Cargo type", StringType()),
    ("Width", DoubleType()),
    ("Length", DoubleType()),
    ("Type of position fixing device", StringType()),
    ("Draught", DoubleType()),
    ("Destination", StringType()),
    ("ETA", StringType()),
    ("Data source type", StringType()),
    ("A", DoubleType()),
    ("B", DoubleType()),
    ("C", DoubleType()),
    ("D", DoubleType()),
)
RAW_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"
# Working ping table: raw column -> working name.
PING_RENAMES = (
    ("MMSI", "mmsi"),
    ("Latitude", "lat"),
    ("Longitude", "lon"),
    ("SOG", "sog"),
    ("COG", "cog"),
    ("Navigational status", "nav_status"),
    ("Type of mobile", "mobile_type"),
    ("Name", "name"),
    ("Ship type", "ship_type"),
    ("IMO", "imo"),
    ("Callsign", "callsign"),
)
# --- end of fixed values ---

RAW_SCHEMA = StructType([StructField(n, t, True) for n, t in RAW_COLUMNS])

PING_COLUMNS = ("ts", "mmsi", "lat", "lon", "sog", "cog", "nav_status", "mobile_type",
                "name", "ship_type", "imo", "callsign", "day")

# Total order of a vessel's pings: ties on ts are broken by every other
# attribute so lag/lead, "first" and "last" never depend on input order.
TRACK_ORDER = ("ts", "lat", "lon", "sog", "cog", "name", "ship_type", "nav_status",
               "mobile_type", "imo", "callsign")
