from .fixture import FIXTURE_SQL, derived_pings
from .readers import normalize_pings, parse_utc_timestamp, read_mid_codes, read_pings, read_pings_csv
from .schema import PING_COLUMNS, RAW_SCHEMA, TRACK_ORDER
from .sinks import pairs_for_json, raw_from_pings, write_pairs_json, write_pings, write_pings_csv

__all__ = ["FIXTURE_SQL", "derived_pings", "normalize_pings", "parse_utc_timestamp", "read_mid_codes",
           "read_pings", "read_pings_csv", "PING_COLUMNS", "RAW_SCHEMA", "TRACK_ORDER",
           "pairs_for_json", "raw_from_pings", "write_pairs_json", "write_pings", "write_pings_csv"]
