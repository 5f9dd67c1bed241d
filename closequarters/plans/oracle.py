"""Independent SQL twins of the registered queries (DuckDB dialect).

Each query is a chain of CTEs over the same derived ping view.  The SQL is
written from the operator semantics, not from the Spark plan: window
functions where Spark uses arg-min aggregates, a brute-force same-minute
neighbour join where Spark uses the forward-cell expansion.  Double literals
are written in exponent form (DuckDB reads plain decimals as DECIMAL) and the
trigonometry is associated exactly as in the Spark expressions.
"""
from __future__ import annotations

from ..params import DEFAULTS, FIXTURE_MID_CODES, METRES_PER_NM, UNDEFINED_SHIP_TYPE
from ..sources.fixture import FIXTURE_SQL, ROUGH_SQL
from .catalog import READ_DAYS, WINDOW_CENTRE_S, WINDOW_IDS

P = DEFAULTS


def f(x: float) -> str:
    return "%.17e" % float(x)


def ints(xs) -> str:
    return ", ".join(str(int(x)) for x in xs)


def strs(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    la1, la2 = f"radians({lat1})", f"radians({lat2})"
    s1 = f"sin((({la2}) - ({la1})) / 2e0)"
    s2 = f"sin((radians({lon2}) - radians({lon1})) / 2e0)"
    a = f"(({s1}) * ({s1}) + cos({la1}) * cos({la2}) * (({s2}) * ({s2})))"
    return f"({f(2.0 * P.earth_radius_nm)} * asin(sqrt({a})))"


TRACK = "ts_s NULLS FIRST, lat, lon, sog NULLS FIRST, cog NULLS FIRST, name NULLS FIRST, ship_type NULLS FIRST"
PING_COLS = "ts_s, mmsi, lat, lon, sog, cog, name, ship_type"
FULL_COLS = PING_COLS + ", nav_status, mobile_type, imo, callsign"
PAIR_COLS = ("mmsi_a, mmsi_b, ts_a_s, ts_b_s, lat_a, lat_b, lon_a, lon_b, sog_a, sog_b, name_a, name_b, "
             "ship_type_a, ship_type_b, round(dist_m, 6) AS dist_m")
OPS = strs(P.operational_types)

CTE = {}
CTE["pings"] = FIXTURE_SQL
CTE["spatial"] = (f"SELECT * FROM pings WHERE lat BETWEEN {f(P.box[0][0])} AND {f(P.box[0][1])} "
                  f"AND lon BETWEEN {f(P.box[1][0])} AND {f(P.box[1][1])} "
                  f"AND {hav(f(P.centre_lat), f(P.centre_lon), 'lat', 'lon')} <= {f(P.radius_nm)}")
SOG_NORM = (f"CASE WHEN sog < 0 THEN 0e0 WHEN sog >= {f(P.sog_not_available_kn)} THEN 0e0 ELSE sog END")
MMSI_OK = (f"mmsi IS NOT NULL AND mmsi BETWEEN {P.mmsi_range[0]} AND {P.mmsi_range[1]} "
           f"AND mmsi NOT IN ({ints(P.mmsi_deny_list)}) AND mmsi NOT IN ({ints(P.mmsi_repeated)}) "
           f"AND CAST(floor(mmsi / 1e6) AS INTEGER) IN ({ints(FIXTURE_MID_CODES)})")
CTE["checked"] = f"SELECT * REPLACE ({SOG_NORM} AS sog) FROM spatial WHERE {MMSI_OK}"
CTE["vmax"] = "SELECT mmsi, max(sog) AS max_sog FROM checked GROUP BY mmsi"
CTE["moving"] = f"SELECT * FROM checked WHERE mmsi IN (SELECT mmsi FROM vmax WHERE max_sog > {f(P.min_vessel_max_sog_kn)})"
CTE["speeds"] = (
    "SELECT * EXCLUDE (p_ts, p_lat, p_lon, n_ts, n_lat, n_lon), "
    f"{hav('p_lat', 'p_lon', 'lat', 'lon')} * 3600e0 / NULLIF(ts_s - p_ts, 0) AS speed_prev_kn, "
    f"{hav('lat', 'lon', 'n_lat', 'n_lon')} * 3600e0 / NULLIF(n_ts - ts_s, 0) AS speed_next_kn "
    "FROM (SELECT *, lag(ts_s) OVER w AS p_ts, lag(lat) OVER w AS p_lat, lag(lon) OVER w AS p_lon, "
    "lead(ts_s) OVER w AS n_ts, lead(lat) OVER w AS n_lat, lead(lon) OVER w AS n_lon "
    f"FROM moving WINDOW w AS (PARTITION BY mmsi ORDER BY {TRACK}))")
JUMP_OK = (f"NOT (speed_prev_kn > {f(P.max_plausible_speed_kn)} AND speed_next_kn > {f(P.max_plausible_speed_kn)})")
CTE["jump_free"] = f"SELECT * EXCLUDE (speed_prev_kn, speed_next_kn) FROM speeds WHERE {JUMP_OK}"
CTE["dense"] = (f"SELECT * FROM jump_free WHERE mmsi IN (SELECT mmsi FROM jump_free GROUP BY mmsi "
                f"HAVING count(*) >= {P.min_pings_per_vessel})")
CTE["names"] = ("SELECT mmsi, name AS vessel_name FROM (SELECT mmsi, name, row_number() OVER "
                "(PARTITION BY mmsi ORDER BY ts_s NULLS FIRST, name) AS rn FROM dense WHERE name IS NOT NULL) WHERE rn = 1")
CTE["types"] = ("SELECT mmsi, ship_type AS modal_type FROM (SELECT mmsi, ship_type, row_number() OVER "
                "(PARTITION BY mmsi ORDER BY n DESC, ship_type) AS rn FROM (SELECT mmsi, ship_type, count(*) AS n "
                f"FROM dense WHERE ship_type IS NOT NULL AND ship_type <> '{UNDEFINED_SHIP_TYPE}' "
                "GROUP BY mmsi, ship_type)) WHERE rn = 1")
CTE["clean"] = ("SELECT d.* REPLACE (coalesce(d.name, nm.vessel_name) AS name, "
                f"coalesce(CASE WHEN d.ship_type <> '{UNDEFINED_SHIP_TYPE}' THEN d.ship_type END, t.modal_type, "
                "d.ship_type) AS ship_type) FROM dense d LEFT JOIN names nm ON nm.mmsi = d.mmsi "
                "LEFT JOIN types t ON t.mmsi = d.mmsi")
CTE["mv"] = (f"SELECT *, CAST(trunc(ts_s / {f(P.time_bucket_s)}) AS BIGINT) AS time_bucket, "
             f"CAST(floor(lat / {f(P.lat_cell_deg)}) AS INTEGER) AS lat_cell, "
             f"CAST(floor(lon / {f(P.lon_cell_deg)}) AS INTEGER) AS lon_cell "
             f"FROM clean WHERE sog > {f(P.min_moving_sog_kn)}")
# Brute force: every unordered pair of pings of different vessels in the same
# minute bucket and in touching grid cells.
CTE["pairs"] = (
    "SELECT a.mmsi AS mmsi_a, b.mmsi AS mmsi_b, a.ts_s AS ts_a_s, b.ts_s AS ts_b_s, a.lat AS lat_a, b.lat AS lat_b, "
    "a.lon AS lon_a, b.lon AS lon_b, a.sog AS sog_a, b.sog AS sog_b, "
    "coalesce(a.name, 'MMSI ' || CAST(a.mmsi AS VARCHAR)) AS name_a, "
    "coalesce(b.name, 'MMSI ' || CAST(b.mmsi AS VARCHAR)) AS name_b, "
    "a.ship_type AS ship_type_a, b.ship_type AS ship_type_b, "
    f"{hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} * {f(METRES_PER_NM)} AS dist_m "
    "FROM mv a JOIN mv b ON a.time_bucket = b.time_bucket AND a.mmsi < b.mmsi "
    "AND abs(a.lat_cell - b.lat_cell) <= 1 AND abs(a.lon_cell - b.lon_cell) <= 1 "
    f"WHERE {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} < {f(P.encounter_distance_nm)}")
CTE["lastp"] = ("SELECT mmsi, ts_s AS last_ts_s, lat AS last_lat, lon AS last_lon FROM (SELECT *, row_number() OVER "
                "(PARTITION BY mmsi ORDER BY ts_s DESC, lat DESC, lon DESC) AS rn FROM clean) WHERE rn = 1")
CTE["lc"] = (f"SELECT *, CAST(floor(last_lat / {f(P.port_lat_deg)}) AS INTEGER) AS port_lat_cell, "
             f"CAST(floor(last_lon / {f(P.port_lon_deg)}) AS INTEGER) AS port_lon_cell FROM lastp")
CTE["ports"] = ("SELECT port_lat_cell, port_lon_cell, count(*) AS n_vessels FROM lc GROUP BY port_lat_cell, "
                f"port_lon_cell HAVING count(*) >= {P.port_min_vessels}")
CTE["prof"] = ("SELECT lc.mmsi, lc.last_ts_s, (p.n_vessels IS NOT NULL) AS in_port FROM lc LEFT JOIN ports p "
               "ON p.port_lat_cell = lc.port_lat_cell AND p.port_lon_cell = lc.port_lon_cell")
CTE["endt"] = "SELECT * FROM (SELECT max(ts_s) AS end_ts_s FROM clean) WHERE end_ts_s IS NOT NULL"
CTE["enc"] = (
    f"SELECT pr.*, (pa.last_ts_s <= pr.ts_a_s + {P.silence_window_s} AND pr.ts_a_s + {P.silence_buffer_s} <= "
    "(SELECT end_ts_s FROM endt) AND NOT pa.in_port) AS silenced_a, "
    f"(pb.last_ts_s <= pr.ts_b_s + {P.silence_window_s} AND pr.ts_b_s + {P.silence_buffer_s} <= "
    "(SELECT end_ts_s FROM endt) AND NOT pb.in_port) AS silenced_b "
    "FROM pairs pr LEFT JOIN prof pa ON pa.mmsi = pr.mmsi_a LEFT JOIN prof pb ON pb.mmsi = pr.mmsi_b")
CIVIL = f"NOT (ship_type_a IN ({OPS})) AND NOT (ship_type_b IN ({OPS}))"
CTE["tagged"] = (f"SELECT 'all' AS list, * FROM enc UNION ALL SELECT 'civilian' AS list, * FROM enc WHERE {CIVIL} "
                 "UNION ALL SELECT 'silenced' AS list, * FROM enc WHERE silenced_a OR silenced_b")
PAIR_TIE = ("round(dist_m, 6), ts_a_s, ts_b_s, mmsi_a, mmsi_b, lat_a, lon_a, lat_b, lon_b, sog_a NULLS FIRST, "
            "sog_b NULLS FIRST, name_a, name_b, ship_type_a NULLS FIRST, ship_type_b NULLS FIRST, dist_m, "
            "silenced_a NULLS FIRST, silenced_b NULLS FIRST")
RANK_KEY = "round(dist_m, 6), ts_a_s, ts_b_s, mmsi_a, mmsi_b"
CTE["best"] = (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY list, mmsi_a, mmsi_b "
               f"ORDER BY {PAIR_TIE}) AS rn FROM tagged) WHERE rn = 1")
CTE["ranked"] = (f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY list ORDER BY {RANK_KEY}) AS BIGINT) "
                 f"AS rank FROM best) WHERE rank <= {P.top_n}")
HALF = 60 * P.trajectory_half_window_min
CTE["req"] = (f"SELECT list, rank, mmsi_a AS mmsi, ts_a_s AS own_ts_s, ts_a_s - {HALF} AS t_lo, ts_a_s + {HALF} AS t_hi "
              f"FROM ranked UNION ALL SELECT list, rank, mmsi_b AS mmsi, ts_b_s AS own_ts_s, ts_a_s - {HALF} AS t_lo, "
              f"ts_a_s + {HALF} AS t_hi FROM ranked")
CTE["traj"] = ("SELECT r.list, r.rank, r.own_ts_s, c.* FROM clean c JOIN req r ON c.mmsi = r.mmsi "
               "AND c.ts_s BETWEEN r.t_lo AND r.t_hi")
CTE["tpos"] = (f"SELECT *, row_number() OVER (PARTITION BY list, rank, mmsi ORDER BY {TRACK}) - 1 AS pos, "
               "count(*) OVER (PARTITION BY list, rank, mmsi) AS n_points FROM traj")
CTE["ext"] = ("SELECT list, rank, avg(lat) AS centre_lat, avg(lon) AS centre_lon, max(lat) - min(lat) AS lat_range, "
              "max(lon) - min(lon) AS lon_range, count(*) AS n_points FROM traj GROUP BY list, rank")

DEPS = {
    "spatial": ["pings"], "checked": ["spatial"], "vmax": ["checked"], "moving": ["vmax"], "speeds": ["moving"],
    "jump_free": ["speeds"], "dense": ["jump_free"], "names": ["dense"], "types": ["dense"],
    "clean": ["names", "types"], "mv": ["clean"], "pairs": ["mv"], "lastp": ["clean"], "lc": ["lastp"],
    "ports": ["lc"], "prof": ["ports"], "endt": ["clean"], "enc": ["pairs", "prof", "endt"], "tagged": ["enc"],
    "best": ["tagged"], "ranked": ["best"], "req": ["ranked"], "traj": ["req"], "tpos": ["traj"], "ext": ["traj"],
}


def _closure(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def q(body: str, *needs: str) -> str:
    names = _closure(list(needs))
    with_ = ",\n".join(f"{n} AS ({CTE[n]})" for n in names)
    return f"WITH {with_}\n{body}"


def rough(body: str, *needs: str) -> str:
    """``q`` over the pings with placeholder ids, copies and missing timestamps."""
    names = [n for n in _closure(list(needs)) if n != "pings"]
    parts = [f"fixture AS ({FIXTURE_SQL})", f"pings AS ({ROUGH_SQL})", *(f"{n} AS ({CTE[n]})" for n in names)]
    return "WITH " + ",\n".join(parts) + f"\n{body}"


def raw_track(body: str, *needs: str) -> str:
    """``q`` with the uncleaned pings in the place of the moving and clean ones."""
    names = [n for n in _closure(list(needs)) if n in ("speeds", "mv", "pairs")]
    parts = [f"moving AS ({FIXTURE_SQL})", "clean AS (SELECT * FROM moving)", *(f"{n} AS ({CTE[n]})" for n in names)]
    return "WITH " + ",\n".join(parts) + f"\n{body}"


def _result(src: str, extra: str = "") -> str:
    return (f"SELECT {extra}mmsi_a, mmsi_b, name_a, name_b, ship_type_a, ship_type_b, "
            "strftime(make_timestamp(ts_a_s * 1000000), '%Y-%m-%dT%H:%M:%S') || '.000' AS timestamp_utc, "
            "lat_a, lon_a, lat_b, lon_b, round(dist_m, 6) AS distance_m, "
            f"CAST({P.trajectory_half_window_min} AS BIGINT) AS window_minutes FROM {src}")


ISO = "strftime(make_timestamp({c} * 1000000), '%Y-%m-%dT%H:%M:%S') || '.000'"
DAY = "CAST(DATE '1970-01-01' + CAST(floor(ts_s / 86400e0) AS INTEGER) AS VARCHAR)"
HEAD_J = ("SELECT s.list, s.rank, s.mmsi, s.k, s.i, c.pos AS j, s.x0, s.y0, c.lon - s.x0 AS dx, c.lat - s.y0 AS dy "
          "FROM (SELECT g.*, t.lon AS x0, t.lat AS y0 FROM (SELECT DISTINCT list, rank, mmsi, n_points, k, "
          "CAST(floor((n_points - 2) * k / 4e0) AS BIGINT) AS i FROM tpos, range(5) r(k) WHERE n_points >= 2) g "
          "JOIN tpos t ON t.list = g.list AND t.rank = g.rank AND t.mmsi = g.mmsi AND t.pos = g.i) s "
          "JOIN tpos c ON c.list = s.list AND c.rank = s.rank AND c.mmsi = s.mmsi "
          "AND c.pos BETWEEN s.i + 1 AND least(s.i + 9, s.n_points - 1)")

ORACLES: dict[str, str] = {
    "read_pings_csv": rough(f"SELECT {FULL_COLS} FROM pings", "pings"),
    "write_pings_space": rough(f"SELECT {FULL_COLS} FROM pings WHERE lat BETWEEN {f(P.box[0][0])} AND {f(P.box[0][1])} "
                               f"AND lon BETWEEN {f(P.box[1][0])} AND {f(P.box[1][1])}", "pings"),
    "write_pings": rough(f"SELECT {FULL_COLS} FROM pings", "pings"),
    "read_pings": q(f"SELECT {PING_COLS} FROM pings WHERE {DAY} BETWEEN '{READ_DAYS[0]}' AND '{READ_DAYS[1]}'", "pings"),
    "read_mid_codes": q("SELECT DISTINCT CAST(floor(mmsi / 1e6) AS BIGINT) AS mid FROM pings", "pings"),
    "mmsi_mid_filter_table": q(f"SELECT {PING_COLS} FROM pings WHERE CAST(floor(mmsi / 1e6) AS BIGINT) % 2 = 1", "pings"),
    "trajectory_path": q("SELECT list, rank, mmsi, pos, lon, lat, " + ISO.format(c="ts_s") + " AS ts, sog, cog FROM tpos",
                         "tpos"),
    "normalize_pings": rough(f"SELECT {FULL_COLS} FROM pings", "pings"),
    "backfill_static": q(f"SELECT {PING_COLS} FROM clean", "clean"),
    "enrich_silence": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b FROM enc", "enc"),
    "canonical_pairs": q(
        "SELECT least(a.mmsi, b.mmsi) AS mmsi_a, greatest(a.mmsi, b.mmsi) AS mmsi_b, "
        "CASE WHEN a.mmsi < b.mmsi THEN a.ts_s ELSE b.ts_s END AS ts_a_s, "
        "CASE WHEN a.mmsi < b.mmsi THEN b.ts_s ELSE a.ts_s END AS ts_b_s, "
        "CASE WHEN a.mmsi < b.mmsi THEN a.lat ELSE b.lat END AS lat_a, "
        "CASE WHEN a.mmsi < b.mmsi THEN b.lat ELSE a.lat END AS lat_b, "
        "CASE WHEN a.mmsi < b.mmsi THEN a.lon ELSE b.lon END AS lon_a, "
        "CASE WHEN a.mmsi < b.mmsi THEN b.lon ELSE a.lon END AS lon_b, "
        "CASE WHEN a.mmsi < b.mmsi THEN a.sog ELSE b.sog END AS sog_a, "
        "CASE WHEN a.mmsi < b.mmsi THEN b.sog ELSE a.sog END AS sog_b, "
        "coalesce(CASE WHEN a.mmsi < b.mmsi THEN a.name ELSE b.name END, 'MMSI ' || CAST(least(a.mmsi, b.mmsi) AS VARCHAR)) AS name_a, "
        "coalesce(CASE WHEN a.mmsi < b.mmsi THEN b.name ELSE a.name END, 'MMSI ' || CAST(greatest(a.mmsi, b.mmsi) AS VARCHAR)) AS name_b, "
        "CASE WHEN a.mmsi < b.mmsi THEN a.ship_type ELSE b.ship_type END AS ship_type_a, "
        "CASE WHEN a.mmsi < b.mmsi THEN b.ship_type ELSE a.ship_type END AS ship_type_b, "
        f"round({hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} * {f(METRES_PER_NM)}, 6) AS dist_m "
        "FROM mv a JOIN mv b ON a.time_bucket = b.time_bucket AND a.mmsi > b.mmsi "
        "AND abs(a.lat_cell - b.lat_cell) <= 1 AND abs(a.lon_cell - b.lon_cell) <= 1 "
        f"WHERE {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} < {f(P.encounter_distance_nm)}", "mv"),
    "streaming_ingest": q(f"SELECT {PING_COLS} FROM pings", "pings"),
    "write_pairs_json": q(f"SELECT list, rank, mmsi_a, mmsi_b, {ISO.format(c='ts_a_s')} AS ts_a, "
                          f"{ISO.format(c='ts_b_s')} AS ts_b, round(dist_m, 6) AS dist_m, silenced_a, silenced_b "
                          "FROM ranked", "ranked"),
    "ingest_summary": q(f"SELECT count(*) AS rows, count(DISTINCT {DAY}) AS days, min({DAY}) AS first_day, "
                        f"max({DAY}) AS last_day FROM pings", "pings"),
    "haversine": q(f"SELECT ts_s, mmsi, lat, lon, round({hav(f(P.centre_lat), f(P.centre_lon), 'lat', 'lon')}, 7) "
                   "AS dist_centre_nm FROM pings", "pings"),
    "bbox_filter": q(f"SELECT {PING_COLS} FROM pings WHERE lat BETWEEN {f(P.box[0][0])} AND {f(P.box[0][1])} "
                     f"AND lon BETWEEN {f(P.box[1][0])} AND {f(P.box[1][1])}", "pings"),
    "within_radius": q(f"SELECT {PING_COLS} FROM spatial", "spatial"),
    "valid_mmsi_range": q(f"SELECT {PING_COLS} FROM pings WHERE mmsi IS NOT NULL AND mmsi BETWEEN "
                          f"{P.mmsi_range[0]} AND {P.mmsi_range[1]}", "pings"),
    "mmsi_deny_list": rough(f"SELECT {PING_COLS} FROM pings WHERE mmsi NOT IN ({ints(P.mmsi_deny_list)})", "pings"),
    "mmsi_repeated_digit": q(f"SELECT {PING_COLS} FROM pings WHERE mmsi NOT IN ({ints(P.mmsi_repeated)})", "pings"),
    "mmsi_mid_filter": q(f"SELECT {PING_COLS} FROM pings WHERE CAST(floor(mmsi / 1e6) AS INTEGER) IN "
                         f"({ints(FIXTURE_MID_CODES)})", "pings"),
    "normalize_sog": q(f"SELECT ts_s, mmsi, lat, lon, {SOG_NORM} AS sog, cog, name, ship_type FROM pings", "pings"),
    "mmsi_filter": q(f"SELECT {PING_COLS} FROM moving", "moving"),
    "vessel_max_sog": q("SELECT mmsi, max_sog FROM vmax", "vmax"),
    "moving_vessels": q(f"SELECT {PING_COLS} FROM moving", "moving"),
    "implied_speeds": q("SELECT ts_s, mmsi, lat, lon, round(speed_prev_kn, 4) AS speed_prev_kn, "
                        "round(speed_next_kn, 4) AS speed_next_kn FROM speeds", "speeds"),
    "not_teleport": q("SELECT ts_s, mmsi, lat, lon, round(speed_prev_kn, 4) AS speed_prev_kn, "
                      f"round(speed_next_kn, 4) AS speed_next_kn FROM speeds WHERE {JUMP_OK}", "speeds"),
    "gps_jump_filter": q(f"SELECT {PING_COLS} FROM jump_free", "jump_free"),
    "gps_jump_filter_runs": rough(f"SELECT {PING_COLS} FROM jump_free", "jump_free"),
    "implied_speeds_untimed": rough("SELECT ts_s, mmsi, lat, lon, round(speed_prev_kn, 4) AS speed_prev_kn, "
                                    "round(speed_next_kn, 4) AS speed_next_kn FROM speeds", "speeds"),
    "clean_pings_cut": q(f"SELECT {PING_COLS} FROM clean", "clean"),
    "gps_jump_filter_depth": raw_track(f"SELECT {PING_COLS} FROM speeds WHERE {JUMP_OK}", "speeds"),
    "encounter_pairs_dealt": raw_track(f"SELECT {PAIR_COLS} FROM pairs", "pairs"),
    "clean_pings_rough": rough(f"SELECT {FULL_COLS} FROM clean", "clean"),
    "encounter_pairs_copies": rough(f"SELECT {PAIR_COLS} FROM pairs", "pairs"),
    "vessel_ping_count": q("SELECT mmsi, count(*) AS n_pings FROM jump_free GROUP BY mmsi", "jump_free"),
    "min_pings": q(f"SELECT {PING_COLS} FROM dense", "dense"),
    "specific_type_rows": q(f"SELECT {PING_COLS} FROM pings WHERE ship_type IS NOT NULL AND ship_type <> "
                            f"'{UNDEFINED_SHIP_TYPE}'", "pings"),
    "vessel_name": q("SELECT d.mmsi, n.vessel_name FROM (SELECT DISTINCT mmsi FROM dense) d LEFT JOIN names n "
                     "ON n.mmsi = d.mmsi", "names"),
    "vessel_modal_type": q("SELECT mmsi, modal_type FROM types", "types"),
    "fill_vessel_static": q(f"SELECT {PING_COLS} FROM clean", "clean"),
    "clean_pings": q(f"SELECT {PING_COLS} FROM clean", "clean"),
    "stage_funnel": q(
        "SELECT stage_no, stage, rows, lag(rows) OVER (ORDER BY stage_no) - rows AS dropped, "
        "round((lag(rows) OVER (ORDER BY stage_no) - rows) * 100e0 / lag(rows) OVER (ORDER BY stage_no), 4) "
        "AS pct_of_previous FROM ("
        "SELECT CAST(1 AS BIGINT) AS stage_no, 'input' AS stage, count(*) AS rows FROM pings UNION ALL "
        "SELECT 2, 'spatial', count(*) FROM spatial UNION ALL SELECT 3, 'mmsi_moving', count(*) FROM moving "
        "UNION ALL SELECT 4, 'gps_jump', count(*) FROM jump_free UNION ALL SELECT 5, 'sparsity', count(*) FROM dense)",
        "dense"),
    "clean_summary": q("SELECT count(*) AS rows, count(DISTINCT mmsi) AS vessels FROM clean", "clean"),
    "moving_pings": q(f"SELECT {PING_COLS} FROM clean WHERE sog > {f(P.min_moving_sog_kn)}", "clean"),
    "bucket_keys": q("SELECT ts_s, mmsi, lat, lon, time_bucket, lat_cell, lon_cell FROM mv", "mv"),
    "expand_cells": q("SELECT ts_s, mmsi, lat, lon, lat_cell, lon_cell, lat_cell + o.dy AS cell_lat_v, "
                      "lon_cell + o.dx AS cell_lon_v FROM mv, (VALUES (0, 0), (0, 1), (1, -1), (1, 0), (1, 1)) "
                      "o(dy, dx)", "mv"),
    "encounter_pairs": q(f"SELECT {PAIR_COLS} FROM pairs", "pairs"),
    "encounter_distance": q("SELECT mmsi_a, mmsi_b, ts_a_s, ts_b_s, round(dist_m, 6) AS dist_m FROM pairs", "pairs"),
    "vessel_display_name": q("SELECT ts_s, mmsi, lat, lon, coalesce(name, 'MMSI ' || CAST(mmsi AS VARCHAR)) "
                             "AS display_name FROM clean", "clean"),
    "vessel_last_seen": q("SELECT mmsi, last_ts_s, last_lat, last_lon FROM lastp", "lastp"),
    "dataset_end": q("SELECT end_ts_s FROM endt", "endt"),
    "port_cells": q("SELECT port_lat_cell, port_lon_cell, n_vessels FROM ports", "ports"),
    "vessels_in_port": q("SELECT mmsi, last_ts_s FROM prof WHERE in_port", "prof"),
    "detect_encounters": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b FROM enc", "enc"),
    "civilian_pairs": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b FROM enc WHERE {CIVIL}", "enc"),
    "silenced_pairs": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b FROM enc WHERE silenced_a OR silenced_b", "enc"),
    "closest_per_pair": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b FROM best WHERE list = 'all'", "best"),
    "top_encounters": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b, rank FROM ranked WHERE list = 'all'", "ranked"),
    "three_rankings": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b, list, rank FROM ranked", "ranked"),
    "ranked_pair": q(f"SELECT {PAIR_COLS}, silenced_a, silenced_b, list, rank FROM ranked WHERE list = 'all' "
                     "AND rank = 1", "ranked"),
    "pair_counts": q("SELECT list, sum(e) AS encounters, count(*) AS pairs FROM (SELECT list, mmsi_a, mmsi_b, "
                     "count(*) AS e FROM tagged GROUP BY list, mmsi_a, mmsi_b) GROUP BY list", "tagged"),
    "rank_in_all": q(
        "SELECT t.list, t.rank, 1 + count(a.mmsi_a) AS rank_in_all, "
        f"count(a.mmsi_a) FILTER (WHERE a.ship_type_a IN ({OPS}) OR a.ship_type_b IN ({OPS})) AS operational_ahead "
        "FROM ranked t LEFT JOIN (SELECT * FROM best WHERE list = 'all') a ON "
        "(round(a.dist_m, 6), a.ts_a_s, a.ts_b_s, a.mmsi_a, a.mmsi_b) < "
        "(round(t.dist_m, 6), t.ts_a_s, t.ts_b_s, t.mmsi_a, t.mmsi_b) GROUP BY t.list, t.rank", "ranked"),
    "encounter_result": q(_result("ranked", "list, rank, "), "ranked"),
    "identified_encounter": q(_result("(SELECT * FROM ranked WHERE list = 'silenced' AND rank = 1)"), "ranked"),
    "encounter_report": q(_result("ranked", "list, rank, "), "ranked"),
    "vessel_time_window": q(f"SELECT {PING_COLS} FROM clean WHERE mmsi IN ({ints(WINDOW_IDS)}) AND ts_s BETWEEN "
                            f"{WINDOW_CENTRE_S - HALF} AND {WINDOW_CENTRE_S + HALF}", "clean"),
    "pair_trajectories": q("SELECT list, rank, mmsi, own_ts_s, ts_s, lat, lon, sog, cog, name, ship_type FROM traj",
                           "traj"),
    "nearest_ping": q("SELECT list, rank, mmsi, ts_s, lat, lon, sog, cog FROM (SELECT *, row_number() OVER "
                      f"(PARTITION BY list, rank, mmsi ORDER BY abs(ts_s - own_ts_s), {TRACK}) AS rn FROM traj) "
                      "WHERE rn = 1", "traj"),
    "trajectory_label": q("SELECT list, rank, mmsi, coalesce(first(name ORDER BY " + TRACK + ") FILTER "
                          "(WHERE name IS NOT NULL), 'MMSI ' || CAST(mmsi AS VARCHAR)) || ' (' || CAST(mmsi AS VARCHAR) "
                          "|| ')' AS label FROM traj GROUP BY list, rank, mmsi", "traj"),
    "trajectory_polyline": q(
        "SELECT list, rank, mmsi, max(n_points) AS n_points, min(ts_s) FILTER (WHERE pos = 0) AS first_ts_s, "
        "max(ts_s) FILTER (WHERE pos = n_points - 1) AS last_ts_s, "
        "max(lon) FILTER (WHERE pos = 0) AS first_lon, max(lat) FILTER (WHERE pos = 0) AS first_lat, "
        "max(lon) FILTER (WHERE pos = n_points - 1) AS last_lon, max(lat) FILTER (WHERE pos = n_points - 1) AS last_lat "
        "FROM tpos GROUP BY list, rank, mmsi", "tpos"),
    "trajectory_geojson": q(
        "SELECT list, rank, mmsi, CAST(max(n_points) AS INTEGER) AS n_points, "
        "'{\"type\":\"Feature\",\"geometry\":{\"type\":\"LineString\",\"coordinates\":[' || "
        "string_agg('[' || lon || ',' || lat || ']', ',' ORDER BY pos) || ']},\"properties\":{\"ts\":[' || "
        "string_agg('\"' || " + ISO.format(c="ts_s") + " || '\"', ',' ORDER BY pos) || '],\"sog\":[' || "
        "string_agg(coalesce(CAST(sog AS VARCHAR), 'null'), ',' ORDER BY pos) || '],\"cog\":[' || "
        "string_agg(coalesce(CAST(cog AS VARCHAR), 'null'), ',' ORDER BY pos) || ']}}' AS geojson "
        "FROM tpos GROUP BY list, rank, mmsi", "tpos"),
    "trajectory_extent": q(
        "SELECT list, rank, round(centre_lat, 9) AS centre_lat, round(centre_lon, 9) AS centre_lon, "
        "round(lat_range, 9) AS lat_range, round(lon_range, 9) AS lon_range, "
        f"round(greatest(lon_range, lat_range, {f(1e-4)}) * {f(0.04)}, 9) AS arrow_len, n_points FROM ext", "ext"),
    "trajectory_headings": q(
        "SELECT h.list, h.rank, h.mmsi, h.k, h.i AS pos_from, h.j AS pos_to, h.x0 AS lon0, h.y0 AS lat0, "
        "round(h.dx / h.d * (greatest(e.lon_range, e.lat_range, " + f(1e-4) + ") * " + f(0.04) + "), 9) AS arrow_dlon, "
        "round(h.dy / h.d * (greatest(e.lon_range, e.lat_range, " + f(1e-4) + ") * " + f(0.04) + "), 9) AS arrow_dlat "
        "FROM (SELECT *, row_number() OVER (PARTITION BY list, rank, mmsi, k ORDER BY j) AS rn FROM "
        "(SELECT *, sqrt(dx * dx + dy * dy) AS d FROM (" + HEAD_J + ")) WHERE d > " + f(1e-7) + ") h "
        "JOIN ext e ON e.list = h.list AND e.rank = h.rank WHERE h.rn = 1", "tpos", "ext"),
}


# the same results by another way share their SQL
ORACLES |= {twin: ORACLES[key] for twin, key in {
    "ingest_summary_observed": "ingest_summary",
    "stage_funnel_observed": "stage_funnel",
    "clean_summary_vessels": "clean_summary",
    "vessels_in_port_states": "vessels_in_port",
    "detect_encounters_states": "detect_encounters",
}.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
