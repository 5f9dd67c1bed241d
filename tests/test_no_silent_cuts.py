"""Parameters never cut results silently, and the big tables are exchanged as often as the design says."""
from __future__ import annotations

import math
import re
from dataclasses import replace

import pytest
from ping_rows import pings
from pyspark.sql import functions as F

from closequarters.functions.timecols import epoch_s
from closequarters.operators import encounters as enc
from closequarters.operators import filters as flt
from closequarters.operators import jumps, ranking, trajectory
from closequarters.params import DEFAULTS, FIXTURE_MID_CODES, Params
from closequarters.plans.clean import clean_pings, clean_stages, stage_funnel
from closequarters.sources import derived_pings, read_pings, write_pairs_json, write_pings

T0 = 1639362420
SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def detected(spark):
    """24 vessel pairs, each meeting once, at growing distances."""
    rows = []
    for i in range(24):
        for k in (0, 1):
            rows.append(dict(ts_s=T0 + 300 * i, mmsi=219000001 + 2 * i + k, lat=54.9 + 0.02 * i, lon=14.0 + 1e-5 * (i + 1) * k,
                             ship_type="Tug" if i % 3 == 0 else "Cargo"))
    df = pings(spark, rows)
    return df, enc.detect_encounters(df).cache()


def test_larger_top_n_reaches_every_consumer(detected):
    df, pairs = detected
    p = replace(DEFAULTS, top_n=20)
    ranked = ranking.three_rankings(pairs, p)
    n = ranked.count()
    assert n > 30
    # consumers called with the default parameters take the frame as it is
    assert ranking.rank_in_all(pairs, ranked).count() == n
    traj = trajectory.pair_trajectories(ranked, df)
    assert traj.select("list", "rank").distinct().count() == n


def test_rank_in_all_equals_counting(detected):
    _, pairs = detected
    ranked = ranking.three_rankings(pairs, replace(DEFAULTS, top_n=20))
    key = lambda r: (round(r["dist_m"], 6), r["ts_a"], r["ts_b"], r["mmsi_a"], r["mmsi_b"])
    best = ranking.closest_per_pair(pairs).collect()
    ops = set(DEFAULTS.operational_types)
    want = {}
    for r in ranked.collect():
        ahead = [b for b in best if key(b) < key(r)]
        want[r["list"], r["rank"]] = (len(ahead) + 1, sum(b["ship_type_a"] in ops or b["ship_type_b"] in ops for b in ahead))
    out = ranking.rank_in_all(pairs, ranked)
    assert {(r["list"], r["rank"]): (r["rank_in_all"], r["operational_ahead"]) for r in out.collect()} == want
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


@pytest.mark.parametrize("p", [Params(radius_nm=80.0), Params(centre_lat=40.0, centre_lon=5.0), Params(radius_nm=20.0),
                               Params(centre_lat=10.0, centre_lon=179.9), Params(centre_lat=89.5, centre_lon=0.0)])
def test_circle_is_never_clipped_by_its_box(spark, p):
    def dist(lat, lon):
        a, b = math.radians(p.centre_lat), math.radians(lat)
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon - p.centre_lon) / 2) ** 2
        return 2 * p.earth_radius_nm * math.asin(math.sqrt(min(1.0, h)))

    span = p.radius_nm / 50.0
    grid = [(max(-90.0, min(90.0, p.centre_lat + span * i / 20)), (p.centre_lon + 3 * span * j / 20 + 180) % 360 - 180)
            for i in range(-30, 31) for j in range(-30, 31)]
    want = sum(dist(*g) <= p.radius_nm for g in grid)
    df = spark.createDataFrame(grid, "lat double, lon double")
    assert want > 100
    assert flt.within_radius(df, p).count() == want


def test_box_that_clips_the_circle_is_rejected():
    with pytest.raises(ValueError, match="does not hold"):
        Params(radius_nm=80.0, bbox_lat=(54.3, 56.15), bbox_lon=(12.7, 15.8)).box
    assert Params(bbox_lat=(50.0, 60.0), bbox_lon=(10.0, 20.0)).box == ((50.0, 60.0), (10.0, 20.0))


def test_narrow_grid_raises(spark):
    df = pings(spark, [dict(ts_s=T0, mmsi=219000001, lat=55.0, lon=14.0)])
    with pytest.raises(ValueError, match="narrower"):
        enc.encounter_pairs(df, Params(grid_cell_m=20.0))


def test_pings_without_timestamp_keep_their_rows(spark):
    rows = [dict(ts_s=T0 + 60 * i, mmsi=219000001, lat=55.0 + 0.001 * i, lon=14.0) for i in range(8)]
    rows += [dict(ts_s=None, mmsi=219000001, lat=55.0, lon=14.0 + i) for i in range(5)]
    out = jumps.implied_speeds(pings(spark, rows), Params(track_chunk_s=120))
    assert out.count() == 13
    assert out.filter(F.col("ts").isNull() & F.col("speed_prev_kn").isNull() & F.col("speed_next_kn").isNull()).count() == 5


def test_written_pings_are_all_read_back(spark, tmp_path):
    rows = [dict(ts_s=T0 + 86400 * 3 * i, mmsi=219000001, lat=55.0, lon=14.0) for i in range(30)]
    write_pings(pings(spark, rows), str(tmp_path / "p"))
    assert read_pings(spark, str(tmp_path / "p")).count() == 30
    some = read_pings(spark, str(tmp_path / "p"), days=("2021-12-13", "2021-12-31"))
    assert some.count() == 7
    assert "PartitionFilters: [isnotnull(day" in plan(some)


def test_unranked_pairs_are_not_written_to_one_file(detected, tmp_path):
    with pytest.raises(ValueError, match="ranked"):
        write_pairs_json(detected[1], str(tmp_path / "x"))


def test_copies_stay_a_column_until_the_output(spark):
    rows = [dict(ts_s=T0, mmsi=219000001, lat=55.0, lon=14.0)] * 40 + [dict(ts_s=T0, mmsi=219000002, lat=55.0, lon=14.0)] * 30
    df = pings(spark, rows)
    kept = enc.detect_encounters(df, keep_copies=True)
    assert [r["n_copies"] for r in kept.collect()] == [1200]
    assert enc.detect_encounters(df).count() == 1200
    counts = {r["list"]: (r["encounters"], r["pairs"]) for r in ranking.pair_counts(kept).collect()}
    assert counts["all"] == (1200, 1)


def ping_exchanges(p: str) -> list[str]:
    """Exchanges that carry single pings (their rows hold a longitude)."""
    return [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)]


def test_clean_exchanges_the_pings_once(spark, tmp_path, no_broadcast):
    write_pings(derived_pings(spark, SF), str(tmp_path / "p"))
    raw = spark.read.parquet(str(tmp_path / "p"))
    kept = clean_stages(raw, FIXTURE_MID_CODES).kept
    p = plan(kept)
    assert p.count("Window [lag(") + p.count("Window [lead(") <= 2  # the pings' window and that of the edge table
    by_chunk = [x for x in ping_exchanges(p) if "_chunk" in x]
    assert len(by_chunk) == 1


def test_funnel_counts_equal_the_stage_tables(spark):
    raw = derived_pings(spark, SF)
    s = clean_stages(raw, FIXTURE_MID_CODES)
    want = [raw.count(), s.spatial.count(), s.moving.count(), s.jump_free.count(), s.dense.count()]
    got = stage_funnel(raw, FIXTURE_MID_CODES)
    cut = clean_stages(raw, FIXTURE_MID_CODES, cut=True)
    shared = stage_funnel(raw, FIXTURE_MID_CODES, stages=cut)
    assert "lag(" not in plan(cut.vessels) and sorted(shared.collect()) == sorted(got.collect())
    assert [r["rows"] for r in got.orderBy("stage_no").collect()] == want
    assert clean_pings(raw, FIXTURE_MID_CODES, cut=False).count() == clean_pings(raw, FIXTURE_MID_CODES).count() == want[-1]


def test_silence_reads_the_clean_table_once(spark, tmp_path, no_broadcast):
    write_pings(clean_pings(derived_pings(spark, SF), FIXTURE_MID_CODES), str(tmp_path / "c"))
    clean = spark.read.parquet(str(tmp_path / "c"))
    pairs = spark.createDataFrame([], enc.detect_encounters(clean).drop("silenced_a", "silenced_b").schema)
    out = enc.enrich_silence(pairs, clean)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") <= 1 + final.count("ReusedExchange")


def test_shared_folder_is_required_off_local_mode(spark):
    from closequarters import session

    class Context:
        master = "spark://somewhere:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")


def test_trajectory_path_survives_geojson(detected):
    df, pairs = detected
    traj = trajectory.pair_trajectories(ranking.three_rankings(pairs), df)
    back = trajectory.path_from_geojson(trajectory.trajectory_polyline(traj))
    want = trajectory.trajectory_points(traj).select("list", "rank", "mmsi", "pos", "lon", "lat", epoch_s("ts"))
    got = back.select("list", "rank", "mmsi", "pos", "lon", "lat", F.unix_seconds(F.to_timestamp("ts")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rough_pings_exercise_deny_list_copies_and_missing_times(spark):
    from closequarters.operators import encounters as enc
    from closequarters.operators.filters import mmsi_deny_list
    from closequarters.sources.fixture import rough_pings

    raw = rough_pings(spark, "/root/testdata/sf0.01").cache()
    n = raw.count()
    assert mmsi_deny_list(raw).count() < n
    assert raw.filter("ts is null").count() > 0 and raw.filter("imo is not null and callsign is not null").count() > 0
    assert raw.distinct().count() < n
    clean = clean_pings(raw, FIXTURE_MID_CODES)
    kept = enc.encounter_pairs(clean, keep_copies=True)
    assert kept.filter("n_copies > 1").count() > 0
    assert kept.agg({"n_copies": "sum"}).first()[0] == enc.encounter_pairs(clean).count()
    raw.unpersist()
