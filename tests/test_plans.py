"""Physical-plan checks: the shapes the design relies on at scale."""
from __future__ import annotations

from ping_rows import pings

from closequarters.operators import encounters as enc
from closequarters.operators import filters as flt
from closequarters.operators import ranking
from closequarters.sources import derived_pings, write_pings

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_self_join_is_an_equi_join(spark):
    p = plan(enc.encounter_pairs(derived_pings(spark, SF)))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "Generate explode" in p or "Generate" in p


def test_window_lookup_prunes_day_partitions(spark, tmp_path):
    path = str(tmp_path / "pings")
    write_pings(derived_pings(spark, SF), path)
    df = flt.vessel_time_window(spark.read.parquet(path), [219000003], 1638316800 + 5 * 3600)
    s = df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    assert "PartitionFilters: [isnotnull(day" in s or "PartitionFilters: [" in s and "day" in s


def test_bbox_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "pings")
    write_pings(derived_pings(spark, SF), path)
    df = flt.within_radius(spark.read.parquet(path)).select("mmsi", "lat")
    s = plan(df)
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lon), GreaterThanOrEqual(lat" in s


def test_rank_filter_is_a_group_limit(spark):
    rows = [dict(ts_s=1639362420 + i, mmsi=219000001 + (i % 2), lat=55.0, lon=14.0) for i in range(6)]
    p = plan(ranking.three_rankings(enc.detect_encounters(pings(spark, rows))))
    assert "WindowGroupLimit" in p


def test_trajectory_join_prunes_days_dynamically(spark, tmp_path):
    from closequarters.operators import trajectory
    from closequarters.params import FIXTURE_MID_CODES
    from closequarters.plans.clean import clean_pings

    clean_path, ranked_path = str(tmp_path / "clean"), str(tmp_path / "ranked")
    clean_pings(derived_pings(spark, SF), FIXTURE_MID_CODES).write.partitionBy("day").parquet(clean_path)
    clean = spark.read.parquet(clean_path)
    ranking.three_rankings(enc.detect_encounters(clean)).write.parquet(ranked_path)
    t = trajectory.pair_trajectories(spark.read.parquet(ranked_path), spark.read.parquet(clean_path))
    t.collect()
    p = plan(t)
    assert "dynamicpruning" in p.lower()
    assert "BroadcastNestedLoopJoin" not in p


def test_run_batch_end_to_end(spark, tmp_path):
    from closequarters.params import FIXTURE_MID_CODES
    from closequarters.plans.batch import run_batch
    from closequarters.sources.sinks import write_pings_csv

    csv = str(tmp_path / "csv")
    write_pings_csv(derived_pings(spark, SF), csv)
    paths = run_batch(spark, csv, str(tmp_path / "out"), FIXTURE_MID_CODES)
    results = spark.read.json(paths["results"])
    ranked = spark.read.parquet(paths["ranked"])
    assert results.count() == ranked.count() > 0
    assert spark.read.parquet(paths["trajectories"]).count() > 0
    assert spark.read.parquet(paths["clean"]).count() == 720  # FIXTURES.md count at sf0.001


def test_streaming_ingest_restart_is_exactly_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from closequarters.sources.sinks import write_pings_csv
    from closequarters.streaming import ingest_stream

    pings = derived_pings(spark, SF)
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    first = pings.filter(F.col("mmsi") % 2 == 0)
    second = pings.filter(F.col("mmsi") % 2 == 1)
    write_pings_csv(first, src + "/a")
    ingest_stream(spark, src + "/*", out, ckpt, available_now=True).awaitTermination()
    n1 = spark.read.parquet(out).count()
    write_pings_csv(second, src + "/b")
    ingest_stream(spark, src + "/*", out, ckpt, available_now=True).awaitTermination()  # restart, same checkpoint
    assert n1 == first.count()
    assert spark.read.parquet(out).count() == pings.count()
