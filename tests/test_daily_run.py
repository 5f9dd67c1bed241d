"""States by day, counts observed by writes, slotted trajectory join, ranks by ranges."""
from __future__ import annotations

from dataclasses import replace

import pytest
from ping_rows import pings
from pyspark.sql import functions as F

from closequarters.operators import daystates, ranking, trajectory, vessels
from closequarters.operators import encounters as enc
from closequarters.params import DEFAULTS, FIXTURE_MID_CODES
from closequarters.plans.clean import (clean_pings, clean_stages, clean_summary, ingest_summary, stage_funnel,
                                       summary_from_vessels, summary_from_write)
from closequarters.sources import derived_pings, write_pings

SF = "/root/testdata/sf0.001"
PAIR_SCHEMA = ("mmsi_a long, mmsi_b long, ts_a timestamp, ts_b timestamp, lat_a double, lat_b double, lon_a double, "
               "lon_b double, sog_a double, sog_b double, name_a string, name_b string, ship_type_a string, "
               "ship_type_b string, dist_m double")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df) -> int:
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Three days: every vessel on the first, fewer on each further one."""
    path = str(tmp_path_factory.mktemp("daily") / "pings")
    one = clean_pings(derived_pings(spark, SF), FIXTURE_MID_CODES)
    later = one.withColumn("_d", F.explode(F.sequence(F.lit(0), F.pmod(F.col("mmsi"), F.lit(3)).cast("int"))))
    later = later.withColumns({"ts": F.timestamp_seconds(F.unix_seconds("ts") + F.col("_d") * 86400),
                               "day": F.date_add("day", F.col("_d"))}).drop("_d")
    return path, write_pings(later.select(one.columns), path)["days"]


def test_a_new_day_reads_one_day_of_pings(spark, tmp_path, stored):
    path, days = stored
    table = spark.read.parquet(path)
    assert len(days) == 3
    states = str(tmp_path / "states")
    daystates.write_states(daystates.day_states(table.filter(F.col("day") < F.lit(days[-1]))), states)
    one_day = daystates.read_pings(spark, path).filter(F.col("day") == F.lit(days[-1]))
    assert scanned_rows(one_day.select("mmsi")) == one_day.count() < table.count()
    merged = daystates.add_days(spark, path, states, days[-1:])
    want = sorted(map(tuple, vessels.vessel_last_seen(table).collect()))
    assert sorted(map(tuple, daystates.merge_states(merged).collect())) == want
    by_states = enc.detect_encounters(table, DEFAULTS, states=merged)
    by_pings = enc.detect_encounters(table, DEFAULTS)
    assert by_states.exceptAll(by_pings).count() == by_pings.exceptAll(by_states).count() == 0 < by_pings.count()
    flags = enc.enrich_silence(spark.createDataFrame([], PAIR_SCHEMA), None, DEFAULTS, merged)
    assert path not in plan(flags)
    # the same day once more replaces its states
    again = daystates.add_days(spark, path, states, [str(days[-1])])
    assert again.count() == daystates.day_states(table).count()


def test_states_of_odd_rows(spark, tmp_path):
    rows = [dict(ts_s=1639362420, mmsi=219000001, lat=55.0, lon=14.0), dict(ts_s=1639362420, mmsi=219000001, lat=55.0, lon=14.1),
            dict(ts_s=1639362420 + 86400, mmsi=219000001, lat=56.0, lon=None), dict(ts_s=None, mmsi=219000001, lat=1.0, lon=1.0),
            dict(ts_s=None, mmsi=219000002, lat=2.0, lon=2.0), dict(ts_s=1639362420, mmsi=None, lat=3.0, lon=3.0)]
    df = pings(spark, rows * 2)
    states = daystates.read_states(spark, daystates.write_states(daystates.day_states(df), str(tmp_path / "s")))
    assert states.count() == 5

    def rows_of(x):
        return sorted(map(tuple, x.collect()), key=str)

    assert rows_of(daystates.merge_states(states)) == rows_of(vessels.vessel_last_seen(df))
    none = daystates.write_states(daystates.day_states(df.limit(0)), str(tmp_path / "none"))
    assert daystates.merge_states(daystates.read_states(spark, none)).count() == 0


def test_summaries_without_a_second_scan(spark, tmp_path):
    raw = derived_pings(spark, SF)
    path = str(tmp_path / "p")
    got = summary_from_write(spark, write_pings(raw, path))
    assert got.collect() == ingest_summary(raw).collect()
    assert "Scan parquet" not in plan(got)
    stages = clean_stages(spark.read.parquet(path), FIXTURE_MID_CODES, DEFAULTS, cut=True)
    brief = summary_from_vessels(stages)
    assert brief.collect() == clean_summary(stages.clean).collect()
    assert stages.spatial_rows == stages.spatial.count()
    funnel = stage_funnel(stages.raw, FIXTURE_MID_CODES, DEFAULTS, stages)
    assert sorted(funnel.collect()) == sorted(stage_funnel(raw, FIXTURE_MID_CODES).collect())
    # the raw table is counted only: none of its columns is read
    assert "ReadSchema: struct<>" in plan(funnel)
    empty = summary_from_write(spark, write_pings(raw.limit(0), str(tmp_path / "none"))).first()
    assert tuple(empty) == (0, 0, None, None)


@pytest.mark.parametrize("minutes", [10, 7, 0, 800])
def test_slotted_trajectories(spark, minutes):
    p = replace(DEFAULTS, trajectory_half_window_min=minutes)
    df = clean_pings(derived_pings(spark, SF), FIXTURE_MID_CODES)
    ranked = ranking.three_rankings(enc.detect_encounters(df, p), p)
    got = trajectory.pair_trajectories(ranked, df, p)
    sides = ranked.select("list", "rank", F.unix_seconds("ts_a").alias("c"), F.explode(F.array("mmsi_a", "mmsi_b")).alias("v"))
    t = F.unix_seconds(df["ts"])
    want = df.join(sides, (F.col("v") == df["mmsi"]) & t.between(F.col("c") - 60 * minutes, F.col("c") + 60 * minutes))
    cols = ("list", "rank", "mmsi", "lat", "lon", "sog")
    rows = sorted(map(str, got.select(*cols, "ts_s").collect()))
    assert rows == sorted(map(str, want.select(*cols, t.alias("ts_s")).collect())) and rows
    slot = trajectory.slot_seconds(p)
    assert 86400 % slot == 0 and (slot >= 120 * minutes or slot == 86400)


def test_slots_hold_windows_not_days(spark):
    # a vessel that reports every 10 s for a day and meets another one at noon
    t0 = 1639353600
    rows = [dict(ts_s=t0 + 10 * i, mmsi=219000001, lat=55.0, lon=14.0 + i * 1e-5) for i in range(8640)]
    rows += [dict(ts_s=t0 + 43200, mmsi=219000002, lat=55.0, lon=14.0432)]
    df = pings(spark, rows)
    ranked = ranking.three_rankings(enc.detect_encounters(df))
    one = ranked.filter("list = 'all'")
    met = trajectory.slot_matches(one, df).count()
    inside = trajectory.pair_trajectories(one, df).count()
    assert inside == 122 and met <= 2.1 * inside


def test_ranks_of_a_long_list(spark):
    # 100,000 ranked pairs, many at the same distance
    n = 100_000
    at = F.timestamp_seconds(F.lit(1639362420) + F.col("id") % 1000)
    pairs = spark.range(n).select(
        (219000000 + F.col("id")).alias("mmsi_a"), (265000000 + F.col("id")).alias("mmsi_b"), at.alias("ts_a"), at.alias("ts_b"),
        *[F.lit(1.0).alias(f"{c}_{x}") for c in ("lat", "lon", "sog") for x in "ab"], F.lit("x").alias("name_a"),
        F.lit("y").alias("name_b"), F.when(F.col("id") % 7 == 0, "Tug").otherwise("Cargo").alias("ship_type_a"),
        F.lit(None).cast("string").alias("ship_type_b"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise((F.xxhash64("id") % 1000).cast("double") / 10 + 150).alias("dist_m"),
        F.lit(False).alias("silenced_a"), F.lit(True).alias("silenced_b"))
    best = ranking.closest_per_pair(pairs)
    order = sorted((r["_d6"], r["ts_a"], r["ts_b"], r["mmsi_a"], r["mmsi_b"], r["ship_type_a"]) for r in best.collect())
    ranked = pairs.select("*", F.lit("all").alias("list"), F.col("mmsi_a").alias("rank"))
    out = ranking.rank_in_all(pairs, ranked)
    p = plan(out)
    assert "SinglePartition" not in p.split("Subquery")[0] and "NestedLoop" not in p
    ops, want = 0, {}
    for i, r in enumerate(order):
        want[r[3]] = (i + 1, ops)
        ops += r[5] in DEFAULTS.operational_types
    assert ops and {r["rank"]: (r["rank_in_all"], r["operational_ahead"]) for r in out.collect()} == want


def test_rank_of_nothing(spark):
    pairs = spark.createDataFrame([], PAIR_SCHEMA + ", silenced_a boolean, silenced_b boolean")
    assert ranking.rank_in_all(pairs, ranking.three_rankings(pairs)).collect() == []
