"""Chunks by quantiles, dealt buckets and late attributes: same rows, bounded tasks, one exchange of the pings."""
from __future__ import annotations

import math
import random
import re
from collections import Counter
from dataclasses import replace

import pytest
from ping_rows import pings
from pyspark.sql import functions as F

from closequarters.operators import encounters as enc
from closequarters.operators import jumps
from closequarters.params import DEFAULTS, Params
from closequarters.sources import derived_pings, write_pings

T0 = 1639362420
SF = "/root/testdata/sf0.001"


def formatted(df) -> str:
    """The initial physical plan, node by node."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(df) -> list[tuple[str, str]]:
    """Input columns and partitioning expression of every exchange."""
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (.*)\n", formatted(df))
    return [(cols, args) for cols, args in found if "hashpartitioning" in args]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def table(spark, tmp_path):
    write_pings(derived_pings(spark, SF), str(tmp_path / "p"))
    return spark.read.parquet(str(tmp_path / "p"))


def by_track(rows):
    out = Counter()
    for r in rows:
        out[tuple(r)] += 1
    return out


def uneven_tracks():
    """One vessel with two thirds of the pings, most of them within one hour;
    reports without id and without time, and copies."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        t = T0 + (rng.randint(0, 3600) if i % 10 else rng.randint(0, 30 * 86400))
        rows.append(dict(ts_s=t, mmsi=219000001, lat=55 + rng.random() / 50, lon=14 + rng.random() / 50, sog=float(i % 7)))
    for i in range(450):
        rows.append(dict(ts_s=T0 + 97 * i if i % 9 else None, mmsi=rng.choice([None, 219000002, 219000003, 219000004]),
                         lat=55 + rng.random() / 20, lon=14.0, sog=1.0))
    return rows + rows[::40]


@pytest.mark.parametrize("runs", [False, True])
def test_quantile_chunks_equal_one_window(spark, runs):
    df = pings(spark, uneven_tracks()).repartition(5)
    whole = replace(DEFAULTS, collapse_track_copies=runs, track_chunk_pings=10**9)
    small = replace(whole, track_chunk_pings=20)
    coarse = replace(whole, track_chunk_pings=20, track_chunk_parts=4)
    want = by_track(jumps.gps_jump_filter(df, whole).collect())
    assert sum(want.values()) < df.count()
    assert want == by_track(jumps.gps_jump_filter(df, small).collect()) == by_track(jumps.gps_jump_filter(df, coarse).collect())
    if not runs:
        want = by_track(jumps.implied_speeds(df, whole).collect())
        assert want == by_track(jumps.implied_speeds(df, small).collect())


def test_chunks_are_bounded_by_pings_not_by_time(spark):
    df = pings(spark, uneven_tracks()).filter("ts is not null")
    sizes = jumps.with_chunks(df, replace(DEFAULTS, track_chunk_pings=20)).groupBy("_track", "_chunk").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 25  # some pings share a second
    fixed = jumps.with_chunks(df, replace(DEFAULTS, track_chunk_s=6 * 3600)).groupBy("_track", "_chunk").count()
    assert fixed.agg({"count": "max"}).first()[0] > 800


def test_no_more_bounds_than_the_total(spark):
    df = pings(spark, uneven_tracks())
    p = replace(DEFAULTS, track_chunk_pings=1, track_chunks_total=30)
    got = jumps.chunk_bounds(df, p).select(F.sum(F.size("_bounds"))).first()[0]
    assert 10 < got <= 30
    assert jumps.chunk_bounds(df).count() == 0  # no track is longer than a chunk


def test_pings_are_exchanged_once(spark, table, no_broadcast):
    for df in (jumps.gps_jump_filter(table), jumps.implied_speeds(table, Params(track_chunk_pings=5))):
        whole = [args for cols, args in exchanges(df) if "lon#" in cols and "name#" in cols]
        assert len(whole) == 1 and "_track" in whole[0] and "_chunk" in whole[0]
        assert "SortMergeJoin" in formatted(df)  # the edge table is not broadcast here
    kept = jumps.gps_jump_filter(pings(spark, [dict(ts_s=T0 + 60 * i, mmsi=None, lat=55.0, lon=14.0) for i in range(4)]))
    assert kept.count() == 4


def test_attributes_stay_below_the_expansion(spark, table, no_broadcast):
    plan = formatted(enc.encounter_pairs(table))
    grown = re.findall(r"\(\d+\) Generate\nInput \[\d+\]: \[(.*)\]", plan)
    assert any("lat_cell" in g for g in grown)
    assert not any(c in g for g in grown for c in ("name#", "ship_type#", "sog#") if "lat_cell" in g)
    by_cell = [cols for cols, args in exchanges(enc.encounter_pairs(table)) if "_key" in args]
    assert len(by_cell) == 2 and not any("name#" in c or "ship_type#" in c or "sog" in c for c in by_cell)


def harbour(n, seed=3):
    """Half of the pings in one minute and one cell, copies among them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 2 == 0
        rows.append(dict(ts_s=T0 + rng.randint(0, 59) + (0 if hot else 60 * rng.randint(0, 9)), mmsi=219000001 + rng.randint(0, 9),
                         lat=55.0 + rng.random() * (0.0005 if hot else 0.01), lon=14.0 + rng.random() * (0.0005 if hot else 0.01),
                         sog=5.0 + i % 3, name=rng.choice(["A", "B", None]), ship_type=rng.choice(["Cargo", "Tug", None])))
    return rows + rows[::15]


def brute_pairs(rows):
    def metres(a, b):
        la, lb = math.radians(a["lat"]), math.radians(b["lat"])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b["lon"] - a["lon"]) / 2) ** 2
        return 2 * DEFAULTS.earth_radius_nm * math.asin(math.sqrt(h)) * 1852.0

    out = Counter()
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            x, y = sorted((a, b), key=lambda r: r["mmsi"])
            if x["mmsi"] != y["mmsi"] and x["ts_s"] // 60 == y["ts_s"] // 60 and metres(x, y) < 100:
                out[tuple((r["mmsi"], r["ts_s"], r["lat"], r["lon"], r["sog"], r["name"] or f"MMSI {r['mmsi']}", r["ship_type"])
                          for r in (x, y))] += 1
    return out


@pytest.mark.parametrize("p", [DEFAULTS, replace(DEFAULTS, cell_pings=1), replace(DEFAULTS, cell_pings=7, cell_keys=3),
                               replace(DEFAULTS, cell_pings=5, dense_cells=1), replace(DEFAULTS, collapse_copies=False)])
def test_dealt_buckets_equal_brute_force(spark, p):
    rows = harbour(240)
    out = enc.encounter_pairs(pings(spark, rows).repartition(4), p)
    got = Counter()
    for r in out.collect():
        got[tuple((r[f"mmsi_{s}"], int(r[f"ts_{s}"].timestamp()), r[f"lat_{s}"], r[f"lon_{s}"], r[f"sog_{s}"], r[f"name_{s}"],
                   r[f"ship_type_{s}"]) for s in "ab")] += 1
    assert got == brute_pairs(rows) and sum(got.values()) > 2000


def test_a_bucket_with_half_of_the_pings_has_many_keys(spark):
    df = enc.bucket_keys(pings(spark, harbour(400)))
    dense = enc.dense_cells(df, replace(DEFAULTS, cell_pings=20)).collect()
    top = max(Counter((r["time_bucket"], r["lat_cell"], r["lon_cell"]) for r in df.collect()).values())
    assert max(r["_keys"] for r in dense) == math.ceil(top / 20) > 3
    assert enc.dense_cells(df).count() == 0 and enc.dense_cells(df.limit(0)).count() == 0


def test_copies_expand_in_blocks(spark):
    pairs = spark.createDataFrame([(1, 1), (2, 7), (3, 20), (4, 16)], "mmsi_a long, n_copies long")
    for block in (4, 1 << 16):
        out = enc.expand_copies(pairs, block)
        assert sorted((r["mmsi_a"], r["count"]) for r in out.groupBy("mmsi_a").count().collect()) == [(1, 1), (2, 7), (3, 20), (4, 16)]
    huge = spark.createDataFrame([(1, 5 * 2**31)], "mmsi_a long, n_copies long")
    assert enc.expand_copies(huge, 2**30).schema.names == ["mmsi_a"]
