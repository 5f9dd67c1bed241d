"""Space-filling-curve layout and Windows-1252 files."""
from __future__ import annotations

import pytest
from ping_rows import pings
from pyspark.sql import functions as F

from closequarters.functions.curve import curve_key
from closequarters.operators import filters as flt
from closequarters.params import DEFAULTS
from closequarters.sources import derived_pings, read_mid_codes, read_pings, write_pings
from closequarters.sources.readers import read_cp1252_csv

SF = "/root/testdata/sf0.01"


def scanned_rows(df) -> int:
    """Rows that the Parquet scan hands on after skipping row groups."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_curve_key_interleaves_bits(spark):
    rows = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (55.2, 14.2), (123.0, -500.0), (None, 1.0)]

    def want(lat, lon):
        if lat is None:
            return None
        y, x = (max(0, min(65535, int((v - lo) / (2 * -lo) * 65536 // 1))) for v, lo in ((lat, -90.0), (lon, -180.0)))
        return sum((y >> b & 1) << (2 * b + 1) | (x >> b & 1) << (2 * b) for b in range(16))

    out = spark.createDataFrame(rows, "lat double, lon double").select("lat", "lon", curve_key().alias("k")).collect()
    assert [r["k"] for r in out] == [want(r["lat"], r["lon"]) for r in out]


def test_region_box_skips_row_groups(spark, tmp_path):
    # one file a day, many small row groups; half of the pings lie far from the region
    near = derived_pings(spark, SF)
    far = near.withColumn("lat", F.col("lat") - 40).withColumn("lon", F.col("lon") + 30)
    both = near.unionByName(far).withColumn("day", F.lit("2021-12-01").cast("date"))
    spark.conf.set("parquet.block.size", str(64 * 1024))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 * 1024))
    try:
        for layout in ("track", "space"):
            write_pings(both, str(tmp_path / layout), layout=layout)
    finally:
        spark.conf.unset("parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    n = both.count()
    found = {x: flt.bbox_filter(read_pings(spark, str(tmp_path / x)), DEFAULTS) for x in ("track", "space")}
    rows = {x: scanned_rows(df) for x, df in found.items()}
    assert rows["space"] < 0.75 * n and rows["space"] < 0.8 * rows["track"]
    assert found["track"].exceptAll(found["space"]).count() == found["space"].exceptAll(found["track"]).count() == 0
    assert found["space"].count() == flt.bbox_filter(both, DEFAULTS).count() > 0


def test_layout_is_checked(spark, tmp_path):
    df = pings(spark, [dict(ts_s=1639362420, mmsi=219000001, lat=None, lon=14.0)])
    write_pings(df, str(tmp_path / "a"), layout="space")
    assert read_pings(spark, str(tmp_path / "a")).count() == 1
    with pytest.raises(ValueError, match="layout"):
        write_pings(df, str(tmp_path / "b"), layout="other")


def test_windows_1252_bytes_are_decoded(spark, tmp_path):
    lines = "Digit,Allocated to,Price \u20ac\n211,Fr\u0153 \u201cx\u201d,5\n 219 ,\u0160koda \u2013 \u0178,\n,blank,7\nx\u20ac,bad,\n"
    (tmp_path / "mid.csv").write_bytes(lines.encode("cp1252") + b"265,\x81\xe9\xff,1\n")
    df = read_cp1252_csv(spark, str(tmp_path / "mid.csv"))
    assert df.columns == ["Digit", "Allocated to", "Price \u20ac"]
    got = [r["Allocated to"] for r in df.collect()]
    assert got == ["Fr\u0153 \u201cx\u201d", "\u0160koda \u2013 \u0178", "blank", "bad", "\x81\xe9\xff"]
    assert sorted(r["mid"] for r in read_mid_codes(spark, str(tmp_path / "mid.csv")).collect()) == [211, 219, 265]
