"""Sinks: day-partitioned ping Parquet and JSON-lines encounter lists."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.curve import curve_key
from ..functions.timecols import epoch_s, iso_millis


LAYOUTS = ("track", "space")


def write_pings(df: DataFrame, path: str, mode: str = "overwrite",
                max_records_per_file: int = 5_000_000, layout: str = "track") -> dict:
    """Day-partitioned Parquet in one pass over the input.

    ``layout`` orders the rows inside a file: "track" by (mmsi, ts) for vessel
    and time lookups, "space" along a space-filling curve of the position, so
    that a row group covers a small area and a region filter (F1, F2) reads only
    the row groups that touch its box.  The rows are the same.

    ``rebalance`` on ``day`` shuffles each day's rows together and lets AQE
    split an oversized day into advisory-size partitions and merge small
    ones, so each task writes one day directory with evenly sized files (a
    range shuffle would read the whole input twice to sample bounds - costly
    when the input is raw CSV).  Sorting inside the task makes the Parquet
    row-group statistics on mmsi/ts skip data for vessel/time lookups;
    ``maxRecordsPerFile`` bounds file size.

    Returns what was written as observed during the write, ``rows`` and ``days``
    (sorted; rows without day are not listed), so that a summary needs no scan
    afterwards.  The observation sits behind the shuffle, in the stage that
    writes: a task run again by a lost executor is counted once."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    order = ["mmsi", "ts"] if layout == "track" else [curve_key(), "mmsi", "ts"]
    seen = Observation()
    (df.hint("rebalance", "day")
       .sortWithinPartitions("day", *order)
       .observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("day").alias("days"))
       .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("day").parquet(path))
    return {"rows": seen.get["rows"], "days": sorted(seen.get["days"])}


def pairs_for_json(df: DataFrame) -> DataFrame:
    """Timestamps as ISO strings with milliseconds and no zone (UTC)."""
    out = df
    for c in ("ts_a", "ts_b"):
        if c in df.columns:
            out = out.withColumn(c, iso_millis(epoch_s(c)))
    return out


def write_pairs_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A ranked list as JSON records (JSON Lines) in one sorted file.

    Only ranked frames (top-N lists, with a ``rank``) are taken, since one file
    is written by one task; the rows are shuffled there, so the stages before
    keep their parallelism."""
    if "rank" not in df.columns:
        raise ValueError("write_pairs_json takes ranked lists; write other pair tables as Parquet")
    order = [c for c in ("list", "rank") if c in df.columns]
    pairs_for_json(df).repartition(1).sortWithinPartitions(*order).write.mode(mode).json(path)


def raw_from_pings(pings: DataFrame) -> DataFrame:
    """Working pings back to the 26-column raw export layout (timestamps as
    ``dd/MM/yyyy HH:mm:ss`` UTC; columns the working table lacks are empty)."""
    from ..functions.timecols import SECONDS_PER_DAY, utc_day
    from .schema import PING_RENAMES, RAW_COLUMNS

    t = epoch_s("ts")
    sod = F.pmod(t, F.lit(SECONDS_PER_DAY))
    stamp = F.concat(F.date_format(utc_day(t), "dd/MM/yyyy"),
                     F.format_string(" %02d:%02d:%02d", F.floor(sod / 3600), F.floor(F.pmod(sod, F.lit(3600)) / 60),
                                     F.pmod(sod, F.lit(60))))
    src = {raw: work for raw, work in PING_RENAMES}
    cols = []
    for name, dtype in RAW_COLUMNS:
        if name == "# Timestamp":
            cols.append(stamp.alias(name))
        elif name in src:
            cols.append(F.col(src[name]).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return pings.select(*cols)


def write_pings_csv(pings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw-layout CSV export with a header line (the input format of S1)."""
    raw_from_pings(pings).write.mode(mode).option("header", True).csv(path)
