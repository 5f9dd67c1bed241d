"""Sources: raw CSV exports, the day-partitioned ping table, the MID list."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s, utc_day
from .schema import PING_RENAMES, RAW_SCHEMA, RAW_TIMESTAMP_FORMAT


def read_pings_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw 26-column CSV export(s): header line skipped, columns bound by position,
    unparsable cells become null and the row stays (PERMISSIVE)."""
    return (spark.read.schema(RAW_SCHEMA)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("nullValue", "")
            .option("enforceSchema", True)
            .csv(path if isinstance(path, str) else list(path)))


def parse_utc_timestamp(col, fmt: str = RAW_TIMESTAMP_FORMAT):
    """Parse a wall-clock string as UTC whatever the session zone; bad input -> null."""
    return F.try_to_timestamp(F.concat(col, F.lit(" +0000")), F.lit(fmt + " xx"))


def normalize_pings(raw: DataFrame) -> DataFrame:
    """Raw export -> the 13-column working ping table (ts parsed as UTC, ``day`` derived)."""
    ts = parse_utc_timestamp(F.col("`# Timestamp`"))
    return raw.select(ts.alias("ts"), *[F.col(f"`{src}`").alias(dst) for src, dst in PING_RENAMES],
                      utc_day(epoch_s(ts)).alias("day"))


def read_pings(spark: SparkSession, path: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Day-partitioned ping Parquet; ``days=(first, last)`` prunes partitions."""
    df = spark.read.parquet(path)
    if days is not None:
        df = df.filter(F.col("day").between(F.to_date(F.lit(days[0])), F.to_date(F.lit(days[1]))))
    return df


def _cp1252_pairs() -> tuple[str, str]:
    """The characters that ISO-8859-1 and Windows-1252 give to the same bytes
    (0x80-0x9F; five of them mean nothing in Windows-1252 and stay)."""
    both = [(chr(b), bytes([b]).decode("cp1252", errors="ignore")) for b in range(0x80, 0xA0)]
    return "".join(a for a, b in both if b), "".join(b for _, b in both if b)


def read_cp1252_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV file in Windows-1252, every column as text.  Spark's charset
    list lacks that encoding, so the bytes are read as ISO-8859-1 and the
    characters that differ are translated, in values and column names."""
    raw = spark.read.option("header", True).option("encoding", "iso-8859-1").csv(path)
    latin, western = _cp1252_pairs()
    names = str.maketrans(latin, western)
    return raw.select(*[F.translate(F.col(f"`{c}`"), latin, western).alias(c.translate(names)) for c in raw.columns])


def read_mid_codes(spark: SparkSession, path: str) -> DataFrame:
    """Country-prefix list: CSV with a ``Digit`` column, Windows-1252 encoded."""
    return (read_cp1252_csv(spark, path)
            .select(F.try_to_number(F.trim("Digit"), F.lit("999999999")).cast("int").alias("mid"))
            .filter(F.col("mid").isNotNull())
            .distinct())
