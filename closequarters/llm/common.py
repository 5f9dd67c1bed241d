"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .tokens import byte_blocks


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Lineage cut: write ``df`` as Parquet under the cluster's shared
    checkpoint folder and continue from the written copy, so that a lost
    executor costs only the tasks of the running stage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id (as text) is divisible by ``folds``."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fold_of(id_col: Column, folds: int = 5) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def training_labels(labels: DataFrame, id_col: str, label_col: str, max_rows: int, folds: int = 5) -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold, chosen by
    a hash of the id: (id, label 0/1, fold).

    Rows without id or with a label other than 0/1 are left out; an id with
    several labels takes the largest, so repeated rows change nothing.  The
    row bound is what makes the result safe to broadcast and to collect.
    """
    lab = F.col(label_col)
    one = (labels.filter(F.col(id_col).isNotNull() & lab.isin(0, 1))
           .groupBy(F.col(id_col).alias("_id")).agg(F.max(lab).cast("int").alias("_label")))
    return (one.withColumn("_fold", fold_of(F.col("_id"), folds)).filter(F.col("_fold") != 0)
            .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package also where the driver found it
    through ``sys.path`` only (a checkout that is not installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in sys.path and root not in parts:
        env["PYTHONPATH"] = os.pathsep.join(parts + [root])


def map_batches(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with the package importable on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_slices(batch, rows: int = 512, text_at: int = 1, size: int = 1 << 40):
    """Slices of a record batch with the texts as Python strings (null: empty),
    so that only one slice of a batch is held as Python objects: at most
    ``rows`` rows, and ``size`` bytes of text unless one text alone has more."""
    for part, _, _ in byte_blocks(batch, text_at, size):
        for i in range(0, part.num_rows, rows):
            some = part.slice(i, rows)
            yield some, [t or "" for t in some.column(text_at).to_pylist()]
