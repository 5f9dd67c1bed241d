"""Sorted hash arrays in the shared folder, memory-mapped by workers.

A store maps 64-bit keys to numbers.  It is cut into shards, each a range of
keys; a shard is one ``.npy`` file with its sorted keys and one per value column,
written by the task that owns the shard (whole file under another name, then
renamed, so a task that runs again writes the same file again).  A worker maps
the files it needs; their pages belong to the file cache, not to the worker, so
memory does not grow with the store.

The shared folder must be a mounted one (a plain path or ``file:``), since only
such files can be mapped.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import map_batches


def shard_count(spark: SparkSession) -> int:
    """As many shards as shuffle partitions, the session's measure of data size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key: a monotone function, so a shard is a range of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def shard_column(key: Column, shards: int) -> Column:
    """``shard_of`` of a long column (keys as signed longs)."""
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 32) * F.lit(shards).cast("long"), 32).cast("int")


def store_folder(spark: SparkSession, name: str) -> str:
    """A new mounted folder for a store, under the shared folder."""
    url = urlparse(shared_dir(spark, name))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped stores need a mounted shared folder, not {url.scheme}:")
    path = unquote(url.path)
    os.makedirs(path, exist_ok=True)
    return path


def write_shard(folder: str, shard: int, **columns: np.ndarray) -> None:
    """Columns of one shard; ``key`` is sorted and without repeats."""
    for name, values in columns.items():
        part = f"{folder}/{uuid.uuid4().hex}.part"
        with open(part, "wb") as f:
            np.save(f, values)
        os.replace(part, f"{folder}/{shard}.{name}.npy")


@dataclass(frozen=True)
class HashArrays:
    """A written store: folder, number of shards and the shards that hold keys."""

    folder: str
    shards: int
    filled: frozenset[int]

    def find(self, keys: np.ndarray, *columns: str) -> list[np.ndarray]:
        """Values of the keys in each column, 0 where a key is missing."""
        wanted, at = np.unique(keys, return_inverse=True)
        out = [np.zeros(len(wanted)) for _ in columns]
        of = shard_of(wanted, self.shards)
        for lo, hi in zip(*_runs(of), strict=True):
            if int(of[lo]) not in self.filled:
                continue
            mapped = open_shard(self.folder, int(of[lo]), ("key", *columns))
            place = np.minimum(np.searchsorted(mapped[0], wanted[lo:hi]), len(mapped[0]) - 1)
            hit = np.flatnonzero(mapped[0][place] == wanted[lo:hi])
            for values, column in zip(out, mapped[1:], strict=True):
                values[lo + hit] = column[place[hit]]
        return [values[at] for values in out]

    def whole(self, **columns: type) -> list[np.ndarray]:
        """Each column of all shards, one shard after the other; only for stores
        of a bounded size.  The types are those of columns without any shard."""
        return [np.concatenate([np.zeros(0, kind), *(np.load(f"{self.folder}/{s}.{c}.npy") for s in sorted(self.filled))])
                for c, kind in columns.items()]


def _runs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.flatnonzero(np.diff(ids)) + 1
    return (np.append(0, cuts), np.append(cuts, len(ids))) if len(ids) else (cuts, cuts)


@lru_cache(maxsize=4096)
def open_shard(folder: str, shard: int, columns: tuple[str, ...]) -> tuple[np.ndarray, ...]:
    return tuple(np.load(f"{folder}/{shard}.{c}.npy", mmap_mode="r") for c in columns)


def write_shards(rows: DataFrame, name: str, build: Callable[..., dict[str, np.ndarray]]) -> HashArrays:
    """A store made shard by shard: ``rows`` has the column shard first, all rows
    of a shard meet in one task, which gives their other columns to ``build``
    and writes the arrays that it returns."""
    spark = rows.sparkSession
    folder, shards = store_folder(spark, name), shard_count(spark)
    dealt = rows.repartitionById(shards, F.col("shard"))

    def run(batches):
        import pyarrow as pa

        held: list[tuple[np.ndarray, ...]] = []
        shard = None

        def done():
            write_shard(folder, shard, **build(*(np.concatenate(c) for c in zip(*held, strict=True))))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], ["shard"])

        for batch in batches:
            of, *columns = (c.to_numpy() for c in batch.columns)
            for lo, hi in zip(*_runs(of), strict=True):
                if held and of[lo] != shard:
                    yield done()
                    held = []
                shard = int(of[lo])
                held.append(tuple(c[lo:hi] for c in columns))
        if held:
            yield done()

    filled = map_batches(dealt, run, "shard int").collect()  # at most one row per shard
    return HashArrays(folder, shards, frozenset(r["shard"] for r in filled))


def write_store(rows: DataFrame, name: str, value: str = "f") -> HashArrays:
    """A store of the columns ``key`` (long, no key twice) and ``value``."""
    shard = shard_column(F.col("key"), shard_count(rows.sparkSession)).alias("shard")

    def build(key, f):
        key = key.view(np.uint64)
        order = np.argsort(key)
        return {"key": key[order], value: f[order]}

    return write_shards(rows.select(shard, "key", F.col(value).cast("long").alias("f")), name, build)
