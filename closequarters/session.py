"""Session helpers for tests, the bench and local runs.

Library operators never create or configure a session; these helpers only
fill in settings that are unset (a cluster's own configuration wins).
"""
from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # PySpark 4 records the Python call site of every Column operation for
    # error messages; each record is several JVM round trips, which makes
    # building a plan slower than running it on small data.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "closequarters") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("CQ_DRIVER_MEMORY", "8g"))
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder of this application under the cluster's ``spark.checkpoint.dir``.

    The setting is read from the session.  Only a ``local[...]`` master, whose
    executors are threads of the driver, may leave it unset: then a folder of
    the driver's machine is set and removed when the process ends.  Any other
    master without a shared folder is an error, since executors would write
    where nobody else can read.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import shutil
        import tempfile

        base = tempfile.mkdtemp(prefix="cq-checkpoints-")
        sc.setCheckpointDir(base)
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{str(base).rstrip('/')}/closequarters/{sc.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory in the application's shared folder."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_shared(spark: SparkSession) -> None:
    """Remove every intermediate table of this application.  Call it when the
    results that were built on them have been written or collected."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_base(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
