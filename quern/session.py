"""Session settings and lineage cuts that hold on a cluster."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings the engine relies on; a cluster's own values win where they are set.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for local work and tests."""
    builder = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in {**DEFAULTS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or in local mode, where it may be unset, one of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


#: Bytes up to which a table that the driver made is broadcast.
BROADCAST_BYTES = 8 << 20


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of the driver's rows, with a broadcast hint if their measured size allows one; else for a shuffle join."""
    size = sum(16 + sum(2 * len(x) + 8 if isinstance(x, str) else 8 for x in r) for r in rows)
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


_SCRATCH: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed by ``release`` or when the driver ends."""
    if not _SCRATCH:
        atexit.register(release, spark)
    path = f"{shared_dir(spark)}/quern_{name}_{os.getpid()}_{uuid.uuid4().hex[:12]}"
    _SCRATCH.add(path)
    return path


def release(spark: SparkSession) -> None:
    """Removes all tables written so far; a long session calls it once it has no more use for the results that read them."""
    while _SCRATCH:
        _remove(spark, _SCRATCH.pop())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: what comes after survives lost executors without repeating
    what came before, and reads only the columns it needs.
    """
    path = scratch(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone already
        pass


#: Bytes of a scan up to which it may be spread by a shuffle.
SPREAD_BYTES = 256 << 20


def spread(scan: DataFrame) -> DataFrame:
    """A small scan (few files or row groups, ``SPREAD_BYTES`` at most) over all cores, ahead of work per row in Python; other scans as they are.

    Only for plans without a shuffle: counting the splits of one would run it.
    """
    spark = scan.sparkSession
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = spark.sparkContext.defaultParallelism
    return scan.repartition(cores) if size <= SPREAD_BYTES and scan.rdd.getNumPartitions() < cores else scan
