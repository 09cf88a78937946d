"""Mutable state as append-only tables: upserts by sequence, tombstones, migrations, guards, exports."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.latest import keep_last
from quern.sources.fs import Folder


class Table:
    """An append-only parquet table with a primary key; the largest ``seq`` of a key holds."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]) -> None:
        self.spark, self.path, self.keys = spark, path, keys

    def append(self, df: DataFrame, seq: int, deleted: bool = False) -> None:
        df.withColumn("seq", F.lit(seq).cast("long")).withColumn("tombstone", F.lit(deleted)).write.mode("append").parquet(self.path)

    def delete(self, keys: DataFrame, seq: int) -> None:
        """Tombstones; rows below them no longer show."""
        self.append(keys.select(*self.keys), seq, deleted=True)

    def read(self) -> DataFrame:
        """The latest row of each key that is not deleted; columns of older files come back as nulls."""
        rows = self.spark.read.option("mergeSchema", True).parquet(self.path)
        return keep_last(rows, self.keys, F.col("seq")).where("not tombstone").drop("tombstone")

    def next_sequence(self) -> int:
        """One more than the largest sequence so far, taken by creating its file: of several that ask, each gets its own."""
        folder = Folder(self.spark)
        taken = [int(p.rpartition("/")[2]) for p, _, _ in folder.list(f"{self.path}_sequence") if p.rpartition("/")[2].isdigit()]
        last = max(taken, default=0)
        if folder.exists(self.path):
            last = max(last, int(self.spark.read.parquet(self.path).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]))
        while not folder.create(f"{self.path}_sequence/{last + 1}"):
            last += 1
        return last + 1


class Cached:
    """A table read once per version of its files: a read after any write, own or other, sees it."""

    def __init__(self, table: Table) -> None:
        self.table, self._version, self._rows = table, None, None

    def read(self) -> DataFrame:
        version = Folder(self.table.spark).list(self.table.path)
        if version != self._version:
            self.close()
            # cached by executors that may be lost; the plan below rebuilds what goes with them
            self._rows, self._version = self.table.read().cache(), version
        return self._rows

    def close(self) -> None:
        if self._rows is not None:
            self._rows.unpersist()
            self._rows = None


def migrate(old: DataFrame, new: DataFrame, **backfill: Column) -> DataFrame:
    """Two generations of a table in one, missing columns filled."""
    out = old.unionByName(new, allowMissingColumns=True)
    for name, value in backfill.items():
        out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out


def guard(spark: SparkSession, path: str, current: dict, guarded: set[str]) -> None:
    """Writes a run's settings, or refuses to resume with a guarded one changed; new keys are allowed."""
    folder = Folder(spark)
    if folder.exists(path):
        old = json.loads(folder.read_text(path))
        changed = sorted(k for k in guarded if k in old and old[k] != current.get(k))
        if changed:
            raise ValueError(f"settings changed since the run began: {changed}")
        current = old | current
    folder.write_text(path, json.dumps(current, indent=1, sort_keys=True))


def heartbeat(spark: SparkSession, path: str, **values: object) -> None:
    """Merges values into a metadata file."""
    folder = Folder(spark)
    folder.write_text(path, json.dumps((json.loads(folder.read_text(path)) if folder.exists(path) else {}) | values))


class Backup:
    """Copies what is new or changed in a folder, once it has been still for ``idle`` seconds and ``least`` after the last copy."""

    def __init__(self, spark: SparkSession, source: str, target: str, idle: float = 600.0, least: float = 60.0, clock: Callable[[], float] = time.time) -> None:
        self.folder, self.source, self.target = Folder(spark), source, target
        self.idle, self.least, self.clock = idle, least, clock
        self._copied: dict[str, tuple[int, int]] = {}
        self._last = float("-inf")

    def run(self, critical: bool = False) -> int:
        """Files copied; a critical change does not wait for the folder to be still."""
        files = self.folder.list(self.source)
        changed = [(p, size, at) for p, size, at in files if self._copied.get(p) != (size, at)]
        now = self.clock()
        still = now - max((at / 1000 for _, _, at in changed), default=0) >= self.idle
        if not changed or now - self._last < self.least or not (still or critical):
            return 0
        base = self.folder.qualified(self.source).rstrip("/")
        for p, size, at in changed:
            self.folder.copy(p, self.target.rstrip("/") + p.removeprefix(base))
            self._copied[p] = (size, at)
        self._last = now
        return len(changed)


def export_dataset(df: DataFrame, path: str, key: str, *order: Column, partition: str | None = None, rows_per_file: int = 1_000_000) -> None:
    """Deduplicates over the whole table and writes typed snappy parquet; writing again replaces it."""
    out = keep_last(df, [key], *order).write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
    (out.partitionBy(partition) if partition else out).parquet(path)


def write_split(good: DataFrame, bad: DataFrame, path: str, most_bad: int = 100) -> int:
    """Good rows to ``path``, bad ones to a side folder; fails beyond ``most_bad`` of these."""
    bad.write.mode("append").json(f"{path}_failures")
    n = bad.limit(most_bad + 1).count()
    if n > most_bad:
        raise RuntimeError(f"more than {most_bad} rows could not be written")
    good.write.mode("append").parquet(path)
    return n


def write_cards(cards: DataFrame, path: str) -> None:
    """The cards payload as line-delimited JSON."""
    cards.write.mode("overwrite").json(path)


def progress(tasks: DataFrame) -> DataFrame:
    """Tasks done, documents done and failed, and the share of tasks, from (done, n_docs, n_failed) rows."""
    return tasks.agg(F.count("*").alias("n_tasks"), F.count_if("done").alias("n_done"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_failed"), F.lit(0)).alias("n_failed"), F.try_divide(F.lit(100.0) * F.count_if("done"), F.count("*")).alias("pct"))
