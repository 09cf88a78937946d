"""Streams of feedback: new files picked up, late answers overwriting earlier ones, windows and sessions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.operators.latest import keep_last

#: One file per event, as the reviewing page writes them.
SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("reviewer", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("generator", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
KEY = ["reviewer", "item_id", "generator"]


def read_feedback(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """The folder as a stream; a bounded number of files a trigger is the back-pressure."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("verdict").isin("accept", "reject") & F.col("item_id").isNotNull())


def append_batches(stream: DataFrame, table: str, checkpoint: str, seconds: int | None = None):
    """Appends each micro-batch, deduplicated inside itself, with its number; ``latest`` reads the table.

    A batch that is run again after a failure writes the same rows, which
    ``latest`` folds together: exactly once in effect.
    """

    def write(batch: DataFrame, number: int) -> None:
        keep_last(valid(batch), KEY, F.col("ts"), F.col("event_id")).withColumn("batch", F.lit(number)).write.mode("append").parquet(table)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def latest(spark: SparkSession, table: str) -> DataFrame:
    """The answer that holds for each reviewer, item and generator."""
    return keep_last(spark.read.parquet(table), KEY, F.col("ts"), F.col("event_id"), F.col("batch")).drop("batch")


def windowed_counts(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Verdicts per window; rows later than ``late`` are left to the batch view."""
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", width), "verdict").agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), "verdict", "n")


def sessions(stream: DataFrame, gap: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of reviewers, closed by an idle gap."""
    s = stream.withWatermark("ts", late).groupBy("reviewer", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return s.select("reviewer", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def throttled(stream: DataFrame, least_seconds: int = 60) -> DataFrame:
    """Per reviewer, events at least so long after the last one that was let through: state of one time a reviewer."""
    out = T.StructType([T.StructField("reviewer", T.StringType()), T.StructField("event_id", T.LongType())])

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = []
        for pdf in batches:
            for r in pdf.sort_values(["ts", "event_id"]).itertuples():
                at = r.ts.timestamp()
                if last is None or at - last >= least_seconds:
                    last = at
                    rows.append((key[0], r.event_id))
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(rows, columns=["reviewer", "event_id"])

    return stream.groupBy("reviewer").applyInPandasWithState(run, out, T.StructType([T.StructField("last", T.DoubleType())]), "append", GroupStateTimeout.NoTimeout)
