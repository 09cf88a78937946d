"""Structured Streaming over the events table, each with the batch SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.registry import Catalogue
from quern.session import scratch
from quern.streaming import feedback as S

query = Catalogue()
_VERDICT = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'accept' WHEN event_type = 'error' THEN 'reject' END"


def _stream(spark, sf_dir) -> DataFrame:
    """The events as a stream of feedback: one micro-batch per trigger's files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir)
    return rows.select("event_id", F.col("user_id").cast("string").alias("reviewer"), (F.col("event_id") % 200).cast("string").alias("item_id"), F.lit("g").alias("generator"), F.expr(_VERDICT).alias("verdict"), F.col("ts").cast("timestamp").alias("ts"))


@query(
    f"""SELECT reviewer, item_id, generator, verdict, event_id FROM (SELECT user_id::varchar AS reviewer, (event_id % 200)::varchar AS item_id, 'g' AS generator, {_VERDICT} AS verdict, event_id,
    row_number() OVER (PARTITION BY user_id, event_id % 200 ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE {_VERDICT} IS NOT NULL) WHERE rn = 1"""
)
def feedback_stream(spark, sf_dir):
    """Feedback appended by micro-batches; the latest answer per reviewer, item and generator holds."""
    table = scratch(spark, "feedback")
    S.append_batches(_stream(spark, sf_dir), table, scratch(spark, "offsets")).awaitTermination()
    return S.latest(spark, table).select("reviewer", "item_id", "generator", "verdict", "event_id")


def _finished(df: DataFrame, name: str) -> DataFrame:
    """Runs an aggregating stream over what is there and reads its last full result."""
    spark = df.sparkSession
    table = scratch(spark, name)
    write = lambda batch, number: batch.write.mode("overwrite").parquet(table)
    df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", scratch(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(table)


@query(f"SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, {_VERDICT} AS verdict, count(*) AS n FROM events WHERE {_VERDICT} IS NOT NULL GROUP BY 1, 2")
def windowed_stream(spark, sf_dir):
    """Verdicts per hour, under a watermark."""
    out = _finished(S.windowed_counts(S.valid(_stream(spark, sf_dir))), "windows")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "verdict", "n")


@query(
    "WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events WHERE event_type IN ('purchase', 'signup', 'error') WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s) SELECT user_id::varchar AS reviewer, min(ts) AS start, count(*) AS n FROM k GROUP BY user_id, k"
)
def session_stream(spark, sf_dir):
    """Sessions of reviewers, closed by half an hour without an answer."""
    out = _finished(S.sessions(S.valid(_stream(spark, sf_dir)), gap="30 minutes"), "sessions")
    return out.select("reviewer", F.col("start").cast("timestamp_ntz").alias("start"), "n")


QUERIES, SQL = query.queries, query.sql
