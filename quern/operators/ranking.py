"""Ranks within groups of any size: no task sorts more than one bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_rank(df: DataFrame, keys: list[str], bucket: Column, order: list[Column | str], name: str = "place") -> DataFrame:
    """``row_number`` per ``keys`` in order of ``bucket`` and then ``order``, which must agree with the buckets.

    The buckets of a group are counted, the running counts (one row per bucket)
    meet the rows again, and rows are ranked inside their bucket: a group that
    holds a third of all rows is spread over its buckets.
    """
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "_bucket"])], F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "_bucket"])]
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    joined = rows.join(before, on).withColumn(name, (F.col("_before") + inside).cast("bigint"))
    return joined.select(*df.columns, name)
