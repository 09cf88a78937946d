"""Loaders of the project's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_key(col: Column | str) -> Column:
    """A key without case and surrounding white space."""
    return F.lower(F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"^[\s 　]+|[\s 　]+$", ""))


def item_versions(items: DataFrame, *columns: str) -> DataFrame:
    """One row per (item_id, iteration), from its earliest delivery.

    A version may be delivered more than once with the same content; the
    aggregate is partial on the map side, so a repeated version costs no skew.
    """
    payload = F.struct(*[F.col(c) for c in columns])
    return (
        items.groupBy("item_id", "iteration")
        .agg(F.min_by(payload, F.coalesce(F.col("created_at"), F.lit("9999-01-01").cast("timestamp_ntz"))).alias("_p"))
        .select("item_id", "iteration", *[F.col("_p")[c].alias(c) for c in columns])
    )
