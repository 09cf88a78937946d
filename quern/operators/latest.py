"""Deduplication and latest-per-key, by aggregates rather than sorts where one row's payload is enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep(df: DataFrame, keys: list[str], order: list[Column], last: bool = True) -> DataFrame:
    """One row per key, the last (or first) in ``order``; rows with a null key are left out.

    ``max_by`` combines on the map side, so a hot key is one row per task in the shuffle.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest) if rest else F.lit(1), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def keep_last(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return keep(df, keys, list(order))


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return keep(df, keys, list(order), last=False)


def todo(df: DataFrame, done: DataFrame, keys: list[str], capped: DataFrame | None = None) -> DataFrame:
    """What is left to do: rows without a key among the done ones or those given up on."""
    out = df.join(done.select(*keys).distinct(), keys, "left_anti")
    return out if capped is None else out.join(capped.select(*keys).distinct(), keys, "left_anti")


def given_up(failures: DataFrame, keys: list[str], attempts: int) -> DataFrame:
    """Keys with as many failures as attempts allowed."""
    return failures.groupBy(*keys).agg(F.count("*").alias("n_failures")).where(F.col("n_failures") >= attempts)


def attempt_numbers(failures: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return failures.withColumn("attempt", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def union_preferring(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """``first``, and the rows of ``second`` whose keys it has not."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)
