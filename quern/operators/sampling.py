"""Seeded sampling by hash order: the same rows at every run, on any partitioning.

Rank per group uses ``row_number``, which Spark cuts to the first rows of each
group before the shuffle, so a hot group sends only its candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.ids import seeded


def first_per_group(df: DataFrame, group: str, n: int, *order: Column | str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def reservoir(df: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """A uniform sample of ``n`` rows."""
    return df.orderBy(seeded(seed, *map(F.col, keys)), *keys).limit(n)


def balanced(df: DataFrame, group: str, n: int, groups: int, seed: str, *keys: str) -> DataFrame:
    """ceil(n / groups) of each group, then ``n`` of these in hash order."""
    share = -(-n // groups)
    some = first_per_group(df.withColumn("_h", seeded(seed, *map(F.col, keys))), group, share, "_h", *keys)
    return some.orderBy("_h", *keys).limit(n).drop("_h")


def per_shard_reservoir(df: DataFrame, shard: str, n: int, shards: int, seed: str, *keys: str, strict: bool = False) -> DataFrame:
    """A pool of ceil(n / shards) + 4 rows of each shard, then ``n`` of the pool; if ``strict``, a pool that is too small fails when it is read."""
    share = -(-n // shards) + 4
    pool = first_per_group(df.withColumn("_h", seeded(seed, F.col(shard), *map(F.col, keys))), shard, share, "_h", *keys)
    if not strict:
        return pool.orderBy(seeded(seed, *map(F.col, keys)), *keys).limit(n).drop("_h")
    enough = pool.agg(F.count("*").alias("_size")).select(F.assert_true(F.col("_size") >= n, F.concat(F.lit("the pool has only "), F.col("_size"), F.lit(f" rows of {n}"))).alias("_ok"))
    checked = pool.join(F.broadcast(enough)).where("_ok is null")  # one row
    return checked.orderBy(seeded(seed, *map(F.col, keys)), *keys).limit(n).drop("_h", "_ok")


def round_robin(df: DataFrame, bucket: str, n: int, seed: str, *keys: str) -> DataFrame:
    """One of each bucket in turn until ``n``."""
    h = seeded(seed, *map(F.col, keys))
    rank = F.row_number().over(Window.partitionBy(bucket).orderBy(h, *keys))
    # at most n rows of a bucket can be chosen
    return df.withColumn("_turn", rank).where(F.col("_turn") <= n).orderBy("_turn", bucket).limit(n).drop("_turn")


def gold_and_fresh(gold: DataFrame, fresh: DataFrame, total: int, n_gold: int, seed: str, key: str) -> DataFrame:
    """Up to ``n_gold`` gold rows, filled with others to ``total``."""
    g = reservoir(gold, n_gold, seed, key).withColumn("_g", F.lit(0))
    f = reservoir(fresh.join(g.select(key), key, "left_anti"), total, seed, key).withColumn("_g", F.lit(1))
    return g.unionByName(f).orderBy("_g", seeded(seed, F.col(key)), key).limit(total).drop("_g")


def top_up(df: DataFrame, flag: Column, n: int, *order: Column | str) -> DataFrame:
    """Half of ``n`` where ``flag`` holds, the rest elsewhere, filled from what is left of either."""
    half = n // 2
    ranked = df.withColumn("_f", flag).withColumn("_r", F.row_number().over(Window.partitionBy("_f").orderBy(*order)))
    some = ranked.where(F.col("_r") <= n)
    quota = F.when(F.col("_f"), F.col("_r") <= half).otherwise(F.col("_r") <= n - half)
    return some.orderBy(F.when(quota, 0).otherwise(1), F.when(F.col("_f"), 0).otherwise(1), "_r").limit(n).drop("_f", "_r")
