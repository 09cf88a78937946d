"""Rubric scores as maps of voices to maps of dimensions: decisions, aggregates and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A score at or below the floor rejects; so does a mean below the threshold.
FLOOR, THRESHOLD = 2, 4
#: Keys of a judgment that are no voices.
RESERVED = (
    "aggregate",
    "decision",
    "judge_prompt",
    "raw_responses",
    "usage",
    "latency_ms",
    "timestamp",
    "reflection_aggregate",
    "reflection_decision",
    "judge_prompt_reflection",
)


def leaf_scores(scores: Column) -> Column:
    """All scores of all voices; an empty array for null."""
    inner = F.transform(F.map_values(scores), lambda m: F.coalesce(F.map_values(m), F.array().cast("array<int>")))
    return F.coalesce(F.flatten(F.filter(inner, lambda a: a.isNotNull())), F.array().cast("array<int>"))


def mean_score(scores: Column) -> Column:
    """Mean of all leaf scores; null if there are none."""
    leaves = F.filter(leaf_scores(scores), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(leaves, F.lit(0).cast("bigint"), lambda a, x: a + x), F.size(leaves))


def rubric_decision(scores: Column, floor: int = FLOOR, threshold: float = THRESHOLD) -> Column:
    """``reject`` if any score is at or below the floor or the mean below the threshold; null without scores."""
    leaves = leaf_scores(scores)
    low = F.exists(leaves, lambda x: F.coalesce(x <= floor, F.lit(False)))
    mean = mean_score(scores)
    return F.when(mean.isNull(), F.lit(None).cast("string")).when(low | (mean < threshold), "reject").otherwise("accept")


def voices(scores: Column) -> Column:
    """Names of the voices, sorted, reserved keys aside."""
    return F.array_sort(F.filter(F.map_keys(scores), lambda k: ~k.isin(*RESERVED)))


def voice_part(scores: Column, mode: str) -> Column:
    """The part of a judgment whose voices belong to a mode (its name, or its name and a suffix)."""
    return F.map_filter(scores, lambda k, v: (k == mode) | k.startswith(mode + "_"))


def clean_decision(decision: Column) -> Column:
    """``accept`` or ``reject`` whatever the case, spacing or ending; else null."""
    d = F.lower(F.trim(decision))
    return F.when(d.isin("accept", "accepted"), "accept").when(d.isin("reject", "rejected"), "reject")


def explode_scores(df: DataFrame, *keep: str) -> DataFrame:
    """One row per voice and dimension: ``keep``, voice, dim, score; unknown voices survive."""
    per = df.select(*keep, F.explode("scores").alias("voice", "_dims"))
    return per.select(*keep, "voice", F.explode("_dims").alias("dim", "score")).where(F.col("score").isNotNull())


def majority(votes: DataFrame, keys: list[str], value: str, order: str, without: str = "accept") -> DataFrame:
    """The most frequent value per key; of equals, the one seen first; ``without`` where no row has any."""
    counts = votes.groupBy(*keys, value).agg(F.count(value).alias("_n"), F.min(order).alias("_first"))
    best = counts.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("_n"), -F.col("_first"))).alias(value), F.sum("_n").alias("n_votes"))
    return best.withColumn(value, F.coalesce(value, F.lit(without)))
