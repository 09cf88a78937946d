"""The classifier-score predicate and the reasons for which documents drop out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def confidence(score: Column, probs: Column) -> Column:
    """The probability at the score's index; null for a score out of range or a short array."""
    return F.when((score >= 0) & (score < F.size(probs)), F.get(probs, score.cast("int")))


def passes_safety(score: Column, probs: Column, least_score: int, least_confidence: float) -> Column:
    """Score and confidence at or above their bounds; never null."""
    return F.coalesce((score >= least_score) & (confidence(score, probs) >= F.lit(least_confidence)), F.lit(False))


def in_band(score: Column, probs: Column, low: float, high: float) -> Column:
    """Confidence in [low, high); never null."""
    c = confidence(score, probs)
    return F.coalesce((c >= low) & (c < high), F.lit(False))


def drop_reason(doc_id: Column, language: Column, languages: list[str], keep: Column) -> Column:
    """``null_id``, ``language``, ``safety`` or ``kept``, the first that holds."""
    return (
        F.when(doc_id.isNull() | (doc_id == ""), "null_id")
        .when(~F.coalesce(language.isin(languages), F.lit(False)), "language")
        .when(~keep, "safety")
        .otherwise("kept")
    )


def keep_filter(doc_id: Column, language: Column, languages: list[str], score: Column, probs: Column, least_score: int, least_confidence: float) -> Column:
    """What ``drop_reason`` calls ``kept``, as plain conjuncts: all but the last are pushed to the scan."""
    return doc_id.isNotNull() & (doc_id != "") & language.isin(languages) & (score >= least_score) & (confidence(score, probs) >= F.lit(least_confidence))
