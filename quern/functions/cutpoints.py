"""A deterministic tokenizer in plain expressions, and the cut points that hang on it.

A token is optional white space and then a run of other characters, so the
tokens of a text, joined, give the text back up to trailing space. Real
tokenizers plug in as pandas UDFs that return the same offsets array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PIECE = r"\s*\S+"


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))


def token_count(text: Column) -> Column:
    return F.size(pieces(text))


def _length(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.length(x))


def truncate_tokens(text: Column, limit: int) -> Column:
    """The text up to ``limit`` tokens; the whole text if it has no more."""
    return F.when(token_count(text) <= limit, text).otherwise(F.array_join(F.slice(pieces(text), 1, limit), ""))


def cut_point(text: Column, limit: int) -> Column:
    """Code points before token number ``limit`` (from 0): the length of the text if it is shorter; null for an empty text."""
    return F.when(F.length(text) > 0, F.when(token_count(text) <= limit, F.length(text)).otherwise(_length(F.slice(pieces(text), 1, limit))))


def starts(text: Column) -> Column:
    """Offset of each token's first character, its leading space included."""
    p = pieces(text)
    return F.transform(p, lambda x, i: _length(F.slice(p, 1, i)))


def ramp(u: Column) -> Column:
    """Inverse of a density that rises to 0.2 and is level after: 0.6 sqrt(u) up to 1/9, then 0.2 + 0.9 (u - 1/9)."""
    return F.when(u <= 1 / 9, F.lit(0.6) * F.sqrt(u)).otherwise(F.lit(0.2) + F.lit(0.9) * (u - F.lit(1 / 9)))


def sampled_index(n: Column, u: Column) -> Column:
    """A token index in [1, n - 1] by ``ramp``; 0 for one token or none."""
    at = F.floor(ramp(u) * n).cast("int")
    return F.when(n <= 1, 0).otherwise(F.greatest(F.lit(1), F.least(at, n - 1))).cast("int")


def end_slot(text: Column, limit: int) -> tuple[Column, Column]:
    """End offset of the last of at most ``limit`` tokens, and their number."""
    kept = F.least(token_count(text), F.lit(limit))
    return _length(F.slice(pieces(text), 1, limit)), kept.cast("int")


def token_index(text: Column, offset: Column) -> Column:
    """The token that holds a character offset, rounding down; the number of tokens past the last one's end."""
    p = pieces(text)
    inside = F.aggregate(p, F.struct(F.lit(0).alias("end"), F.lit(0).alias("k")), lambda a, x: F.struct((a["end"] + F.length(x)).alias("end"), F.when(a["end"] + F.length(x) <= offset, a["k"] + 1).otherwise(a["k"]).alias("k")))
    return inside["k"].cast("int")


def completion_budget(window: int, prompt_tokens: Column, margin: int, requested: int) -> Column:
    """Tokens left for an answer: at most ``requested``; null where nothing is left."""
    left = F.lit(window) - prompt_tokens - F.lit(margin)
    return F.when(left > 0, F.least(left, F.lit(requested))).cast("int")
