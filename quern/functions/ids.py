"""Identity, versions, seeds and names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of a text that make its identity; and the hex digits kept.
ID_CHARS, ID_DIGITS = 200, 16


def content_id(text: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the first 200 code points."""
    return F.substring(F.sha2(F.substring(text, 1, ID_CHARS), 256), 1, ID_DIGITS)


def review_split(item_id: Column) -> Column:
    """``validation`` for a quarter of all ids, told by the last hex digit of their hash; else ``train``."""
    last = F.substring(F.sha2(item_id, 256), 64, 1)
    return F.when(last.isin("0", "4", "8", "c"), "validation").otherwise("train")


def seeded(seed: str, *keys: Column) -> Column:
    """A hash of a seed and keys: ordering by it is a shuffle that repeats."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]), 256)


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of ``seeded``."""
    return F.conv(F.substring(seeded(seed, *keys), 1, 13), 16, 10).cast("bigint") / F.lit(4503599627370496.0)


def fingerprint(sorted_names: Column) -> Column:
    """SHA-256 of a sorted array of names, one a line."""
    return F.sha2(F.array_join(sorted_names, "\n"), 256)


def prompt_version(name: Column, missing: int = -1) -> Column:
    """The number after ``_v``, so that v10 follows v9; ``missing`` without one."""
    return F.coalesce(F.regexp_extract(name, r"_v(\d+)", 1).try_cast("int"), F.lit(missing))


def split_stem(stem: Column) -> tuple[Column, Column]:
    """Alias and prompt of ``alias__prompt``; the whole stem and null without a separator."""
    parts = F.split(stem, "__", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def safe_name(name: Column, width: int = 120) -> Column:
    """A file name of word characters, dots and dashes."""
    return F.substring(F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "_"), 1, width)


def status_key(key: Column) -> tuple[Column, Column, Column]:
    """Role, mode and alias of ``role_mode_alias``; the alias keeps later underscores."""
    parts = F.split(key, "_", 3)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))


def first_match(text: Column, table: list[tuple[str, object]], default: object = None) -> Column:
    """The value of the first of ``table``'s substrings that ``text`` holds, in their order."""
    out = F.lit(default)
    for needle, value in reversed(table):
        out = F.when(F.contains(F.lower(text), F.lit(needle)), F.lit(value)).otherwise(out)
    return out
