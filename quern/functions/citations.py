"""Bracketed citations: which element ids a text cites, in which order and how often."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The forms of a bracket group, an id, a numeric id, and of references and headings in a specification.
_GROUP = r"\[([A-Z0-9., ]+)\]"
ID = r"(?:[A-Z]+|\d+)\.\d+"
_ID = f"^{ID}$"
_NUMERIC = r"\d+\.\d+"
_REFERENCE = rf"\[({ID})\]"
HEADING = rf"^###\s+({ID})"
_NONE = "array<string>"


def _known(ids: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in ids]).cast(_NONE)


def cited_ids(text: Column, known: list[str]) -> Column:
    """Known ids in bracket groups, first seen first, without repeats; an empty array for null."""
    groups = F.regexp_extract_all(text, F.lit(_GROUP), F.lit(1))
    parts = F.transform(F.flatten(F.transform(groups, lambda g: F.split(g, ","))), lambda x: F.trim(x))
    ids = F.filter(parts, lambda x: x.rlike(_ID) & F.array_contains(_known(known), x))
    return F.coalesce(F.array_distinct(ids), F.array().cast(_NONE))


def cited_union(known: list[str], *texts: Column) -> Column:
    """Ids cited in any of several texts, in order of first sight."""
    return F.array_distinct(F.flatten(F.array(*[cited_ids(t, known) for t in texts])))


def citation_strings(text: Column) -> Column:
    """Whole bracket groups of numeric ids, as they stand."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(r"\[\d+\.\d+(?:, ?\d+\.\d+)*\]"), F.lit(0)), F.array().cast(_NONE))


def numeric_citations(text: Column, known: list[str]) -> Column:
    """Known numeric ids in brackets, repeats kept."""
    groups = F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]"), F.lit(0))
    ids = F.flatten(F.transform(groups, lambda g: F.regexp_extract_all(g, F.lit(_NUMERIC), F.lit(0))))
    return F.coalesce(F.filter(ids, lambda x: F.array_contains(_known(known), x)), F.array().cast(_NONE))


def id_order(ident: Column) -> Column:
    """A sort key that puts 5.10 after 5.2: the parts of an id as numbers, letters after all numbers."""
    return F.transform(F.split(ident, r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(1000) + F.ascii(x)))


def spec_ids(markdown: Column) -> Column:
    """Ids of a value specification: inline ``[X.Y]`` references, else headings ``### X.Y``; ordered, distinct."""
    inline = F.regexp_extract_all(markdown, F.lit(_REFERENCE), F.lit(1))
    heads = F.regexp_extract_all(markdown, F.lit(f"(?m){HEADING}"), F.lit(1))
    return F.array_distinct(F.when(F.size(inline) > 0, inline).otherwise(heads))
