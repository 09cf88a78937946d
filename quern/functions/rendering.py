"""Presentation shapes: hover markup for citations, specification sections, slimmed records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.citations import HEADING

_HEAD = re.compile(HEADING + r"\s*(.*)$")


def escape_html(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def hover_citations(text: Column, titles: dict[str, str]) -> Column:
    """Escaped text whose known citations carry their titles; others stay as they are."""
    out = escape_html(text)
    for ident, title in titles.items():
        safe = title.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;").replace("\\", "\\\\").replace("$", "\\$")
        out = F.regexp_replace(out, rf"(?<![\w.]){re.escape(ident)}(?![\w.])(?=[^\[\]]*\])", f'<abbr title="{safe}">{ident}</abbr>')
    return out


def spec_sections(markdown: str, cap: int = 2000) -> list[tuple[str, str, str]]:
    """id, title and body (at most ``cap`` characters) of each section of a value specification."""
    out: list[list] = []
    for line in markdown.splitlines():
        m = _HEAD.match(line)
        if m:
            out.append([m.group(1), m.group(2).strip(), []])
        elif line.startswith("#"):
            out.append([None, "", []])
        elif out:
            out[-1][2].append(line)
    return [(i, t, "\n".join(b).strip()[:cap]) for i, t, b in out if i]


def strip_heavy(df: DataFrame, voices: str, drop: tuple[str, ...] = ("reasoning", "model_reasoning"), columns: tuple[str, ...] = ()) -> DataFrame:
    """Drops heavy columns, and heavy fields inside every voice of a map of structs."""
    slim = F.transform_values(voices, lambda k, v: v.dropFields(*drop))
    return df.drop(*columns).withColumn(voices, slim)


def sanitize(text: Column) -> Column:
    """Text without lone surrogates and other characters that no UTF-8 file holds."""
    return F.regexp_replace(text, "[\\uD800-\\uDFFF\\uFFFE\\uFFFF\\u0000]", "�")
