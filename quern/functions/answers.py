"""Tolerant parsing of model answers: objects inside prose, fences, think blocks and strings.

The fast path is a built-in expression; only rows it rejects go to Python, by a
filter and a union, since a projection would evaluate a UDF for every row.
Errors are data: a row that cannot be parsed says why.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.textchecks import LEAK

_FENCE = re.compile(r"```[a-zA-Z]*\s*\n?(.*?)```", re.S)
_LEAK = re.compile(LEAK)
_BAD_ESCAPE = re.compile(r'\\(?!["\\/bfnrtu])')
#: Other spellings of the answer's keys.
ALIASES = {
    "reflection": "reflection_1p",
    "reflection_first_person": "reflection_1p",
    "reflectio_n_1p": "reflection_1p",
    "reflecting_1p": "reflection_1p",
}


def object_at(s: str, start: int) -> str | None:
    """The balanced object that opens at ``start``, strings and escapes observed; None if it never closes."""
    depth, quoted, i = 0, False, start
    while i < len(s):
        ch = s[i]
        if quoted:
            if ch == "\\":
                i += 1
            elif ch == '"':
                quoted = False
        elif ch == '"':
            quoted = True
        elif ch == "{":
            depth += 1
        elif ch == "}":
            depth -= 1
            if depth == 0:
                return s[start : i + 1]
        i += 1
    return None


def objects(s: str) -> Iterator[str]:
    """Outermost balanced objects, left to right."""
    at = s.find("{")
    while at >= 0:
        got = object_at(s, at)
        at = s.find("{", at + (len(got) if got else 1))
        if got:
            yield got


def mend(s: str) -> str:
    """A lenient repair: single quotes, quotes inside strings, stray braces, trailing commas, and what was left open.

    A quote ends its string only where a comma, colon, bracket or the end
    follows; a brace where a key is due is dropped, so halves join.
    """
    out: list[str] = []
    stack: list[str] = []
    quote, last, i = "", "", 0
    while i < len(s):
        ch = s[i]
        if quote:
            if ch == "\\" and i + 1 < len(s):
                out.append(s[i : i + 2])
                i += 2
                continue
            if ch == quote and s[i + 1 :].lstrip()[:1] in ("", ",", ":", "}", "]"):
                out.append('"')
                quote, last = "", '"'
            else:
                out.append({"\n": "\\n", "\t": "\\t", '"': '\\"'}.get(ch, ch))
        elif ch in "\"'":
            quote = ch
            out.append('"')
        elif ch == "{" and last == "," and stack[-1:] == ["}"]:
            pass
        elif ch in "{[":
            stack.append("}" if ch == "{" else "]")
            out.append(ch)
            last = ch
        elif ch in "}]":
            if stack:
                stack.pop()
                out.append(ch)
                last = ch
            if not stack:
                break
        else:
            out.append(ch)
            last = ch if not ch.isspace() else last
        i += 1
    text = "".join(out) + ('"' if quote else "") + "".join(reversed(stack))
    text = re.sub(r",\s*([}\]])", r"\1", text)
    text = re.sub(r"\bTrue\b", "true", re.sub(r"\bFalse\b", "false", re.sub(r"\bNone\b", "null", text)))
    return re.sub(r":\s*([}\]])", r": null\1", text)


def _load(s: str) -> dict | None:
    try:
        got = json.loads(s, strict=False)
    except ValueError:
        return None
    if isinstance(got, list):
        got = next((x for x in got if isinstance(x, dict)), None)
    return got if isinstance(got, dict) else None


def extract_object(raw: str | None) -> dict | None:
    """The answer's object: direct, then in fences (last first), after the last fence, first and last balanced object, each also with escapes mended, and last by lenient repair."""
    if not raw or not raw.strip():
        return None
    text = raw.rpartition("</think>")[2] if "</think>" in raw else raw
    text = text.replace("<think>", "").strip()
    for escape in (False, True):
        s = _BAD_ESCAPE.sub(r"\\\\", text) if escape else text
        fences = _FENCE.findall(s)
        tries = [s, *(f.strip() for f in reversed(fences))]
        if "```" in s:
            tries.append(s.rpartition("```")[2].strip())
        whole = list(objects(s))
        tries += whole[:1] + whole[-1:]
        for t in tries:
            if (got := _load(t)) is not None:
                return got
    at = text.find("{")
    return _load(mend(text[at:])) if at >= 0 else None


def normalise(got: dict) -> dict:
    """Unwraps single-key objects and lists and renames old keys."""
    for _ in range(3):
        if len(got) == 1:
            inner = next(iter(got.values()))
            if isinstance(inner, list) and len(inner) == 1:
                inner = inner[0]
            if isinstance(inner, str) and "{" in inner:
                inner = extract_object(inner) or inner
            if isinstance(inner, dict):
                got = inner
                continue
        break
    out = dict(got)
    for other, name in ALIASES.items():
        if other in out and name not in out:
            out[name] = out.pop(other)
    return out


def _text(v: object) -> str | None:
    if isinstance(v, list):
        return "\n".join(map(str, v))
    return None if v is None else str(v)


def parse_answer(raw: str | None, required: tuple[str, ...] = ("analysis", "reflection_1p")) -> tuple[str | None, str | None, str | None, str | None]:
    """analysis, reflection_1p, and for a failure its category (``api`` or ``parse``) and reason."""
    if raw is None or not raw.strip():
        return None, None, "api", "empty answer"
    got = extract_object(raw)
    if got is None:
        return None, None, "parse", "no object"
    got = normalise(got)
    missing = [k for k in required if k not in got]
    if missing and (again := _load(mend(raw[raw.find("{") :]))) is not None:
        again = normalise(again)
        if all(k in again for k in required):
            got, missing = again, []
    if missing:
        return None, None, "parse", "missing " + ", ".join(missing)
    answer = _text(got["reflection_1p"])
    if answer and _LEAK.search(answer):
        return None, None, "parse", "key in text"
    return _text(got["analysis"]), answer, None, None


_ANSWER = "analysis string, reflection_1p string, category string, reason string"


def parse_answers(df: DataFrame, raw: str) -> DataFrame:
    """``df`` with analysis, reflection_1p, category and reason."""
    inner = F.from_json(F.col(raw), "reflection string")["reflection"]
    fast = F.from_json(F.coalesce(inner, F.col(raw)), "analysis string, reflection_1p string")
    good = fast["analysis"].isNotNull() & fast["reflection_1p"].isNotNull()
    first = df.where(good).select("*", fast["analysis"].alias("analysis"), fast["reflection_1p"].alias("reflection_1p"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("reason"))
    schema = T.StructType([*df.schema.fields, *T._parse_datatype_string(_ANSWER).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse_answer(x if isinstance(x, str) else None) for x in pdf[raw]]
            yield pdf.assign(**{c: pd.Series([g[k] for g in got], dtype=object, index=pdf.index) for k, c in enumerate(("analysis", "reflection_1p", "category", "reason"))})

    return first.unionByName(df.where(~F.coalesce(good, F.lit(False))).mapInPandas(run, schema))


def parse_judgment(raw: str | None) -> tuple[dict[str, int], float] | None:
    """Scores as whole numbers and their mean; None where there are none."""
    got = extract_object(raw)
    if got is None:
        return None
    scores = got.get("scores", got)
    try:
        out = {k: int(v) for k, v in scores.items() if not isinstance(v, (dict, list, bool))}
    except (AttributeError, TypeError, ValueError):
        return None
    return (out, sum(out.values()) / len(out)) if out else None
