"""Several values packed in one field: a quote-aware finite-state tokenizer.

Problem 1. ``split_packed`` reads one field character by character. Its states are
the start of a member, inside a bare member, inside a quoted one and after a
quoted one; beside these it tracks the nesting depth of brackets. A delimiter
counts only outside quotes. Where members begin with an element id, as in this
project, and titles may themselves hold commas, slashes or bars, it counts only
before a new id (or the end); in a field without any id, every delimiter counts.
Bracketed citations go through the same tokenizer: a member is the id with which
it begins, or, in quotes, the ids it consists of.

Defined results: null and empty fields, ``[]`` and fields of delimiters alone
give no rows; repeats are kept and get their own place; a quote that is never
closed ends with the field; fields are read in one pass, in time linear in their length; extra
columns of the input play no part.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ID = re.compile(r"(?:[A-Z]|\d+)\.\d+(?!\w|\.\d)")
_BARE_ID = re.compile(r"\W*(?:[A-Z]|\d+)\.\d+|cf\.", re.I)
_DELIMS = frozenset(",;|/&·、；，\t\n\r")
_WORD_DELIM = re.compile(r"\s+and\s+", re.I)
_CLOSERS = {'"': '"', "'": "'", "“": "”", "«": "»"}
_OPEN, _CLOSE = "[(［（{", "])］）}"
#: Marks before an id, and dashes between ids.
_SIGNS, _DASHES = frozenset("§"), frozenset("–—")
_START, _BARE, _QUOTED, _AFTER = range(4)


def _id_follows(s: str, i: int) -> tuple[bool, int]:
    """Whether an id or the end follows, past delimiters, white space, brackets and quotes; and where it looked."""
    n = len(s)
    while True:
        while i < n and (s[i].isspace() or s[i] in _DELIMS or s[i] in _SIGNS or s[i] in _CLOSERS or s[i] in _OPEN or s[i] in _CLOSE or s[i] == "\\"):
            i += 1
        if i >= n:
            return True, n
        if s[i : i + 3].lower() != "and" or not s[i + 3 : i + 4].isspace():
            return _ID.match(s, i) is not None, i
        i += 3


def split_packed(field: str | None) -> list[str]:
    """The members of one packed field, in order."""
    return [value for value, _ in _tokens(field)]


def _tokens(field: str | None, cited: bool = False) -> list[tuple[str, bool]]:
    """The members of one packed field, in order, and whether each stood in quotes that close.

    In a citation (``cited``) a quote that never closes is an ordinary character.
    """
    if not field:
        return []
    out: list[tuple[str, bool]] = []
    buf: list[str] = []
    state, closer, escaped, depth, i, n = _START, "", False, 0, 0, len(field)
    free = _ID.search(field) is None  # no ids: every delimiter counts
    opened = -1
    known = (0, -1, False)  # a stretch without anything but delimiters, quotes and brackets, and what follows it

    def follows(at: int) -> bool:
        nonlocal known
        if not known[0] <= at <= known[1]:
            found, seen = _id_follows(field, at)
            known = (at, seen, found)
        return known[2]

    def emit(quoted: bool = False) -> None:
        value = "".join(buf).strip().strip("　")
        buf.clear()
        if value:
            out.append((value, quoted))

    while i < n or cited and state == _QUOTED:
        if i >= n:  # never closed: again from the quote on, as a bare member
            buf.clear()
            i, state = opened + 1, _BARE
            continue
        ch = field[i]
        if state == _START:
            opened = i
            if ch == "\\" and i + 1 < n and field[i + 1] in _CLOSERS:
                i, escaped = i + 1, True
                closer, state = _CLOSERS[field[i]], _QUOTED
            elif ch in _CLOSERS:
                closer, state, escaped = _CLOSERS[ch], _QUOTED, False
            elif ch in _OPEN:
                depth += 1
            elif ch in _CLOSE:
                depth = max(0, depth - 1)
            elif not (ch.isspace() or ch in _DELIMS):
                if (m := _WORD_DELIM.match(" " + field[i : i + 5])) and m.end() > 1:
                    i += 3
                    continue
                buf.append(ch)
                state = _BARE
        elif state == _QUOTED:
            if ch == "\\" and i + 1 < n:
                nxt = field[i + 1]
                if escaped and nxt == closer:  # the closing half of an escaped pair
                    i, state = i + 1, _AFTER
                    emit(True)
                else:
                    buf.append({"n": "\n", "t": "\t"}.get(nxt, nxt))
                    i += 1
            elif ch == closer and not escaped:
                if i + 1 < n and field[i + 1] == closer and closer == '"' and not (buf == [] and follows(i + 2)):
                    buf.append(ch)  # a doubled quote stands for one
                    i += 1
                else:
                    state = _AFTER
                    emit(True)
            else:
                buf.append(ch)
        elif state == _AFTER:
            if ch in _CLOSE:
                depth = max(0, depth - 1)
            elif ch in _OPEN:
                depth += 1
                state = _START
            elif ch.isspace() or ch in _DELIMS or ch == "\\":
                state = _START
            else:
                state = _START
                continue
        else:  # _BARE
            if depth and ch in _CLOSE:
                depth -= 1
                state = _START
                emit()
            elif ch in _DELIMS or ch.isspace() or ch in _DASHES and not free:
                # in a citation, mere space parts ids, not a title and an id it mentions
                split = ch in _DELIMS if free else follows(i + 1) and not (cited and ch.isspace() and ch not in _DELIMS and (len(buf) > 12 or not _BARE_ID.fullmatch("".join(buf))))
                if split:
                    state = _START
                    emit()
                else:
                    buf.append(ch)
            else:
                buf.append(ch)
        i += 1
    emit()
    return out


#: Marks that may stand before a member's id.
_LEAD = re.compile(r"(?:cf\.|\W)*", re.I)
#: A quoted member, from its quote to the delimiter or bracket after it.
_QUOTED_MEMBER = re.compile(r"""(?:"(?:[^"\\\n]|\\.|"")*"|'[^'\\\n]*'|“[^”\n]*”|«[^»\n]*»)(?=\s*[,;|/&·、；，\]］])""")


def bracket_members(text: str | None, known: frozenset[str]) -> list[str]:
    """Known ids that stand as members of closed square brackets, in order.

    Brackets nest; one that is never closed makes no list, those closed within
    it do. A bracket in a quoted member is none. The inside of each outermost
    closed bracket goes through the tokenizer.
    """
    if not text:
        return []
    starts: list[int] = []
    closed: list[tuple[int, int]] = []
    i, fresh = 0, False  # fresh: a member may begin here
    while i < len(text):
        ch = text[i]
        if ch in "[［":
            starts.append(i + 1)
            fresh = True
        elif ch in "]］":
            if starts:
                start = starts.pop()
                while closed and closed[-1][0] >= start:
                    closed.pop()
                closed.append((start, i))
            fresh = False
        elif starts and fresh and ch in _CLOSERS and (m := _QUOTED_MEMBER.match(text, i)):
            i = m.end() - 1
            fresh = False
        elif not ch.isspace():
            fresh = ch in _DELIMS
        i += 1
    return [x for start, end in closed for value, quoted in _tokens(text[start:end], cited=True) for x in _members(value, quoted, known)]


def _members(value: str, quoted: bool, known: frozenset[str]) -> list[str]:
    """The known ids of one member: that with which it begins, or all, if it is quoted and holds nothing else."""
    if quoted and all(map(_ID.fullmatch, inner := split_packed(value))):
        return [x for x in inner if x in known]
    m = _ID.match(value, _LEAD.match(value).end())
    return [m.group()] if m and m.group() in known else []


_STRINGS = T.ArrayType(T.StringType())


def packed_values(field: Column) -> Column:
    """``split_packed`` over a column, in Arrow batches."""
    return _udf(split_packed)(field)


def cited_members(text: Column, known: list[str]) -> Column:
    """``bracket_members`` over a column, for the given ids (a small, fixed vocabulary)."""
    ids = frozenset(known)
    return _udf(lambda t: bracket_members(t, ids))(text)


def _udf(fn):
    def run(s: pd.Series) -> pd.Series:
        return s.map(fn)

    return F.pandas_udf(run, _STRINGS)


def explode_members(df: DataFrame, keys: list[str], fields: dict[str, Column]) -> DataFrame:
    """One row per member: ``keys``, field_name, elem_pos (from 1) and elem."""
    packed = F.array(*[F.struct(F.lit(name).alias("field_name"), col.alias("elems")) for name, col in fields.items()])
    one = df.select(*keys, F.explode(packed).alias("_f"))
    return one.select(*keys, F.col("_f.field_name").alias("field_name"), F.posexplode("_f.elems").alias("_pos", "elem")).select(
        *keys, "field_name", (F.col("_pos") + 1).cast("int").alias("elem_pos"), "elem"
    )


def packed_elements(items: DataFrame, charter_elements: DataFrame) -> DataFrame:
    """Problem 1 over whole tables: each element of both fields, once per item version."""
    known = [r[0] for r in charter_elements.select("element_id").where("element_id is not null").distinct().collect()]  # a fixed vocabulary
    # the members, not the texts, are shuffled; of several deliveries of a version the earliest counts
    members = F.struct(cited_members(F.col("reflection"), known).alias("reflection"), packed_values(F.col("reflection_charter_elements")).alias("reflection_charter_elements"))
    rows = items.select("item_id", "iteration", "created_at", members.alias("_m"))
    born = F.coalesce("created_at", F.lit("9999-01-01").cast("timestamp_ntz"))
    versions = rows.groupBy("item_id", "iteration").agg(F.min_by("_m", born).alias("_m"))
    return explode_members(versions, ["item_id", "iteration"], {f: F.col("_m")[f] for f in ("reflection", "reflection_charter_elements")})
