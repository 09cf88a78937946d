"""Evaluation texts leaking into training text.

Problem 8, pigeonhole edit matching. A leaked piece is ten or more words in a
row (15 characters in scripts without spaces) with stray changes. Each such
block of a test item is split into error-budget-plus-one pieces; if the block
was copied within its budget, one piece stands in the document unchanged. An
Aho-Corasick automaton finds exact piece hits in one pass over each document,
each hit is extended over single changed, dropped or added words, and Myers'
bit-parallel distance verifies the extended run. A document and an item are a
pair when the verified runs cover a quarter of the item's own passage.

The documents are never shuffled: the test items, a stated query set, go to
the documents. What items share is told over all items before they are split:
wording that several items have (task lines) is masked and neither seeds nor
counts; a shorter piece that stands in several items seeds too, but a run found
by such pieces alone counts only if it is no run of another of these items: else
it is wording they share. Items beyond ``PASS_BYTES`` of text make further
passes over the documents, each with the other items that share a piece with
its own, so the rows do not depend on where the items are split.

Defined results: null and empty documents or items, and null ids, give no pair; repeated
documents give a pair each, repeated items of one id count as one; whole texts
are read however long; an item whose wording is all shared has no passage.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.textnorm import CJK, fold_tokens
from quern.session import spread

#: Bytes of test items in one automaton, which is all that is sent to the workers at a time.
PASS_BYTES = 16 << 20
#: Least run, errors in such a run, and wording length that counts as shared, for words and for characters.
WORDS = {"run": 10, "errors": 1, "shared": 8}
CHARS = {"run": 15, "errors": 1, "shared": 12}
#: Share of an item's own passage that a document must repeat.
SHARE = 0.25
#: Changed tokens allowed in a verified run, as a share of its length.
ERROR_RATE = 0.25

_IS_CJK = re.compile(f"[{CJK}]")


def myers(pattern: list, text: list) -> int:
    """Edit distance of two token sequences by Myers' bit-parallel algorithm (any length, in one big integer)."""
    m = len(pattern)
    if not m:
        return len(text)
    peq: dict = defaultdict(int)
    for i, tok in enumerate(pattern):
        peq[tok] |= 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    for tok in text:
        eq = peq.get(tok, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | 1) & mask
        mh = (mh << 1) & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return score


def _walk(a: list, b: list, i: int, j: int, step: int) -> tuple[int, int]:
    """From a matching pair (i, j), how far a run goes on over single changed, dropped or added tokens."""
    n, m, good = len(a), len(b), (i, j)
    while True:
        while 0 <= i + step < n and 0 <= j + step < m and a[i + step] == b[j + step]:
            i, j = i + step, j + step
            good = (i, j)
        for di, dj in ((2, 2), (2, 1), (1, 2)):
            x, y = i + di * step, j + dj * step
            if 0 <= x + step < n and 0 <= y + step < m and 0 <= x < n and 0 <= y < m and a[x] == b[y] and a[x + step] == b[y + step]:
                i, j = x, y
                good = (i, j)
                break
        else:
            return good


class Wording:
    """Tokens of all items, the mask of what is no item's own, and the places of pieces that stand in several items."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.tokens = [fold_tokens(t) for _, t in items]
        self.rule = [CHARS if sum(bool(_IS_CJK.match(t)) for t in toks) * 2 > len(toks) else WORDS for toks in self.tokens]
        number = {i: k for k, i in enumerate(dict.fromkeys(self.ids))}
        self._owner = np.array([number[i] for i in self.ids], dtype=np.int64)
        vocab: dict[str, int] = {}
        self._numbers = [np.array([vocab.setdefault(t, len(vocab)) for t in toks], dtype=np.int64) for toks in self.tokens]
        self.own = [bytearray(b"\1" * len(t)) for t in self.tokens]
        for row, i, n in self._shared([r["shared"] for r in self.rule]):
            self.own[row][i : i + n] = bytes(n)
        places: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for row, i, n in self._shared([self.piece(k) for k in range(len(self.ids))]):
            if all(self.own[row][i : i + n]):
                places[tuple(self.tokens[row][i : i + n])].append((row, i))
        self.places = {p: at for p, at in places.items() if len({self.ids[r] for r, _ in at}) > 1}

    def piece(self, k: int) -> int:
        return self.rule[k]["run"] // (self.rule[k]["errors"] + 1)

    def _shared(self, sizes: list[int]) -> Iterator[tuple[int, int, int]]:
        """Row, place and length of each run of ``sizes`` tokens that also stands in an item of another id."""
        for n in sorted(set(sizes)):
            rows = [k for k, s in enumerate(sizes) if s == n and len(self.tokens[k]) >= n]
            if not rows:
                continue
            grams = np.concatenate([np.lib.stride_tricks.sliding_window_view(self._numbers[k], n) for k in rows])
            row = np.repeat(rows, [len(self.tokens[k]) - n + 1 for k in rows])
            at = np.concatenate([np.arange(len(self.tokens[k]) - n + 1) for k in rows])
            _, gram = np.unique(grams, axis=0, return_inverse=True)
            owner = self._owner[row]
            low, high = np.full(gram.max() + 1, len(self.ids)), np.full(gram.max() + 1, -1)
            np.minimum.at(low, gram, owner)
            np.maximum.at(high, gram, owner)
            several = low[gram] != high[gram]
            yield from ((int(k), int(i), n) for k, i in zip(row[several], at[several]))

    def passes(self, most: int = 0) -> list[tuple[list[tuple], dict]]:
        """The items in parts: each one's (id, tokens, rule, mask) with those of the items that share pieces with them, which only compare."""
        sizes = np.cumsum([sum(map(len, t)) + len(t) for t in self.tokens])
        if not len(sizes):
            return []
        # all texts of one id go to the part of its first
        _, first, same = np.unique(self._owner, return_index=True, return_inverse=True)
        part = (sizes // (most or PASS_BYTES))[first][same]
        out = []
        for p in np.unique(part):
            mine = np.flatnonzero(part == p).tolist()
            inside = set(mine)
            common = {x: at for x, at in self.places.items() if any(r in inside for r, _ in at)}
            rest = sorted({r for at in common.values() for r, _ in at} - inside)
            new = {r: k for k, r in enumerate([*mine, *rest])}
            entries = [(self.ids[r], self.tokens[r], self.rule[r], bytes(self.own[r]), r in inside) for r in new]
            out.append((entries, {x: [(new[r], i) for r, i in at] for x, at in common.items()}))
        return out


class Items:
    """The pieces of some test items and their automaton."""

    def __init__(self, entries: list[tuple], common: dict[tuple, list[tuple[int, int]]]) -> None:
        import ahocorasick

        self.ids, self.tokens, self.rule, self.own, mine = map(list, zip(*entries)) if entries else ([], [], [], [], [])
        self.target = mine
        self._mask = [int("".join(map(str, reversed(own))) or "0", 2) for own in self.own]
        self._need = [SHARE * sum(own) for own in self.own]
        at: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for k, toks in enumerate(self.tokens):
            size = self.piece(k)
            for i in range(len(toks) - size + 1 if mine[k] else 0):
                if all(self.own[k][i : i + size]):
                    at[tuple(toks[i : i + size])].append((k, i))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            word = f" {' '.join(piece)} "
            self.automaton.add_word(word, (common.get(piece, places), len(word), piece in common))
        if len(self.automaton):
            self.automaton.make_automaton()

    @classmethod
    def of(cls, items: list[tuple[str, str]]) -> Items:
        return cls(*(Wording(items).passes(1 << 60) or [([], {})])[0])

    def piece(self, k: int) -> int:
        return self.rule[k]["run"] // (self.rule[k]["errors"] + 1)

    def matches(self, text: str | None) -> list[str]:
        """Ids of the items that ``text`` repeats."""
        if not text or not len(self.automaton):
            return []
        toks = fold_tokens(text)
        line = f" {' '.join(toks)} "
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        shared: dict[int, list[tuple[int, int, list]]] = defaultdict(list)
        last, count = 0, 0
        for end, (places, size, common) in self.automaton.iter(line):
            start = end - size + 1
            count += line.count(" ", last, start)  # tokens that began before this one
            last = start
            for k, i in places:
                if common:
                    if self.target[k]:
                        shared[k].append((i, count, places))
                else:
                    seeds[k].append((i, count))
        return [self.ids[k] for k in seeds | shared if self._covers(k, seeds.get(k, []), shared.get(k, []), toks)]

    def _run(self, k: int, i: int, j: int, toks: list[str]) -> tuple[int, int, int, int, bool]:
        """First and last token of the run from (i, j) in the item and in the document, and whether it is long and like enough."""
        item, rule = self.tokens[k], self.rule[k]
        a, c = _walk(item, toks, i, j, -1)
        b, d = _walk(item, toks, i, j, 1)
        size = b - a + 1
        return a, b, c, d, size >= rule["run"] and myers(item[a : b + 1], toks[c : d + 1]) <= ERROR_RATE * size

    def _covers(self, k: int, seeds: list[tuple[int, int]], shared: list[tuple[int, int, list]], toks: list[str]) -> bool:
        covered = 0  # as bits, one a token
        done: set[tuple[int, int]] = set()
        spans: list[tuple[int, int, int, int]] = []
        for i, j, others in [*((i, j, ()) for i, j in seeds), *shared]:
            if (i, j) in done or any(a <= i <= b and c <= j <= d for a, b, c, d in spans[-4:]):
                continue
            a, b, c, d, good = self._run(k, i, j, toks)
            done.add((i, j))
            spans.append((a, b, c, d))
            if good and not any(self.ids[x] != self.ids[k] and self._run(x, y, j, toks)[4] for x, y in others):
                covered |= (1 << b - a + 1) - 1 << a
        return covered != 0 and self._need[k] > 0 and (covered & self._mask[k]).bit_count() >= self._need[k]


_BUILT: dict[str, Items] = {}


def leaked_pairs(documents: DataFrame, bench_items: DataFrame) -> DataFrame:
    """doc_id and item_id of each document that repeats a quarter of an item's own passage."""
    spark = documents.sparkSession
    # the test items, a stated query set, come to the driver whole
    rows = sorted({(r[0], r[1]) for r in bench_items.select("item_id", "text").where("item_id is not null and text is not null").collect()})
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("item_id", T.StringType())])
    docs = spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null"))
    found = None
    for part in Wording(rows).passes() or [([], {})]:
        sent = spark.sparkContext.broadcast(part)

        def scan(batches: Iterator[pd.DataFrame], sent=sent, key=uuid.uuid4().hex) -> Iterator[pd.DataFrame]:
            if key not in _BUILT:  # once per worker, for all its tasks
                _BUILT.clear()
                _BUILT[key] = Items(*sent.value)
            items = _BUILT[key]
            for pdf in batches:
                hits = [(d, i) for d, t in zip(pdf["doc_id"], pdf["text"]) for i in dict.fromkeys(items.matches(t))]
                yield pd.DataFrame({"doc_id": pd.Series([h[0] for h in hits], dtype=pdf["doc_id"].dtype), "item_id": pd.Series([h[1] for h in hits], dtype="object")})

        some = docs.mapInPandas(scan, schema)
        found = some if found is None else found.unionByName(some)
    return found


def leak_counts(pairs: DataFrame, bench_items: DataFrame) -> DataFrame:
    """For each test item, the documents that hold it; items that did not leak have 0."""
    counts = pairs.groupBy("item_id").agg(F.count("*").alias("n_docs"))
    items = bench_items.select("item_id", "bench", "lang").where("item_id is not null").dropDuplicates(["item_id"])
    return items.join(counts, "item_id", "left").select("item_id", "bench", "lang", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
