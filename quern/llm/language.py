"""Missing or wrong document language labels, and mixed texts.

Problem 4. A linear-chain conditional random field labels each word (in scripts
without spaces, each character) with a language: affix, character n-gram,
script and lexicon features with learned weights, and learned transitions,
trained jointly by stochastic gradient of the log likelihood. Forward-backward
gives the marginals, whose means over sentences are the segments' confidences.

Training uses a bounded sample: ``PER_LANGUAGE`` labelled texts of each
language, chosen by hash and read whole. Code-switched sequences are made by joining sentences
of different texts; after a first round, sentences whose label the model
contradicts are left out (labels are wrong in places). Everything else reads all texts.

Words carry the labels: within a sentence, runs of ``SENTENCE_WORDS`` words or
more of one language are kept apart (fewer go with their neighbours, as a few
foreign words are no segment), so a sentence that changes its language in the
middle gives two segments; each segment has the offsets of its characters. A
sentence is full in a language if it is long enough and its mean marginal is
``SURE``. A segment of which too few words are known in its language (function
words and words of the training texts) is of no known language: ``und``.

A passage in brackets is read apart from the sentence around it. It counts if it
is a full sentence: it begins like one, ends in a stop or stands between
sentences, and has the words of one; other bracketed words are no segment, unless
the text has no others.

Defined results: null and blank texts have no language; a text without letters
is ``und`` with confidence 0; ties go to the language first in ``LANGS``; whole
texts are read; with few or no labelled texts the lexicon and scripts decide.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.textnorm import CJK
from quern.llm.tokens import clean_language
from quern.llm.words import LANGS, languages_of

#: Labelled texts per language that the model is fitted on, and the most words of a training sentence, longer ones being several.
PER_LANGUAGE, TRAIN_WORDS = 200, 60
BUCKETS = 1 << 15
EPOCHS, BATCH, RATE = 3, 64, 0.05
#: Least words (characters, in scripts without spaces) of a full sentence, and its least mean marginal.
SENTENCE_WORDS, SENTENCE_CHARS, SURE = 4, 8, 0.6
#: Words of a text that are worked out at a time; longer texts are in several parts, which bounds the memory and cuts the chain there.
PART_WORDS = 50_000
#: Least share of a segment's words that its language must know, and of its different words, or so many of these.
KNOWN, KNOWN_KINDS, ENOUGH_KINDS = 0.2, 0.15, 12
UND = "und"

_N = len(LANGS)
_AT = {lang: k for k, lang in enumerate(LANGS)}
_ALL = (1 << _N) - 1
_TOKEN = re.compile(f"[{CJK}]|[^\\W\\d_{CJK}]+")
_SPLIT = re.compile(r"(?<=[.!?…;])[\"”»)\]]*\s+|(?<=[。！？；])|\n\s*\n|\.\.\.|!!")
_PAREN = re.compile(r"[(（][^()（）\n]{0,200}[)）]")
_ENDED = re.compile(r"[.!?。！？…][\"”»』」]*$")
#: Holds the place of a bracketed passage.
_HELD = "\ue000"
_KANA = re.compile("[ぁ-ヿ]")
_WIDE = re.compile(f"[{CJK}]")
_HAN = re.compile("[㐀-䶿一-鿿豈-﫿]")
_CYR = re.compile("[Ѐ-ӿ]")


def _h(s: str) -> int:
    return zlib.crc32(s.encode()) % BUCKETS


#: The first buckets are kept for the lexicon and script features, which start with a weight.
_FIXED = {f"lex={lang}": k for k, lang in enumerate(LANGS)} | {"kana": _N, "han": _N + 1, "cyr": _N + 2, "latin": _N + 3}


@lru_cache(maxsize=100_000)
def word_features(word: str) -> list[int]:
    """Buckets of one word's features (lower case; a character comes with its neighbours as ``prev char next``)."""
    if "\x00" in word:
        prev, ch, nxt = word.split("\x00")
        out = [_FIXED["kana"] if _KANA.match(ch) else _FIXED["han"], _h("c" + ch), _h("p" + prev + ch), _h("n" + ch + nxt)]
        if _KANA.match(prev or " ") or _KANA.match(nxt or " "):
            out.append(_FIXED["kana"])
        return out
    w = word
    out = [_FIXED["cyr" if _CYR.search(w) else "latin"], _h("w" + w)]
    out += [_FIXED[f"lex={x}"] for x in languages_of(w)]
    for k in range(1, min(4, len(w)) + 1):
        out += [_h(f"<{w[:k]}"), _h(f"{w[-k:]}>")]
    s = f"^{w}$"
    for k in (2, 3):
        out += [_h(f"{k}{s[i : i + k]}") for i in range(len(s) - k + 1)]
    return out


def _initial() -> np.ndarray:
    w = np.zeros((BUCKETS, _N), dtype=np.float32)
    for k in range(_N):
        w[k, k] = 1.5
    for script, own in (("kana", {"jpn": 2.5}), ("han", {"cmn": 1.0, "jpn": 0.7}), ("cyr", {"rus": 3.0}), ("latin", dict.fromkeys(("en", "deu", "fra", "ita", "spa"), 1.0))):
        for lang, k in _AT.items():
            w[_FIXED[script], k] = own.get(lang, -3.0)
    return w


def forward_backward(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (batch, time, state) and summed pair marginals of a padded batch of log potentials."""
    b, t, n = emit.shape
    e = np.exp(emit - emit.max(2, keepdims=True))
    a = np.exp(trans)
    live = np.arange(t)[None, :] < lengths[:, None]
    alpha = np.empty_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        x = (alpha[:, i - 1] @ a) * e[:, i]
        alpha[:, i] = x / x.sum(1, keepdims=True)
    beta = np.ones_like(e)
    for i in range(t - 2, -1, -1):
        x = (e[:, i + 1] * beta[:, i + 1]) @ a.T
        x /= x.sum(1, keepdims=True)
        beta[:, i] = np.where(live[:, i + 1, None], x, 1.0)
    post = alpha * beta
    post /= post.sum(2, keepdims=True)
    pair = np.zeros((n, n))
    for i in range(t - 1):
        right = e[:, i + 1] * beta[:, i + 1]
        x = alpha[:, i, :, None] * a[None] * right[:, None, :]
        x /= x.sum((1, 2), keepdims=True)
        pair += x[live[:, i + 1]].sum(0)
    return post, pair


def _is_char(w: str) -> bool:
    return w[0] > "⺀" and len(w) == 1 and (_HAN.match(w) or _KANA.match(w)) is not None


def tokens_of(text: str) -> list[str]:
    """Words in lower case; characters of scripts without spaces carry their neighbours."""
    raw = _TOKEN.findall(text.lower())
    if text.isascii() or not _WIDE.search(text):
        return raw
    out = []
    for i, w in enumerate(raw):
        if _is_char(w):
            prev = raw[i - 1] if i and len(raw[i - 1]) == 1 else ""
            nxt = raw[i + 1] if i + 1 < len(raw) and len(raw[i + 1]) == 1 else ""
            out.append(f"{prev}\x00{w}\x00{nxt}")
        else:
            out.append(w)
    return out


class Model:
    """Weights of the field, and the words each language knows; the emissions of words seen before are kept as rows of a table."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, known: dict[str, int] | None = None) -> None:
        self.weights, self.trans, self.known = weights, trans, known or {}
        self._row: dict[str, int] = {}
        self._table = np.zeros((1024, _N))
        self._knows = np.zeros(1024, dtype=np.int64)

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of the words in the table of emissions."""
        if len(self._row) > 200_000:
            self._row.clear()
        get = self._row.get
        ids = [get(w, -1) for w in words]
        if -1 in ids:
            for i, k in enumerate(ids):
                if k < 0:
                    w = words[i]
                    k = self._row.get(w)
                    if k is None:
                        k = self._row[w] = len(self._row)
                        if k >= len(self._table):
                            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
                            self._knows = np.concatenate([self._knows, np.zeros_like(self._knows)])
                        self._table[k] = self.weights[word_features(w)].sum(0)
                        self._knows[k] = self.known.get(w, 0) | sum(1 << _AT[x] for x in languages_of(w)) if "\x00" not in w else _ALL
                    ids[i] = k
        return np.array(ids, dtype=np.int64)

    def emissions(self, words: list[str]) -> np.ndarray:
        rows = self.rows(words)
        return self._table[rows]

    def marginals(self, sequences: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Marginals of each sequence, and the rows of its words, worked out in batches of like lengths."""
        out: list = [(np.zeros((0, _N)), np.zeros(0, dtype=np.int64))] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if s), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            # a batch holds at most 256 sequences and some 100,000 words
            size = 256
            while size > 1 and at + size <= len(order) and size * len(sequences[order[min(at + size, len(order)) - 1]]) > 100_000:
                size //= 2
            some = order[at : at + size]
            lengths = np.array([len(sequences[i]) for i in some])
            rows = self.rows([w for i in some for w in sequences[i]])
            live = np.arange(lengths.max())[None, :] < lengths[:, None]
            emit = np.zeros((*live.shape, _N))
            emit[live] = self._table[rows]
            post = self._post(emit, lengths)
            ends = np.cumsum(lengths)
            for k, i in enumerate(some):
                out[i] = (post[k, : lengths[k]], rows[ends[k] - lengths[k] : ends[k]])
            at += size
        return out

    def knows(self, rows: list[np.ndarray], k: int) -> bool:
        """Whether language ``k`` knows enough of the words."""
        every = np.concatenate(rows)
        hit = self._knows[every] >> k & 1
        kinds = self._knows[np.unique(every)] >> k & 1
        return hit.mean() >= KNOWN and kinds.sum() >= max(min(ENOUGH_KINDS, KNOWN_KINDS * len(kinds)), min(2, len(kinds) / 2))

    def _post(self, emit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        e = np.exp(emit - emit.max(2, keepdims=True))
        a = np.exp(self.trans)
        t = e.shape[1]
        alpha, beta = np.empty_like(e), np.ones_like(e)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for i in range(1, t):
            x = (alpha[:, i - 1] @ a) * e[:, i]
            alpha[:, i] = x / x.sum(1, keepdims=True)
        for i in range(t - 2, -1, -1):
            x = (e[:, i + 1] * beta[:, i + 1]) @ a.T
            beta[:, i] = np.where((i + 1 < lengths)[:, None], x / x.sum(1, keepdims=True), 1.0)
        post = alpha * beta
        return post / post.sum(2, keepdims=True)


def _pieces(texts: list[tuple[str, str]]) -> list[tuple[list[str], int]]:
    """Sentences as words, long ones in several parts, with the number of their text's language."""
    sentences = [(tokens_of(s), _AT[lang]) for lang, text in texts for s in _SPLIT.split(text) if s and s.strip()]
    return [(ws[i : i + TRAIN_WORDS], k) for ws, k in sentences for i in range(0, len(ws), TRAIN_WORDS)]


def _sequences(pieces: list[tuple[list[str], int]], rng: np.random.Generator) -> tuple[list[list[str]], list[list[int]]]:
    """Code-switched training sequences: one to three sentences of any texts in turn."""
    order = rng.permutation(len(pieces))
    words, labels, i = [], [], 0
    while i < len(order):
        k = int(rng.integers(1, 4))
        some = [pieces[j] for j in order[i : i + k]]
        words.append([w for ws, _ in some for w in ws])
        labels.append([y for ws, y in some for _ in ws])
        i += k
    return words, labels


def _train(pieces: list[tuple[list[str], int]], weights: np.ndarray, trans: np.ndarray, epochs: int, rng: np.random.Generator) -> np.ndarray:
    """Stochastic gradient ascent on the log likelihood; ``weights`` are changed in place."""
    words, labels = _sequences(pieces, rng)
    ys = [np.array(y) for y in labels]
    eye = np.eye(_N)
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab)) for w in ws]) for ws in words]
    feats = [np.array(word_features(w)) for w in vocab]
    sizes = np.array([len(f) for f in feats])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(feats)
    g2w, g2t = np.full((BUCKETS, 1), 1e-2), np.full((_N, _N), 1e-2)
    for _ in range(epochs):
        order = np.array(sorted(range(len(ids)), key=lambda i: (len(ids[i]) // 8, rng.random())))
        for b in rng.permutation(-(-len(order) // BATCH)):
            some = order[b * BATCH : (b + 1) * BATCH]
            lengths = np.array([len(ids[i]) for i in some])
            live = np.arange(lengths.max())[None, :] < lengths[:, None]
            y = np.concatenate([ys[i] for i in some])
            gold = np.zeros((*live.shape, _N))
            gold[live] = eye[y]
            within = np.ones(len(y), dtype=bool)
            within[np.cumsum(lengths) - 1] = False  # no pair with the next sequence
            first = np.flatnonzero(within)
            gpair = np.bincount(y[first] * _N + y[first + 1], minlength=_N * _N).reshape(_N, _N).astype(float)
            mine_ids = np.concatenate([ids[i] for i in some])
            seen, where = np.unique(mine_ids, return_inverse=True)
            owner = np.repeat(np.arange(len(seen)), sizes[seen])
            inner = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(sizes[seen])[:-1]]), sizes[seen])
            mine = flat[starts[seen][owner] + inner]
            scores = np.add.reduceat(weights[mine], np.concatenate([[0], np.cumsum(sizes[seen])[:-1]]), axis=0)
            emit = np.zeros_like(gold)
            emit[live] = scores[where]
            post, pair = forward_backward(emit, lengths, trans)
            miss = (gold - post)[live]
            by_word = np.stack([np.bincount(where, miss[:, k], len(seen)) for k in range(_N)], 1)
            touched, slot = np.unique(mine, return_inverse=True)
            spread = by_word[owner]
            grad = np.stack([np.bincount(slot, spread[:, k], len(touched)) for k in range(_N)], 1) / len(some) - 1e-4 * weights[touched]
            grad[(touched >= _N) & (touched < _N + 4)] = 0  # what a script allows is given
            g2w[touched] += (grad**2).mean(1, keepdims=True)
            weights[touched] += (RATE * grad / np.sqrt(g2w[touched])).astype(np.float32)
            gt = (gpair - pair) / len(some)
            g2t += gt**2
            trans = trans + RATE * gt / np.sqrt(g2t)
    return trans


def fit(texts: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fits the field to (language, text) pairs: once to all, then to the sentences the first fit does not contradict."""
    rng = np.random.default_rng(seed)
    pieces = _pieces(texts)
    weights, trans = _initial(), np.eye(_N) * 3.0
    known: dict[str, int] = {}
    if pieces:
        _train(pieces, weights, trans, 1, rng)
        first = Model(weights, trans)
        kept = [p for p in pieces if int(first.emissions(p[0]).sum(0).argmax()) == p[1]]
        if kept:
            weights = _initial()
            trans = _train(kept, weights, trans, EPOCHS, rng)
            seen = Counter((w, k) for ws, k in kept for w in set(ws) if "\x00" not in w)
            for (w, k), n in seen.items():
                if n > 1:  # a word in one sentence only may be a name
                    known[w] = known.get(w, 0) | 1 << k
    return Model(weights, trans, known)


def _spans(cut: re.Pattern, text: str, start: int, end: int) -> list[tuple[int, int]]:
    """What lies between the matches of ``cut``."""
    out, at = [], start
    for m in cut.finditer(text, start, end):
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, end)]


def _cut(text: str) -> list[tuple[int, str, bool]]:
    """Sentences of a text: where each begins, its characters (bracketed passages blanked), and whether it stood in brackets.

    A bracketed passage comes after the sentence around it, if it is one itself.
    """
    text = text.replace(_HELD, " ")
    inside = [m.span() for m in _PAREN.finditer(text)] if "(" in text or "（" in text else []
    if not inside:
        return [(a, text[a:b], False) for a, b in _spans(_SPLIT, text, 0, len(text)) if text[a:b].strip()]
    rest = _PAREN.sub(lambda m: _HELD * len(m.group()), text)
    alone = not _TOKEN.search(rest.replace(_HELD, " "))
    held = iter(inside)
    brackets = next(held, None)
    out = []
    for a, b in _spans(_SPLIT, rest, 0, len(rest)):
        if not rest[a:b].strip():
            continue
        own = rest[a:b].replace(_HELD, " ")
        out.append((a, own, False))
        stands = not _TOKEN.search(own)
        while brackets and brackets[0] < b:
            x, y = brackets[0] + 1, brackets[1] - 1
            brackets = next(held, None)
            first = _TOKEN.search(text, x, y)
            if alone or first and not first.group()[0].islower() and (stands or _ENDED.search(text[x:y].rstrip())):
                out += [(c, text[c:d], not alone) for c, d in _spans(_SPLIT, text, x, y) if text[c:d].strip()]
    return out


def _runs(labels: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends of the runs of like labels in one sentence; runs of fewer words than a sentence has go with a neighbour."""
    edges = np.flatnonzero(np.diff(labels)) + 1
    if not len(edges):
        return [(0, len(labels))]
    starts = [0, *edges.tolist()]
    ends = [*edges.tolist(), len(labels)]
    kept: list[list[int]] = []
    for a, b in zip(starts, ends):
        if sizes[a:b].sum() >= 1:  # long enough
            if kept and labels[kept[-1][0]] == labels[a]:
                kept[-1][1] = b
            else:
                kept.append([a, b])
    if len(kept) < 2:
        return [(0, len(labels))]
    # what lies between two runs goes with the one before, what comes first with the one after
    bounds = [0, *[a for a, _ in kept[1:]], len(labels)]
    return list(zip(bounds, bounds[1:]))


def segments(texts: list[str], model: Model, offsets: bool = False) -> list[list[tuple[str, float, int, bool, int, int]]]:
    """Of each text, its stretches in one language: language, confidence, words, whether any sentence is full, and (if asked for) where they begin and end."""
    cut = [_cut(t) for t in texts]
    toks = [[(at, s, bracketed, tokens_of(s)) for at, s, bracketed in ss] for ss in cut]
    words = [[w for x in ts for w in x[3]] for ts in toks]
    parts_of = [range(0, max(len(ws), 1), PART_WORDS) for ws in words]
    done = iter(model.marginals([ws[at : at + PART_WORDS] for ws, ats in zip(words, parts_of) for at in ats]))
    out = []
    for ts, ats in zip(toks, parts_of):
        some = [next(done) for _ in ats]
        post, rows = some[0] if len(some) == 1 else (np.concatenate([p for p, _ in some]), np.concatenate([r for _, r in some]))
        runs: list[list] = []
        i = 0
        for at, s, bracketed, ws in ts:
            n = len(ws)
            if not n:
                continue
            own, mine = post[i : i + n], rows[i : i + n]
            i += n
            mean = own.mean(0)
            k = int(mean.argmax())
            wide = sum("\x00" in w for w in ws) * 2 > n
            full = n >= (SENTENCE_CHARS if wide else SENTENCE_WORDS) and mean[k] >= SURE
            if bracketed and not full:
                continue
            parts = [(0, n)]
            if mean[k] < 0.95 and n >= 2 * SENTENCE_WORDS:
                parts = _runs(own.argmax(1), np.where(["\x00" in w for w in ws], 1 / SENTENCE_CHARS, 1 / SENTENCE_WORDS) + 1e-9)
            places = [m.span() for m in _TOKEN.finditer(s)] if offsets else ()
            for a, b in parts:
                part = own[a:b].mean(0) if len(parts) > 1 else mean
                j = int(part.argmax()) if len(parts) > 1 else k
                start, end = (at + places[a][0], at + places[b - 1][1]) if offsets else (0, 0)
                sure = part[j] * (b - a)
                if runs and runs[-1][0] == j:
                    last = runs[-1]
                    last[1] += sure
                    last[2] += b - a
                    last[3] |= full and j == k
                    last[4], last[5] = min(last[4], start), max(last[5], end)
                    last[6].append(mine[a:b])
                else:
                    runs.append([j, sure, b - a, full and j == k, start, end, [mine[a:b]]])
        found = [(LANGS[k] if model.knows(words, k) else UND, float(p / n), n, bool(f), a, b) for k, p, n, f, a, b, words in runs]
        out.append(found or [(UND, 0.0, 0, False, 0, 0)])
    return out


_SEGMENT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("n_words", T.LongType()), T.StructField("full", T.BooleanType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def training_sample(items: DataFrame) -> list[tuple[str, str]]:
    """At most ``PER_LANGUAGE`` (language, text) pairs of each language, chosen by hash."""
    labelled = items.where("item_id is not null and text is not null").select("item_id", clean_language(F.col("subset")).alias("lang")).where("lang is not null").groupBy("item_id").agg(F.min("lang").alias("lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("item_id"), "item_id"))
    chosen = labelled.withColumn("_r", rank).where(F.col("_r") <= PER_LANGUAGE).drop("_r")
    texts = items.select("item_id", "text").join(F.broadcast(chosen), "item_id").groupBy("item_id", "lang").agg(F.min("text").alias("text"))
    return [(r["lang"], r["text"]) for r in texts.orderBy("item_id").collect()]


def text_segments(items: DataFrame, kinds: bool = False, offsets: bool = True) -> DataFrame:
    """item_id, position, lang, confidence, n_words, full, start and end of every segment, once per item.

    With ``kinds``, texts that are no prose are left out in the same pass; those all
    in the one language of all their labels, which are no cases anyway, go unlooked at.
    """
    from quern.llm import quality

    spark = items.sparkSession
    with ThreadPoolExecutor(1) as pool:  # the two models are fitted side by side
        later = pool.submit(lambda: quality.fit_texts(quality.distinct_texts(items))) if kinds else None
        model = fit(training_sample(items))
        kind = later.result() if later else None
    sent = spark.sparkContext.broadcast((model.weights, model.trans, model.known))
    judge = spark.sparkContext.broadcast((kind.grams.grams, kind.weights) if kind else None)
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("segs", T.ArrayType(_SEGMENT))])
    names = _SEGMENT.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = Model(*sent.value)
        odd = quality.Kinds(*judge.value) if judge.value else None
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                some = pdf.iloc[at : at + 1000]
                got = segments(some["text"].tolist(), mine, offsets)
                keep = [True] * len(got)
                if odd:
                    cases = [len(found := {s[0] for s in segs}) > 1 or found != set(labels) for segs, labels in zip(got, some["labels"])]
                    keep = [c and quality.text_kind(quality.Layout(t, odd.grams), odd)[0] is None for c, t in zip(cases, some["text"])]
                out = [(i, [dict(zip(names, s)) for s in segs]) for i, segs, k in zip(some["item_id"], got, keep) if k]
                yield pd.DataFrame({"item_id": [i for i, _ in out], "segs": [s for _, s in out]})

    label = F.coalesce(clean_language(F.col("subset")), F.lit("")) if kinds else F.lit("")
    texts = items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"), F.collect_set(label).alias("labels"))
    found = texts.where(F.trim("text") != "").select("item_id", "text", "labels").mapInPandas(run, schema)
    return found.select("item_id", F.posexplode("segs").alias("position", "_s")).select("item_id", (F.col("position") + 1).alias("position"), "_s.*")


def text_languages(segs: DataFrame) -> DataFrame:
    """item_id, lang, confidence and n_words: the main language, and others that have a full sentence."""
    per = segs.groupBy("item_id", "lang").agg(F.sum("n_words").alias("n_words"), F.try_divide(F.sum(F.col("confidence") * F.col("n_words")), F.sum("n_words")).alias("confidence"), F.bool_or("full").alias("full"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("n_words"), "lang"))
    return per.withColumn("_r", rank).where("_r = 1 or full").select("item_id", "lang", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "n_words")


def label_cases(items: DataFrame) -> DataFrame:
    """Item versions whose label is missing, wrong or names one of several languages: a row per language of the text."""
    langs = text_languages(text_segments(items, kinds=True, offsets=False)).where("lang <> 'und'").groupBy("item_id").agg(F.collect_set("lang").alias("langs"))
    versions = items.where("text is not null").groupBy("item_id", "iteration").agg(F.min(clean_language(F.col("subset"))).alias("label"))
    wrong = F.col("label").isNull() | (F.size("langs") > 1) | ~F.array_contains("langs", F.col("label"))
    return versions.join(langs, "item_id").where(wrong).select("item_id", "iteration", F.explode("langs").alias("lang"))
