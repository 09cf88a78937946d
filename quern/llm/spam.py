"""Keyword-stuffed and link-list pages.

Problem 10. Each document gives a vector of features that grow towards spam:
density (the share of the text in links, hashtags, price lists, keyword runs and
sentences that only repeat a keyword), entropy deficit, repetition of content
words, and lack of function words. Over all documents of a language a robust
centre (medians), scale (median absolute deviations) and correlation (of values
clipped at ``CLIP`` scales, so that spam itself cannot bend it) are taken; the
documents whose robust Mahalanobis distance is as large as that of a page half
of which is spam, and whose deviation lies towards spam, are the spam pages.
Nothing else selects them.

The features are computed in one pass over whole texts and written once; medians
and moments are partial aggregates over that narrow table, so neither a hot
site nor a hot language gathers rows in one task.

Defined results: null, empty and blank texts and null ids are no cases; repeated documents
are cases each; a language with fewer than ``LEAST`` documents uses the figures
of all documents, as do texts of no telling language; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.textnorm import CJK, LOOKALIKES
from quern.llm.words import guess, is_function
from quern.session import materialize, small_table, spread

FEATURES = ("density", "entropy", "repetition", "bare")
#: Least scale of each feature, and the scales at which values are clipped for the correlation.
FLOOR, CLIP = 0.05, 3.0
#: Squared distance from which on a document is an outlier: that of a page of which half is spam while its other features are a scale or two off.
CUT = 110.0
LEAST = 50
#: Words from which on a text's entropy is no longer held against its length.
WIDE = 2000

_ANCHOR = re.compile(r"<a\b[^<>]*>[^<]*</a>|\[[^\[\]\n]*\]\([^)\s]*\)|(?:https?://|www\.)\S+|(?<!\w)#\w+", re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_WORD = re.compile(f"[{CJK}]|[^\\W_{CJK}]+")
_SENT = re.compile(r"(?<=[.!?…])[\"”»)\]]*\s+|(?<=[。！？])")
_STOPS, _CLOSERS = frozenset(".!?。！？…"), "\"”»』」)]"
_LINK = "\x01"
_FN, _HEAVY = 1 << 30, 1 << 60
_PRICE = re.compile(r"\d[.,]\d\d(?!\d)")
_CYRILLIC, _LATIN = re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-z]")
_HIRA = re.compile("[ぁ-ゖ]")
#: Share of words that repeated content words take up in a stuffed entry or sentence; half, in a fluent sentence with no word twice.
STUFFED = 0.3


def _segments(text: str) -> list[str]:
    return [s for line in text.split("\n") for s in _SENT.split(line) if s.strip()]


def _heavy(words: list[str], fn: set[str], cjk: bool) -> tuple[set, bool]:
    """Content words (in scripts without spaces, character pairs) that the text keeps repeating."""
    n = len(words)
    if cjk:
        least = max(3, 0.025 * n)
        return {p for p, k in Counter(zip(words, words[1:])).items() if k >= least and p[0] not in fn and p[1] not in fn and not (_HIRA.match(p[0]) and _HIRA.match(p[1]))}, True
    least = max(3, 0.02 * n)
    return {w for w, k in Counter(words).items() if k >= least and w not in fn and len(w) > 2 and not w[0].isdigit()}, False


def _weigh_pairs(toks: list[str], fn: set[str], heavy: set) -> tuple[int, int, int]:
    """Characters that count, function characters, and those of repeated pairs, in scripts without spaces."""
    hit = bytearray(len(toks))
    for i, p in enumerate(zip(toks, toks[1:])):
        if p in heavy:
            hit[i] = hit[i + 1] = 1
    keep = [i for i, t in enumerate(toks) if t[0] > "\u2e80"] or range(len(toks))
    return len(keep), sum(toks[i] in fn for i in keep), sum(hit[i] for i in keep)


def _repeats(toks: list[str], heavy: set, pairs: bool) -> bool:
    """Whether one sentence has a repeated content word twice."""
    own = [p for p in (zip(toks, toks[1:]) if pairs else toks) if p in heavy]
    return len(set(own)) < len(own)


def _ends(seg: str) -> bool:
    """Whether a segment ends in a stop, closing quotes and brackets aside."""
    return seg.rstrip(_CLOSERS)[-1:] in _STOPS if seg[-1:] in _CLOSERS else seg[-1:] in _STOPS


def _evenness(counts: Counter) -> float:
    """Entropy of the words over the most there can be; over that of ``WIDE`` words in longer texts, whose vocabulary no longer grows with them."""
    n = counts.total()
    if n < 2 or len(counts) < 2:
        return 1.0 - (n > 3)
    return min(1.0, -sum(k / n * math.log(k / n) for k in counts.values()) / math.log(min(n, WIDE)))


def _latin(text: str) -> str:
    """Text in the Latin alphabet with look-alike Cyrillic letters set straight; other texts as they are."""
    if text.isascii() or not (found := _CYRILLIC.findall(text)):
        return text
    return text.translate(LOOKALIKES) if len(_LATIN.findall(text)) > 2 * len(found) else text


def features(text: str) -> tuple[str, list[float]] | None:
    """Language and the feature vector: density of spam, entropy deficit, repetition, lack of function words."""
    total = len("".join(text.split()))
    if not total:
        return None
    text = _latin(text)
    bare = _ANCHOR.sub(_LINK, text)
    if "<" in bare:
        bare = _TAG.sub(" ", bare)
    segs = [(seg, _WORD.findall(seg.lower())) for seg in _segments(bare)]
    words = [w for _, toks in segs for w in toks]
    n = len(words)
    linked = sum(len(m) - m.count(" ") for m in _ANCHOR.findall(text)) if _LINK in bare else 0
    counts = Counter(words)
    lang = guess(counts)
    cjk = lang in ("cmn", "jpn")
    fn = {w for w in counts if is_function(w)}
    share = 0.06 if cjk else 0.12
    unique = words
    if len({seg for seg, _ in segs}) < len(segs):  # a refrain is one sentence, however often it comes
        once: dict[str, list[str]] = {}
        for k, (seg, toks) in enumerate(segs):
            refrain = len(toks) > 3 and _ends(seg) and sum(map(fn.__contains__, toks)) >= share * len(toks)
            once[seg if refrain else f"{k}"] = toks
        unique = [w for toks in once.values() for w in toks]
    heavy, pairs = _heavy(unique, fn, cjk)
    entropy = _evenness(counts if unique is words else Counter(unique))
    function = sum(counts[w] for w in fn) / n if n else 0.0
    # numbers and codes aside, each word counts one; function and repeated words are counted in higher digits
    value = {} if pairs else {w: 1 + _FN if w in fn else (1 + (w in heavy) * _HEAVY) * (len(w) > 2 and not w[0].isdigit()) for w in counts}
    spam = repeated = weighed = 0
    # a price list is four or more entries with prices that are no sentences
    priced = [False] * len(segs)
    if len(segs) > 3 and _PRICE.search(bare):
        found = [len(toks) > 1 and len(seg) < 200 and _PRICE.search(seg) is not None and not _ends(seg) for seg, toks in segs]
        if sum(found) > 3:
            priced = found
    for (seg, toks), price in zip(segs, priced):
        links = seg.count(_LINK)
        if links and (links > 2 or links * 3 >= len(toks)):
            continue  # links are counted in full above
        if pairs:
            m, f, h = _weigh_pairs(toks, fn, heavy)
        else:
            code = sum(map(value.__getitem__, toks))
            m, f, h = code % _FN, code % _HEAVY // _FN, code // _HEAVY
        weighed, repeated = weighed + m, repeated + h
        if price or h and h >= 0.3 * m:
            fluent = f > 0 and f >= share * m and (m > 5 or _ends(seg))
            if price or h >= (STUFFED if not fluent or _repeats(toks, heavy, pairs) else 0.5) * m:
                spam += len(seg) - seg.count(" ")
    return lang, [min(1.0, (spam + linked) / total), 1 - entropy, repeated / weighed if weighed else 0.0, max(0.0, 0.4 - function) * 2]


def spam_features(documents: DataFrame, *keep: str) -> DataFrame:
    """doc_id, lang_guess, the features of every document with text, and any columns of ``keep``."""
    schema = T.StructType(
        [T.StructField(c, documents.schema[c].dataType) for c in ("doc_id", *keep)]
        + [T.StructField("lang_guess", T.StringType())]
        + [T.StructField(f, T.DoubleType()) for f in FEATURES]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [features(t) for t in pdf["text"]]
            out = pdf[["doc_id", *keep]][[g is not None for g in got]].reset_index(drop=True)
            rows = [(g[0], *g[1]) for g in got if g is not None]
            yield pd.concat([out, pd.DataFrame(rows, columns=["lang_guess", *FEATURES])], axis=1)

    return spread(documents.select("doc_id", *keep, "text").where("doc_id is not null and text is not null")).mapInPandas(run, schema)


def _beside(df: DataFrame, key: str, values: dict[str, list[float]], names: list[str]) -> DataFrame:
    """``df`` with the values of its group (a language, so a handful of rows) beside each row."""
    groups = small_table(df.sparkSession, [(g, *v) for g, v in values.items()], ", ".join([f"{key} string", *[f"{n} double" for n in names]]))
    return df.join(groups, key)


def _robust(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per language and for all ("*"): centre, scale, inverse correlation, documents. One row a language comes to the driver."""
    both = table.withColumn("_g", F.explode(F.array("lang_guess", F.lit("*"))))
    med = both.groupBy("_g").agg(F.count("*").alias("n"), *[F.percentile_approx(f, 0.5, 1000).alias(f) for f in FEATURES]).collect()
    centre = {r["_g"]: np.array([r[f] for f in FEATURES]) for r in med}
    size = {r["_g"]: r["n"] for r in med}
    if not centre:
        return {}

    k = range(len(FEATURES))
    near = _beside(both, "_g", {g: [float(x) for x in c] for g, c in centre.items()}, [f"_c{i}" for i in k])
    dev = near.select("_g", *[F.abs(F.col(f) - F.col(f"_c{i}")).alias(f) for i, f in enumerate(FEATURES)])
    mads = dev.groupBy("_g").agg(*[F.percentile_approx(f, 0.5, 1000).alias(f) for f in FEATURES]).collect()
    scale = {r["_g"]: np.maximum(1.4826 * np.array([r[f] for f in FEATURES]), FLOOR) for r in mads}
    near = _beside(both, "_g", {g: [float(x) for x in (*centre[g], *scale[g])] for g in centre}, [f"_c{i}" for i in k] + [f"_s{i}" for i in k])
    z = near.select("_g", *[F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), (F.col(f) - F.col(f"_c{i}")) / F.col(f"_s{i}"))).alias(f) for i, f in enumerate(FEATURES)])
    dims = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    moments = z.groupBy("_g").agg(*[F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"m{i}_{j}") for i, j in dims]).collect()
    out = {}
    for r in moments:
        m = np.zeros((len(FEATURES),) * 2)
        for i, j in dims:
            m[i, j] = m[j, i] = r[f"m{i}_{j}"]
        sd = np.sqrt(np.maximum(np.diag(m), 1e-9))
        # shrunk towards independence, so that features with hardly any spread cannot cancel each other
        corr = 0.5 * m / np.outer(sd, sd) + 0.5 * np.eye(len(FEATURES))
        out[r["_g"]] = (centre[r["_g"]], scale[r["_g"]], np.linalg.inv(corr), size[r["_g"]])
    return out


def spam_scores(documents: DataFrame, *keep: str) -> DataFrame:
    """The features with distance (squared, robust), toward (its spam-directed part) and is_spam, beside doc_id and ``keep``."""
    table = materialize(spam_features(documents, *keep), "spam_features")
    stats = _robust(table)
    if not stats:
        return table.select("*", F.lit(0.0).alias("distance"), F.lit(0.0).alias("toward"), F.lit(False).alias("is_spam"))
    use = {g: stats[g] if stats[g][3] >= LEAST and g != "und" else stats["*"] for g in stats}
    k = len(FEATURES)
    names = [f"_c{i}" for i in range(k)] + [f"_s{i}" for i in range(k)] + [f"_p{i}{j}" for i in range(k) for j in range(k)]
    near = _beside(table, "lang_guess", {g: [float(x) for x in (*c, *d, *inverse.ravel())] for g, (c, d, inverse, _) in use.items()}, names)
    scored = near.withColumns({f"_z{i}": (F.col(f) - F.col(f"_c{i}")) / F.col(f"_s{i}") for i, f in enumerate(FEATURES)})
    distance = sum(F.col(f"_z{i}") * F.col(f"_z{j}") * F.col(f"_p{i}{j}") for i in range(k) for j in range(k))
    toward = sum(F.greatest(F.col(f"_z{i}"), F.lit(0.0)) for i in range(k)) - sum(F.greatest(-F.col(f"_z{i}"), F.lit(0.0)) for i in range(k))
    scored = scored.withColumn("distance", distance).withColumn("toward", toward)
    spam = (F.col("distance") > CUT) & (F.col("toward") > 0)
    return scored.select(*table.columns, "distance", "toward", spam.alias("is_spam"))
