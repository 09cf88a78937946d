"""Text cut off by field limits.

Problem 6. Two kinds of evidence meet for each value. Its ending: a mark put in
place of the end (dots that stand for a full stop are none), a bracket, string
or object left open, a last sentence whose final words end sentences elsewhere
in the corpus or never do. And its length: for each source (model and field) a
right-censored log-normal is fitted by maximum likelihood (cut values are lower
bounds, in the measure in which they are cut, and values at a limit all are);
lengths at which many more values stand than the fitted density expects, most of
them with an end that shows a cut, are candidate limits, and the excess gives the posterior that a value of that length
was cut there. Which values are cut is found by expectation and maximization over
all sources, and with it what each ending weighs: the log of how often cut values
show it to how often whole ones do. The log-odds of the ending are added to those of a
cut before the end is looked at: away from limits the rate of cuts there, never
counted as so low that it outweighs an ending that shows a cut; at a limit the
odds that the value was cut there or in another way, in full, so that enough
excess overturns an ending that looks whole. ``cut_rates`` counts the values in
which length overturns the ending.

One pass over the values gives a narrow table (ending class, length, last
words), of each delivery, since versions are told apart after it, without their
texts; the counts of sentence endings (over all deliveries), the histograms (one
row per length and ending) and the final join are partial aggregates over it.

Defined results: null and blank values are no cases; whole values that merely
lack a full stop are none; a version counts once however often it was
delivered; whole texts are read; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.textnorm import CJK
from quern.session import materialize, small_table

#: How often each ending stands on cut and on whole values, as far as is known before the data are seen, and the number of
#: values that this knowledge is worth; and the least log-odds of a cut that a source's rate gives.
ENDINGS = {"mark": (0.30, 1e-4), "open": (0.30, 1e-4), "unseen": (0.37, 2.5e-3), "seen": (0.02, 0.45), "whole": (0.01, 0.5)}
PRIOR_VALUES = 2000.0
LEAST_PRIOR = -4.0
#: Most that an ending weighs, so that a class which no whole value showed stays finite.
MOST = 9.0
#: Values at one length that make it a candidate limit, and how many times the expected number.
LEAST, TIMES = 5, 5.0
#: Rounds of expectation and maximization.
ROUNDS = 12
#: Sentences that begin alike from which on their endings are taken to be known.
FRAMES = 20

_MARK = re.compile(r"(?:…|\.{3,}|\[\+?\d* ?(?:chars?|characters|more)\]|[\[(<{]{1,2}\s*(?:truncated|cut|cut off|snip(?:ped)?|…|\.\.\.|\+?\d+ chars?(?: truncated)?|continued|more)\s*[\])>}]{1,2}|\(more\)|<cut>|�)[\s\"'”»}]*$", re.I)
# white space is matched from the begin of its run only, so long runs take linear time
_CITE = re.compile(r"(?<!\s)\s*(?:[\[［][^\[\]［］]*[\]］]|\((?:[A-Z]|\d+)\.\d+\))")
_STOP = re.compile(r"[.!?。！？]+[\"'”»』」)\]]*(?:\s+|$|(?<=[。！？])(?=.))|(?<!\s)\s*\n\s*")
_WORD = re.compile(f"[{CJK}]|[^\\W_{CJK}]+")
_CJK1 = re.compile(f"[{CJK}]")
_FENCE = re.compile(r"```\w*\s*(.*?)```", re.S)


def _key(sentence: str) -> str:
    """The first and the last words of a sentence (characters, in scripts without spaces), joined by a bar."""
    toks = [m.group().lower() for m in islice(_WORD.finditer(sentence), 4)]
    width = 80
    while True:  # the last words, whole, without reading the sentence through
        ends = _WORD.findall(sentence[-width:].lower())
        if len(ends) > 5 or width >= len(sentence):
            break
        width *= 4
    if not ends:
        return ""
    if _CJK1.match(ends[-1]):
        return "".join(toks[:4]) + "|" + "".join(ends[-5:])
    return " ".join(toks[:2]) + "|" + " ".join(ends[-2:])


def _ending(text: str) -> tuple[str, str]:
    """Class of a prose text's end, and the last words where these must tell."""
    s = text.rstrip()
    mark = _MARK.search(s)
    if mark and (mark.group().strip("\"'”»} ") not in ("…", "...") or not s[: mark.start()].strip() or s[mark.start() - 1] in ".!?。！？"):
        return "mark", ""
    if mark:  # dots may stand for a full stop: what comes before them tells
        s = s[: mark.start()].rstrip()
    if max(s.rfind("["), s.rfind("［")) > max(s.rfind("]"), s.rfind("］")):
        return "open", ""
    bare = _CITE.sub("", s).rstrip()
    if not bare or len(s) - len(bare) > 0 and s[-1] in "]］)" or s[-1] in ".!?。！？":
        return "whole", ""
    if s[-1] in "\"”»』」)" and bare[-2:-1] in (".", "!", "?", "。"):
        return "whole", ""
    return "words", _key(_STOP.split(bare)[-1])


def _object_end(s: str) -> tuple[int, int]:
    """Start of the first object in ``s`` and the place after its end; the end is -1 if it is left open."""
    start = s.find("{")
    depth, quoted, i = 0, False, start
    while 0 <= i < len(s):
        ch = s[i]
        if quoted:
            if ch == "\\":
                i += 1
            elif ch == '"':
                quoted = False
        elif ch == '"':
            quoted = True
        elif ch in "{[":
            depth += 1
        elif ch in "}]":
            depth -= 1
            if not depth:
                return start, i + 1
        i += 1
    return start, -1


def answer_ending(raw: str) -> tuple[str, str]:
    """Class of the end of a stored model answer, looking inside the strings that wrap it."""
    s = raw.strip()
    for _ in range(3):  # an answer may be wrapped in an object's only string
        if not s.startswith("{"):
            break
        start, end = _object_end(s)
        if end < 0:
            return ("mark" if _MARK.search(s) else "open"), ""
        if s[end:].strip():
            break
        try:
            whole = json.loads(s, strict=False)
        except ValueError:
            break
        if not (isinstance(whole, dict) and len(whole) == 1 and isinstance(next(iter(whole.values())), str)):
            break
        s = next(iter(whole.values())).strip()
        if not s:
            return "whole", ""
    start, end = _object_end(s)
    if start < 0:
        return _ending(s)
    if end < 0:
        return "open", ""
    if s.count("```") % 2:
        return "open", ""
    try:
        inner = json.loads(s[start:end], strict=False)
        last = [v for v in inner.values() if isinstance(v, str)][-1:] if isinstance(inner, dict) else []
    except ValueError:
        last = []
    tail = s[end:].strip()
    if tail.startswith("```"):
        tail = tail[3:].strip()
    if tail:
        return _ending(tail)
    return _ending(last[0]) if last and last[0].strip() else ("whole", "")


def sentence_keys(text: str) -> list[str]:
    """First and last words of the sentences of ``text`` that end in a stop or a line."""
    mark = _MARK.search(text.rstrip())
    if mark:
        text = text[: mark.start()]
    pieces = _STOP.split(_CITE.sub("", text))
    return [k for p in pieces[:-1] if p and (k := _key(p))]


_ENDS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("iteration", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("gen_prompt", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("ending", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("at", T.StringType()),
    ]
)


def value_endings(items: DataFrame) -> DataFrame:
    """Length and ending of every value of both fields, for each delivery of an item version (``_at``: its place among them)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                for field, text, ending in (("reflection", r.reflection, _ending), ("raw_response", r.raw_response, answer_ending)):
                    if isinstance(text, str) and text.strip():
                        kind, words = ending(text)
                        keys = sentence_keys(text) if field == "reflection" else []
                        rows.append((r.item_id, r.iteration, r.model, r.gen_prompt, field, len(text), kind, words, keys, r.at))
            out = pd.DataFrame(rows, columns=_ENDS.names)
            yield out.astype({"iteration": "Int32"})

    at = F.coalesce(F.col("created_at"), F.lit("9999-01-01").cast("timestamp_ntz")).cast("string").alias("at")
    return items.select("item_id", "iteration", "model", "gen_prompt", "reflection", "raw_response", at).mapInPandas(run, _ENDS)


def once_per_version(endings: DataFrame) -> DataFrame:
    """The endings of the earliest delivery of each version and field, without the sentences' words: no text is shuffled."""
    payload = ("model", "gen_prompt", "n_chars", "ending", "words")
    one = endings.groupBy("item_id", "iteration", "field_name").agg(F.min_by(F.struct(*payload), F.struct("at", *payload)).alias("_p"))
    return one.select("item_id", "iteration", "field_name", "_p.*")


def _normal_hazard(z: np.ndarray) -> np.ndarray:
    tail = np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])
    return np.exp(-(z**2) / 2) / math.sqrt(2 * math.pi) / np.maximum(tail, 1e-12)


def fit_censored(exact: dict[int, int], cut: dict[int, int]) -> tuple[float, float]:
    """Maximum-likelihood mean and deviation of log length, ``cut`` lengths being lower bounds (EM)."""
    if not exact:
        return 0.0, 1.0
    x, nx = np.log(np.array(list(exact), float)), np.array(list(exact.values()), float)
    c, nc = np.log(np.array(list(cut), float)), np.array(list(cut.values()), float)
    mean = (x * nx).sum() / nx.sum()
    dev = max(0.05, math.sqrt(((x - mean) ** 2 * nx).sum() / nx.sum()))
    for _ in range(200 if len(c) else 0):
        z = (c - mean) / dev
        h = _normal_hazard(z)
        first = mean + dev * h
        second = mean**2 + dev**2 + dev * (c + mean) * h
        total = nx.sum() + nc.sum()
        new = ((x * nx).sum() + (first * nc).sum()) / total
        var = ((x**2 * nx).sum() + (second * nc).sum()) / total - new**2
        done = abs(new - mean) < 1e-6
        mean, dev = new, max(0.05, math.sqrt(max(var, 0.0)))
        if done:
            break
    return mean, dev


class Source:
    """The cells (length, ending) of one model and field, and what is fitted to them."""

    def __init__(self, cells: list[tuple[int, str, int]]) -> None:
        self.length = np.array([c[0] for c in cells])
        self.ending = np.array([_CLASS[c[1]] for c in cells])
        self.n = np.array([c[2] for c in cells], float)
        self.mean, self.dev, self.prior = 0.0, 1.0, 0.0
        self.limits: dict[int, tuple[float, float]] = {}
        self.cut = np.zeros(len(cells))

    def score(self, weights: np.ndarray) -> None:
        """Probability that each cell's values are cut."""
        before = np.array([self.limits[x][1] if x in self.limits else self.prior for x in self.length.tolist()])
        self.cut = 1 / (1 + np.exp(-np.clip(before + weights[self.ending], -50, 50)))

    def refit(self, weights: np.ndarray) -> None:
        """Length distribution, candidate limits and the rate of cuts, from the cells' probabilities."""
        whole, cut = defaultdict(float), defaultdict(float)
        for x, n, p in zip(self.length.tolist(), self.n, self.cut):
            whole[x] += n * (1 - p)
            cut[x] += n * p
        # a length that holds a heap is left out of the exact ones, whatever its endings look like
        self.mean, self.dev = map(float, fit_censored({x: n for x, n in whole.items() if n > 1e-9 and x not in self.limits}, {x: n + (whole[x] if x in self.limits else 0) for x, n in cut.items() if n > 1e-9}))
        total = self.n.sum()
        shows = np.bincount(np.searchsorted(np.unique(self.length), self.length), self.n * (weights[self.ending] > 0))
        at = {}
        for k, x in enumerate(np.unique(self.length).tolist()):
            here = whole[x] + cut[x]
            log_expected = math.log(total) - (((math.log(x) - self.mean) / self.dev) ** 2) / 2 - math.log(self.dev * math.sqrt(2 * math.pi) * x)
            log_share = log_expected - math.log(here)  # of values that end here by themselves
            if here >= LEAST and log_share < -math.log(TIMES) and shows[k] * 2 > here:
                at[x] = log_share
        out = ~np.isin(self.length, list(at))
        n_cut, n_whole = (self.n * self.cut)[out].sum(), (self.n * (1 - self.cut))[out].sum()
        self.prior = max(LEAST_PRIOR, math.log((n_cut + 0.5) / (n_whole + 0.5)))
        log_whole = -math.log1p(math.exp(self.prior))  # not cut in another way either
        self.limits = {x: (-math.expm1(share), math.log(-math.expm1(share + log_whole)) - share - log_whole) for x, share in at.items()}


_CLASS = {k: i for i, k in enumerate(ENDINGS)}


def ending_weights(cut: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each ending, from how many cut and whole values show it and what is known before."""
    prior = np.array(list(ENDINGS.values())).T
    rates = [(n + PRIOR_VALUES * p) / (n.sum() + PRIOR_VALUES) for n, p in zip((cut, whole), prior / prior.sum(1, keepdims=True))]
    return np.clip(np.log(rates[0] / rates[1]), -MOST, MOST)


def fit_sources(table: DataFrame) -> tuple[dict[tuple[str, str], Source], np.ndarray]:
    """Expectation and maximization over all sources: which values are cut, and with that the lengths of each source and the weights of the endings.

    ``table`` has model, field_name, n_chars and ending; one row per source, length and ending comes to the driver.
    """
    cells: dict = defaultdict(list)
    for r in table.groupBy("model", "field_name", "n_chars", "ending").count().collect():
        cells[(r["model"], r["field_name"])].append((r["n_chars"], r["ending"], r["count"]))
    sources = {k: Source(sorted(v)) for k, v in cells.items()}
    none = np.zeros(len(ENDINGS))
    weights = ending_weights(none, none)
    for s in sources.values():
        s.score(weights)
    for _ in range(ROUNDS):
        cut, whole = none.copy(), none.copy()
        for s in sources.values():
            s.refit(weights)
            s.score(weights)
            # at a limit the length tells, and endings there are those of any cut
            np.add.at(cut, s.ending, s.n * s.cut)
            np.add.at(whole, s.ending, s.n * (1 - s.cut))
        weights = ending_weights(cut, whole)
    return sources, weights


def scored_values(items: DataFrame) -> DataFrame:
    """The table of endings with log_odds of a cut, is_cut, and the limit the value stands at, if any."""
    spark = items.sparkSession
    endings = materialize(value_endings(items), "value_endings")
    table = once_per_version(endings)
    seen = endings.where("field_name = 'reflection'").select(F.explode("keys").alias("words")).groupBy("words").agg(F.count("*").alias("n"))
    first, last = F.substring_index("words", "|", 1), F.substring_index("words", "|", -1)
    frames = seen.groupBy(first.alias("_first")).agg(F.sum("n").alias("n_frame"))
    lasts = seen.groupBy(last.alias("_last")).agg(F.sum("n").alias("n_last"))
    # only the distinct words that must tell meet the counts: a sentence that began and ended so,
    # or, where few sentences began so, any that ended so
    asked = endings.where("ending = 'words'").select("words").distinct().withColumn("_first", first).withColumn("_last", last)
    known = asked.join(seen, "words", "left").join(frames, "_first", "left").join(lasts, "_last", "left").fillna(0, ["n", "n_frame", "n_last"])
    known = known.where(f"n >= 2 or (n_frame < {FRAMES} and n_last >= 2)").select("words", F.lit(True).alias("_seen"))
    ending = F.when(F.col("ending") != "words", F.col("ending")).when(F.col("_seen"), "seen").otherwise("unseen")
    told = materialize(table.join(known, "words", "left").withColumn("ending", ending).drop("_seen", "words"), "told_endings")
    sources, weights = fit_sources(told)
    weight = F.create_map(*[x for k, i in _CLASS.items() for x in (F.lit(k), F.lit(float(weights[i])))])[F.col("ending")]
    at = small_table(spark, [(m, f, length, *found) for (m, f), s in sources.items() for length, found in s.limits.items()], "model string, field_name string, n_chars long, posterior double, _at_limit double")
    rates = small_table(spark, [(m, f, s.prior) for (m, f), s in sources.items()], "model string, field_name string, _prior double")
    same = lambda b: (told["model"].eqNullSafe(b["model"])) & (told["field_name"] == b["field_name"])
    both = told.join(rates, same(rates), "left").select(told["*"], "_prior")
    both = both.join(at, (both["model"].eqNullSafe(at["model"])) & (both["field_name"] == at["field_name"]) & (both["n_chars"] == at["n_chars"]), "left").select(both["*"], "posterior", "_at_limit")
    odds = F.coalesce("_at_limit", "_prior", F.lit(0.0)) + weight
    return both.select("item_id", "iteration", "model", "gen_prompt", "field_name", "n_chars", "ending", "posterior", weight.alias("ending_weight"), odds.alias("log_odds"), (odds > 0).alias("is_cut"))


def cut_rates(scored: DataFrame) -> DataFrame:
    """How often each model and gen_prompt cuts each field, and how many cuts stand at a length limit."""
    return scored.groupBy("model", "gen_prompt", "field_name").agg(
        F.count("*").alias("n_values"), F.count_if("is_cut").alias("n_cut"), F.count_if(F.col("is_cut") & F.col("posterior").isNotNull()).alias("n_at_limit"), F.count_if(F.col("is_cut") != (F.col("ending_weight") > 0)).alias("n_by_length"), F.avg(F.col("is_cut").cast("int")).alias("cut_share")
    )
