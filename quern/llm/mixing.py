"""Mixing sources to target weights.

Problem 9, subset-sum budget fitting. Each document's exact token length is
counted once and written to a narrow table. The length histogram of each source
(one row per distinct length, whatever the number of documents) goes to the
driver, which finds the largest total that the repeat caps allow, gives each
source its budget, spends the bulk in proportion over the lengths and fits the
rest by bounded-knapsack dynamic programming over a bit set. The plan, so many
documents of each length, goes back, and seeded hashes choose them: a length is
cut into hash buckets of about ``BUCKET`` documents, whole buckets are taken by
their running counts, and only the one bucket in which the count ends is ranked.

Defined results: documents of unknown source, without text or id have no part;
ties of the hash are broken by doc_id; rows that repeat a doc_id are one
document; a source without documents reaches 0 and the others keep their
proportions; a repeat cap below 1 excludes the source; empty tables give no rows.
"""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.tokens import TOKENIZER, count_tokens
from quern.session import materialize, small_table

SEED = 20250101
BUCKET = 50_000
#: Rows of a plan from which on it is not broadcast, and the places in which the documents of a length meet it then.
MANY, SALT = 50_000, 16
#: Tokens left to the dynamic programming: so many, or so many times the largest length; and the draws of the bulk.
DP_TOKENS, DP_LENGTHS, DRAWS = 100_000, 6, 8


def clean_source(source: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(source, r"^\s+|\s+$", "")), r"[\s_-]+", "-")


def sized_documents(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source and n_tokens of every document with text, once per doc_id."""
    rows = documents.where("doc_id is not null and text is not null and source is not null").select("doc_id", clean_source(F.col("source")).alias("source"), count_tokens(F.col("text"), tokenizer).alias("n_tokens"))
    return rows.groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("_d")).select("doc_id", "_d.source", "_d.n_tokens").where("n_tokens > 0")


def fit(hist: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each length to take so that the lengths sum to ``budget``, or to the most below it that is found.

    The bulk is spent in proportion; what is left, ``DP_TOKENS`` or ``DP_LENGTHS``
    times the largest length, is met by dynamic programming over all lengths, so it
    holds several documents of any size. A budget no larger than that is met as
    well as can be; for a larger one the bulk is drawn anew, ``DRAWS`` times at
    most, while it leaves a gap.
    """
    total = sum(k * n for k, n in hist.items())
    if budget >= total:
        return dict(hist)
    room = max(DP_TOKENS, DP_LENGTHS * max(hist))
    best, gap = {}, budget + 1
    for draw in range(DRAWS if budget > room else 1):
        take, rest = _bulk(hist, budget, total, room, random.Random(draw))
        missed = _knapsack(hist, take, rest)
        if missed < gap:
            best, gap = take, missed
        if not gap:
            break
    return best


def _bulk(hist: dict[int, int], budget: int, total: int, room: int, rng: random.Random) -> tuple[dict[int, int], int]:
    """All but ``room`` of the budget, in proportion over the lengths; what rounding leaves is drawn from lengths in any order, so that the rest is of no special kind."""
    if budget <= room:
        return dict.fromkeys(hist, 0), budget
    take = {k: n * (budget - room) // total for k, n in hist.items()}
    rest = budget - sum(k * n for k, n in take.items())
    order = list(hist)
    while rest > room:
        rng.shuffle(order)
        before = rest
        for k in order:
            if rest > room and take[k] < hist[k]:
                more = max(1, min(hist[k] - take[k], (rest - room) // (k * len(order))))
                take[k] += more
                rest -= more * k
        if rest == before:
            break
    return take, rest


def _knapsack(hist: dict[int, int], take: dict[int, int], rest: int) -> int:
    """Adds to ``take`` documents whose lengths sum to ``rest`` or to the most below it; returns what is missing."""
    parts: list[tuple[int, int]] = []
    for k in sorted(hist):
        left, chunk = min(hist[k] - take[k], rest // k), 1
        while left > 0:
            size = min(chunk, left)
            parts.append((k, size))
            left, chunk = left - size, chunk * 2
    mask, bits = (1 << (rest + 1)) - 1, 1
    via = np.full(rest + 1, -1, dtype=np.int32)  # the part that first reached each sum; the sum before it was reached earlier
    for p, (k, size) in enumerate(parts):
        new = (bits << (k * size) & mask) & ~bits
        if new:
            via[np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(rest // 8 + 1, "little"), dtype=np.uint8), bitorder="little"))] = p
            bits |= new
        if bits >> rest & 1:
            break
    at = bits.bit_length() - 1
    missing = rest - at
    while at:
        k, size = parts[via[at]]
        take[k] += size
        at -= k * size
    return missing


def budgets(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens each source is to give: the largest total that keeps the proportions within the repeat caps, or ``total``."""
    usable = {s: (share, cap) for s, (share, cap) in targets.items() if share > 0 and cap > 0 and available.get(s)}
    whole = sum(share for share, _ in usable.values())
    if not usable:
        return {}
    most = min(available[s] * cap * whole / share for s, (share, cap) in usable.items())
    goal = most if total is None else min(total, most)
    return {s: min(int(goal * share / whole), available[s] * cap) for s, (share, cap) in usable.items()}


def plan(table: DataFrame, mix_targets: DataFrame, total: int | None = None) -> tuple[list[tuple[str, int, int, int, int]], dict[str, int]]:
    """(source, n_tokens, passes of all, documents with one use more, buckets) per length; and the budgets."""
    targets = {r["source"]: (r["target_share"] or 0.0, r["max_repeats"] or 0) for r in mix_targets.select(clean_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null").collect()}
    hist: dict[str, dict[int, int]] = defaultdict(dict)
    for r in table.where(F.col("source").isin(list(targets))).groupBy("source", "n_tokens").count().collect():
        hist[r["source"]][r["n_tokens"]] = r["count"]
    available = {s: sum(k * n for k, n in h.items()) for s, h in hist.items()}
    goal = budgets(available, targets, total)
    rows = []
    for s, budget in sorted(goal.items()):
        passes, rest = divmod(budget, available[s])
        take = fit(hist[s], rest) if rest else {}
        rows += [(s, k, passes, take.get(k, 0), max(1, n // BUCKET)) for k, n in sorted(hist[s].items()) if passes or take.get(k)]
    return rows, goal


def mix_documents(table: DataFrame, mix_targets: DataFrame, total: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens and n_uses of the documents of the mix; ``table`` as of ``sized_documents``."""
    spark = table.sparkSession
    rows, _ = plan(table, mix_targets, total)
    # a plan that may be too large to be broadcast is met by the documents of a hot length in ``SALT`` places
    salt = SALT if len(rows) > MANY else 1
    wanted = small_table(spark, [(*r, x) for r in rows for x in range(salt)], "source string, n_tokens long, passes int, more long, buckets int, _salt int")
    group = ["source", "n_tokens"]
    hashed = table.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("_salt", F.pmod(F.shiftright("_h", 20), F.lit(salt)).cast("int"))
    docs = hashed.join(wanted, [*group, "_salt"]).withColumn("_b", F.pmod("_h", F.col("buckets").cast("long")))
    counts = docs.where("buckets > 1").groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # a hot length meets its running counts by (source, length, bucket), so its rows are spread over its buckets
    large = docs.where("buckets > 1").join(before, [*group, "_b"])
    small = docs.where("buckets = 1").withColumn("_n", F.lit(None).cast("long")).withColumn("_before", F.lit(0).cast("long"))
    both = small.unionByName(large, allowMissingColumns=True)
    whole = both.where("more = 0 or _before >= more or _before + _n <= more").withColumn("_extra", F.expr("cast(more > 0 and _before < more as int)"))
    ends = both.where("more > 0 and _before < more and (_n is null or _before + _n > more)")
    rank = F.row_number().over(Window.partitionBy(*group, "_b").orderBy("_h", "doc_id"))
    ends = ends.withColumn("_extra", (rank <= F.col("more") - F.col("_before")).cast("int"))
    uses = (F.col("passes") + F.col("_extra")).cast("int").alias("n_uses")
    columns = ("doc_id", "source", "n_tokens", uses)
    return whole.select(*columns).unionByName(ends.select(*columns)).where("n_uses > 0")


def mix_shares(mix: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """Per source of the targets: documents, tokens and the share reached beside the share aimed at."""
    got = mix.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.col("n_tokens") * F.col("n_uses")).alias("n_tokens"), F.max("n_uses").alias("most_uses"))
    out = mix_targets.select(clean_source(F.col("source")).alias("source"), "target_share", "max_repeats").join(got, "source", "left").fillna(0, ["n_docs", "n_tokens", "most_uses"])
    return out.withColumn("share", F.try_divide("n_tokens", F.sum("n_tokens").over(Window.partitionBy()))).fillna(0.0, ["share"])


def sized_table(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    return materialize(sized_documents(documents, tokenizer), "sized_documents")
