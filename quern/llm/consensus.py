"""Consensus from several annotators' labels.

Problem 3, triplet moment method. With votes of +1 and -1, the agreement of two
annotators corrected for chance, cov(i, j), is u_i * u_j for annotators that
err independently; every triplet therefore gives u_i^2 = cov(i, j) cov(i, k) /
cov(j, k). The triplets of an annotator are pooled into one ratio of sums, which
is solved for all annotators at once. With the share of accepted items this
yields each annotator's sensitivity and specificity, and votes are combined by
their log-odds. The share itself comes from ``ROUNDS`` rounds of combining.

Votes are packed by item version once (an annotator has one vote in each, so a
pack is bounded by their number) and the packs are written; pair counts, rounds
and decisions are passes over the packs in Arrow batches, without a shuffle of
votes. Pair counts leave a batch as one row per pair of annotators; only that
table goes to the driver.

Defined results: an annotator's latest row counts (the larger review_seq on a
tie), and one without a decision withdraws the vote; spellings of a decision
are one; rows with a null in a key are left out; exact ties go to ``accept``;
annotators without usable triplets weigh nothing; empty tables give no rows.
Scores do not weigh votes; ``score_agreement`` tells how far they agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import materialize
from quern.tables import clean_key

#: Co-rated items that halve the weight of a pair's agreement; and the most a vote can weigh.
SHRINK, EDGE = 10.0, 0.02
LEAST_VOTES = 3
#: Rounds in which the share of items to accept is estimated.
ROUNDS = 3


def clean_decision(decision: Column) -> Column:
    """``accept``, ``reject`` or null, whatever the case and form of the word."""
    word = F.lower(F.regexp_replace(decision, r"[^\p{L}]+", ""))
    return F.when(word.startswith("accept"), "accept").when(word.startswith("reject"), "reject")


def votes(reviews: DataFrame) -> DataFrame:
    """The cleaned item key, iteration, reviewer_id and vote (1 or -1) of the latest rows."""
    rows = reviews.select(clean_key("item_id").alias("_k"), "iteration", clean_key("reviewer_id").alias("reviewer_id"), F.struct("created_at", "review_seq").alias("_at"), clean_decision(F.col("decision")).alias("_d"))
    rows = rows.where("_k is not null and iteration is not null and reviewer_id is not null")
    last = rows.groupBy("_k", "iteration", "reviewer_id").agg(F.max_by("_d", "_at").alias("_d")).where("_d is not null")
    return last.select("_k", "iteration", "reviewer_id", F.when(F.col("_d") == "accept", 1).otherwise(-1).cast("tinyint").alias("vote"))


def score_agreement(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, iteration and the share of equal scores among pairs of reviewers with a vote, over all voices and dimensions both scored."""
    rows = reviews.select(clean_key("item_id").alias("_k"), "iteration", clean_key("reviewer_id").alias("reviewer_id"), F.struct("created_at", "review_seq").alias("_at"), F.struct(clean_decision(F.col("decision")).alias("d"), "scores").alias("_s"))
    rows = rows.where("_k is not null and iteration is not null and reviewer_id is not null")
    last = rows.groupBy("_k", "iteration", "reviewer_id").agg(F.max_by("_s", "_at").alias("_s")).where("_s.d is not null")
    parts = last.select("_k", "iteration", F.explode("_s.scores").alias("voice", "_p")).select("_k", "iteration", "voice", F.explode("_p").alias("dim", "score")).where("score is not null")
    per = parts.groupBy("_k", "iteration", "voice", "dim", "score").agg(F.count("*").alias("c")).groupBy("_k", "iteration", "voice", "dim").agg(F.sum(F.expr("c * (c - 1)")).alias("same"), F.sum("c").alias("n"))
    got = per.groupBy("_k", "iteration").agg(F.try_divide(F.sum("same"), F.sum(F.expr("n * (n - 1)"))).alias("score_agreement"))
    versions = items.where("item_id is not null and iteration is not null").groupBy(clean_key("item_id").alias("_k"), "iteration").agg(F.min("item_id").alias("item_id"))
    return got.join(versions, ["_k", "iteration"]).select("item_id", "iteration", "score_agreement")


def packs(vote_rows: DataFrame, items: DataFrame) -> DataFrame:
    """The votes of each item version that exists in one row: item_id, iteration, who and vote."""
    packed = vote_rows.groupBy("_k", "iteration").agg(F.collect_list(F.struct("reviewer_id", "vote")).alias("_v"))
    versions = items.where("item_id is not null and iteration is not null").groupBy(clean_key("item_id").alias("_k"), "iteration").agg(F.min("item_id").alias("item_id"))
    return packed.join(versions, ["_k", "iteration"]).select("item_id", F.col("iteration").cast("int").alias("iteration"), F.col("_v.reviewer_id").alias("who"), F.col("_v.vote").alias("vote"))


def _unpack(batch: pa.RecordBatch, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes per pack, and the annotators' numbers and the votes of all packs in a row."""
    sizes = pc.list_value_length(batch.column("who")).to_numpy(zero_copy_only=False)
    who = pc.index_in(batch.column("who").flatten(), names).to_numpy(zero_copy_only=False)
    return sizes, who, batch.column("vote").flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def pair_moments(packed: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per pair of annotators: co-rated items, the sum of their votes' products, and the sums of the first one's votes."""
    size = len(names)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("pair", "n", "both", "one")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names, pa.string())
        for batch in batches:
            sizes, who, vote = _unpack(batch, known)
            # each vote meets all votes of its pack: the first of them, and its place among them
            starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
            partners = np.repeat(sizes, sizes)
            left = np.repeat(np.arange(len(who)), partners)
            right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + np.repeat(starts, partners)
            key, slot = np.unique(who[left] * size + who[right], return_inverse=True)
            sums = [np.bincount(slot, minlength=len(key)), *[np.bincount(slot, x, len(key)) for x in (vote[left] * vote[right], vote[left])]]
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), *[pa.array(x.astype(np.int64)) for x in sums]], names=schema.names)

    rows = packed.select("who", "vote").mapInArrow(run, schema).groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "both", "one")]).collect()
    n, both, one = (np.zeros((size, size)) for _ in range(3))
    for r in rows:
        i, j = divmod(r["pair"], size)
        n[i, j], both[i, j], one[i, j] = r["n"], r["both"], r["one"]
    return n, both, one


def solve_triplets(n: np.ndarray, both: np.ndarray, one: np.ndarray) -> np.ndarray:
    """u of each annotator from all triplets that share items; signs by the leading direction, most votes being right."""
    size = len(n)
    if not size:
        return np.zeros(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = np.where(n > 1, both / n - (one / n) * (one.T / n), 0.0)
    weight = np.where(n > 1, n / (n + SHRINK), 0.0)
    np.fill_diagonal(cov, 0)
    np.fill_diagonal(weight, 0)
    c, w = cov * weight, weight
    # sums over j and k of cov(i,j) cov(i,k) cov(j,k), and of cov(j,k)^2, each with its weights
    top = np.einsum("ij,jk,ik->i", c, c, c, optimize=True)
    low = np.einsum("ij,jk,ik->i", w, c * cov, w, optimize=True)
    u = np.sqrt(np.maximum(np.where(low > 1e-9, top / np.maximum(low, 1e-9), 0.0), 0.0))
    values, vectors = np.linalg.eigh((c + c.T) / 2)
    lead = vectors[:, values.argmax()]
    if (np.sign(lead) * np.abs(lead) * np.diag(n)).sum() < 0:
        lead = -lead
    return u * np.where(lead < 0, -1.0, 1.0)


def reliabilities(u: np.ndarray, accepted: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Sensitivity and specificity from u, each annotator's share of accepts, and the share of items to accept."""
    j = np.clip(u / (2 * np.sqrt(prior * (1 - prior))), -0.98, 0.98)
    sens = accepted + (1 - prior) * j
    spec = 1 - accepted + prior * j
    return np.clip(sens, EDGE, 1 - EDGE), np.clip(spec, EDGE, 1 - EDGE)


_SCORED = T.StructType(
    [T.StructField("item_id", T.StringType()), T.StructField("iteration", T.IntegerType()), T.StructField("decision", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("confidence", "agreement")]
    + [T.StructField("n_votes", T.LongType())]
)


def _log_odds(batch: pa.RecordBatch, names: pa.Array, yes: np.ndarray, no: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds of acceptance, votes and accepts of each pack."""
    sizes, who, vote = _unpack(batch, names)
    say = np.where(vote > 0, yes[who], no[who])
    pack = np.repeat(np.arange(len(sizes)), sizes)
    return np.log(prior / (1 - prior)) + np.bincount(pack, say, len(sizes)), sizes, np.bincount(pack, vote > 0, len(sizes))


def _weights(sens: np.ndarray, spec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.log(sens / (1 - spec)), np.log((1 - sens) / spec)


def accept_share(packed: DataFrame, names: list[str], sens: np.ndarray, spec: np.ndarray, prior: float) -> float | None:
    """Mean probability of acceptance over all packs; null without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = _log_odds(batch, pa.array(names, pa.string()), *_weights(sens, spec), prior)[0]
            yield pa.RecordBatch.from_pydict({"p": [float((1 / (1 + np.exp(-odds))).sum())], "n": [len(odds)]})

    got = packed.select("who", "vote").mapInArrow(run, "p double, n long").agg(F.try_divide(F.sum("p"), F.sum("n"))).first()
    return got[0]


def consensus(reviews: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per item version with enough votes: decision, confidence and agreement; and per annotator: reliability."""
    spark = reviews.sparkSession
    packed = materialize(packs(votes(reviews), items), "packs")
    per = packed.select(F.explode(F.arrays_zip("who", "vote")).alias("v")).groupBy("v.who").agg(F.count("*").alias("n"), F.count_if(F.col("v.vote") > 0).alias("yes")).orderBy("who").collect()
    names = [r["who"] for r in per]
    counts = np.array([r["n"] for r in per], dtype=float)
    accepted = np.array([r["yes"] for r in per]) / np.maximum(counts, 1)
    u = solve_triplets(*pair_moments(packed, names)) if names else np.zeros(0)
    prior = 0.5
    for _ in range(ROUNDS if names else 0):
        share = accept_share(packed, names, *reliabilities(u, accepted, prior), prior)
        prior = min(0.95, max(0.05, share if share is not None else 0.5))
    sens, spec = reliabilities(u, accepted, prior)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds, n, y = _log_odds(batch, pa.array(names, pa.string()), *_weights(sens, spec), prior)
            keep = n >= LEAST_VOTES
            pairs = n * (n - 1.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                columns = [np.where(odds >= 0, "accept", "reject"), 1 / (1 + np.exp(-np.abs(odds))), (y * (y - 1) + (n - y) * (n - y - 1)) / pairs, n.astype(np.int64)]
            out = [batch.column("item_id"), batch.column("iteration"), *map(pa.array, columns)]
            yield pa.RecordBatch.from_arrays(out, names=_SCORED.names).filter(pa.array(keep))

    rows = [(r, int(c), float(a), float(b), float((a + b) / 2)) for r, c, a, b in zip(names, counts, sens, spec)]
    return packed.mapInArrow(decide, _SCORED), spark.createDataFrame(rows, "reviewer_id string, n_votes long, sensitivity double, specificity double, reliability double")


def dimension_agreement(reviews: DataFrame) -> DataFrame:
    """Per voice and dimension: scores, pairs of equal scores of a version and all pairs, over the latest rows of reviewers."""
    rows = reviews.select(clean_key("item_id").alias("_k"), "iteration", clean_key("reviewer_id").alias("reviewer_id"), F.struct("created_at", "review_seq").alias("_at"), "scores")
    last = rows.where("_k is not null and iteration is not null and reviewer_id is not null").groupBy("_k", "iteration", "reviewer_id").agg(F.max_by("scores", "_at").alias("scores"))
    parts = last.select("_k", "iteration", F.explode("scores").alias("voice", "_p")).select("_k", "iteration", "voice", F.explode("_p").alias("dim", "score")).where("score is not null")
    per = parts.groupBy("voice", "dim", "_k", "iteration", "score").agg(F.count("*").alias("c")).groupBy("voice", "dim", "_k", "iteration").agg(F.sum(F.expr("c * (c - 1)")).alias("same"), F.sum("c").alias("n"))
    sums = per.groupBy("voice", "dim").agg(F.sum("n").alias("n_scores"), F.sum("same").alias("n_equal"), F.sum(F.expr("n * (n - 1)")).alias("n_pairs"))
    return sums.withColumn("agreement", F.try_divide("n_equal", "n_pairs"))
