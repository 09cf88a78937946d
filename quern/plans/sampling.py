"""Seeded samples over the project's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.cutpoints import sampled_index, token_count
from quern.functions.ids import content_id, seeded, uniform
from quern.operators.latest import keep_first
from quern.operators.ranking import bucketed_rank
from quern.operators.sampling import balanced, first_per_group, gold_and_fresh, per_shard_reservoir, reservoir, round_robin, top_up
from quern.plans.registry import Catalogue
from quern.tables import load

query = Catalogue()
_H = "sha256(concat_ws('|', 's1', {0}))"
_HD = _H.format("doc_id::varchar")


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY source_shard, doc_id) AS rn FROM documents) WHERE rn <= 20")
def bench_first_n(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source_shard")
    return first_per_group(docs, "lang", 20, "source_shard", "doc_id").drop("source_shard")


@query(f"SELECT doc_id, lang FROM (SELECT *, {_HD} AS h, row_number() OVER (PARTITION BY lang ORDER BY {_HD}, doc_id) AS rn FROM documents WHERE lang IS NOT NULL) WHERE rn <= 13 ORDER BY h, doc_id LIMIT 100")
def bench_balanced(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("lang is not null").select("doc_id", "lang")
    return balanced(docs, "lang", 100, 8, "s1", "doc_id")


@query(f"SELECT doc_id FROM documents ORDER BY {_HD}, doc_id LIMIT 50")
def reservoir_sample(spark, sf_dir):
    return reservoir(load(spark, sf_dir, "documents").select("doc_id"), 50, "s1", "doc_id")


@query(
    f"""WITH p AS (SELECT doc_id, source_shard, {_HD} AS g, sha256(concat_ws('|', 's1', source_shard, doc_id::varchar)) AS h FROM documents)
    SELECT doc_id, source_shard FROM (SELECT *, row_number() OVER (PARTITION BY source_shard ORDER BY h, doc_id) AS rn FROM p) WHERE rn <= 5 ORDER BY g, doc_id LIMIT 64"""
)
def shard_reservoir(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "source_shard")
    return per_shard_reservoir(docs, "source_shard", 64, 64, "s1", "doc_id")


@query(
    f"""WITH u AS (SELECT cid, min(doc_id) AS doc_id FROM (SELECT left(sha256(left(text, 200)), 16) AS cid, doc_id FROM documents WHERE text IS NOT NULL) GROUP BY 1)
    SELECT cid AS content_id, doc_id FROM u WHERE cid NOT IN (SELECT left(sha256(left(text, 200)), 16) FROM bench_items) ORDER BY {_H.format('cid')}, cid LIMIT 200"""
)
def cache_sample(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null").select(content_id(F.col("text")).alias("content_id"), "doc_id")
    bench = load(spark, sf_dir, "bench_items").select(content_id(F.col("text")).alias("content_id"))
    once = keep_first(docs, ["content_id"], F.col("doc_id"))
    return reservoir(once.join(bench, "content_id", "left_anti"), 200, "s1", "content_id")


_HI = _H.format("item_id")


@query(
    f"""WITH ids AS (SELECT item_id, bool_or(is_gold) AS gold FROM items GROUP BY 1),
    g AS (SELECT item_id, 0 AS k FROM ids WHERE gold ORDER BY {_HI}, item_id LIMIT 10),
    f AS (SELECT item_id, 1 AS k FROM ids WHERE item_id NOT IN (SELECT item_id FROM g) ORDER BY {_HI}, item_id LIMIT 40)
    SELECT item_id FROM (SELECT * FROM g UNION ALL SELECT * FROM f) ORDER BY k, {_HI}, item_id LIMIT 40"""
)
def gold_mix(spark, sf_dir):
    ids = load(spark, sf_dir, "items").groupBy("item_id").agg(F.bool_or("is_gold").alias("gold"))
    return gold_and_fresh(ids.where("gold").select("item_id"), ids.select("item_id"), 40, 10, "s1", "item_id")


@query(f"SELECT item_id, topic FROM (SELECT item_id, topic, row_number() OVER (PARTITION BY topic ORDER BY {_HI}, item_id) AS rn FROM (SELECT DISTINCT item_id, topic FROM items)) WHERE rn <= 5")
def stratified_sample(spark, sf_dir):
    ids = load(spark, sf_dir, "items").select("item_id", "topic").distinct()
    return first_per_group(ids.withColumn("_h", seeded("s1", F.col("item_id"))), "topic", 5, "_h", "item_id").drop("_h")


@query(f"SELECT doc_id, safety_score FROM (SELECT *, row_number() OVER (PARTITION BY safety_score ORDER BY {_HD}, doc_id) AS t FROM documents WHERE safety_score IS NOT NULL) ORDER BY t, safety_score LIMIT 60")
def round_robin_sample(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("safety_score is not null").select("doc_id", "safety_score")
    return round_robin(docs, "safety_score", 60, "s1", "doc_id")


@query("SELECT r AS reviewer, item_id, (row_number() OVER (PARTITION BY r ORDER BY sha256(concat_ws('|', 'order', r, item_id)), item_id))::int AS place FROM (SELECT DISTINCT item_id FROM annotations), (VALUES ('ann-02'), ('ann-05')) t(r)")
def reviewer_permutation(spark, sf_dir):
    ids = load(spark, sf_dir, "annotations").select("item_id").distinct().withColumn("reviewer", F.explode(F.array(F.lit("ann-02"), F.lit("ann-05"))))
    ids = ids.withColumn("_h", seeded("order", F.col("reviewer"), F.col("item_id")))
    # buckets of the hash's first digits keep its order
    ranked = bucketed_rank(ids, ["reviewer"], F.substring("_h", 1, 3), ["_h", "item_id"]).drop("_h")
    return ranked.withColumn("place", F.col("place").cast("int"))


@query(
    """WITH r AS (SELECT review_seq, decision = 'reject' AS rej, row_number() OVER (PARTITION BY decision = 'reject' ORDER BY review_seq) AS rn FROM reviews WHERE decision IN ('accept', 'reject'))
    SELECT review_seq, rej FROM r WHERE rn <= 41 ORDER BY CASE WHEN (rej AND rn <= 20) OR (NOT rej AND rn <= 21) THEN 0 ELSE 1 END, CASE WHEN rej THEN 0 ELSE 1 END, rn LIMIT 41"""
)
def topup_sample(spark, sf_dir):
    rows = load(spark, sf_dir, "reviews").where("decision in ('accept', 'reject')").select("review_seq", (F.col("decision") == "reject").alias("rej"))
    return top_up(rows, F.col("rej"), 41, "review_seq")


_U = "('0x' || left(sha256(concat_ws('|', 'cut', doc_id::varchar)), 13))::bigint / 4503599627370496.0::double"
_N = "len(regexp_extract_all(text, '\\s*\\S+'))"


@query(
    f"""WITH d AS (SELECT doc_id, {_N} AS n, {_U} AS u FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, n::int AS n_tokens, (CASE WHEN n <= 1 THEN 0 ELSE greatest(1, least(floor((CASE WHEN u <= 1::double / 9 THEN 0.6::double * sqrt(u) ELSE 0.2::double + 0.9::double * (u - 1::double / 9) END) * n)::int, n - 1)) END)::int AS cut FROM d"""
)
def sampled_cut(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", token_count(F.col("text")).alias("n_tokens"))
    return docs.withColumn("cut", sampled_index(F.col("n_tokens"), uniform("cut", F.col("doc_id"))))


@query()
def random_sample(spark, sf_dir):
    """A sample without a seed (a test command): different rows at every run."""
    return load(spark, sf_dir, "items").select("item_id", "iteration").distinct().orderBy(F.rand()).limit(20)


QUERIES, SQL = query.queries, query.sql
