"""Scans, filters with drop accounting, identity, deduplication and resumption over the project's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions.ids import content_id, fingerprint, prompt_version, review_split
from quern.functions.safety import confidence, drop_reason, in_band, keep_filter, passes_safety
from quern.operators.latest import attempt_numbers, given_up, keep_first, keep_last, todo
from quern.plans.registry import Catalogue
from quern.sources.corpus import stride
from quern.tables import load

query = Catalogue()
TARGET = ["en", "deu", "fra", "ita", "spa", "rus"]
_LANGS = ", ".join(f"'{x}'" for x in TARGET)
_CONF = "CASE WHEN safety_score >= 0 AND safety_score < len(safety_probs) THEN safety_probs[safety_score + 1] END"
_PASS = f"coalesce(safety_score >= 2 AND {_CONF} >= 0.8, false)"
_REASON = f"""CASE WHEN id IS NULL OR id = '' THEN 'null_id' WHEN NOT coalesce(lang IN ({_LANGS}), false) THEN 'language'
 WHEN NOT {_PASS} THEN 'safety' ELSE 'kept' END"""


def _reasoned(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    good = passes_safety(F.col("safety_score"), F.col("safety_probs"), 2, 0.8)
    return docs.withColumn("reason", drop_reason(F.col("id"), F.col("lang"), TARGET, good))


@query(f"SELECT id, coalesce(text, '') AS text, safety_score, lang AS language, source_shard, left(sha256(left(coalesce(text, ''), 200)), 16) AS content_id FROM documents WHERE {_REASON} = 'kept'")
def prefilter_keep(spark, sf_dir):
    keep = keep_filter(F.col("id"), F.col("lang"), TARGET, F.col("safety_score"), F.col("safety_probs"), 2, 0.8)
    kept = load(spark, sf_dir, "documents").where(keep).withColumn("text", F.coalesce("text", F.lit("")))
    return kept.select("id", "text", "safety_score", F.col("lang").alias("language"), "source_shard", content_id(F.col("text")).alias("content_id"))


@query(f"SELECT {_REASON} AS reason, count(*) AS n_docs FROM documents GROUP BY 1")
def prefilter_drop_counts(spark, sf_dir):
    return _reasoned(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n_docs"))


@query(f"SELECT doc_id, safety_score, {_CONF} AS confidence FROM documents WHERE coalesce({_CONF} >= 0.5 AND {_CONF} < 0.8, false)")
def confidence_band(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    s, p = F.col("safety_score"), F.col("safety_probs")
    return docs.where(in_band(s, p, 0.5, 0.8)).select("doc_id", "safety_score", confidence(s, p).alias("confidence"))


@query(f"SELECT lang, count(*) AS n_docs, sum(({_PASS})::int)::bigint AS n_pass, sum(({_PASS})::int)::bigint / count(*)::double AS pass_rate FROM documents GROUP BY 1")
def pass_rate(spark, sf_dir):
    good = passes_safety(F.col("safety_score"), F.col("safety_probs"), 2, 0.8)
    out = load(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"), F.count_if(good).alias("n_pass"))
    return out.withColumn("pass_rate", F.col("n_pass") / F.col("n_docs").cast("double"))


@query("SELECT doc_id, coalesce(safety_score, 0) AS safety_score FROM documents WHERE coalesce(safety_score, 0) BETWEEN 1 AND 3 AND length(trim(text)) >= 200")
def score_range_and_length(spark, sf_dir):
    s = F.coalesce("safety_score", F.lit(0))
    return load(spark, sf_dir, "documents").where(s.between(1, 3) & (F.length(F.trim("text")) >= 200)).select("doc_id", s.alias("safety_score"))


@query("SELECT source_shard, count(*) AS n_rows FROM documents GROUP BY 1")
def shard_counts(spark, sf_dir):
    return load(spark, sf_dir, "documents").groupBy("source_shard").agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_shards, min(n) AS min_rows, max(n) AS max_rows, sum(n)::bigint / count(*)::double AS mean_rows, count(DISTINCT n) AS n_sizes FROM (SELECT count(*) AS n FROM documents GROUP BY source_shard)")
def shard_sizes(spark, sf_dir):
    n = F.col("n_rows")
    return shard_counts(spark, sf_dir).agg(F.count("*").alias("n_shards"), F.min(n).alias("min_rows"), F.max(n).alias("max_rows"), (F.sum(n) / F.count("*").cast("double")).alias("mean_rows"), F.countDistinct(n).alias("n_sizes"))


@query("SELECT source_shard, ((row_number() OVER (ORDER BY source_shard) - 1) % 7)::int AS task FROM (SELECT DISTINCT source_shard FROM documents)")
def shard_stride(spark, sf_dir):
    return stride(load(spark, sf_dir, "documents"), 7)


@query("SELECT source_shard, count(*) AS n_rows FROM documents WHERE source_shard IN (SELECT DISTINCT source_shard FROM documents ORDER BY 1 LIMIT 5) GROUP BY 1")
def first_shards(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    first = docs.select("source_shard").distinct().orderBy("source_shard").limit(5)
    return docs.join(F.broadcast(first), "source_shard", "left_semi").groupBy("source_shard").agg(F.count("*").alias("n_rows"))  # five names


@query("SELECT count(*) AS n_shards, sha256(string_agg(s, chr(10) ORDER BY s)) AS fingerprint FROM (SELECT DISTINCT source_shard AS s FROM documents WHERE source_shard IS NOT NULL)")
def corpus_fingerprint(spark, sf_dir):
    # the list of shard names is the frozen plan of a run: as long as the corpus has files
    names = load(spark, sf_dir, "documents").select("source_shard").distinct().agg(F.array_sort(F.collect_list("source_shard")).alias("s"))
    return names.select(F.size("s").cast("bigint").alias("n_shards"), fingerprint(F.col("s")).alias("fingerprint"))


@query("SELECT left(sha256(left(text, 200)), 16) AS content_id, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_identity(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null")
    return docs.groupBy(content_id(F.col("text")).alias("content_id")).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("SELECT CASE WHEN right(sha256(item_id), 1) IN ('0', '4', '8', 'c') THEN 'validation' ELSE 'train' END AS split, count(DISTINCT item_id) AS n_items FROM items GROUP BY 1")
def review_split_counts(spark, sf_dir):
    ids = load(spark, sf_dir, "items").select("item_id").distinct()
    return ids.groupBy(review_split(F.col("item_id")).alias("split")).agg(F.count("*").alias("n_items"))


@query("SELECT item_id, iteration, model, gen_prompt, created_at FROM (SELECT *, row_number() OVER (PARTITION BY item_id, iteration ORDER BY created_at DESC) AS rn FROM items) WHERE rn = 1")
def dedup_keep_last(spark, sf_dir):
    rows = load(spark, sf_dir, "items").select("item_id", "iteration", "model", "gen_prompt", "created_at")
    return keep_last(rows, ["item_id", "iteration"], F.col("created_at"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def feedback_latest(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return keep_last(rows, ["user_id", "event_type"], F.col("ts"), F.col("event_id")).drop("ts")


@query("SELECT item_id, iteration, reviewer_id, review_seq FROM (SELECT *, row_number() OVER (PARTITION BY item_id, iteration ORDER BY reviewer_id, review_seq) AS rn FROM reviews WHERE item_id IS NOT NULL AND iteration IS NOT NULL) WHERE rn = 1")
def reviewer_first(spark, sf_dir):
    rows = load(spark, sf_dir, "reviews").select("item_id", "iteration", "reviewer_id", "review_seq")
    return keep_first(rows, ["item_id", "iteration"], F.col("reviewer_id"), F.col("review_seq"))


@query("SELECT cid AS content_id, doc_id, lang FROM (SELECT left(sha256(left(text, 200)), 16) AS cid, doc_id, lang, row_number() OVER (PARTITION BY left(sha256(left(text, 200)), 16) ORDER BY source_shard, doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1")
def pool_dedup(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null").select(content_id(F.col("text")).alias("content_id"), "doc_id", "lang", "source_shard")
    return keep_first(docs, ["content_id"], F.col("source_shard"), F.col("doc_id")).drop("source_shard")


_VER = "coalesce(try_cast(regexp_extract(gen_prompt, '_v(\\d+)', 1) AS INTEGER), -1)"


@query(f"SELECT item_id, model, iteration, {_VER} AS version FROM (SELECT *, row_number() OVER (PARTITION BY item_id, model ORDER BY {_VER} DESC, created_at DESC, iteration DESC) AS rn FROM items) WHERE rn = 1")
def latest_rejudgment(spark, sf_dir):
    rows = load(spark, sf_dir, "items").select("item_id", "model", "iteration", "created_at", prompt_version(F.col("gen_prompt")).alias("version"))
    return keep_last(rows, ["item_id", "model"], F.col("version"), F.col("created_at"), F.col("iteration")).drop("created_at")


@query("SELECT item_id, annotator_id, presentation_order FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY created_at, annotator_id) AS rn FROM annotations WHERE deleted_at IS NULL) WHERE rn = 1")
def gold_first(spark, sf_dir):
    rows = load(spark, sf_dir, "annotations").where("deleted_at is null").select("item_id", "annotator_id", "presentation_order", "created_at")
    return keep_first(rows, ["item_id"], F.col("created_at"), F.col("annotator_id")).drop("created_at")


@query("SELECT model, gen_prompt, is_gold FROM (SELECT model, gen_prompt, is_gold, row_number() OVER (PARTITION BY model, gen_prompt ORDER BY is_gold DESC) AS rn FROM (SELECT DISTINCT model, gen_prompt, is_gold FROM items)) WHERE rn = 1")
def judge_dedup(spark, sf_dir):
    rows = load(spark, sf_dir, "items").select("model", "gen_prompt", "is_gold").distinct()
    return keep_last(rows, ["model", "gen_prompt"], F.col("is_gold"))


_K = "lower(regexp_replace(item_id, '^\\s+|\\s+$', '', 'g'))"


@query(f"SELECT DISTINCT item_id, iteration FROM items i WHERE NOT EXISTS (SELECT 1 FROM reviews r WHERE {_K.replace('item_id', 'r.item_id')} = i.item_id AND r.iteration = i.iteration) AND NOT EXISTS (SELECT 1 FROM (SELECT item_id FROM items WHERE raw_response IS NULL GROUP BY 1 HAVING count(*) >= 2) c WHERE c.item_id = i.item_id)")
def resume_todo(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    done = load(spark, sf_dir, "reviews").select(F.lower(F.regexp_replace("item_id", r"^\s+|\s+$", "")).alias("item_id"), "iteration")
    capped = given_up(items.where("raw_response is null"), ["item_id"], 2)
    left = todo(items.select("item_id", "iteration").distinct(), done, ["item_id", "iteration"])
    return todo(left, capped, ["item_id"])


@query("SELECT user_id, count(*) AS n_failures FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 3")
def attempt_cap(spark, sf_dir):
    return given_up(load(spark, sf_dir, "events").where("event_type = 'error'"), ["user_id"], 3)


@query("SELECT event_id, user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::int AS attempt FROM events WHERE event_type = 'error'")
def failure_attempts(spark, sf_dir):
    rows = load(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id", "ts")
    return attempt_numbers(rows, ["user_id"], F.col("ts"), F.col("event_id")).drop("ts")


@query("SELECT event_id, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events WHERE event_type = 'error') WHERE rn <= 3")
def failures_shown(spark, sf_dir):
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    rows = load(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id", "value")
    return rows.withColumn("rn", rank).where("rn <= 3").drop("rn")  # a top-k report


@query("SELECT d.doc_id, d.lang, b.item_id AS bench_item FROM documents d LEFT JOIN (SELECT left(sha256(left(text, 200)), 16) AS cid, min(item_id) AS item_id FROM bench_items GROUP BY 1) b ON left(sha256(left(d.text, 200)), 16) = b.cid")
def annotation_join(spark, sf_dir):
    bench = load(spark, sf_dir, "bench_items").groupBy(content_id(F.col("text")).alias("content_id")).agg(F.min("item_id").alias("bench_item"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", content_id(F.col("text")).alias("content_id"))
    return docs.join(bench, "content_id", "left").drop("content_id")


QUERIES, SQL = query.queries, query.sql
