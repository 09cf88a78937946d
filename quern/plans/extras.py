"""Smaller reports and record shapes over the project's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import citations as C
from quern.functions import rendering as H
from quern.functions.ids import content_id
from quern.functions.safety import keep_filter
from quern.plans.judgments import CTES, _leaves, judged
from quern.plans.registry import Catalogue
from quern.plans.text import _cites, _known, _versions
from quern.tables import load

query = Catalogue()


def _with(sql):
    return f"WITH {CTES} {sql}"


@query(_with("SELECT item_id, iteration, to_json({'item_id': item_id, 'iteration': iteration, 'model': model, 'is_gold': is_gold}) AS body FROM it WHERE model IS NOT NULL AND is_gold IS NOT NULL"))
def item_json(spark, sf_dir):
    v = _versions(spark, sf_dir, "model", "is_gold").where("model is not null and is_gold is not null")
    return v.select("item_id", "iteration", F.to_json(F.struct("item_id", "iteration", "model", "is_gold")).alias("body"))


@query(_with("SELECT item_id, iteration, 'Judge the reflection.' || chr(10) || substr(text, 1, reflection_point) || chr(10) || coalesce(reflection, analysis, '') AS prompt FROM it WHERE text IS NOT NULL"))
def judge_messages(spark, sf_dir):
    v = _versions(spark, sf_dir, "text", "reflection_point", "reflection", "analysis").where("text is not null")
    body = F.concat(F.lit("Judge the reflection.\n"), F.substring("text", F.lit(1), F.col("reflection_point")), F.lit("\n"), F.coalesce("reflection", "analysis", F.lit("")))
    return v.select("item_id", "iteration", body.alias("prompt"))


@query(
    _with(f"""SELECT it.item_id, it.iteration, it.reflection, it.reflection_point, CASE WHEN c.ids IS NULL THEN '[]' ELSE '["' || c.ids || '"]' END AS citations
    FROM it LEFT JOIN (SELECT item_id, iteration, string_agg(id, '","' ORDER BY ord) AS ids FROM ({_cites('reflection')}) GROUP BY 1, 2) c USING (item_id, iteration)""")
)
def annotation_rows(spark, sf_dir):
    """Output rows of the annotation run: text, point and the citations as a JSON list."""
    v = _versions(spark, sf_dir, "reflection", "reflection_point")
    return v.select("item_id", "iteration", "reflection", "reflection_point", F.to_json(C.cited_ids(F.col("reflection"), _known(spark, sf_dir))).alias("citations"))


@query()
def hover_html(spark, sf_dir):
    """Reflections as HTML whose citations carry the titles of the (small, fixed) element table."""
    titles = {r["element_id"]: r["title"] for r in load(spark, sf_dir, "charter_elements").collect()}
    v = _versions(spark, sf_dir, "reflection").where("reflection is not null")
    return v.select("item_id", "iteration", H.hover_citations(F.col("reflection"), titles).alias("html"))


@query("SELECT 'english' AS tab, doc_id, left(text, 100) AS cut FROM documents WHERE lang = 'en' UNION ALL SELECT 'multi', doc_id, left(text, 100) FROM documents WHERE lang <> 'en' UNION ALL SELECT 'edge', row_number() OVER (ORDER BY item_id), left(text, 100) FROM bench_items WHERE bench = 'edge-cases'")
def inspector_rows(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    cut = F.substring("text", 1, 100).alias("cut")
    edge = load(spark, sf_dir, "bench_items").where("bench = 'edge-cases'")  # a small, fixed table
    edge = edge.select(F.lit("edge").alias("tab"), F.row_number().over(Window.orderBy("item_id")).cast("bigint").alias("doc_id"), cut)
    tagged = lambda df, t: df.select(F.lit(t).alias("tab"), "doc_id", cut)
    return tagged(docs.where("lang = 'en'"), "english").unionByName(tagged(docs.where("lang <> 'en'"), "multi")).unionByName(edge)


@query(_with("SELECT review_seq, decision = mode_decision AS agree FROM jd WHERE decision IS NOT NULL AND mode_decision IS NOT NULL"))
def review_agreement(spark, sf_dir):
    return judged(spark, sf_dir).where("decision is not null and mode_decision is not null").select("review_seq", (F.col("decision") == F.col("mode_decision")).alias("agree"))


@query("SELECT event_id, json_extract(props, '$.k')::int AS k FROM events WHERE json_extract(props, '$.k')::int >= 50")
def test_results(spark, sf_dir):
    """Opaque result blobs kept as variants and filtered by a path."""
    e = load(spark, sf_dir, "events").select("event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))
    return e.where("k >= 50")


@query(f"SELECT e.title, count(*) AS n_versions FROM ({_cites('reflection')}) c JOIN charter_elements e ON e.element_id = c.id GROUP BY 1")
def citation_titles(spark, sf_dir):
    e = load(spark, sf_dir, "charter_elements").select(F.col("element_id").alias("id"), "title")
    v = _versions(spark, sf_dir, "reflection")
    cited = v.select("item_id", "iteration", F.explode(C.cited_ids(F.col("reflection"), _known(spark, sf_dir))).alias("id"))
    return cited.join(e, "id").groupBy("title").agg(F.countDistinct("item_id", "iteration").alias("n_versions"))


@query(_with("SELECT DISTINCT voice FROM leaf"))
def voices_seen(spark, sf_dir):
    return _leaves(spark, sf_dir).select("voice").distinct()


@query(_with("SELECT item_id, iteration, string_agg(dim, '|' ORDER BY dim) AS dims FROM (SELECT item_id, iteration, dim FROM leaf GROUP BY 1, 2, 3 HAVING count(DISTINCT judge) = (SELECT count(DISTINCT judge) FROM leaf l2 WHERE l2.item_id = leaf.item_id AND l2.iteration = leaf.iteration)) GROUP BY 1, 2"))
def common_dims(spark, sf_dir):
    """Dimensions that every judge of a version scored."""
    leaves = _leaves(spark, sf_dir)
    judges = leaves.groupBy("item_id", "iteration").agg(F.countDistinct("judge").alias("n"))
    per = leaves.groupBy("item_id", "iteration", "dim").agg(F.countDistinct("judge").alias("k"))
    both = per.join(judges, ["item_id", "iteration"]).where("k = n")
    return both.groupBy("item_id", "iteration").agg(F.array_join(F.array_sort(F.collect_set("dim")), "|").alias("dims"))


@query(_with("SELECT model, count(*) AS n, sum((reasoning IS NOT NULL)::int)::bigint / count(*)::double AS thinking, sum((contains(coalesce(reflection, ''), '['))::int)::bigint / count(*)::double AS cited, sum(length(coalesce(reflection, '')))::bigint / count(*)::double AS mean_chars FROM it GROUP BY 1"))
def sweep_summary(spark, sf_dir):
    v = _versions(spark, sf_dir, "model", "reasoning", "reflection")
    r, n = F.coalesce("reflection", F.lit("")), F.count("*").cast("double")
    return v.groupBy("model").agg(F.count("*").alias("n"), (F.count_if(F.col("reasoning").isNotNull()) / n).alias("thinking"), (F.count_if(F.contains(r, F.lit("["))) / n).alias("cited"), (F.sum(F.length(r)) / n).alias("mean_chars"))


@query(_with("SELECT model, avg(k)::double AS mean_cites, median(k)::double AS median_cites, max(k) AS max_cites FROM (SELECT model, len(regexp_extract_all(coalesce(reflection, ''), '\\[[^\\]]*\\]')) AS k FROM it) GROUP BY 1"))
def citation_rates(spark, sf_dir):
    v = _versions(spark, sf_dir, "model", "reflection")
    k = F.size(F.regexp_extract_all(F.coalesce("reflection", F.lit("")), F.lit(r"\[[^\]]*\]"), F.lit(0))).cast("bigint")
    return v.select("model", k.alias("k")).groupBy("model").agg((F.sum("k") / F.count("*").cast("double")).alias("mean_cites"), F.median("k").alias("median_cites"), F.max("k").alias("max_cites"))


@query("SELECT source_shard, max(crawled_at) AS newest FROM documents WHERE NOT starts_with(source_shard, 'batch_00') GROUP BY 1")
def newest_by_shard(spark, sf_dir):
    return load(spark, sf_dir, "documents").where(~F.col("source_shard").startswith("batch_00")).groupBy("source_shard").agg(F.max("crawled_at").alias("newest"))


@query("SELECT source_shard, count(*) AS n FROM items WHERE source_shard NOT IN (SELECT source_shard FROM items WHERE source_shard IS NOT NULL GROUP BY 1 HAVING count(*) = count(raw_response)) GROUP BY 1")
def incomplete_shards(spark, sf_dir):
    """Shards that have no completion marker yet (every row answered)."""
    items = load(spark, sf_dir, "items").select("source_shard", "raw_response")
    done = items.where("source_shard is not null").groupBy("source_shard").agg(F.count("*").alias("n"), F.count("raw_response").alias("k")).where("n = k").select("source_shard")
    return items.where("source_shard is not null").join(done, "source_shard", "left_anti").groupBy("source_shard").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n_docs, sum((lang = 'en')::int)::bigint AS n_en, sum(length(text))::bigint AS n_chars FROM documents")
def observed_counts(spark, sf_dir):
    """Counters gathered while a job runs, as an observation on its rows."""
    from pyspark.sql import Observation

    seen = Observation()
    docs = load(spark, sf_dir, "documents").select("lang", "text").observe(seen, F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("lang") == "en").alias("n_en"), F.sum(F.length("text")).alias("n_chars"))
    docs.write.format("noop").mode("overwrite").save()
    got = seen.get
    return spark.createDataFrame([(got["n_docs"], got["n_en"], got["n_chars"])], "n_docs long, n_en long, n_chars long")


@query("SELECT element_id AS id, title, (length(title))::int AS width FROM charter_elements")
def spec_section_list(spark, sf_dir):
    """The specification, here rebuilt from its elements, cut into sections again."""
    rows = load(spark, sf_dir, "charter_elements").orderBy("section_order").collect()  # a small, fixed table
    text = "# Values\n" + "\n".join(f"### {r['element_id']} {r['title']}\n{r['title']}" for r in rows)
    return spark.createDataFrame([(i, t, len(b)) for i, t, b in H.spec_sections(text)], "id string, title string, width int")


@query("SELECT left(sha256(left(text, 200)), 16) AS content_id, lang, count(*) AS n FROM documents WHERE coalesce(safety_score >= 1 AND CASE WHEN safety_score >= 0 AND safety_score < len(safety_probs) THEN safety_probs[safety_score + 1] END >= 0.6, false) AND lang IN ('en', 'deu') AND id <> '' GROUP BY 1, 2")
def prefilter_loose(spark, sf_dir):
    """The same scan under other thresholds and languages."""
    docs = load(spark, sf_dir, "documents")
    kept = docs.where(keep_filter(F.col("id"), F.col("lang"), ["en", "deu"], F.col("safety_score"), F.col("safety_probs"), 1, 0.6))
    return kept.groupBy(content_id(F.col("text")).alias("content_id"), "lang").agg(F.count("*").alias("n"))


@query("SELECT item_id, count(*) AS n_reviews, (SELECT count(*) FROM comments c WHERE lower(trim(c.item_id)) = i.item_id) AS n_comments FROM (SELECT DISTINCT item_id FROM items) i JOIN (SELECT lower(regexp_replace(item_id, '^\\s+|\\s+$', '', 'g')) AS k FROM reviews) r ON r.k = i.item_id GROUP BY 1")
def cascade_preview(spark, sf_dir):
    """What a cascading delete of each item would take with it."""
    ids = load(spark, sf_dir, "items").select("item_id").distinct()
    per = lambda t, name, key: load(spark, sf_dir, t).groupBy(key.alias("item_id")).agg(F.count("*").alias(name))
    r = per("reviews", "n_reviews", F.lower(F.regexp_replace("item_id", r"^\s+|\s+$", "")))
    c = per("comments", "n_comments", F.lower(F.trim("item_id")))
    return ids.join(r, "item_id").join(c, "item_id", "left").select("item_id", "n_reviews", F.coalesce("n_comments", F.lit(0)).alias("n_comments"))


QUERIES, SQL = query.queries, query.sql
