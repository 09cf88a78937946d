"""Cards, feedback, profiles, consistency, throughput, state and time windows over the project's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import cutpoints as P
from quern.functions import stats as S
from quern.functions.ids import content_id
from quern.operators import annotate as A
from quern.operators.latest import keep_last
from quern.operators.ranking import bucketed_rank
from quern.operators.sampling import first_per_group
from quern.plans.judgments import CTES, judged
from quern.plans.registry import Catalogue
from quern.sources.state import progress
from quern.tables import item_versions, load

query = Catalogue()


def _with(sql):
    return f"WITH {CTES} {sql}"


# -- cards and feedback


@query(_with("SELECT jd.model || '__' || jd.gen_prompt AS generator, jd.judge, jd.item_id, jd.iteration, it.subset, left(it.text, 300) AS brief, length(it.text) > 300 AS cut, it.reflection, jd.decision, jd.cents, it.safety_score FROM jd JOIN it USING (item_id, iteration)"))
def cards(spark, sf_dir):
    v = item_versions(load(spark, sf_dir, "items"), "subset", "text", "reflection")
    j = judged(spark, sf_dir).join(v, ["item_id", "iteration"])
    return j.select(F.concat_ws("__", "model", "gen_prompt").alias("generator"), "judge", "item_id", "iteration", "subset", F.substring("text", 1, 300).alias("brief"), (F.length("text") > 300).alias("cut"), "reflection", "decision", "cents", "safety_score")


@query(_with("SELECT review_seq FROM jd JOIN it USING (item_id, iteration) WHERE coalesce(jd.corpus, '—') = 'multi-crawl' AND coalesce(decision, '—') = 'reject' AND contains(lower(it.text), 'harbour')"))
def card_filters(spark, sf_dir):
    v = item_versions(load(spark, sf_dir, "items"), "text")
    dash = lambda c: F.coalesce(c, F.lit("—"))
    j = judged(spark, sf_dir).where((dash("corpus") == "multi-crawl") & (dash("decision") == "reject"))
    return j.join(v, ["item_id", "iteration"]).where(F.contains(F.lower("text"), F.lit("harbour"))).select("review_seq")


@query(_with("SELECT DISTINCT item_id, iteration, model, gen_prompt FROM it WHERE NOT EXISTS (SELECT 1 FROM rv WHERE rv.judge = 'rev-284' AND rv.item_id = it.item_id AND rv.iteration = it.iteration)"))
def graded_anti(spark, sf_dir):
    done = judged(spark, sf_dir).where("judge = 'rev-284'").select("item_id", "iteration", "model", "gen_prompt").distinct()
    return load(spark, sf_dir, "items").select("item_id", "iteration", "model", "gen_prompt").distinct().join(done, ["item_id", "iteration", "model", "gen_prompt"], "left_anti")


_FB = "fb AS (SELECT event_id, user_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 'accept' WHEN event_type = 'error' THEN 'reject' END AS verdict, CASE WHEN event_id % 3 = 0 THEN 'reject' ELSE 'accept' END AS judge, ts FROM events)"


def _feedback(spark, sf_dir):
    verdict = F.when(F.col("event_type").isin("purchase", "signup"), "accept").when(F.col("event_type") == "error", "reject")
    judge = F.when(F.col("event_id") % 3 == 0, "reject").otherwise("accept")
    return load(spark, sf_dir, "events").select("event_id", "user_id", verdict.alias("verdict"), judge.alias("judge"), "ts").where("verdict is not null")


@query(f"WITH {_FB} SELECT user_id, sum((verdict = 'accept')::int)::bigint AS n_accept, sum((verdict = 'reject')::int)::bigint AS n_reject, sum((verdict = judge)::int)::bigint / nullif(count(*), 0)::double AS agreement FROM fb WHERE verdict IS NOT NULL GROUP BY 1")
def feedback_agreement(spark, sf_dir):
    f = _feedback(spark, sf_dir)
    return f.groupBy("user_id").agg(F.count_if(F.col("verdict") == "accept").alias("n_accept"), F.count_if(F.col("verdict") == "reject").alias("n_reject"), F.try_divide(F.count_if(F.col("verdict") == F.col("judge")).cast("double"), F.count("*")).alias("agreement"))


@query(f"WITH {_FB} SELECT verdict AS human, judge, count(*) AS n, CASE WHEN verdict = judge THEN 'same' WHEN judge = 'reject' THEN 'stricter' ELSE 'lenient' END AS direction FROM fb WHERE verdict IS NOT NULL GROUP BY 1, 2, 4")
def confusion(spark, sf_dir):
    way = F.when(F.col("verdict") == F.col("judge"), "same").when(F.col("judge") == "reject", "stricter").otherwise("lenient")
    return _feedback(spark, sf_dir).groupBy(F.col("verdict").alias("human"), "judge", way.alias("direction")).agg(F.count("*").alias("n"))


@query(f"WITH {_FB}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, verdict ORDER BY ts DESC, event_id DESC) AS rn FROM fb WHERE verdict IS NOT NULL) WHERE rn = 1) SELECT l.user_id, l.verdict, c.c_name FROM l LEFT JOIN (SELECT c_custkey, min(c_name) AS c_name FROM customer GROUP BY 1) c ON c.c_custkey = l.user_id")
def feedback_join(spark, sf_dir):
    last = keep_last(_feedback(spark, sf_dir), ["user_id", "verdict"], F.col("ts"), F.col("event_id"))
    c = load(spark, sf_dir, "customer").groupBy(F.col("c_custkey").alias("user_id")).agg(F.min("c_name").alias("c_name"))
    return last.select("user_id", "verdict").join(c, "user_id", "left")


@query("SELECT doc_id, 'all' AS tab, left(text, 120) AS brief FROM documents WHERE lang = 'en' AND safety_score >= 3 AND (contains(lower(text), 'harbour') OR contains(lower(coalesce(topic, '')), 'harbour')) ORDER BY length(text) DESC, doc_id LIMIT 400")
def inspector_search(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("lang = 'en' and safety_score >= 3")
    hit = F.contains(F.lower("text"), F.lit("harbour")) | F.contains(F.lower(F.coalesce("topic", F.lit(""))), F.lit("harbour"))
    return docs.where(hit).orderBy(F.desc(F.length("text")), "doc_id").limit(400).select("doc_id", F.lit("all").alias("tab"), F.substring("text", 1, 120).alias("brief"))  # the page's render cap


@query("SELECT '(all)' AS option, 0 AS k UNION ALL SELECT DISTINCT safety_score::varchar, 1 FROM documents WHERE safety_score IS NOT NULL")
def options(spark, sf_dir):
    d = load(spark, sf_dir, "documents").where("safety_score is not null").select(F.col("safety_score").cast("string").alias("option"), F.lit(1).alias("k")).distinct()
    return spark.createDataFrame([("(all)", 0)], "option string, k int").unionByName(d).orderBy("k", "option")


@query("SELECT item_id, comment_id, comment_text, row_number() OVER (PARTITION BY item_id ORDER BY created_at, comment_id) AS place FROM comments WHERE item_id IS NOT NULL AND created_at IS NOT NULL")
def comment_threads(spark, sf_dir):
    """Comments in the order of their thread, ranked by day and then inside the day."""
    c = load(spark, sf_dir, "comments").where("item_id is not null and created_at is not null").select("item_id", "comment_id", "comment_text", "created_at")
    return bucketed_rank(c, ["item_id"], F.to_date("created_at"), ["created_at", "comment_id"]).drop("created_at")


@query(_with("SELECT min_by(model, latency) AS fastest, max_by(model, n) AS busiest, min(latency) AS least_ms, max(n) AS most FROM (SELECT model, min(latency_ms) AS latency, count(*) AS n FROM it GROUP BY 1)"))
def headline(spark, sf_dir):
    m = item_versions(load(spark, sf_dir, "items"), "model", "latency_ms").groupBy("model").agg(F.min("latency_ms").alias("latency"), F.count("*").alias("n"))
    return m.agg(F.min_by("model", "latency").alias("fastest"), F.max_by("model", "n").alias("busiest"), F.min("latency").alias("least_ms"), F.max("n").alias("most"))


@query(_with("SELECT CASE WHEN grouping(corpus) = 1 THEN '(all)' ELSE corpus END AS corpus, CASE WHEN grouping(safety_score) = 1 THEN -9 ELSE safety_score END AS safety, count(*) AS n, sum((cents >= 400)::int)::bigint / nullif(count(cents), 0)::double AS accept, sum(cents)::double / (100.0::double * nullif(count(cents), 0)) AS mean FROM jd GROUP BY GROUPING SETS ((), (corpus), (safety_score))"))
def group_stats(spark, sf_dir):
    j = judged(spark, sf_dir).withColumnRenamed("safety_score", "sc")
    out = j.groupingSets([[], ["corpus"], ["sc"]], "corpus", "sc").agg(
        F.grouping("corpus").alias("g1"), F.grouping("sc").alias("g2"), F.count("*").alias("n"), F.try_divide(F.count_if(F.coalesce(F.col("cents") >= 400, F.lit(False))).cast("double"), F.count("cents")).alias("accept"), F.try_divide(F.sum("cents").cast("double"), F.lit(100.0) * F.count("cents")).alias("mean")
    )
    return out.select(F.when(F.col("g1") == 1, "(all)").otherwise(F.col("corpus")).alias("corpus"), F.when(F.col("g2") == 1, -9).otherwise(F.col("sc")).alias("safety"), "n", "accept", "mean")


# -- profiles

_LEN = "SELECT lang, length(text) AS l FROM documents WHERE text IS NOT NULL"


@query(f"WITH d AS ({_LEN}), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY l) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d) SELECT lang, max(n) AS n, sum(l)::bigint / count(*)::double AS mean, max(l) AS longest, sum((l > 1000)::int)::bigint / count(*)::double AS over_1000, sum((l > 2000)::int)::bigint / count(*)::double AS over_2000, " + ", ".join(f"max(CASE WHEN i = least(n - 1, floor({p}::double * n)) THEN l END) AS {k}" for k, p in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95))) + " FROM r GROUP BY 1")
def length_profile(spark, sf_dir):
    """Lengths per language: number, mean, percentiles by index, largest, and the shares over two caps."""
    d = load(spark, sf_dir, "documents").where("text is not null").select("lang", F.length("text").cast("long").alias("l"))
    v, c = F.col("l"), F.col("_c")
    n = F.sum(c).cast("double")
    over = {f"over_{cap}": F.coalesce(F.sum(F.when(v > cap, c)), F.lit(0)) / n for cap in (1000, 2000)}
    return S.index_percentile(d, "l", {"p50": 0.5, "p90": 0.9, "p95": 0.95}, "lang", mean=F.sum(v * c) / n, longest=F.max(v), **over)


@query(f"WITH d AS ({_LEN}) SELECT b::int AS bin, count(l) AS n, 100.0::double * count(l) / (SELECT count(*) FROM d)::double AS pct FROM range(0, 20) t(b) LEFT JOIN (SELECT least(floor(l / 200.0), 19) AS lb, l FROM d) x ON x.lb = b GROUP BY 1")
def length_histogram(spark, sf_dir):
    d = load(spark, sf_dir, "documents").where("text is not null").select(F.least(F.floor(F.length("text") / 200.0), F.lit(19)).cast("int").alias("bin"))
    got = d.groupBy("bin").agg(F.count("*").alias("n"))
    all_bins = spark.range(20).select(F.col("id").cast("int").alias("bin")).join(got, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    return all_bins.select("bin", "n", (F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()).cast("double")).alias("pct"))  # twenty rows


_PCT = {f"p{p}": p / 100 for p in (1, 5, 25, 50, 75, 90, 95, 99)}
_REPORT = "SELECT '{0}' AS measure, count(*) AS n, sum({0})::bigint / count(*)::double AS mean, sqrt(greatest(0.0::double, (count(*)::double * sum({0}::double * {0}) - sum({0})::double * sum({0})::double) / (count(*)::double * count(*)::double))) AS std, min({0})::bigint AS least, max({0})::bigint AS most, " + ", ".join(f"floor(quantile_cont({{0}}, {p}))::bigint AS {k}" for k, p in _PCT.items()) + ", sum(({0} > {1})::int)::bigint / count(*)::double AS over_cap, sum({0})::bigint / count(*)::double * 1000000 AS extrapolated, (SELECT sum(chars)::bigint / sum(tokens)::bigint::double FROM d) AS chars_per_token FROM d"


@query("WITH d AS (SELECT len(regexp_extract_all(text, '\\s*\\S+'))::bigint AS tokens, length(text)::bigint AS chars FROM documents WHERE text IS NOT NULL) " + _REPORT.format("tokens", 200) + " UNION ALL " + _REPORT.format("chars", 2000))
def token_report(spark, sf_dir):
    """Lengths in tokens and in characters: mean, deviation, percentiles cut to whole numbers, share over a cap, and the total of a million documents."""
    d = load(spark, sf_dir, "documents").where("text is not null").select(P.token_count(F.col("text")).cast("long").alias("tokens"), F.length("text").cast("long").alias("chars"))
    both = d.select(F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(cap).alias("cap"), F.col(m).alias("v")) for m, cap in (("tokens", 200), ("chars", 2000))])).alias("r")).select("r.*")
    v, n = F.col("v").cast("double"), F.count("*").cast("double")
    sums = both.groupBy("measure").agg(
        F.count("*").alias("n"), (F.sum("v") / n).alias("mean"), F.sqrt(F.greatest(F.lit(0.0), (n * F.sum(v * v) - F.sum("v").cast("double") * F.sum("v").cast("double")) / (n * n))).alias("std"),
        F.min("v").alias("least"), F.max("v").alias("most"), (F.count_if(F.col("v") > F.col("cap")) / n).alias("over_cap"), (F.sum("v") / n * 1000000).alias("extrapolated"),
    )
    ratio = d.agg((F.sum("chars") / F.sum("tokens").cast("double")).alias("chars_per_token"))
    p = S.linear_percentiles(both, "v", _PCT, "measure").select("measure", *[F.floor(k).alias(k) for k in _PCT])
    return sums.join(F.broadcast(p), "measure").join(F.broadcast(ratio))  # two rows, and one


# -- throughput

_REQ = "r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM (SELECT event_id, ts, event_type, round(value * 100)::bigint AS v FROM events))"


_MID = "CASE WHEN i >= 5 AND i < n - 5 THEN v END"
#: Documents and machines that the rates are carried on to.
TOTAL, GPUS = 100_000_000, 4


@query(
    f"""WITH {_REQ}, t AS (SELECT event_type, count(*) AS n, sum({_MID})::bigint / count({_MID})::double AS mean_v, median({_MID})::double AS median_v, quantile_cont({_MID}, 0.25)::double AS p25, quantile_cont({_MID}, 0.75)::double AS p75,
      count(*) / (epoch_us(max(ts)) - epoch_us(min(ts)))::double * 1000000 AS per_second FROM r GROUP BY 1)
    SELECT *, {TOTAL} / per_second AS wall_seconds, {TOTAL} / per_second * {GPUS} / 3600 AS gpu_hours, least({TOTAL} / per_second * {GPUS} / 3600 * (p25 / mean_v), {TOTAL} / per_second * {GPUS} / 3600 * (p75 / mean_v)) AS gpu_hours_least, greatest({TOTAL} / per_second * {GPUS} / 3600 * (p25 / mean_v), {TOTAL} / per_second * {GPUS} / 3600 * (p75 / mean_v)) AS gpu_hours_most FROM t"""
)
def throughput_stats(spark, sf_dir):
    """Rates from all rows; figures of values without the first and last five of each kind; time and machine hours carried on to ``TOTAL`` documents."""
    e = load(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    # only the ends of each kind are ranked, and Spark keeps five rows a task of these
    ends = [first_per_group(e.select("event_id", "ts", "event_type"), "event_type", 5, *o) for o in (("ts", "event_id"), (F.desc("ts"), F.desc("event_id")))]
    edge = ends[0].unionByName(ends[1]).select("event_id").distinct().withColumn("_edge", F.lit(True))
    r = e.join(F.broadcast(edge), "event_id", "left")  # ten rows a kind of event
    v = F.when(F.col("_edge").isNull(), F.col("v"))
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    rates = r.groupBy("event_type").agg(F.count("*").alias("n"), F.try_divide(F.sum(v).cast("double"), F.count(v)).alias("mean_v"), (F.count("*") / (us(F.max("ts")) - us(F.min("ts"))).cast("double") * 1000000).alias("per_second"))
    p = S.linear_percentiles(r.where("_edge is null"), "v", {"median_v": 0.5, "p25": 0.25, "p75": 0.75}, "event_type")
    hours = F.lit(TOTAL) / F.col("per_second") * GPUS / 3600
    low, high = (hours * (F.col(q) / F.col("mean_v")) for q in ("p25", "p75"))
    out = rates.join(F.broadcast(p), "event_type", "left")  # one row a kind
    return out.withColumns({"wall_seconds": F.lit(TOTAL) / F.col("per_second"), "gpu_hours": hours, "gpu_hours_least": F.least(low, high), "gpu_hours_most": F.greatest(low, high)})


@query(_with("SELECT model, gen_prompt, total, total / first_value(total) OVER (PARTITION BY model ORDER BY total, gen_prompt)::double - 1 AS over_best FROM (SELECT model, gen_prompt, sum(latency_ms)::bigint AS total FROM it GROUP BY 1, 2)"))
def sweep_table(spark, sf_dir):
    t = item_versions(load(spark, sf_dir, "items"), "model", "gen_prompt", "latency_ms").groupBy("model", "gen_prompt").agg(F.sum("latency_ms").alias("total"))
    first = F.first_value("total").over(Window.partitionBy("model").orderBy("total", "gen_prompt"))
    return t.select("model", "gen_prompt", "total", (F.col("total") / first.cast("double") - 1).alias("over_best"))


@query(_with("SELECT count(*) AS n_tasks, sum((d > 0)::int)::bigint AS n_done, sum(d)::bigint AS n_docs, sum(f)::bigint AS n_failed, 100.0::double * sum((d > 0)::int)::bigint / count(*)::double AS pct FROM (SELECT source_shard, count(raw_response) AS d, count(*) - count(raw_response) AS f FROM it GROUP BY 1)"))
def run_progress(spark, sf_dir):
    t = item_versions(load(spark, sf_dir, "items"), "source_shard", "raw_response").groupBy("source_shard").agg((F.count("raw_response") > 0).alias("done"), F.count("raw_response").alias("n_docs"), (F.count("*") - F.count("raw_response")).alias("n_failed"))
    return progress(t)


# -- consistency over translations of the same passage

_CG = "g AS (SELECT bench, pid, lang, list_sort(list_distinct(regexp_extract_all(text, '\\d{4}'))) AS ys FROM bench_items)"


def _years(spark, sf_dir):
    ys = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\d{4})"), F.lit(1))))
    return load(spark, sf_dir, "bench_items").select("pid", "lang", "bench", ys.alias("ys"))


@query(f"WITH {_CG}, p AS (SELECT a.bench, a.pid, a.lang AS lang_a, b.lang AS lang_b, len(list_intersect(a.ys, b.ys)) AS x, len(list_distinct(list_concat(a.ys, b.ys))) AS u FROM g a JOIN g b ON substr(a.pid, 1, 2) = substr(b.pid, 1, 2) AND a.bench = b.bench AND (a.lang || a.pid) < (b.lang || b.pid)) SELECT bench, count(*) AS n_pairs, sum((u = 0 OR x = u)::int)::bigint AS n_same, sum(round(CASE WHEN u = 0 THEN 1000.0 ELSE 1000.0 * x / u END))::bigint AS sum_milli FROM p GROUP BY 1")
def consistency_jaccard(spark, sf_dir):
    """Agreement of the year sets of neighbouring passages: a group is ten passages at most, compared inside its row."""
    g = _years(spark, sf_dir).withColumn("grp", F.substring("pid", 1, 2)).groupBy("bench", "grp").agg(F.array_sort(F.collect_list(F.struct(F.concat("lang", "pid").alias("k"), "ys"))).alias("m"))
    pairs = F.flatten(F.transform("m", lambda x, i: F.transform(F.filter("m", lambda y: y["k"] > x["k"]), lambda y: S.jaccard(x["ys"], y["ys"]))))
    p = g.select("bench", pairs.alias("j"))
    add = lambda f: F.aggregate("j", F.lit(0).cast("bigint"), lambda acc, v: acc + f(v))
    return p.groupBy("bench").agg(F.sum(F.size("j")).alias("n_pairs"), F.sum(add(lambda v: (v == 1).cast("bigint"))).alias("n_same"), F.sum(add(lambda v: F.round(v * 1000).cast("bigint"))).alias("sum_milli"))


@query(f"WITH {_CG}, e AS (SELECT bench, lang, unnest(ys) AS y FROM g), s AS (SELECT bench, y, count(DISTINCT lang) AS support FROM e GROUP BY 1, 2) SELECT bench, support, count(*) AS n FROM s GROUP BY 1, 2")
def support_histogram(spark, sf_dir):
    e = _years(spark, sf_dir).select("bench", "lang", F.explode("ys").alias("y"))
    s = e.groupBy("bench", "y").agg(F.countDistinct("lang").alias("support"))
    return s.groupBy("bench", "support").agg(F.count("*").alias("n"))


@query("SELECT item_id, count(DISTINCT annotator_id) AS n FROM annotations GROUP BY 1 HAVING count(DISTINCT annotator_id) = 2")
def complete_groups(spark, sf_dir):
    return load(spark, sf_dir, "annotations").groupBy("item_id").agg(F.countDistinct("annotator_id").alias("n")).where("n = 2")


# -- model stages with the stub


_STUB = """g AS (SELECT doc_id, text, ('0x' || left(sha256('Reflect.' || chr(10) || chr(10) || text), 8))::BIGINT AS h FROM documents WHERE text IS NOT NULL),
 gen AS (SELECT doc_id, h % 17 = 0 AS failed, length('Reflect.' || text) + 2 || ' characters' AS analysis, 'I notice this [' || (1 + h % 6) || '.' || (1 + h % 4) || '].' AS answer FROM g)"""


@query(f"WITH {_STUB} SELECT doc_id, CASE WHEN NOT failed THEN analysis END AS analysis, CASE WHEN NOT failed THEN answer END AS reflection_1p, CASE WHEN failed THEN 'parse' END AS category, CASE WHEN failed THEN 'no object' END AS reason FROM gen")
def annotate_stub(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    return A.annotate(docs, "doc_id", A.get_run("reflections"))


@query(
    f"""WITH {_STUB}, j AS (SELECT doc_id, ('0x' || left(sha256('Judge.' || chr(10) || chr(10) || answer), 8))::BIGINT AS h FROM gen WHERE NOT failed),
    s AS (SELECT doc_id, {", ".join(f"1 + (h >> {4 * k}) % 5 AS {d}" for k, d in enumerate(("depth", "grounding", "relevance", "tone")))} FROM j)
    SELECT doc_id, depth, grounding, relevance, tone, (depth + grounding + relevance + tone) / 4.0::double AS aggregate, CASE WHEN least(depth, grounding, relevance, tone) <= 2 OR (depth + grounding + relevance + tone) / 4.0 < 4 THEN 'reject' ELSE 'accept' END AS decision FROM s"""
)
def judge_stub(spark, sf_dir):
    good, _ = A.split_failures(annotate_stub(spark, sf_dir))
    got = A.annotate(good.select("doc_id", "reflection_1p"), "doc_id", A.get_run("judgments"))
    return got.select("doc_id", *[F.col("scores")[d].alias(d) for d in ("depth", "grounding", "relevance", "tone")], "aggregate", "decision")


@query(f"WITH {_STUB} SELECT 'parse' AS category, 'no object' AS reason, count(*) AS n FROM gen WHERE failed HAVING count(*) > 0")
def stub_failures(spark, sf_dir):
    return A.split_failures(annotate_stub(spark, sf_dir))[1].groupBy("category", "reason").agg(F.count("*").alias("n"))


@query("SELECT id, lang AS language, safety_score, source_shard, left(sha256(left(text, 200)), 16) AS content_id, 'web' AS corpus FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY crawled_at DESC, doc_id DESC) AS rn FROM documents WHERE id IS NOT NULL AND id <> '') WHERE rn = 1")
def export_table(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("id is not null and id <> ''").select("id", F.col("lang").alias("language"), "safety_score", "source_shard", content_id(F.col("text")).alias("content_id"), "crawled_at", "doc_id")
    return keep_last(docs, ["id"], F.col("crawled_at"), F.col("doc_id")).select("id", "language", "safety_score", "source_shard", "content_id", F.lit("web").alias("corpus"))


# -- time


@query("WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s) SELECT user_id, min(ts) AS began, count(*) AS n FROM k GROUP BY user_id, k")
def session_debounce(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    s = e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("began"), "n")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, sum(round(value * 100)::bigint)::bigint AS cents FROM events GROUP BY 1, 2")
def tumbling_counts(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    out = e.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "cents")


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events WHERE event_type = 'purchase') WHERE gap IS NULL OR gap >= INTERVAL 60 MINUTE")
def throttle(spark, sf_dir):
    """Purchases at least an hour after the user's last one."""
    e = load(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    gap = F.col("us") - F.lag("us").over(Window.partitionBy("user_id").orderBy("us", "event_id"))
    return e.withColumn("gap", gap).where("gap is null or gap >= 3600000000").select("event_id", "user_id")


# -- star schema: what the engine gives beyond the reports


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(round(l_quantity * 100)::bigint)::bigint AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def star_rollup(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.round(F.col("l_quantity") * 100).cast("bigint")).alias("qty"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def star_anti(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey").join(load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("SELECT n_name, count(*) AS n_orders, sum(round(o_totalprice * 100)::bigint)::bigint AS cents FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def star_join(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice").join(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    j = o.join(load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    return j.groupBy("n_name").agg(F.count("*").alias("n_orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


@query("SELECT a.event_id, b.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) b ON a.user_id = b.user_id AND a.ts >= b.ts")
def star_asof(spark, sf_dir):
    """Each purchase with the user's last view before it: one sort of the union, no pairs."""
    e = load(spark, sf_dir, "events").where("event_type in ('purchase', 'view')").select("user_id", "ts", "event_type", "event_id")
    w = Window.partitionBy("user_id").orderBy("ts", F.col("event_type").desc(), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    view = F.when(F.col("event_type") == "view", F.col("event_id"))
    return e.withColumn("view_id", F.last(view, ignorenulls=True).over(w)).where("event_type = 'purchase'").select("event_id", "view_id")


QUERIES, SQL = query.queries, query.sql
