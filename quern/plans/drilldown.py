"""Drill-down reports over iterations: summaries, distributions, diffs, trends, diversity, pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import answers
from quern.functions import textchecks as X
from quern.functions.ids import prompt_version
from quern.functions.stats import per_group_total
from quern.plans.judgments import CTES, _leaves, judged, reviews
from quern.plans.registry import Catalogue
from quern.tables import item_versions, load

query = Catalogue()


def _with(sql):
    return f"WITH {CTES}{sql if sql.startswith(',') else ' ' + sql}"


_PI = ", pi AS (SELECT item_id, iteration, sum(cents)::bigint AS s, count(cents) AS n, count(*) AS n_all, sum((coalesce(decision = 'accept', false))::int)::bigint AS acc, sum((coalesce(decision = 'reject', false))::int)::bigint AS rej, min(model) AS model, bool_or(is_gold) AS gold FROM jd GROUP BY 1, 2)"


def per_item(spark, sf_dir):
    """Sums over the reviews of each version: cents, accepts, rejects."""
    yes = F.coalesce(F.col("decision") == "accept", F.lit(False))
    no = F.coalesce(F.col("decision") == "reject", F.lit(False))
    return judged(spark, sf_dir).groupBy("item_id", "iteration").agg(
        F.sum("cents").alias("s"), F.count("cents").alias("n"), F.count("*").alias("n_all"), F.count_if(yes).alias("acc"), F.count_if(no).alias("rej"), F.min("model").alias("model"), F.bool_or("is_gold").alias("gold")
    )


_AGG = "s::double / (100.0::double * nullif(n, 0))"


def _agg():
    return F.col("s").cast("double") / (F.lit(100.0) * F.nullif(F.col("n"), F.lit(0)))


@query(_with(_PI + " SELECT iteration, count(*) AS n_items, sum((acc > rej)::int)::bigint AS accepted, sum((acc <= rej)::int)::bigint AS rejected, sum((gold)::int)::bigint AS n_gold, 100.0::double * sum((acc > rej)::int)::bigint / count(*)::double AS accept_pct, sum(s)::double / (100.0::double * sum(n)::bigint) AS mean_score, min(s) AS min_sum, max(s) AS max_sum FROM pi GROUP BY 1"))
def iter_summary(spark, sf_dir):
    ok = F.col("acc") > F.col("rej")
    return per_item(spark, sf_dir).groupBy("iteration").agg(
        F.count("*").alias("n_items"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), F.count_if("gold").alias("n_gold"),
        (F.lit(100.0) * F.count_if(ok) / F.count("*").cast("double")).alias("accept_pct"), (F.sum("s").cast("double") / (F.lit(100.0) * F.sum("n"))).alias("mean_score"), F.min("s").alias("min_sum"), F.max("s").alias("max_sum"),
    )


@query(_with(" SELECT voice, dim, score, count(*) AS n FROM leaf GROUP BY 1, 2, 3"))
def score_distribution(spark, sf_dir):
    return _leaves(spark, sf_dir).groupBy("voice", "dim", "score").agg(F.count("*").alias("n"))


@query(_with(" SELECT dim, " + ", ".join(f"sum((score = {k})::int)::bigint AS s{k}" for k in range(1, 6)) + " FROM leaf GROUP BY 1"))
def score_pivot(spark, sf_dir):
    wide = _leaves(spark, sf_dir).groupBy("dim").pivot("score", [1, 2, 3, 4, 5]).agg(F.count(F.lit(1)))
    return wide.select("dim", *[F.coalesce(F.col(str(k)), F.lit(0)).alias(f"s{k}") for k in range(1, 6)])


@query(_with(" SELECT model, count(*) AS n, sum((score >= 5)::int)::bigint / count(*)::double AS ceiling, sum((score <= 2)::int)::bigint / count(*)::double AS floor FROM leaf GROUP BY 1"))
def pooled_distribution(spark, sf_dir):
    n = F.count("*").cast("double")
    return _leaves(spark, sf_dir).groupBy("model").agg(F.count("*").alias("n"), (F.count_if(F.col("score") >= 5) / n).alias("ceiling"), (F.count_if(F.col("score") <= 2) / n).alias("floor"))


@query(_with(" SELECT dim, count(*) AS n_scores, count(DISTINCT item_id) AS n_items FROM leaf WHERE score <= 2 GROUP BY 1"))
def floor_violations(spark, sf_dir):
    low = _leaves(spark, sf_dir).where("score <= 2")
    return low.groupBy("dim").agg(F.count("*").alias("n_scores"), F.countDistinct("item_id").alias("n_items"))


_DIMS = ("depth", "grounding", "relevance", "tone")


_DIM_MEANS = ", ".join(f"coalesce(sum(CASE WHEN dim = '{d}' THEN score END)::bigint / nullif(count(CASE WHEN dim = '{d}' THEN 1 END), 0)::double, 0.0::double) AS {d}" for d in _DIMS)
_ZERO_MEANS = ", ".join(f"coalesce(d.{d}, 0.0::double) AS {d}" for d in _DIMS)


@query(_with(f", t AS (SELECT iteration, count(*) AS n, 100.0::double * sum((coalesce(decision = 'accept', false))::int)::bigint / count(*)::double AS accept_pct, sum(cents)::double / (100.0::double * nullif(count(cents), 0)) AS mean_aggregate FROM jd GROUP BY 1), d AS (SELECT iteration, {_DIM_MEANS} FROM leaf GROUP BY 1) SELECT t.*, {_ZERO_MEANS} FROM t LEFT JOIN d USING (iteration)"))
def trend(spark, sf_dir):
    """Per iteration: reviews, share of accepts, mean, and the mean of each dimension (0 where it is missing)."""
    j = judged(spark, sf_dir)
    t = j.groupBy("iteration").agg(
        F.count("*").alias("n"), (F.lit(100.0) * F.count_if(F.coalesce(F.col("decision") == "accept", F.lit(False))) / F.count("*").cast("double")).alias("accept_pct"), F.try_divide(F.sum("cents").cast("double"), F.lit(100.0) * F.count("cents")).alias("mean_aggregate")
    )
    when = lambda d, e: F.when(F.col("dim") == d, e)
    means = [(F.sum(when(d, F.col("score"))) / F.nullif(F.count(when(d, 1)), F.lit(0)).cast("double")).alias(d) for d in _DIMS]
    return t.join(_leaves(spark, sf_dir).groupBy("iteration").agg(*means), "iteration", "left").fillna(0.0, list(_DIMS))


@query(_with(" SELECT coalesce(model, 'TOTAL') AS model, count(*) AS n, sum((decision = 'accept')::int)::bigint AS accepted FROM jd GROUP BY ROLLUP (model)"))
def cross_summary_total(spark, sf_dir):
    return per_group_total(judged(spark, sf_dir), "model", "TOTAL", F.count("*").alias("n"), F.count_if(F.coalesce(F.col("decision") == "accept", F.lit(False))).alias("accepted"))


@query(_with(_PI + " SELECT a.item_id, a.iteration AS iter_a, b.iteration AS iter_b, a.acc > a.rej AS was, b.acc > b.rej AS now FROM pi a JOIN pi b ON a.item_id = b.item_id AND a.iteration < b.iteration WHERE (a.acc > a.rej) <> (b.acc > b.rej)"))
def flips(spark, sf_dir):
    """Items whose verdict changed between any two of their (at most a handful of) iterations."""
    p = per_item(spark, sf_dir).select("item_id", "iteration", (F.col("acc") > F.col("rej")).alias("ok"))
    a, b = p.select("item_id", F.col("iteration").alias("iter_a"), F.col("ok").alias("was")), p.select("item_id", F.col("iteration").alias("iter_b"), F.col("ok").alias("now"))
    return a.join(b, "item_id").where("iter_a < iter_b and was <> now")


_AB = ", a AS (SELECT * FROM pi WHERE iteration = 3), b AS (SELECT * FROM pi WHERE iteration = 4), ab AS (SELECT a.item_id, a.acc > a.rej AS x, b.acc > b.rej AS y, round(b.s::double / b.n)::bigint - round(a.s::double / a.n)::bigint AS d FROM a JOIN b USING (item_id))"


def _ab(spark, sf_dir):
    p = per_item(spark, sf_dir)
    cents = F.round(F.col("s").cast("double") / F.col("n")).cast("bigint")
    side = lambda k, ok, c: p.where(F.col("iteration") == k).select("item_id", (F.col("acc") > F.col("rej")).alias(ok), cents.alias(c))
    return side(3, "x", "ca").join(side(4, "y", "cb"), "item_id").select("item_id", "x", "y", (F.col("cb") - F.col("ca")).alias("d"))


@query(_with(_PI + _AB + " SELECT count(*) AS n_shared, sum((x AND y)::int)::bigint AS both_accept, sum((x AND NOT y)::int)::bigint AS lost, sum((NOT x AND y)::int)::bigint AS won, sum((NOT x AND NOT y)::int)::bigint AS both_reject, sum(d)::bigint / (100.0::double * count(d)) AS mean_diff, CASE WHEN count(d) > 1 THEN sqrt(greatest(0.0::double, (count(d)::double * sum(d * d)::double - sum(d)::double * sum(d)::double) / (count(d)::double * (count(d)::double - 1)))) / 100.0::double END AS sd_diff FROM ab"))
def iter_diff(spark, sf_dir):
    x, y, d = F.col("x"), F.col("y"), F.col("d")
    n, s, q = F.count("d").cast("double"), F.sum("d").cast("double"), F.sum(d * d).cast("double")
    return _ab(spark, sf_dir).agg(
        F.count("*").alias("n_shared"), F.count_if(x & y).alias("both_accept"), F.count_if(x & ~y).alias("lost"), F.count_if(~x & y).alias("won"), F.count_if(~x & ~y).alias("both_reject"),
        F.try_divide(F.sum("d"), F.lit(100.0) * F.count("d")).alias("mean_diff"), F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (n * q - s * s) / F.nullif(n * (n - 1), F.lit(0.0)))) / 100.0).alias("sd_diff"),
    )


@query(_with(_PI + _AB + " SELECT item_id, d FROM ab WHERE d IS NOT NULL ORDER BY abs(d) DESC, item_id LIMIT 10"))
def biggest_moves(spark, sf_dir):
    return _ab(spark, sf_dir).where("d is not null").select("item_id", "d").orderBy(F.desc(F.abs("d")), "item_id").limit(10)  # a top-k report


_FV = "(SELECT * FROM it WHERE reflection IS NOT NULL AND trim(reflection) <> '')"
_WORD = "regexp_split_to_array(regexp_replace(reflection, '^\\s+|\\s+$', '', 'g'), '\\s+')"


def _openers(spark, sf_dir):
    v = item_versions(load(spark, sf_dir, "items"), "reflection", "model")
    text = F.regexp_replace("reflection", r"^\s+|\s+$", "")
    return v.where(F.col("reflection").isNotNull() & (F.trim("reflection") != "")).select("item_id", "iteration", "model", X.first_word(text).alias("first_word"), X.opener(text).alias("opener"), X.closing(F.col("reflection")).alias("closing"))


@query(_with(f" SELECT first_word, n FROM (SELECT {_WORD}[1] AS first_word, count(*) AS n, min(item_id || '/' || lpad(iteration::varchar, 4, '0')) AS f FROM {_FV} GROUP BY 1) ORDER BY n DESC, f LIMIT 10"))
def first_words(spark, sf_dir):
    seen = F.concat("item_id", F.lit("/"), F.lpad(F.col("iteration").cast("string"), 4, "0"))
    c = _openers(spark, sf_dir).groupBy("first_word").agg(F.count("*").alias("n"), F.min(seen).alias("f"))
    return c.orderBy(F.desc("n"), "f").limit(10).drop("f")  # a top-k report


@query(_with(f" SELECT model, count(*) AS n, count(DISTINCT array_to_string(list_slice({_WORD}, 1, 5), ' ')) AS n_openers, 100.0::double * count(DISTINCT array_to_string(list_slice({_WORD}, 1, 5), ' ')) / count(*)::double AS unique_pct FROM {_FV} GROUP BY 1"))
def diversity(spark, sf_dir):
    return _openers(spark, sf_dir).groupBy("model").agg(F.count("*").alias("n"), F.countDistinct("opener").alias("n_openers"), (F.lit(100.0) * F.countDistinct("opener") / F.count("*").cast("double")).alias("unique_pct"))


@query(_with(f" SELECT opener, n FROM (SELECT array_to_string(list_slice({_WORD}, 1, 5), ' ') AS opener, count(*) AS n FROM {_FV} GROUP BY 1) WHERE n > 1"))
def duplicate_openers(spark, sf_dir):
    return _openers(spark, sf_dir).groupBy("opener").agg(F.count("*").alias("n")).where("n > 1")


@query(_with(f" SELECT closing, n FROM (SELECT left(trim(list_last(string_split(regexp_replace(rtrim(reflection), '\\.+$', ''), '.'))), 80) AS closing, count(*) AS n FROM {_FV} GROUP BY 1) WHERE n > 1"))
def duplicate_closings(spark, sf_dir):
    return _openers(spark, sf_dir).groupBy("closing").agg(F.count("*").alias("n")).where("n > 1")


@query(_with(f" SELECT iteration, first_word, n FROM (SELECT iteration, {_WORD}[1] AS first_word, count(*) AS n, row_number() OVER (PARTITION BY iteration ORDER BY count(*) DESC, {_WORD}[1]) AS rn FROM {_FV} GROUP BY 1, 2) WHERE rn <= 3"))
def top_first_words(spark, sf_dir):
    c = _openers(spark, sf_dir).groupBy("iteration", "first_word").agg(F.count("*").alias("n"))
    return c.withColumn("rn", F.row_number().over(Window.partitionBy("iteration").orderBy(F.desc("n"), "first_word"))).where("rn <= 3").drop("rn")


@query()
def parse_stats(spark, sf_dir):
    """Per iteration: answers attempted, parsed and failed by category."""
    v = item_versions(load(spark, sf_dir, "items"), "raw_response")
    got = answers.parse_answers(v.select("item_id", "iteration", "raw_response"), "raw_response")
    return got.groupBy("iteration").agg(F.count("*").alias("attempted"), F.count_if(F.col("category").isNull()).alias("ok"), F.count_if(F.col("category") == "api").alias("api"), F.count_if(F.col("category") == "parse").alias("parse"))


@query()
def parse_generation(spark, sf_dir):
    """Every stored answer parsed, failures as data."""
    v = item_versions(load(spark, sf_dir, "items"), "raw_response")
    return answers.parse_answers(v.select("item_id", "iteration", "raw_response"), "raw_response").drop("raw_response")


@query(_with(" SELECT review_seq, item_id, iteration, voice, score FROM leaf WHERE dim = 'tone' AND score < 3"))
def filter_dim(spark, sf_dir):
    return _leaves(spark, sf_dir).where("dim = 'tone' and score < 3").select("review_seq", "item_id", "iteration", "voice", "score")


@query(_with(_PI + f" SELECT item_id, iteration, {_AGG} AS aggregate FROM pi WHERE acc <= rej ORDER BY coalesce({_AGG}, 0), item_id, iteration LIMIT 20 OFFSET 5"))
def failures_page(spark, sf_dir):
    p = per_item(spark, sf_dir).where("acc <= rej").select("item_id", "iteration", _agg().alias("aggregate"))
    return p.orderBy(F.coalesce("aggregate", F.lit(0.0)), "item_id", "iteration").offset(5).limit(20)  # a page


@query(_with(_PI + f" SELECT item_id, iteration, {_AGG} AS aggregate FROM pi WHERE acc > rej AND n > 0 ORDER BY abs({_AGG} - 4), item_id, iteration LIMIT 20"))
def accepts_borderline(spark, sf_dir):
    p = per_item(spark, sf_dir).where("acc > rej and n > 0").select("item_id", "iteration", _agg().alias("aggregate"))
    return p.orderBy(F.abs(F.col("aggregate") - 4), "item_id", "iteration").limit(20)  # a top-k report


@query(_with(" SELECT item_id FROM it WHERE iteration = 3 INTERSECT SELECT item_id FROM it WHERE iteration = 4"))
def shared_items(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    return items.where("iteration = 3").select("item_id").intersect(items.where("iteration = 4").select("item_id"))


@query("SELECT item_id FROM items WHERE iteration = 3 EXCEPT SELECT item_id FROM items WHERE iteration = 4")
def dropped_items(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    return items.where("iteration = 3").select("item_id").subtract(items.where("iteration = 4").select("item_id"))


@query("SELECT DISTINCT item_id, iteration FROM items WHERE starts_with(item_id, 'a') AND is_gold")
def id_prefix_gold(spark, sf_dir):
    return load(spark, sf_dir, "items").where(F.col("item_id").startswith("a") & F.col("is_gold")).select("item_id", "iteration").distinct()


@query(_with(", cm AS (SELECT lower(trim(item_id)) AS item_id, count(*) AS n_comments FROM comments GROUP BY 1) SELECT jd.review_seq, jd.iteration, jd.judge, jd.model, coalesce(jd.mode_decision, jd.decision) AS decision, coalesce(cm.n_comments, 0) AS n_comments FROM jd LEFT JOIN cm USING (item_id)"))
def review_context(spark, sf_dir):
    comments = load(spark, sf_dir, "comments").groupBy(F.lower(F.trim("item_id")).alias("item_id")).agg(F.count("*").alias("n_comments"))
    j = judged(spark, sf_dir).join(comments, "item_id", "left")
    return j.select("review_seq", "iteration", "judge", "model", F.coalesce("mode_decision", "decision").alias("decision"), F.coalesce("n_comments", F.lit(0)).alias("n_comments")).orderBy(F.desc("iteration"), "review_seq")


@query(_with(" SELECT it.item_id, it.iteration, a.annotator_id, it.reflection = a.reflection AS same FROM it JOIN (SELECT DISTINCT item_id, annotator_id, reflection FROM annotations WHERE deleted_at IS NULL) a ON it.item_id = a.item_id"))
def compare_gold(spark, sf_dir):
    v = item_versions(load(spark, sf_dir, "items"), "reflection")
    a = load(spark, sf_dir, "annotations").where("deleted_at is null").select("item_id", "annotator_id", F.col("reflection").alias("gold")).distinct()
    return v.join(a, "item_id").select("item_id", "iteration", "annotator_id", (F.col("reflection") == F.col("gold")).alias("same"))


@query("SELECT item_id, iteration, gen_prompt FROM items WHERE regexp_matches(gen_prompt, '_v1[0-9]') AND NOT regexp_matches(gen_prompt, 'v11') AND contains(lower(gen_prompt), 'reflection')")
def prompt_filter(spark, sf_dir):
    p = F.col("gen_prompt")
    return load(spark, sf_dir, "items").where(p.rlike("_v1[0-9]") & ~p.rlike("v11") & F.contains(F.lower(p), F.lit("reflection"))).select("item_id", "iteration", "gen_prompt")


@query(_with(" SELECT iteration, count(*) AS n, bool_or(reasoning IS NOT NULL) AS any_reasoning, max(coalesce(try_cast(regexp_extract(gen_prompt, '_v(\\d+)', 1) AS INTEGER), 0)) AS newest FROM it GROUP BY 1"))
def run_summary(spark, sf_dir):
    v = item_versions(load(spark, sf_dir, "items"), "reasoning", "gen_prompt")
    return v.groupBy("iteration").agg(F.count("*").alias("n"), F.bool_or(F.col("reasoning").isNotNull()).alias("any_reasoning"), F.max(prompt_version(F.col("gen_prompt"), 0)).alias("newest"))


@query(_with(" SELECT DISTINCT dense_rank() OVER (ORDER BY iteration DESC)::int AS page, iteration, count(*) OVER (PARTITION BY iteration) AS n FROM rv"))
def review_pages(spark, sf_dir):
    n = reviews(spark, sf_dir).groupBy("iteration").agg(F.count("*").alias("n"))
    return n.withColumn("page", F.dense_rank().over(Window.orderBy(F.desc("iteration"))))  # one row an iteration


SECTIONS = ("iter_summary", "score_distribution", "pooled_distribution", "floor_violations", "flips", "diversity", "top_first_words", "run_summary")


def diagnose(spark, sf_dir):
    """The sections of the full report over all iterations, each as a row of JSON per line: section and line."""
    out = None
    for name in SECTIONS:
        df = query.queries[name](spark, sf_dir)
        part = df.select(F.lit(name).alias("section"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns) if dict(df.dtypes)[c] in ("string", "int", "bigint")]).alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


query.queries["diagnose"] = diagnose
QUERIES, SQL = query.queries, query.sql
