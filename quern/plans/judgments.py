"""Rubric decisions, leaderboards and agreement over the reviews of item versions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import rubric as R
from quern.functions import stats as S
from quern.functions.ids import prompt_version
from quern.operators.latest import keep_first, keep_last, union_preferring
from quern.plans.registry import Catalogue
from quern.tables import clean_key, load

query = Catalogue()

_DEC = "CASE WHEN lower(trim({0})) IN ('accept', 'accepted') THEN 'accept' WHEN lower(trim({0})) IN ('reject', 'rejected') THEN 'reject' END"
_KEY = "lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))"
CTES = f"""it AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, iteration ORDER BY created_at) AS rn FROM items) WHERE rn = 1),
rv AS (SELECT review_seq, k AS item_id, iteration, judge, scores, cents, {_DEC.format('decision')} AS decision, {_DEC.format('reflection_decision')} AS mode_decision, mode_cents, created_at FROM (
  SELECT *, {_KEY.format('item_id')} AS k, {_KEY.format('reviewer_id')} AS judge, round(agg_score * 100)::bigint AS cents, round(reflection_agg_score * 100)::bigint AS mode_cents,
    row_number() OVER (PARTITION BY {_KEY.format('item_id')}, iteration, {_KEY.format('reviewer_id')} ORDER BY created_at DESC, review_seq DESC) AS rn
  FROM reviews WHERE item_id IS NOT NULL AND iteration IS NOT NULL) WHERE rn = 1),
jd AS (SELECT rv.*, it.model, it.gen_prompt, it.safety_score, it.topic, it.corpus, it.is_gold FROM rv JOIN it ON rv.item_id = it.item_id AND rv.iteration = it.iteration),
lf AS (SELECT review_seq, item_id, iteration, judge, model, gen_prompt, voice, unnest(map_keys(m)) AS dim, unnest(map_values(m)) AS score FROM (
  SELECT review_seq, item_id, iteration, judge, model, gen_prompt, unnest(map_keys(scores)) AS voice, unnest(map_values(scores)) AS m FROM jd)),
leaf AS (SELECT * FROM lf WHERE score IS NOT NULL)"""


def reviews(spark, sf_dir):
    """The latest review of each judge of each item version."""
    rows = load(spark, sf_dir, "reviews").where("item_id is not null and iteration is not null")
    rows = rows.select(
        "review_seq",
        clean_key("item_id").alias("item_id"),
        "iteration",
        clean_key("reviewer_id").alias("judge"),
        "scores",
        F.round(F.col("agg_score") * 100).cast("bigint").alias("cents"),
        R.clean_decision(F.col("decision")).alias("decision"),
        R.clean_decision(F.col("reflection_decision")).alias("mode_decision"),
        F.round(F.col("reflection_agg_score") * 100).cast("bigint").alias("mode_cents"),
        "created_at",
    )
    return keep_last(rows, ["item_id", "iteration", "judge"], F.col("created_at"), F.col("review_seq"))


def judged(spark, sf_dir):
    """These reviews with what is known of the version they judge; both sides are keyed once, so no row multiplies."""
    from quern.tables import item_versions

    versions = item_versions(load(spark, sf_dir, "items"), "model", "gen_prompt", "safety_score", "topic", "corpus", "is_gold")
    return reviews(spark, sf_dir).join(versions, ["item_id", "iteration"])


def _leaves(spark, sf_dir):
    return R.explode_scores(judged(spark, sf_dir), "review_seq", "item_id", "iteration", "judge", "model", "gen_prompt")


def _with(sql):
    return f"WITH {CTES}{sql if sql.startswith(',') else ' ' + sql}"


_MEAN = "coalesce(sum(cents)::double / (100.0::double * nullif(count(cents), 0)), 0.0::double)"


def _mean(col="cents"):
    return F.coalesce(F.sum(col).cast("double") / (F.lit(100.0) * F.nullif(F.count(col), F.lit(0))), F.lit(0.0))


def _accepts(col="decision"):
    return F.count_if(F.coalesce(F.col(col) == "accept", F.lit(False)))


def _rate(col="decision"):
    return _accepts(col) / F.count("*").cast("double")


_RATE = "sum((coalesce(decision = 'accept', false))::int)::bigint / count(*)::double"


@query(_with(f"SELECT model, gen_prompt, count(*) AS n, {_MEAN} AS mean_aggregate, {_RATE} AS accept_rate FROM jd GROUP BY 1, 2"))
def leaderboard(spark, sf_dir):
    out = judged(spark, sf_dir).groupBy("model", "gen_prompt").agg(F.count("*").alias("n"), _mean().alias("mean_aggregate"), _rate().alias("accept_rate"))
    return out.orderBy(F.desc("mean_aggregate"), "model", "gen_prompt")


@query(_with("SELECT model, voice, dim, count(*) AS n, sum(score)::bigint / count(*)::double AS mean_score FROM leaf GROUP BY 1, 2, 3"))
def per_dim_mean(spark, sf_dir):
    return _leaves(spark, sf_dir).groupBy("model", "voice", "dim").agg(F.count("*").alias("n"), (F.sum("score") / F.count("*").cast("double")).alias("mean_score"))


@query(_with(f"SELECT model, safety_score::varchar AS safety, count(*) AS n, {_RATE} AS accept_rate FROM jd WHERE safety_score IS NOT NULL GROUP BY 1, 2"))
def accept_by_score(spark, sf_dir):
    return judged(spark, sf_dir).where("safety_score is not null").groupBy("model", F.col("safety_score").cast("string").alias("safety")).agg(F.count("*").alias("n"), _rate().alias("accept_rate"))


@query(_with(f"SELECT model, corpus, topic, count(*) AS n, {_RATE} AS accept_rate, {_MEAN} AS mean_aggregate FROM jd GROUP BY 1, 2, 3"))
def by_subset(spark, sf_dir):
    return judged(spark, sf_dir).groupBy("model", "corpus", "topic").agg(F.count("*").alias("n"), _rate().alias("accept_rate"), _mean().alias("mean_aggregate"))


@query(_with("SELECT model, count(mode_decision) AS n, sum((mode_decision = 'accept')::int)::bigint / count(mode_decision)::double AS mode_accept_rate, sum(mode_cents)::double / (100.0::double * nullif(count(mode_cents), 0)) AS mode_mean FROM jd GROUP BY 1 HAVING count(mode_decision) > 0"))
def mode_metrics(spark, sf_dir):
    out = judged(spark, sf_dir).groupBy("model").agg(
        F.count("mode_decision").alias("n"), F.try_divide(_accepts("mode_decision"), F.count("mode_decision").cast("double")).alias("mode_accept_rate"), (F.sum("mode_cents").cast("double") / (F.lit(100.0) * F.nullif(F.count("mode_cents"), F.lit(0)))).alias("mode_mean")
    )
    return out.where("n > 0")


@query(
    f"""WITH {CTES}, f AS (SELECT model, item_id, iteration, CASE WHEN raw_response IS NULL THEN 'api' WHEN regexp_matches(raw_response, '^\\s*\\{{') AND regexp_matches(raw_response, '\\}}\\s*$') THEN NULL ELSE 'parse' END AS category FROM it)
    SELECT model, count(*) AS n_pool, count(DISTINCT CASE WHEN category = 'api' THEN item_id END) / greatest(count(*), 1)::double AS api_rate,
      count(DISTINCT CASE WHEN category = 'parse' THEN item_id END) / greatest(count(*), 1)::double AS parse_rate, (count(*) - count(CASE WHEN category IS NULL THEN 1 END)) / greatest(count(*), 1)::double AS total_dropped FROM f GROUP BY 1"""
)
def failure_rates(spark, sf_dir):
    from quern.tables import item_versions

    v = item_versions(load(spark, sf_dir, "items"), "model", "raw_response")
    cat = F.when(F.col("raw_response").isNull(), "api").when(~(F.col("raw_response").rlike(r"^\s*\{") & F.col("raw_response").rlike(r"\}\s*$")), "parse")
    f = v.select("model", "item_id", cat.alias("category"))
    n = F.greatest(F.count("*"), F.lit(1)).cast("double")
    ever = lambda c: F.count_distinct(F.when(F.col("category") == c, F.col("item_id")))
    return f.groupBy("model").agg(F.count("*").alias("n_pool"), (ever("api") / n).alias("api_rate"), (ever("parse") / n).alias("parse_rate"), ((F.count("*") - F.count_if(F.col("category").isNull())) / n).alias("total_dropped"))


_RUB = "CASE WHEN l.n IS NULL THEN NULL WHEN l.low <= 2 OR l.s::double / l.n < 4 THEN 'reject' ELSE 'accept' END"
_LV = "l AS (SELECT review_seq, min(score) AS low, sum(score)::bigint AS s, count(*) AS n FROM leaf GROUP BY 1)"


@query(_with(f", {_LV} SELECT jd.review_seq, l.s::double / l.n AS mean_score, {_RUB} AS rubric FROM jd LEFT JOIN l USING (review_seq)"))
def rubric_decision(spark, sf_dir):
    return judged(spark, sf_dir).select("review_seq", R.mean_score(F.col("scores")).alias("mean_score"), R.rubric_decision(F.col("scores")).alias("rubric"))


@query(f"WITH {CTES}, {_LV} SELECT jd.review_seq, coalesce(jd.decision, {_RUB}) AS decision, jd.decision IS NULL AS filled, coalesce(jd.cents::double / 100.0::double, l.s::double / l.n) AS aggregate FROM jd LEFT JOIN l USING (review_seq)")
def human_decision_fill(spark, sf_dir):
    j = judged(spark, sf_dir)
    return j.select(
        "review_seq",
        F.coalesce("decision", R.rubric_decision(F.col("scores"))).alias("decision"),
        F.col("decision").isNull().alias("filled"),
        F.coalesce(F.col("cents").cast("double") / 100.0, R.mean_score(F.col("scores"))).alias("aggregate"),
    )


@query(_with("SELECT review_seq, coalesce(array_to_string(list_sort(map_keys(scores)), '|'), '') AS voices, coalesce(len(list_filter(map_keys(scores), lambda x: x = 'reflection' OR starts_with(x, 'reflection_'))), 0)::int AS n_mode FROM jd"))
def voice_parts(spark, sf_dir):
    j = judged(spark, sf_dir)
    return j.select("review_seq", F.coalesce(F.array_join(R.voices(F.col("scores")), "|"), F.lit("")).alias("voices"), F.coalesce(F.when(F.col("scores").isNotNull(), F.size(R.voice_part(F.col("scores"), "reflection"))), F.lit(0)).alias("n_mode"))


@query(_with("SELECT item_id, iteration, voice, dim, count(*) AS n, sum(score)::bigint / count(*)::double AS mean_score FROM leaf GROUP BY 1, 2, 3, 4"))
def reviewer_average(spark, sf_dir):
    return _leaves(spark, sf_dir).groupBy("item_id", "iteration", "voice", "dim").agg(F.count("*").alias("n"), (F.sum("score") / F.count("*").cast("double")).alias("mean_score"))


@query(_with("SELECT item_id, iteration, judge, decision, cents FROM jd"))
def reviewer_all(spark, sf_dir):
    return judged(spark, sf_dir).select("item_id", "iteration", "judge", "decision", "cents")


@query(_with(", c AS (SELECT item_id, iteration, decision, count(decision) AS n, min(review_seq) AS f FROM jd GROUP BY 1, 2, 3) SELECT item_id, iteration, coalesce(decision, 'accept') AS decision, tot AS n_votes FROM (SELECT *, sum(n) OVER (PARTITION BY item_id, iteration)::bigint AS tot, row_number() OVER (PARTITION BY item_id, iteration ORDER BY n DESC, f) AS rn FROM c) WHERE rn = 1"))
def majority_decision(spark, sf_dir):
    return R.majority(judged(spark, sf_dir), ["item_id", "iteration"], "decision", "review_seq")


@query(_with("SELECT iteration, count(*) AS n_orphans FROM rv WHERE NOT EXISTS (SELECT 1 FROM it WHERE it.item_id = rv.item_id AND it.iteration = rv.iteration) GROUP BY 1"))
def orphan_reviews(spark, sf_dir):
    items = load(spark, sf_dir, "items").select("item_id", "iteration").distinct()
    return reviews(spark, sf_dir).join(items, ["item_id", "iteration"], "left_anti").groupBy("iteration").agg(F.count("*").alias("n_orphans"))


# -- agreement: each judge against the gold judge, the one with most reviews

_GOLD = "gold AS (SELECT judge FROM rv GROUP BY 1 ORDER BY count(*) DESC, judge LIMIT 1), pr AS (SELECT c.judge, c.item_id, c.iteration, c.cents AS x, g.cents AS y, c.decision AS a, g.decision AS b, c.mode_cents AS mx, g.mode_cents AS my, c.mode_decision AS ma, g.mode_decision AS mb FROM jd c JOIN jd g ON c.item_id = g.item_id AND c.iteration = g.iteration WHERE g.judge = (SELECT judge FROM gold) AND c.judge <> g.judge)"


def pairs(spark, sf_dir):
    """Reviews beside the gold judge's of the same version."""
    j = judged(spark, sf_dir)
    gold = reviews(spark, sf_dir).groupBy("judge").count().orderBy(F.desc("count"), "judge").limit(1).select(F.col("judge").alias("_gold"))
    marked = j.join(F.broadcast(gold))  # one row
    side = lambda x, y, a, b, ma, mb: [F.col("cents").alias(x), F.col("decision").alias(a), F.col("mode_cents").alias(ma), F.col("mode_decision").alias(mb)]
    g = marked.where("judge = _gold").select("item_id", "iteration", *side("y", None, "b", None, "my", "mb"))
    c = marked.where("judge <> _gold").select("judge", "item_id", "iteration", *side("x", None, "a", None, "mx", "ma"))
    return c.join(g, ["item_id", "iteration"])


def _pearson_sql(x, y, least=2):
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    s = lambda e: f"sum(CASE WHEN {both} THEN {e} END)::double"
    n = f"count(CASE WHEN {both} THEN 1 END)::double"
    vx, vy = f"({n} * {s(f'{x} * {x}')} - {s(x)} * {s(x)})", f"({n} * {s(f'{y} * {y}')} - {s(y)} * {s(y)})"
    return f"CASE WHEN {n} >= {least} AND {vx} > 0 AND {vy} > 0 THEN ({n} * {s(f'{x} * {y}')} - {s(x)} * {s(y)}) / (sqrt({vx}) * sqrt({vy})) END"


def _kappa_sql(a, b, flavour="rank"):
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    n = f"count(CASE WHEN {both} THEN 1 END)::double"
    share = lambda c: f"(count(CASE WHEN {both} AND {c} THEN 1 END) / nullif({n}, 0))"
    po, a1, b1 = share(f"{a} = {b}"), share(f"{a} = 'accept'"), share(f"{b} = 'accept'")
    pe = f"({a1} * {b1} + (1 - {a1}) * (1 - {b1}))"
    k = f"({po} - {pe}) / nullif(1 - {pe}, 0)"
    if flavour == "rank":
        return f"CASE WHEN {n} = 0 THEN NULL WHEN {pe} >= 1 THEN CASE WHEN {po} >= 1 THEN 1.0::double END ELSE {k} END"
    labels = f"(max(CASE WHEN {both} AND ({a} = 'accept' OR {b} = 'accept') THEN 1 ELSE 0 END) + max(CASE WHEN {both} AND ({a} = 'reject' OR {b} = 'reject') THEN 1 ELSE 0 END))"
    return f"CASE WHEN {n} >= 2 AND {labels} >= 2 THEN {k} END"


_CONC = "count(CASE WHEN a = b THEN 1 END) / nullif(count(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 END)::double, 0)"


@query(f"WITH {CTES}, {_GOLD} SELECT judge, count(*) AS n, {_pearson_sql('x', 'y')} AS pearson, {_CONC} AS concordance, {_kappa_sql('a', 'b')} AS kappa FROM pr GROUP BY 1")
def judge_vs_gold(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    return pairs(spark, sf_dir).groupBy("judge").agg(F.count("*").alias("n"), S.pearson(F.col("x"), F.col("y")).alias("pearson"), S.concordance(a, b).alias("concordance"), S.kappa(a, b).alias("kappa"))


@query(f"WITH {CTES}, {_GOLD} SELECT judge, {_pearson_sql('x', 'y', 3)} AS pearson, {_kappa_sql('a', 'b', 'tools')} AS kappa FROM pr GROUP BY 1")
def agreement_tools(spark, sf_dir):
    return pairs(spark, sf_dir).groupBy("judge").agg(S.pearson(F.col("x"), F.col("y"), 3).alias("pearson"), S.kappa(F.col("a"), F.col("b"), "tools").alias("kappa"))


@query(f"WITH {CTES}, {_GOLD} SELECT judge, {_pearson_sql('mx', 'my')} AS mode_pearson, count(CASE WHEN ma = mb THEN 1 END) / nullif(count(CASE WHEN ma IS NOT NULL AND mb IS NOT NULL THEN 1 END)::double, 0) AS mode_concordance FROM pr WHERE mx IS NOT NULL AND my IS NOT NULL GROUP BY 1")
def per_mode_correlation(spark, sf_dir):
    p = pairs(spark, sf_dir).where("mx is not null and my is not null")
    return p.groupBy("judge").agg(S.pearson(F.col("mx"), F.col("my")).alias("mode_pearson"), S.concordance(F.col("ma"), F.col("mb")).alias("mode_concordance"))


_RANKS = """r AS (SELECT {g}, (2 * (rank() OVER (PARTITION BY {g} ORDER BY x) + (count(*) OVER (PARTITION BY {g}, x) - 1) / 2.0))::bigint AS x, (2 * (rank() OVER (PARTITION BY {g} ORDER BY y) + (count(*) OVER (PARTITION BY {g}, y) - 1) / 2.0))::bigint AS y FROM {t} WHERE x IS NOT NULL AND y IS NOT NULL)"""


@query(f"WITH {CTES}, {_GOLD}, {_RANKS.format(g='judge', t='pr')} SELECT judge, count(*) AS n, {_pearson_sql('x', 'y')} AS spearman FROM r GROUP BY 1")
def judge_spearman(spark, sf_dir):
    return S.spearman(pairs(spark, sf_dir), "x", "y", "judge")


_DIMPAIR = """, hum AS (SELECT item_id, iteration, dim, sum(score)::bigint AS s, count(*) AS n FROM leaf WHERE judge <> (SELECT judge FROM gold) GROUP BY 1, 2, 3),
 dp AS (SELECT l.dim, l.score::bigint * 1000 AS x, round(h.s * 1000 / h.n::double)::bigint AS y FROM leaf l JOIN hum h ON l.item_id = h.item_id AND l.iteration = h.iteration AND l.dim = h.dim WHERE l.judge = (SELECT judge FROM gold) AND l.voice = 'reflection')"""


@query(f"WITH {CTES}, {_GOLD}{_DIMPAIR}, {_RANKS.format(g='dim', t='dp')} SELECT dim, count(*) AS n, {_pearson_sql('x', 'y')} AS spearman FROM r GROUP BY 1")
def per_dim_spearman(spark, sf_dir):
    leaves = _leaves(spark, sf_dir)
    gold = F.broadcast(reviews(spark, sf_dir).groupBy("judge").count().orderBy(F.desc("count"), "judge").limit(1).select(F.col("judge").alias("_gold")))  # one row
    marked = leaves.join(gold)
    human = marked.where("judge <> _gold").groupBy("item_id", "iteration", "dim").agg(F.round(F.sum("score") * 1000 / F.count("*").cast("double")).cast("bigint").alias("y"))
    mine = marked.where("judge = _gold and voice = 'reflection'").select("item_id", "iteration", "dim", (F.col("score").cast("bigint") * 1000).alias("x"))
    return S.spearman(mine.join(human, ["item_id", "iteration", "dim"]), "x", "y", "dim")


_HUM = f"""h AS (SELECT item_id, iteration, count(*) AS n_reviews, round(avg(cents))::bigint AS y, CASE WHEN sum((decision = 'accept')::int) >= sum((decision = 'reject')::int) THEN 'accept' ELSE 'reject' END AS b FROM jd GROUP BY 1, 2),
 c AS (SELECT jd.judge, jd.item_id, jd.iteration, jd.cents AS x, jd.decision AS a, h.y, h.b FROM jd JOIN h ON jd.item_id = h.item_id AND jd.iteration = h.iteration WHERE n_reviews > 1)"""


@query(f"WITH {CTES}, {_HUM} SELECT judge, count(*) AS n, {_pearson_sql('x', 'y')} AS pearson, {_CONC} AS concordance, {_kappa_sql('a', 'b')} AS kappa FROM c GROUP BY 1")
def judge_vs_human(spark, sf_dir):
    j = judged(spark, sf_dir)
    yes, no = (F.sum(F.when(F.col("decision").isNotNull(), (F.col("decision") == d).cast("int"))) for d in ("accept", "reject"))
    h = j.groupBy("item_id", "iteration").agg(F.count("*").alias("n_reviews"), F.round(F.avg("cents")).cast("bigint").alias("y"), F.when(yes >= no, "accept").otherwise("reject").alias("b")).where("n_reviews > 1")
    c = j.select("judge", "item_id", "iteration", F.col("cents").alias("x"), F.col("decision").alias("a")).join(h, ["item_id", "iteration"])
    a, b = F.col("a"), F.col("b")
    return c.groupBy("judge").agg(F.count("*").alias("n"), S.pearson(F.col("x"), F.col("y")).alias("pearson"), S.concordance(a, b).alias("concordance"), S.kappa(a, b).alias("kappa"))


_CAL = _HUM.replace("jd.judge, jd", "jd.gen_prompt, jd.model, jd")


@query(f"WITH {CTES}, {_CAL} SELECT gen_prompt, model, count(*) AS n, {_CONC} AS agreement, {_pearson_sql('x', 'y')} AS pearson, sum(abs(x - y))::double / (100.0::double * nullif(count(x), 0)) AS mean_abs_diff, {_kappa_sql('a', 'b', 'tools')} AS kappa FROM c GROUP BY 1, 2")
def calibration_by_prompt(spark, sf_dir):
    """Each prompt and model against the reviewers' own verdict: agreement, kappa, r and the mean difference."""
    j = judged(spark, sf_dir)
    yes, no = (F.sum(F.when(F.col("decision").isNotNull(), (F.col("decision") == d).cast("int"))) for d in ("accept", "reject"))
    h = j.groupBy("item_id", "iteration").agg(F.count("*").alias("n_reviews"), F.round(F.avg("cents")).cast("bigint").alias("y"), F.when(yes >= no, "accept").otherwise("reject").alias("b")).where("n_reviews > 1")
    c = j.select("gen_prompt", "model", "item_id", "iteration", F.col("cents").alias("x"), F.col("decision").alias("a")).join(h, ["item_id", "iteration"])
    diff = F.sum(F.abs(F.col("x") - F.col("y"))).cast("double") / (F.lit(100.0) * F.nullif(F.count("x"), F.lit(0)))
    a, b, x, y = map(F.col, "abxy")
    return c.groupBy("gen_prompt", "model").agg(F.count("*").alias("n"), S.concordance(a, b).alias("agreement"), S.pearson(x, y).alias("pearson"), diff.alias("mean_abs_diff"), S.kappa(a, b, "tools").alias("kappa"))


@query(_with(", m AS (SELECT item_id, iteration, voice, dim, sum(score)::bigint AS s, count(*) AS k FROM leaf GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) SELECT l.gen_prompt, l.model, l.voice, l.dim, count(*) AS n, sum(round(abs(1000 * l.score - 1000 * m.s / m.k::double))::bigint)::bigint / (1000.0::double * count(*)) AS mean_abs_diff FROM leaf l JOIN m USING (item_id, iteration, voice, dim) GROUP BY 1, 2, 3, 4"))
def calibration_dims(spark, sf_dir):
    """The same per voice and dimension: how far single scores lie from the mean of all."""
    leaves = _leaves(spark, sf_dir)
    keys = ["item_id", "iteration", "voice", "dim"]
    m = leaves.groupBy(*keys).agg(F.sum("score").alias("s"), F.count("*").alias("k")).where("k > 1")
    milli = F.round(F.abs(1000 * F.col("score") - 1000 * F.col("s") / F.col("k").cast("double"))).cast("bigint")
    return leaves.join(m, keys).groupBy("gen_prompt", "model", "voice", "dim").agg(F.count("*").alias("n"), (F.sum(milli) / (F.lit(1000.0) * F.count("*"))).alias("mean_abs_diff"))


@query("SELECT model, gen_prompt, version FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY version DESC) AS rn FROM (SELECT DISTINCT model, gen_prompt, coalesce(try_cast(regexp_extract(gen_prompt, '_v(\\d+)', 1) AS INTEGER), -1) AS version FROM items)) WHERE rn <= 5")
def versions_top5(spark, sf_dir):
    v = load(spark, sf_dir, "items").select("model", "gen_prompt", prompt_version(F.col("gen_prompt")).alias("version")).distinct()
    return v.withColumn("rn", F.row_number().over(Window.partitionBy("model").orderBy(F.desc("version")))).where("rn <= 5").drop("rn")


@query(_with(", q AS (SELECT DISTINCT r.item_id, r.iteration, p.gen_prompt, p.model FROM (SELECT DISTINCT item_id, iteration FROM rv) r, (SELECT DISTINCT gen_prompt, model FROM it WHERE gen_prompt LIKE '%_v1.md') p) SELECT item_id, iteration, gen_prompt, model FROM q WHERE NOT EXISTS (SELECT 1 FROM it WHERE it.item_id = q.item_id AND it.iteration = q.iteration AND it.gen_prompt = q.gen_prompt AND it.model = q.model)"))
def rejudge_queue(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    seen = reviews(spark, sf_dir).select("item_id", "iteration").distinct()
    # prompts and models are a handful, so the work list is that many times the reviewed versions
    kinds = items.where("gen_prompt like '%\\_v1.md'").select("gen_prompt", "model").distinct().collect()
    fan = F.array(*[F.struct(F.lit(k["gen_prompt"]).alias("gen_prompt"), F.lit(k["model"]).alias("model")) for k in kinds])
    queue = seen.select("item_id", "iteration", F.explode(fan).alias("k")).select("item_id", "iteration", "k.gen_prompt", "k.model") if kinds else seen.select("item_id", "iteration", F.lit("").alias("gen_prompt"), F.lit("").alias("model")).limit(0)
    return queue.join(items.select("item_id", "iteration", "gen_prompt", "model").distinct(), ["item_id", "iteration", "gen_prompt", "model"], "left_anti")


@query(_with("SELECT item_id, iteration, judge, 'review' AS source, cents FROM jd WHERE cents IS NOT NULL UNION ALL SELECT item_id, iteration, judge, 'mode', mode_cents FROM jd WHERE cents IS NULL AND mode_cents IS NOT NULL"))
def preferred_scores(spark, sf_dir):
    j = judged(spark, sf_dir)
    keys = ["item_id", "iteration", "judge"]
    first = j.where("cents is not null").select(*keys, F.lit("review").alias("source"), "cents")
    second = j.where("mode_cents is not null").select(*keys, F.lit("mode").alias("source"), F.col("mode_cents").alias("cents"))
    return union_preferring(first, second, keys)


@query(_with("SELECT item_id, iteration, judge, review_seq FROM (SELECT *, row_number() OVER (PARTITION BY item_id, iteration ORDER BY judge, review_seq) AS rn FROM jd WHERE right(sha256(item_id), 1) IN ('0', '4', '8', 'c') AND judge NOT IN ('rev-284')) WHERE rn = 1"))
def review_lookup(spark, sf_dir):
    from quern.functions.ids import review_split

    rows = judged(spark, sf_dir).where((review_split(F.col("item_id")) == "validation") & ~F.col("judge").isin("rev-284")).select("item_id", "iteration", "judge", "review_seq")
    return keep_first(rows, ["item_id", "iteration"], F.col("judge"), F.col("review_seq"))


QUERIES, SQL = query.queries, query.sql
