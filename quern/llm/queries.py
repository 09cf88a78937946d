"""Queries of the problems tagged llm, with SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.llm import consensus, language, leakage, mixing, quality, spam, tokens, truncation
from quern.tables import load


def _consensus(spark, sf_dir):
    return consensus.consensus(load(spark, sf_dir, "reviews"), load(spark, sf_dir, "items"))


def p3_found(spark, sf_dir):
    return _consensus(spark, sf_dir)[0].select("item_id", "iteration", "decision")


def p3_agreement(spark, sf_dir):
    """Confidence of each decision, the share of agreeing pairs of votes, and that of equal scores (null without two scores of a kind)."""
    scores = consensus.score_agreement(load(spark, sf_dir, "reviews"), load(spark, sf_dir, "items"))
    return _consensus(spark, sf_dir)[0].join(scores, ["item_id", "iteration"], "left")


def p3_reliability(spark, sf_dir):
    """Sensitivity, specificity and reliability of each reviewer."""
    return _consensus(spark, sf_dir)[1]


def p3_dimension_agreement(spark, sf_dir):
    """How far reviewers agree on the scores of each voice and dimension."""
    return consensus.dimension_agreement(load(spark, sf_dir, "reviews"))


def p4_found(spark, sf_dir):
    return language.label_cases(load(spark, sf_dir, "items"))


def p4_segments(spark, sf_dir):
    """Every segment of every item's text with its language and confidence."""
    return language.text_segments(load(spark, sf_dir, "items"))


def p5_found(spark, sf_dir):
    return quality.text_statistics(load(spark, sf_dir, "items")).where("text_kind is not null").select("item_id", "text_kind")


def p5_statistics(spark, sf_dir):
    """All figures of every item's text."""
    items = load(spark, sf_dir, "items")
    return quality.text_statistics(items, common=quality.common_list(items))


def p6_found(spark, sf_dir):
    return truncation.scored_values(load(spark, sf_dir, "items")).where("is_cut").select("item_id", "iteration", "field_name")


def p6_cut_rates(spark, sf_dir):
    return truncation.cut_rates(truncation.scored_values(load(spark, sf_dir, "items")))


def p7_token_totals(spark, sf_dir):
    return tokens.token_cube(tokens.item_tokens(load(spark, sf_dir, "items")))


def p7_item_tokens(spark, sf_dir):
    return tokens.item_tokens(load(spark, sf_dir, "items"))


def p8_found(spark, sf_dir):
    return leakage.leaked_pairs(load(spark, sf_dir, "documents"), load(spark, sf_dir, "bench_items"))


def p8_leak_counts(spark, sf_dir):
    return leakage.leak_counts(p8_found(spark, sf_dir), load(spark, sf_dir, "bench_items"))


def p9_mix(spark, sf_dir):
    return mixing.mix_documents(mixing.sized_table(load(spark, sf_dir, "documents")), load(spark, sf_dir, "mix_targets"))


def p9_shares(spark, sf_dir):
    return mixing.mix_shares(p9_mix(spark, sf_dir), load(spark, sf_dir, "mix_targets"))


def p10_found(spark, sf_dir):
    return spam.spam_scores(load(spark, sf_dir, "documents")).where("is_spam").select("doc_id")


def p10_site_rates(spark, sf_dir):
    """Spam documents per site, over sites with any document that has text."""
    return spam.spam_scores(load(spark, sf_dir, "documents"), "site").groupBy("site").agg(F.count("*").alias("n_docs"), F.count_if("is_spam").alias("n_spam"))


QUERIES = {f.__name__: f for f in (p3_found, p3_agreement, p3_reliability, p3_dimension_agreement, p4_found, p4_segments, p5_found, p5_statistics, p6_found, p6_cut_rates, p7_token_totals, p7_item_tokens, p8_found, p8_leak_counts, p9_mix, p9_shares, p10_found, p10_site_rates)}
_TRIM = "lower(regexp_replace({0}, '^[\\s\\x{{00a0}}\\x{{3000}}]+|[\\s\\x{{00a0}}\\x{{3000}}]+$', '', 'g'))"
SQL: dict[str, str] = {
    "p3_dimension_agreement": f"""WITH r AS (SELECT k, iteration, scores FROM (SELECT *, row_number() OVER (PARTITION BY k, iteration, w ORDER BY created_at DESC NULLS LAST, review_seq DESC) AS rn FROM (SELECT *, {_TRIM.format("item_id")} AS k, {_TRIM.format("reviewer_id")} AS w FROM reviews WHERE item_id IS NOT NULL AND iteration IS NOT NULL AND reviewer_id IS NOT NULL)) WHERE rn = 1),
      v AS (SELECT k, iteration, unnest(map_keys(scores)) AS voice, unnest(map_values(scores)) AS m FROM r), d AS (SELECT k, iteration, voice, unnest(map_keys(m)) AS dim, unnest(map_values(m)) AS score FROM v),
      c AS (SELECT voice, dim, k, iteration, score, count(*) AS c FROM d WHERE score IS NOT NULL GROUP BY ALL), p AS (SELECT voice, dim, k, iteration, sum(c * (c - 1))::bigint AS same, sum(c)::bigint AS n FROM c GROUP BY ALL)
      SELECT voice, dim, sum(n)::bigint AS n_scores, sum(same)::bigint AS n_equal, sum(n * (n - 1))::bigint AS n_pairs, sum(same)::bigint / nullif(sum(n * (n - 1))::bigint, 0)::double AS agreement FROM p GROUP BY ALL""",
}
