"""Text functions over the project's tables: citations, tokens, cut points, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import citations as C
from quern.functions import cutpoints as P
from quern.functions import ids as I
from quern.functions import textchecks as X
from quern.functions import tokenizer as K
from quern.plans.registry import Catalogue
from quern.tables import load

query = Catalogue()
_TOK = "regexp_extract_all(text, '\\s*\\S+')"
_FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, iteration ORDER BY created_at) AS rn FROM items) WHERE rn = 1)"


def _versions(spark, sf_dir, *columns):
    from quern.tables import item_versions

    return item_versions(load(spark, sf_dir, "items"), *columns)


def _known(spark, sf_dir):
    return [r[0] for r in load(spark, sf_dir, "charter_elements").orderBy("section_order").select("element_id").collect()]  # a small, fixed vocabulary


@query(f"SELECT doc_id, len({_TOK})::int AS n_tokens FROM documents WHERE text IS NOT NULL")
def token_counts(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", P.token_count(F.col("text")).alias("n_tokens"))


@query(f"SELECT doc_id, CASE WHEN len({_TOK}) <= 50 THEN text ELSE array_to_string(list_slice({_TOK}, 1, 50), '') END AS head, len({_TOK}) > 50 AS truncated FROM documents WHERE text IS NOT NULL")
def truncate_tokens(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", P.truncate_tokens(F.col("text"), 50).alias("head"), (P.token_count(F.col("text")) > 50).alias("truncated"))


@query(f"SELECT doc_id, (CASE WHEN length(text) > 0 THEN CASE WHEN len({_TOK}) <= 50 THEN length(text) ELSE length(array_to_string(list_slice({_TOK}, 1, 50), '')) END END)::int AS point FROM documents WHERE text IS NOT NULL")
def cut_point(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", P.cut_point(F.col("text"), 50).cast("int").alias("point"))


@query(f"SELECT doc_id, length(array_to_string(list_slice({_TOK}, 1, 80), ''))::int AS end_offset, least(len({_TOK}), 80)::int AS kept FROM documents WHERE text IS NOT NULL")
def end_slot_cut(spark, sf_dir):
    end, kept = P.end_slot(F.col("text"), 80)
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", end.cast("int").alias("end_offset"), kept.alias("kept"))


@query(
    """WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\s*\\S+')) AS p, generate_subscripts(regexp_extract_all(text, '\\s*\\S+'), 1) AS i FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM t)
    SELECT d.doc_id, coalesce(x.k, 0)::int AS token FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS k FROM e WHERE stop <= 400 GROUP BY 1) x USING (doc_id) WHERE d.text IS NOT NULL"""
)
def token_index(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", P.token_index(F.col("text"), F.lit(400)).alias("token"))


@query(f"SELECT doc_id, (CASE WHEN 1024 - (len({_TOK}) + 20) - 64 > 0 THEN least(1024 - (len({_TOK}) + 20) - 64, 512) END)::int AS budget FROM documents WHERE text IS NOT NULL")
def completion_budget(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", P.completion_budget(1024, P.token_count(F.col("text")) + 20, 64, 512).alias("budget"))


# -- the same by an existing tokenizer; with bytes as tokens, which SQL can count, and with a vocabulary


def _spans(spark, sf_dir, path):
    docs = load(spark, sf_dir, "documents").where("text <> ''").select("doc_id", "text")
    return docs.withColumn("_s", K.token_spans(F.col("text"), path))


_BYTES = "octet_length(encode({0}))"
_AT = f"list_max(list_filter(range(0, {{0}} + 1), lambda c: {_BYTES.format('left(text, c::int)')} <= {{0}}))"


def _cuts(spark, sf_dir, path):
    d = _spans(spark, sf_dir, path)
    head, kept = K.truncated(F.col("text"), F.col("_s"), 50)
    end, slot = K.end_slot(F.col("_s"), 80)
    return d.select(
        "doc_id", F.size("_s.starts").alias("n_tokens"), K.cut_point(F.col("text"), F.col("_s"), 50).alias("point"), F.length(head).alias("head_chars"), kept.alias("kept"), end.alias("end_offset"), slot.alias("slot"), K.token_index(F.col("_s"), F.lit(400)).alias("token")
    )


@query(
    f"""SELECT doc_id, n::int AS n_tokens, (CASE WHEN n <= 50 THEN length(text) ELSE {_AT.format(50)} END)::int AS point, (CASE WHEN n <= 50 THEN length(text) ELSE {_AT.format(50)} END)::int AS head_chars, least(n, 50)::int AS kept,
    (CASE WHEN n <= 80 THEN length(text) ELSE {_AT.format(79)} + 1 END)::int AS end_offset, least(n, 80)::int AS slot, {_BYTES.format("left(text, 400)")}::int AS token FROM (SELECT doc_id, text, {_BYTES.format("text")} AS n FROM documents WHERE text <> '')"""
)
def byte_cuts(spark, sf_dir):
    """Counts, cut points, end slots and token indices with every byte a token."""
    return _cuts(spark, sf_dir, "")


@query()
def bpe_cuts(spark, sf_dir):
    """Counts, cut points, end slots and token indices in the tokens of a public vocabulary."""
    return _cuts(spark, sf_dir, K.TOKENIZER)


@query()
def bpe_sampled_cut(spark, sf_dir):
    """A drawn token's start and index, and one drawn over characters."""
    u = I.uniform("cut", F.col("doc_id"))
    start, at = K.sampled_cut(F.col("_s"), u, 3800)
    return _spans(spark, sf_dir, K.TOKENIZER).select("doc_id", start.alias("point"), at.alias("token"), P.sampled_index(F.length("text"), u).alias("char_point"))


def _cites(column, alias="i"):
    return f"""SELECT item_id, iteration, id, min(ord) AS ord FROM (
        SELECT item_id, iteration, trim(part) AS id, gi * 1000 + pi AS ord FROM (
          SELECT item_id, iteration, gi, unnest(string_split(g, ',')) AS part, generate_subscripts(string_split(g, ','), 1) AS pi FROM (
            SELECT item_id, iteration, unnest(regexp_extract_all({column}, '\\[([A-Z0-9., ]+)\\]', 1)) AS g, generate_subscripts(regexp_extract_all({column}, '\\[([A-Z0-9., ]+)\\]', 1), 1) AS gi FROM {_FIRST} {alias})))
        WHERE regexp_full_match(id, '(?:[A-Z]+|\\d+)\\.\\d+') AND id IN (SELECT element_id FROM charter_elements) GROUP BY 1, 2, 3"""


@query(f"SELECT f.item_id, f.iteration, coalesce(c.ids, '') AS ids FROM {_FIRST} f LEFT JOIN (SELECT item_id, iteration, string_agg(id, '|' ORDER BY ord) AS ids FROM ({_cites('reflection')}) GROUP BY 1, 2) c USING (item_id, iteration)")
def citations(spark, sf_dir):
    v = _versions(spark, sf_dir, "reflection")
    return v.select("item_id", "iteration", F.array_join(C.cited_ids(F.col("reflection"), _known(spark, sf_dir)), "|").alias("ids"))


@query(
    f"""WITH u AS (SELECT *, 0 AS t FROM ({_cites('analysis')}) UNION ALL SELECT *, 1 AS t FROM ({_cites('reflection')})), m AS (SELECT item_id, iteration, id, min(t * 1000000 + ord) AS o FROM u GROUP BY 1, 2, 3)
    SELECT f.item_id, f.iteration, coalesce(c.ids, '') AS ids FROM {_FIRST} f LEFT JOIN (SELECT item_id, iteration, string_agg(id, '|' ORDER BY o) AS ids FROM m GROUP BY 1, 2) c USING (item_id, iteration)"""
)
def citation_union(spark, sf_dir):
    v = _versions(spark, sf_dir, "analysis", "reflection")
    return v.select("item_id", "iteration", F.array_join(C.cited_union(_known(spark, sf_dir), F.col("analysis"), F.col("reflection")), "|").alias("ids"))


@query(f"SELECT item_id, iteration, coalesce(array_to_string(regexp_extract_all(reflection, '\\[\\d+\\.\\d+(?:, ?\\d+\\.\\d+)*\\]'), '|'), '') AS cites FROM {_FIRST}")
def citation_strings(spark, sf_dir):
    v = _versions(spark, sf_dir, "reflection")
    return v.select("item_id", "iteration", F.array_join(C.citation_strings(F.col("reflection")), "|").alias("cites"))


@query(
    f"""SELECT f.item_id, f.iteration, coalesce(c.n, 0)::int AS n_cites FROM {_FIRST} f LEFT JOIN (
      SELECT item_id, iteration, count(*) AS n FROM (SELECT item_id, iteration, unnest(regexp_extract_all(g, '\\d+\\.\\d+')) AS id FROM (SELECT item_id, iteration, unnest(regexp_extract_all(reflection, '\\[[^\\]]*\\]')) AS g FROM {_FIRST}))
      WHERE id IN (SELECT element_id FROM charter_elements) GROUP BY 1, 2) c USING (item_id, iteration)"""
)
def citation_counts(spark, sf_dir):
    v = _versions(spark, sf_dir, "reflection")
    return v.select("item_id", "iteration", F.size(C.numeric_citations(F.col("reflection"), _known(spark, sf_dir))).alias("n_cites"))


@query(
    f"""WITH n AS (SELECT f.item_id, f.iteration, coalesce(c.n, 0) AS n FROM {_FIRST} f LEFT JOIN (SELECT item_id, iteration, count(*) AS n FROM ({_cites('reflection')}) GROUP BY 1, 2) c USING (item_id, iteration))
    SELECT least(n, 4)::int AS bucket, count(*) AS n_docs, sum(n)::bigint AS n_cites FROM n GROUP BY 1"""
)
def citation_profile(spark, sf_dir):
    n = F.size(C.cited_ids(F.col("reflection"), _known(spark, sf_dir)))
    return _versions(spark, sf_dir, "reflection").select(n.alias("n")).groupBy(F.least("n", F.lit(4)).alias("bucket")).agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_cites"))


@query(f"SELECT id, count(*) AS n_docs, count(*) / (SELECT count(*) FROM {_FIRST})::double AS share FROM ({_cites('reflection')}) GROUP BY 1")
def citation_by_id(spark, sf_dir):
    v = _versions(spark, sf_dir, "reflection").withColumn("ids", C.cited_ids(F.col("reflection"), _known(spark, sf_dir)))
    total = v.agg(F.count("*").alias("n"))
    return v.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n_docs")).join(F.broadcast(total)).select("id", "n_docs", (F.col("n_docs") / F.col("n").cast("double")).alias("share"))  # one row


@query("SELECT element_id, (row_number() OVER (ORDER BY CASE WHEN regexp_matches(element_id, '^[0-9]') THEN split_part(element_id, '.', 1)::int ELSE 1000 + ascii(element_id) END, split_part(element_id, '.', 2)::int))::int AS place FROM charter_elements")
def element_order(spark, sf_dir):
    rank = F.row_number().over(Window.orderBy(C.id_order(F.col("element_id"))))  # a small, fixed table
    return load(spark, sf_dir, "charter_elements").select("element_id", rank.alias("place"))


@query("SELECT element_id AS id, title FROM charter_elements WHERE contains(lower(element_id || ' ' || title), 'care') ORDER BY section_order")
def spec_search(spark, sf_dir):
    e = load(spark, sf_dir, "charter_elements")
    return e.where(F.contains(F.lower(F.concat_ws(" ", "element_id", "title")), F.lit("care"))).select(F.col("element_id").alias("id"), "title")


@query("SELECT count(*)::int AS n_ids, string_agg(element_id, '|' ORDER BY section_order) AS ids FROM charter_elements")
def spec_id_list(spark, sf_dir):
    lines = load(spark, sf_dir, "charter_elements").agg(F.array_sort(F.collect_list(F.struct("section_order", F.concat(F.lit("### "), "element_id", F.lit(" "), "title").alias("line")))).alias("x"))
    ids = C.spec_ids(F.array_join(F.transform("x", lambda r: r["line"]), "\n"))
    return lines.select(F.size(ids).alias("n_ids"), F.array_join(ids, "|").alias("ids"))


@query(f"""SELECT item_id, iteration, coalesce(regexp_matches(raw_response, '(^|[^A-Za-z0-9_])reflection_1p([^A-Za-z0-9_]|$)|"(analysis|reflection_1p)"'), false) AS leaks FROM {_FIRST}""")
def key_leak_guard(spark, sf_dir):
    return _versions(spark, sf_dir, "raw_response").select("item_id", "iteration", X.leaks_key(F.col("raw_response")).alias("leaks"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '[぀-ヿ一-鿿]') THEN 'CJK' WHEN regexp_matches(text, '[Ѐ-ӿ]') THEN 'cyrillic' WHEN regexp_matches(text, '[A-Za-z]') THEN 'latin' ELSE '?' END AS script FROM documents WHERE text IS NOT NULL")
def script_class(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", X.script_of(F.col("text")).alias("script"))


@query(f"SELECT item_id, iteration, coalesce(length(raw_response) < 800 AND length(raw_response) - length(replace(raw_response, '{{', '')) > length(raw_response) - length(replace(raw_response, '}}', '')), false) AS cut FROM {_FIRST}")
def truncated_heuristic(spark, sf_dir):
    return _versions(spark, sf_dir, "raw_response").select("item_id", "iteration", X.looks_truncated(F.col("raw_response")).alias("cut"))


@query(f"SELECT item_id, iteration, trim(split_part('<think>' || coalesce(reasoning, '') || '</think> ' || coalesce(reflection, ''), '</think>', 2)) AS answer FROM {_FIRST} WHERE NOT contains(coalesce(reflection, ''), '</think>')")
def think_strip(spark, sf_dir):
    v = _versions(spark, sf_dir, "reasoning", "reflection").where(~F.contains(F.coalesce("reflection", F.lit("")), F.lit("</think>")))
    full = F.concat(F.lit("<think>"), F.coalesce("reasoning", F.lit("")), F.lit("</think> "), F.coalesce("reflection", F.lit("")))
    return v.select("item_id", "iteration", X.after_thinking(full).alias("answer"))


@query("SELECT gen_prompt, coalesce(try_cast(regexp_extract(gen_prompt, '_v(\\d+)', 1) AS INTEGER), -1) AS version, row_number() OVER (ORDER BY coalesce(try_cast(regexp_extract(gen_prompt, '_v(\\d+)', 1) AS INTEGER), -1), gen_prompt)::int AS place FROM (SELECT DISTINCT gen_prompt FROM items)")
def prompt_versions(spark, sf_dir):
    v = I.prompt_version(F.col("gen_prompt"))
    return load(spark, sf_dir, "items").select("gen_prompt").distinct().select("gen_prompt", v.alias("version"), F.row_number().over(Window.orderBy(v, "gen_prompt")).alias("place"))  # one row a prompt


@query("SELECT stem, split_part(stem, '__', 1) AS alias, CASE WHEN contains(stem, '__') THEN substr(stem, strpos(stem, '__') + 2) END AS prompt, left(regexp_replace(stem, '[^A-Za-z0-9_.-]+', '_', 'g'), 120) AS safe FROM (SELECT DISTINCT model || '__' || gen_prompt AS stem FROM items UNION SELECT DISTINCT model FROM items)")
def stems(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    s = items.select(F.concat_ws("__", "model", "gen_prompt").alias("stem")).union(items.select("model")).distinct()
    alias, prompt = I.split_stem(F.col("stem"))
    return s.select("stem", alias.alias("alias"), prompt.alias("prompt"), I.safe_name(F.col("stem")).alias("safe"))


@query("SELECT k, split_part(k, '_', 1) AS role, split_part(k, '_', 2) AS mode, array_to_string(list_slice(string_split(k, '_'), 3, 99), '_') AS alias FROM (SELECT DISTINCT 'generator_' || coalesce(topic, 'none') || '_' || model || '_x' AS k FROM items)")
def status_keys(spark, sf_dir):
    k = F.concat(F.lit("generator_"), F.coalesce("topic", F.lit("none")), F.lit("_"), "model", F.lit("_x")).alias("k")
    role, mode, alias = I.status_key(F.col("k"))
    return load(spark, sf_dir, "items").select(k).distinct().select("k", role.alias("role"), mode.alias("mode"), alias.alias("alias"))


@query("SELECT model, CASE WHEN contains(lower(model), 'birch') THEN 0.7 WHEN contains(lower(model), 'b') THEN 0.9 ELSE 1.0 END::double AS temperature FROM (SELECT DISTINCT model FROM items)")
def sampling_params(spark, sf_dir):
    t = I.first_match(F.col("model"), [("birch", 0.7), ("b", 0.9)], 1.0)
    return load(spark, sf_dir, "items").select("model").distinct().select("model", t.alias("temperature"))


@query("SELECT event_id, coalesce(nullif(json_extract(props, '$.k')::bigint, 0), nullif(json_extract(props, '$.n')::bigint, 0), 0) AS tokens FROM events")
def usage_tokens(spark, sf_dir):
    get = lambda k: F.get_json_object("props", f"$.{k}").try_cast("bigint")
    return load(spark, sf_dir, "events").select("event_id", X.usage_tokens(get("k"), get("n")).alias("tokens"))


_DIR = "CASE lang WHEN 'deu' THEN 'Antworte auf Deutsch.' WHEN 'fra' THEN 'Réponds en français.' END"


@query(f"SELECT doc_id, 'Read.' || chr(10) || chr(10) || substr(text, 1, least(300, length(text))::int) || ' [...] ' || coalesce(chr(10) || {_DIR}, '') AS prompt FROM documents WHERE text IS NOT NULL")
def messages(spark, sf_dir):
    directive = F.try_element_at(F.create_map(F.lit("deu"), F.lit("Antworte auf Deutsch."), F.lit("fra"), F.lit("Réponds en français.")), F.col("lang"))
    docs = load(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", X.assemble("Read.", F.col("text"), F.least(F.lit(300), F.length("text")), directive).alias("prompt"))


@query(f"SELECT item_id, iteration, substr(text, 1, reflection_point) AS prefix, left(text, 300) AS brief, length(text) > 5000 AS capped, left(text, 5000) AS shown FROM {_FIRST}")
def prefixes(spark, sf_dir):
    v = _versions(spark, sf_dir, "text", "reflection_point")
    return v.select("item_id", "iteration", F.substring("text", F.lit(1), F.col("reflection_point")).alias("prefix"), F.substring("text", 1, 300).alias("brief"), (F.length("text") > 5000).alias("capped"), F.substring("text", 1, 5000).alias("shown"))


_CLEAN = "lower(regexp_replace(text, '\\[[^\\]]*\\]|`[^`]*`', ' ', 'g'))"
_HITS = ", ".join(f"len(list_intersect(ws, {s.split()!r})) AS n{k}" for k, s in enumerate(X.STOP_WORDS.values()))
_MOST = f"greatest({', '.join(f'n{k}' for k in range(len(X.STOP_WORDS)))})"
_DETECTED = f"""CASE WHEN length(trim(c)) < 10 THEN NULL WHEN regexp_matches(c, '[぀-ヿ]') THEN 'jpn' WHEN regexp_matches(c, '[一-鿿]') THEN 'cmn' WHEN regexp_matches(c, '[Ѐ-ӿ]') THEN 'rus' WHEN {_MOST} = 0 THEN NULL {" ".join(f"WHEN n{k} = {_MOST} THEN '{x}'" for k, x in enumerate(X.STOP_WORDS))} END"""
_LANGUAGE = f"(SELECT doc_id, lang, {_DETECTED} AS detected FROM (SELECT doc_id, lang, c, {_HITS} FROM (SELECT doc_id, lang, {_CLEAN} AS c, list_distinct(regexp_extract_all({_CLEAN}, '\\p{{L}}+')) AS ws FROM documents WHERE text IS NOT NULL)))"
_ANSWERED = "CASE WHEN lang <> '' AND lang <> '—' AND detected IS NOT NULL THEN (lang = 'en') = (detected = 'en') END"


@query(f"SELECT doc_id, lang, detected FROM {_LANGUAGE}")
def language_detect(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", "lang", X.detect_language(F.col("text")).alias("detected"))


@query(f"SELECT doc_id, {_ANSWERED} AS in_language FROM {_LANGUAGE}")
def in_language(spark, sf_dir):
    """Whether a text is English where its label says so, and not where it does not."""
    docs = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", "lang", X.detect_language(F.col("text")).alias("detected"))
    return docs.select("doc_id", X.in_language(F.col("lang"), F.col("detected")).alias("in_language"))


QUERIES, SQL = query.queries, query.sql
