"""Sources, sinks and state: each written to the shared folder and read back, over whole tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import answers
from quern.functions.rendering import sanitize, strip_heavy
from quern.operators import annotate as A
from quern.plans.judgments import CTES, rejudge_queue
from quern.plans.judgments import SQL as JUDGMENT_SQL
from quern.plans.registry import Catalogue
from quern.session import scratch
from quern.sources import corpus as C
from quern.sources import jsonl as J
from quern.sources import state as ST
from quern.sources.fs import Folder
from quern.streaming import feedback as S
from quern.tables import item_versions, load

query = Catalogue()
_IT = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, iteration ORDER BY created_at) AS rn FROM items) WHERE rn = 1)"


def _with(sql):
    return f"WITH {CTES} {sql}"


# -- corpora


def _corpus(spark, sf_dir, layout="flat"):
    """The documents as a corpus on disk, with the language inside a struct and columns nobody asked for."""
    docs = load(spark, sf_dir, "documents")
    path = scratch(spark, "corpus")
    meta = F.struct(F.col("lang").alias("language"), F.array(F.lit(0.0)).alias("embeddings"))
    rows = docs.select("doc_id", "text", "id", "safety_score", "safety_probs", meta.alias("metadata"), "topic", "site", F.coalesce("lang", F.lit("none")).alias("dir"))
    writer = rows.write.option("compression", "zstd")
    (writer if layout == "flat" else writer.partitionBy("dir")).parquet(path)
    return C.Corpus("web", path, layout, {"deu": "dir=deu", "en": "dir=en", "fra": "dir=fra"})


@query("SELECT coalesce(text, '') AS text, id, safety_score, lang AS language FROM documents")
def corpus_scan(spark, sf_dir):
    """A projected scan: one field of a struct, null texts as empty ones, a check that the columns are there."""
    return C.read_corpus(spark, _corpus(spark, sf_dir)).select("text", "id", "safety_score", "language")


@query("SELECT lang AS language, count(*) AS n FROM documents WHERE lang IN ('deu', 'fra') GROUP BY 1")
def corpus_languages(spark, sf_dir):
    """Shards of the wanted languages only, each in its directory."""
    return C.read_corpus(spark, _corpus(spark, sf_dir, "per_language_dir"), ["deu", "fra"]).groupBy("language").agg(F.count("*").alias("n"))


@query("SELECT doc_id, topic, site FROM documents")
def corpus_leftover(spark, sf_dir):
    """Columns beyond the projection come along as one JSON object."""
    rows = C.read_corpus(spark, _corpus(spark, sf_dir), leftover=True)
    return rows.select(F.from_json("metadata", "doc_id bigint, topic string, site string").alias("m")).select("m.*")


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "items", "reviews", "annotations", "comments", "bench_items")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def file_rows(spark, sf_dir):
    """Rows of every table's files, without decoding a column."""
    one = lambda t: C.file_rows(spark, f"{sf_dir}/{t}.parquet").agg(F.sum("n_rows").alias("n_rows")).select(F.lit(t).alias("name"), "n_rows")
    out = one(_TABLES[0])
    for t in _TABLES[1:]:
        out = out.unionByName(one(t))
    return out


@query("SELECT name FROM (SELECT DISTINCT source_shard || '.parquet' AS name FROM documents WHERE source_shard IS NOT NULL) WHERE name LIKE 'batch_0%'")
def shard_listing(spark, sf_dir):
    """A remote listing, cut to the names that begin and end so."""
    shards = load(spark, sf_dir, "documents").where("source_shard is not null").select("source_shard").distinct().collect()  # one row a file
    names = C.list_files([f"{r[0]}.parquet" for r in shards] + ["README.md"], "batch_0")
    return spark.createDataFrame([(n,) for n in names if n.startswith("batch_0")], "name string")


@query("SELECT DISTINCT source_shard FROM (SELECT *, row_number() OVER (ORDER BY source_shard) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT source_shard FROM documents WHERE source_shard IS NOT NULL)) WHERE n <= 5 OR i IN (0, floor((n - 1) / 4.0), floor(2 * (n - 1) / 4.0), floor(3 * (n - 1) / 4.0), n - 1)")
def spaced_shards(spark, sf_dir):
    shards = load(spark, sf_dir, "documents").where("source_shard is not null").select("source_shard").distinct().orderBy("source_shard").collect()  # one row a file
    return spark.createDataFrame([(s,) for s in dict.fromkeys(C.linspace_shards([r[0] for r in shards], 5))], "source_shard string")


@query("SELECT text FROM documents WHERE text IS NOT NULL ORDER BY source_shard NULLS FIRST, doc_id LIMIT 20")
def first_texts(spark, sf_dir):
    """The first texts in the order of the files, and nothing but them."""
    return C.first_texts(load(spark, sf_dir, "documents").where("text is not null").select("text", "source_shard", F.col("doc_id").alias("row_index")), 20)


@query("SELECT item_id, bench, lang, length(text) AS n_chars FROM bench_items")
def cached_bench(spark, sf_dir):
    """A table built where it is missing, and read where it is there."""
    path = scratch(spark, "bench")
    build = lambda: load(spark, sf_dir, "bench_items").select("item_id", "bench", "lang", F.length("text").cast("bigint").alias("n_chars"))
    C.cached(spark, path, build)
    return C.cached(spark, path, lambda: build().limit(0))


@query("SELECT doc_id, doc_id + floor(('0x' || left(sha256(concat_ws('|', 'buffer', doc_id::varchar)), 13))::BIGINT / 4503599627370496.0::double * 10000)::bigint AS place FROM documents")
def buffered_shuffle(spark, sf_dir):
    """An approximate shuffle through a buffer of 10,000 rows."""
    return C.buffer_shuffle(load(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10_000, "buffer").select("doc_id", "place")


@query("SELECT element_id || '.txt' AS file_name, sha256(title) AS sha256 FROM charter_elements")
def file_hashes(spark, sf_dir):
    """Hashes of whole files, here one for each element's title."""
    path, folder = scratch(spark, "prompts"), Folder(spark)
    for r in load(spark, sf_dir, "charter_elements").collect():  # a small, fixed table
        folder.write_text(f"{path}/{r['element_id']}.txt", r["title"])
    return C.file_hashes(spark, f"{path}/*.txt")


# -- lines, logs and results

_ROW = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("iteration", T.IntegerType()), T.StructField("model", T.StringType()), T.StructField("latency_ms", T.LongType())])


def _lines(spark, sf_dir):
    """Item rows as JSON lines, with a blank, a broken and a torn one among them."""
    path = scratch(spark, "lines")
    good = load(spark, sf_dir, "items").select(F.to_json(F.struct("item_id", "iteration", "model", "latency_ms")).alias("value"))
    bad = spark.createDataFrame([("",), ("not json",), ('{"item_id": "torn", "itera',)], "value string")
    good.unionByName(bad).write.text(path)
    return J.read_jsonl(spark, path, _ROW)


@query("SELECT item_id, iteration, model, latency_ms FROM items")
def jsonl_rows(spark, sf_dir):
    """Good lines under an explicit schema; blank ones skipped."""
    return _lines(spark, sf_dir)[0].select(*_ROW.names)


@query("""SELECT * FROM (VALUES ('not json'), ('{"item_id": "torn", "itera')) t(line)""")
def jsonl_bad_lines(spark, sf_dir):
    """Lines that are no JSON, the torn last one among them, apart from the rows."""
    return _lines(spark, sf_dir)[1].select("line")


@query(_with("SELECT judge, model || '__' || gen_prompt AS generator, count(*) AS n FROM jd GROUP BY 1, 2"))
def judgment_files(spark, sf_dir):
    """Dimensions read off file names, and each judgment met with its generation's file."""
    from quern.plans.judgments import judged

    gen = F.concat_ws("__", "model", "gen_prompt")
    j = judged(spark, sf_dir).select(F.concat("judge", F.lit("__on__"), gen, F.lit(".jsonl")).alias("file_name"))
    judge, generator = J.judge_and_generator(F.col("file_name"))
    files = load(spark, sf_dir, "items").select(gen.alias("generator")).distinct()
    return j.select(judge.alias("judge"), generator.alias("generator")).join(files, "generator", "left_semi").groupBy("judge", "generator").agg(F.count("*").alias("n"))


@query("SELECT 'edge-' || pid || '-' || lang AS item_id, lang, length(text) AS n_chars FROM bench_items WHERE bench = 'edge-cases'")
def json_arrays(spark, sf_dir):
    """Files that each hold an array, the language being the file's name."""
    path, folder = scratch(spark, "arrays"), Folder(spark)
    by_lang: dict[str, list] = {}
    for r in load(spark, sf_dir, "bench_items").where("bench = 'edge-cases'").select("pid", "lang", "text").collect():  # a small, fixed table
        by_lang.setdefault(r["lang"], []).append({"pid": r["pid"], "text": r["text"]})
    for lang, rows in by_lang.items():
        folder.write_text(f"{path}/{lang}.json", json.dumps(rows, ensure_ascii=False))
    if not by_lang:
        return spark.createDataFrame([], "item_id string, lang string, n_chars bigint")
    return J.read_json_arrays(spark, path, T._parse_datatype_string("pid string, text string"), "edge").select("item_id", "lang", F.length("text").cast("bigint").alias("n_chars"))


@query("SELECT model AS run_id, strftime(min(created_at), '%Y-%m-%dT%H:%M:%S') AS started_at, 'done' AS status, count(DISTINCT gen_prompt)::int AS n_candidates FROM items GROUP BY 1")
def run_listing(spark, sf_dir):
    """Run directories with their metadata: start to the second, status, number of candidates."""
    path = scratch(spark, "runs")
    runs = load(spark, sf_dir, "items").groupBy("model").agg(F.date_format(F.min("created_at"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("started_at"), F.array_sort(F.collect_set("gen_prompt")).alias("candidates"))
    runs.select(F.col("model").alias("run_id"), "started_at", F.lit("done").alias("status"), "candidates", "model").write.partitionBy("model").json(path)
    return J.run_listing(spark, f"{path}/model=*/*.json")


@query("SELECT model, 'generate' AS mode, count(latency_ms) AS n_measured, 0.0::double AS n_failed, sum(latency_ms)::bigint / count(latency_ms)::double AS avg_output_tok, 0.0::double AS gpu_hours FROM items WHERE model <> 'elm-4b' GROUP BY 1")
def result_files(spark, sf_dir):
    """Benchmark results, an object a file, as flat figures; files with an error are left out, missing figures are 0."""
    path = scratch(spark, "results")
    m = load(spark, sf_dir, "items").groupBy("model").agg(F.count("latency_ms").alias("n"), F.sum("latency_ms").alias("s"))
    stats = F.struct(
        F.when(F.col("model") == "elm-4b", "No successful measured requests").alias("error"), F.col("n").alias("n_measured"), F.struct((F.col("s") / F.col("n").cast("double")).alias("mean")).alias("output_tokens")
    )
    m.select(F.col("model").alias("model_alias"), F.lit("generate").alias("mode"), stats.alias("stats"), F.col("model").alias("_m")).write.partitionBy("_m").json(path)
    out = J.read_results(spark, f"{path}/_m=*/*.json")
    return out.select("model", "mode", F.col("n_measured").cast("bigint").alias("n_measured"), "n_failed", "avg_output_tok", "gpu_hours")


@query("SELECT model, latency_ms FROM items WHERE latency_ms IS NOT NULL AND model IS NOT NULL")
def log_scrape(spark, sf_dir):
    """Figures scraped from log lines; lines of other kinds are passed over."""
    path = scratch(spark, "logs")
    line = F.concat(F.lit("INFO done model="), "model", F.lit(" latency="), "latency_ms", F.lit(" ms"))
    rows = load(spark, sf_dir, "items").where("latency_ms is not null and model is not null").select(line.alias("value"))
    rows.unionByName(spark.createDataFrame([("WARN retry",), ("",)], "value string")).write.text(path)
    return J.scrape_logs(spark, path, {"model": r"model=(\S+)", "latency_ms": r"latency=(\d+)"}).select("model", F.col("latency_ms").cast("bigint").alias("latency_ms"))


@query("SELECT element_id, '## Final Summary' || chr(10) || title || chr(10) || 'more of ' || element_id AS summary FROM charter_elements")
def log_sections(spark, sf_dir):
    """The closing summary out of a log whose text blocks are broken by other lines."""
    lines = F.concat_ws("\n", F.lit("[text] begin"), F.lit("[tool] run"), F.lit("out of block"), F.lit("[text] ## Final Summary"), "title", F.lit("[ok] run"), F.lit("lost"), F.concat(F.lit("[text] more of "), "element_id"))
    return load(spark, sf_dir, "charter_elements").select("element_id", J.log_summary(lines).alias("summary"))


@query("SELECT model, CASE WHEN length(model) % 3 = 0 THEN NULL ELSE length(model) * 1024 END::int AS context_length FROM (SELECT DISTINCT model FROM items WHERE model IS NOT NULL)")
def context_lengths(spark, sf_dir):
    """The window out of a server's flags, in both spellings; null where it is absent."""
    n = F.length("model")
    flags = F.when(n % 3 == 0, F.lit("--tp 4")).when(n % 3 == 1, F.concat(F.lit("--tp 4 --context-length="), n * 1024)).otherwise(F.concat(F.lit("--context-length  "), n * 1024, F.lit(" --dp 2")))
    return load(spark, sf_dir, "items").where("model is not null").select("model").distinct().select("model", J.context_length(flags).alias("context_length"))


@query("SELECT comment_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS stamp FROM comments")
def time_stamps(spark, sf_dir):
    """Times as stored text, cut to the second."""
    iso = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return load(spark, sf_dir, "comments").select("comment_id", F.substring(iso, 1, 19).alias("stamp"))


# -- state


@query(f"SELECT item_id, iteration, CASE WHEN is_gold THEN 'gold' ELSE model END AS model, 'web' AS corpus_name FROM {_IT} WHERE item_id NOT LIKE 'a%'")
def state_table(spark, sf_dir):
    """Upserts, deletes and a new column with a backfill, as appended files of which the latest row of a key holds."""
    table = ST.Table(spark, scratch(spark, "state"), ["item_id", "iteration"])
    v = item_versions(load(spark, sf_dir, "items"), "model", "is_gold")
    table.append(v.select("item_id", "iteration", "model"), table.next_sequence())
    table.append(v.where("is_gold").select("item_id", "iteration", F.lit("gold").alias("model"), F.lit(None).cast("string").alias("corpus_name")), table.next_sequence())
    table.delete(v.where("item_id like 'a%'"), table.next_sequence())
    rows = table.read()
    return ST.migrate(rows, rows.limit(0), corpus_name=F.lit("web")).select("item_id", "iteration", "model", "corpus_name")


@query("SELECT * FROM (VALUES (1), (2), (3), (4)) t(seq)")
def sequences(spark, sf_dir):
    """Numbers of which no two who ask get the same."""
    table = ST.Table(spark, scratch(spark, "sequence"), ["k"])
    return spark.createDataFrame([(table.next_sequence(),) for _ in range(4)], "seq int")


@query("SELECT 'before' AS moment, count(*) AS n FROM customer UNION ALL SELECT 'after', count(*) FROM (SELECT c_custkey FROM customer UNION SELECT s_suppkey + 100000000 FROM supplier)")
def versioned_cache(spark, sf_dir):
    """A cached read that sees later writes."""
    table = ST.Table(spark, scratch(spark, "cache"), ["k"])
    table.append(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), 1)
    cached = ST.Cached(table)
    before = [cached.read().count(), cached.read().count()][-1]
    table.append(load(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 100_000_000).alias("k")), 2)
    after = cached.read().count()
    cached.close()
    return spark.createDataFrame([("before", before), ("after", after)], "moment string, n long")


@query("SELECT * FROM (VALUES ('first', 'written'), ('same', 'resumed'), ('new key', 'resumed'), ('changed', 'refused')) t(step, outcome)")
def run_guard(spark, sf_dir):
    """Settings of a run: resumed if nothing guarded changed, else refused."""
    path = f"{scratch(spark, 'guard')}/run.json"
    out = []
    for step, settings in (("first", {"model": "a", "n": 1}), ("same", {"model": "a", "n": 2}), ("new key", {"model": "a", "prompt": "p"}), ("changed", {"model": "b"})):
        there = Folder(spark).exists(path)
        try:
            ST.guard(spark, path, settings, {"model"})
            ST.heartbeat(spark, path, beat=step)
            out.append((step, "resumed" if there else "written"))
        except ValueError:
            out.append((step, "refused"))
    return spark.createDataFrame(out, "step string, outcome string")


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL")
def dataset_export(spark, sf_dir):
    """One row an id, typed and compressed, in files of bounded rows; writing again replaces it."""
    path = scratch(spark, "export")
    docs = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", "lang", "crawled_at")
    for _ in range(2):
        ST.export_dataset(docs.unionByName(docs), path, "doc_id", F.col("crawled_at"), partition="lang", rows_per_file=500)
    return spark.read.parquet(path).select("doc_id", "text")


@query("SELECT 'good' AS part, count(*) AS n FROM items WHERE raw_response IS NOT NULL UNION ALL SELECT 'bad', count(*) FROM items WHERE raw_response IS NULL")
def split_sink(spark, sf_dir):
    """Rows that can be written and those that cannot, to two places."""
    path = scratch(spark, "split")
    rows = load(spark, sf_dir, "items").select("item_id", "iteration", "raw_response")
    ST.write_split(rows.where("raw_response is not null"), rows.where("raw_response is null").select("item_id", "iteration"), path, most_bad=1 << 30)
    parts = (("good", spark.read.parquet(path)), ("bad", spark.read.schema("item_id string").json(f"{path}_failures")))
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    return one(*parts[0]).unionByName(one(*parts[1]))


@query("SELECT item_id, iteration, model FROM items WHERE model IS NOT NULL")
def cards_file(spark, sf_dir):
    """The cards payload as line JSON, read again under its schema."""
    path = scratch(spark, "cards")
    ST.write_cards(load(spark, sf_dir, "items").where("model is not null").select("item_id", "iteration", "model"), path)
    return J.read_jsonl(spark, path, T._parse_datatype_string("item_id string, iteration int, model string"))[0].select("item_id", "iteration", "model")


@query("SELECT n_regionkey AS region, count(*) AS n FROM nation GROUP BY 1")
def folder_backup(spark, sf_dir):
    """A folder copied once it is still, then only what changed, at most once a minute."""
    source, target = scratch(spark, "live"), scratch(spark, "backup")
    load(spark, sf_dir, "nation").where("n_regionkey < 3").write.parquet(source)
    now = [1e12]
    backup = ST.Backup(spark, source, target, clock=lambda: now[0])
    first = backup.run()
    again = backup.run()
    load(spark, sf_dir, "nation").where("n_regionkey >= 3").write.mode("append").parquet(source)
    early = backup.run()
    now[0] += 60
    late = backup.run()
    assert first and late and not again and not early
    return spark.read.parquet(target).groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n"))


@query(
    """SELECT user_id::varchar AS reviewer, (event_id % 50)::varchar AS item_id, max_by(CASE WHEN event_type = 'error' THEN 'reject' ELSE 'accept' END, (ts, event_id)) AS verdict FROM events GROUP BY ALL"""
)
def feedback_files(spark, sf_dir):
    """Feedback written as files, picked up by a stream in bounded batches; later answers hold."""
    folder, table = scratch(spark, "feedback_files"), scratch(spark, "feedback_table")
    verdict = F.when(F.col("event_type") == "error", "reject").otherwise("accept")
    rows = load(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("reviewer"), (F.col("event_id") % 50).cast("string").alias("item_id"), F.lit("g").alias("generator"), verdict.alias("verdict"), F.col("ts").cast("timestamp").alias("ts"))
    rows.repartition(3).write.json(folder)
    S.append_batches(S.read_feedback(spark, folder, files_per_trigger=2), table, scratch(spark, "offsets")).awaitTermination()
    return S.latest(spark, table).select("reviewer", "item_id", "verdict")


# -- answers


@query(f"""SELECT item_id, iteration, json_extract_string(a, '$.analysis') AS analysis, json_extract_string(a, '$.reflection_1p') AS reflection_1p FROM (
    SELECT item_id, iteration, CASE WHEN json_valid(raw_response) THEN json_extract_string(raw_response, '$.reflection') END AS a FROM {_IT}) WHERE json_valid(a) AND json_type(json_extract(a, '$.analysis')) = 'VARCHAR' AND json_type(json_extract(a, '$.reflection_1p')) = 'VARCHAR'""")
def parse_direct(spark, sf_dir):
    """Answers that are plain JSON inside JSON, by the tolerant parser."""
    v = item_versions(load(spark, sf_dir, "items"), "raw_response").select("item_id", "iteration", "raw_response")
    inner = F.get_json_object("raw_response", "$.reflection")
    plain = F.udf(_plain, "boolean", useArrow=True)
    rows = v.where(F.startswith(F.ltrim("raw_response"), F.lit("{")) & inner.isNotNull()).where(plain(inner) & plain("raw_response"))
    schema = T._parse_datatype_string("item_id string, iteration int, analysis string, reflection_1p string")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            got = [answers.normalise(answers.extract_object(r) or {}) for r in pdf["raw_response"]]
            yield pd.DataFrame({"item_id": pdf["item_id"], "iteration": pdf["iteration"], **{k: [g.get(k) if isinstance(g.get(k), str) else None for g in got] for k in ("analysis", "reflection_1p")}})

    return rows.mapInPandas(run, schema).where("analysis is not null and reflection_1p is not null")


def _plain(text):
    """Whether a text is JSON as the standard has it."""
    try:
        json.loads(text)
    except (TypeError, ValueError):
        return False
    return True


@query("SELECT review_seq, (SELECT sum(v)::bigint FROM (SELECT unnest(map_values(scores['reflection'])) AS v)) AS total, (SELECT count(*) FROM (SELECT unnest(map_values(scores['reflection'])) AS v)) AS n FROM reviews WHERE scores['reflection'] IS NOT NULL AND len(map_keys(scores['reflection'])) > 0 AND len(list_filter(map_values(scores['reflection']), lambda x: x IS NULL)) = 0")
def parse_judgments(spark, sf_dir):
    """Scores out of a judge's stored answer, here with prose and a fence around it."""
    rows = load(spark, sf_dir, "reviews").select("review_seq", F.try_element_at("scores", F.lit("reflection")).alias("s")).where(F.size("s") > 0)
    rows = rows.where(~F.exists(F.map_values("s"), lambda x: x.isNull()))
    raw = F.concat(F.lit("I think so.\n```json\n{\"scores\": "), F.to_json("s"), F.lit("}\n```\nDone."))
    schema = T._parse_datatype_string("review_seq bigint, total bigint, n bigint")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            got = [answers.parse_judgment(r) for r in pdf["raw"]]
            yield pd.DataFrame({"review_seq": pdf["review_seq"], "total": [sum(g[0].values()) if g else None for g in got], "n": [len(g[0]) if g else None for g in got]})

    return rows.select("review_seq", raw.alias("raw")).mapInPandas(run, schema)


@query("SELECT doc_id, regexp_replace(text, '[\\x{0000}\\x{FFFE}\\x{FFFF}]', '�', 'g') AS clean FROM documents WHERE text IS NOT NULL")
def sanitized_texts(spark, sf_dir):
    """Texts without characters that no file holds."""
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", sanitize(F.col("text")).alias("clean"))


@query("SELECT review_seq, to_json(list_sort(map_keys(scores))) AS voices, false AS heavy FROM reviews WHERE scores IS NOT NULL")
def slim_records(spark, sf_dir):
    """Records without their heavy columns, and without heavy fields inside every voice."""
    rows = load(spark, sf_dir, "reviews").where("scores is not null")
    fat = F.transform_values("scores", lambda k, v: F.struct(v.alias("scores"), F.lit("long").alias("reasoning")))
    slim = strip_heavy(rows.select("review_seq", fat.alias("voices"), "notes"), "voices", columns=("notes",))
    heavy = "reasoning" in slim.schema["voices"].dataType.valueType.names or "notes" in slim.columns
    return slim.select("review_seq", F.to_json(F.array_sort(F.map_keys("voices"))).alias("voices"), F.lit(heavy).alias("heavy"))


# -- model stages

_STUB = "('0x' || left(sha256({0}), 8))::BIGINT"
_GEN = "'I notice this [' || (1 + h % 6) || '.' || (1 + h % 4) || '].'"
_SCORES = ", ".join(f"1 + (jh >> {4 * k}) % 5 AS s{k}" for k in range(4))


@query(
    f"""WITH q AS (SELECT q.item_id, q.iteration, q.gen_prompt, q.model, it.reflection FROM ({{queue}}) q JOIN {_IT} it ON it.item_id = q.item_id AND it.iteration = q.iteration),
    s AS (SELECT *, {_SCORES} FROM (SELECT *, {_STUB.format("'Judge.' || chr(10) || chr(10) || coalesce(reflection, '')")} AS jh FROM q))
    SELECT item_id || '|' || iteration || '|' || gen_prompt || '|' || model AS k, CASE WHEN least(s0, s1, s2, s3) <= 2 OR (s0 + s1 + s2 + s3) / 4.0 < 4 THEN 'reject' ELSE 'accept' END AS decision FROM s"""
)
def rejudge_run(spark, sf_dir):
    """The work queue of versions, prompts and models judged in bulk by the stub judge."""
    v = item_versions(load(spark, sf_dir, "items"), "reflection")
    key = F.concat_ws("|", "item_id", "iteration", "gen_prompt", "model")
    todo = rejudge_queue(spark, sf_dir).join(v, ["item_id", "iteration"]).select(key.alias("k"), F.col("reflection").alias("reflection_1p"))
    return A.annotate(todo, "k", A.get_run("judgments")).select("k", "decision")


@query("SELECT left(sha256(a.model), 8) AS group_id, a.model AS target, b.model AS counterpart FROM (SELECT DISTINCT model FROM items WHERE model IS NOT NULL) a, (SELECT DISTINCT model FROM items WHERE model IS NOT NULL) b WHERE a.model <> b.model")
def cross_iteration(spark, sf_dir):
    """The runs of a cross iteration: every model with every other, those of one target in a group."""
    models = sorted(r[0] for r in load(spark, sf_dir, "items").where("model is not null").select("model").distinct().collect())  # a handful
    return A.cross_runs(spark, models, models)


@query("SELECT doc_id, len(regexp_extract_all('Reflect. ' || text, '\\S+')) AS input_tokens, true AS success FROM documents WHERE text IS NOT NULL")
def throughput_probe(spark, sf_dir):
    """Tokens and success of single requests; their times are measured, and so no two runs agree on them."""
    docs = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.regexp_replace("text", r"[^\S ]|[^\S\n]", " ").alias("text"))
    run = A.get_run("reflections")
    got = A.probe(docs, "doc_id", run, count=lambda s: len(re.findall(r"[^\t\n\f\r ]+", s)))
    return got.where("seconds >= 0").select("doc_id", "input_tokens", "success")


@query("SELECT count(*) AS n, sum(length(text))::bigint AS n_chars FROM documents WHERE text IS NOT NULL")
def pipeline_step(spark, sf_dir):
    """A custom stage with its rank and the number of ranks, over the rows of each partition."""

    def run(rows, rank, world_size):
        assert 0 <= rank < world_size
        for r in rows:
            yield {"doc_id": r["doc_id"], "n_chars": len(r["text"])}

    docs = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    step = A.Step("lengths", T._parse_datatype_string("doc_id bigint, n_chars bigint"), run)
    return A.run_step(docs, step).agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query(f"SELECT it.item_id, it.iteration, it.model, it.gen_prompt, r.n_versions, r.mean_latency FROM {_IT} it JOIN (SELECT iteration, count(*) AS n_versions, sum(latency_ms)::bigint / nullif(count(latency_ms), 0)::double AS mean_latency FROM {_IT} GROUP BY 1) r USING (iteration)")
def items_runs(spark, sf_dir):
    """Each version with what is known of its iteration's run."""
    v = item_versions(load(spark, sf_dir, "items"), "model", "gen_prompt", "latency_ms")
    runs = v.groupBy("iteration").agg(F.count("*").alias("n_versions"), F.try_divide(F.sum("latency_ms").cast("double"), F.count("latency_ms")).alias("mean_latency"))
    return v.drop("latency_ms").join(F.broadcast(runs), "iteration")  # one row an iteration


@query("SELECT comment_id, row_number() OVER (PARTITION BY item_id ORDER BY target_annotator_id DESC NULLS LAST, created_at NULLS FIRST, comment_id) AS place FROM comments")
def mixed_order(spark, sf_dir):
    """Several keys in mixed directions, as the place of each row within its item."""
    from pyspark.sql import Window

    order = Window.partitionBy("item_id").orderBy(F.desc("target_annotator_id"), F.asc("created_at"), "comment_id")
    return load(spark, sf_dir, "comments").select("comment_id", F.row_number().over(order).cast("bigint").alias("place"))


QUERIES, SQL = query.queries, query.sql
SQL["rejudge_run"] = SQL["rejudge_run"].replace("{queue}", JUDGMENT_SQL["rejudge_queue"])
