import json
import math
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators import annotate as A
from quern.operators import latest as L
from quern.operators import sampling as S
from quern.sources import corpus as C
from quern.sources import jsonl as J
from quern.sources import state as ST


def test_keep_last_and_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "z"), ("b", 1, "y")], "k string, o int, v string")
    assert {r.k: r.v for r in L.keep_last(df, ["k"], F.col("o")).collect()} == {"a": None, "b": "y"}
    assert {r.k: r.v for r in L.keep_first(df, ["k"], F.col("o")).collect()} == {"a": "x", "b": "y"}
    assert L.keep_last(df.limit(0), ["k"], F.col("o")).collect() == []


def test_resumption(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    failures = spark.createDataFrame([("c", 1), ("c", 2), ("b", 1)], "k string, t int")
    capped = L.given_up(failures, ["k"], 2)
    left = L.todo(items, spark.createDataFrame([("a",), ("a",), (None,)], "k string"), ["k"], capped)
    assert [r.k for r in left.collect()] == ["b"]
    assert sorted((r.k, r.t, r.attempt) for r in L.attempt_numbers(failures, ["k"], F.col("t")).collect()) == [("b", 1, 1), ("c", 1, 1), ("c", 2, 2)]
    both = L.union_preferring(items.withColumn("s", F.lit(1)), spark.createDataFrame([("a", 2), ("d", 2)], "k string, s int"), ["k"])
    assert sorted((r.k, r.s) for r in both.collect()) == [("a", 1), ("b", 1), ("c", 1), ("d", 2)]


def test_samples(spark):
    df = spark.createDataFrame([(k, "abc"[k % 3] if k % 10 else "a") for k in range(300)], "id int, g string")
    one, two = S.reservoir(df, 50, "s", "id").collect(), S.reservoir(df.repartition(5), 50, "s", "id").collect()
    assert one == two and len({r.id for r in one}) == 50
    assert one != S.reservoir(df, 50, "t", "id").collect()
    counts = {}
    for r in S.balanced(df, "g", 100, 3, "s", "id").collect():
        counts[r.g] = counts.get(r.g, 0) + 1
    assert sum(counts.values()) == 100 and max(counts.values()) - min(counts.values()) <= 2
    turns = [r.g for r in S.round_robin(df, "g", 7, "s", "id").collect()]
    assert sorted(turns) == ["a", "a", "a", "b", "b", "c", "c"]
    gold = df.where("id < 5").select("id")
    mix = [r.id for r in S.gold_and_fresh(gold, df.select("id"), 20, 10, "s", "id").collect()]
    assert len(mix) == 20 and len(set(mix)) == 20 and {0, 1, 2, 3, 4} <= set(mix)
    top = S.top_up(df.where("id < 12"), F.col("id") < 2, 10, "id").collect()
    assert len(top) == 10 and {0, 1} <= {r.id for r in top}


def test_annotate_routes_failures(spark):
    docs = spark.createDataFrame([(k, None if k == 3 else f"text {k}") for k in range(60)], "doc_id int, text string")
    good, bad = A.split_failures(A.annotate(docs, "doc_id", A.get_run("reflection")))
    n_good, n_bad = good.count(), bad.count()
    assert n_good + n_bad == 60 and n_bad > 0 and {r.category for r in bad.collect()} == {"parse"}
    judged = A.annotate(good, "doc_id", A.get_run("judge")).collect()
    assert len(judged) == n_good
    for r in judged:
        mean = sum(r.scores.values()) / 4
        assert r.aggregate == mean and r.decision == ("reject" if min(r.scores.values()) <= 2 or mean < 4 else "accept")
    with pytest.raises(KeyError):
        A.get_run("none")
    assert A.cross_pairs(["a"], ["a", "b", "c"]) == [("a", "b"), ("a", "c")]


def test_retries_by_kind_of_error():
    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 4:
            raise ConnectionError
        return "ok"

    assert A.retry(flaky, "p", sleep=lambda s: None) == "ok" and len(calls) == 4
    calls.clear()
    with pytest.raises(A.Refused):
        A.retry(lambda p: calls.append(p) or " ", "p", sleep=lambda s: None)
    assert len(calls) == 5
    calls.clear()
    with pytest.raises(ConnectionError):
        A.retry(lambda p: (calls.append(p), (_ for _ in ()).throw(ConnectionError))[1], "p", sleep=lambda s: None)
    assert len(calls) == 8


def _shards(spark, root, names):
    schema = "text string, id string, safety_score long, safety_probs array<double>, metadata struct<language:string, embeddings:array<double>>"
    for n in names:
        rows = [(None if k == 0 else f"{n}-{k}", f"{n}/{k}", k, [0.1] * 6, ("en", [0.0] * 8)) for k in range(6)]
        pdf = spark.createDataFrame(rows, schema).coalesce(1)
        tmp = root / f"_{n.replace('/', '_')}"
        pdf.write.parquet(str(tmp))
        (root / n).parent.mkdir(parents=True, exist_ok=True)
        next(tmp.glob("part-*.parquet")).rename(root / f"{n}.parquet")
        shutil.rmtree(tmp)


def test_corpus_scan(spark, tmp_path):
    _shards(spark, tmp_path, ["000_00001", "000_00000", "000_00002"])
    flat = C.Corpus("web", str(tmp_path))
    df = C.read_corpus(spark, flat)
    rows = df.orderBy("source_shard", "row_index").collect()
    assert len(rows) == 18 and rows[0].text == "" and rows[1].source_shard == "000_00000.parquet" and rows[1].language == "en"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "embeddings" not in plan  # nested pruning
    assert len(C.list_shards(spark, flat, cap=2)) == 2
    with pytest.raises(ValueError, match="missing"):
        C.assert_projection(spark.read.parquet(str(tmp_path)), ("text", "metadata.missing"))
    assert sorted(r.task for r in C.stride(df.select("source_shard"), 2).collect()) == [0, 0, 1]
    assert [r.text for r in C.first_texts(df, 2).collect()] == ["", "000_00000-1"]
    with pytest.raises(ValueError):
        C.first_texts(df, 99)
    assert C.linspace_shards(list("abcdefg"), 3) == ["a", "d", "g"]


def test_language_directories(spark, tmp_path):
    _shards(spark, tmp_path, ["deu_Latn/0", "fra_Latn/0", "spa_Latn/0"])
    per = C.Corpus("multi", str(tmp_path), "per_language_dir", {"deu": "deu_Latn", "fra": "fra_Latn"})
    assert [p.rsplit("/", 2)[1] for p in C.list_shards(spark, per, ["deu"])] == ["deu_Latn"]
    assert C.read_corpus(spark, per, ["fra"]).select("source_shard").distinct().collect()[0][0] == "fra_Latn/0.parquet"
    with pytest.raises(ValueError):
        C.list_shards(spark, per, ["ita"])


def test_jsonl(spark, tmp_path):
    (tmp_path / "j1__on__g1.jsonl").write_text('{"doc_id": "a", "n": 1}\n\n{"doc_id": "b", "n": 2}\nnot json\n{"doc_id": "a", "n": 3}\n{"doc_id": "c"')
    schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("n", T.LongType())])
    good, bad = J.read_jsonl(spark, str(tmp_path / "*.jsonl"), schema)
    assert bad.count() == 2
    last = L.keep_last(good.where("doc_id is not null").select("doc_id", "n", "ordinal"), ["doc_id"], F.col("ordinal"))
    assert {r.doc_id: r.n for r in last.collect()} == {"a": 3, "b": 2}
    judge, generator = J.judge_and_generator(F.col("file_name"))
    assert good.select(judge.alias("j"), generator.alias("g")).distinct().collect() == [("j1", "g1")]
    (tmp_path / "en.json").write_text(json.dumps([{"pid": "01", "text": "x"}]))
    assert J.read_json_arrays(spark, str(tmp_path / "en.json"), T.StructType([T.StructField("pid", T.StringType()), T.StructField("text", T.StringType())]), "edge").first().item_id == "edge-01-en"
    (tmp_path / "run.log").write_text("start\nloss=0.5 step=3\n")
    assert J.scrape_logs(spark, str(tmp_path / "run.log"), {"loss": r"loss=(\S+)"}).collect()[0].loss == "0.5"
    (tmp_path / "metadata.json").write_text(json.dumps({"run_id": "r", "started_at": "2025-01-01T00:00:00.123Z", "status": "done", "candidates": ["a", "b"]}))
    row = J.run_listing(spark, str(tmp_path / "metadata.json")).first()
    assert (row.started_at, row.n_candidates) == ("2025-01-01T00:00:00", 2)


def test_state(spark, tmp_path):
    t = ST.Table(spark, str(tmp_path / "t"), ["k"])
    assert t.next_sequence() == 1
    t.append(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 1)
    t.append(spark.createDataFrame([("a", 2, "new")], "k string, v int, extra string"), 2)
    t.delete(spark.createDataFrame([("b",)], "k string"), 3)
    assert t.next_sequence() == 4
    assert [(r.k, r.v, r.extra) for r in t.read().collect()] == [("a", 2, "new")]
    old, new = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("b", "x")], "k string, mode string")
    assert {r.k: r.mode for r in ST.migrate(old, new, mode=F.lit("m")).collect()} == {"a": "m", "b": "x"}
    p = str(tmp_path / "run.json")
    ST.guard(spark, p, {"a": 1, "b": 2}, {"a"})
    ST.guard(spark, p, {"a": 1, "b": 3, "c": 4}, {"a"})
    with pytest.raises(ValueError, match="a"):
        ST.guard(spark, p, {"a": 2}, {"a"})
    ST.heartbeat(spark, p, beat=1)
    assert json.loads(open(p).read())["beat"] == 1


def test_export_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "r0"), ("a", 2, "r1"), ("b", 1, "r0")], "doc_id string, o int, rank string")
    for _ in range(2):
        ST.export_dataset(df, str(tmp_path / "out"), "doc_id", F.col("o"), partition="rank")
    assert sorted((r.doc_id, r.o) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 2), ("b", 1)]
    good = df.where("o = 1")
    assert ST.write_split(good, df.where("o = 2"), str(tmp_path / "split")) == 1
    with pytest.raises(RuntimeError):
        ST.write_split(good, df, str(tmp_path / "split2"), most_bad=2)
    ST.write_cards(df, str(tmp_path / "cards"))
    assert spark.read.json(str(tmp_path / "cards")).count() == 3
    tasks = spark.createDataFrame([(True, 5, 1), (False, 2, 0)], "done boolean, n_docs long, n_failed long")
    assert math.isclose(ST.progress(tasks).first().pct, 50.0)


def test_cache_builds_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    path = str(tmp_path / "bench")
    assert C.cached(spark, path, build).count() == C.cached(spark, path, build).count() == 3 and built == [1]
    assert C.list_files(["b/2.parquet", "a/1.parquet", "a/x.txt"], "a/") == ["a/1.parquet"] and len(C.list_files(["b/2.parquet", "a/1.parquet"], "z/")) == 2


def test_rendering(spark):
    from quern.functions import rendering as H

    row = spark.createDataFrame([("a <b> [1.1] 1.1 [9.9]",)], "t string").select(H.hover_citations(F.col("t"), {"1.1": 'So "x" $1'}).alias("h")).first()
    assert row.h == 'a &lt;b&gt; [<abbr title="So &quot;x&quot; $1">1.1</abbr>] 1.1 [9.9]'
    assert H.spec_sections("# T\n### 1.1 One\nbody\n\n### A.1 Two\nmore\n# End\nno") == [("1.1", "One", "body"), ("A.1", "Two", "more")]
    schema = "id int, raw string, j map<string, struct<scores: map<string,int>, reasoning: string, model_reasoning: string>>"
    slim = H.strip_heavy(spark.createDataFrame([(1, "x", {"v": ({"a": 1}, "long", "long")})], schema), "j", columns=("raw",))
    assert slim.columns == ["id", "j"] and slim.first().j["v"].asDict() == {"scores": {"a": 1}}
    assert spark.createDataFrame([("a\x00b￿",)], "t string").select(H.sanitize(F.col("t")).alias("t")).first().t == "a�b�"


def test_bucketed_rank_is_row_number(spark):
    from pyspark.sql import Window

    from quern.operators.ranking import bucketed_rank

    df = spark.createDataFrame([(None if k % 7 == 0 else "hot" if k % 3 else "b", k % 5, (k * 37) % 101) for k in range(200)], "g string, n int, v int")
    got = bucketed_rank(df, ["g"], F.floor(F.col("v") / 10), ["v", "n"])
    want = df.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy("v", "n")).cast("bigint"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert bucketed_rank(df.limit(0), ["g"], F.col("v"), ["v"]).collect() == []


def test_a_pool_that_is_too_small_fails(spark):
    from quern.operators.sampling import per_shard_reservoir

    df = spark.range(30).selectExpr("id", "id % 3 as shard")
    assert per_shard_reservoir(df, "shard", 12, 3, "s", "id", strict=True).count() == 12
    with pytest.raises(Exception, match="24 rows of 100"):
        per_shard_reservoir(df, "shard", 100, 25, "s", "id", strict=True).collect()
    assert per_shard_reservoir(df, "shard", 100, 25, "s", "id").count() == 24


def test_sequences_are_exclusive(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    table = ST.Table(spark, str(tmp_path / "t"), ["k"])
    table.append(spark.createDataFrame([("a",)], "k string"), 7)
    with ThreadPoolExecutor(4) as pool:
        got = sorted(pool.map(lambda _: ST.Table(spark, str(tmp_path / "t"), ["k"]).next_sequence(), range(8)))
    assert got == list(range(8, 16))


def test_backup_waits_until_a_folder_is_still(spark, tmp_path):
    source, target, now = tmp_path / "a", tmp_path / "b", [0.0]
    (source / "x").mkdir(parents=True)
    (source / "x" / "1.txt").write_text("one")
    now[0] = (source / "x" / "1.txt").stat().st_mtime + 5
    backup = ST.Backup(spark, str(source), str(target), clock=lambda: now[0])
    assert backup.run() == 0  # changed five seconds ago
    assert backup.run(critical=True) == 1 and (target / "x" / "1.txt").read_text() == "one"
    now[0] += 1000
    assert backup.run() == 0  # nothing new
    (source / "x" / "1.txt").write_text("other")
    now[0] += 1000
    assert backup.run() == 1 and (target / "x" / "1.txt").read_text() == "other"


def test_linear_percentiles_equal_numpy(spark):
    import numpy as np

    from quern.functions.stats import linear_percentiles

    rows = [("a", int(x)) for x in np.random.default_rng(3).integers(0, 40, 301)] + [("b", 5), ("c", None)]
    got = {r.g: r for r in linear_percentiles(spark.createDataFrame(rows, "g string, v int"), "v", {"p1": 0.01, "p50": 0.5, "p99": 0.99}, "g").collect()}
    mine = [v for g, v in rows if g == "a"]
    assert [got["a"].p1, got["a"].p50, got["a"].p99] == pytest.approx([np.percentile(mine, p) for p in (1, 50, 99)])
    assert got["b"].p1 == 5 and "c" not in got


def test_steps_know_their_rank(spark):
    from pyspark.sql import types as T

    from quern.operators.annotate import Step, run_step

    step = Step("ranks", T.StructType([T.StructField("rank", T.LongType()), T.StructField("world", T.LongType())]), lambda rows, rank, world: ({"rank": rank, "world": world} for _ in rows))
    got = {(r.rank, r.world) for r in run_step(spark.range(0, 100, 1, 4), step).collect()}
    assert got == {(k, 4) for k in range(4)}
