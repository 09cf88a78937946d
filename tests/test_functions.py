import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.functions import answers as A
from quern.functions import citations as C
from quern.functions import cutpoints as P
from quern.functions import ids as I
from quern.functions import rubric as R
from quern.functions import safety as S
from quern.functions import stats as T
from quern.functions import textchecks as X

KNOWN = ["1.1", "1.2", "5.2", "5.10", "A.1"]


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "score, probs, keep",
    [
        (3, [0.0, 0.0, 0.0, 0.9], True),  # both bounds inclusive
        (2, [0.0, 0.0, 0.9], False),
        (3, [0.0, 0.0, 0.0, 0.89], False),
        (None, [1.0], False),
        (3, None, False),
        (3, [0.9], False),  # index out of range
        (-1, [0.9], False),
    ],
)
def test_safety(spark, score, probs, keep):
    row = spark.createDataFrame([(score, probs)], "s long, p array<double>").select(S.passes_safety(F.col("s"), F.col("p"), 3, 0.9).alias("k"), S.in_band(F.col("s"), F.col("p"), 0.9, 1.0).alias("b")).first()
    assert row.k is keep and row.b is (keep or score == 2)


def test_drop_order(spark):
    df = spark.createDataFrame([(None, "en", True), ("", "xx", False), ("a", "xx", False), ("a", None, True), ("a", "en", False), ("a", "en", True)], "id string, l string, k boolean")
    assert [r.r for r in df.select(S.drop_reason(F.col("id"), F.col("l"), ["en"], F.col("k")).alias("r")).collect()] == ["null_id", "null_id", "language", "language", "safety", "kept"]


@pytest.mark.parametrize(
    "text, ids",
    [(None, []), ("", []), ("a [1.1] b [5.10, 1.1]", ["1.1", "5.10"]), ("[A.1]", ["A.1"]), ("[9.9] [1.1; 1.2]", []), ("[1.1 1.2]", []), ("1.1", []), ("[1.2,1.1 , 5.2]", ["1.2", "1.1", "5.2"])],
)
def test_citations(spark, text, ids):
    assert one(spark, text, "string", lambda x: C.cited_ids(x, KNOWN)) == ids


def test_other_citation_flavours(spark):
    assert one(spark, "x [1.1] [1.1, 9.9] [A.1]", "string", lambda x: C.numeric_citations(x, KNOWN)) == ["1.1", "1.1"]
    assert one(spark, "x [1.1, 9.9] [A.1]", "string", C.citation_strings) == ["[1.1, 9.9]"]
    assert one(spark, "### 1.1 A\n### 1.2 B\n", "string", C.spec_ids) == ["1.1", "1.2"]
    assert one(spark, "### 1.1 A [1.2] [1.2]", "string", C.spec_ids) == ["1.2"]
    got = [r.x for r in spark.createDataFrame([("5.10",), ("A.1",), ("5.2",), ("1.1",)], "x string").orderBy(C.id_order(F.col("x"))).collect()]
    assert got == ["1.1", "5.2", "5.10", "A.1"]
    row = spark.createDataFrame([(None, "[1.2][1.1]", "[1.1][5.2]")], "a string, b string, c string").select(C.cited_union(KNOWN, *map(F.col, "abc")).alias("y")).first()
    assert row.y == ["1.2", "1.1", "5.2"]


def test_identity(spark):
    from hashlib import sha256

    text = "é" * 300
    assert one(spark, text, "string", I.content_id) == sha256(("é" * 200).encode()).hexdigest()[:16]
    ids = [f"i{k}" for k in range(400)]
    got = {r.x: r.y for r in spark.createDataFrame([(i,) for i in ids], "x string").select("x", I.review_split(F.col("x")).alias("y")).collect()}
    assert got == {i: "validation" if int(sha256(i.encode()).hexdigest(), 16) % 4 == 0 else "train" for i in ids}
    assert one(spark, "p_v10.md", "string", I.prompt_version) == 10 and one(spark, "p.md", "string", I.prompt_version) == -1
    u = [r.u for r in spark.range(2000).select(I.uniform("s", F.col("id")).alias("u")).collect()]
    assert min(u) >= 0 and max(u) < 1 and abs(sum(u) / 2000 - 0.5) < 0.03


def test_cut_points(spark):
    rng = random.Random(1)
    texts = ["", "one", " lead", "a b  c\nd ", "x" * 50] + [" ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    import re

    df = spark.createDataFrame([(t,) for t in texts], "x string")
    x = F.col("x")
    rows = df.select("x", P.token_count(x).alias("n"), P.truncate_tokens(x, 5).alias("t"), P.cut_point(x, 5).alias("c"), P.end_slot(x, 5)[0].alias("e"), P.starts(x).alias("s"), P.token_index(x, F.lit(12)).alias("k")).collect()
    for r in rows:
        pieces = re.findall(r"\s*\S+", r.x)
        assert r.n == len(pieces)
        assert r.t == (r.x if len(pieces) <= 5 else "".join(pieces[:5]))
        assert r.c == (None if not r.x else len(r.x) if len(pieces) <= 5 else len("".join(pieces[:5])))
        assert r.e == len("".join(pieces[:5]))
        assert r.s == [len("".join(pieces[:k])) for k in range(len(pieces))]
        ends = [len("".join(pieces[: k + 1])) for k in range(len(pieces))]
        assert r.k == sum(e <= 12 for e in ends)


def test_sampled_index_follows_the_ramp(spark):
    df = spark.range(20_000).select(P.sampled_index(F.lit(1000), I.uniform("r", F.col("id"))).alias("k"))
    got = [r.k for r in df.collect()]
    assert min(got) >= 1 and max(got) <= 999
    assert abs(sum(k < 200 for k in got) / len(got) - 1 / 9) < 0.01
    halves = [sum(a <= k < a + 100 for k in got) for a in range(200, 1000, 100)]
    assert max(halves) / min(halves) < 1.2
    assert [r.k for r in spark.range(2).select(P.sampled_index(F.col("id").cast("int"), F.lit(0.5)).alias("k")).collect()] == [0, 0]


def test_text_checks(spark):
    for text, leaks in (('and "analysis" too', True), ("reflection_1p: oops", True), ("the reflection_1p_variant idea", False), ("a reflection", False)):
        assert one(spark, text, "string", X.leaks_key) is leaks
    assert not one(spark, None, "string", X.leaks_key)
    assert [one(spark, t, "string", X.script_of) for t in ("abc 中", "abc я", "abc", "123")] == ["CJK", "cyrillic", "latin", "?"]
    assert one(spark, '{"a": {"b"', "string", X.looks_truncated) and not one(spark, "{}" + "{" * 900, "string", X.looks_truncated)
    assert one(spark, "<think>x</think> y", "string", X.after_thinking) == "y" and one(spark, "<think>x", "string", X.after_thinking) is None and one(spark, "z", "string", X.after_thinking) == "z"
    assert one(spark, "One two. Last words here. ", "string", X.closing) == "Last words here"
    assert [one(spark, t, "string", X.detect_language) for t in ("the cat of the house", "der Hund und die Katze", "это кошка и дом", "これは猫です。そうです", "short", None)] == ["en", "deu", "rus", "jpn", None, None]
    row = spark.createDataFrame([("en", "en"), ("en", "deu"), (None, "en"), ("fra", "spa"), ("fra", "en"), ("—", "en"), ("", "en"), ("fra", None)], "a string, b string").select(X.in_language(F.col("a"), F.col("b")).alias("y")).collect()
    assert [r.y for r in row] == [True, False, None, True, False, None, None, None]


GOOD = {"analysis": "a", "reflection_1p": "b"}


@pytest.mark.parametrize(
    "raw",
    [
        json.dumps(GOOD),
        "<think>{\"no\": 1}</think>" + json.dumps(GOOD),
        "```json\n" + json.dumps(GOOD) + "\n```",
        'first ```json\n{"x": 1}\n``` then ```json\n' + json.dumps(GOOD) + "\n```",
        "Sure! " + json.dumps(GOOD) + " Done.",
        '{"analysis": "a", "reflection_1p": "b",}',
        "{'analysis': 'a', 'reflection_1p': 'b'}",
        '{"analysis": "a", "reflection_1p": "b"',
        "[" + json.dumps(GOOD) + "]",
        json.dumps({"reflection": json.dumps(GOOD)}),
        json.dumps({"output": [GOOD]}),
        json.dumps({"analysis": "a", "reflection": "b"}),
        json.dumps({"wrap": {"analysis": "a", "reflecting_1p": "b"}}),
        '```json\n{"analysis": "a",\n{"reflection_1p": "b"}\n```',
        json.dumps({"analysis": "a", "reflection_1p": ["b"]}),
    ],
)
def test_answers(raw):
    assert A.parse_answer(raw) == ("a", "b", None, None)


def test_answer_failures():
    assert A.parse_answer(None)[2:] == ("api", "empty answer") and A.parse_answer("  ")[2] == "api"
    assert A.parse_answer("no object")[2:] == ("parse", "no object")
    assert A.parse_answer('{"analysis": "a"}')[3] == "missing reflection_1p"
    assert A.parse_answer(json.dumps({"analysis": "a", "reflection_1p": 'x "reflection_1p": "y"'}))[3] == "key in text"
    assert A.parse_answer('{"analysis": "ok", "reflection_1p": "Ich erkenne „eine These" [3.3] im Text."}')[1] == 'Ich erkenne „eine These" [3.3] im Text.'
    assert A.parse_answer(json.dumps({"analysis": "I will produce reflection_1p next.", "reflection_1p": "b"}))[3] is None
    assert A.extract_object('{"a": "\\d"}') == {"a": "\\d"}
    assert A.parse_judgment('{"scores": {"a": 4, "b": "5"}}') == ({"a": 4, "b": 5}, 4.5)
    assert A.parse_judgment('{"scores": {}}') is None and A.parse_judgment("x") is None


def test_answers_over_a_table(spark):
    rows = [(1, json.dumps(GOOD)), (2, json.dumps({"reflection": json.dumps(GOOD)})), (3, "bad"), (4, None), (5, "x " + json.dumps(GOOD))]
    got = {r.k: (r.analysis, r.category) for r in A.parse_answers(spark.createDataFrame(rows, "k int, raw string"), "raw").collect()}
    assert got == {1: ("a", None), 2: ("a", None), 3: (None, "parse"), 4: (None, "api"), 5: ("a", None)}


@pytest.mark.parametrize(
    "scores, decision, mean",
    [
        ({"v": {"a": 4, "b": 4}}, "accept", 4.0),
        ({"v": {"a": 5, "b": 2}}, "reject", 3.5),
        ({"v": {"a": 3, "b": 4}}, "reject", 3.5),
        ({"v": {"a": 5}, "w": {"a": 3}}, "accept", 4.0),
        ({}, None, None),
        (None, None, None),
        ({"v": None}, None, None),
        ({"v": {}, "odd": {"x": 4}}, "accept", 4.0),
    ],
)
def test_rubric(spark, scores, decision, mean):
    row = spark.createDataFrame([(scores,)], "s map<string,map<string,int>>").select(R.rubric_decision(F.col("s")).alias("d"), R.mean_score(F.col("s")).alias("m")).first()
    assert (row.d, row.m) == (decision, mean)


def test_majority_first_seen_wins_ties(spark):
    v = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "x", 1), ("b", "x", 2), ("b", "y", 0), ("c", None, 0)], "k string, d string, o long")
    assert {r.k: r.d for r in R.majority(v, ["k"], "d", "o").collect()} == {"a": "y", "b": "x", "c": "accept"}


def test_agreement_statistics_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(g, rng.randint(1, 5), rng.randint(1, 5), rng.choice(["accept", "reject", None]), rng.choice(["accept", "reject"])) for g in ("p", "q") for _ in range(60)]
    rows += [("one", 1, 2, "accept", "accept"), ("flat", 1, 2, "accept", "accept"), ("flat", 1, 3, "accept", "accept")]
    df = spark.createDataFrame(rows, "g string, x long, y long, a string, b string")
    x, y, a, b = map(F.col, "xyab")
    got = {r.g: r for r in df.groupBy("g").agg(T.pearson(x, y).alias("r"), T.kappa(a, b).alias("k"), T.kappa(a, b, "tools").alias("t"), T.concordance(a, b).alias("c")).collect()}
    rho = {r.g: r.spearman for r in T.spearman(df, "x", "y", "g").collect()}

    def pearson(u, v):
        n, mu, mv = len(u), sum(u) / len(u), sum(v) / len(v)
        su, sv = sum((i - mu) ** 2 for i in u), sum((j - mv) ** 2 for j in v)
        return None if n < 2 or not su or not sv else sum((i - mu) * (j - mv) for i, j in zip(u, v)) / (su * sv) ** 0.5

    def ranks(u):
        return [sum(w < i for w in u) + (sum(w == i for w in u) + 1) / 2 for i in u]

    for g in ("p", "q"):
        u, v = [r[1] for r in rows if r[0] == g], [r[2] for r in rows if r[0] == g]
        ab = [(r[3], r[4]) for r in rows if r[0] == g and r[3]]
        po = sum(i == j for i, j in ab) / len(ab)
        ca, cb = Counter(i for i, _ in ab), Counter(j for _, j in ab)
        pe = sum(ca[k] * cb[k] for k in ca) / len(ab) ** 2
        assert got[g].r == pytest.approx(pearson(u, v)) and rho[g] == pytest.approx(pearson(ranks(u), ranks(v)))
        assert got[g].k == pytest.approx((po - pe) / (1 - pe)) and got[g].t == pytest.approx(got[g].k) and got[g].c == pytest.approx(po)
    assert got["one"].r is None and got["one"].k == 1.0 and got["one"].t is None
    assert got["flat"].r is None and got["flat"].k == 1.0 and got["flat"].t is None and got["flat"].c == 1.0


def test_index_percentile(spark):
    rng = random.Random(2)
    values = [rng.randint(0, 9) for _ in range(101)]
    row = T.index_percentile(spark.createDataFrame([(v,) for v in values], "v long"), "v", {"p0": 0.0, "p5": 0.5, "p9": 0.95, "p1": 1.0}).first()
    s = sorted(values)
    assert (row.p0, row.p5, row.p9, row.p1, row.n) == (s[0], s[50], s[min(100, int(0.95 * 101))], s[100], 101)


def test_jaccard_and_total(spark):
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    assert [round(r.j, 3) for r in df.select(T.jaccard(F.col("a"), F.col("b")).alias("j")).collect()] == [1.0, 0.0, 0.333]
    t = T.per_group_total(spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "g string, v int"), "g", "TOTAL", F.sum("v").alias("s"))
    assert {r.g: r.s for r in t.collect()} == {"x": 3, "y": 3, "TOTAL": 6}


def test_majority_without_a_vote_accepts(spark):
    from quern.functions.rubric import majority

    rows = [("a", "reject", 1), ("a", "accept", 2), ("a", "reject", 3), ("b", None, 1), ("c", "accept", 2), ("c", "reject", 1), ("d", None, 1), ("d", "reject", 2)]
    got = majority(spark.createDataFrame(rows, "k string, v string, o int"), ["k"], "v", "o").collect()
    assert {r.k: (r.v, r.n_votes) for r in got} == {"a": ("reject", 3), "b": ("accept", 0), "c": ("reject", 2), "d": ("reject", 1)}


def test_headings_of_third_level_alone_name_sections(spark):
    from quern.functions.citations import spec_ids
    from quern.functions.rendering import spec_sections

    text = "## 1.1 Chapter\n### 1.2 Truth\nbody\n#### 1.3 Deeper\nmore"
    assert spark.range(1).select(spec_ids(F.lit(text)).alias("x")).first().x == ["1.2"]
    assert spec_sections(text) == [("1.2", "Truth", "body")]


def test_log_sections_and_flags(spark):
    from quern.sources.jsonl import context_length, log_summary

    log = "[text] a\n[tool] b\nlost\n[text] ## Final Summary\nkept\n[done] x\nlost too"
    row = spark.createDataFrame([(log, "--x --context-length=4096"), ("no text", "--context-length 8"), (None, None)], "l string, f string").select(log_summary(F.col("l")).alias("s"), context_length(F.col("f")).alias("n")).collect()
    assert [tuple(r) for r in row] == [("## Final Summary\nkept", 4096), (None, 8), (None, None)]


@pytest.mark.parametrize("path", ["", None])
def test_token_offsets(spark, path):
    from quern.functions import tokenizer as K

    path = K.TOKENIZER if path is None else path
    texts = ["The old miller, 1950.", "日本語の本🎉 é", " ", "a", "x" * 3000, None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("s", K.token_spans(F.col("t"), path))
    cut, (end, slot), index = K.cut_point(F.col("t"), F.col("s"), 3), K.end_slot(F.col("s"), 3), [K.token_index(F.col("s"), F.lit(o)).alias(f"i{o}") for o in (0, 1, 5, 9000)]
    head, kept = K.truncated(F.col("t"), F.col("s"), 3)
    rows = df.where("t is not null").select("k", "s", cut.alias("cut"), end.alias("end"), slot.alias("slot"), head.alias("head"), kept.alias("kept"), *index).orderBy("k").collect()
    for r in rows:
        text, (starts, ends) = texts[r.k], K.offsets(texts[r.k], path)
        assert r.s.starts == list(starts) and r.s.ends == list(ends) and starts[0] == 0 and ends[-1] == len(text)
        assert all(a <= b for a, b in zip(starts, starts[1:])) and all(a < b for a, b in zip(starts, ends))
        assert r.cut == (len(text) if len(starts) <= 3 else starts[3]) and r.head == text[: r.cut] and r.kept == r.slot == min(3, len(starts)) and r.end == ends[r.slot - 1]
        for o in (0, 1, 5, 9000):
            later = [k for k, s in enumerate(starts) if s >= o]
            assert r[f"i{o}"] == (len(starts) if not later else later[0] if starts[later[0]] == o else max(later[0] - 1, 0))
    if not path:
        assert [len(r.s.starts) for r in rows] == [len(t.encode()) for t in texts[:-1]]
    with pytest.raises(Exception, match="without tokens"):
        spark.createDataFrame([("",)], "t string").withColumn("s", K.token_spans(F.col("t"), path)).select(K.cut_point(F.col("t"), F.col("s"), 3)).collect()
