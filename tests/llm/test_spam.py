import time

import pytest

from quern.llm.spam import features, spam_scores

PROSE = "The old miller repairs the bridge behind the school. Nobody asks him why, although the village still talks about it. In the end a tired clerk brings him the letter from the town hall, and he reads it by candlelight. It says that the harbour will be closed before winter, which is harder than it sounds."
LINKS = "\n".join(f"- [cheap tyres](https://shop{k}.example/tyres?id={k})" for k in range(20))
SPAM = [
    "Tags: " + "phone case, used tyres, dog food, " * 12,
    "wedding cake buy wedding cake best wedding cake near me wedding cake cheap wedding cake " * 6,
    LINKS,
    " ".join(f"#Buy{w}Online" for w in ("Tyres", "Cake", "Hose")) * 10,
    "\n".join(f"hair dryer KT-{k}83 13{k}.55 in: running shoes/tax advisor" for k in range(9)),
    "Order used tyres today. Used tyres here! Our used tyres are the used tyres for used tyres fans. Used tyres? Buy used tyres, cheap used tyres. " * 3,
    "手机壳 沙发 床垫 手机壳 沙发 床垫 " * 12,
    PROSE + "\n" + LINKS,
]
FINE = [
    PROSE,
    PROSE + "\n\n- https://a.example/note_1\n- https://b.example/note_2",
    "\n".join(f"{PROSE.split('.')[k % 4].strip()}.\nAnd the river rolls on to the sea." for k in range(8)),  # a refrain
    "\n".join(f"{w}: the {w} is what a {v} keeps under the stairs, as the rules say." for w, v in zip("key lamp rope bell".split(), "guard clerk nurse cook".split())),
    PROSE + " " + PROSE.replace("bridge", "tax advisor").replace("letter", "tax advisor"),
    "陌生人忘记了那份旧合同，因为没有别人愿意负责。后来，退休的会计在旧车站旁边承诺了一半的收成。村里的人至今还在谈论这件事，虽然规定不是这样写的。",
]


@pytest.mark.parametrize("text", SPAM)
def test_spam_density(text):
    assert features(text)[1][0] > 0.5


@pytest.mark.parametrize("text", FINE)
def test_fine_density(text):
    assert features(text)[1][0] <= 0.5


def test_odd_markup_takes_linear_time():
    began = time.perf_counter()
    for odd in ("<a ", "[", "<b", "http", "."):
        features(odd * 100_000)
    assert time.perf_counter() - began < 20


def test_the_distance_alone_selects(spark, tables, monkeypatch):
    docs = tables("documents", "sf0.01")
    count = lambda: spam_scores(docs).where("is_spam").count()
    some = count()
    assert 0 < some < 80
    monkeypatch.setattr("quern.llm.spam.CUT", 1.0)
    assert count() > 2 * some


def test_scores_by_language(spark, tables):
    base = tables("documents", "sf0.01").select("doc_id", "text", "lang")
    more = [(10_000_000 + k, t, "en") for k, t in enumerate(SPAM)] + [(20_000_000 + k, t, None) for k, t in enumerate(FINE)] + [(None, SPAM[0], "en"), (3, None, "en"), (4, "", "en"), (5, "  \n ", "en"), (6, "?!", "en"), (7, PROSE * 2000, "en")]
    docs = base.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    found = {r.doc_id: r.is_spam for r in spam_scores(docs.selectExpr("*", "1 as links", "true as is_spam", "'x' as lang_guess")).collect()}
    assert all(found[10_000_000 + k] for k in range(len(SPAM))) and not any(found[20_000_000 + k] for k in range(len(FINE)))
    assert None not in found and found[7] is False and 0 < sum(found[r.doc_id] for r in base.collect() if r.doc_id in found) < 80


def test_empty_table(spark, tables):
    assert spam_scores(tables("documents").limit(0)).collect() == []
