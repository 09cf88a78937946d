import random

import pytest

from quern.llm import quality as Q
from quern.llm.quality import Layout, alignment, autocorrelation, common_list, fit_kinds, periodicity, statistics, text_kind, text_statistics

rng = random.Random(3)
PROSE = "The old miller repairs the bridge behind the school. Nobody asks him why, although the village still talks about it. In the end a tired clerk brings him the letter from the town hall, and he reads it by candlelight."
NOUNS = ["the old bridge", "a tired clerk", "the plain letter", "a rusty key of the mill", "the blue door", "cold soup", "the wet coat", "a grey stone"]
WRAPPED = "\n".join([PROSE[i : i + 50] for i in range(0, len(PROSE), 50)])
KINDS = [
    (PROSE, None),
    (WRAPPED, None),
    ("A: I saw the letter, and it was old.\n— Nobody asks him why, although the village talks.\nB: The miller repairs the bridge for them.\nA: It was in the town hall all the time.", None),
    ("Dear clerk,\n\n" + PROSE + "\n\nThe miller", None),
    (PROSE + "\n\n- the old bridge\n- a rusty key\n\n" + PROSE, None),
    ("It is late.", None),
    ("\n".join(f"{k}. {x}" for k, x in enumerate(NOUNS, 1)), "list"),
    ("Things to find\n----\n" + "; ".join(NOUNS * 2), "list"),
    ("\n".join(NOUNS), "list"),
    ("\n".join(f"- [ ] {x}" for x in NOUNS), "list"),
    ("\n".join(f"| {a} | {k} | {k * 7}.5% |" for k, a in enumerate(NOUNS)), "table"),
    ("\n".join(f"{a}\t{k}\t{k * 31}" for k, a in enumerate(NOUNS)), "table"),
    ("\n".join(f"{a};{k};{k * 31};x" for k, a in enumerate(NOUNS)), "table"),
    ("\n".join(f"{a:<30}{k:<8}{k * 31}" for k, a in enumerate(NOUNS)), "table"),
    ("<table>" + "".join(f"<tr><td>{a}</td><td>{k}</td></tr>" for k, a in enumerate(NOUNS)) + "</table>", "table"),
    (" ".join("".join(rng.choice("bcdfghjklmqwz") for _ in range(rng.randint(3, 12))) for _ in range(40)), "junk"),
    ("{}|" * 5 + "".join(rng.choice("!@#$%^&*()_+=~") for _ in range(200)), "junk"),
    ("the tired clerk " * 40, "junk"),
    (PROSE.encode().decode("latin-1").replace("e", "Ã©Â¼"), "junk"),
]


#: Prose on a subject and in languages of which the fit has seen nothing.
STRANGE = [
    "Photosynthesis converts light energy into chemical energy inside chloroplasts. Pigments such as chlorophyll absorb photons, and electrons move through thylakoid membranes.",
    "Stary młynarz naprawia most za szkołą. Nikt go nie pyta dlaczego, chociaż wieś wciąż o tym mówi. W końcu zmęczony urzędnik przynosi mu list z ratusza.",
    "De oude molenaar herstelt de brug achter de school. Niemand vraagt hem waarom, hoewel het dorp er nog steeds over praat.",
    "يصلح الطحان العجوز الجسر خلف المدرسة. لا أحد يسأله لماذا، رغم أن القرية لا تزال تتحدث عن ذلك. في النهاية يحضر له موظف متعب الرسالة.",
]


@pytest.fixture(scope="module")
def model(tables):
    return fit_kinds(Q.sample_texts(tables("items", "sf0.01")))


@pytest.mark.parametrize("n", range(len(KINDS)))
def test_kinds(model, n):
    text, kind = KINDS[n]
    assert statistics(text, model)["text_kind"] == kind


def test_prose_of_unknown_words_is_prose(model):
    assert [statistics(t, model)["text_kind"] for t in STRANGE] == [None] * len(STRANGE)
    assert statistics(PROSE, fit_kinds([]))["text_kind"] is None


def test_layout_has_a_say(model):
    """Without alignment, periodicity and autocorrelation the fitted weights give other kinds."""
    texts = [t for t, _ in KINDS]
    full = [statistics(t, model)["text_kind"] for t in texts]
    flat = Q.Kinds(model.grams.grams, model.weights.copy())
    flat.weights[1:5] = 0
    assert sum(a != b for a, b in zip(full, [statistics(t, flat)["text_kind"] for t in texts])) >= 2


def test_layout_measures():
    assert periodicity(["0-", "2d", "0-", "2d", "0-", "2d"]) == 1 and periodicity(["0", "1-", "2d", "3"]) == 0 and periodicity([]) == 0
    assert autocorrelation([5, 5, 5]) == 1 and autocorrelation([1, 9, 1, 9, 1, 9]) < -0.5 and autocorrelation([3]) == 0
    rows, share = alignment(["a;b;c", "d;e;f", "g;h;i", "prose"])
    assert set(rows) == {0, 1, 2} and set(rows.values()) == {1.0} and share == 0.75
    ragged, _ = alignment(["a    b     c", "dd  eee   ffffffff", "g   h   i"])
    straight, _ = alignment(["a    b    c", "dd   ee   f", "g    h    i"])
    assert sum(straight.values()) > sum(ragged.values())


def test_held_out_kinds(tables):
    """Layouts made of other sentences than those of the fit."""
    texts = [r.text for r in tables("items", "sf0.01").where("text is not null").orderBy("item_id").collect()]
    fitted = fit_kinds(texts[: len(texts) // 2])
    rng = random.Random(5)
    sents = Q._sentences(texts[len(texts) // 2 :])
    right = total = 0
    for make, want in ((Q._prose, None), (Q._list, "list"), (Q._table, "table"), (Q._junk, "junk")):
        for _ in range(150):
            lay = Layout(make(rng, sents), fitted.grams)
            if len(lay.dense) >= Q.SHORT:
                right, total = right + (text_kind(lay, fitted)[0] == want), total + 1
    assert right / total > 0.95


def test_figures(model):
    s = statistics("One two three.\nfour (five)", model, frozenset({"one"}))
    assert s["n_words"] == 5 and s["mean_word_length"] == 3.8 and s["ending_share"] == 0.5
    assert s["symbol_share"] == pytest.approx(3 / 22) and s["common_share"] == 0.2
    assert statistics(None, model) is None and statistics(" \n\t", model) is None
    assert statistics("?", model)["n_words"] == 0
    assert statistics(PROSE * 3000, model)["text_kind"] is None
    for odd in ("<td", "a.", "(", "- ", "\x00", "|"):
        assert statistics(odd * 50_000, model) is not None


def test_tables(spark):
    rows = [("a", 1, PROSE), ("a", 2, PROSE), ("b", 1, "\n".join(NOUNS)), ("c", 1, None), ("d", 1, "  "), (None, 1, PROSE)]
    items = spark.createDataFrame(rows, "item_id string, iteration int, text string").selectExpr("*", "1 n_words", "'x' text_kind")
    got = {r.item_id: r.text_kind for r in text_statistics(items).collect()}
    assert got == {"a": None, "b": "list"}
    assert text_statistics(items.limit(0)).collect() == [] and "the" in common_list(items)


#: Texts of another making, in words of none of the tables.
OTHERS = [
    ("Glaciers carve valleys over thousands of years, and the rock they grind turns rivers milky. When the ice retreats, it leaves moraines behind. Farmers later clear the stones and build walls from them.", None),
    ("The committee met on Tuesday. It discussed three matters:\n- the budget\n- the roof\n- the new caretaker\nAfter a long debate the members agreed that the roof could wait until spring, because the budget would not stretch to both. The caretaker starts in June.", None),
    ("The road goes on beneath the pale moonlight,\nand every step I take is cold and slow;\nthe owls are silent on this winter night,\nand what is lost lies buried in the snow.", None),
    ("Dear Anna,\n\nThank you for your letter, which arrived yesterday. We were all glad to hear that the operation went well.\n\nYours,\nPeter", None),
    ("— Where were you last night?\n— At home, as I told you.\n— Nobody saw you there.\n— Then nobody looked.", None),
    ("Az öreg molnár megjavítja a hidat az iskola mögött. Senki sem kérdezi meg tőle, miért, pedig a falu még mindig erről beszél.", None),
    ("id,name,price,stock\n1,bolt,0.10,500\n2,nut,0.05,700\n3,washer,0.02,900\n4,screw,0.08,450\n", "table"),
    ("milk\neggs\nbread\nbutter\ncoffee\napples\nrice\ntea bags\n", "list"),
    ("1. Preheat oven\n2. Grease tin\n3. Mix flour\n4. Add eggs\n5. Pour batter\n6. Bake\n", "list"),
    ("jabłka\ngruszki\nśliwki\nwiśnie\nczereśnie\nmaliny\nporzeczki\n", "list"),
    ("asdkjh qwpoei zxmcnb laksjd qpwoei zmxncb alskdj qpwoeiru zmxncbv alskdjf qwpoeiru zxcmnvb", "junk"),
]


@pytest.mark.parametrize("n", range(len(OTHERS)))
def test_texts_of_another_making(model, n):
    text, kind = OTHERS[n]
    assert statistics(text, model)["text_kind"] == kind


def _many(n):
    """Texts of two sentences, each with a word of its own."""
    own = ["".join("bcdfghjklmnpqrstvwxz"[k // 20**p % 20] for p in range(3)) for k in range(n)]
    return own, [f"The old {w} stood in the town for a week and nobody asked why. It was in the house of {w} all the time." for w in own]


def test_fit_reads_all_texts(spark, monkeypatch):
    """The trigrams of every text are known, not those of a sample."""
    made = []

    class Seen(Q.Kinds):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    own, texts = _many(1000)
    items = spark.createDataFrame([(f"i{k}", 1, t) for k, t in enumerate(texts)], "item_id string, iteration int, text string")
    monkeypatch.setattr(Q, "Kinds", Seen)
    text_statistics(items)
    assert [w for w in own if w not in made[-1].grams.grams] == []


def test_groups_and_partitions(spark, tables, monkeypatch):
    """Fitted in several groups, each different text once, whatever the partitions and repeats."""
    monkeypatch.setattr(Q, "GROUP", 40_000)
    monkeypatch.setattr(Q, "GROUP_SENTENCES", 100)
    texts = [(r.item_id, r.text) for r in tables("items", "sf0.01").where("text is not null").select("item_id", "text").distinct().collect()]
    once = spark.createDataFrame(texts, "item_id string, text string")
    twice = spark.createDataFrame([*reversed(texts), *texts], "item_id string, text string").repartition(7)
    a, b = (Q.fit_texts(Q.distinct_texts(x)) for x in (once, twice))
    assert a.grams.grams == b.grams.grams and (a.weights == b.weights).all()
    assert statistics(PROSE, a)["text_kind"] is None and statistics("\n".join(NOUNS), a)["text_kind"] == "list"


def test_few_sentences(spark):
    for texts in ([], ["  \x1c\u3000\n"], ["milk\neggs\nbread"], ["The old letter lay on the table of the house."]):
        items = spark.createDataFrame([("a", t) for t in texts], "item_id string, text string")
        assert text_statistics(items).count() == sum(bool(t.strip()) for t in texts)


def test_each_sentence_is_dealt(monkeypatch):
    deal = Q.Deal(random.Random(1), ["a", "b", "c"])
    assert [deal.next() for _ in range(3)] == ["a", "b", "c"] and deal.left == 0 and deal.next() in "abc"
    halves = [Q._sentences(_many(300)[1])[k::2] for k in (0, 1)]
    dealt = []
    plain = Q._one
    monkeypatch.setattr(Q, "_one", lambda r, s: dealt.append(x := plain(r, s)) or x)
    few = Q.Grams(frozenset())
    _, docs = Q.fit_layouts(halves, [few, few], few, rounds=0, docs=5)
    assert set(dealt) == set(halves[0] + halves[1]) and docs % 5 == 0
