import json
import math

import numpy as np
import pytest

from quern.llm import truncation as t

WHOLE = ["It is so.", "It is so [1.1].", "It is so. [1.1]", "Gut [1.1, 2.2]", "So (1.2)", "これは良心の問題である［4.3］。", 'He said "no."', "so [4.3]…"]
CUT = ["It is so…[+84 chars]", "And then [truncated]", "And th<cut>", "And th�", "open [1.1, 2", "...", "And so it ends.…"]


@pytest.mark.parametrize("text", WHOLE)
def test_whole(text):
    assert t._ending(text)[0] == "whole"


@pytest.mark.parametrize("text", CUT)
def test_cut(text):
    assert t._ending(text)[0] in ("mark", "open")


@pytest.mark.parametrize("text", ["gives way to convenience", "gives way to conven", "I think…", "私はこれを見過ごしたくない"])
def test_words_must_tell(text):
    kind, key = t._ending("One. " + text)
    assert kind == "words" and key


def _wrap(answer):
    return json.dumps({"reflection": answer})


OBJECT = json.dumps({"analysis": "A clerk.", "reflection_1p": "It is so [1.1]."})


@pytest.mark.parametrize(
    "raw, kind",
    [
        (OBJECT, "whole"),
        (_wrap(OBJECT), "whole"),
        (_wrap("```json\n" + OBJECT + "\n```"), "whole"),
        (_wrap("Well. " + OBJECT + "\n\nIn 1990 it ended."), "whole"),
        (_wrap(OBJECT[:-9]), "open"),
        (_wrap(OBJECT)[:-9], "open"),
        (OBJECT[:-4], "open"),
        (_wrap("```json\n" + OBJECT), "open"),
        (OBJECT + "\n\nIn 1990 it", "words"),
        ("Nothing here.", "whole"),
        ("{}", "whole"),
        (_wrap(""), "whole"),
        ('{"a": "brace } in \\" text"', "open"),
    ],
)
def test_answers(raw, kind):
    assert t.answer_ending(raw)[0] == kind


def test_censored_fit_recovers_the_distribution():
    rng = np.random.default_rng(2)
    x = np.exp(rng.normal(6, 0.5, 40_000))
    limit = 400
    exact = {int(k): 1.0 * int(n) for k, n in zip(*np.unique(x[x < limit].astype(int) + 1, return_counts=True))}
    mean, dev = t.fit_censored(exact, {limit: int((x >= limit).sum())})
    assert abs(mean - 6) < 0.03 and abs(dev - 0.5) < 0.03
    assert t.fit_censored({}, {}) == (0.0, 1.0) and math.isfinite(t.fit_censored({5: 3}, {})[1])


def test_scores(spark):
    s = "It gives way to convenience. "
    rows = [(f"w{k}", 1, "m", "p", s * 2, OBJECT) for k in range(30)]
    rows += [(f"l{k}", 1, "m", "p", (s * 5)[:100], None) for k in range(12)]  # a limit of 100, in mid-word
    rows += [("a", 1, "m", "p", s + "It gives way to convenience", OBJECT[:-5]), ("a", 1, "m", "p", s + "It gives way to convenience", OBJECT[:-5]), ("b", 1, None, None, s + "It gives way to conv", ""), ("c", 1, "m", "p", None, None), ("d", 1, "m", "p", s * 9000 + "It giv", None)]
    items = spark.createDataFrame(rows, "item_id string, iteration int, model string, gen_prompt string, reflection string, raw_response string").selectExpr("*", "timestamp_ntz'2025-01-01' created_at", "1 ending", "true is_cut", "'x' field_name")
    scored = t.scored_values(items)
    cut = {(r.item_id, r.field_name) for r in scored.where("is_cut").collect()}
    assert cut == {(f"l{k}", "reflection") for k in range(12)} | {("a", "raw_response"), ("b", "reflection"), ("d", "reflection")}
    assert scored.where("posterior is not null").count() == 12
    assert scored.where("item_id = 'a'").count() == 2
    assert sum(r.n_cut for r in t.cut_rates(scored).collect()) == len(cut)
    assert t.scored_values(items.limit(0)).collect() == []


CELLS = "model string, field_name string, n_chars long, ending string"
SCHEMA = "item_id string, iteration int, model string, gen_prompt string, reflection string, raw_response string"


def _cut_ids(spark, rows):
    items = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "timestamp_ntz'2025-01-01' created_at")
    return {r.item_id for r in t.scored_values(items).where("is_cut").collect()}


def test_a_source_that_rarely_cuts_keeps_its_cuts(spark):
    s = "It gives way to convenience. "
    rows = [(f"w{k}", 1, "hot", "p", s * (2 + k % 7), None) for k in range(997)]
    rows += [(f"c{k}", 1, "hot", "p", s * (2 + k) + "It gives way to conv", None) for k in range(3)]  # 0.3 %
    assert _cut_ids(spark, rows) == {"c0", "c1", "c2"}
    # marks, open structures and unseen words, in a source that cuts one value in ten thousand
    sources, weights = t.fit_sources(spark.createDataFrame([("hot", "reflection", 100 + k % 300, "mark" if k == 0 else "whole") for k in range(10_000)], CELLS))
    shows = [weights[t._CLASS[c]] for c in ("mark", "open", "unseen")]
    assert sources[("hot", "reflection")].prior + min(shows) > 0


def test_the_posterior_alone_can_tell(spark):
    s, limit = "It gives way to convenience. ", 57
    rows = [(f"w{k}", 1, "m", "p", s * (20 + k % 40), None) for k in range(400)]
    rows += [(f"l{k}", 1, "m", "p", ("Now then, " + s * 2)[:limit], None) for k in range(30)]  # in mid-word
    rows += [("whole at limit", 1, "m", "p", (s * 2).strip(), None), ("seen at limit", 1, "m", "p", ("So. " + s + "It gives way to convenience")[:limit].ljust(limit, "…"), None)]
    rows += [("whole elsewhere", 1, "m", "p", (s * 2).strip() + " So.", None), ("seen elsewhere", 1, "m", "p", s * 9 + "It gives way to convenience", None)]
    assert all(len(r[4]) == limit for r in rows if "at limit" in r[0])
    assert _cut_ids(spark, rows) == {f"l{k}" for k in range(30)} | {"whole at limit", "seen at limit"}


def test_a_weak_posterior_leaves_whole_endings(spark):
    rows = [("m", "reflection", 100 + k % 50, "whole") for k in range(400)] + [("m", "reflection", 120, "unseen")] * 100
    sources, weights = t.fit_sources(spark.createDataFrame(rows, CELLS))
    at = sources[("m", "reflection")].limits
    assert list(at) == [120] and 0 < at[120][1] < -weights[t._CLASS["whole"]]


def test_endings_weigh_what_the_values_show():
    none = np.zeros(len(t.ENDINGS))
    start = t.ending_weights(none, none)
    assert start[t._CLASS["unseen"]] > 3 and start[t._CLASS["whole"]] < -3
    # where whole values often end in words not seen elsewhere, such an end weighs less
    cut, whole = none.copy(), none.copy()
    whole[t._CLASS["unseen"]], whole[t._CLASS["whole"]], cut[t._CLASS["unseen"]] = 5000, 5000, 100
    assert t.ending_weights(cut, whole)[t._CLASS["unseen"]] < start[t._CLASS["unseen"]] - 3


def test_rows_that_length_overturns_are_counted(spark):
    s, limit = "It gives way to convenience. ", 57
    rows = [(f"w{k}", 1, "m", "p", s * (20 + k % 40), None) for k in range(400)]
    rows += [(f"l{k}", 1, "m", "p", ("Now then, " + s * 2)[:limit], None) for k in range(30)] + [("x", 1, "m", "p", (s * 2).strip(), None)]
    items = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "timestamp_ntz'2025-01-01' created_at")
    assert [(r.n_cut, r.n_by_length) for r in t.cut_rates(t.scored_values(items)).collect()] == [(31, 1)]


def test_long_words_stay_whole():
    assert t._key("So " + "a" * 300 + " " + "b" * 300) == "so " + "a" * 300 + "|" + "a" * 300 + " " + "b" * 300


def test_recall_on_cuts_made_here(spark, tables):
    """Whole values of the table, half of them cut at any place within a sentence."""
    import random

    rng = random.Random(8)
    items = tables("items", "sf0.01")
    sure = t.scored_values(items).where("field_name = 'reflection' and not is_cut and ending = 'whole'").select("item_id", "iteration")
    rows = sure.join(items, ["item_id", "iteration"]).select("item_id", "iteration", "model", "gen_prompt", "reflection", "created_at").dropDuplicates(["item_id", "iteration"]).orderBy("item_id", "iteration").collect()
    made, cut = [], set()
    for k, r in enumerate(rows):
        text = r.reflection
        if k % 10 == 0 and len(text) > 80:
            at = rng.randint(40, len(text) - 5)
            while at > 40 and not (text[at - 1].isalpha() and text[at].isalpha()):
                at -= 1
            if at > 40 and ord(text[at]) < 0x2E80:
                text = text[:at]
                cut.add((r.item_id, r.iteration))
        made.append((r.item_id, r.iteration, r.model, r.gen_prompt, text, None, r.created_at))
    found = t.scored_values(spark.createDataFrame(made, SCHEMA + ", created_at timestamp_ntz")).where("is_cut").select("item_id", "iteration").collect()
    got = {(r.item_id, r.iteration) for r in found}
    assert len(cut) > 20 and len(got & cut) / len(cut) >= 0.9 and len(got & cut) / len(got) >= 0.9


def test_odd_texts_take_linear_time():
    import time

    began = time.perf_counter()
    for odd in (" ", "\n", ". ", "[", "… ", "a\n ", '"'):
        text = "a" + odd * 100_000 + "b"
        t.sentence_keys(text)
        t._ending(text)
        t.answer_ending("{" + text)
    assert time.perf_counter() - began < 20
