from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import mixing


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 200))
def test_fit_is_the_best_subset_sum(hist, budget):
    take = mixing.fit(hist, budget)
    assert all(0 <= take[k] <= n for k, n in hist.items())
    got = sum(k * n for k, n in take.items())
    best = max(s for c in product(*[range(n + 1) for n in hist.values()]) if (s := sum(k * x for k, x in zip(hist, c))) <= budget)
    assert got == best


def test_fit_of_many_documents_meets_the_budget():
    hist = {k: 5000 for k in range(50, 1500)}
    take = mixing.fit(hist, 1_234_567_891)
    assert sum(k * n for k, n in take.items()) == 1_234_567_891


def test_budgets_keep_proportions_within_caps():
    goal = mixing.budgets({"a": 1000, "b": 100}, {"a": (0.6, 1), "b": (0.3, 4), "c": (0.1, 2)})
    assert goal == {"a": 800, "b": 400}
    assert mixing.budgets({}, {"a": (1.0, 1)}) == {} and mixing.budgets({"a": 10}, {"a": (1.0, 0)}) == {}


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def test_mix_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 7)
    table = _table(spark, [(k, "a" if k % 3 else "b", 10 + k % 2) for k in range(900)])
    targets = spark.createDataFrame([(" A", 0.5, 1), ("b", 0.4, 3), ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    mix = mixing.mix_documents(table, targets).collect()
    assert len({r.doc_id for r in mix}) == len(mix) and all(1 <= r.n_uses <= (3 if r.source == "b" else 1) for r in mix)
    got = {r.source: r for r in mixing.mix_shares(mixing.mix_documents(table, targets), targets).collect()}
    assert abs(got["a"].share - 5 / 9) < 0.002 and abs(got["b"].share - 4 / 9) < 0.002 and got["missing"].share == 0
    assert sorted(map(tuple, mix)) == sorted(map(tuple, mixing.mix_documents(table.repartition(3), targets).collect()))
    other = mixing.mix_documents(table, targets, total=2000, seed=9).collect()
    assert abs(sum(r.n_tokens * r.n_uses for r in other) - 2000) <= 2


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "x y z", "A ", 1), (1, "x y z", "a", 2), (2, None, "a", 1), (3, "", "a", 1), (None, "x", "a", 1), (4, "some words", None, 1), (5, "more words", "other", 1), (6, "w", "a_b", 1)],
        "doc_id long, text string, source string, n_tokens int",
    )
    sized = {r.doc_id: (r.source, r.n_tokens > 0) for r in mixing.sized_documents(docs).collect()}
    assert sized == {1: ("a", True), 5: ("other", True), 6: ("a-b", True)}
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    assert [(r.doc_id, r.n_uses) for r in mixing.mix_documents(mixing.sized_documents(docs), targets).collect()] == [(1, 2)]
    assert mixing.mix_documents(_table(spark, []), targets).collect() == []
    assert mixing.mix_documents(mixing.sized_documents(docs), targets.limit(0)).collect() == []


def test_every_open_length_can_be_drawn_on():
    hist = {1000 + k: 1 for k in range(5000)}  # every second length is even, and so are their sums
    take = mixing.fit(hist, 150_001)
    assert sum(k * n for k, n in take.items()) == 150_001 and all(n <= hist[k] for k, n in take.items())


def test_long_documents_meet_their_budget():
    hist = {200_000 + k: 5 for k in range(50)}
    budget = sum(k * n for k, n in hist.items()) // 2
    take = mixing.fit(hist, budget)
    assert budget - sum(k * n for k, n in take.items()) <= 5 and all(0 <= n <= hist[k] for k, n in take.items())
    mixed = {k: 400 for k in range(40, 900, 7)} | {1_000_000 + 13 * k: 2 for k in range(9)}
    budget = sum(k * n for k, n in mixed.items()) // 3
    take = mixing.fit(mixed, budget)
    assert budget == sum(k * n for k, n in take.items()) and all(0 <= n <= mixed[k] for k, n in take.items())


def test_a_plan_too_large_to_broadcast_gives_the_same_mix(spark, monkeypatch):
    table = _table(spark, [(k, "a" if k % 4 else "b", 10 + k % 5) for k in range(600)])
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    want = sorted(map(tuple, mixing.mix_documents(table, targets).collect()))
    monkeypatch.setattr(mixing, "MANY", 3)
    monkeypatch.setattr("quern.session.BROADCAST_BYTES", 0)
    assert sorted(map(tuple, mixing.mix_documents(table, targets).collect())) == want
