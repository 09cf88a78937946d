import numpy as np
from pyspark.sql import functions as F

from quern.llm import consensus as C


def _simulate(n_items, seed, sens, spec, share=0.6, per=5):
    rng = np.random.default_rng(seed)
    truth = rng.random(n_items) < share
    rows = []
    for i in range(n_items):
        for r in rng.choice(len(sens), per, replace=False):
            right = rng.random() < (sens[r] if truth[i] else spec[r])
            rows.append((i, int(r), 1 if truth[i] == right else -1))
    return truth, rows


def _moments(rows, size):
    votes = {}
    for i, r, v in rows:
        votes.setdefault(i, []).append((r, v))
    n, both, one = (np.zeros((size, size)) for _ in range(3))
    for pack in votes.values():
        for a, x in pack:
            for b, y in pack:
                n[a, b] += 1
                both[a, b] += x * y
                one[a, b] += x
    return n, both, one


def test_triplets_recover_accuracies():
    sens = np.array([0.95, 0.9, 0.85, 0.8, 0.7, 0.5, 0.15, 0.97])
    spec = np.array([0.9, 0.85, 0.9, 0.7, 0.8, 0.5, 0.2, 0.05])
    _, rows = _simulate(6000, 1, sens, spec)
    n, both, one = _moments(rows, 8)
    u = C.solve_triplets(n, both, one)
    accepted = np.array([np.mean([v > 0 for _, r, v in rows if r == k]) for k in range(8)])
    a, b = C.reliabilities(u, accepted, 0.6)
    assert np.abs(a - sens).max() < 0.06 and np.abs(b - spec).max() < 0.06
    assert u[6] < 0  # one who says the contrary
    assert C.solve_triplets(*np.zeros((3, 0, 0))).size == 0
    assert np.allclose(C.solve_triplets(*_moments([(0, 0, 1), (0, 1, 1)], 2)), 0)


def _reviews(spark, rows):
    df = spark.createDataFrame(rows, "review_seq long, item_id string, iteration int, reviewer_id string, decision string, created_at string")
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def test_consensus_beats_the_majority(spark):
    sens, spec = np.array([0.95, 0.95, 0.9, 0.5, 0.5, 0.5, 0.1, 0.55]), np.array([0.95, 0.9, 0.95, 0.5, 0.5, 0.5, 0.1, 0.5])
    truth, rows = _simulate(1200, 3, sens, spec)
    words = {1: ["accept", " Accepted", "ACCEPT"], -1: ["reject", "Rejected ", "REJECT"]}
    reviews = _reviews(spark, [(k, f"i{i} ".upper() if k % 5 == 0 else f"i{i}", 1, f"R{r}" if k % 7 == 0 else f"r{r}", words[v][k % 3], "2025-01-01") for k, (i, r, v) in enumerate(rows)])
    items = spark.createDataFrame([(f"i{i}", 1, "x") for i in range(1200)], "item_id string, iteration int, decision string")
    found, who = C.consensus(reviews, items)
    got = {r.item_id: r.decision == "accept" for r in found.collect()}
    share = np.mean([got[f"i{i}"] == truth[i] for i in range(1200)])
    votes = {}
    for i, _, v in rows:
        votes[i] = votes.get(i, 0) + v
    majority = np.mean([(votes[i] > 0) == truth[i] for i in range(1200)])
    assert share > 0.93 and share > majority + 0.05
    rel = {r.reviewer_id: r.reliability for r in who.collect()}
    assert len(rel) == 8 and rel["r0"] > 0.85 and rel["r6"] < 0.25


def test_latest_rows_ties_and_edges(spark):
    rows = [
        (1, "a", 1, "x", "reject", "2025-01-01"), (2, "A ", 1, "X", "accept", "2025-01-02"), (3, "a", 1, "y", "accept", "2025-01-01"), (4, "a", 1, "z", "accept", "2025-01-01"),
        (5, "b", 1, "x", "accept", "2025-01-01"), (6, "b", 1, "y", "accept", "2025-01-01"), (7, "b", 1, "z", "accept", "2025-01-01"), (8, "b", 1, "z", None, "2025-01-02"),
        (9, None, 1, "x", "accept", "2025-01-01"), (10, "a", None, "x", "accept", "2025-01-01"), (11, "none", 1, "x", "accept", "2025-01-01"), (12, "a", 1, "w", "maybe", "2025-01-01"),
    ]
    items = spark.createDataFrame([("a", 1), ("b", 1), ("a", 1)], "item_id string, iteration int")
    found, _ = C.consensus(_reviews(spark, rows), items)
    assert [(r.item_id, r.iteration, r.decision, r.n_votes, r.agreement) for r in found.collect()] == [("a", 1, "accept", 3, 1.0)]
    found, who = C.consensus(_reviews(spark, rows).limit(0), items)
    assert found.collect() == [] and who.collect() == []


def test_scores_on_which_reviewers_disagree(spark):
    from quern.llm.consensus import score_agreement

    rows = [
        (1, "a", 1, "r1", "accept", {"v": {"x": 3, "y": 2}}), (2, " A", 1, "r2", "accept", {"v": {"x": 3, "y": 1}}), (3, "a", 1, "r3", "accept", {"v": {"x": 5}}), (4, "a", 1, "R3 ", "accept", {"v": {"x": 3}, "w": {"x": 1}}),
        (5, "a", 1, "r4", None, {"v": {"x": 1}}), (6, "b", 1, "r1", "accept", {"v": {"x": 1}}), (7, "b", 1, "r2", "accept", None), (8, "gone", 1, "r1", "accept", {"v": {"x": 1}}),
    ]
    reviews = spark.createDataFrame(rows, "review_seq long, item_id string, iteration int, reviewer_id string, decision string, scores map<string,map<string,int>>").selectExpr("*", "timestamp_ntz'2025-01-01' created_at")
    items = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "item_id string, iteration int")
    assert {r.item_id: r.score_agreement for r in score_agreement(reviews, items).collect()} == {"a": 6 / 8, "b": None}
