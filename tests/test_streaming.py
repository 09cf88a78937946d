import json
from datetime import datetime, timedelta

from quern.streaming import feedback as S

T0 = datetime(2025, 1, 1)


def _write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"event_id": e, "reviewer": r, "item_id": i, "generator": "g", "verdict": v, "ts": (T0 + timedelta(seconds=s)).isoformat()}) for e, r, i, v, s in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_late_answers_overwrite_and_new_files_are_picked_up(spark, tmp_path):
    src, table, ck = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ck")
    _write(src, "1.json", [(1, "a", "x", "accept", 0), (2, "a", "x", "reject", 5), (3, "b", "x", "maybe", 1), (4, "b", None, "accept", 1)])
    S.append_batches(S.read_feedback(spark, str(src)), table, ck).awaitTermination()
    assert [(r.reviewer, r.verdict) for r in S.latest(spark, table).collect()] == [("a", "reject")]
    _write(src, "2.json", [(5, "a", "x", "accept", 3), (6, "b", "x", "accept", 9)])
    S.append_batches(S.read_feedback(spark, str(src)), table, ck).awaitTermination()
    assert sorted((r.reviewer, r.verdict) for r in S.latest(spark, table).collect()) == [("a", "reject"), ("b", "accept")]


def _run(df, spark, name, mode):
    df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


def test_windows_sessions_and_throttle(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "1.json", [(1, "a", "x", "accept", 0), (2, "a", "y", "accept", 30), (3, "a", "z", "reject", 70), (4, "a", "w", "accept", 3700), (5, "b", "x", "accept", 10)])
    counts = _run(S.windowed_counts(S.read_feedback(spark, str(src))), spark, "counts", "complete")
    assert sorted((r.start.hour, r.verdict, r.n) for r in counts) == [(0, "accept", 3), (0, "reject", 1), (1, "accept", 1)]
    found = _run(S.sessions(S.read_feedback(spark, str(src))), spark, "sessions", "complete")
    assert sorted((r.reviewer, r.n) for r in found) == [("a", 1), ("a", 3), ("b", 1)]
    let = _run(S.throttled(S.read_feedback(spark, str(src))), spark, "let", "append")
    assert sorted(r.event_id for r in let) == [1, 3, 4, 5]
