from quern.operators.orphans import orphan_counts, project_orphans


def _df(spark, rows, schema, *times):
    df = spark.createDataFrame(rows, schema)
    for t in times:
        df = df.withColumn(t, df[t].cast("timestamp_ntz"))
    return df


def test_kinds(spark):
    items = _df(spark, [("a", 1, "2025-01-05", None), (" A", 1, "2025-01-03", None), ("b", 1, "2025-01-01", "2025-02-01"), (None, 1, "2025-01-01", None)], "item_id string, iteration int, created_at string, deleted_at string", "created_at", "deleted_at")
    reviews = _df(
        spark,
        [(1, "A\t", 1, "2025-01-04"), (2, "a", 1, "2025-01-02"), (3, "b", 1, "2025-02-01"), (4, "b", 1, "2025-01-31"), (5, "c", 1, "2025-01-01"), (5, "c", 1, "2025-01-01"), (6, None, 1, "2025-01-01"), (7, "a", None, "2025-01-01"), (8, "a", 2, "2025-01-01"), (9, "", 1, "2025-03-01"), (10, "b", 1, None)],
        "review_seq long, item_id string, iteration int, created_at string",
        "created_at",
    )
    annotations = _df(spark, [("a", "ann-1", "2025-01-01", None)], "item_id string, annotator_id string, created_at string, deleted_at string", "created_at", "deleted_at")
    comments = _df(spark, [(1, "A", "ANN-1 ", "2025-01-02"), (2, "a", None, "2025-01-02"), (3, "a", "ann-2", "2025-01-02")], "comment_id long, item_id string, target_annotator_id string, created_at string", "created_at")
    found = project_orphans(items, annotations, reviews, comments)
    got = sorted((r.ref_table, r.row_seq, r.orphan_kind) for r in found.collect())
    assert got == [("comments", 3, "missing"), ("reviews", 2, "late"), ("reviews", 3, "deleted"), ("reviews", 5, "missing"), ("reviews", 5, "missing"), ("reviews", 8, "missing"), ("reviews", 9, "missing")]
    assert sum(r.n_rows for r in orphan_counts(found).collect()) == 7
    assert project_orphans(items.limit(0), annotations.limit(0), reviews.limit(0), comments.limit(0)).count() == 0
