"""Queries of the general data problems (1 and 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators.orphans import orphan_counts, project_orphans
from quern.operators.packed import packed_elements
from quern.tables import load


def p1_found(spark, sf_dir):
    return packed_elements(load(spark, sf_dir, "items"), load(spark, sf_dir, "charter_elements"))


def p1_element_counts(spark, sf_dir):
    """Rows and item versions per field and element id."""
    found = p1_found(spark, sf_dir)
    ident = F.regexp_extract("elem", r"^((?:[A-Z]|\d+)\.\d+)", 1)
    return found.groupBy("field_name", ident.alias("element_id")).agg(F.count("*").alias("n_rows"), F.max("elem_pos").alias("last_pos"))


def _orphans(spark, sf_dir):
    return project_orphans(*[load(spark, sf_dir, t) for t in ("items", "annotations", "reviews", "comments")])


def p2_found(spark, sf_dir):
    return _orphans(spark, sf_dir).drop("created_at")


def p2_counts(spark, sf_dir):
    return orphan_counts(_orphans(spark, sf_dir))


_TRIM = "lower(regexp_replace({0}, '^[\\s\\x{{00a0}}\\x{{3000}}]+|[\\s\\x{{00a0}}\\x{{3000}}]+$', '', 'g'))"


def _orphan_sql(rows, seq, row_keys, parents, parent_keys):
    kinds = "CASE WHEN p.k1 IS NULL THEN 'missing' WHEN p.born > r.created_at THEN 'late' WHEN p.gone <= r.created_at THEN 'deleted' END"
    return f"""
    SELECT '{rows}' AS ref_table, r.seq AS row_seq, r.created_at, {kinds} AS orphan_kind
    FROM (SELECT {row_keys[0]} AS k1, {row_keys[1]} AS k2, {seq} AS seq, created_at FROM {rows}) r
    LEFT JOIN (SELECT {parent_keys[0]} AS k1, {parent_keys[1]} AS k2, min(created_at) AS born, min(deleted_at) AS gone
               FROM {parents} GROUP BY 1, 2) p ON p.k1 = r.k1 AND p.k2 = r.k2
    WHERE r.k1 IS NOT NULL AND r.k2 IS NOT NULL"""


_ITEM = _TRIM.format("item_id")
_ORPHANS = (
    "SELECT * FROM ("
    + _orphan_sql("reviews", "review_seq", (_ITEM, "iteration"), "items", (_ITEM, "iteration"))
    + " UNION ALL "
    + _orphan_sql("comments", "comment_id", (_ITEM, _TRIM.format("target_annotator_id")), "annotations", (_ITEM, _TRIM.format("annotator_id")))
    + ") WHERE orphan_kind IS NOT NULL"
)

QUERIES = {"p1_found": p1_found, "p1_element_counts": p1_element_counts, "p2_found": p2_found, "p2_counts": p2_counts}
SQL = {
    "p2_found": f"SELECT ref_table, row_seq, orphan_kind FROM ({_ORPHANS})",
    "p2_counts": f"SELECT ref_table, strftime(created_at, '%Y-%m') AS month, orphan_kind, count(*) AS n_rows FROM ({_ORPHANS}) GROUP BY ALL",
}
