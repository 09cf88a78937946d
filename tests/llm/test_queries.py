"""Every registered query of the subpackage runs over the smallest tables, with the columns asked for."""

import duckdb
import pytest

from quern.llm.queries import QUERIES, SQL

from .conftest import DATA

FOUND = {
    "p3_found": ["item_id", "iteration", "decision"],
    "p4_found": ["item_id", "iteration", "lang"],
    "p5_found": ["item_id", "text_kind"],
    "p6_found": ["item_id", "iteration", "field_name"],
    "p8_found": ["doc_id", "item_id"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, f"{DATA}/sf0.001")
    rows = df.collect()
    assert name not in FOUND or df.columns == FOUND[name]
    assert len(set(map(repr, rows))) == len(rows)
    assert rows or name in ("p8_found", "p10_found")  # rare; see below


def test_reliabilities_lie_between_zero_and_one(spark):
    assert all(0 < r.reliability < 1 for r in QUERIES["p3_reliability"](spark, f"{DATA}/sf0.01").collect())


def test_texts_of_a_kind_are_no_language_cases(spark):
    odd = {r.item_id for r in QUERIES["p5_found"](spark, f"{DATA}/sf0.01").collect()}
    cases = QUERIES["p4_found"](spark, f"{DATA}/sf0.01").collect()
    assert odd and cases and not odd & {r.item_id for r in cases}


def test_shares_reached(spark):
    rows = QUERIES["p9_shares"](spark, f"{DATA}/sf0.01").collect()
    there = sum(r.target_share for r in rows if r.n_docs)
    assert all(abs(r.share - r.target_share / there) < 0.01 for r in rows if r.n_docs) and all(r.most_uses <= r.max_repeats for r in rows)


@pytest.mark.parametrize("name", ["p8_found", "p10_found"])
def test_rare_cases_are_found_in_larger_tables(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.01").count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW reviews AS SELECT * FROM read_parquet('{DATA}/sf0.01/reviews.parquet')")
    df = QUERIES[name](spark, f"{DATA}/sf0.01")
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, want)) and want
