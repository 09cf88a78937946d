import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.operators.packed import bracket_members, packed_elements, split_packed


@pytest.mark.parametrize(
    "field, values",
    [
        (None, []),
        ("", []),
        ("[]", []),
        ("[ ]", []),
        (" ;; , ", []),
        ('["1.1","A.2"]', ["1.1", "A.2"]),
        ("['1.1 Truthful speech', '2.3']", ["1.1 Truthful speech", "2.3"]),
        ('["1.3 So-called \\"small\\" lies", "5.1"]', ['1.3 So-called "small" lies', "5.1"]),
        ('"1.3 So-called ""small"" lies"|5.4', ['1.3 So-called "small" lies', "5.4"]),
        ('"4.3 The right to say ""no"""\t1.3\t', ['4.3 The right to say "no"', "1.3"]),
        ("2.4 Rest; not only output;5.1", ["2.4 Rest; not only output", "5.1"]),
        ("3.3 Fair shares | fair burdens|1.1", ["3.3 Fair shares | fair burdens", "1.1"]),
        ("1.4 and 1.3 and 6.1", ["1.4", "1.3", "6.1"]),
        ("6.2 Language and memory and 1.1", ["6.2 Language and memory", "1.1"]),
        ("3.4 Due process & ", ["3.4 Due process"]),
        ("2.4 5.10 5.3", ["2.4", "5.10", "5.3"]),
        ("A.3；2.5、2.5", ["A.3", "2.5", "2.5"]),
        ("[A.6, 6.1]", ["A.6", "6.1"]),
        ('[["1.1"], ["2.2", "2.3"]]', ["1.1", "2.2", "2.3"]),
        ('"[\\"1.1\\"', ['["1.1"']),
        ("/3.3/4.4", ["3.3", "4.4"]),
    ],
)
def test_split(field, values):
    assert split_packed(field) == values


def test_long_fields_are_read_in_one_pass():
    assert len(split_packed("1.1 " * 50_000)) == 50_000
    assert split_packed("1.1" + " " * 200_000 + "x") == ["1.1" + " " * 200_000 + "x"]
    assert split_packed("and " * 50_000 + "1.1") == ["1.1"]


@pytest.mark.parametrize(
    "text, ids",
    [
        (None, []),
        ("nothing [sic] here [v1.2] [TODO 3] [99.9]", []),
        ('a [cf. "1.1"; "2.1"]. b [§1.1, §2.1] c ［2.1、1.1］', ["1.1", "2.1", "1.1", "2.1", "2.1", "1.1"]),
        ("cut off [1.1, 2", []),
        ("[ 1.1 [truncated]", []),
        ("[12.1] [1.1.1] [1.10]", []),
        ("[1.1][2.1] [1.1 and 2.1] 1.1", ["1.1", "2.1", "1.1", "2.1"]),
    ],
)
def test_brackets(text, ids):
    assert bracket_members(text, frozenset({"1.1", "2.1"})) == ids


TITLES = ["", " Rest; not only output", " Candour, even when costly", ' The right to say "no"', " Fair shares | fair burdens"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1.1", "A.2", "5.10"]), st.sampled_from(TITLES), st.booleans()), max_size=8), st.sampled_from([",", "; ", "|", "\t", " / ", "、", ";;", "\n"]))
def test_round_trip(members, delim):
    values = [i + t for i, t, _ in members]
    shown = ['"' + v.replace('"', '""') + '"' if q else v for v, (_, _, q) in zip(values, members)]
    assert split_packed(delim.join(shown)) == values


def test_versions_once_and_clashing_columns(spark):
    rows = [
        ("a", 1, "x [1.1]", '["1.1","1.1"]', "2025-01-02", "e"),
        ("a", 1, "x [1.1]", '["1.1","1.1"]', "2025-01-01", "f"),
        ("a", 2, None, None, None, "g"),
        (None, None, "", "[]", "2025-01-01", "h"),
    ]
    random.shuffle(rows)
    items = spark.createDataFrame(rows, "item_id string, iteration int, reflection string, reflection_charter_elements string, at string, elem string").selectExpr("*", "cast(at as timestamp_ntz) created_at")
    elements = spark.createDataFrame([("1.1",), (None,)], "element_id string")
    found = sorted(map(tuple, packed_elements(items, elements).collect()))
    assert found == [("a", 1, "reflection", 1, "1.1"), ("a", 1, "reflection_charter_elements", 1, "1.1"), ("a", 1, "reflection_charter_elements", 2, "1.1")]
    assert packed_elements(items.limit(0), elements).collect() == []


@pytest.mark.parametrize(
    "text, ids",
    [
        ("[3.1 [4.2]]", ["3.1", "4.2"]),
        ("［3.1、[4.2], 3.1］ and [4.2]", ["3.1", "4.2", "3.1", "4.2"]),
        ('["a title that names 4.2"]', []),
        ('["3.1 a title that names 4.2", \'4.2 another ] 3.1\', "§4.2"]', ["3.1", "4.2", "4.2"]),
        ('[\\"3.1 names 4.2\\"; cf. 4.2]', ["3.1", "4.2"]),
        ('["3.1, 4.2"] ["3.1 Truth, 4.2]', ["3.1", "4.2", "3.1", "4.2"]),
        ("[3.1 a title, 4.2–3.1 (see 4.2)]", ["3.1", "4.2", "3.1"]),  # a mention within a member is none
        ("[see Article 3.1 of the law]", []),
        ('["not 3.1, or"]', []),
        ("[§3.1, §4.2 & 3.1]", ["3.1", "4.2", "3.1"]),
        ("[open 3.1 [4.2] don't ['tis 3.1]", ["4.2"]),
        ("[[3.1] [4.2]] ]", ["3.1", "4.2"]),
    ],
)
def test_brackets_nest_and_quotes_shield(text, ids):
    assert bracket_members(text, frozenset({"3.1", "4.2"})) == ids


def test_many_brackets_are_read_in_one_pass():
    assert bracket_members("[" * 200_000 + "3.1" + "]" * 200_000, frozenset({"3.1"})) == ["3.1"]
    assert len(bracket_members("[3.1] " * 50_000, frozenset({"3.1"}))) == 50_000
    assert bracket_members("[" + '"' * 100_000, frozenset({"3.1"})) == []


def test_without_ids_every_delimiter_outside_quotes_counts():
    assert split_packed("red, green, 'blue, or; so' ; x") == ["red", "green", "blue, or; so", "x"]
    assert split_packed("1.1 red, green, 2.2 blue") == ["1.1 red, green", "2.2 blue"]


def test_fields_take_linear_time():
    began = time.perf_counter()
    for odd in ("[x" + "," * 1_000_000, '""' * 300_000, "[1.1 " * 100_000, '["a' * 100_000, "and " * 100_000, "'" + "a 1.1, " * 100_000):
        split_packed(odd)
        bracket_members(odd, frozenset({"1.1"}))
        bracket_members(f"[{odd}]", frozenset({"1.1"}))
    assert time.perf_counter() - began < 20
