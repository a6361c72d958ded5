from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import distinct_starts, reopen_orphans
from tests.conftest import rows

SCHEMA = "company_krs string, v string, valid_from_entry int, valid_to_entry int"


def test_chain_keeps_replaced_end(spark):
    df = spark.createDataFrame([("A", "x", 1, 3), ("A", "y", 3, None)], SCHEMA)
    assert rows(reopen_orphans(df)) == [("A", "x", 1, 3), ("A", "y", 3, None)]


def test_orphan_is_reopened(spark):
    df = spark.createDataFrame([("A", "x", 1, 5), ("A", "y", 8, None)], SCHEMA)
    assert rows(reopen_orphans(df)) == [("A", "x", 1, None), ("A", "y", 8, None)]


def test_other_key_does_not_count_as_successor(spark):
    df = spark.createDataFrame([("A", "x", 1, 5), ("B", "y", 5, None)], SCHEMA)
    assert rows(reopen_orphans(df), "company_krs", "valid_to_entry") == [("A", None), ("B", None)]


def test_null_key_and_null_start(spark):
    df = spark.createDataFrame([(None, "x", 1, 2), (None, "y", 2, None), ("A", "z", None, 4)], SCHEMA)
    out = rows(reopen_orphans(df), "v", "valid_to_entry")
    assert out == [("x", None), ("y", None), ("z", None)]


def test_columns_order_and_type_preserved(spark):
    df = spark.createDataFrame([(1, "A", 7, 9)], "valid_from_entry int, company_krs string, x int, valid_to_entry long")
    out = reopen_orphans(df)
    assert out.columns == df.columns
    assert out.schema["valid_to_entry"].dataType == df.schema["valid_to_entry"].dataType


def test_distinct_starts(spark):
    df = spark.createDataFrame([("A", "x", 1, 3), ("A", "y", 1, 4), ("B", "z", 1, None)], SCHEMA)
    assert rows(distinct_starts(df, ["company_krs"])) == [("A", 1), ("B", 1)]


intervals = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.integers(1, 12),
        st.one_of(st.none(), st.integers(1, 14)),
    ),
    max_size=25,
)


@settings(max_examples=25, deadline=None)
@given(intervals)
def test_repair_matches_brute_force_and_is_idempotent(spark, data):
    df = spark.createDataFrame([(k, f"v{i}", s, e) for i, (k, s, e) in enumerate(data)], SCHEMA)
    starts = {(k, s) for k, s, _ in data}
    expected = sorted(
        ((k, f"v{i}", s, e if e is not None and (k, e) in starts else None) for i, (k, s, e) in enumerate(data)),
        key=repr,
    )
    once = reopen_orphans(df)
    assert rows(once) == expected
    assert rows(reopen_orphans(once)) == expected


def test_repair_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame([("A", "x", 1, 3)], SCHEMA).withColumn("company_krs", F.col("company_krs"))
    plan = reopen_orphans(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_explode_semantics_and_single_parse(spark):
    from strata import Field, HistorySpec, explode_history
    from strata.functions.documents import parse_json

    docs = spark.createDataFrame(
        [(1, '{"a": [null, {"v": "x", "s": "1"}]}'), (2, '{"a": []}'), (3, "{}"), (4, "{bad")], "k int, t string"
    )
    parsed = parse_json(docs, "t", "a ARRAY<STRUCT<v: STRING, s: STRING>>")
    inner = explode_history(parsed, HistorySpec("a", ("a",), (Field("v", "v"),), start="s"), carry=["k"])
    outer = explode_history(parsed, HistorySpec("a", ("a",), (Field("v", "v"),), outer=True, start="s"), carry=["k"])
    assert rows(inner, "k", "v") == sorted([(1, None), (1, "x")], key=repr)  # NULL element kept, empty/missing dropped
    assert rows(outer, "k", "v") == sorted([(1, None), (1, "x"), (2, None), (3, None), (4, None)], key=repr)
    plan = inner._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
