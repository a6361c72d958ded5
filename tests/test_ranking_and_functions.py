from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import first_per_key, latest_per_key
from strata.functions.documents import contains_marker, parse_date, parse_int, parse_json, rewrite_keys
from tests.conftest import rows


def test_first_per_key_keeps_lowest_source_id(spark):
    df = spark.createDataFrame([(20, "A", "new"), (10, "A", "old"), (5, "B", "b")], "source_id int, k string, j string")
    assert rows(first_per_key(df, ["k"], ["source_id"])) == [(10, "A", "old"), (5, "B", "b")]
    assert rows(first_per_key(df, ["k"], ["source_id"], keep="last")) == [(20, "A", "new"), (5, "B", "b")]


def test_latest_per_key_nulls_last_and_tie_break(spark):
    df = spark.createDataFrame(
        [("A", None, 1), ("A", 3, 1), ("A", 3, 2), ("B", None, 9)], "k string, entry_number int, t int"
    )
    out = latest_per_key(df, ["k"], "entry_number", tie_break=["t"])
    assert rows(out) == [("A", 3, 2), ("B", None, 9)]


def test_top1_is_partial_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("source_id"))
    plan = first_per_key(df, ["k"], ["source_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_marker_is_a_substring_test(spark):
    df = spark.createDataFrame([('{"x":"danePodmiotuZagranicznego"}',), (None,), ("{}",)], "t string")
    assert [r[0] for r in df.select(contains_marker("t", "danePodmiotuZagranicznego")).collect()] == [True, False, False]


def test_rewrite_rules_in_order(spark):
    from strata.plans.registry import DIALECT_RULES

    text = '{"siedzibaIAdresPodmiotuZagranicznego" : {}, "danePodmiotuZagranicznego":{}, "v":"xZagranicznego"}'
    df = spark.createDataFrame([(text,)], "t string")
    out = df.select(rewrite_keys("t", DIALECT_RULES)).first()[0]
    assert out == '{"siedzibaIAdres": {}, "danePodmiotu":{}, "v":"xZagranicznego"}'


def test_parse_json_permissive(spark):
    df = spark.createDataFrame(
        [('{"a": [{"b": "true", "c": true}]}',), ("{bad",), ('{"a": {"b": "x"}}',)], "t string"
    )
    out = parse_json(df, "t", "a ARRAY<STRUCT<b: BOOLEAN, c: BOOLEAN>>")
    got = [r["data"] for r in out.collect()]
    assert got[0]["a"][0]["b"] is None and got[0]["a"][0]["c"] is True  # string "true" is not a boolean
    assert got[1]["a"] is None  # malformed -> NULLs
    assert got[2]["a"] is None  # object where an array is expected -> missing


def test_strict_and_lenient_parsing(spark):
    df = spark.createDataFrame([("31.02.2020", "")], "d string, n string")
    assert df.select(parse_date("d", on_error="null"), parse_int("n", on_error="null")).first() == (None, None)
    with pytest.raises(Exception):
        df.select(parse_int("n")).collect()
    with pytest.raises(Exception):
        df.select(parse_date("d")).collect()


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 99)),
                min_size=1, max_size=30, unique_by=lambda r: r[2]))
def test_latest_is_one_row_per_key_and_the_maximum(spark, data):
    df = spark.createDataFrame(data, "k string, entry_number int, t int")
    got = {r["k"]: (r["entry_number"], r["t"]) for r in latest_per_key(df, ["k"], "entry_number", ["t"]).collect()}
    want = {}
    for k, e, t in data:
        key = (e is not None, e if e is not None else 0, t)
        if k not in want or key > want[k][0]:
            want[k] = (key, (e, t))
    assert got == {k: v for k, (_, v) in want.items()}


DOCS = "source_id int, company_krs string, raw_json string"
DOC_ROWS = [
    (3, "A", "a3"), (1, "A", "a1"), (2, "B", "b2"), (2, "B", "b2"), (2, "B", "b2x"), (None, "C", "cn"), (4, "C", "c4"),
    (5, None, "n5"), (6, None, "n6"), (7, "D", None),
]


def test_late_top1_equals_the_window(spark):
    from strata.operators.ranking import first_per_key, first_per_key_late

    df = spark.createDataFrame(DOC_ROWS, DOCS)
    for keep in ("first", "last"):
        for limit in (0, 1 << 20):  # hashed and broadcast
            late = first_per_key_late(df, ["company_krs"], ["source_id"], keep, broadcast_bytes=limit)
            want = first_per_key(df, ["company_krs"], ["source_id"], keep)
            assert late.columns == df.columns
            assert rows(late, "company_krs", "source_id") == rows(want, "company_krs", "source_id")
            assert late.where("company_krs = 'B'").count() == 1
    assert rows(first_per_key_late(df.limit(0), ["company_krs"], ["source_id"])) == []


def test_bronze_neither_sorts_nor_shuffles_the_documents(spark):
    from strata.plans import registry as R

    raw = spark.range(400).selectExpr(
        "id", "CAST(id % 300 AS STRING) AS krs_number", "repeat(CAST(id AS STRING), 50) AS raw_data"
    )
    for limit in (0, 1 << 20):
        plan_of = R.first_per_key_late(raw, ["krs_number"], ["id"], broadcast_bytes=limit)
        plan = plan_of._jdf.queryExecution().executedPlan().toString()
        assert "Sort [" not in plan and "Window" not in plan and ("BroadcastExchange" in plan) == (limit > 0)
    out = R.bronze(raw)
    assert out.count() == 300 and out.agg(F.max("source_id")).first()[0] == 299
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "Sort [" not in text
