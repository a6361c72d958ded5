from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import asof
from strata import AsOfSpec, interval_chain, interval_join, start_match_chain, start_match_join
from tests.conftest import rows

BASE = "company_krs string, entry_number int"
HIST = "company_krs string, v string, valid_from_entry int, valid_to_entry int"


def brute_force(base, hist):
    out = []
    for k, e in base:
        hits = [v for hk, v, s, t in hist if hk == k and s is not None and e is not None and s <= e and (t is None or t > e)]
        out += [(k, e, v) for v in hits] or [(k, e, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("method,width", [("measured", 1), ("measured", 2), ("measured", 32), ("key", 32)])
def test_fixture_cases(spark, method, width):
    base = [("A", 1), ("A", 3), ("A", 9), ("B", 1), ("B", 2), ("C", 5)]
    hist = [
        ("A", "x", 1, 5),  # orphan already reopened elsewhere; here closed at 5
        ("A", "y", 8, None),
        ("A", "z", 3, None),  # overlaps: entry 3 and 9 fan out
        ("B", "w", 2, None),  # before first: entry 1 gets NULL
        ("C", "n", None, None),  # NULL start never matches
    ]
    out = interval_join(
        spark.createDataFrame(base, BASE), spark.createDataFrame(hist, HIST), ["v"], bin_rows=width, method=method
    )
    assert rows(out) == brute_force(base, hist)


def test_prefix_and_column_order(spark):
    base = spark.createDataFrame([("A", 1, "d")], "company_krs string, entry_number int, extra string")
    hist = spark.createDataFrame([("A", "x", 1, None)], HIST)
    out = interval_join(base, hist, ["v"], prefix="names")
    assert out.columns == ["company_krs", "entry_number", "extra", "names_v"]


cases = st.tuples(
    st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.one_of(st.none(), st.integers(0, 70))), max_size=30),
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", "D"]),
            st.text("xyz", min_size=1, max_size=2),
            st.one_of(st.none(), st.integers(0, 70)),
            st.one_of(st.none(), st.integers(0, 75)),
        ),
        max_size=20,
    ),
    st.sampled_from([1, 3, 8, 64]),
)


@settings(max_examples=12, deadline=None)
@given(cases)
def test_binned_join_equals_brute_force(spark, case):
    base, hist, width = case
    out = interval_join(spark.createDataFrame(base, BASE), spark.createDataFrame(hist, HIST), ["v"], bin_rows=width)
    assert rows(out) == brute_force(base, hist)


def test_chain_row_count_is_product_of_matches(spark):
    base = spark.createDataFrame([("A", 5)], BASE)
    h1 = spark.createDataFrame([("A", "a", 1, None), ("A", "b", 2, None)], HIST)
    h2 = spark.createDataFrame([("A", "c", 1, None), ("A", "d", 3, None), ("A", "e", 4, None)], HIST)
    h3 = spark.createDataFrame([("A", "f", 9, None)], HIST)
    out = interval_chain(base, [AsOfSpec(h1, ("v",), "one"), AsOfSpec(h2, ("v",), "two"), AsOfSpec(h3, ("v",), "three")])
    assert out.count() == 2 * 3 * 1
    assert out.columns == ["company_krs", "entry_number", "one_v", "two_v", "three_v"]


def test_chain_does_not_reshuffle_the_base(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hs = [spark.createDataFrame([("A", "a", 1, 7)], HIST) for _ in range(4)]
        specs = [AsOfSpec(h, ("v",), f"p{i}") for i, h in enumerate(hs)]
        # few rows per key: the plain key join, one shuffle for the base and one for each history, no replicas
        plan = interval_chain(spark.createDataFrame([("A", 5)], BASE), specs)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 5 and "Generate" not in plan
        many = spark.createDataFrame([("A", i) for i in range(300)], BASE)
        plan = interval_chain(many, specs, bin_rows=8)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        # the base is shuffled to (key, range, bin) once; later joins reuse that partitioning
        import re

        assert len(re.findall(r"Exchange hashpartitioning\([^)]*__strata_bin#", plan)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_date_axis(spark):
    import datetime as dt

    d = dt.date
    base = spark.createDataFrame([("A", d(2020, 1, 5)), ("A", d(2021, 1, 1))], "company_krs string, entry_number date")
    hist = spark.createDataFrame(
        [("A", "x", d(2020, 1, 1), d(2020, 6, 1)), ("A", "y", d(2020, 6, 1), None)],
        "company_krs string, v string, valid_from_entry date, valid_to_entry date",
    )
    assert rows(interval_join(base, hist, ["v"], bin_rows=30), "v") == [("x",), ("y",)]


def test_start_match_join_keeps_all_pairs(spark):
    s = spark.createDataFrame([("A", "s1", 1, None), ("A", "s2", 1, None), ("B", None, None, None)], HIST)
    c = spark.createDataFrame([("A", "c1", 1, None), ("A", "c2", 1, None), ("B", None, None, None)], HIST)
    p = spark.createDataFrame([("A", "p1", 1, None), ("A", "p2", 1, None)], HIST)
    two = start_match_join(s, c, ["v"], prefix="count")
    assert two.columns == ["company_krs", "v", "valid_from_entry", "valid_to_entry", "count_v"]
    assert two.count() == 4 + 1
    three = start_match_chain(s, [AsOfSpec(c, ("v",), "count"), AsOfSpec(p, ("v",), "pref")])
    assert three.count() == 8 + 1
    assert rows(three.where("company_krs = 'B'"), "count_v", "pref_v") == [(None, None)]


def test_huge_interval_is_clamped_to_the_key_extent(spark):
    base = spark.createDataFrame([("A", 5), ("A", 6), ("B", 1)], BASE)
    hist = spark.createDataFrame(
        [("A", "far", -2_000_000_000, 2_000_000_000), ("A", "open", 6, None), ("B", "short", 1, 3)], HIST
    )
    out = interval_join(base, hist, ["v"], bin_rows=2)
    assert rows(out) == brute_force(
        [("A", 5), ("A", 6), ("B", 1)],
        [("A", "far", -2_000_000_000, 2_000_000_000), ("A", "open", 6, None), ("B", "short", 1, 3)],
    )


def test_custom_column_names(spark):
    from strata import reopen_orphans

    timeline = spark.createDataFrame([("e1", 1), ("e1", 4), ("e1", 9)], "entity string, n int")
    history = spark.createDataFrame(
        [("e1", "active", 1, 4), ("e1", "paused", 4, 6), ("e1", "closed", 8, None)],
        "entity string, status string, from_n int, to_n int",
    )
    hist = reopen_orphans(history, keys=["entity"], start="from_n", end="to_n")  # paused: 6 has no successor
    facts = interval_join(timeline, hist, ["status"], prefix="s", keys=["entity"], at="n", start="from_n", end="to_n")
    assert facts.columns == ["entity", "n", "s_status"]
    assert rows(facts) == [("e1", 1, "active"), ("e1", 4, "paused"), ("e1", 9, "closed"), ("e1", 9, "paused")]


hist_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.text("pq", min_size=1, max_size=2),
        st.one_of(st.none(), st.integers(0, 40)),
        st.one_of(st.none(), st.integers(0, 45)),
    ),
    max_size=10,
)


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 40)), max_size=15),
    hist_rows,
    hist_rows,
    st.sampled_from([1, 4, 32]),
)
def test_chain_equals_brute_force_product(spark, base, h1, h2, width):
    def matches(hist, k, e):
        return [v for hk, v, s, t in hist if hk == k and s is not None and s <= e and (t is None or t > e)] or [None]

    want = sorted(((k, e, a, b) for k, e in base for a in matches(h1, k, e) for b in matches(h2, k, e)), key=repr)
    specs = [AsOfSpec(spark.createDataFrame(h, HIST), ("v",), p) for h, p in ((h1, "one"), (h2, "two"))]
    got = interval_chain(spark.createDataFrame(base, BASE), specs, bin_rows=width)
    assert rows(got) == want


@settings(max_examples=15, deadline=None)
@given(hist_rows, hist_rows, hist_rows)
def test_start_match_chain_equals_brute_force(spark, s, c, p):
    def partners(other, k, start):
        return [v for ok, v, os_, _ in other if ok == k and start is not None and os_ == start] or [None]

    want = sorted(
        ((k, v, start, end, a, b) for k, v, start, end in s for a in partners(c, k, start) for b in partners(p, k, start)),
        key=repr,
    )
    specs = [AsOfSpec(spark.createDataFrame(c, HIST), ("v",), "c"), AsOfSpec(spark.createDataFrame(p, HIST), ("v",), "p")]
    got = start_match_chain(spark.createDataFrame(s, HIST), specs)
    assert rows(got) == want


def test_far_entries_and_gaps_are_not_enumerated(spark):
    base = [("K", 1), ("K", 2_000_000_000), ("K", -7), ("L", 5), (None, 3), ("K", None)]
    hist = [("K", "open", 1, None), ("K", "far", 1_999_999_990, 2_000_000_001), ("K", "long", -100, 1_500_000_000)]
    hist += [("K", "none", 9, 9), ("L", "gap", 6, 2_000_000_000), ("L", "low", -2_000_000_000, 6)]
    out = interval_join(spark.createDataFrame(base, BASE), spark.createDataFrame(hist, HIST), ["v"])
    assert rows(out) == brute_force(base, hist)


def test_timestamp_axis_over_years(spark):
    from datetime import datetime, timedelta

    t = datetime(2001, 1, 1)
    base = [("K", t + timedelta(days=d, microseconds=d)) for d in range(0, 4000, 97)]
    hist = [("K", str(d), t + timedelta(days=d), t + timedelta(days=d + 300) if d % 2 else None) for d in range(0, 4000, 501)]
    out = interval_join(
        spark.createDataFrame(base, "company_krs string, entry_number timestamp"),
        spark.createDataFrame(hist, "company_krs string, v string, valid_from_entry timestamp, valid_to_entry timestamp"),
        ["v"],
    )
    assert rows(out) == brute_force(base, hist)


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 200)), min_size=20, max_size=120),
    st.lists(
        st.tuples(st.sampled_from(["A", "B"]), st.text("xyz", min_size=1, max_size=2), st.integers(-5, 200),
                  st.one_of(st.none(), st.integers(0, 230))),
        max_size=30,
    ),
)
def test_bins_and_ranges_equal_brute_force(spark, base, hist):
    # one row a bin and few partitions: every key is cut into ranges and bins
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        left = spark.createDataFrame(base, BASE)
        assert asof.measure(left, ["company_krs"], "entry_number", 1) is not None
        out = interval_join(left, spark.createDataFrame(hist, HIST), ["v"], bin_rows=1)
        assert rows(out) == brute_force(base, hist)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_timestamps_need_no_more_bins_than_rows(spark):
    # one hot key on a microsecond axis: edges are sampled rows, about one for each bin_rows rows
    base = spark.range(20_000).selectExpr("'K' AS k", "timestamp_micros(id * 977 + id % 7) AS at")
    split = asof.measure(base, ["k"], "at", 32)
    edges = split.bins.selectExpr("sum(size(__strata_edges)) AS n").first()["n"]
    assert 0.5 * 20_000 / 32 < edges < 2 * 20_000 / 32
    hist = base.where("unix_micros(at) % 3 = 0").selectExpr(
        "k", "unix_micros(at) AS v", "at AS s", "timestamp_micros(unix_micros(at) + 5000) AS e"
    )
    placed = asof.binned_history(asof.AsOfSpec(hist, ("v",)), ["k"], "s", "e", base.schema["at"].dataType, split)
    assert placed.count() < 3 * hist.count()


def _hot_issue(spark, k):
    """``k`` series, counts and preferences at one entry of one company, and a few ordinary rows."""
    def side(name, n):
        hot = spark.range(n).selectExpr("'HOT' AS company_krs", f"concat('{name}', id) AS v", "1 AS valid_from_entry",
                                        "CAST(NULL AS INT) AS valid_to_entry")
        few = spark.createDataFrame([("K1", f"{name}a", 1, None), ("K1", f"{name}b", 2, None), (None, "n", 1, None)], HIST)
        return hot.unionByName(few)

    return side("s", k), side("c", k).where("v <> 'ca'"), side("p", 3)


def test_hot_pairs_are_dealt_over_tasks(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        series, counts, prefs = _hot_issue(spark, 300)
        specs = [AsOfSpec(counts, ("v",), "c"), AsOfSpec(prefs, ("v",), "p")]
        plain = start_match_chain(series, specs)
        dealt = start_match_chain(series, specs, pair_rows=16)
        assert dealt.columns == plain.columns
        assert plain.count() == dealt.count() == 300 * 300 * 3 + 1 + 1 + 1
        assert plain.exceptAll(dealt).count() == 0
        assert rows(dealt.where("company_krs = 'K1' OR company_krs IS NULL")) == rows(
            plain.where("company_krs = 'K1' OR company_krs IS NULL")
        )

        def largest(df):
            n = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            return max(n) / sum(n)

        assert largest(plain) > 0.9 and largest(dealt) < 0.35
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=6, deadline=None)
@given(hist_rows, hist_rows, hist_rows)
def test_dealt_start_match_equals_brute_force(spark, s, c, p):
    def partners(other, k, start):
        return [v for ok, v, os_, _ in other if ok == k and start is not None and os_ == start] or [None]

    want = sorted(
        ((k, v, start, end, a, b) for k, v, start, end in s for a in partners(c, k, start) for b in partners(p, k, start)),
        key=repr,
    )
    specs = [AsOfSpec(spark.createDataFrame(c, HIST), ("v",), "c"), AsOfSpec(spark.createDataFrame(p, HIST), ("v",), "p")]
    assert rows(start_match_chain(spark.createDataFrame(s, HIST), specs, pair_rows=1)) == want
