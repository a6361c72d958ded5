"""A key holding most rows must not land in one task (binned join, pair-join repair, partial top-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import interval_join, latest_per_key, reopen_orphans


def _partition_shares(df):
    counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    total = sum(r["count"] for r in counts)
    return max(r["count"] for r in counts) / total, len(counts)


def _skewed(spark, n=20000):
    # key HOT holds ~95% of the timeline and of the history
    base = spark.range(n).select(
        F.when(F.col("id") % 20 == 0, F.concat(F.lit("K"), (F.col("id") % 97).cast("string"))).otherwise(F.lit("HOT"))
        .alias("company_krs"),
        (F.col("id") + 1).cast("int").alias("entry_number"),
    )
    hist = base.where(F.col("entry_number") % 3 == 1).select(
        "company_krs",
        F.col("entry_number").cast("string").alias("v"),
        F.col("entry_number").alias("valid_from_entry"),
        F.when(F.col("entry_number") % 2 == 0, F.col("entry_number") + 3).cast("int").alias("valid_to_entry"),
    )
    return base, hist


def _no_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def _restore(spark):
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_binned_join_spreads_a_hot_key(spark):
    _no_adaptive(spark)
    try:
        base, hist = _skewed(spark)
        binned, used = _partition_shares(interval_join(base, hist, ["v"], bin_rows=16))
        keyed, _ = _partition_shares(interval_join(base, hist, ["v"], method="key"))
        assert keyed > 0.9  # the reference plan: one task holds the hot key
        assert binned < 0.3 and used >= 6
    finally:
        _restore(spark)


def test_repair_spreads_a_hot_key(spark):
    _no_adaptive(spark)
    try:
        _, hist = _skewed(spark)
        repaired = reopen_orphans(hist)
        # every column is measured, so that the join stays in the plan
        tagged = repaired.withColumn("p", F.spark_partition_id())
        assert "Join" in tagged._jdf.queryExecution().executedPlan().toString()
        sizes = [r["n"] for r in tagged.groupBy("p").agg(F.count("*").alias("n"), F.count("valid_to_entry")).collect()]
        assert max(sizes) / sum(sizes) < 0.3 and len(sizes) >= 6
    finally:
        _restore(spark)


def test_interval_replication_spreads_a_hot_key(spark):
    """2,000 open intervals of one key: the tasks that replicate them and join grow with the partitions."""
    from strata.operators import asof

    _no_adaptive(spark)
    try:
        base, hist = _skewed(spark)
        hist = hist.where("company_krs = 'HOT'").limit(2000).withColumn("valid_to_entry", F.lit(None).cast("int"))
        used = {}
        for n in (8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            split = asof.measure(base, ["company_krs"], "entry_number", 16)
            assert split.ranges.count() == 1  # only the hot key is cut into ranges
            spec = asof.AsOfSpec(hist, ("v",))
            at_type = base.schema["entry_number"].dataType
            spread = asof.binned_history(spec, ["company_krs"], "valid_from_entry", "valid_to_entry", at_type, split)
            share, used[n] = _partition_shares(spread)
            assert share < 3 / min(n, 30), (n, share)
        assert used[8] >= 6 and used[64] > 3 * used[8]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        _restore(spark)


def test_top1_ships_one_row_per_map_partition(spark):
    _no_adaptive(spark)
    try:
        base, _ = _skewed(spark)
        out = latest_per_key(base.repartition(8), ["company_krs"], "entry_number")
        assert out.where("company_krs = 'HOT'").collect()[0]["entry_number"] == 20000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Partial") > plan.index("Exchange hashpartitioning(company_krs")
    finally:
        _restore(spark)


def test_numbering_equals_row_number_and_spreads_a_hot_key(spark):
    from pyspark.sql import Window

    from strata.plans.recipes import number_within_key

    _no_adaptive(spark)
    try:
        base, _ = _skewed(spark)
        df = base.select("company_krs", (F.col("entry_number") * 7 % 1001).alias("t"), "entry_number")
        got = number_within_key(df, "company_krs", ["t", "entry_number"], "n")
        w = Window.partitionBy("company_krs").orderBy("t", "entry_number")
        want = df.withColumn("n", F.row_number().over(w))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        share, used = _partition_shares(got.where("company_krs = 'HOT'"))
        assert share < 0.5 and used >= 4
    finally:
        _restore(spark)


def test_cluster_by_range_splits_a_hot_key(spark):
    from strata import cluster

    _no_adaptive(spark)
    try:
        base, _ = _skewed(spark)
        ranged, used = _partition_shares(cluster(base, 8, ["company_krs"], ["company_krs", "entry_number"]))
        hashed, _ = _partition_shares(cluster(base, 8, ["company_krs"], ["entry_number"], method="hash"))
        assert hashed > 0.9 and ranged < 0.3 and used >= 6
    finally:
        _restore(spark)


def test_registry_gold_spreads_a_huge_company(spark):
    from strata.plans import registry as R
    from tests.registry_fixtures import document

    n = 3000
    entries = [(i, "01.01.2020") for i in range(1, n + 1)]
    names = [(f"N{i}", i, i + 10) for i in range(1, n, 10)]  # each replaced 10 entries later
    big = document(entries, names=names, address=[("S", "C", 1, None)])
    small = [document([(1, "01.01.2020"), (2, "02.01.2020")], names=[("x", 1, None)]) for _ in range(20)]
    raw = spark.createDataFrame(
        [(1, "HOT", big)] + [(i + 2, f"K{i}", d) for i, d in enumerate(small)], "id long, krs_number string, raw_data string"
    )
    _no_adaptive(spark)
    try:
        full = R.full_history(R.silver(R.bronze(raw)))
        hot = full.where("company_krs = 'HOT'").select("entry_number", "company_name", "address_street")
        got = {r["entry_number"]: (r["company_name"], r["address_street"]) for r in hot.collect()}
        assert len(got) == n and got[1] == ("N1", "S") and got[15] == ("N11", "S") and got[n] == ("N2991", "S")
        share, used = _partition_shares(full)
        assert share < 0.3 and used >= 6
    finally:
        _restore(spark)
