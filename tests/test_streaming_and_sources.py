from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata import cluster
from strata.plans import registry as R
from strata.session import Settings, fresh_path, shared_dir
from strata.sources.jdbc import RangePartitioning, jdbc_read_options, jdbc_write_options, limit_connections, source_query
from strata.sources.tables import read_clustered, read_table, write_table
from strata.streaming.incremental import start_silver_stream
from tests.conftest import rows
from tests.registry_fixtures import raw_rows

RAW = "id long, krs_number string, raw_data string"


def test_stream_matches_batch_silver(spark, tmp_path):
    src = str(tmp_path / "raw")
    spark.createDataFrame(raw_rows(), RAW).write.parquet(src)
    out = str(tmp_path / "silver")
    q = start_silver_stream(spark, src, out, checkpoint_location=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    batch = R.silver(R.bronze(spark.createDataFrame(raw_rows(), RAW)))
    for name in ("registry", "names", "address", "share_issues_series_name", "statute_change"):
        streamed = spark.read.parquet(f"{out}/{name}").drop("batch_id")
        assert rows(streamed) == rows(batch[name]), name


def test_source_query_pushes_filter_into_subquery():
    assert source_query("db_data") == "db_data"
    q = source_query("db_data", ["id", "krs_number", "raw_data"], "is_current = TRUE")
    assert q == "(SELECT id, krs_number, raw_data FROM db_data WHERE is_current = TRUE) src"


def test_jdbc_options():
    opts = jdbc_read_options(
        "jdbc:postgresql://h/db", "db_data", user="u", password="p", driver="org.postgresql.Driver", fetchsize=1000,
        source_filter="is_current = TRUE", partitioning=RangePartitioning("id", 0, 1000, 8),
    )
    assert opts["dbtable"].endswith("WHERE is_current = TRUE) src")
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id" and opts["fetchsize"] == "1000"
    assert "db_data" not in [k for k in opts]  # no ignored option keys
    assert jdbc_write_options() == {"truncate": "true", "batchsize": "200"}


def test_connection_cap_is_narrow(spark):
    df = spark.range(100).repartition(10)
    capped = limit_connections(df, 4)
    assert capped.rdd.getNumPartitions() == 4
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 4" in plan and "Exchange" not in plan.split("Coalesce 4")[0]  # no shuffle added on top
    assert limit_connections(spark.range(10).coalesce(2), 4).rdd.getNumPartitions() <= 4


def test_table_roundtrip_and_pushdown(spark):
    path = fresh_path(spark, "t")
    assert path.startswith(shared_dir(spark))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_table(df, path)
    back = read_table(spark, path, columns=["v"], source_filter="k = 2")
    assert rows(back) == [("b",)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,2)]" in plan
    clustered = read_clustered(spark, path, keys=["k"], sort_by=["k"], num_partitions=3)
    assert clustered.rdd.getNumPartitions() <= 3 and rows(clustered) == [(1, "a"), (2, "b")]


def test_settings_conf():
    s = Settings()
    conf = {**s.static_conf(), **s.sql_conf()}
    assert conf["spark.sql.shuffle.partitions"] == "96"
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "64m"
    assert conf["spark.serializer"].endswith("KryoSerializer")
    assert conf["spark.ui.enabled"] == "false"


def test_replayed_batch_rewrites_the_same_output(spark, tmp_path):
    from strata.streaming.incremental import silver_batch_writer

    out = str(tmp_path / "silver")
    write = silver_batch_writer(out)
    batch = spark.createDataFrame(raw_rows(), RAW)
    write(batch, 7)
    first = rows(spark.read.parquet(f"{out}/names"))
    write(batch, 7)  # replay after a failure
    assert rows(spark.read.parquet(f"{out}/names")) == first


def test_settings_for_scale():
    big = Settings.for_scale(100 * 1024**4, cores=4000)  # 100 TiB on 1000 x 4 cores
    assert big.shuffle_partitions == 204_800 and big.advisory_partition_size == "1024m"
    conf = big.sql_conf()
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "204800"
    assert conf["spark.sql.files.maxPartitionBytes"] == "1024m"
    assert big.static_conf()["spark.executor.memory"] == "14g" and big.executor_cores == "4"
    small = Settings.for_scale(1024**2, cores=8, time_zone="Europe/Warsaw")
    assert small.shuffle_partitions == 16 and small.time_zone == "Europe/Warsaw"


def test_clustered_files_are_sorted_and_disjoint(spark, tmp_path):
    """Order on disk: rows of a file rise by key and order, files cover disjoint ranges (a hot key several of
    them), and the row groups' statistics say so, which is what lets readers skip them."""
    path = str(tmp_path / "laid")
    base = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("k00500")).otherwise(F.format_string("k%05d", F.col("id") % 1000)).alias("k"),
        F.pmod(F.hash("id"), F.lit(100_000)).alias("n"),
    )
    write_table(cluster(base, 8, ["k"], ["k", "n"]), path, atomic=False)
    ranges, hot = [], 0
    for file in sorted((tmp_path / "laid").glob("*.parquet")):
        kept = list(map(tuple, pq.read_table(file).to_pandas()[["k", "n"]].itertuples(index=False)))
        assert kept == sorted(kept)
        meta = pq.ParquetFile(file).metadata
        groups = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        assert min(g.min for g in groups) == kept[0][0] and max(g.max for g in groups) == kept[-1][0]
        ranges.append((kept[0], kept[-1]))
        hot += any(k == "k00500" for k, _ in kept)
    ranges.sort()
    assert all(last <= first for (_, last), (first, _) in zip(ranges, ranges[1:]))
    assert len(ranges) > 4 and hot > 2
