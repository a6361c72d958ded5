from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from strata import jobs
from strata.plans import derived_registry
from strata.plans import registry as R
from strata.session import build_session, fresh_path, release, shared_dir
from strata.sources import jdbc
from strata.sources.tables import read_table
from tests.registry_fixtures import raw_rows
from tests.test_registry import FULL_HISTORY_COLUMNS


def test_every_query_has_an_oracle():
    # most of the optional corpus operators have no SQL form; their own tests hold them against brute force
    own = {name for name in contract.queries() if not re.fullmatch(r"op\d+_.*|pipeline", name)}
    assert own == {name for name in contract.oracle_sql() if name in own} and len(own) >= 35


def test_missing_packages_of_optional_operators_leave_the_rest(monkeypatch):
    """Also a folder that is there but does not import: the other queries stay."""
    code = Path(contract.__file__).read_text()
    for name in ("strata.llm", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)  # importing it raises ImportError
    names: dict = {"__name__": "entry_without_optional"}
    exec(compile(code, contract.__file__, "exec"), names)
    left = names["queries"]()
    assert set(left) == set(names["oracle_sql"]()) and len(left) == 51


def test_every_silver_table_has_a_query():
    assert len(derived_registry.SILVER) == 14 and len(derived_registry.QUERIES) == 26


def test_entry_is_the_registry_full_history(spark):
    df = contract.entry(spark)
    assert df.columns == FULL_HISTORY_COLUMNS
    assert df.limit(5).count() == 5


def test_jobs_run_all_stages(spark, tmp_path):
    src = str(tmp_path / "raw")
    spark.createDataFrame(raw_rows(), "id long, krs_number string, raw_data string").write.parquet(src)
    out = str(tmp_path / "lake")
    jobs.main(["all", "--source-table", src, "--out", out, "--tie-break", "company_name", "address_street"], spark=spark)
    cur = read_table(spark, f"{out}/gold/current_info")
    assert cur.columns == FULL_HISTORY_COLUMNS and cur.count() == 3
    assert read_table(spark, f"{out}/bronze").count() == 4
    assert read_table(spark, f"{out}/gold/shares_issues").count() > 0


def test_export_targets_match_reference_tables():
    assert [t for _, t, _ in jobs.EXPORTS] == [
        "stg_full_history", "stg_shares_issues", "stg_amendments", "stg_current_company_info"
    ]
    assert [c for _, _, c in jobs.EXPORTS] == [True, False, True, True]


def test_no_query_plans_a_cross_or_nested_loop_join(spark):
    for name, fn in contract.queries().items():
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_cli_settings():
    sized = jobs.settings_from(jobs.parser().parse_args(["all", "--out", "/x", "--input-bytes", "1e13", "--cores", "400"]))
    assert sized.shuffle_partitions == 18627 and sized.advisory_partition_size == "1024m"
    fixed = jobs.settings_from(jobs.parser().parse_args(["gold", "--out", "/x", "--shuffle-partitions", "500"]))
    assert fixed.shuffle_partitions == 500


def test_cli_reaches_every_setting():
    args = jobs.parser().parse_args(
        ["all", "--out", "/x", "--executor-memory", "9g", "--network-timeout", "900s", "--no-skew-join",
         "--checkpoint-dir", "/shared/ckpt", "--conf", "spark.sql.extensions=a.B", "--conf", "spark.executorEnv.X=k=v"]
    )
    s = jobs.settings_from(args)
    conf = {**s.static_conf(), **s.sql_conf(), **s.extra}
    assert conf["spark.executor.memory"] == "9g" and conf["spark.network.timeout"] == "900s"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "false" and conf["spark.checkpoint.dir"] == "/shared/ckpt"
    assert conf["spark.sql.extensions"] == "a.B" and conf["spark.executorEnv.X"] == "k=v"
    args = jobs.parser().parse_args(["all", "--out", "/x", "--input-bytes", "1e13", "--executor-memory", "9g"])
    assert jobs.settings_from(args).executor_memory == "9g" and jobs.settings_from(args).shuffle_partitions == 18627


def test_extra_options_reach_a_running_session(spark):
    settings = jobs.Settings(extra={"spark.sql.caseSensitive": "true"})
    before = {k: spark.conf.get(k, None) for k in (*settings.sql_conf(), *settings.extra, "spark.sql.session.timeZone")}
    try:
        assert build_session(settings).conf.get("spark.sql.caseSensitive") == "true"
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_credentials_come_from_a_file(tmp_path):
    path = tmp_path / "db.properties"
    path.write_text("# access\nuser = u\npassword=a=b\n\nurl=ignored\n")
    args = jobs.parser().parse_args(["gold", "--out", "/x", "--export-properties", str(path), "--export-user", "v"])
    assert jobs.credentials(args, "export") == {"user": "v", "password": "a=b"}
    assert jobs.credentials(args, "jdbc") == {}


def test_range_reads_need_bounds_and_a_count():
    base = ["bronze", "--out", "/x", "--jdbc-url", "jdbc:x", "--jdbc-table", "t", "--jdbc-partition-column", "id"]
    for more in ([], ["--jdbc-num-partitions", "8", "--jdbc-upper-bound", "9"]):
        with pytest.raises(ValueError):
            jobs.read_source(None, jobs.parser().parse_args(base + more))
    with pytest.raises(ValueError):
        jdbc.RangePartitioning("id", 9, 0, 4)
    assert jdbc.bounds_query("t", "id", "c = 1") == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM t WHERE c = 1) bounds"


def test_only_own_staged_folders_are_released(spark, tmp_path):
    path = fresh_path(spark, "mine")
    spark.range(3).write.parquet(path)
    local = Path(path.removeprefix("file:"))
    assert local.is_dir() and release(spark, path) and not local.exists() and not release(spark, path)
    other = tmp_path / "other"
    other.mkdir()
    assert not release(spark, str(other)) and other.is_dir()


def test_silver_layout_sorts_without_a_shuffle(spark, tmp_path):
    raw = spark.createDataFrame(raw_rows(), "id long, krs_number string, raw_data string")
    out = str(tmp_path / "lake")
    R.run_bronze(raw, out)
    R.run_silver(spark, out)
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("parsed-*"))
    for name, df in R.silver(R.bronze(raw)).items():
        got = read_table(spark, f"{out}/silver/{name}")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect())), name


def test_quantile_reads_hold_every_row_once(spark):
    """Ids with a gap and a dense stretch: equal shares per task, where equal strides leave one with most rows."""
    ids = spark.range(100, 5100).selectExpr("id AS v").unionByName(spark.range(1_000_000, 1_000_500).selectExpr("id AS v"))
    cuts = jdbc.quantile_cuts(ids, 8)
    clauses = jdbc.quantile_predicates(cuts, "v")
    table = ids.unionByName(spark.createDataFrame([(None,), (-5,)], "v long"))
    counts = [table.where(c).count() for c in clauses]
    assert len(clauses) == 8 and sum(counts) == table.count() and max(counts) < 1.3 * table.count() / 8
    assert jdbc.quantile_predicates([], "v") == ["1 = 1"] and jdbc.quantile_cuts(ids, 1) == []
    assert jdbc.quantile_predicates([7, 3, 7], "v") == ["v < 3 OR v IS NULL", "v >= 3 AND v < 7", "v >= 7"]
    assert jdbc.sample_query("t", "id", 10, "c = 1") == "(SELECT id AS v FROM t WHERE (c = 1) AND MOD(id, 10) = 0) ids"
    bad = ["bronze", "--out", "/x", "--jdbc-url", "jdbc:x", "--jdbc-table", "t", "--jdbc-quantiles", "100"]
    with pytest.raises(ValueError):
        jobs.read_source(None, jobs.parser().parse_args(bad))


def test_environment_gives_defaults():
    given = {"STRATA_OUT": "/lake", "STRATA_SHUFFLE_PARTITIONS": "500", "STRATA_TIE_BREAK": "a,b", "STRATA_KRYO": "false",
             "STRATA_CONF": "x.y=1,x.z=2", "STRATA_TRUNCATE": "false", "OUT": "/other"}
    args = jobs.parser(given).parse_args(["gold"])
    assert (args.out, args.shuffle_partitions, args.tie_break, args.kryo) == ("/lake", 500, ["a", "b"], False)
    assert args.conf == ["x.y=1", "x.z=2"] and args.truncate is False
    assert jobs.settings_from(args).extra == {"x.y": "1", "x.z": "2"}
    assert jobs.parser(given).parse_args(["gold", "--out", "/y", "--shuffle-partitions", "7"]).shuffle_partitions == 7
    with pytest.raises(SystemExit):
        jobs.parser({}).parse_args(["gold"])
