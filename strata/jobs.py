"""Command-line jobs: bronze, silver, gold (and all three), like the reference's three submits.

    spark-submit --py-files strata.zip run_registry.py bronze --source-table /shared/raw --out /shared/lake
    python -m strata.jobs all --jdbc-url jdbc:postgresql://h/db --jdbc-table db_data \
        --source-filter "is_current = TRUE" --out /shared/lake --export-url jdbc:postgresql://h/dw

Sources: a table path (``--source-table``) or JDBC (``--jdbc-*``). Gold optionally exports
the four staging tables over JDBC. Settings come from arguments, or from the environment as STRATA_<ARGUMENT>.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from .plans import registry as R
from .session import Settings, build_session
from .sources.jdbc import RangePartitioning, derive_partitioning, derive_predicates, read_jdbc, read_properties, write_jdbc
from .sources.tables import read_table

# Target table names of the JDBC export and whether each is capped to
# the connection limit (the share-issue export is not capped in the reference).
EXPORTS = (
    ("full_history", "stg_full_history", True),
    ("shares_issues", "stg_shares_issues", False),
    ("amendments", "stg_amendments", True),
    ("current_info", "stg_current_company_info", True),
)


# Settings that are arguments of the same name
SETTINGS = (
    "app_name", "executor_memory", "executor_cores", "executor_memory_overhead", "network_timeout",
    "shuffle_max_retries", "shuffle_retry_wait", "advisory_partition_size", "max_partition_bytes", "checkpoint_dir",
)
#: Of environment variables that stand in for arguments.
PREFIX = "STRATA_"
SWITCHES = ("adaptive", "skew_join", "coalesce_partitions", "kryo")


def read_source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.source_table:
        return read_table(spark, args.source_table, args.source_format, source_filter=args.source_filter)
    access = credentials(args, "jdbc")
    partitioning = None
    predicates = None
    if args.jdbc_quantiles:
        if not (args.jdbc_partition_column and args.jdbc_num_partitions):
            raise ValueError("--jdbc-quantiles needs --jdbc-partition-column and --jdbc-num-partitions")
        predicates = derive_predicates(
            spark, args.jdbc_url, args.jdbc_table, args.jdbc_partition_column, args.jdbc_num_partitions,
            args.source_filter, args.jdbc_quantiles, **access,
        )
    elif args.jdbc_partition_column:
        column, parts = args.jdbc_partition_column, args.jdbc_num_partitions
        if parts is None:
            raise ValueError("--jdbc-partition-column needs --jdbc-num-partitions")
        bounds = (args.jdbc_lower_bound, args.jdbc_upper_bound)
        if bounds == (None, None):
            partitioning = derive_partitioning(
                spark, args.jdbc_url, args.jdbc_table, column, parts, args.source_filter, **access
            )
        elif None in bounds:
            raise ValueError("give both --jdbc-lower-bound and --jdbc-upper-bound, or neither")
        else:
            partitioning = RangePartitioning(column, *bounds, parts)
    return read_jdbc(
        spark, args.jdbc_url, args.jdbc_table, fetchsize=args.jdbc_fetchsize,
        columns=["id", "krs_number", "raw_data"], source_filter=args.source_filter, partitioning=partitioning,
        predicates=predicates, **access,
    )


def credentials(args: argparse.Namespace, side: str) -> dict[str, str]:
    """user, password and driver of the ``jdbc`` or ``export`` side: its properties file, then its arguments."""
    path = getattr(args, f"{side}_properties")
    given = read_properties(path) if path else {}
    own = {k: getattr(args, f"{side}_{k}") for k in ("user", "password", "driver")}
    found = {**given, **{k: v for k, v in own.items() if v}}
    return {k: v for k, v in found.items() if k in own}


def run_bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    R.run_bronze(read_source(spark, args), args.out, args.format, args.keep)


def run_silver(spark: SparkSession, args: argparse.Namespace) -> None:
    R.run_silver(spark, args.out, args.format, args.on_error, args.silver_partitions)


def run_gold(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    paths = R.run_gold(spark, args.out, args.format, args.bin_rows, args.tie_break)
    if args.export_url:
        props = credentials(args, "export")
        for name, target, capped in EXPORTS:
            df = read_table(spark, paths[name], args.format)
            write_jdbc(df, args.export_url, target, props, args.max_connections if capped else None,
                       args.truncate, args.batchsize)
    return paths


def parser(environment: Mapping[str, str] | None = None) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata.jobs", description=__doc__.split("\n")[0])
    p.add_argument("stage", choices=["bronze", "silver", "gold", "all"])
    p.add_argument("--out", required=True, help="lake root on shared storage")
    p.add_argument("--format", default="parquet")
    p.add_argument("--source-table")
    p.add_argument("--source-format", default="parquet")
    p.add_argument("--source-filter", help="e.g. \"is_current = TRUE\"; pushed to the source")
    for name in ("url", "table", "user", "password", "driver", "partition-column", "properties"):
        p.add_argument(f"--jdbc-{name}")
    p.add_argument("--jdbc-fetchsize", type=int)
    p.add_argument("--jdbc-lower-bound", type=int, help="asked from the database when neither bound is given")
    p.add_argument("--jdbc-upper-bound", type=int)
    p.add_argument("--jdbc-num-partitions", type=int)
    p.add_argument("--jdbc-quantiles", type=int, metavar="N", help="cut at quantiles of every N-th id, not at equal strides")
    p.add_argument("--keep", choices=["first", "last"], default="first")
    p.add_argument("--on-error", choices=["fail", "null"], default="fail")
    p.add_argument("--silver-partitions", type=int)
    p.add_argument("--bin-rows", type=int, default=R.BIN_ROWS)
    p.add_argument("--tie-break", nargs="*", default=[])
    for name in ("url", "user", "password", "driver", "properties"):
        p.add_argument(f"--export-{name}")
    p.add_argument("--max-connections", type=int, default=4)
    p.add_argument("--batchsize", type=int, default=200)
    p.add_argument("--truncate", type=lambda v: v.lower() == "true", default=True)
    p.add_argument("--shuffle-partitions", type=int, default=96)
    p.add_argument("--input-bytes", type=float, help="size shuffles for this input size (overrides --shuffle-partitions)")
    p.add_argument("--cores", type=int, default=8, help="total task slots, with --input-bytes")
    p.add_argument("--time-zone", default="UTC")
    for name in SETTINGS:
        p.add_argument(f"--{name.replace('_', '-')}")
    for name in SWITCHES:
        p.add_argument(f"--{name.replace('_', '-')}", action=argparse.BooleanOptionalAction)
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="any other Spark option")
    from_environment(p, os.environ if environment is None else environment)
    return p


def from_environment(p: argparse.ArgumentParser, environment: Mapping[str, str]) -> None:
    """Defaults of the arguments from ``STRATA_<ARGUMENT>`` (lists separated by commas); the command line wins."""
    for action in p._actions:
        value = environment.get(f"{PREFIX}{action.dest.upper()}")
        if value is None or not action.option_strings:
            continue
        if isinstance(action, argparse.BooleanOptionalAction):
            action.default = value.lower() in ("1", "true", "yes")
        elif action.nargs == "*" or isinstance(action, argparse._AppendAction):
            action.default = [v for v in value.split(",") if v]
        else:
            action.default, action.required = value, False  # argparse applies the type to a text default


def settings_from(args: argparse.Namespace) -> Settings:
    """Sized from ``--input-bytes``/``--cores`` when given, else the fixed shuffle width."""
    extra = dict(pair.partition("=")[::2] for pair in args.conf)
    given = {n: getattr(args, n) for n in (*SETTINGS, *SWITCHES) if getattr(args, n) is not None}
    common = {"time_zone": args.time_zone, "extra": extra, **given}
    if args.input_bytes:
        return replace(Settings.for_scale(args.input_bytes, args.cores), **common)
    return Settings(shuffle_partitions=args.shuffle_partitions, **common)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if spark is None:
        spark = build_session(settings_from(args))
    stages = ["bronze", "silver", "gold"] if args.stage == "all" else [args.stage]
    for stage in stages:
        {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}[stage](spark, args)


if __name__ == "__main__":
    main()
