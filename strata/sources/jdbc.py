"""JDBC source and sink.

The reference reads the whole source table in one task and sends its "current
rows only" query under an option Spark ignores (quirk Q1). Here the filter and
column list become the ``dbtable`` subquery, and an optional range partitioning
lets many tasks fetch in parallel - one task cannot pull a 100 TB source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class RangePartitioning:
    """Split the read into ``num_partitions`` range queries over a numeric column."""

    column: str
    lower_bound: int
    upper_bound: int
    num_partitions: int


    def __post_init__(self) -> None:
        if self.num_partitions < 1 or self.lower_bound > self.upper_bound:
            raise ValueError("a range read needs lower_bound <= upper_bound and at least one partition")


def bounds_query(table: str, column: str, source_filter: str | None = None) -> str:
    """``dbtable`` text for the smallest and largest value of ``column`` among the rows read."""
    where = f" WHERE {source_filter}" if source_filter else ""
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}{where}) bounds"


def derive_partitioning(
    spark: SparkSession, url: str, table: str, column: str, num_partitions: int, source_filter: str | None = None, **access
) -> RangePartitioning:
    """Range partitioning whose bounds are asked from the database (one row); an empty table reads as one range."""
    options = jdbc_read_options(url, bounds_query(table, column, source_filter), **access)
    row = spark.read.format("jdbc").options(**options).load().first()
    lo, hi = (0, 0) if row is None or row[0] is None else (int(row[0]), int(row[1]))
    return RangePartitioning(column, lo, hi, num_partitions)


def read_properties(path: str) -> dict[str, str]:
    """``key=value`` lines (user, password, driver, ...); blank lines and those starting with # are skipped."""
    with open(path, encoding="utf-8") as f:
        lines = [line.strip() for line in f]
    pairs = [line.partition("=") for line in lines if line and not line.startswith("#")]
    return {key.strip(): value.strip() for key, _, value in pairs}


def source_query(table: str, columns: Sequence[str] | None = None, source_filter: str | None = None) -> str:
    """``dbtable`` text: the table itself, or a subquery with projection and filter."""
    if not columns and not source_filter:
        return table
    select = ", ".join(columns) if columns else "*"
    where = f" WHERE {source_filter}" if source_filter else ""
    return f"(SELECT {select} FROM {table}{where}) src"


def jdbc_read_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetchsize: int | None = None,
    columns: Sequence[str] | None = None,
    source_filter: str | None = None,
    partitioning: RangePartitioning | None = None,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": source_query(table, columns, source_filter)}
    for name, value in (("user", user), ("password", password), ("driver", driver), ("fetchsize", fetchsize)):
        if value is not None:
            opts[name] = str(value)
    if partitioning is not None:
        opts.update(
            partitionColumn=partitioning.column,
            lowerBound=str(partitioning.lower_bound),
            upperBound=str(partitioning.upper_bound),
            numPartitions=str(partitioning.num_partitions),
        )
    return opts


def quantile_predicates(cuts: Sequence[int], column: str) -> list[str]:
    """One WHERE clause per read task: the ranges between ``cuts``, which together hold every row once, rows
    without ``column`` included (they go to the first)."""
    cuts = sorted(set(cuts))
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def sample_query(table: str, column: str, one_in: int, source_filter: str | None = None) -> str:
    """``dbtable`` text of every ``one_in``-th id (by value), computed in the database."""
    where = f"({source_filter}) AND " if source_filter else ""
    return f"(SELECT {column} AS v FROM {table} WHERE {where}MOD({column}, {one_in}) = 0) ids"


def quantile_cuts(ids: DataFrame, num_partitions: int) -> list[int]:
    """Up to ``num_partitions - 1`` values of ``ids`` (column ``v``) that split it into equal shares; the quantiles are
    sketched by Spark, only they reach the driver."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be positive")
    shares = [i / num_partitions for i in range(1, num_partitions)]
    return sorted({int(v) for v in ids.approxQuantile("v", shares, 0.1 / num_partitions)}) if shares else []


def derive_predicates(
    spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
    source_filter: str | None = None, one_in: int = 1000, **access: str,
) -> list[str]:
    """Predicates of about equal numbers of rows from a sample of the ids, so that gaps and dense stretches do not
    leave one task with most rows, as equal strides between the bounds do."""
    options = jdbc_read_options(url, sample_query(table, column, one_in, source_filter), **access)
    return quantile_predicates(quantile_cuts(spark.read.format("jdbc").options(**options).load(), num_partitions), column)


def read_jdbc(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None = None, **kwargs
) -> DataFrame:
    """JDBC scan (S1) with the source filter applied in the database (S2); one task per predicate when given."""
    if predicates:
        options = jdbc_read_options(url, table, **kwargs)
        where = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, options["dbtable"], predicates=list(predicates), properties=where)
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kwargs)).load()


def jdbc_write_options(truncate: bool = True, batchsize: int = 200) -> dict[str, str]:
    return {"truncate": str(truncate).lower(), "batchsize": str(batchsize)}


def limit_connections(df: DataFrame, max_connections: int | None) -> DataFrame:
    """Cap writer tasks (K4) with a narrow ``coalesce`` - never a shuffle, never more partitions."""
    if max_connections is None:
        return df
    return df.coalesce(max_connections)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    max_connections: int | None = 4,
    truncate: bool = True,
    batchsize: int = 200,
    mode: str = "overwrite",
) -> None:
    """Overwrite a table keeping its DDL (``truncate``), batched inserts (K3)."""
    writer = limit_connections(df, max_connections).write.mode(mode)
    for key, value in jdbc_write_options(truncate, batchsize).items():
        writer = writer.option(key, value)
    writer.jdbc(url, table, properties=properties or {})
