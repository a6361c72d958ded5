"""File-table sources and sinks.

Delta is not installed here, so the format is a parameter (default parquet). File formats are written
as snapshots and published atomically (:mod:`.snapshots`); formats with a commit log of their own are
written by their own writer. Filters and column lists are handed to Catalyst, which pushes them into the
scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.layout import cluster
from . import snapshots

FILE_FORMATS = ("parquet", "orc", "json", "csv")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    source_filter: str | Column | None = None,
) -> DataFrame:
    """Read a table (its newest version, or a plain folder); ``columns`` and ``source_filter`` (S2's intent)
    reach the scan."""
    df = snapshots.load(spark, path, fmt) if fmt in FILE_FORMATS else spark.read.format(fmt).load(path)
    if source_filter is not None:
        df = df.where(source_filter)
    if columns:
        df = df.select(*columns)
    return df


def read_clustered(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = ("company_krs",),
    sort_by: Sequence[str] = ("company_krs", "valid_from_entry"),
    num_partitions: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Clustered scan (S4): read, range-partition by key and order, sort within partitions.

    The reference hard-codes 24 partitions; here the width is a parameter and by
    default follows ``spark.sql.shuffle.partitions`` so it grows with the cluster.
    """
    return cluster(read_table(spark, path, fmt), num_partitions, keys, sort_by)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    overwrite_schema: bool = False,
    partition_by: Sequence[str] = (),
    atomic: bool | None = None,
) -> None:
    """Full overwrite (K1) or append, published atomically for file formats: until the new rows are whole the old
    ones are read, also by the query that is being written. ``overwrite_schema`` (K2) lets the columns or
    types change; without it a change is an error. ``atomic=False`` writes a plain folder (a staged copy).
    """
    if fmt in FILE_FORMATS if atomic is None else atomic:
        snapshots.publish(df, path, fmt, mode, overwrite_schema, partition_by)
        return
    writer = df.write.format(fmt).mode(mode)
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
