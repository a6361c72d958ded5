"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import materialize

__all__ = ["byte_values", "digest", "documents", "groups", "materialize", "pages", "spread", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def digest(text: Column) -> Column:
    """Identity of an exact text (null counts as empty): its MD5 as 16 bytes."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def byte_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def spread(df: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over a number of tasks of its own. Rows that only name work (files, blocks) are so
    small that adaptive execution would merge their partitions into one; a given count is not merged."""
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(n_rows, max(wide, -(-n_rows // 16)))), *keys)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Runs of equal ``key`` in a stream of record batches that arrive sorted by ``key``."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != current:
                yield current, rows
                rows = []
            current = row[key]
            rows.append(row)
    if rows:
        yield current, rows
