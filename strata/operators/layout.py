"""Physical layout helpers: clustering by key (L1, L2, O1) and materialisation (L3, L4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..session import fresh_path


def cluster(
    df: DataFrame,
    num_partitions: int | None,
    keys: Sequence[str],
    sort_by: Sequence[str] = (),
    method: str = "range",
) -> DataFrame:
    """Cluster rows by ``keys`` and sort each partition by ``sort_by``.

    Worth it before a write (row groups get tight min/max statistics on the key, later
    reads prune) - not before a join, where the join's own exchange does the same work.
    ``method="range"`` range-partitions on ``keys + sort_by``: a key's rows stay
    contiguous and sorted, and a key holding a large share of the rows is split over
    several tasks. ``method="hash"`` is the reference's ``repartition(n, key)``, which
    sends each key whole to one task. ``num_partitions=None`` uses
    ``spark.sql.shuffle.partitions``.
    """
    if method == "range":
        cols = [*keys, *[c for c in sort_by if c not in keys]]
        out = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    elif method == "hash":
        out = df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)
    else:
        raise ValueError("method must be 'range' or 'hash'")
    return out.sortWithinPartitions(*sort_by) if sort_by else out


def materialize(
    df: DataFrame, path: str | None = None, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Write ``df`` once to the shared folder and return the re-read table.

    This replaces the reference's ``persist(DISK_ONLY)`` + eager ``checkpoint``
    double materialisation: one write, lineage cut, the files survive the loss of
    executors, and the re-read is column-pruned per consumer. ``options`` go to the writer.
    """
    target = path or fresh_path(df.sparkSession, "stage")
    df.write.format(fmt).options(**(options or {})).mode("overwrite").save(target)
    return df.sparkSession.read.format(fmt).load(target)
