"""Lookups in sorted arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_at_most(values: Column, limit: Column) -> Column:
    """How many elements of the sorted array are at most ``limit``, by halving steps: log n comparisons a row.
    NULLs (sorted last) never count; 0 for a NULL limit or a NULL array."""
    steps = F.reverse(F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")))

    def advance(at: Column, bit: Column) -> Column:
        ahead = at + F.call_function("shiftleft", F.lit(1), bit)
        return F.when(F.get(values, ahead - 1) <= limit, ahead).otherwise(at)

    return F.coalesce(F.aggregate(steps, F.lit(0), advance), F.lit(0))
