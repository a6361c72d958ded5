"""One row per key: first / latest.

``row_number() = 1`` over a key window is planned by Catalyst as a
``WindowGroupLimit``: a partial top-1 runs in every map task *before* the
shuffle, so each key ships at most one row per input partition. A key that
holds a third of the table therefore does not arrive whole at one reducer.

Rows with a large payload (raw documents) take :func:`first_per_key_late`: ranks are
found on keys and order alone and the payload is only filtered, not sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path, stored_bytes
from .layout import materialize

#: Superseded ids are broadcast while their staged copy is at most this large.
BROADCAST_BYTES = 32 * 1024**2

_RANK = "__strata_rank"


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``; columns unchanged."""
    window = Window.partitionBy(*keys).orderBy(*_as_columns(order))
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str = "first") -> DataFrame:
    """Deduplicate by key keeping the lowest (``keep="first"``) or highest order value.

    The reference keeps the lowest source id per entity (quirk Q2); ``keep="last"``
    is the opt-in alternative.
    """
    cols = _as_columns(order)
    if keep == "last":
        cols = [c.desc() for c in cols]
    elif keep != "first":
        raise ValueError("keep must be 'first' or 'last'")
    return top_per_key(df, keys, cols)


def first_per_key_late(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: str = "first",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of :func:`first_per_key`, without moving the columns that are neither key nor order.

    A first pass reads keys and order only: the best order value per key (a map-side combined aggregate), then the
    (key, order) pairs that another row of the key beats, staged once. The rows are what is left of ``df`` without
    those pairs, an anti join whose small side is broadcast when its staged copy measures at most
    ``broadcast_bytes``; above that both sides are hashed to the same task, and still not sorted. Where several rows
    tie for the first place (the first pass sees it), one of them is kept by :func:`top_per_key`.
    NULL keys form a group and NULL orders sort as in ``ORDER BY``.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    names = [*keys, *order]
    best, rank = "__strata_best", F.struct(*order)
    ids = df.select(*names)
    firsts = ids.groupBy(*keys).agg((F.min if keep == "first" else F.max)(rank).alias(best), F.count("*").alias(_RANK))
    several = firsts.where(F.col(_RANK) > 1).select(*[F.col(k).alias(f"{_RANK}{i}") for i, k in enumerate(keys)], best)
    of_key = [F.col(k).eqNullSafe(F.col(f"{_RANK}{i}")) for i, k in enumerate(keys)]
    path = fresh_path(df.sparkSession, "ranked")
    ranked = ids.join(several, of_key).select(*names, rank.eqNullSafe(F.col(best)).alias(_RANK))
    ranked = materialize(ranked.groupBy(*names, _RANK).agg(F.count("*").alias(best)), path)
    if not ranked.head(1):
        return df
    beaten = ranked.where(~F.col(_RANK)).select(*[F.col(c).alias(f"{_RANK}{i}") for i, c in enumerate(names)])
    beaten = F.broadcast(beaten) if stored_bytes(df.sparkSession, path) <= broadcast_bytes else beaten.hint("shuffle_hash")
    left = df.join(beaten, [F.col(c).eqNullSafe(F.col(f"{_RANK}{i}")) for i, c in enumerate(names)], "left_anti")
    if ranked.where(F.col(_RANK) & (F.col(best) > 1)).head(1):
        return first_per_key(left, keys, order, keep)
    return left


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Column,
    tie_break: Sequence[str | Column] = (),
) -> DataFrame:
    """Row with the highest ``order`` (NULLs last) per key.

    With fan-out several rows share the top value and the reference returns any
    of them (Q6); ``tie_break`` adds further descending columns to fix the choice.
    """
    first = F.col(order) if isinstance(order, str) else order
    extra = [c.desc_nulls_last() for c in _as_columns(tie_break)]
    return top_per_key(df, keys, [first.desc_nulls_last(), *extra])
