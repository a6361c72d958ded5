"""Joins of histories onto a timeline.

Interval as-of join (J1): a base row at ordinal ``at`` matches every history row
of the same key with ``start <= at`` and (``end IS NULL`` or ``end > at``); it is
a LEFT join that keeps *every* match (overlaps fan out) and gives NULLs when
nothing matches. NULL starts never match.

Plan ("measured"): a plain equi-join on the key would test every (timeline row,
history row) pair of a key, which is quadratic for a heavy key and sends the
whole key to one task. So a pass over the base's keys and ordinals comes first
(:func:`measure`: a sample of a few rows per bin, staged once and used by all joins of a chain):

* if no key has more than about two bins of rows, the plain equi-join is the plan: no
  interval is replicated and nothing else is shuffled;
* otherwise the axis of every larger key is cut at sampled quantiles into bins of about
  ``bin_rows`` base rows, whatever the values are (entry numbers, dates, timestamps), so every bin
  is occupied, and an interval is replicated to the bins it covers only. The join is an
  equi-join on ``(key, bin)`` with the exact interval test as residual;
* a key that holds more than a share of ``1 / (SPLITS x shuffle partitions)`` of all rows is cut
  into ranges of that share first. Its bins are kept per range, so no edge list, window or group holds
  a hot key whole, and the number of ranges grows with the partitions. The ranges are few (at
  most ``2 x SPLITS x shuffle partitions`` in all), which is the bound of what is broadcast.

In a chain (J4) the bin is computed once, so the base keeps its
``hash(key, range, bin)`` partitioning from join to join: only the histories shuffle.

Start match (J2): every pair of rows that shares ``(key, start)`` is kept. Pairs are counted
first; for a ``(key, start)`` whose product exceeds ``PAIR_ROWS ** 2`` both sides are dealt over a
grid of cells (:func:`start_match_chain`), so no task makes a hot pair's k x k rows alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import count_at_most
from .layout import materialize

#: Base rows in a bin, about.
BIN_ROWS = 64
#: Sampled rows in a bin, and in a range of a hot key.
SAMPLES = 4
RANGE_SAMPLES = 16
#: Ranges that all rows would give per shuffle partition.
SPLITS = 4
#: A cell of a hot (key, start) pair gets about so many rows of either side.
PAIR_ROWS = 1024

_RANGE, _BIN = "__strata_range", "__strata_bin"
_EDGES, _AT = "__strata_edges", "__strata_at"
_BASE = "__strata_base"
_H = "__strata_h_"
_O = "__strata_o_"


@dataclass(frozen=True)
class AsOfSpec:
    """One history to attach: its columns, and the output prefix (``{prefix}_{col}``)."""

    history: DataFrame
    columns: tuple[str, ...]
    prefix: str | None = None

    def output_names(self) -> list[str]:
        return [f"{self.prefix}_{c}" if self.prefix else c for c in self.columns]


def _axis(c: Column, dtype: T.DataType) -> Column:
    """A long projection of the ordinal axis, used for binning only."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    raise TypeError(f"interval join needs an integer, date or timestamp axis, got {dtype}")


def _renamed_history(spec: AsOfSpec, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """History narrowed to key, bounds and payload; key and bounds get private names."""
    cols = [F.col(k).alias(f"{_H}k{i}") for i, k in enumerate(keys)]
    cols += [F.col(start).alias(f"{_H}start"), F.col(end).alias(f"{_H}end")]
    cols += [F.col(c).alias(n) for c, n in zip(spec.columns, spec.output_names())]
    return spec.history.select(*cols)


@dataclass(frozen=True)
class Split:
    """Measured edges: ``ranges`` (keys, edges) cuts hot keys, ``bins`` (keys, range, edges) cuts what is left."""

    ranges: DataFrame | None
    bins: DataFrame


def measure(base: DataFrame, keys: Sequence[str], at: str, bin_rows: int = BIN_ROWS) -> Split | None:
    """Quantile edges of the base's keys from a sample of ``SAMPLES`` rows a bin; None if every key fits in about
    two bins. The sample and the edges are staged, so that every use sees the same."""
    rate = min(1.0, SAMPLES / bin_rows)
    step = max(1, round(bin_rows * rate))
    names = [f"{_O}k{i}" for i in range(len(keys))]
    rows = base.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], _axis(F.col(at), base.schema[at].dataType).alias(_AT))
    rows = rows.dropna()
    sample = materialize(rows.where(F.rand(1) < rate) if rate < 1 else rows)
    sizes = sample.groupBy(*names).agg(F.count("*").alias("n"))
    total, most = sizes.agg(F.sum("n"), F.max("n")).first()
    if most is None or most <= 2 * step:
        return None
    share = max(2 * step, math.ceil(total / (SPLITS * int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    ranges = None
    if most > 2 * share:
        hot = sizes.where(F.col("n") > 2 * share).select(*names)  # fewer than SPLITS x partitions keys
        thin = min(1.0, RANGE_SAMPLES / share)
        few = sample.where(F.rand(2) < thin).join(F.broadcast(hot), names)
        place = F.row_number().over(Window.partitionBy(*names).orderBy(_AT))
        cuts = few.select(*names, _AT, place.alias("n")).where(F.col("n") % max(1, round(share * thin)) == 0)
        ranges = materialize(cuts.groupBy(*names).agg(F.array_sort(F.collect_set(_AT)).alias(_EDGES)))
    ranged = _with_ranges(sample, names, F.col(_AT), F.col(_AT), ranges, names)
    listed = ranged.groupBy(*names, _RANGE).agg(F.array_sort(F.collect_list(_AT)).alias("values"))
    places = F.sequence(F.lit(step), F.size("values") - 1, F.lit(step))
    edges = F.array_distinct(F.transform(places, lambda i: F.get("values", i)))
    cut = listed.where(F.size("values") > 2 * step).select(*names, _RANGE, edges.alias(_EDGES))
    return Split(ranges, materialize(cut))


def _with_ranges(df: DataFrame, keys, low: Column, high: Column, ranges: DataFrame | None, names) -> DataFrame:
    """``df`` with a row for each range of its key from that of ``low`` to that of ``high`` (NULL: the last)."""
    if ranges is None:
        return df.withColumn(_RANGE, F.lit(0))
    renamed = ranges.select(*[F.col(n).alias(f"{_EDGES}{i}") for i, n in enumerate(names)], _EDGES)
    on = [F.col(k) == F.col(f"{_EDGES}{i}") for i, k in enumerate(keys)]
    joined = df.join(F.broadcast(renamed), on, "left")  # bounded: see measure
    return joined.select(*df.columns, F.explode(_covered(low, high)).alias(_RANGE))


def _covered(low: Column, high: Column) -> Column:
    """Places of a sorted edge list from that of ``low`` to that of ``high``; one place, 0, without a list."""
    last = F.when(high.isNull(), F.size(_EDGES)).otherwise(count_at_most(F.col(_EDGES), high))
    return F.sequence(count_at_most(F.col(_EDGES), low), F.greatest(F.coalesce(last, F.lit(0)), F.lit(0)))


def _placed(df: DataFrame, keys, low: Column, high: Column, split: Split) -> DataFrame:
    """``df`` with a row for every (range, bin) that ``low`` to ``high`` covers."""
    names = [f"{_O}k{i}" for i in range(len(keys))]
    ranged = _with_ranges(df, keys, low, high, split.ranges, names)
    bins = split.bins.withColumnRenamed(_RANGE, f"{_O}range")
    on = [F.col(k) == F.col(n) for k, n in zip(keys, names)] + [F.col(_RANGE) == F.col(f"{_O}range")]
    return ranged.join(bins, on, "left").select(*df.columns, _RANGE, F.explode(_covered(low, high)).alias(_BIN))


def binned_history(spec: AsOfSpec, keys, start: str, end: str, at_type: T.DataType, split: Split) -> DataFrame:
    """Each interval replicated into the bins it covers, key, bounds and place under private names."""
    h = _renamed_history(spec, keys, start, end).where(F.col(f"{_H}start").isNotNull())
    h = h.where(F.col(f"{_H}end").isNull() | (F.col(f"{_H}start") < F.col(f"{_H}end")))
    low = _axis(F.col(f"{_H}start"), at_type)
    high = _axis(F.col(f"{_H}end"), at_type) - 1  # end is exclusive
    placed = _placed(h, [f"{_H}k{i}" for i in range(len(keys))], low, high, split)
    return placed.withColumnsRenamed({_RANGE: f"{_H}range", _BIN: f"{_H}bin"})


def interval_chain(
    base: DataFrame,
    specs: Sequence[AsOfSpec],
    keys: Sequence[str] = ("company_krs",),
    at: str = "entry_number",
    start: str = "valid_from_entry",
    end: str = "valid_to_entry",
    bin_rows: int = BIN_ROWS,
    method: str = "measured",
    hashed: bool = False,
) -> DataFrame:
    """Left-deep chain of interval as-of joins (J4): base columns, then each spec's columns.

    Rows per base row = product over specs of max(1, matches), as in the reference.
    ``method="measured"`` reads the base's keys and ordinals once beforehand (see the module);
    ``method="key"`` is the reference's plan (equi-join on the key + range residual) without that pass.
    With ``hashed`` the plain key joins build hash tables of the histories instead of sorting both sides: for
    histories whose share of a shuffle partition is known to fit in memory (a hash table does not spill).
    """
    keys = list(keys)
    at_type = base.schema[at].dataType
    _axis(F.col(at), at_type)  # raises on other types
    if method not in ("measured", "key"):
        raise ValueError("method must be 'measured' or 'key'")
    if bin_rows < 1:
        raise ValueError("bin_rows must be positive")
    split = measure(base, keys, at, bin_rows) if method == "measured" else None
    if split is None:
        return _key_chain(base, specs, keys, at, start, end, hashed)

    here = F.coalesce(_axis(F.col(at), at_type), F.lit(0))  # a NULL ordinal matches nothing, in any bin
    out = _placed(base, keys, here, here, split)
    for spec in specs:
        h = binned_history(spec, keys, start, end, at_type, split)
        cond = [out[k] == h[f"{_H}k{i}"] for i, k in enumerate(keys)]
        cond += [
            out[_RANGE] == h[f"{_H}range"],
            out[_BIN] == h[f"{_H}bin"],
            h[f"{_H}start"] <= out[at],
            h[f"{_H}end"].isNull() | (h[f"{_H}end"] > out[at]),
        ]
        joined = out.join(h, on=cond, how="left")
        out = joined.select(*out.columns, *spec.output_names())
    return out.drop(_RANGE, _BIN)


def _key_chain(base: DataFrame, specs: Sequence[AsOfSpec], keys, at, start, end, hashed: bool) -> DataFrame:
    """The chain of equi-joins on the key. Every join writes its rows anew, column by column, so the columns of
    the base and of each history travel packed in one struct and are named at the end."""
    moved = [c for c in base.columns if c not in (*keys, at)]
    out = base.select(*keys, at, *([F.struct(*moved).alias(_BASE)] if moved else []))
    named = [F.col(f"{_BASE}.`{c}`").alias(c) if c in moved else F.col(c) for c in base.columns]
    for i, spec in enumerate(specs):
        names, packed = spec.output_names(), f"{_H}packed{i}"
        h = _renamed_history(spec, keys, start, end)
        h = h.select(*h.columns[: len(keys) + 2], F.struct(*names).alias(packed))
        cond = [out[k] == h[f"{_H}k{j}"] for j, k in enumerate(keys)]
        cond += [h[f"{_H}start"] <= out[at], h[f"{_H}end"].isNull() | (h[f"{_H}end"] > out[at])]
        out = out.join(h.hint("shuffle_hash") if hashed else h, on=cond, how="left").select(*out.columns, packed)
        named += [F.col(f"{packed}.`{n}`").alias(n) for n in names]
    return out.select(*named)


def interval_join(
    base: DataFrame,
    history: DataFrame,
    columns: Sequence[str],
    prefix: str | None = None,
    keys: Sequence[str] = ("company_krs",),
    at: str = "entry_number",
    start: str = "valid_from_entry",
    end: str = "valid_to_entry",
    bin_rows: int = BIN_ROWS,
    method: str = "measured",
) -> DataFrame:
    """Interval as-of LEFT join of one history onto ``base``."""
    spec = AsOfSpec(history, tuple(columns), prefix)
    return interval_chain(base, [spec], keys, at, start, end, bin_rows, method)


def start_match_join(
    base: DataFrame,
    other: DataFrame,
    columns: Sequence[str],
    prefix: str | None = None,
    keys: Sequence[str] = ("company_krs",),
    start: str = "valid_from_entry",
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """LEFT join on ``(keys, start)`` equality (J2); the other side's bounds are dropped.

    Every pair that shares ``(key, start)`` is kept: k rows on each side give k x k
    (quirk Q7, reference behaviour). The join shuffles on the pair, not the key; hot pairs are dealt over cells.
    """
    return start_match_chain(base, [AsOfSpec(other, tuple(columns), prefix)], keys, start, pair_rows)


def _cells(rows: Column, others: Column, pair_rows: int) -> Column:
    """In how many parts a side with ``rows`` rows is dealt when the other has ``others``: one unless hot."""
    hot = rows.cast("double") * others > float(pair_rows) ** 2
    return F.when(hot, F.ceil(rows / F.lit(pair_rows))).otherwise(1).cast("int")


def hot_pairs(base: DataFrame, specs: Sequence[AsOfSpec], on: Sequence[str], pair_rows: int) -> DataFrame | None:
    """``on`` with ``__strata_l{i}`` and ``__strata_r{i}``, the parts of either side at step ``i``, for the pairs that
    are hot at some step; None if there are none. Counts only: the joins themselves are not run for it."""
    tables = [base, *[spec.history for spec in specs]]
    ones = [F.sum(F.when(F.col("__strata_of") == i, 1).otherwise(0)).alias(f"__strata_n{i}") for i in range(len(tables))]
    keyed = [df.select(*on, F.lit(i).alias("__strata_of")) for i, df in enumerate(tables)]
    counts = reduce(DataFrame.unionByName, keyed).dropna(subset=list(on)).groupBy(*on).agg(*ones)  # one shuffle of counts
    left, parts = F.col("__strata_n0"), []
    for i in range(len(specs)):
        right = F.col(f"__strata_n{i + 1}")
        parts += [_cells(left, right, pair_rows).alias(f"__strata_l{i}"), _cells(right, left, pair_rows).alias(f"__strata_r{i}")]
        left = left * F.greatest(right, F.lit(1))
    table = counts.select(*on, *parts)
    split = [F.col(c) > 1 for c in table.columns[len(on) :]]
    staged = materialize(table.where(reduce(or_, split)))
    return staged if staged.head(1) else None


def _dealt(df: DataFrame, on, hot: DataFrame, own: str, others: str) -> DataFrame:
    """``df`` with ``__strata_own`` (the part its row is dealt to) and ``__strata_cell``: a row per part of the other
    side. The part comes from the row's values and its partition, so a task that runs again deals alike, and
    equal rows spread."""
    sized = df.join(hot.select(*on, F.col(own).alias("__strata_own"), F.col(others).alias("__strata_others")), on, "left")
    part = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.coalesce("__strata_own", F.lit(1)))
    across = F.sequence(F.lit(0), F.coalesce("__strata_others", F.lit(1)) - 1)
    hit = (F.coalesce(F.col("__strata_own") * F.col("__strata_others"), F.lit(1)) > 1).alias("__strata_hot")
    return sized.select(*df.columns, part.cast("int").alias("__strata_part"), F.explode(across).alias("__strata_cell"), hit)


def start_match_chain(
    base: DataFrame,
    specs: Sequence[AsOfSpec],
    keys: Sequence[str] = ("company_krs",),
    start: str = "valid_from_entry",
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """Fold of LEFT joins on ``(keys, start)`` (J5): base columns, then each spec's columns.

    Rows per pair are counted first (per table, map-side combined; the chain's own counts are products, so
    no join runs for it). Without hot pairs the plan is the plain fold. A hot pair's ``l`` base and ``r`` other rows
    are dealt over ``ceil(l / pair_rows) x ceil(r / pair_rows)`` cells: a side is sent once for each part of the other,
    which is less than ``1 / pair_rows`` of the pair's result. A cell without partners is dropped there, as a pair
    is only hot when both sides have rows.
    """
    on = [*keys, start]
    hot = hot_pairs(base, specs, on, pair_rows)
    out = base
    for i, spec in enumerate(specs):
        names = spec.output_names()
        right = spec.history.select(*on, *[F.col(c).alias(n) for c, n in zip(spec.columns, names)])
        if hot is None:
            out = out.join(right, on, "left").select(*out.columns, *names)
            continue
        left = _dealt(out, on, hot, f"__strata_l{i}", f"__strata_r{i}")
        right = _dealt(right, on, hot, f"__strata_r{i}", f"__strata_l{i}").select(
            *on, *names, F.col("__strata_part").alias("__strata_cell"), F.col("__strata_cell").alias("__strata_part"),
            F.lit(True).alias("__strata_met"),
        )
        joined = left.join(right, [*on, "__strata_part", "__strata_cell"], "left")
        out = joined.where(F.col("__strata_met").isNotNull() | ~F.col("__strata_hot")).select(*out.columns, *names)
    return out
