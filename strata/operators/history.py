"""Validity-interval histories: explode from documents (G1-G4, H5), orphan repair (H1), distinct starts (A1).

A history row carries attributes plus a half-open interval ``[start, end)`` of
integer ordinals; a NULL end means "still valid".
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import count_at_most
from ..functions.documents import parse_date, parse_int, typed_null

_ELEM = "__strata_elem"
_POS = "__strata_pos"
_SUCC = "__strata_has_successor"


@dataclass(frozen=True)
class Field:
    """One output column read from an exploded element.

    ``kind``: ``"raw"`` keeps the parsed type, ``"int"`` parses text to int,
    ``"date"`` parses text with ``fmt``.
    """

    name: str
    path: str
    kind: str = "raw"
    fmt: str = "dd.MM.yyyy"

    def column(self, element: str, on_error: str) -> Column:
        c = F.col(f"{element}.{self.path}")
        if self.kind == "int":
            c = parse_int(c, on_error)
        elif self.kind == "date":
            c = parse_date(c, self.fmt, on_error)
        elif self.kind != "raw":
            raise ValueError(f"unknown field kind {self.kind!r}")
        return c.alias(self.name)


@dataclass(frozen=True)
class HistorySpec:
    """How to turn one nested array of a document into a table.

    ``path``: one dotted path per explode level - the first relative to the
    document column, each further one relative to the previous element
    (two levels = nested explode, G2/G4). ``outer`` keeps documents with a
    missing or empty array as one all-NULL row (G3/G4). ``start``/``end`` name
    the element fields holding the interval bounds; ``start=None`` makes a
    plain table (the timeline), ``end=None`` a typed-NULL end.
    """

    name: str
    path: tuple[str, ...]
    fields: tuple[Field, ...]
    outer: bool = False
    start: str | None = None
    end: str | None = None
    start_col: str = "valid_from_entry"
    end_col: str = "valid_to_entry"

    @property
    def is_history(self) -> bool:
        return self.start is not None

    @property
    def payload(self) -> list[str]:
        return [f.name for f in self.fields]


def _explode_step(df: DataFrame, carried: list[Column], array: Column, outer: bool) -> DataFrame:
    """One explode level.

    A plain ``explode`` over a path inside ``from_json`` makes Catalyst infer a
    ``size(from_json(...)) > 0`` filter, which parses every document a second time.
    ``posexplode_outer`` + "position is not NULL" keeps exactly ``explode``'s rows
    (empty/NULL arrays give none, NULL elements are kept) with one parse.
    """
    if outer:
        return df.select(*carried, F.explode_outer(array).alias(_ELEM))
    out = df.select(*carried, F.posexplode_outer(array).alias(_POS, _ELEM))
    return out.where(F.col(_POS).isNotNull()).drop(_POS)


def _is_start(starts: Column, end: Column) -> Column:
    """Whether the sorted array ``starts`` holds ``end``: a document with a long history costs n log n and
    not n squared. NULL (sorted last) is never found."""
    return F.get(starts, count_at_most(starts, end) - 1) == end


def _with_repaired_ends(array: Column, spec: HistorySpec, on_error: str) -> Column:
    """Each element with its end, NULL where no element of the same array starts there (H1 in one document).
    The one-element ``transform`` binds the sorted starts once per document; an empty array, which explodes like a
    missing one, is not looked at."""

    def bound(element: Column, field: str) -> Column:
        return parse_int(element[field], on_error)

    def repaired(starts: Column) -> Column:
        return F.transform(array, lambda x: F.struct(
            x.alias("element"), F.when(_is_start(starts, bound(x, spec.end)), bound(x, spec.end)).alias("end")
        ))

    starts = F.array_sort(F.transform(array, lambda x: bound(x, spec.start)))
    return F.when(F.size(array) > 0, F.transform(F.array(starts), repaired)[0])


def explode_history(
    df: DataFrame,
    spec: HistorySpec,
    carry: Sequence[str] = ("source_id", "company_krs"),
    document: str = "data",
    on_error: str = "fail",
    repair_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Explode ``spec.path`` of the parsed ``document`` into rows (narrow, no shuffle).

    ``repair_keys`` also repairs orphaned ends, as :func:`reopen_orphans` with these keys does, but without
    its join: for tables that hold *one document per key* (as after a dedup by key), where an interval's
    successor can only stand in the same array. One-level histories with an end only.
    """
    carried = [F.col(c) for c in carry]
    array = F.col(f"{document}.{spec.path[0]}")
    if repair_keys is not None:
        if len(spec.path) > 1 or not spec.start or not spec.end:
            raise ValueError(f"history {spec.name!r} cannot be repaired inside its documents")
        out = _explode_step(df, carried, _with_repaired_ends(array, spec, on_error), spec.outer)
        element = f"{_ELEM}.element"
        keyed = reduce(and_, [F.col(k).isNotNull() for k in repair_keys])
        return out.select(
            *carried,
            *(f.column(element, on_error) for f in spec.fields),
            parse_int(F.col(f"{element}.{spec.start}"), on_error).alias(spec.start_col),
            F.when(keyed, F.col(f"{_ELEM}.end")).alias(spec.end_col),
        )
    out = _explode_step(df, carried, array, spec.outer)
    for step in spec.path[1:]:
        out = _explode_step(out, carried, F.col(f"{_ELEM}.{step}"), spec.outer)
    cols = [*carried, *(f.column(_ELEM, on_error) for f in spec.fields)]
    if spec.is_history:
        cols.append(parse_int(F.col(f"{_ELEM}.{spec.start}"), on_error).alias(spec.start_col))
        end = parse_int(F.col(f"{_ELEM}.{spec.end}"), on_error) if spec.end else typed_null("int")
        cols.append(end.alias(spec.end_col))
    return out.select(*cols)


def distinct_starts(df: DataFrame, keys: Sequence[str], start: str = "valid_from_entry") -> DataFrame:
    """Distinct ``(keys, start)`` pairs (A1): a hash aggregate with map-side partial combine."""
    return df.select(*keys, start).dropDuplicates()


def reopen_orphans(
    df: DataFrame,
    keys: Sequence[str] = ("company_krs",),
    start: str = "valid_from_entry",
    end: str = "valid_to_entry",
) -> DataFrame:
    """Set ``end := NULL`` where no row of the same key starts at exactly ``end`` (H1).

    Row count, column order and the end column's type are preserved. Rows whose
    interval has a successor keep their end; open rows stay open. Like the
    reference this also reopens genuine deletions (Q5).

    Plan: the distinct ``(key, start)`` set is a partial+final hash aggregate, and
    the existence test is an equi-join on ``(key, end) = (key, start)``. Both
    shuffle on the *pair*, so one heavy key spreads over all its distinct entry
    numbers; open rows, which have no end to look up, take part under their own
    start and can't match, so they spread as well. Nothing is collected per key.
    """
    keys = list(keys)
    end_type = df.schema[end].dataType
    successors = (
        df.select(*[F.col(k).alias(f"{_SUCC}{i}") for i, k in enumerate(keys)], F.col(start).alias(f"{_SUCC}at"))
        .where(F.col(f"{_SUCC}at").isNotNull())
        .dropDuplicates()
        .select("*", F.lit(False).alias(f"{_SUCC}open"), F.lit(True).alias(_SUCC))
    )
    same = [F.col(k) == F.col(f"{_SUCC}{i}") for i, k in enumerate(keys)]
    same += [F.coalesce(F.col(end), F.col(start)) == F.col(f"{_SUCC}at"), F.col(end).isNull() == F.col(f"{_SUCC}open")]
    joined = df.join(successors, on=same, how="left")
    fixed = F.when(F.col(_SUCC), F.col(end)).otherwise(typed_null(end_type)).alias(end)
    return joined.select(*[fixed if c == end else F.col(c) for c in df.columns])
