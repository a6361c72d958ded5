"""Benchmark decontamination by greedy string tiling (operator 1).

For every document the words of a benchmark item are tiled: the longest matches between the item's
and the document's still unmarked words are marked first, found with Karp-Rabin hashes of a search
length that shrinks down to ``MIN_MATCH`` words (running Karp-Rabin greedy string tiling). Tiles may
come in any order, so reordered passages are caught; a document is contaminated when the tiles cover
at least ``COVERAGE`` of an item's words.

Only (document, item) pairs that share a seed (``MIN_MATCH`` consecutive words, or a whole shorter
item) are tiled, and only on the document's words inside runs of such seeds: every tile is made of
them, so nothing is lost.

Scale: documents are read once, nothing is shuffled. The benchmark is the query set; it is split
into blocks of about ``BLOCK_CHARS`` characters by a hash, each collected and broadcast on its own, so one
broadcast has a fixed size; an executor holds all blocks, so its memory grows with the benchmark.

Words: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Defined cases: null
and wordless texts have no matches; an item without words matches nothing; an item of fewer than
``MIN_MATCH`` words matches where all of them stand in a row (an item of one word: wherever it stands); null or
repeated item ids are kept as they come; empty tables give no matches.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_CHARS = 4_000_000

#: Every byte that is not part of a word becomes a space; A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

MATCH = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("covered", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("tiles", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )
)
_BASE = 1_000_003
_MASK = (1 << 64) - 1


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``length`` tokens."""
    n = len(tokens) - length + 1
    out = np.zeros(max(0, n), np.uint64)
    for i in range(length if n > 0 else 0):
        out = out * np.uint64(_BASE) + tokens[i : i + n]
    return out


def tile(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, text start, length) of two token lists: the longest first, of equal ones that with
    the largest starts; 0 never matches."""
    free_item, free_text = bytearray(t != 0 for t in item), bytearray(t != 0 for t in text)
    tiles: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 32))
    while True:
        matches, longest = _scan(item, text, free_item, free_text, length)
        if longest > 2 * length:
            length = longest
            continue
        queue = [(-size, -p, -q) for size, p, q in matches]
        heapq.heapify(queue)
        while queue and 1 in free_item:
            size, p, q = (-x for x in heapq.heappop(queue))
            marked = [at for at in (free_item.find(0, p, p + size) - p, free_text.find(0, q, q + size) - q) if at >= 0]
            if not marked:
                free_item[p : p + size] = free_text[q : q + size] = bytes(size)
                tiles.append((p, q, size))
                continue
            # occluded: what is left on either side of the marked words may still be long enough
            whole = rest = min(marked)
            while rest < size and not (free_item[p + rest] and free_text[q + rest]):
                rest += 1
            for start, left in ((0, whole), (rest, size - rest)):
                if left >= length:
                    heapq.heappush(queue, (-left, -(p + start), -(q + start)))
        if length == least or 1 not in free_item:
            return tiles
        length = max(least, length // 2)


def _runs(free: bytearray) -> list[int]:
    """How many unmarked tokens follow from every place on."""
    out, run = [0] * len(free), 0
    for i in range(len(free) - 1, -1, -1):
        out[i] = run = run + 1 if free[i] else 0
    return out


def _common(item: list[int], p: int, text: list[int], q: int, limit: int) -> int:
    """Tokens that agree from ``p`` and ``q`` on, ``limit`` at most; compared in growing slices."""
    size, step = 0, 16
    while size < limit:
        take = min(step, limit - size)
        if item[p + size : p + size + take] != text[q + size : q + size + take]:
            low, high = size, size + take  # agree up to low, not up to high
            while high - low > 1:
                middle = (low + high) // 2
                same = item[p + low : p + middle] == text[q + low : q + middle]
                low, high = (middle, high) if same else (low, middle)
            return low
        size, step = size + take, 2 * step
    return size


def _scan(
    item: list[int], text: list[int], free_item: bytearray, free_text: bytearray, length: int
) -> tuple[list[tuple[int, int, int]], int]:
    """Maximal matches of at least ``length`` unmarked tokens, found by rolling hashes. Places of one hash are
    kept by the token before them (0: none or marked): equal tokens before make a part of a longer match, so
    repetitive texts cost their maximal matches, not all pairs of places."""
    top = pow(_BASE, length - 1, 1 << 64)

    def windows(tokens: list[int], free: bytearray) -> Iterator[tuple[int, int, int]]:
        run = value = 0
        for i, t in enumerate(tokens):
            if not free[i]:
                run = value = 0
                continue
            if run >= length:
                value = value - tokens[i - length] * top & _MASK
            value = value * _BASE + t & _MASK
            run += 1
            if run >= length:
                start = i - length + 1
                yield start, value, tokens[start - 1] if run > length else 0

    table: dict[int, dict[int, list[int]]] = {}
    for p, value, before in windows(item, free_item):
        table.setdefault(value, {}).setdefault(before, []).append(p)
    item_runs, text_runs = _runs(free_item), _runs(free_text)
    found, longest = [], 0
    for q, value, before in windows(text, free_text):
        for other, places in table.get(value, {}).items():
            if before == other != 0:
                continue
            for p in places:
                size = _common(item, p, text, q, min(item_runs[p], text_runs[q]))
                if size >= length:
                    found.append((size, p, q))
                    longest = max(longest, size)
    return found, longest


class _Block:
    """Vocabulary and seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int | None, list[int]]] = []
        for item_id, text in items:
            tokens = [
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of((text or "").encode())
            ]
            if tokens:
                self.items.append((item_id, tokens))
        seeds: dict[int, tuple[list[int], list[int]]] = {}
        for i, (_, tokens) in enumerate(self.items):
            length = min(MIN_MATCH, len(tokens))
            h = np.unique(_hashes(np.array(tokens, np.uint64), length)).tolist()
            at = seeds.setdefault(length, ([], []))
            at[0].extend(h)
            at[1].extend([i] * len(h))
        self.seeds = {}
        for length, (h, owner) in seeds.items():
            order = np.argsort(np.array(h, np.uint64), kind="stable")
            self.seeds[length] = (np.array(h, np.uint64)[order], np.array(owner)[order])

    def matches(self, text: bytes) -> list[dict]:
        words = words_of(text)
        tokens = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        out = []
        for length, (known, owner) in self.seeds.items():
            h = _hashes(tokens, length)
            lo = np.searchsorted(known, h)
            lo[lo == len(known)] = 0
            at = np.flatnonzero(known[lo] == h)
            if not len(at):
                continue
            lo, hi = lo[at], np.searchsorted(known, h[at], "right")
            places: dict[int, list[int]] = {}
            for q, s, e in zip(at.tolist(), lo.tolist(), hi.tolist()):
                for i in owner[s:e].tolist():
                    places.setdefault(i, []).append(q)
            for i, starts in places.items():
                item_id, item = self.items[i]
                part, origin, end = [], [], -1
                for q in starts:  # the document's words inside seeds, runs parted by a 0
                    if q > end:
                        part.append(0)
                        origin.append(-1)
                    first = max(q, end)
                    part.extend(tokens[first : q + length].tolist())
                    origin.extend(range(first, q + length))
                    end = q + length
                tiles = tile(item, part, length)
                if tiles:
                    out.append(
                        {
                            "item_id": item_id,
                            "covered": sum(t[2] for t in tiles),
                            "length": len(item),
                            "tiles": [[p, origin[q], size] for p, q, size in sorted(tiles)],
                        }
                    )
        return out


def _matcher(items) -> object:
    kind = pa.list_(
        pa.struct(
            [
                ("item_id", pa.int64()),
                ("covered", pa.int64()),
                ("length", pa.int64()),
                ("tiles", pa.list_(pa.list_(pa.int64()))),
            ]
        )
    )

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = _Block(items.value)
        for text in parts:
            yield pa.array([block.matches(t) for t in byte_values(text)], kind)

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, MATCH)


def matches(benchmark: DataFrame, text: Column) -> Column:
    """Column of the tiled matches of ``text`` with all items: item_id, covered and total words, tiles
    [item start, text start, length in words]."""
    spark = benchmark.sparkSession
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    parted = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        "text",
        F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"),
    )
    columns = []
    for b in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in parted.where(F.col("block") == b).collect()]  # a bounded block
        columns.append(_matcher(spark.sparkContext.broadcast(rows))(text))
    return columns[0] if blocks == 1 else F.concat(*columns)


def leaked(found: Column, coverage: float = COVERAGE) -> Column:
    """The matches that cover enough of their item."""
    return F.filter(found, lambda m: m["covered"] >= m["length"] * coverage)


def scan(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, contaminated, coverage (largest of any item), leaks (matches at or above ``coverage``)."""
    found = docs.select("doc_id", matches(benchmark, F.col("text")).alias("m"))
    share = F.transform("m", lambda m: m["covered"] / m["length"])
    return found.select(
        "doc_id",
        (F.size(leaked(F.col("m"), coverage)) > 0).alias("contaminated"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("coverage"),
        leaked(F.col("m"), coverage).alias("leaks"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` without a leaked item, columns unchanged."""
    found = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), matches(benchmark, docs["text"]).alias("m")
    )
    return found.where(F.size(leaked(F.col("m"), coverage)) == 0).select(
        *[F.col("row")[c].alias(c) for c in docs.columns]
    )
