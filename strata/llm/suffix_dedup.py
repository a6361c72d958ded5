"""Removal of repeated byte strings with deep-shallow suffix sorting (operator 7).

A byte goes when a ``LENGTH``-byte string that covers it also starts in a document with a smaller id.
Strings are judged on the input and never cross documents.

Not every suffix has to be sorted. Of each ``LENGTH``-byte string one ``GRAM``-byte piece is chosen by its
content alone (the one with the smallest hash), so equal strings choose the same piece: an anchor.
About one suffix in 13 starts at an anchor.

1. Documents are packed into chunks of about ``CHUNK`` bytes, a stored table with fixed chunk ids.
2. Every chunk sends short hashes of its anchors; those of one document only drop out.
3. Every chunk sends its different contexts of the other anchors (the bytes any string over the anchor
   can have), each with its smallest document id. A bucket's contexts are sorted as suffixes at
   their anchors: a multikey quicksort over eight-byte symbols orders them to ``SHALLOW`` bytes, and the
   groups left, equal so far, are ordered by blind tries. Contexts of one anchor are then neighbours:
   where all agree the anchor's strings have one smallest document; else it is found for each string.
4. Every chunk marks the strings whose smallest document is below the document they stand in.

Contexts are compared byte by byte, so hashes only ever let too much through to step 3.

Scale: texts are shuffled once, compressed; a chunk sends a context once however many documents repeat
it, so a passage in every document costs a row per chunk; buckets grow in number with the input
(``BUCKET`` bytes of text each). Chunks and buckets are the only things held in memory.

Defined cases: null text has no bytes; a null id is above all ids, and no smaller than another null;
rows that share an id never remove each other's bytes; a document is one row, however long; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_values, groups, materialize

LENGTH, GRAM = 50, 24
REACH = LENGTH - GRAM  # a string starts at most so far before its anchor
CONTEXT = REACH + LENGTH
CHUNK, BUCKET = 2 << 20, 64 << 20
SHALLOW = 32
GAP = 255  # never a byte of UTF-8
NO_ID = np.iinfo(np.int64).max
_LOW = np.uint64((1 << 40) - 1)


# ---------------------------------------------------------------- sorting


class _Trie:
    """Blind trie: inner nodes know the byte position they branch at, leaves a string's members."""

    __slots__ = ("at", "children", "key", "members")

    def __init__(self, key: bytes, member: int | None = None, at: int = -1):
        self.at, self.key = at, key
        self.children: dict[int, _Trie] = {}
        self.members = [] if member is None else [member]

    def insert(self, key: bytes, member: int) -> _Trie:
        """Adds a string; the (new) root."""
        node = self
        while node.at >= 0:  # blind: only the branching bytes are looked at
            node = node.children.get(key[node.at]) or next(iter(node.children.values()))
        if node.key == key:
            node.members.append(member)
            return self
        split = next(i for i, (a, b) in enumerate(zip(node.key, key)) if a != b)
        up, node = None, self
        while 0 <= node.at < split:
            up, node = node, node.children[key[node.at]]
        if node.at == split:
            node.children[key[split]] = _Trie(key, member)
            return self
        branch = _Trie(node.key, at=split)
        branch.children = {node.key[split]: node, key[split]: _Trie(key, member)}
        if up is None:
            return branch
        up.children[key[up.at]] = branch
        return self

    def leaves(self) -> Iterator[_Trie]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.at < 0:
                yield node
            else:
                stack += [c for _, c in sorted(node.children.items(), reverse=True)]


def shallow_groups(symbols: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of ``symbols`` in lexicographic order, in groups of equal rows: multikey quicksort."""
    width = symbols.shape[1]
    stack = [(np.arange(len(symbols)), 0)] if len(symbols) else []
    while stack:
        rows, depth = stack.pop()
        if len(rows) == 1 or depth == width:
            yield rows
        elif len(rows) <= 16:
            keyed = sorted((symbols[r, depth:].tolist(), r) for r in rows.tolist())
            start = 0
            for i in range(1, len(keyed) + 1):
                if i == len(keyed) or keyed[i][0] != keyed[start][0]:
                    yield np.array([r for _, r in keyed[start:i]])
                    start = i
        else:
            column = symbols[rows, depth]
            pivot = np.partition(column[:: max(1, len(column) // 9)][:9], 4)[4]
            below, above = column < pivot, column > pivot
            for part, d in ((rows[above], depth), (rows[~below & ~above], depth + 1), (rows[below], depth)):
                if len(part):
                    stack.append((part, d))


def deep_shallow(strings: np.ndarray, shallow: int = SHALLOW) -> Iterator[tuple[bytes, list[int]]]:
    """The different rows of a byte matrix in lexicographic order, each with its row numbers."""
    symbols = np.ascontiguousarray(strings[:, :shallow]).view(">u8").astype(np.uint64)
    width = strings.shape[1]
    flat = np.ascontiguousarray(strings).tobytes()
    for rows in shallow_groups(symbols):
        members = rows.tolist()
        first = members[0]
        root = _Trie(flat[first * width : (first + 1) * width], first)
        for r in members[1:]:
            root = root.insert(flat[r * width : (r + 1) * width], r)
        for leaf in root.leaves():
            yield leaf.key, leaf.members


# ---------------------------------------------------------------- anchors of a chunk


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a byte array whose documents are parted by ``GAP``."""
    n = len(data) - GRAM + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    window = LENGTH - GRAM + 1
    positions, hashes = [], []
    step = 1 << 20
    for at in range(0, n, step):
        lo, hi = max(0, at - 2 * window), min(n, at + step + 2 * window)
        part = data[lo : hi + GRAM - 1]
        size = hi - lo
        words = np.ndarray((len(part) - 7,), "<u8", part.tobytes(), 0, (1,))
        h = words[:size] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += words[8 : 8 + size]
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h += words[16 : 16 + size]
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        gaps = np.concatenate([[0], np.cumsum(part == GAP)])
        broken = gaps[GRAM : GRAM + size] != gaps[:size]
        h[broken] = ~np.uint64(0)
        padded = np.concatenate([np.full(window - 1, ~np.uint64(0)), h, np.full(window - 1, ~np.uint64(0))])
        least = _slide(padded, window, np.minimum)
        chosen = np.flatnonzero((_slide(least, window, np.maximum) == h) & ~broken)
        chosen = chosen[(chosen + lo >= at) & (chosen + lo < at + step)]
        positions.append(chosen + lo)
        hashes.append(h[chosen])
    return np.concatenate(positions), np.concatenate(hashes)


class _Chunk:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.absent = np.frombuffer(row["absent"], np.uint8)
        sizes = np.frombuffer(row["sizes"], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        raw = pa.decompress(row["data"], decompressed_size=int(sizes.sum() + len(sizes)), codec="zstd")
        self.data = np.frombuffer(raw, np.uint8)

    def bucketed(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor positions, their buckets, and their hashes within the bucket (40 bits)."""
        at, h = anchors(self.data)
        return at, ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), h & _LOW

    def documents(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """A row per anchor: LENGTH bytes from the anchor on, then the REACH bytes before it, nearest first;
        what lies beyond the document is ``GAP``."""
        wide = np.concatenate([np.full(REACH, GAP, np.uint8), self.data, np.full(LENGTH, GAP, np.uint8)])
        after = wide[(at + REACH)[:, None] + np.arange(LENGTH)]
        before = wide[(at + REACH)[:, None] - np.arange(1, REACH + 1)]
        for part in (after, before):
            part[np.logical_or.accumulate(part == GAP, axis=1)] = GAP
        return np.hstack([after, before])

    def shared(self, row: dict, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per bucket with shared anchors: bucket, different contexts, positions, each position's context."""
        at, bucket, h = self.bucketed(buckets)
        key = (bucket.astype(np.uint64) << np.uint64(40)) | h
        known = [
            (np.uint64(p) << np.uint64(40)) | _unpack(b) for p, b in zip(row["shared_buckets"] or (), row["shared"] or ())
        ]
        if not known:
            return
        known = np.sort(np.concatenate(known))
        place = np.searchsorted(known, key)
        place[place == len(known)] = 0
        hit = known[place] == key
        at, bucket = at[hit], bucket[hit]
        order = np.argsort(bucket, kind="stable")
        at, bucket = at[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        for s, e in zip(cuts[:-1], cuts[1:]):
            rows = np.ascontiguousarray(self.contexts(at[s:e]))
            different, which = np.unique(rows.view(f"V{CONTEXT}").ravel(), return_inverse=True)
            yield int(bucket[s]), different.view(np.uint8).reshape(-1, CONTEXT), at[s:e], which.ravel()


def _pack(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes() + (values >> np.uint64(32)).astype(np.uint8).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    n = len(blob) // 5
    low, high = np.frombuffer(blob, "<u4", n), np.frombuffer(blob, np.uint8, n, 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("bytes", pa.int64()), ("ids", pa.binary()), ("absent", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())]
)
_BLOBS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary())])
_BLOB_COLUMNS = "chunk long, bucket long, blob binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    serial = TaskContext.get().partitionId() << 32
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0

    def close() -> pa.RecordBatch:
        joined = b"".join(t + b"\xff" for t in texts)
        number = np.array([NO_ID if i is None else i for i in ids], np.int64)
        absent = np.array([i is None for i in ids], np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        packed = pa.compress(joined, codec="zstd", asbytes=True)
        return _rows(
            _CHUNKS, [(serial, int(sizes.sum()), number.tobytes(), absent.tobytes(), sizes.tobytes(), packed)]
        )

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
            ids.append(doc_id)
            texts.append(text)
            held += len(text) + 1
            if held >= CHUNK:
                yield close()
                ids, texts, held, serial = [], [], 0, serial + 1
    if ids:
        yield close()


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                at, bucket, h = chunk.bucketed(buckets)
                doc = chunk.documents(at)
                order = np.lexsort((doc, h, bucket))
                bucket, h, doc = bucket[order], h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (bucket[1:] != bucket[:-1]) | (h[1:] != h[:-1])
                # an anchor of several documents is sent twice: that alone makes it shared
                again = ~new & np.concatenate([[False], doc[1:] != doc[:-1]])
                keep = new | _first_again(new, again)
                bucket, h = bucket[keep], h[keep]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
                rows = [(row["chunk"], int(bucket[s]), _pack(h[s:e])) for s, e in zip(cuts[:-1], cuts[1:])]
                yield _rows(_BLOBS, rows)

    return run


def _first_again(new: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Of each run begun by ``new``, the first place where ``again`` holds."""
    count = np.cumsum(again)
    base = np.maximum.accumulate(np.where(new, count, 0))
    return again & (count - base == 1)


def _find_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in groups(batches, "bucket"):
        sent = [_unpack(r["blob"]) for r in rows]
        every = np.sort(np.concatenate(sent))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        out = []
        for r, own in zip(rows, sent):
            own = np.unique(own)
            place = np.searchsorted(shared, own)
            place[place == len(shared)] = 0
            own = own[shared[place] == own] if len(shared) else own[:0]
            if len(own):
                out.append((r["chunk"], bucket, _pack(own)))
        yield _rows(_BLOBS, out)


def _send_contexts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                out = []
                for bucket, different, at, which in chunk.shared(row, buckets):
                    owner = chunk.ids[chunk.documents(at)]
                    low, high = np.full(len(different), NO_ID), np.full(len(different), np.iinfo(np.int64).min)
                    np.minimum.at(low, which, owner)
                    np.maximum.at(high, which, owner)
                    raw = different.tobytes() + low.tobytes() + (high > low).astype(np.uint8).tobytes()
                    out.append((row["chunk"], bucket, pa.compress(raw, codec="zstd", asbytes=True), len(different)))
                yield _rows(_BLOBS.append(pa.field("n", pa.int64())), out)

    return run


def _least_documents(strings: list[bytes], least: list[int]) -> list[list[tuple[int, int, int]]]:
    """For the different contexts of one anchor: runs (from, to, smallest document) over how many bytes
    before the anchor a string starts."""
    whole = []
    for s in strings:
        after = s.find(GAP, 0, LENGTH)
        before = s.find(GAP, LENGTH)
        whole.append((LENGTH if after < 0 else after, REACH if before < 0 else before - LENGTH))
    if len(strings) == 1:
        after, before = whole[0]
        low = max(0, LENGTH - after)
        return [[(low, before, least[0])] if before >= low else []]
    found: list[list[tuple[int, int, int]]] = [[] for _ in strings]
    for o in range(REACH + 1):
        smallest: dict[tuple[bytes, bytes], int] = {}
        keys = []
        for s, (after, before), d in zip(strings, whole, least):
            if o > before or LENGTH - o > after:
                keys.append(None)
                continue
            key = (s[: LENGTH - o], s[LENGTH : LENGTH + o])
            keys.append(key)
            if d < smallest.get(key, NO_ID + 1):
                smallest[key] = d
        for runs, key in zip(found, keys):
            if key is None:
                continue
            d = smallest[key]
            if runs and runs[-1][1] == o - 1 and runs[-1][2] == d:
                runs[-1] = (runs[-1][0], o, d)
            else:
                runs.append((o, o, d))
    return found


_RUN = np.dtype([("entry", "<u4"), ("low", "u1"), ("high", "u1"), ("doc", "<i8")])


def _sort_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in groups(batches, "bucket"):
        matrices, lows, many, sender, entry = [], [], [], [], []
        for k, r in enumerate(rows):
            n = r["n"]
            raw = pa.decompress(r["blob"], decompressed_size=n * (CONTEXT + 9), codec="zstd", asbytes=True)
            matrices.append(np.frombuffer(raw, np.uint8, n * CONTEXT).reshape(n, CONTEXT))
            lows.append(np.frombuffer(raw, np.int64, n, n * CONTEXT))
            many.append(np.frombuffer(raw, np.uint8, n, n * (CONTEXT + 8)))
            sender.append(np.full(n, k))
            entry.append(np.arange(n))
        strings, low = np.concatenate(matrices), np.concatenate(lows).tolist()
        several, sender = np.concatenate(many).tolist(), np.concatenate(sender).tolist()
        entry = np.concatenate(entry).tolist()
        replies: list[list[tuple]] = [[] for _ in rows]

        def settle(keys: list[bytes], members: list[list[int]]) -> None:
            if len(keys) == 1 and len(members[0]) == 1 and not several[members[0][0]]:
                return
            for runs, own in zip(_least_documents(keys, [min(low[i] for i in m) for m in members]), members):
                for i in own:
                    for a, b, d in runs:
                        if d < low[i] or several[i]:
                            replies[sender[i]].append((entry[i], a, b, d))

        keys: list[bytes] = []
        members: list[list[int]] = []
        for key, own in deep_shallow(strings):
            if keys and key[:GRAM] != keys[0][:GRAM]:
                settle(keys, members)
                keys, members = [], []
            keys.append(key)
            members.append(own)
        if keys:
            settle(keys, members)
        out = [(r["chunk"], bucket, np.array(x, _RUN).tobytes()) for r, x in zip(rows, replies) if x]
        yield _rows(_BLOBS, out)


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())]
)


def _remove(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                edges = np.zeros(len(chunk.data) + 1, np.int32)
                replies = dict(zip(row["run_buckets"] or (), row["runs"] or ()))
                for bucket, _, at, which in chunk.shared(row, buckets) if replies else ():
                    if bucket not in replies:
                        continue
                    runs = np.sort(np.frombuffer(replies[bucket], _RUN), order="entry", kind="stable")
                    first, last = (np.searchsorted(runs["entry"], which, side) for side in ("left", "right"))
                    times = last - first
                    own = np.repeat(np.arange(len(at)), times)
                    nth = np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times)
                    r = runs[np.repeat(first, times) + nth]
                    covered = r["doc"] < chunk.ids[chunk.documents(at[own])]
                    p, r = at[own][covered], r[covered]
                    np.add.at(edges, p - r["high"], 1)
                    np.add.at(edges, p - r["low"] + LENGTH, -1)
                gone = (np.cumsum(edges[:-1]) > 0).astype(np.int8)
                turns = np.diff(gone, prepend=0, append=0)
                starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
                of = chunk.documents(starts)
                bounds = np.searchsorted(of, np.arange(len(chunk.ids) + 1))
                raw, out, held = chunk.data.tobytes(), [], 0
                for d, (s, e) in enumerate(zip(chunk.starts.tolist(), chunk.ends.tolist())):
                    a, b = starts[bounds[d] : bounds[d + 1]].tolist(), ends[bounds[d] : bounds[d + 1]].tolist()
                    kept = b"".join(raw[x:y] for x, y in zip([s, *b], [*a, e]))
                    doc_id = None if chunk.absent[d] else int(chunk.ids[d])
                    out.append((doc_id, e - s, [x - s for x in a], [x - s for x in b], kept))
                    held += len(kept)
                    if held > 8 << 20:
                        yield _rows(_RESULT, out)
                        out, held = [], 0
                yield _rows(_RESULT, out)

    return run


def _by_chunk(blobs: DataFrame, key: str, buckets: str, values: str) -> DataFrame:
    pairs = blobs.groupBy(F.col("chunk").alias(key)).agg(F.collect_list(F.struct("bucket", "blob")).alias("p"))
    return pairs.select(key, F.col("p.bucket").alias(buckets), F.col("p.blob").alias(values))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_bytes, removed spans as starts and ends (bytes of
    the input), kept (the remaining bytes)."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = materialize(
        columns.mapInArrow(
            _chunks, "chunk long, bytes long, ids binary, absent binary, sizes binary, data binary"
        )
    )
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(32, -(-total // BUCKET))
    shared = materialize(
        chunks.mapInArrow(_send_anchors(buckets), _BLOB_COLUMNS)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_find_shared, _BLOB_COLUMNS)
    )
    known = chunks.join(
        _by_chunk(shared, "s_chunk", "shared_buckets", "shared"), F.col("chunk") == F.col("s_chunk"), "left"
    )
    replies = (
        known.mapInArrow(_send_contexts(buckets), _BLOB_COLUMNS + ", n long")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sort_contexts, _BLOB_COLUMNS)
    )
    return known.join(
        _by_chunk(replies, "r_chunk", "run_buckets", "runs"), F.col("chunk") == F.col("r_chunk"), "left"
    ).mapInArrow(
        _remove(buckets), "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    )
