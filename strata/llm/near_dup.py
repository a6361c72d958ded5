"""N-gram Jaccard join with a MinHash LSH forest (operator 3).

A text is the set of its five-word shingles (words: runs without ASCII white space, A-Z lower-cased;
a text of fewer words is one shingle). Two texts are linked when their sets' Jaccard similarity is at
least ``threshold``.

Forest: a signature has a run of MinHash values for each tree; the texts that agree on a tree's first ``d``
values are one node of its prefix trie. The shorter the prefix, the fewer trees find a pair at the threshold
(:func:`forest`: 16 trees at 4 values, 12 at 3, 8 at 2). Every text begins at the full prefix and shortens it,
dropping the trees it no longer needs, to the length that leaves it the fewest candidates (each further value
must leave less than 1 / ``WORTH`` of them): texts among many
alike by chance keep long prefixes, texts with true copies only get short ones. A node is matched if one of its
texts stopped there; it then meets all texts of the node, however long their own prefixes. Whichever length a
text chooses, and though it looks at the node sizes to choose, a pair at the threshold is lost with a probability
of at most 1 - ``recall``: each length may lose a share of it, and the shares add up. Nodes with the same
members are matched once. Each pair of a node is then verified exactly on the whole shingle sets.

Scale: equal texts are folded into one representative before anything is matched, so a hot group of
copies costs one row. A node of many different texts is cut into chunks, and each pair of chunks is a
block verified on its own, so no task holds a node; a pair meeting in several nodes is counted in the
first only. Blocks return link counts and a spanning forest of their links, never the pairs, so a
group of near copies yields rows in proportion to its size. Only signatures, ids and the texts of
node members are shuffled.

Components of the links are found by minimum labels with pointer jumping; every round is a table in
the shared folder.

Defined cases: null text counts as empty; a text without words is linked with equal texts only;
null ids sort last, so a class id is null only when all its ids are; repeated rows are copies of each
other, and classes that share a repeated id as their smallest share the class id; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, digest, groups, materialize

WORDS = 5
THRESHOLD = 0.8
DEPTHS, RECALL = (2, 3, 4), 0.999
#: A prefix is left longer by a value if that divides the candidates by more than this.
WORTH = 4
#: Most MinHash values of a signature.
VALUES = 500
#: Most texts and shingles of a chunk; a block holds two chunks.
CHUNK_TEXTS, CHUNK_SHINGLES = 512, 1 << 21

_ODD = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 512, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()


def shingles(text: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of a whole text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    size = len(words) - width + 1
    out = np.zeros(size, np.uint64)
    for i in range(width):
        out += h[i : i + size] * _ODD[500 + i]
        out ^= out >> np.uint64(31)
        out *= _ODD[511]
    return np.unique(out)


def signature(hashes: np.ndarray, length: int) -> np.ndarray:
    """``length`` MinHash values (32 bits) of a shingle set."""
    best = np.full(length, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[None, at : at + 4096] * _ODD[:length, None]
        part += _ADD[:length, None]
        part ^= part >> np.uint64(29)
        np.minimum(best, part.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(">u4")


def forest(threshold: float, recall: float = RECALL, depths: tuple[int, ...] = DEPTHS) -> dict[int, int]:
    """Trees for each prefix length, so that a text may settle for any of them: at each, a pair at
    ``threshold`` meets in no tree with probability (1 - ``recall``) / lengths at most."""
    lost = (1 - recall) / len(depths)
    trees = {d: math.ceil(math.log(lost) / math.log1p(-(threshold**d))) if threshold < 1 else 1 for d in depths}
    if max(trees.values()) * max(depths) > VALUES:
        raise ValueError(f"a signature of {VALUES} values is too short for this threshold and recall")
    return trees


def _signatures(length: int):
    def run(text: pa.Array) -> pa.Array:
        sizes, values = [], []
        for t in byte_values(text):
            s = shingles(t)
            sizes.append(len(s))
            values.append(signature(s, length).tobytes() if len(s) else b"")
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(values, pa.binary())], ["n", "sig"])

    kind = T.StructType([T.StructField("n", T.LongType()), T.StructField("sig", T.BinaryType())])
    return F.arrow_udf(run, kind)


def _linked(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets ``a`` reach the threshold with which of the sets ``b``."""
    size_a = np.array([len(x) for x in a], np.float64)
    size_b = np.array([len(x) for x in b], np.float64)
    shared = np.zeros((len(a), len(b)))
    if len(a) * len(b) <= 36:
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared[i, j] = np.count_nonzero(y[at] == x)
    else:
        _, column = np.unique(np.concatenate([*a, *b]), return_inverse=True)
        split = int(size_a.sum())
        row_a, row_b = np.repeat(np.arange(len(a)), size_a.astype(int)), np.repeat(np.arange(len(b)), size_b.astype(int))
        col_a, col_b = column[:split], column[split:]
        both = np.bincount(col_a, minlength=column.max() + 1).astype(bool) & np.bincount(
            col_b, minlength=column.max() + 1
        ).astype(bool)
        place = np.cumsum(both) - 1
        keep_a, keep_b = both[col_a], both[col_b]
        row_a, col_a = row_a[keep_a], place[col_a[keep_a]]
        row_b, col_b = row_b[keep_b], place[col_b[keep_b]]
        order_a, order_b = np.argsort(col_a, kind="stable"), np.argsort(col_b, kind="stable")
        row_a, col_a, row_b, col_b = row_a[order_a], col_a[order_a], row_b[order_b], col_b[order_b]
        step, total = 2048, int(place[-1]) + 1 if len(place) else 0
        for lo in range(0, total, step):
            width = min(step, total - lo)
            x, y = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
            for m, r, c in ((x, row_a, col_a), (y, row_b, col_b)):
                s, e = np.searchsorted(c, (lo, lo + width))
                m[r[s:e], c[s:e] - lo] = 1
            shared += x @ y.T
    union = size_a[:, None] + size_b[None, :] - shared
    return shared + 1e-9 >= threshold * union


def _first_met(rows_a: list[dict], rows_b: list[dict], node: int) -> np.ndarray:
    """False where a pair shares a node below ``node`` as well: it is counted there."""
    out = np.ones((len(rows_a), len(rows_b)), bool)
    at: dict[int, tuple[list[int], list[int]]] = {}
    for side, rows in enumerate((rows_a, rows_b)):
        for i, r in enumerate(rows):
            for n in r["nodes"]:
                if n < node:
                    at.setdefault(n, ([], []))[side].append(i)
    for x, y in at.values():
        if x and y:
            out[np.ix_(x, y)] = False
    return out


def _block(key: tuple, rows: list[dict], threshold: float) -> list[tuple]:
    """(tk, number of linked documents, tk of the block's component root) for each linked text."""
    node, left, right = key
    rows = list({r["tk"]: r for r in rows}.values())
    sets = [shingles((r["text"] or "").encode()) for r in rows]
    a = [i for i, r in enumerate(rows) if r["chunk"] == left]
    b = a if left == right else [i for i, r in enumerate(rows) if r["chunk"] == right]
    if not a or not b or len(rows) < 2:
        return []
    ok = _linked([sets[i] for i in a], [sets[i] for i in b], threshold)
    ok &= _first_met([rows[i] for i in a], [rows[i] for i in b], node)
    links = np.zeros(len(rows), np.int64)
    count = np.array([r["copies"] for r in rows], np.int64)
    label = np.arange(len(rows))
    if left == right:
        np.fill_diagonal(ok, False)
        links[a] = ok @ count[a]
    else:
        links[a] = ok @ count[b]
        links[b] = ok.T @ count[a]
    a, b, big = np.array(a), np.array(b), len(rows)
    while True:
        new = label.copy()
        new[a] = np.minimum(new[a], np.where(ok, label[b][None, :], big).min(axis=1, initial=big))
        new[b] = np.minimum(new[b], np.where(ok, new[a][:, None], big).min(axis=0, initial=big))
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(rows[i]["tk"], int(links[i]), rows[label[i]]["tk"]) for i in np.flatnonzero(links)]


def _verify(threshold: float):
    kind = pa.schema([("tk", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, rows in groups(batches, "block"):
            out += _block((rows[0]["node"], rows[0]["left"], rows[0]["right"]), rows, threshold)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip(kind.names, zip(*out))), schema=kind)
                out = []
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(kind.names, zip(*out))), schema=kind)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of ``edges`` (a, b)."""
    both = materialize(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a"))).distinct()
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("near_node"))
            .agg(F.min("label").alias("near"))
        )
        low = labels.join(near, F.col("node") == F.col("near_node")).select(
            "node", "label", F.least("label", "near").alias("low")
        )
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("onward"))
        moved = materialize(
            low.join(jump, F.col("low") == F.col("at")).select(
                "node", F.least("low", "onward").alias("label"), (F.least("low", "onward") != F.col("label")).alias("new")
            )
        )
        labels = moved.select("node", "label")
        if moved.where("new").isEmpty():
            return labels


def matched_nodes(texts: DataFrame, trees: dict[int, int]) -> DataFrame:
    """(tk, n, depth, node): the texts (tk, n, sig) of every node at which one of them stops."""
    deepest = max(trees)
    keys = F.array(
        *[
            F.struct(
                F.lit(d).alias("depth"),
                F.xxhash64(F.lit(d), F.lit(t), F.substring("sig", 4 * deepest * t + 1, 4 * d)).alias("node"),
            )
            for d in trees
            for t in range(trees[d])
        ]
    )
    placed = texts.where("n > 0").select("tk", "n", F.explode(keys).alias("k")).select("tk", "n", "k.depth", "k.node")
    sizes = placed.groupBy(F.col("node").alias("s_node")).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = materialize(placed.join(sizes, F.col("node") == F.col("s_node")).drop("s_node"))
    # true copies hardly thin out along a prefix: only much fewer candidates are worth the trees of a longer one
    candidates = {
        d: F.sum(F.when(F.col("depth") == d, (F.col("members") - 1) * WORTH ** (d - min(trees))).otherwise(0))
        for d in trees
    }
    stops = shared.groupBy(F.col("tk").alias("c_tk")).agg(
        F.least(*[F.struct(c.alias("candidates"), F.lit(d).alias("depth")) for d, c in candidates.items()]).alias("stop")
    )
    reached = (
        shared.join(stops, (F.col("tk") == F.col("c_tk")) & (F.col("depth") == F.col("stop.depth")))
        .select(F.col("node").alias("r_node"))
        .distinct()
    )
    return shared.join(reached, F.col("node") == F.col("r_node")).select("tk", "n", "depth", "node")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct text of ``docs`` (doc_id, text): tk (its digest), rep (smallest doc_id),
    copies, links (documents linked with it, copies included), class_id, keeper (the class's one text
    that stays)."""
    trees = forest(threshold)
    sig = _signatures(max(trees.values()) * max(trees))(F.col("text"))
    texts = materialize(
        docs.select("doc_id", digest(F.col("text")).alias("tk"), sig.alias("s"))
        .groupBy("tk")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("s").alias("s"))
        .select("tk", "rep", "copies", "s.n", "s.sig")
    )
    placed = matched_nodes(texts, trees)
    nodes = (
        placed.groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("n").alias("shingles"),
            F.bit_xor(F.xxhash64("tk")).alias("x"),
            F.bit_xor(F.xxhash64("tk", F.lit(1))).alias("y"),
        )
        .where("members > 1")
        .groupBy("members", "shingles", "x", "y")
        .agg(F.min("node").alias("node"))
        .select(
            F.col("node").alias("kept_node"),
            F.greatest(F.ceil(F.col("members") / CHUNK_TEXTS), F.ceil(F.col("shingles") / CHUNK_SHINGLES))
            .cast("int")
            .alias("chunks"),
        )
    )
    member = (
        placed.join(nodes, F.col("node") == F.col("kept_node"))
        .groupBy("tk")
        .agg(F.collect_list(F.struct("node", "chunks")).alias("at"))
    )
    wanted = (
        member.withColumnRenamed("tk", "wanted_tk")
        .join(texts, F.col("wanted_tk") == F.col("tk"))
        .select("wanted_tk", F.col("rep").alias("wanted_id"), "copies", "at")
    )
    chunk = F.pmod(F.xxhash64("tk", "node"), F.col("chunks").cast("long")).cast("int")
    blocks = (
        docs.select("doc_id", digest(F.col("text")).alias("tk"), "text")
        .join(wanted, (F.col("tk") == F.col("wanted_tk")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")))
        .select("tk", "copies", "text", F.col("at.node").alias("nodes"), F.explode("at").alias("one"))
        .select("tk", "copies", "text", "nodes", "one.node", "one.chunks")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("left", F.least("chunk", "other"))
        .withColumn("right", F.greatest("chunk", "other"))
        .withColumn("block", F.concat_ws(":", "node", "left", "right"))
        .select("block", "node", "left", "right", "chunk", "tk", "copies", "nodes", "text")
    )
    found = materialize(
        blocks.repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_verify(threshold), "tk binary, links long, root binary")
    )
    linked = found.groupBy(F.col("tk").alias("l_tk")).agg(F.sum("links").alias("l"))
    label = components(found.select(F.col("tk").alias("a"), F.col("root").alias("b")))
    joined = (
        texts.select("tk", "rep", "copies")
        .join(linked, F.col("tk") == F.col("l_tk"), "left")
        .join(label, F.col("tk") == F.col("node"), "left")
        .select(
            "tk",
            "rep",
            "copies",
            (F.coalesce("l", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("label", "tk").alias("component"),
        )
    )
    joined = materialize(joined)
    first = joined.groupBy(F.col("component").alias("c")).agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "tk")).alias("first")
    )
    return joined.join(first, F.col("component") == F.col("c")).select(
        "tk",
        "rep",
        "copies",
        "links",
        F.col("first.rep").alias("class_id"),
        (F.col("first.tk") == F.col("tk")).alias("keeper"),
    )


def join_near(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of its class), n_copies (rows with the
    same text, itself included), n_links (other rows at or above the threshold, copies included)."""
    docs = docs.select("doc_id", "text")
    found = classes(docs, threshold).withColumnRenamed("tk", "class_tk")
    return (
        docs.select("doc_id", digest(F.col("text")).alias("tk"))
        .join(found, F.col("tk") == F.col("class_tk"))
        .select("doc_id", "class_id", F.col("copies").alias("n_copies"), F.col("links").alias("n_links"))
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with one row of each class (its smallest doc_id), columns unchanged."""
    stay = (
        classes(docs.select("doc_id", "text"), threshold)
        .where("keeper")
        .select(F.col("tk").alias("stay_tk"), F.col("rep").alias("stay_id"))
    )
    rows = docs.select(
        digest(docs["text"]).alias("tk"), docs["doc_id"].alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row")
    )
    return (
        rows.join(stay, (F.col("tk") == F.col("stay_tk")) & F.col("id").eqNullSafe(F.col("stay_id")), "left_semi")
        .groupBy("tk", "id")
        .agg(F.first("row").alias("row"))
        .select(*[F.col("row")[c].alias(c) for c in docs.columns])
    )
