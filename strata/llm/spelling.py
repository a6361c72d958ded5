"""Words of one edit apart by pivotal grams, grouped under their common spelling (operator 11).

Every word chooses, among its rarest bigrams, two that do not overlap (its pivots, the cheapest pair by
dynamic programming over the positions); one edit spoils at most one of them. The other words index
their gram prefix: the three rarest places and all places of the same bigrams. If ``s`` and ``r`` are one
edit apart and the last gram of ``s``'s prefix is no more frequent than that of ``r``'s, then a pivot of
``s`` that the edit leaves whole stands in ``r``'s prefix, and there its position is known:

* an edit behind the left pivot leaves everything up to that pivot as it is, so ``r`` begins with the same
  letters up to the gram's end (same position from the left);
* any other edit leaves everything from the right pivot on, so ``r`` ends in the same letters from the
  gram on (same position from the right).

So the position limit becomes an equality: the join key is the side, the letters up to (from) the gram and
the length (one less, equal, one more), and Spark joins probes to index entries on it; the edit distance
is verified in the join. Among equal bigrams the left pivot takes the first place and the right pivot the
last, so an index needs only these: at most six entries a word however long and repetitive it is.

The vocabulary is counted over whole texts (per document in Python, added up by Spark). The only thing
that reaches the driver is the bigram frequency table, whose size is bounded by the square of the alphabet
(90 letters), never by the words; no join broadcasts a side. A word's neighbours are bounded by its length times the alphabet.

Defined cases: null text has no words; a null id is empty text in the hash; repeated rows count each;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, materialize

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is at least this many times as frequent as its variant.
DOMINANCE = 5
#: One run in so many, chosen by hash, loses a letter (the contract's noise).
DROPS = 199
EDITS = 1
GRAM = 2
PREFIX = GRAM * EDITS + 1

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}")
_FLUSH = 500_000


def words_of(doc_id: bytes, text: bytes) -> Iterator[tuple[str, int]]:
    """Distinct words of one whole text with their number, letters dropped where the hash says so."""
    start = zlib.crc32(doc_id + b":")
    for run, n in Counter(_RUN.findall(text.translate(_LOWER).decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), start)
        if h % DROPS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
        )

    total: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(byte_values(batch.column(0)), byte_values(batch.column(1))):
            for word, n in words_of(doc_id, text):
                total[word] += n
            if len(total) > _FLUSH:
                yield flushed()
                total.clear()
    yield flushed()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words of ``docs`` (doc_id, text) that are long and frequent enough."""
    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counts = read.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            total.update(map("".join, zip(word, word[1:])))
    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["gram", "n"])


def gram_frequencies(words: DataFrame) -> dict[str, int]:
    """Places of each bigram over the distinct words: one entry per pair of letters at most."""
    grams = words.select("word").mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in grams.collect()}


def choose_pivots(places: list[tuple[int, int]], wanted: int = EDITS + 1) -> list[int]:
    """Positions of ``wanted`` grams without overlap with the least total weight, from ``(position, weight)``
    in order of position. ``best[m]`` is the cheapest choice of ``m`` grams among those before, one list for
    every place; a gram may follow the best choice that ends ``GRAM`` places before it."""
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * wanted]
    for j, (at, weight) in enumerate(places):
        free = j
        while free and places[free - 1][0] > at - GRAM:
            free -= 1
        row = list(best[-1])
        for m in range(1, wanted + 1):
            before = best[free][m - 1]
            if before is not None:
                taken = (before[0] + weight, (*before[1], at))
                if row[m] is None or taken < row[m]:
                    row[m] = taken
        best.append(row)
    return list(best[-1][wanted][1])


def signature(word: str, frequency: Mapping[str, int]) -> tuple[int, str, str, list[str], list[str]]:
    """Rank of the prefix's last gram; the word up to its left pivot; the word from its right pivot;
    the same for every gram of its prefix, each at its first and its last place."""
    grams = [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]
    first = {g: i for i, g in reversed(list(enumerate(grams)))}
    final = {g: i for i, g in enumerate(grams)}
    times, taken, prefix = Counter(grams), 0, []
    for gram in sorted(times, key=lambda g: (frequency[g], g)):
        prefix.append(gram)
        taken += times[gram]
        if taken >= PREFIX:
            break
    places = sorted({(p, frequency[g]) for g in prefix for p in (first[g], final[g])})
    chosen = choose_pivots(places)
    left, right = first[grams[chosen[0]]], final[grams[chosen[-1]]]
    starts = [word[: first[g] + GRAM] for g in prefix]
    return frequency[prefix[-1]], word[: left + GRAM], word[right:], starts, [word[final[g] :] for g in prefix]


def _signatures(frequency: Mapping[str, int]):
    kind = T.StructType(
        [
            T.StructField("last", T.LongType()),
            T.StructField("left", T.StringType()),
            T.StructField("right", T.StringType()),
            T.StructField("starts", T.ArrayType(T.StringType())),
            T.StructField("ends", T.ArrayType(T.StringType())),
        ]
    )
    types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]

    def made(words: pa.Array) -> pa.Array:
        columns = list(zip(*(signature(w, frequency) for w in words.to_pylist()))) or [()] * len(types)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], kind.names)

    return F.arrow_udf(made, kind)


def _dealt(table: DataFrame) -> DataFrame:
    """``table`` as a side of a join that is never broadcast: it grows with the vocabulary. Files of words are small
    beside the rows they hold (a few index entries each), so a plan that goes by the size of the files would
    gather the entries of half a million words in the driver."""
    return table.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n`` for words one edit apart; a pair comes in one direction or both, once
    or twice. ``words`` (word, n) is read several times, so it should be stored."""
    signed = words.withColumn("s", _signatures(gram_frequencies(words))(F.col("word")))

    def keyed(side: str, part: Column) -> Column:
        return F.struct(F.lit(side).alias("side"), part.alias("part"))

    def entries(field: str, side: str) -> Column:
        return F.transform(F.col(f"s.{field}"), lambda x: keyed(side, x))

    index = signed.select(
        F.explode(F.concat(entries("starts", "left"), entries("ends", "right"))).alias("key"),
        F.length("word").alias("length"), F.col("s.last").alias("near_last"),
        F.col("word").alias("near"), F.col("n").alias("near_n"),
    )
    pivots = F.array(keyed("left", F.col("s.left")), keyed("right", F.col("s.right")))
    probes = signed.select("word", "n", F.col("s.last").alias("last"), F.explode(pivots).alias("key"))
    lengths = F.transform(F.sequence(F.lit(-EDITS), F.lit(EDITS)), lambda d: F.length("word") + d)
    probes = probes.select("*", F.explode(lengths).alias("length"))
    found = probes.join(_dealt(index), ["key", "length"]).where(
        (F.col("last") <= F.col("near_last"))
        & (F.col("word") != F.col("near"))
        & (F.levenshtein("word", "near", EDITS) == EDITS)
    )
    return found.select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words with a form, by pointer doubling. A form is ``DOMINANCE`` times as frequent
    as its word, so a chain has at most log(largest n) steps and the rounds are known beforehand."""
    top = forms.agg(F.max("form_n")).collect()[0][0] or MIN_COUNT
    steps = max(1, math.floor(math.log(max(1.0, top / MIN_COUNT), DOMINANCE)) + 1)
    roots = materialize(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(
            roots.join(_dealt(further), "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        )
    return roots


def group(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``docs`` (doc_id, text)."""
    words = materialize(vocabulary(docs))
    pairs = near_pairs(words)
    both = pairs.unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    # a word's neighbours: bounded by its length and the alphabet
    neighbours = F.collect_set(F.struct((-F.col("near_n")).alias("order"), "near"))
    found = both.groupBy("word", "n").agg(neighbours.alias("near"))
    best = F.array_min("near")
    dominant = -best["order"] >= DOMINANCE * F.col("n")
    linked = materialize(
        found.select(
            "word",
            F.size("near").cast("long").alias("n_near"),
            F.when(dominant, best["near"]).alias("form"),
            F.when(dominant, -best["order"]).alias("form_n"),
        )
    )
    roots = _roots(linked.where(F.col("form").isNotNull()))
    return (
        words.join(_dealt(linked), "word", "left")
        .join(_dealt(roots), "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n",
        )
    )
