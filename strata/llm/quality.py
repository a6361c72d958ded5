"""Quality rules whose cutoffs carry a statistical guarantee (operator 6).

Each rule is a score that rises with badness; it rejects a document when the score is
above the cutoff of the document's stratum (its language). A cutoff is used only when
labelled holdout documents prove, with an exact binomial bound, that the rule rejects at
most ``alpha / rules`` of the stratum's good documents:

* only documents that pass the base rules count, as the method decides nothing else;
* labelled documents are split by a hash of ``doc_id`` into a tuning and a holdout half;
* per (stratum, rule) the fixed grid of cutoffs is tested on the holdout from the laxest to
  the strictest and testing stops at the first failure (fixed-sequence testing needs no
  correction inside the sequence); each sequence gets ``delta / (strata x rules)``
  (Bonferroni). With probability 1 - ``delta`` every used cutoff in every stratum is safe,
  so together the rules reject at most ``alpha`` of any stratum's good documents;
* among the proven cutoffs the tuning half picks the one with the largest excess of
  rejected bad over rejected good documents, the laxest on ties, none when the excess stays under ``MIN_GAIN``.

Only counts per (stratum, rule, grid step) leave the tasks. A stratum with too few labelled
good documents to prove anything has no cutoffs there, so only the base rules apply.

Defined cases: null text has no words (so ``base_failed``); null language is the stratum
``''``; a document labelled both good and bad counts as good; null labels, null ids and
labels without a document are ignored; repeated rows are judged each; empty tables give
empty results, an empty label table gives no cutoffs.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, materialize

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")

#: A rule is used only when it rejects at least this much more of the bad than of the good.
MIN_GAIN = 0.05

RATIO_GRID = tuple(k / 40 for k in range(1, 40))
GRIDS = {
    "symbols": tuple(k / 10 for k in range(1, 41)),
    "dup_lines": RATIO_GRID,
    "repeats": RATIO_GRID,
    "capitals": RATIO_GRID,
    "long_words": tuple(float(k) for k in range(6, 41)),
}


def text_counts(text: bytes) -> tuple[int, ...]:
    """The counts of ``FIELDS`` for one whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(FIELDS)
    chars = len(text.decode("utf-8", "replace")) - (len(text) - len(text.translate(None, SPACE)))
    seen, dup, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    repeat = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        marked = bytearray(n)
        for i, window in enumerate(windows):
            if times[window] > 1:
                marked[i : i + 3] = b"\1\1\1"
        repeat = sum(marked)
    return (
        n,
        chars,
        len(text) - len(text.translate(None, SYMBOLS)),
        dup,
        repeat,
        lines,
        len(text) - len(text.translate(None, CAPITALS)),
    )


def _counts(text: pa.Array) -> pa.Array:
    rows = [text_counts(t) for t in byte_values(text)]
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(FIELDS))


def counts(text: Column) -> Column:
    """Struct of the base counts of a whole text."""
    kind = T.StructType([T.StructField(f, T.LongType()) for f in FIELDS])
    return F.arrow_udf(_counts, kind).asNondeterministic()(text)  # else filters on a count would count again


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def scores(c: Column) -> dict[str, Column]:
    """Rule name to score, from a struct of counts."""
    return {
        "symbols": _ratio(c["n_symbols"], c["n_words"]),
        "dup_lines": _ratio(c["n_dup_lines"], c["n_lines"]),
        "repeats": _ratio(c["n_repeat_words"], c["n_words"]),
        "capitals": _ratio(c["n_capitals"], c["word_chars"]),
        "long_words": _ratio(c["word_chars"], c["n_words"]),
    }


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed exactly downwards from the term at ``k``.

    For ``k`` at or above the mean the tail cannot prove a rate below ``p``; 1.0 is returned.
    """
    if k >= n * p:
        return 1.0
    log_term = (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    term = total = 1.0
    for j in range(k, 0, -1):
        term *= j * (1 - p) / ((n - j + 1) * p)
        total += term
        if term < 1e-17 * total:
            break
    return min(1.0, math.exp(log_term) * total)


def choose_cutoff(
    grid: tuple[float, ...], table: dict[tuple[bool, bool, int], int], alpha: float, delta: float
) -> float | None:
    """Cutoff for one (stratum, rule). ``table[(holdout, good, step)]`` counts documents whose
    score is above exactly ``step`` cutoffs of the ascending grid."""

    def rejected(holdout: bool, good: bool) -> list[int]:
        out, above = [0] * len(grid), 0
        for j in range(len(grid) - 1, -1, -1):
            above += table.get((holdout, good, j + 1), 0)
            out[j] = above
        return out

    total = {(h, g): sum(v for (a, b, _), v in table.items() if (a, b) == (h, g)) for h in (0, 1) for g in (0, 1)}
    bad, good, certified = rejected(False, False), rejected(False, True), rejected(True, True)
    best, gain = None, MIN_GAIN
    for j in range(len(grid) - 1, -1, -1):
        if binomial_cdf(certified[j], total[True, True], alpha) > delta:
            break
        excess = bad[j] / max(1, total[False, False]) - good[j] / max(1, total[False, True])
        if excess >= gain and (best is None or excess > gain):
            best, gain = grid[j], excess
    return best


def _below(score: Column, cutoff: Column) -> Column:
    return cutoff < score


def fit_cutoffs(
    features: DataFrame, labels: DataFrame, *, alpha: float = 0.05, delta: float = 0.05, stratum: str = "lang"
) -> DataFrame:
    """(stratum, cutoffs map<rule, cutoff>) from ``features`` (doc_id, ``stratum``, counts struct ``c``)
    and ``labels`` (doc_id, quality). One row per stratum that has a proven cutoff."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("quality").alias("quality"))
    )
    rule_scores = scores(F.col("c"))
    steps = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.size(F.filter(F.array(*map(F.lit, GRIDS[name])), partial(_below, score))).alias("step"),
            )
            for name, score in rule_scores.items()
        ]
    )
    hist = materialize(
        features.where(~base_failed(F.col("c")))
        .join(known, F.col("doc_id") == known["label_id"])
        .select(
            F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
            (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("holdout"),
            (F.col("quality") == 1).alias("good"),
            F.explode(steps).alias("s"),
        )
        .groupBy("stratum", "s.rule", "s.step", "holdout", "good")
        .count()
    )
    strata = hist.select("stratum").distinct().count()
    share, level = alpha / len(GRIDS), delta / (max(1, strata) * len(GRIDS))

    def certify(key, pdf: pd.DataFrame) -> pd.DataFrame:
        name = key[1]
        cells = {
            (bool(h), bool(g), int(s)): int(n)
            for h, g, s, n in zip(pdf["holdout"], pdf["good"], pdf["step"], pdf["count"])
        }
        cut = choose_cutoff(GRIDS[name], cells, share, level)
        rows = [] if cut is None else [(key[0], name, cut)]
        return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff"])

    chosen = hist.groupBy("stratum", "rule").applyInPandas(certify, "stratum string, rule string, cutoff double")
    return materialize(
        chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )


def judge(features: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang") -> DataFrame:
    """Adds ``base_failed``, ``fired`` (sorted names of rules above their cutoff) and ``kept``."""
    limits = cutoffs.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs"))
    joined = features.join(
        limits, F.coalesce(F.col(stratum).cast("string"), F.lit("")) == F.col("_stratum"), "left"
    )
    fired = F.array_sort(
        F.filter(
            F.array(
                *[F.when(score > F.col("_cutoffs")[name], F.lit(name)) for name, score in scores(F.col("c")).items()]
            ),
            lambda x: x.isNotNull(),
        )
    )
    return (
        joined.withColumn("base_failed", base_failed(F.col("c")))
        .withColumn("fired", F.array_join(fired, ","))
        .withColumn("kept", ~F.col("base_failed") & (F.col("fired") == ""))
        .drop("_stratum", "_cutoffs")
    )


def assess(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Verdict of every row: doc_id, counts ``c``, base_failed, fired, kept. Texts are read once."""
    features = materialize(docs.select("doc_id", "lang", counts(F.col("text")).alias("c")))
    return judge(features, fit_cutoffs(features, labels, **options))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, columns unchanged.

    Counts are made twice (once without the texts for the fit) rather than writing the texts again.
    """
    columns = docs.columns
    cutoffs = fit_cutoffs(docs.select("doc_id", "lang", counts(F.col("text")).alias("c")), labels, **options)
    whole = docs.select(
        F.struct(*[docs[c] for c in columns]).alias("row"), F.col("lang"), counts(F.col("text")).alias("c")
    )
    return judge(whole, cutoffs).where("kept").select(*[F.col("row")[c].alias(c) for c in columns])
