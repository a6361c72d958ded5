"""Quality classifier from trusted positives and unlabelled text (operator 12).

Labels that say "bad" are never used. Trusted positives are the documents labelled good in the training
part; all other training documents, labelled or not, are only "unlabelled". The classifier minimises the
non-negative unbiased risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

with the logistic loss: the second term is the risk on negatives, computed from unlabelled documents less
the positives among them; when a batch makes it negative (overfitting), the step goes the other way for it.
The class prior is estimated beforehand from the same two samples (:func:`estimated_prior`): a first
classifier tells positives from unlabelled, and the share of unlabelled documents above a score, divided by
the share of positives above it, is an upper bound on the prior; the score with the least upper confidence
limit gives the estimate. A classifier trained with that prior is put to the same test, and the lower bound
of the two is used. Both score only rows they were not trained on.

Texts are read whole. Features are frequencies of pairs of character classes (letters, digits, space, kinds
of punctuation, others) and ratios of words, lines and repetitions; neither labels nor language, source or
id are among them.

The fit uses a bounded sample: the ``POSITIVES`` trusted positives and the ``UNLABELLED`` training
documents whose ids have the smallest hash, a sample of the same law at every size. Their ids (at most the sum
of the two numbers) are broadcast, features are made where the documents lie, and one task fits on that
bounded table. Scores are then made for every document in one narrow pass.

Defined cases: null text is empty and is scored; a null id belongs to the training part and matches no label;
an id labelled both good and bad is no trusted positive; rows that repeat an id are scored each, and the one
with the smallest digest of its text stands for the id in the fit; null labels and labels without a document are
ignored; without trusted positives every score is 0.5; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, digest, materialize

#: Bounds of the sample for the fit.
POSITIVES = 8_000
UNLABELLED = 16_000
THRESHOLD = 0.7

_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\x0b\x0c\r",
    b"\n",
    b".",
    b",;:",
    b"!",
    b"?",
    b"'\"`",
    b"()[]{}",
    b"#*$%&@",
    b"|<>\\/",
    b"-_=+~^",
    bytes(range(0x80, 0x100)),
)
_CLASS_OF = bytearray([len(_CLASSES)] * 256)
for _i, _members in enumerate(_CLASSES):
    for _b in _members:
        _CLASS_OF[_b] = _i
_CLASS_OF = bytes(_CLASS_OF)
_N = len(_CLASSES) + 1
N_FEATURES = _N * _N + 9


def text_features(text: bytes) -> np.ndarray:
    """Features of one whole text: log of pairs of character classes per 1,000, and ratios."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if len(text) > 1:
        kinds = np.frombuffer(text.translate(_CLASS_OF), dtype=np.uint8)
        pairs = np.bincount(kinds[:-1].astype(np.int16) * _N + kinds[1:], minlength=_N * _N)
        out[: _N * _N] = np.log1p(pairs * (1000.0 / len(text)))
    words = text.split()
    n = len(words)
    if not n:
        return out
    triples = n - 2
    distinct = len(set(zip(words, words[1:], words[2:]))) if triples > 0 else 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[_N * _N :] = (
        1.0,
        math.log1p(n),
        sum(map(len, words)) / n / 10,
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        distinct / triples if triples > 0 else 1.0,
        math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        math.log1p(max(map(len, words))),
    )
    return out


def _feature_rows(column: pa.Array) -> np.ndarray:
    return np.stack([text_features(t) for t in byte_values(column)]) if len(column) else np.zeros((0, N_FEATURES), "f4")


def _features(text: pa.Array) -> pa.Array:
    rows = _feature_rows(text)
    ends = np.arange(0, N_FEATURES * len(rows) + 1, N_FEATURES, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


class Network:
    """One hidden layer of rectified units over standardised features, trained by Adam."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int, seed: int):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = mean.astype("f4"), scale.astype("f4")
        size = (len(mean), hidden)
        self.parts = [
            draw.normal(0, math.sqrt(2 / len(mean)), size).astype("f4"),
            np.zeros(hidden, "f4"),
            draw.normal(0, math.sqrt(1 / hidden), hidden).astype("f4"),
            np.zeros(1, "f4"),
        ]

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8)

    def margin(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b, v, c = self.parts
        hidden = np.maximum(x @ w + b, 0)
        return hidden @ v + c[0], hidden

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.standard(rows))[0].astype("f8"), -30, 30)))

    def train(self, x: np.ndarray, slope, steps: int, batch: int, seed: int, rate: float = 2e-3, decay: float = 1e-3):
        """``steps`` steps on shuffled batches; ``slope(margin, chosen rows)`` is the derivative of the risk by each
        margin."""
        draw = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.parts]
        second = [np.zeros_like(p) for p in self.parts]
        order = np.zeros(0, dtype=np.int64)
        for step in range(1, steps + 1):
            if len(order) < min(batch, len(x)):
                order = draw.permutation(len(x))
            chosen, order = order[:batch], order[batch:]
            z, hidden = self.margin(x[chosen])
            g = slope(z, chosen).astype("f4")
            back = np.outer(g, self.parts[2]) * (hidden > 0)
            gradient = [x[chosen].T @ back, back.sum(0), hidden.T @ g, np.array([g.sum()], "f4")]
            for k, (p, d) in enumerate(zip(self.parts, gradient)):
                d = d + decay * p if p.ndim > 1 else d
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                p -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of both (rows the scorer was not trained on).

    ``share of unlabelled >= t`` / ``share of positives >= t`` bounds the prior from above at every ``t``; the
    ``t`` with the least upper confidence limit of the ratio is taken.
    """
    cuts = np.unique(positive)
    p = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    slack = math.sqrt(math.log(4 / confidence) / (2 * len(positive))) + math.sqrt(
        math.log(4 / confidence) / (2 * len(unlabelled))
    )
    best = np.argmin((u + slack) / p)
    return float(min(0.99, max(0.01, u[best] / p[best])))


def _positive_from_unlabelled(x: np.ndarray, is_positive: np.ndarray, net: Network, seed: int) -> None:
    weight = np.where(is_positive, 0.5 / max(1, is_positive.sum()), 0.5 / max(1, (~is_positive).sum())) * len(x)

    def slope(z, chosen):
        return (_sigmoid(z) - is_positive[chosen]) * weight[chosen] / len(chosen)

    net.train(x, slope, steps=200, batch=512, seed=seed)


def _non_negative_risk(x: np.ndarray, is_positive: np.ndarray, prior: float, net: Network, seed: int) -> None:
    def slope(z, chosen):
        """Of prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), logistic loss; each part averaged over its rows."""
        p, n = is_positive[chosen], len(chosen)
        n_p, n_u = max(1, p.sum()), max(1, n - p.sum())
        as_bad, loss_bad = _sigmoid(z), np.logaddexp(0, z)
        negative = loss_bad[~p].sum() / n_u - prior * loss_bad[p].sum() / n_p
        bad = np.where(p, -prior * as_bad / n_p, as_bad / n_u)
        if negative < 0:
            return -bad
        return bad + np.where(p, prior * (as_bad - 1) / n_p, 0)

    net.train(x, slope, steps=700, batch=1024, seed=seed)


def fit(rows: np.ndarray, is_positive: np.ndarray, seed: int = 12) -> tuple[Network, float]:
    """Network and class prior from feature rows in a fixed order; one row may be listed in both roles."""
    scale = rows.std(axis=0)
    scale[scale < 1e-3] = 1e-3
    mean = rows.mean(axis=0)
    even = np.arange(len(rows)) % 2 == 0

    def crossed(hidden: int, train) -> np.ndarray:
        """Scores of either half by a network trained on the other."""
        scores = np.zeros(len(rows))
        for half in (even, ~even):
            net = Network(mean, scale, hidden, seed)
            train(net.standard(rows[~half]), is_positive[~half], net)
            scores[half] = net.probability(rows[half])
        return scores

    prior = 0.5
    if all(is_positive[h].any() and not is_positive[h].all() for h in (even, ~even)):
        scores = crossed(16, lambda x, p, net: _positive_from_unlabelled(x, p, net, seed))
        prior = estimated_prior(scores[is_positive], scores[~is_positive])
        # every scorer bounds the prior from above, and one trained with a prior ranks better: the least bound
        scores = crossed(32, lambda x, p, net: _non_negative_risk(x, p, prior, net, seed))
        prior = min(prior, estimated_prior(scores[is_positive], scores[~is_positive]))
    net = Network(mean, scale, 32, seed)
    _non_negative_risk(net.standard(rows), is_positive, prior, net, seed)
    return net, prior


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4 (null counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def _sampled_ids(ids: DataFrame, at_most: int, role: str) -> DataFrame:
    kept = ids.where(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 2)).dropDuplicates()
    return kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most).select("doc_id", F.lit(role).alias("role"))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``role`` (positive or unlabelled) and ``features`` of the bounded sample."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    good = good.where((F.col("least") == 1) & (F.col("most") == 1)).select("doc_id")
    known = docs.select("doc_id").join(good, "doc_id", "left_semi")
    sample = _sampled_ids(known, POSITIVES, "positive").unionByName(
        _sampled_ids(docs.select("doc_id"), UNLABELLED, "unlabelled")
    )
    roles = sample.groupBy("doc_id").agg(F.collect_set("role").alias("roles"))
    made = docs.select("doc_id", "text").join(F.broadcast(roles), "doc_id")
    made = made.select("doc_id", "roles", digest(F.col("text")).alias("d"), features(F.col("text")).alias("features"))
    one = made.groupBy("doc_id").agg(F.min_by(F.struct("roles", "features"), "d").alias("x"))
    return one.select("doc_id", F.explode("x.roles").alias("role"), F.col("x.features").alias("features"))


def features(text: Column) -> Column:
    return F.arrow_udf(_features, T.ArrayType(T.FloatType()))(text)


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "doc_id", "role"], kind="stable")
    net, prior = fit(np.stack(rows["features"].to_numpy()).astype("f4"), (rows["role"] == "positive").to_numpy())
    return pd.DataFrame({"model": [pickle.dumps(net)], "prior": [prior]})


def trained(docs: DataFrame, labels: DataFrame) -> tuple[Network | None, float]:
    """The classifier and the class prior; (None, 0.5) without trusted positives."""
    rows = materialize(training_rows(docs, labels)).select("*", F.xxhash64("doc_id").alias("place"), F.lit(0).alias("all"))
    if not rows.where(F.col("role") == "positive").head(1):
        return None, 0.5
    # POSITIVES + UNLABELLED rows at most, in one task
    fitted = rows.groupBy("all").applyInPandas(_fitted, "model binary, prior double").collect()[0]
    return pickle.loads(bytes(fitted["model"])), fitted["prior"]


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``score``, the probability that the text is good."""
    if net is None:
        return docs.withColumn("score", F.lit(0.5))

    def scored(text: pa.Array) -> pa.Array:
        return pa.array(net.probability(_feature_rows(text)), pa.float64())

    return docs.withColumn("score", F.arrow_udf(scored, T.DoubleType())(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs`` (doc_id, text)."""
    net, _ = trained(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    held_out = remainder(F.col("doc_id")) == 2
    return score(docs.select("doc_id", held_out.alias("held_out"), "text"), net).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
