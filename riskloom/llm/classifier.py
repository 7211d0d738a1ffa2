"""Quality classifier by Bradley-Terry pairwise ranking (operator 4).

A document's score is a linear function of its text's features.  It is
learned from preference pairs (a text labelled 1 is preferred to one labelled
0) by the logistic loss on the difference of their features, and the decision
threshold is a quantile of the scores: as many training texts are rejected as
carry label 0.

Fitting sees a bounded sample of the labelled rows (``max_per_class`` by a
hash of the id) with ``pairs_per_row`` partners each; scoring sees every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record, slices, utf8

LOWER, UPPER, DIGITS = (bytes(range(*r)) for r in ((97, 123), (65, 91), (48, 58)))
PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SHARES = (LOWER, UPPER, DIGITS, PUNCT, b"!", b"?", b".", b",", b"|", b"#*$%&<>", b"\n", b" \t", b":/", b"{}[]()=;", b"-_", b"@")
FEATURES = len(SHARES) + 13
SCORED = pa.schema([("doc_id", pa.int64()), ("raw", pa.float64())])
SAMPLE = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float64()))])


def features(raw: bytes) -> list[float]:
    """What a text looks like; never its id, source, language tag or labels."""
    n = len(raw)
    if not n:
        return [0.0] * FEATURES
    shares = [(n - len(raw.translate(None, s))) / n for s in SHARES]
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    w = len(words)
    if not w:
        return [*shares, *[0.0] * (FEATURES - len(SHARES))]
    distinct = set(words)
    length = sum(map(len, words)) / w
    starts = [x[:1] for x in words]
    pairs = set(zip(words, words[1:], strict=False))
    packed = len(zlib.compress(raw, 1)) / (n + 20)
    capital = sum(x.isupper() for x in words) / w
    return [*shares,
            np.log1p(w), np.log1p(n), length, len(distinct) / w, len(pairs) / max(1, w - 1), packed, capital,
            sum(x in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" for x in starts) / w,
            len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), w / max(1, len(lines)) / 100,
            sum(len(x) == 1 for x in words) / w, sum(len(x) > 20 for x in words) / w]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield record(SAMPLE, doc_id=batch.column("doc_id"),
                     features=[features(raw) for raw in utf8(batch.column("text"))])


@dataclass
class Ranking:
    """A fitted ranking: standardised features, weights, and the raw score that maps to ``cut``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expand((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the raw score; ``cut`` at the threshold."""
        z = (self.raw(x) - self.threshold) / self.spread + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def expand(z: np.ndarray) -> np.ndarray:
    """Standardised features, and their squares for rules that reject both ends."""
    z = np.clip(z, -8, 8)
    return np.concatenate([z, z * z / 4], axis=1)


def fit(good: np.ndarray, bad: np.ndarray, cut: float = 0.3, pairs_per_row: int = 16, l2: float = 1e-3,
        seed: int = 3, prior: float | None = None) -> Ranking:
    """Bradley-Terry weights by Newton steps on the pairs' logistic loss.

    Without rows of both classes there is nothing to prefer: all weights are 0
    and every text scores ``cut``.
    """
    rng = np.random.default_rng(seed)
    both = np.concatenate([good, bad])
    if not len(good) or not len(bad):
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(2 * FEATURES), 0.0, 1.0, cut)
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    g, b = (expand((x - mean) / scale) for x in (good, bad))
    n = pairs_per_row * max(len(g), len(b))
    d = g[rng.permutation(np.arange(n) % len(g))] - b[rng.permutation(np.arange(n) % len(b))]
    w = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # chance that the pair is ordered wrongly
        grad = l2 * w - d.T @ p / n
        hess = (d * (p * (1 - p))[:, None]).T @ d / n + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    raw_good, raw_bad = g @ w, b @ w
    share = len(b) / (len(g) + len(b)) if prior is None else prior
    weight = np.concatenate([np.full(len(g), (1 - share) / len(g)), np.full(len(b), share / len(b))])
    raw = np.concatenate([raw_good, raw_bad])
    order = np.argsort(raw, kind="stable")
    reached = np.searchsorted(np.cumsum(weight[order]), share)
    low, high = raw[order[max(0, min(reached, len(raw) - 1) - 1)]], raw[order[min(reached, len(raw) - 1)]]
    return Ranking(mean, scale, w, float((low + high) / 2), float(max(raw.std() / 2, 1e-9)), cut)


def fit_on(docs: DataFrame, labels: DataFrame, max_per_class: int = 10_000, cut: float = 0.3, **options) -> Ranking:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, quality): at most ``max_per_class`` rows of a class."""
    votes = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in votes.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    key = F.xxhash64(F.lit(17), "doc_id")
    sample = None
    for quality in (0, 1):
        part = votes.where(F.col("quality") == quality).orderBy(key, "doc_id").limit(max_per_class)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    wanted = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text")  # at most 2 * max_per_class ids
    shown = wanted.mapInArrow(_features, "doc_id long, features array<double>").join(F.broadcast(sample), "doc_id")
    rows = sorted((r["doc_id"], r["quality"], tuple(r["features"])) for r in shown.collect())
    good, bad = (np.array([r[2] for r in rows if r[1] == q]).reshape(-1, FEATURES) for q in (1, 0))
    total = sum(counts.values())
    return fit(good, bad, cut=cut, prior=counts.get(0, 0) / total if total else None, **options)


def score_documents(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text.

    A null or empty text is scored by its (empty) features; ids may be null
    or repeat; an empty table gives no rows; other columns are neither read
    nor returned.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(raw) for raw in utf8(batch.column("text"))]).reshape(-1, FEATURES)
            yield record(schema, doc_id=batch.column("doc_id"), score=ranking.score(x))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= ranking.cut).cast("int"))
