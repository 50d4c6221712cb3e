"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text becomes a few statistics (lengths, shares of character kinds, repetition), transformed to be nearly
normal and standardised.  Each class has a mean and a covariance shrunk towards the pooled one and its diagonal;
the score is the difference of the two log densities, from Mahalanobis distances by cached Cholesky factors,
turned into a probability by a logistic curve fitted on the same rows.

The model learns from at most ``SAMPLE`` labelled rows (a documented bound, taken by a hash of the id over the
whole label table); everything is scored.  Labels, language, source and id are no inputs of a score.

Nulls, empty texts and ties: a NULL text is an empty one and is scored; rows without a label, or with a NULL
one, teach nothing; repeated label rows each count; without labels of both classes every score is the share of
label 1 (one half without any).  Other columns are ignored and kept by ``keep``.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import held_out, map_rows

#: Labelled rows learned from at most (about), shrinkage towards pooled and diagonal, score that keeps a text.
SAMPLE, POOLED, DIAGONAL, THRESHOLD = 20_000, 0.1, 0.1, 0.3


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    c = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(1, len(data))
    upper, lower, digit = int(c[65:91].sum()), int(c[97:123].sum()), int(c[48:58].sum())
    blank = int(c[9:14].sum() + c[32])
    stops = int(c[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    symbol = int(c[33:127].sum()) - upper - lower - digit - stops
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    kinds = len(set(words))
    return [
        np.log1p(len(data)), np.log1p(sizes.mean()), np.log1p(sizes.std()), np.sqrt(upper / size),
        np.sqrt(digit / size), np.sqrt(symbol / size), np.sqrt(stops / size), np.sqrt(int(c[33]) / size),
        np.sqrt(int(c[128:].sum()) / size), blank / size, np.log1p(kinds) / np.log1p(n), kinds / n,
        len(set(lines)) / len(lines), np.log1p(size / len(lines)), float((sizes <= 3).mean()),
        np.sqrt(sum(w[:1].isupper() for w in words) / n),
    ]


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of the two classes, and the logistic curve of their difference."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    logdets: list[float]
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        z = (x - self.centre) / self.scale
        part = [-0.5 * np.square((z - m) @ f.T).sum(axis=1) - d for m, f, d in zip(self.means, self.factors, self.logdets)]
        return part[1] - part[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> Discriminant | float:
    """Model of rows ``x`` with labels ``y``; the share of label 1 where a class has too few rows."""
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return float(y.mean()) if len(y) else 0.5
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - centre) / scale
    covs = [np.cov(z[y == k].T) for k in (0, 1)]
    weights = [(y == k).mean() for k in (0, 1)]
    pooled = weights[0] * covs[0] + weights[1] * covs[1]
    means, factors, logdets = [], [], []
    for k in (0, 1):
        cov = (1 - POOLED) * covs[k] + POOLED * pooled
        cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + 1e-6 * np.eye(len(cov))
        low = np.linalg.cholesky(cov)
        means.append(z[y == k].mean(axis=0))
        factors.append(np.linalg.inv(low))
        logdets.append(float(np.log(np.diag(low)).sum()))
    model = Discriminant(centre, scale, means, factors, logdets, 1.0, 0.0)
    d = np.clip(model.difference(x), -200, 200)
    a, b = 0.1, float(np.log(weights[1] / weights[0]))
    for _ in range(50):  # Newton steps of a two-parameter logistic fit, slightly damped
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -60, 60)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * d).sum() - 1e-3 * a, (y - p).sum()])
        h = np.array([[(w * d * d).sum() + 1e-3, (w * d).sum()], [(w * d).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -5, 5))
    model.slope, model.offset = max(a, 1e-3), b
    return model


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Discriminant | float:
    """Fit on labelled documents that are not held out, at most ``sample`` of them; a document with several texts counts for each."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = usable.count()
    share = min(1.0, sample / max(1, known))
    some = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select(
        "doc_id", F.col("quality").cast("int").alias("quality"))
    # the sample is bounded by SAMPLE rows of two numbers, so it may be broadcast
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(some), "doc_id")

    def measured(batches):
        for b in batches:
            yield {"quality": b["quality"], "x": [statistics(t) for t in b["text"]], "doc_id": b["doc_id"]}

    # equal rows count once, and no more than the bound are collected: a repeated doc_id may have any number of rows
    listed = map_rows(rows, measured, "doc_id long, quality int, x array<double>").distinct()
    got = listed.orderBy(F.xxhash64("doc_id", "quality", "x"), "doc_id", "quality", "x").limit(sample).collect()
    got.sort(key=lambda r: (r["doc_id"], r["quality"], r["x"]))
    if not got:
        return 0.5
    return fit(np.array([r["x"] for r in got]), np.array([r["quality"] for r in got]))


def scores(model: Discriminant | float, texts: list[str | None]) -> np.ndarray:
    if isinstance(model, float) or not texts:
        return np.full(len(texts), model if isinstance(model, float) else 0.5)
    return model.score(np.array([statistics(t) for t in texts]))


def score_documents(docs: DataFrame, model: Discriminant | float) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row."""
    def rows(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": scores(model, b["text"])}

    scored = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: Discriminant | float) -> DataFrame:
    """The documents of sufficient quality, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            yield b.filter(pa.array(scores(model, texts) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
