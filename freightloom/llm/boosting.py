"""Gradient-boosted trees for binary labels, on binned features.

``fit`` takes arrays; ``fit_counted`` the same method for a table of any size: each level of a tree is one pass over the distinct
binned rows, of which sums by node, feature and bin come back.  Sums are of whole numbers, so their order cannot show.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept, map_rows

#: Gradients are summed as whole numbers of this fraction.
UNIT = 1 << 24
BINS, DEPTH, ROUNDS, RATE, LEAST, SMOOTH = 32, 3, 40, 0.2, 1.0, 1.0


@dataclass
class Trees:
    """Bin edges per feature, and complete trees: (feature, bin) per inner node, value per leaf."""

    edges: list[np.ndarray]
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            out += value[_leaf(b, feature, cut)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def _leaf(b: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    at, rows = np.zeros(len(b), np.int64), np.arange(len(b))
    for _ in range(DEPTH):
        at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
    return at - (2 ** DEPTH - 1)


def _best(b: np.ndarray, g: np.ndarray, h: np.ndarray, width: int) -> tuple[int, int]:
    """Feature and bin of the split with the largest gain; a bin past the end where none helps."""
    best, choice = 1e-6, (0, width)
    total_g, total_h = g.sum(), h.sum()
    for f in range(b.shape[1]):
        left_g = np.cumsum(np.bincount(b[:, f], g, width))[:-1]
        left_h = np.cumsum(np.bincount(b[:, f], h, width))[:-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g ** 2 / (left_h + SMOOTH) + right_g ** 2 / (right_h + SMOOTH) - total_g ** 2 / (total_h + SMOOTH)
        gain[(left_h < LEAST) | (right_h < LEAST)] = 0
        if gain.max() > best:
            best, choice = gain.max(), (f, int(gain.argmax()))
    return choice


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to the logistic loss; a constant where there is one class only."""
    quantiles = np.linspace(0, 1, BINS)[1:-1]
    model = Trees([np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])])
    share = (y.sum() + 1) / (len(y) + 2)
    model.base = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    b, width = model.bins(x), BINS
    margin = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        inner = 2 ** DEPTH - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, width)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            mine = at == node
            if mine.any():
                feature[node], cut[node] = _best(b[mine], g[mine], h[mine], width)
                at[mine] = 2 * node + 1 + (b[mine, feature[node]] > cut[node])
        leaf = at - inner
        value = RATE * np.bincount(leaf, g, 2 ** DEPTH) / (np.bincount(leaf, h, 2 ** DEPTH) + SMOOTH)
        margin += value[leaf]
        model.trees.append((feature, cut, value))
    return model


def packed(x: list[float]) -> bytes:
    """Whole-numbered features of a row as a key."""
    return np.asarray(x, "<i2").tobytes()


def _unpacked(rows: list[bytes], kind: str = "<i2") -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _quantiles(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The inner bin edges of ``fit`` from counted values."""
    ends = np.cumsum(counts)
    at = np.linspace(0, 1, BINS)[1:-1] * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, f(at), side="right")].astype(float) for f in (np.floor, np.ceil))
    part, step = at - np.floor(at), high - low
    return np.unique(np.where(part >= 0.5, high - step * (1 - part), low + step * part))


def _edges(rows: DataFrame) -> list[np.ndarray]:
    def values(batches):
        for b in batches:
            x, n = _unpacked(b["x"]), np.array(b["n"])
            for f in range(x.shape[1]):
                got, at = np.unique(x[:, f], return_inverse=True)
                yield {"feature": [f] * len(got), "value": got.tolist(), "n": np.bincount(at, n).astype(np.int64).tolist()}

    counted = map_rows(rows, values, "feature int, value int, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    found = np.array([tuple(r) for r in counted.collect()], np.int64)
    out = []
    for f in range(int(found[:, 0].max()) + 1):
        mine = found[found[:, 0] == f]
        mine = mine[np.argsort(mine[:, 1])]
        out.append(_quantiles(mine[:, 1], mine[:, 2]))
    return out


def _level(rows: DataFrame, model: Trees, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Sums of gradients and curvatures of the nodes of one level: [node, feature, bin, 2]."""
    width, nodes, count = BINS, 2 ** depth, len(model.edges)

    def sums(batches):
        out = np.zeros((2, nodes * count * width), np.int64)
        for batch in batches:
            b = _unpacked(batch["bins"], "u1").astype(np.int64)
            n, y, margin = np.array(batch["n"]), np.array(batch["y"]), np.full(len(b), model.base)
            for f, c, value in model.trees:
                margin += value[_leaf(b, f, c)]
            p, at, row = 1 / (1 + np.exp(-margin)), np.zeros(len(b), np.int64), np.arange(len(b))
            for _ in range(depth):
                at = 2 * at + 1 + (b[row, feature[at]] > cut[at])
            cells = (((at - (nodes - 1))[:, None] * count + np.arange(count)) * width + b).ravel()
            for k, part in enumerate((y - n * p, n * p * (1 - p))):
                np.add.at(out[k], cells, np.repeat(np.rint(part * UNIT).astype(np.int64), count))
        some = np.nonzero(out.any(axis=0))[0]
        yield {"cell": some.tolist(), "g": out[0, some].tolist(), "h": out[1, some].tolist()}

    got = map_rows(rows, sums, "cell int, g long, h long").groupBy("cell").agg(F.sum("g"), F.sum("h")).collect()
    out = np.zeros((nodes * count * width, 2))
    for cell, g, h in got:
        out[cell] = g / UNIT, h / UNIT
    return out.reshape(nodes, count, width, 2)


def _split(sums: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
    """``_best`` from sums by feature and bin, and the sums of both sides."""
    total, left = sums[0].sum(axis=0), np.cumsum(sums, axis=1)[:, :-1]
    right = total - left
    gain = (left[..., 0] ** 2 / (left[..., 1] + SMOOTH) + right[..., 0] ** 2 / (right[..., 1] + SMOOTH)
            - total[0] ** 2 / (total[1] + SMOOTH))
    gain[(left[..., 1] < LEAST) | (right[..., 1] < LEAST)] = 0
    f, c = np.unravel_index(gain.argmax(), gain.shape)
    if gain[f, c] <= 1e-6:
        return 0, BINS, total, np.zeros(2)
    return int(f), int(c), left[f, c], right[f, c]


def fit_counted(rows: DataFrame, folder: str) -> Trees:
    """``fit`` on all rows of a written table (x packed, n rows, y of them positive), which stay where they are.

    The driver gets counts by feature and value and sums by node, feature and bin.
    """
    total, right = rows.agg(F.sum("n"), F.sum("y")).first()
    model = Trees(_edges(rows))
    share = (right + 1) / (total + 2)
    model.base = float(np.log(share / (1 - share)))
    if right in (0, total):
        return model

    def binned(batches):
        for b in batches:
            if b["x"]:
                yield {"bins": [r.tobytes() for r in model.bins(_unpacked(b["x"])).astype("u1")], "n": b["n"], "y": b["y"]}

    distinct = kept(map_rows(rows, binned, "bins binary, n long, y long").groupBy("bins").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y")), folder, "binned")
    inner = 2 ** DEPTH - 1
    for _ in range(ROUNDS):
        feature, cut, value = np.zeros(inner, np.int64), np.full(inner, BINS), np.zeros(2 ** DEPTH)
        for depth in range(DEPTH):
            for i, sums in enumerate(_level(distinct, model, feature, cut, depth)):
                node = 2 ** depth - 1 + i
                feature[node], cut[node], *sides = _split(sums)
                if depth == DEPTH - 1:
                    value[2 * i:2 * i + 2] = [RATE * g / (h + SMOOTH) for g, h in sides]
        model.trees.append((feature, cut, value))
    return model
