"""Approximate nearest neighbours by a permutation index; nearness is the inner product.

A vector is told by its ``PREFIX`` nearest pivots in order.  Pivots are ``PIVOTS`` vectors of the table itself, those
of the smallest hashes, so every run picks the same ones; every row is indexed.  The index is a written table of
blocks of up to ``BLOCK`` vectors.  A block holds its ids, its vectors and one inverted file per pivot: the rows
that have the pivot in their prefix, with the pivot's weight there (``PREFIX`` less its place).  Of two prefixes the
footrule distance, missing pivots counted at place ``PREFIX``, is PREFIX * (PREFIX + 1) less twice the sum, over
shared pivots, of the smaller weight; a query adds up those sums from the files of its own pivots.  The rows of a block whose footrule is
among the best ``SHARE`` (``LEAST`` rows at least, ties included) are reranked by their exact inner products, which are
summed in order only where a matrix product, less its rounding, leaves the row a chance.

Queries meet all blocks, ``QUERIES`` at a time: that many are sent to all tasks (a bound of their bytes), each job reads the
index once, and a task keeps the best ``k`` of each query.  The sum of a score runs over the components in order, in doubles.

Nulls, ties and odd rows: a vector that is NULL, zero, or holds a NULL or non-finite component takes no part, nor does
one of another size than most rows have (the smaller size if two are as frequent).  A NULL ``vec_id`` is never a query and comes
after all others of its score.  Equal scores go to the smaller ``vec_id``, then to the row read first; rows that repeat
an id are rows of their own, and only a query's own row is left out.  A score that overflows to no number comes last.  Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freightloom.llm.common import kept

PIVOTS, PREFIX, BLOCK = 256, 64, 4096
#: Share of a block's rows that is reranked, and the least number of rows.
SHARE, LEAST = 0.15, 512
#: Queries sent out at once, and queries a block is searched for at a time.
QUERIES, STEP = 8192, 256
#: Id that stands for NULL: it sorts last and is turned back at the end.
LAST = np.iinfo(np.int64).max

INDEX = "rows int, row binary, vec_id binary, vectors binary, starts binary, posted binary, weights binary"
HITS = "query long, vec_id long, hit long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """row, vec_id and ``v`` (doubles) of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.when(fine & some, F.col("embedding").cast("array<double>")).alias("v")).where("v IS NOT NULL")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def pivots(rows: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """The ``count`` different vectors of the smallest hashes."""
    found = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(count).collect()
    return np.array([r["v"] for r in found], float).reshape(len(found), len(found[0]["v"]) if found else 0)


def prefixes(v: np.ndarray, pivot: np.ndarray, length: int) -> np.ndarray:
    """Per vector the numbers of its nearest pivots in order, equal ones by number."""
    with np.errstate(over="ignore", invalid="ignore"):
        near = np.zeros((len(v), len(pivot)))
        for d in range(v.shape[1]):  # in the order of a score, so that equal vectors have equal prefixes
            near += v[:, d, None] * pivot[:, d]
    return np.argsort(-np.nan_to_num(near, nan=-np.inf), axis=1, kind="stable")[:, :length]


def inverted(prefix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each pivot's file, the rows posted and their weights, file after file."""
    length = prefix.shape[1]
    order = np.argsort(prefix.ravel(), kind="stable")
    starts = np.searchsorted(prefix.ravel()[order], np.arange(count + 1))
    return starts.astype("<i4"), (order // length).astype("<u2"), (length - order % length).astype("<u2")


def build(rows: DataFrame, pivot: np.ndarray, length: int, block: int = BLOCK) -> DataFrame:
    """Index blocks of ``usable``'s rows."""
    schema = pa.schema([("rows", pa.int32()), *((c, pa.binary()) for c in (
        "row", "vec_id", "vectors", "starts", "posted", "weights"))])

    def pack(row, ids, v):
        for at in range(0, len(ids), block):
            part = v[at:at + block]
            starts, posted, weights = inverted(prefixes(part, pivot, length), len(pivot))
            yield pa.RecordBatch.from_pylist([{
                "rows": len(part), "row": row[at:at + block].tobytes(), "vec_id": ids[at:at + block].tobytes(),
                "vectors": part.astype("<f8").tobytes(), "starts": starts.tobytes(), "posted": posted.tobytes(),
                "weights": weights.tobytes()}], schema=schema)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            if not (n := batch.num_rows):
                continue
            held.append((batch.column("row").to_numpy().astype("<i8"),
                         batch.column("vec_id").fill_null(LAST).to_numpy().astype("<i8"),
                         batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)))
            if sum(len(h[0]) for h in held) >= block:
                yield from pack(*map(np.concatenate, zip(*held)))
                held = []
        if held:
            yield from pack(*map(np.concatenate, zip(*held)))

    return rows.mapInArrow(run, INDEX)


class Best:
    """The best ``k`` (score, id, row) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), LAST, np.int64)
        self.rows = np.full((queries, k), -1, np.int64)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        have = self.rows[q] >= 0
        score, ids, rows = (np.concatenate([old[q][have], new]) for old, new in (
            (self.score, score), (self.ids, ids), (self.rows, rows)))
        best = np.lexsort((rows, ids, -score))[:self.k]
        for kept_, new in ((self.score, score), (self.ids, ids), (self.rows, rows)):
            kept_[q, :len(best)] = new[best]


def unrolled(block: dict, rows: int) -> np.ndarray:
    """Pivots by rows: the weights of the inverted files at their rows, 0 for rows a file does not have."""
    starts, posted, weights = (np.frombuffer(block[c], t) for c, t in (("starts", "<i4"), ("posted", "<u2"), ("weights", "<u2")))
    out = np.zeros((len(starts) - 1, rows), np.uint8 if weights.max(initial=0) < 256 else np.uint16)
    out[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), posted] = weights
    return out


def overlap(block: dict, prefix: np.ndarray, rows: int, files: np.ndarray | None = None) -> np.ndarray:
    """Queries by rows: the sum of the smaller weights over shared pivots, from the inverted files."""
    files = unrolled(block, rows) if files is None else files
    length = prefix.shape[1]
    own = np.arange(length, 0, -1).astype(files.dtype)[:, None]
    total = np.zeros((len(prefix), rows), np.int32)
    for q, mine in enumerate(prefix):
        smaller = files[mine]
        np.minimum(smaller, own, out=smaller)
        # the largest sum is 1 + ... + length
        total[q] = np.add.reduce(smaller, axis=0, dtype=np.uint16 if length < 362 else np.int32)
    return total


def hopeful(near: np.ndarray, slack: float, k: int, worst: float) -> np.ndarray:
    """Which rows may be among the best ``k``, by products that are off by ``slack`` at most; ``worst`` is the score to beat."""
    if not np.isfinite(slack) or not np.isfinite(near).all():
        return np.ones(len(near), bool)
    edge = np.partition(near, len(near) - k)[len(near) - k] - slack if len(near) > k else -np.inf
    return near >= max(edge, worst) - slack


def search_block(block: dict, best: Best, row: np.ndarray, v: np.ndarray, prefix: np.ndarray,
                 share: float = SHARE, least: int = LEAST) -> None:
    """Meet one block with all queries: footrule ranks, then exact inner products of the best."""
    n = block["rows"]
    rows, ids = (np.frombuffer(block[c], "<i8") for c in ("row", "vec_id"))
    vectors = np.frombuffer(block["vectors"], "<f8").reshape(n, -1)
    wanted = min(n, max(least, int(np.ceil(share * n))))
    files = unrolled(block, n)
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt((vectors * vectors).sum(axis=1).max())
    for at in range(0, len(row), STEP):
        shared = overlap(block, prefix[at:at + STEP], n, files)  # more shared weight, less footrule
        edge = np.partition(shared, n - wanted, axis=1)[:, n - wanted]
        asked = v[at:at + STEP]
        with np.errstate(over="ignore", invalid="ignore"):
            # sums in any order differ from the score by the rounding of as many additions, here doubled
            near = asked @ vectors.T
            slack = asked.shape[1] * 2.0 ** -51 * length * np.sqrt((asked * asked).sum(axis=1)) + 1e-300
        for j in range(len(shared)):
            q = at + j
            found = np.flatnonzero((shared[j] >= edge[j]) & (rows != row[q]))
            worst = best.score[q].min() if best.rows[q].min() >= 0 else -np.inf
            found = found[hopeful(near[j, found], slack[j], best.k, worst)]
            with np.errstate(over="ignore", invalid="ignore"):
                # cumsum adds the components in order
                score = np.cumsum(vectors[found] * v[q], axis=1)[:, -1]
            best.add(q, np.nan_to_num(score, nan=-np.inf, posinf=np.inf, neginf=-np.inf), ids[found], rows[found])


def search(index: DataFrame, queries: list, pivot: np.ndarray, length: int, k: int, share: float = SHARE,
           least: int = LEAST) -> DataFrame:
    """query (its row), vec_id, hit (its row) and score: the best ``k`` of each task, for one block of queries."""
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast((
        np.array([q["row"] for q in queries], np.int64), np.array([q["v"] for q in queries], float)))

    def run(batches):
        row, v = sent.value
        prefix, best = prefixes(v, pivot, length), Best(len(row), k)
        for batch in batches:
            for at in range(batch.num_rows):
                search_block(batch.slice(at, 1).to_pylist()[0], best, row, v, prefix, share, least)
        for at in range(0, len(row), STEP):
            have = best.rows[at:at + STEP] >= 0
            ids = best.ids[at:at + STEP][have]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(row[at:at + STEP], have.sum(axis=1))), pa.array(ids, mask=ids == LAST),
                 pa.array(best.rows[at:at + STEP][have]), pa.array(best.score[at:at + STEP][have])],
                ["query", "vec_id", "hit", "score"])

    return index.mapInArrow(run, HITS)


def nearest(vectors: DataFrame, folder: str, k: int, every: int, share: float = SHARE, least: int = LEAST,
            at_once: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` nearest found of each vector whose id ``every`` divides."""
    rows = kept(usable(vectors), folder, "vectors")
    pivot = pivots(rows)
    length = min(PREFIX, len(pivot))
    index = kept(build(rows, pivot, length), folder, "index")
    asked = rows.where(F.col("vec_id") % every == 0)
    parts = -(-asked.count() // at_once)
    # queries are dealt by the hash of their row; a part is cut at ``at_once`` rows, the rest joins the next round
    numbered = asked.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(max(1, parts))))
    numbered = kept(numbered, folder, "queries")
    turn = 0
    for part in range(parts):
        last = -1
        while True:
            some = numbered.where((F.col("part") == part) & (F.col("row") > last)).orderBy("row").limit(at_once).collect()
            if not some:
                break
            last, turn = some[-1]["row"], turn + 1
            kept(search(index, some, pivot, length, k, share, least), folder, f"hits/{turn}")
    if not turn:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    found = index.sparkSession.read.schema(HITS).option("recursiveFileLookup", True).parquet(f"{folder}/hits")
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "hit")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = numbered.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", "rank", "vec_id", "score")
