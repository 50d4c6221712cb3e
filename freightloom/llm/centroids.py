"""Centroid clustering over subvector dictionaries, in whole numbers.

Components become integers floor(1024 * x).  Vectors are gathered to chunks of up to ``CHUNK`` rows; a chunk's
dimensions are cut into blocks, and each block is dictionary-encoded without loss: its distinct subvectors once and
one code per row.  A block is as wide as pays: neighbouring blocks are merged, up to 8 dimensions, while the merged dictionary is no
larger than ``WORTH`` of the rows, so repeated vectors meet in wide blocks and unlike ones in single components.  The encoded
table is written once.  In a round, the squared distances of a block's distinct subvectors to all centroids are computed
once, and a row's distance is the sum of its codes' entries.  A cluster's sum is the dictionary weighted by how often each code
falls into the cluster.  Tasks send one row per cluster and chunk, summed by Spark; the driver sees the centroids
alone.  All sums are exact, so neither chunks nor retries can change a result.

Nulls, ties and odd rows: a vector that is NULL, of another size, or holds a NULL or non-finite component takes no
part, nor does one with a component of 131,072 (2^27 / 1024) or more in size, whose squared distance a long may not
hold.  A NULL ``vec_id`` takes part; its text is empty where ids are hashed.  Repeated rows are rows of their own; among
equal hashes the smaller vector comes first, so with repeated ids several centroids may start alike.  With
fewer vectors than clusters there are fewer centroids.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Rows a chunk holds at most, the widest block, the share of rows a dictionary may reach, and the bound of a component.
CHUNK, WIDEST, WORTH, BOUND = 8192, 8, 0.5, 1 << 27

ENCODED = "rows int, vec_id binary, empty binary, widths array<int>, sizes array<int>, subvectors array<binary>, codes array<binary>"


def whole(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and ``parts``, the integer components, of the vectors that take part."""
    x = F.transform("embedding", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < BOUND / scale))
    return vectors.where((F.size("embedding") == size) & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: v.cast("int")).alias("parts"))


def blocks(rows: np.ndarray, worth: float = WORTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct subvectors, code per row) of the dimension blocks of ``rows``, from left to right."""
    def encode(low: int, high: int):
        if high - low == 1:
            found, code = np.unique(rows[:, low], return_inverse=True)
            return [(found[:, None], code)]
        left, right = encode(low, (low + high) // 2), encode((low + high) // 2, high)
        if len(left) == len(right) == 1:
            (first, a), (second, b) = *left, *right
            pair, code = np.unique(a * len(second) + b, return_inverse=True)
            if len(pair) <= worth * len(rows):
                return [(np.hstack([first[pair // len(second)], second[pair % len(second)]]), code)]
        return left + right

    return [b for low in range(0, rows.shape[1], WIDEST) for b in encode(low, min(low + WIDEST, rows.shape[1]))]


def encoded(points: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunks of ``whole``'s rows: ids, and per block its width, dictionary size, distinct subvectors and codes."""
    def run(batches):
        ids, parts, held = [], [], 0
        for batch in batches:
            if not (n := batch.num_rows):
                continue
            ids.append(batch.column("vec_id"))
            parts.append(batch.column("parts").flatten().to_numpy(zero_copy_only=False).reshape(n, -1))
            held += n
            if held >= chunk:
                yield from pack(pa.concat_arrays(ids), np.concatenate(parts))
                ids, parts, held = [], [], 0
        if held:
            yield from pack(pa.concat_arrays(ids), np.concatenate(parts))

    def pack(ids, rows):
        for at in range(0, len(ids), chunk):
            some, part = ids.slice(at, chunk), rows[at:at + chunk].astype("<i4")
            found = blocks(part)
            out = {"rows": len(part), "vec_id": some.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                   "empty": np.asarray(some.is_null().to_numpy(zero_copy_only=False), np.uint8).tobytes(),
                   "widths": [d.shape[1] for d, _ in found], "sizes": [len(d) for d, _ in found],
                   "subvectors": [d.astype("<i4").tobytes() for d, _ in found],
                   "codes": [c.astype("<u2").tobytes() for _, c in found]}
            yield pa.RecordBatch.from_pylist([out], schema=schema)

    schema = pa.schema([("rows", pa.int32()), ("vec_id", pa.binary()), ("empty", pa.binary()),
                        ("widths", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())),
                        ("subvectors", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary()))])
    return points.mapInArrow(run, ENCODED)


def chunk_blocks(row: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """(subvectors, codes) of an encoded chunk."""
    return [(np.frombuffer(d, "<i4").reshape(n, w).astype(np.int64), np.frombuffer(c, "<u2"))
            for d, c, n, w in zip(row["subvectors"], row["codes"], row["sizes"], row["widths"])]


def nearest(parts: list[tuple[np.ndarray, np.ndarray]], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance per row: partial distances of distinct subvectors, summed by code."""
    total, low = 0, 0
    for subvectors, code in parts:
        here = centroids[:, low:low + subvectors.shape[1]]
        low += subvectors.shape[1]
        partial = ((subvectors[:, None] - here) ** 2).sum(axis=2)
        total = total + partial[code]
    cluster = total.argmin(axis=1)  # the first of equals, so the smaller number
    return cluster, total[np.arange(len(total)), cluster]


def _sums(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, count and the sum of each component, over all chunks."""
    size = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                parts = chunk_blocks(row)
                cluster, _ = nearest(parts, centroids)
                counts, sums = np.bincount(cluster, minlength=len(centroids)), []
                for subvectors, code in parts:
                    times = np.bincount(cluster * len(subvectors) + code, minlength=len(centroids) * len(subvectors))
                    sums.append(times.reshape(len(centroids), -1) @ subvectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(centroids)), pa.int32()), pa.array(counts, pa.int64()),
                     pa.array(np.concatenate(sums, axis=1).tolist(), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    per_chunk = chunks.mapInArrow(run, "cluster int, n long, s array<long>")
    return per_chunk.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("s")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(size)])


def first_centroids(points: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """Vectors of the smallest hashes of ``seed:vec_id``, in hash order."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.orderBy(named, "parts").limit(clusters).collect()
    return np.array([r["parts"] for r in rows], np.int64).reshape(len(rows), SIZE)


def learn(points: DataFrame, chunks: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids after ``rounds`` of assigning and averaging (floor of the exact mean; an empty cluster keeps its own)."""
    centroids = first_centroids(points, clusters)
    for _ in range(rounds if len(centroids) else 0):
        centroids = centroids.copy()
        for row in _sums(chunks, centroids).collect():  # one row per centroid
            if row["n"]:
                centroids[row["cluster"]] = [int(row[f"s{d}"]) // row["n"] for d in range(centroids.shape[1])]
    return centroids


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every vector."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cluster, distance = nearest(chunk_blocks(row), centroids)
                ids = pa.array(np.frombuffer(row["vec_id"], "<i8"), mask=np.frombuffer(row["empty"], np.uint8) == 1)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def _by_cluster(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])[F.col("cluster")]


def cluster(vectors: DataFrame, folder: str, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    points = whole(vectors)
    chunks = kept(encoded(points), folder, "chunks")
    centroids = learn(points, chunks, clusters, rounds)
    rows = kept(assigned(chunks, centroids), folder, "assigned")
    if not len(centroids):
        return rows.select("*", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                           F.lit("").alias("centroid_sha256"))
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(
        F.try_sum("distance").alias("s")).collect()}  # one row per centroid; NULL where a long cannot hold it
    within = [sums.get(k, 0) for k in range(len(centroids))]
    total = None if None in within or sum(within) >= 1 << 63 else sum(within)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return rows.select(
        "vec_id", "cluster", "distance", _by_cluster(within).cast("long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), _by_cluster(digests).alias("centroid_sha256"))
