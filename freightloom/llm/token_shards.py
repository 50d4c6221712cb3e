"""Token shards on disk with a minimal perfect hash index.

A shard is a row of raw ids (little-endian, fixed width) with the ids and lengths of its documents; shards follow
ascending ``doc_id``.  Spark's own writer commits them, so a lost or repeated task leaves no partial shard.

The index deals keys to buckets by their hash.  Each bucket is a minimal perfect hash (hash, displace): n slots
for n keys, one pilot number per small group of keys, and in each slot a 32-bit fingerprint, the place and the
length.  A key is found by one bucket row, one pilot and one slot; a key that was never stored is told by its
fingerprint (wrong once in four billion).

Nulls, empty texts and ties: a NULL or empty text has only the end id (no ids without one).  Of repeated
``doc_id``s every row is written, ordered by text, and found as copy 0, 1, ... of the key; NULL is a key like
others and comes first.  ``doc_id`` is meant to be nearly unique: all rows of one id are written by one task,
in a stream.  Other columns are ignored.  An empty table gives empty files and results.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.llm.bpe import Encoder
from freightloom.llm.common import map_rows

#: Ids in a shard at least (a longer document is a shard of its own), keys per index bucket, keys per pilot.
SHARD_IDS, BUCKET_KEYS, PILOT_KEYS = 1 << 20, 2048, 4
#: Pilots tried before a bucket starts afresh with another salt.
TRIES = 1 << 17
SHARD = "part int, seq int, at long, n_ids long, first_copy long, width int, doc_ids binary, lengths binary, payload binary"
BUCKET = "bucket long, n int, salt long, pilots binary, prints binary, parts binary, seqs binary, places binary, " \
         "starts binary, lengths binary"
#: Keys that ``fetch`` looks up on their own; their places fit a broadcast of a megabyte.
FEW = 10_000
#: Stands for NULL among document ids.
NONE = -(1 << 63)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    return mix(doc_ids.astype("<i8").view("<u8") ^ mix(copies.astype("<u8")))


def copies_of(doc_ids: np.ndarray, first: int = 0) -> np.ndarray:
    """Ordinal of each element among equal neighbours; the leading one is number ``first``."""
    at = np.arange(len(doc_ids))
    new = np.r_[True, doc_ids[1:] != doc_ids[:-1]] if len(at) else np.zeros(0, bool)
    copies = at - np.maximum.accumulate(np.where(new, at, 0))
    return copies + first * (np.cumsum(new) == 1)


def _slots(h: np.ndarray, pilot, n: int) -> np.ndarray:
    return mix(h + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(pilot, "<u8") + np.uint64(1))) % np.uint64(n)


def _groups(h: np.ndarray, n: int) -> np.ndarray:
    return (mix(h ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(-(-n // PILOT_KEYS))).astype(np.int64)


def _pilot(h: np.ndarray, free: np.ndarray) -> tuple[int, np.ndarray] | None:
    """Smallest pilot that sends a group of keys to free, different slots."""
    for low in range(0, TRIES, 128):
        tried = _slots(h[None, :], np.arange(low, low + 128)[:, None], len(free)).astype(np.int64)
        good = free[tried].all(axis=1)
        if len(h) > 1:
            ordered = np.sort(tried, axis=1)
            good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
        if good.any():
            return low + int(good.argmax()), tried[good.argmax()]
    return None


def build_hash(h: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(salt, pilots, slot of each key) of a minimal perfect hash over distinct 64-bit hashes."""
    n, salt = len(h), 0
    if len(np.unique(h)) < n:
        raise ValueError("two keys of the index have one hash")
    while True:
        salted = h + np.uint64(salt)
        group = _groups(salted, n)
        sizes = np.bincount(group, minlength=-(-n // PILOT_KEYS))
        members = np.split(np.argsort(group, kind="stable"), np.cumsum(sizes)[:-1])
        pilots, slot, free = np.zeros(len(members), "<u4"), np.zeros(n, np.int64), np.ones(n, bool)
        for g in np.argsort(-sizes, kind="stable").tolist():
            if not sizes[g]:
                continue
            if (found := _pilot(salted[members[g]], free)) is None:
                break
            pilots[g], slot[members[g]] = found
            free[found[1]] = False
        else:
            return salt, pilots, slot
        salt += 1


def find_slots(h: np.ndarray, n: int, salt: int, pilots: np.ndarray) -> np.ndarray:
    salted = h + np.uint64(salt)
    return _slots(salted, pilots[_groups(salted, n)], n).astype(np.int64)


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype("<u4")


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 2) -> None:
    """Write ``shards``, ``bases`` (ids before each part) and ``index`` below ``path``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, "doc_id")
              .sortWithinPartitions("doc_id", "text"))

    def pack(batches):
        from pyspark import TaskContext

        coder, part = Encoder.of(tokenizer), TaskContext.get().partitionId()
        end = b"" if end_id is None else np.array([end_id], coder.kind).tobytes()
        width = np.dtype(coder.kind).itemsize
        seq = at = size = copy = first = 0
        ids: list[int] = []
        bodies: list[bytes] = []
        last = None

        def shard():
            return {"part": [part], "seq": [seq], "at": [at], "n_ids": [size], "first_copy": [first],
                    "width": [width], "doc_ids": [np.array(ids, "<i8").tobytes()],
                    "lengths": [(np.array([len(x) for x in bodies], "<i8") // width).tobytes()],
                    "payload": [b"".join(bodies)]}

        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                key = NONE if doc_id is None else doc_id
                copy = copy + 1 if key == last else 0
                first, last = first if ids else copy, key
                bodies.append(coder.encode(text) + end)
                ids.append(key)
                size += len(bodies[-1]) // width
                if size >= SHARD_IDS or len(ids) >= SHARD_IDS:
                    yield shard()
                    seq, at, size, ids, bodies = seq + 1, at + size, 0, [], []
        if ids:
            yield shard()

    # raw payloads: the file is the ids as they are, not compressed
    map_rows(ranged, pack, SHARD).write.option("compression", "uncompressed").parquet(f"{path}/shards")
    shards = read_shards(spark, path)
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # one per part
    bases, before = {}, 0
    for p in sorted(totals):
        bases[p], before = before, before + totals[p]
    spark.createDataFrame(list(bases.items()), "part int, base long").coalesce(1).write.parquet(f"{path}/bases")

    n_docs = shards.agg(F.coalesce(F.sum(F.length("lengths") / 8), F.lit(0)).cast("long")).first()[0]
    buckets = max(1, -(-n_docs // BUCKET_KEYS))
    listed = ["part", "seq", "at", "first_copy", "doc_ids", "lengths"]

    def entries(batches):
        for b in batches:
            for part, seq, at, first, raw, lens in zip(*(b[c] for c in listed)):
                ids, n = np.frombuffer(raw, "<i8"), np.frombuffer(lens, "<i8")
                h = key_hash(ids, copies_of(ids, first))
                yield {"bucket": (h % np.uint64(buckets)).astype(np.int64), "h": h.view("<i8"),
                       "part": np.full(len(ids), part, np.int32), "seq": np.full(len(ids), seq, np.int32),
                       "place": np.arange(len(ids), dtype=np.int32),
                       "start": bases[part] + at + np.cumsum(n) - n, "length": n}

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy().astype("<i8").view("<u8")
        salt, pilots, slot = build_hash(h)
        order = np.argsort(slot)

        def column(name, kind):
            return [pdf[name].to_numpy()[order].astype(kind).tobytes()]

        return pd.DataFrame({
            "bucket": pdf["bucket"].iloc[:1].to_numpy(), "n": [len(h)], "salt": [salt], "pilots": [pilots.tobytes()],
            "prints": [fingerprints(h)[order].tobytes()], "parts": column("part", "<i4"), "seqs": column("seq", "<i4"),
            "places": column("place", "<i4"), "starts": column("start", "<i8"), "lengths": column("length", "<i8")})

    (map_rows(shards.select(listed), entries,
              "bucket long, h long, part int, seq int, place int, start long, length long")
     .groupBy("bucket").applyInPandas(bucket, BUCKET).write.parquet(f"{path}/index"))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(f"{path}/shards")


def lookup(spark: SparkSession, path: str, keys: DataFrame, few: bool = False) -> DataFrame:
    """Places of stored keys: doc_id, copy, part, seq, place, start, n_tokens.  ``keys``: distinct (doc_id, copy).

    With ``few`` keys (at most ``FEW``) the scan of the index is told which buckets they are in.
    """
    index = spark.read.schema(BUCKET).parquet(f"{path}/index")
    buckets = index.agg(F.coalesce(F.max("bucket"), F.lit(0))).first()[0] + 1
    out = "doc_id long, copy long, part int, seq int, place int, start long, n_tokens long"

    def hashes(batches):
        for b in batches:
            ids = np.array([NONE if i is None else i for i in b["doc_id"]], "<i8")
            h = key_hash(ids, np.array(b["copy"], "<i8"))
            yield {"bucket": (h % np.uint64(buckets)).astype(np.int64), "h": h.view("<i8"),
                   "doc_id": b["doc_id"], "copy": b["copy"]}

    def find(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if held.empty or asked.empty:
            return pd.DataFrame({c.split()[0]: [] for c in out.split(", ")})
        row = held.iloc[0]
        h = asked["h"].to_numpy().astype("<i8").view("<u8")
        slot = find_slots(h, int(row["n"]), int(row["salt"]), np.frombuffer(row["pilots"], "<u4"))
        sure = np.frombuffer(row["prints"], "<u4")[slot] == fingerprints(h)

        def column(name, kind):
            return np.frombuffer(row[name], kind)[slot][sure]

        return pd.DataFrame({
            "doc_id": asked["doc_id"].array[sure], "copy": asked["copy"].to_numpy()[sure],
            "part": column("parts", "<i4"), "seq": column("seqs", "<i4"), "place": column("places", "<i4"),
            "start": column("starts", "<i8"), "n_tokens": column("lengths", "<i8")})

    hashed = map_rows(keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long")), hashes,
                      "bucket long, h long, doc_id long, copy long")
    if few:
        asked = [r.bucket for r in hashed.select("bucket").distinct().collect()]
        index = index.where(F.col("bucket").isin(asked))
    return hashed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, out)


def slices(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every stored document as read from the payloads: part, seq, place, ids_crc32 and, if asked for, the ids."""
    schema = "part int, seq int, place int, ids_crc32 long" + ", ids array<int>" * with_ids

    def rows(batches) -> Iterator[dict]:
        for b in batches:
            for part, seq, width, lens, body in zip(*(b[c] for c in ("part", "seq", "width", "lengths", "payload"))):
                n = np.frombuffer(lens, "<i8")
                flat, ends = np.frombuffer(body, f"<u{width}"), np.cumsum(n)
                cut = [flat[e - k:e].astype("<u4") for e, k in zip(ends, n)]
                out = {"part": [part] * len(n), "seq": [seq] * len(n), "place": list(range(len(n))),
                       "ids_crc32": [zlib.crc32(x.tobytes()) for x in cut]}
                yield out | ({"ids": [x.astype(np.int32) for x in cut]} if with_ids else {})

    return map_rows(read_shards(spark, path).select("part", "seq", "width", "lengths", "payload"), rows, schema)


def fetch(spark: SparkSession, path: str, keys: DataFrame, with_ids: bool = True) -> DataFrame:
    """The stored documents of ``keys`` (distinct doc_id, copy) by way of the index.

    Up to ``FEW`` keys, counted first, are found in their index buckets alone; their places go to the rows of the shards
    that hold them, other row groups are not read, and nothing but the asked places is cut.  More keys than that meet all
    stored documents by shuffles of places, so that payloads never move.
    """
    if keys.limit(FEW + 1).count() > FEW:
        found = lookup(spark, path, keys)
        return found.join(slices(spark, path, with_ids), ["part", "seq", "place"]).drop("part", "seq", "place")
    found = lookup(spark, path, keys, few=True).collect()
    asked = defaultdict(list)
    for r in found:
        asked[r.part, r.seq].append((r.place, r.doc_id, r.copy, r.start, r.n_tokens))
    places = spark.sparkContext.broadcast(dict(asked))
    schema = "doc_id long, copy long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    # both bounds reach the scan, which skips row groups by their statistics
    wanted = (F.col("part").isin(sorted({p for p, _ in asked})) & F.col("seq").isin(sorted({q for _, q in asked}))
              if asked else F.lit(False))

    def rows(batches) -> Iterator[dict]:
        for b in batches:
            for part, seq, width, lens, body in zip(*(b[c] for c in ("part", "seq", "width", "lengths", "payload"))):
                mine = places.value.get((part, seq), [])
                flat, ends = np.frombuffer(body, f"<u{width}"), np.cumsum(np.frombuffer(lens, "<i8"))
                cut = [flat[ends[p] - n:ends[p]].astype("<u4") for p, _, _, _, n in mine]
                names = ("doc_id", "copy", "start", "n_tokens")
                out = {name: [m[i] for m in mine] for i, name in enumerate(names, 1)}
                out["ids_crc32"] = [zlib.crc32(x.tobytes()) for x in cut]
                yield out | ({"ids": [x.astype(np.int32) for x in cut]} if with_ids else {})

    held = read_shards(spark, path).where(wanted).select("part", "seq", "width", "lengths", "payload")
    return map_rows(held, rows, schema)


def all_keys(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, copy) of a table."""
    counted = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("copy"))
