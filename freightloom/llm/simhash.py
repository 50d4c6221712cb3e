"""SimHash near-duplicates by multi-index hashing.

Fingerprints are made where the text is read.  Distinct fingerprints are kept in two tables, one per 32-bit
half.  Of two fingerprints at most three bits apart, one half differs in at most one bit, so each fingerprint
looks up the Hamming ball of radius one around each of its halves and the complete distance is verified in the
join.  A ball is probed only by clearing set bits: of two halves one bit apart, the one with the bit set finds
the other.  A fingerprint has no more than 43,744 others within three bits, which bounds its links.

Nulls, empty texts and ties: a NULL text is an empty one; a text without words has fingerprint zero and links
like any other; repeated rows each get a row; a NULL ``doc_id`` gets a row and never names a component unless
it has no other member (then NULL).  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept, map_rows, place
from freightloom.llm.components import components

BITS, HALF, RADIUS, WORDS, SEED = 64, 32, 3, 3, 42
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
STEP = 1 << 20


def words(text: str) -> Iterator[list[bytes]]:
    """Lower-cased words in lists from about a megabyte of text each."""
    data, left = text.encode("utf-8", "surrogatepass").translate(LOWER), b""
    for at in range(0, len(data), STEP):
        piece = left + data[at:at + STEP]
        found = piece.split()
        left = found.pop() if found and at + STEP < len(data) and not piece[-1:].isspace() else b""
        yield found
    if left:
        yield [left]


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of word shingles; see the contract in the module text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    counts, total, before = np.zeros(BITS, np.int64), 0, []
    for found in words(text or ""):
        run = before + found
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(run[i:] for i in range(WORDS)))]
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        before = run[-(WORDS - 1):]
    if not total and before:
        return digest(b" ".join(before), SEED)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, row: str | None = None) -> DataFrame:
    """row (a column of the table or a new number), doc_id and fp, the fingerprint as a signed long."""
    def rows(batches):
        for b in batches:
            yield {"row": b["row"], "doc_id": b["doc_id"],
                   "fp": [int(np.uint64(fingerprint(t)).astype(np.int64)) for t in b["text"]]}

    number = F.col(row) if row else F.monotonically_increasing_id()
    return map_rows(docs.select(number.alias("row"), F.col("doc_id").cast("long"), "text"), rows,
                    "row long, doc_id long, fp long")


def _half(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, HALF * k).bitwiseAND(F.lit((1 << HALF) - 1))


def _ball(key: Column) -> Column:
    """The key itself (own) and every key with one of its set bits cleared."""
    one = F.lit(1).cast("long")
    cleared = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda i: F.getbit(key, i) == 1),
        lambda i: F.struct((key - F.call_function("shiftleft", one, i)).alias("key"), F.lit(False).alias("own")))
    return F.concat(F.array(F.struct(key.alias("key"), F.lit(True).alias("own"))), cleared)


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) at most RADIUS bits apart."""
    halves = prints.select("fp", F.explode(F.array(*(
        F.struct(F.lit(k).alias("half"), _half(F.col("fp"), k).alias("key")) for k in (0, 1)))).alias("h"))
    homes = halves.select(F.col("fp").alias("b"), "h.half", "h.key")
    probes = halves.select(F.col("fp").alias("a"), "h.half", F.explode(_ball(F.col("h.key"))).alias("p")).select(
        "a", "half", "p.key", "p.own")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    once = F.when(F.col("own"), F.col("a") > F.col("b")).otherwise(F.lit(True))
    # the exploded tables look as small as what they were made from: never broadcast them
    return probes.join(
        homes.hint("merge"), (probes.half == homes.half) & (probes.key == homes.key) & apart.between(1, RADIUS) & once,
    ).select("a", "b")


def simhash_dedup(docs: DataFrame, folder: str, row: str | None = None) -> DataFrame:
    """row, doc_id, fingerprint (16 hex digits), component_id and kept (the first row of its component)."""
    prints = kept(fingerprints(docs, row), folder, "prints").withColumn("place", place())
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("place").alias("first"))
    stars = components(links(distinct.select("fp")), folder)
    rooted = distinct.join(stars, distinct.fp == stars.u, "left").select(
        "fp", "least", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("head"))
    # written, so that both sides of the last join are plain shuffles, which adaptive execution splits at a hot fingerprint
    classes = kept(rooted.join(named, "root").select("fp", "component_id", "head"), folder, "classes")
    return prints.join(classes, "fp").select(
        "row", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("place") == F.col("head")).alias("kept"))
