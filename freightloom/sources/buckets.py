"""Tables in hash buckets, of which a refresh rewrites only some.

Rows lie in folders of one bucket each below ``_parts``.  The manifest says which parts make up each bucket and what each
part was made from.  It is a table of committed versions (see ``versions``), one row for a part, so an append or a rewrite of some
buckets is seen whole or not at all, and buckets that are not touched keep their files.

The number of buckets is fixed for a table.  A manifest holds one row for each bucket and append since the last
``compact``; it is the only thing the driver reads.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.operators.keep_first import null_safe_key
from freightloom.sources import versions

PARTS, BUCKET, BUCKETS = "_parts", "_bucket", 256
#: Rows of a piece of a bucket (see ``cell_of``).
CELL = 60_000
MANIFEST = "bucket int, part string, made_from string, buckets int"


@dataclass(frozen=True, order=True)
class Part:
    """Folder name of a part and the text that tells what it was made from."""

    name: str
    made_from: str = ""


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a text key; the NULL key has one too."""
    return F.pmod(F.xxhash64(null_safe_key(key)), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict[int, list[Part]]:
    """Parts of every bucket as of the last commit, or of commit ``number``; none for a table not written yet."""
    out: dict[int, list[Part]] = defaultdict(list)
    if versions.exists(spark, path):
        for r in versions.read(spark, path, number).collect():
            out[r.bucket].append(Part(r.part, r.made_from))
    return {b: sorted(parts) for b, parts in out.items()}


def _last(spark: SparkSession, path: str) -> int:
    return (versions.commits(spark, path) or [-1])[-1]


def _commit(spark: SparkSession, path: str, parts: Mapping[int, Iterable[Part]], buckets: int, after: int) -> None:
    rows = [(b, p.name, p.made_from, buckets) for b, ps in sorted(parts.items()) for p in ps]
    versions.commit(spark, path, versions.stage(spark.createDataFrame(rows, MANIFEST).coalesce(1), path), after)


def _check(spark: SparkSession, path: str, buckets: int) -> None:
    if versions.exists(spark, path):
        other = versions.read(spark, path).where(F.col("buckets") != buckets).head(1)
        if other:
            raise ValueError(f"{path} has {other[0].buckets} buckets, not {buckets}")


def spread(df: DataFrame, key: Column, buckets: int = BUCKETS) -> DataFrame:
    """Rows rebalanced by bucket: adaptive execution joins small buckets in a task and splits a bucket that one key fills."""
    return df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET).drop(BUCKET)


def cell_of(key: Column, rows: int, buckets: int = BUCKETS) -> Column:
    """Number of a piece of a bucket that has all rows of its keys; of ``rows`` rows a piece has ``CELL`` or fewer on average."""
    pieces = max(1, -(-rows // (buckets * CELL)))
    inner = F.pmod(F.shiftright(F.xxhash64(null_safe_key(key)), 32), F.lit(pieces)).cast("int")
    return bucket_of(key, buckets) * F.lit(pieces) + inner


def _write(df: DataFrame, path: str, bucket: Column) -> tuple[str, list[int]]:
    """Write rows by bucket; the part's name and the buckets that have rows."""
    name = uuid.uuid4().hex
    df.withColumn(BUCKET, bucket).write.partitionBy(BUCKET).parquet(f"{path}/{PARTS}/{name}")
    found = versions.listed(df.sparkSession, f"{path}/{PARTS}/{name}")
    return name, [int(f.split("=")[1]) for f in found if f.startswith(f"{BUCKET}=")]


def append(df: DataFrame, path: str, key: Column, buckets: int = BUCKETS) -> list[int]:
    """Add rows to their buckets; the buckets that got any.  Raises ``CommitConflict`` if another writer came first."""
    spark = df.sparkSession
    _check(spark, path, buckets)
    after, parts = _last(spark, path), manifest(spark, path)
    name, touched = _write(spread(df, key, buckets), path, bucket_of(key, buckets))
    for b in touched:
        parts[b] = [*parts.get(b, []), Part(name)]
    _commit(spark, path, parts, buckets, after)
    return touched


def rewrite(df: DataFrame, path: str, key: Column, made_from: Mapping[int, str], buckets: int = BUCKETS,
            grown: Iterable[int] = ()) -> None:
    """Replace the buckets named in ``made_from`` by the rows of ``df``, which has rows of these buckets only.

    Buckets that are also in ``grown`` keep their parts, and the rows are one part more.  Rows are written as they lie: ``df`` should
    hold a bucket's rows in few tasks (see ``spread``).
    """
    spark = df.sparkSession
    _check(spark, path, buckets)
    after, parts, stay = _last(spark, path), manifest(spark, path), set(grown)
    name, filled = _write(df, path, bucket_of(key, buckets))
    if strays := set(filled) - set(made_from):
        raise ValueError(f"{path}: rows of buckets that are not replaced: {sorted(strays)[:5]}")
    for b, source in made_from.items():
        old = [Part(p.name, source) for p in parts.get(b, []) if p.name] if b in stay else []
        new = [Part(name, source)] if b in filled else []
        # a bucket without rows keeps a part that is not there, so that it is known to be up to date
        parts[b] = old + new or [Part("", source)]
    _commit(spark, path, parts, buckets, after)


def read(spark: SparkSession, path: str, schema, only: Iterable[int] | None = None,
         names: Mapping[int, Iterable[str]] | None = None) -> DataFrame:
    """Rows of all buckets, or of some: the files of other buckets are not listed or read.

    Of buckets in ``names`` only the parts named there are read.
    """
    wanted, named = None if only is None else set(only), {b: set(n) for b, n in (names or {}).items()}
    folders = [f"{path}/{PARTS}/{p.name}/{BUCKET}={b}" for b, ps in sorted(manifest(spark, path).items())
               if wanted is None or b in wanted for p in ps if p.name and (b not in named or p.name in named[b])]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def schema_of(spark: SparkSession, path: str):
    """Column types of a table, from one of its parts."""
    for b, ps in sorted(manifest(spark, path).items()):
        for p in ps:
            if p.name:
                return spark.read.parquet(f"{path}/{PARTS}/{p.name}/{BUCKET}={b}").schema
    raise FileNotFoundError(f"no rows at {path}")


def compact(spark: SparkSession, path: str, key: Column, buckets: int = BUCKETS) -> int:
    """Put the parts of buckets that have several into one; the number of such buckets.

    What a part was made from is kept, as a joined text where it differs; the part has a new name, so tables made from this one
    see a change in these buckets.
    """
    several = {b: "+".join(dict.fromkeys(p.made_from for p in ps)) for b, ps in manifest(spark, path).items() if len(ps) > 1}
    if several:
        rewrite(spread(read(spark, path, schema_of(spark, path), several), key, buckets), path, key, several, buckets)
    return len(several)
