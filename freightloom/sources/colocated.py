"""Two tables bucketed by the same key, so that jobs on that key join and group them without a shuffle.

One committed version (see ``versions``) holds both tables, each in two parts.  ``even`` has the rows of most keys in ``buckets``
Spark buckets, one file each: a join or an aggregate by the key reads a bucket of either table in one task and moves
nothing.  ``loose`` has the rows of keys too frequent for that, and is shuffled as any other table, so adaptive execution may split a
hot key.  A key is frequent if it has more than twice the rows of an average bucket in one of the tables.  Of such keys there
are fewer than ``buckets``, so their list fits a filter.

Every key lies in one part only, so a job whose result is a union over keys runs on each part (``by_key``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.operators.keep_first import PLACES
from freightloom.sources import versions

BUCKETS = 512
#: Rows of both tables that a bucket holds on average, where the number of buckets follows the tables.
ROWS = 250_000
EVEN, LOOSE, NOTE = "even", "loose", "note"
SIDES = ("left", "right")
NOTE_COLUMNS = "key string, buckets int, loose boolean, left string, right string"


@dataclass(frozen=True)
class Pair:
    """Both tables in parts: ``even`` and ``loose`` are (left, right); ``loose`` is None if no key is frequent."""

    even: tuple[DataFrame, DataFrame]
    loose: tuple[DataFrame, DataFrame] | None

    def by_key(self, build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``build(left, right)`` for a result that is a union over keys: no row of it needs rows of two keys."""
        done = build(*self.even)
        return done if self.loose is None else done.unionByName(build(*self.loose))


def buckets_for(*tables: DataFrame, least: int = 1, rows: int = ROWS) -> int:
    """Number of buckets for written tables: a bucket, which is one task's, does not grow with them."""
    return max(least, -(-sum(t.count() for t in tables) // rows))


def frequent_keys(df: DataFrame, key: str, buckets: int) -> list[str | None]:
    """Keys, NULL too, with more than twice the rows of an average bucket; fewer than half as many as buckets.

    Rows are counted by hash places of the keys first, so keys are told apart and shuffled only where a place has that many.
    """
    place = F.pmod(F.xxhash64(key), F.lit(max(PLACES, 8 * buckets)))
    counts = [tuple(r) for r in df.groupBy(place).count().collect()]
    total = sum(n for _, n in counts)
    full = [p for p, n in counts if n * buckets > 2 * total]
    if not full:
        return []
    named = df.filter(place.isin(full)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [r[0] for r in named.filter(F.col("_n") * buckets > 2 * total).select(key).collect()]


def _is_frequent(key: str, keys: list[str | None]) -> Column:
    named = [k for k in keys if k is not None]
    found = F.coalesce(F.col(key).isin(named), F.lit(False)) if named else F.lit(False)
    return found | F.col(key).isNull() if None in keys else found


def _register(spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int) -> str:
    """Name of a bucketed folder in the session's catalogue."""
    name = f"freightloom_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet "
              f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def publish_pair(left: DataFrame, right: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> Pair:
    """Write both tables bucketed by ``key`` and commit them together; the pair as read back.

    The frames are read twice, once for the key alone, so they should be written tables.  A bucket should fit an executor's
    memory or spill quietly: about one for each gigabyte.
    """
    if buckets < 1:
        raise ValueError("at least one bucket")
    spark = left.sparkSession
    keys = sorted({*frequent_keys(left, key, buckets), *frequent_keys(right, key, buckets)}, key=lambda k: (k is not None, k))
    version = uuid.uuid4().hex
    base = f"{path}/{versions.VERSIONS}/{version}"
    for side, df in zip(SIDES, (left, right), strict=True):
        staged = f"freightloom_{uuid.uuid4().hex}"
        writer = df.filter(~_is_frequent(key, keys)).repartition(buckets, key).write.format("parquet")
        writer.bucketBy(buckets, key).option("path", f"{base}/{side}/{EVEN}").saveAsTable(staged)
        spark.sql(f"DROP TABLE {staged}")  # the files stay: the table is external, and readers name it by its folder
        if keys:
            df.filter(_is_frequent(key, keys)).hint("rebalance").write.parquet(f"{base}/{side}/{LOOSE}")
    note = (key, buckets, bool(keys), left.schema.json(), right.schema.json())
    spark.createDataFrame([note], NOTE_COLUMNS).coalesce(1).write.parquet(f"{base}/{NOTE}")
    versions.commit(spark, path, version)
    return read_pair(spark, path)


def read_pair(spark: SparkSession, path: str) -> Pair:
    """The pair as of the last commit, in any session that reaches the folder."""
    base = versions.current(spark, path)
    note = spark.read.parquet(f"{base}/{NOTE}").first()
    # the columns are kept with the pair, as a table without rows has no file to tell them
    schemas = {side: T.StructType.fromJson(json.loads(note[side])) for side in SIDES}
    even = tuple(spark.table(_register(spark, f"{base}/{s}/{EVEN}", schemas[s], note.key, note.buckets)) for s in SIDES)
    loose = tuple(spark.read.schema(schemas[s]).parquet(f"{base}/{s}/{LOOSE}") for s in SIDES) if note.loose else None
    return Pair(even, loose)
