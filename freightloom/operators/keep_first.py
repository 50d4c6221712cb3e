"""Deterministic keep-first deduplication that survives hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDINAL = ("_src_file", "_ord")
COPIES = "_copies"
#: Groups are counted by this many hash places; a place with more rows than this, and than four average ones, is hot.
PLACES, HOT_ROWS = 4096, 10_000
#: Rows dealt by key to a task, on average and at most.
PORTION = 250_000


def places_of(keys: Sequence[str | Column]) -> Column:
    """Place of a row, by the hash of its keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(PLACES))


def hot_places(df: DataFrame, keys: Sequence[str]) -> tuple[list[int], float, int]:
    """Places of the keys' hash that hold far more rows than others, the share of all rows that lies there, and all rows."""
    counts = [(r[0], r[1]) for r in df.groupBy(places_of(keys)).count().collect()]
    total = sum(n for _, n in counts)
    hot = [(p, n) for p, n in counts if n > max(HOT_ROWS, 4 * total / PLACES)]
    return sorted(p for p, _ in hot), sum(n for _, n in hot) / max(1, total), total


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df``, of ``rows`` rows, dealt by ``keys``: the session's number of portions, sized by adaptive execution, unless they would
    hold more than ``PORTION`` rows each; then as many as keep a task from growing with the table."""
    portions = -(-rows // PORTION)
    enough = portions <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(*keys) if enough else df.repartition(portions, *keys)


def by_group(df: DataFrame, keys: Sequence[str], build: Callable[[DataFrame], DataFrame],
             places: tuple[list[int], float, int] | None = None) -> DataFrame:
    """``build(rows)`` for a result that is a union over groups of ``keys``: no row of it needs rows of two groups.

    A partial aggregate over groups of few rows saves nothing, and sorts or hashes whatever a task reads, which for
    a well compressed file is far more than fits its memory.  So rows are dealt by the keys first, and ``build`` finds them
    in portions that adaptive execution sizes, or that are bounded by rows (see ``dealt``).  Rows of hot places (see ``hot_places``) keep the plain plan, in which
    copies collapse before the shuffle.  The places are counted when the plan is built, unless they are given: the frame
    should be a written table.
    """
    hot, share, rows = places or hot_places(df, keys)
    if share > 0.5:
        return build(df)
    if not hot:
        return build(dealt(df, keys, rows))
    is_hot = places_of(keys).isin(hot)
    return build(dealt(df.filter(~is_hot), keys, round(rows * (1 - share)))).unionByName(build(df.filter(is_hot)))


def ordinal_columns(df: DataFrame) -> list[str]:
    """Ingest order where the extract carries it, else every column (a total order up to equal rows)."""
    return list(ORDINAL) if set(ORDINAL) <= set(df.columns) else list(df.columns)


def null_safe_key(col: Column) -> Column:
    """Text key that keeps NULL apart from every value and still joins with plain equality."""
    return F.coalesce(F.concat(F.lit("="), col), F.lit(""))


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per key, the first in ``order``; NULL keys form one group.

    ``copies`` names an extra column with the number of rows the key had.

    A ranking window would pull all copies of a key into one task.  This is an aggregate instead:
    ``min`` over a row struct whose leading fields are the order.  Copies of a hot key collapse in each map task
    before the shuffle, so a key holding a third of the table ships one row per task; other rows are dealt by key first
    (see ``by_group``).
    """
    order = list(order or ordinal_columns(df))
    return by_group(df, keys, lambda rows: first_rows(rows, keys, order, copies))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], copies: str | None = None) -> DataFrame:
    """``keep_first`` as one aggregate of the rows as they lie."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    lead = [c for c in order if c not in keys]
    aggregates = [F.count(F.lit(1)).alias(copies or COPIES)]
    if lead or rest:
        aggregates.append(F.min(F.struct(*lead, *rest)).alias("_row"))
    grouped = df.groupBy(*keys).agg(*aggregates)
    out = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return grouped.select(*out, *([copies] if copies else []))


def qualify_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], desc: bool = False) -> DataFrame:
    """Row with the smallest (or largest) ``order`` per key: a filter on a window rank, as an aggregate."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    pick = F.max if desc else F.min
    grouped = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return grouped.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
