"""Joins to reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.functions.flags import usable

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
#: A value of fixed width counts as this many bytes, and so does the header of one that varies.
WORD = 8


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: texts and binary by their length, nested values by that of their JSON text."""
    sizes: list[Column] = []
    for f in df.schema:
        value = F.col(f"`{f.name.replace('`', '``')}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(value))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.octet_length(F.to_json(F.struct(value))))
    return sum((F.coalesce(s, F.lit(0)) for s in sizes), F.lit(WORD * len(df.columns))).cast("long")


def bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark a frame for broadcast only after measuring that it has at most ``max_rows`` rows and ``max_bytes`` bytes.

    For written tables only: rows and bytes are measured on ``max_rows + 1`` rows at most, so it is cheap there, and would run
    the plan of a derived frame a second time; leave such a frame's joins to adaptive execution.  A larger frame comes back without a hint, so its
    joins shuffle and adaptive execution splits their skewed partitions.
    """
    return F.broadcast(df) if is_bounded(df, max_rows, max_bytes) else df


def is_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    seen = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return seen.rows <= max_rows and seen.bytes <= max_bytes


def attach(
    df: DataFrame,
    dim: DataFrame,
    key: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add columns of a reference table; pass it through ``bounded`` first, once per plan.

    ``key`` maps fact column to reference column, ``take`` maps reference column to its new name.
    The reference key is dropped; take it under another name to tell a miss from a NULL attribute.
    """
    side = dim.select(
        *[F.col(ref).alias(f"_key_{i}") for i, ref in enumerate(key.values())],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    on = [F.col(f"_fact.{fact}") == F.col(f"_side._key_{i}") for i, fact in enumerate(key)]
    joined = df.alias("_fact").join(side.alias("_side"), on, how)
    return joined.drop(*[f"_key_{i}" for i in range(len(key))])


def node_lookup(df: DataFrame, network: DataFrame, node: str, take: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join one endpoint of a lane to the network."""
    return attach(df, network, {node: "node_id"}, take, how)


def usable_endpoints(df: DataFrame, network: DataFrame, origin: str, destination: str) -> DataFrame:
    """Keep rows whose two endpoints are non-critical nodes and add their type, country and position."""
    good = bounded(usable(network))
    for node, role in ((origin, "origin_node"), (destination, "destination_node")):
        take = {c: f"{role}_{n}" for c, n in
                (("node_type", "type"), ("country", "country"), ("latitude", "latitude"), ("longitude", "longitude"))}
        df = node_lookup(df, good, node, take, how="inner")
    return df


def member_flag(df: DataFrame, value: str, members: DataFrame, out: str) -> DataFrame:
    """Boolean ``out`` = value NOT IN (members) under three-valued logic.

    ``members`` is a one-column frame.  A NULL member makes every non-member NULL, so do NULL values
    unless the set is empty.
    """
    column = members.columns[0]
    distinct = members.select(F.col(column).alias("_member")).distinct()
    known = distinct.filter(F.col("_member").isNotNull())
    facts = distinct.agg(
        F.struct(
            F.coalesce(F.bool_or(F.col("_member").isNull()), F.lit(False)).alias("has_null"),
            (F.count(F.lit(1)) == 0).alias("empty"),
        ).alias("s")
    )
    joined = df.join(known, F.col(value) == F.col("_member"), "left")
    info = facts.scalar()
    absent: Column = (
        F.when(info["empty"], True)
        .when(F.col("_member").isNotNull(), False)
        .when(F.col(value).isNull() | info["has_null"], F.lit(None).cast("boolean"))
        .otherwise(True)
    )
    return joined.withColumn(out, absent).drop("_member")
