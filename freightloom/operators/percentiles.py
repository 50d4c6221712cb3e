"""Exact continuous percentiles per group, built from value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Different values sampled for each cut point of a large group.
PER_CUT = 8


def _same(left: str, right: str, keys: Sequence[str]):
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def value_cuts(counts: DataFrame, keys: Sequence[str], value: str, slices: int) -> DataFrame:
    """Ascending cut points (``_cuts``) of each group with more than ``PER_CUT * slices`` different values.

    ``counts`` has one row per group and value.  About ``PER_CUT * slices`` values of a group are taken by
    their hash, so a list is that long however large the group is, and a retry takes the same values.
    """
    wanted = PER_CUT * slices
    large = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values")).filter(F.col("_values") > wanted)
    sampled = counts.alias("_c").join(large.alias("_l"), _same("_c", "_l", keys)).filter(
        F.pmod(F.xxhash64(f"_c.{value}"), F.col("_values")) < wanted)
    listed = sampled.groupBy(*[F.col(f"_c.{k}").alias(k) for k in keys]).agg(
        F.array_sort(F.collect_list(f"_c.{value}")).alias("_taken"))
    return listed.select(*keys, F.filter("_taken", lambda _, i: i % PER_CUT == PER_CUT - 1).alias("_cuts"))


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], count: str | None = None
) -> DataFrame:
    """Linear-interpolated percentiles (``PERCENTILE_CONT``) of ``value`` per group, NULLs ignored.

    ``points`` maps output column to fraction.  The built-in exact percentile holds all distinct
    values of a group in one buffer, and a plain ranking window sorts a group in one task.  Here equal
    values are counted before the shuffle, and ranks are built in two steps: a running count inside
    (group, value slice), plus the count of all lower slices.  A large group has about as many slices as
    the session has shuffle partitions, each with nearly as many of its different values.  The cuts are
    approximate, the ranks are exact for any cuts.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    below = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col(f"_v.{value}"))), F.lit(0))
    counts = values.alias("_v").join(
        value_cuts(values, keys, value, slices).alias("_k"), _same("_v", "_k", keys), "left").select(
        *[F.col(f"_v.{c}").alias(c) for c in (*keys, value, "_n")], below.alias("_slice"))
    cell = [*keys, "_slice"]
    # a group has about as many slices as there are shuffle partitions, so this window is small for every group
    group = W.partitionBy(*keys)
    lower = counts.groupBy(*cell).agg(F.sum("_n").alias("_in_slice")).withColumns({
        "_before": F.sum("_in_slice").over(group.orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow))
        - F.col("_in_slice"),
        "_total": F.sum("_in_slice").over(group),
    }).drop("_in_slice")
    running = F.sum("_n").over(W.partitionBy(*cell).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = counts.withColumn("_running", running).alias("_c").join(lower.alias("_s"), _same("_c", "_s", cell)).select(
        *[F.col(f"_c.{k}").alias(k) for k in keys], F.col(f"_c.{value}").alias(value), "_n", "_total",
        (F.col("_before") + F.col("_running")).alias("_last"))

    def at(rank):
        """Value at a zero-based rank."""
        return F.max(F.when((rank < F.col("_last")) & (rank >= F.col("_last") - F.col("_n")), F.col(value)))

    picks = []
    for name, fraction in points.items():
        position = F.lit(fraction) * (F.col("_total") - 1)
        picks += [
            at(F.floor(position)).alias(f"_{name}_low"),
            at(F.ceil(position)).alias(f"_{name}_high"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"),
        ]
    picked = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)

    def between(name):
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * F.col(f"_{name}_part")).alias(name)

    total = [F.col("_total").alias(count)] if count else []
    return picked.select(*keys, *total, *[between(name) for name in points])


#: Size parameter of a sketch, and the share of ranks by which a percentile of a sketch of that size may miss its own.
SKETCH, RANK_ERROR = 200, 0.03


def value_sketches(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH) -> DataFrame:
    """``_sketch`` (KLL) of the values of each group, and their number ``_n``; NULLs are left out.

    A sketch is a few kilobytes however many values it has seen, map tasks make their own before the shuffle, and sketches merge: keep
    them per day and combine any period with ``sketched_percentiles``.
    """
    values = df.filter(F.col(value).isNotNull())
    return values.groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("_sketch"), F.count(F.lit(1)).alias("_n"))


def sketched_percentiles(
    sketches: DataFrame, keys: Sequence[str], points: Mapping[str, float], count: str | None = None
) -> DataFrame:
    """Approximate percentiles per group of ``keys`` from ``value_sketches`` of a finer or equal grouping.

    A result is a value whose rank is within ``RANK_ERROR`` of the asked one (with the default size and the confidence of
    99 % and more that its authors state); groups of up to ``SKETCH`` values are not approximated.
    """
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("_sketch").alias("_sketch"), F.sum("_n").alias("_n"))
    total = [F.col("_n").alias(count)] if count else []
    return merged.select(*keys, *total, *[
        F.kll_sketch_get_quantile_double("_sketch", F.lit(fraction)).alias(name) for name, fraction in points.items()])
