"""Scored runs and legs kept up to date after an append, by the buckets it touched.

All four tables, raw and scored, lie in buckets of the trimmed truck id.  Whatever a scored run or leg depends on, apart from the
reference tables, has the same truck: copies of a leg, other spellings of its ids, the legs counted against the run, and the
run itself.  A bucket is therefore scored from its own raw rows alone.

Each scored part records what its bucket was made from: the raw parts of the bucket and the versions of the reference tables.  A
refresh deals with the buckets for which that has changed and no others.  Where only parts were added, whose trucks the scored
rows do not have, the new rows are scored alone and become one part more; any other bucket is rewritten.  A refresh that failed
half way, or an append nobody refreshed after, is made up for by the next one; a new version of a reference table rewrites every
bucket.

Rows of a bucket are dealt once, by pieces of a bucket (see ``buckets.cell_of``), scored there and written as they lie.  Trucks with very
many rows are scored apart, by plans that need no truck in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.functions.casting import trim_all
from freightloom.operators.keep_first import hot_places, null_safe_key, places_of
from freightloom.operators.lookup import is_bounded
from freightloom.plans.shipments import silver_wms
from freightloom.plans.transport import silver_tms
from freightloom.schemas import FEEDS
from freightloom.sources import buckets, versions
from freightloom.sources.sinks import table_path

RAW, SCORED = "bronze_bucketed", "silver_bucketed"
RUNS, LEGS = "tms_transportation", "wms_shipment_details"
NETWORK, RATES = "mdm_network", "fin_transport_rates"


def _key():
    return trim_all(F.col("truck_id"))


def append_raw(df: DataFrame, base: str, name: str, count: int = buckets.BUCKETS) -> list[int]:
    """Add raw runs or legs to their buckets."""
    if not FEEDS[name].append_only:
        raise ValueError(f"{name} is refreshed in full")
    return buckets.append(df, table_path(base, RAW, name), _key(), count)


def _sources(*texts: list[str]) -> str:
    return ";".join(",".join(t) for t in texts)


def _names(parts: dict[int, list[buckets.Part]], bucket: int) -> list[str]:
    return [p.name for p in parts.get(bucket, [])]


def _outdated(have: dict[int, list[buckets.Part]], want: dict[int, str]) -> dict[int, str]:
    return {b: source for b, source in want.items() if {p.made_from for p in have.get(b, [])} != {source}}


def _added(have: dict[int, list[buckets.Part]], due: dict[int, str]) -> dict[int, list[list[str]]]:
    """Of buckets whose sources only gained parts: the parts gained, for each of the tables they come from."""
    out = {}
    for b, source in due.items():
        if len({p.made_from for p in have.get(b, [])}) == 1:
            *old, old_at = (set(t.split(",")) - {""} for t in have[b][0].made_from.split(";"))
            *new, new_at = (set(t.split(",")) - {""} for t in source.split(";"))
            if len(old) == len(new) and old_at == new_at and all(o <= n for o, n in zip(old, new, strict=True)):
                out[b] = [sorted(n - o) for o, n in zip(old, new, strict=True)]
    return out


def _trucks(df: DataFrame, count: int) -> DataFrame:
    """Trucks as 64-bit hashes, with their bucket, a row for each row; two trucks of one hash cost a rewrite."""
    return df.select(F.xxhash64(null_safe_key(_key())).alias("_h"), buckets.bucket_of(_key(), count).alias("_b"))


def _shared(new: DataFrame, old: DataFrame) -> set[int]:
    """Buckets in which the two have a truck in common.

    One aggregate of both, not a join: Spark goes by the bytes of the files, in which ids take next to nothing, and would
    collect all trucks in the driver.
    """
    sides = new.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
    both = sides.groupBy("_h", "_b").agg(F.bool_or("_new").alias("_in_new"), F.bool_and("_new").alias("_in_no_other"))
    return {r[0] for r in both.where(F.col("_in_new") & ~F.col("_in_no_other")).select("_b").distinct().collect()}


def _scored(score: Callable[..., DataFrame], raw: DataFrame, runs: DataFrame | None, network: DataFrame, count: int) -> DataFrame:
    """``score(raw, runs, cell, rows)`` over all rows, laid out for a write by bucket."""
    key = null_safe_key(_key())
    hot, share, rows = hot_places(raw.select(key.alias("_key")), ["_key"])
    if share > 0.5 or not is_bounded(network):
        return buckets.spread(score(raw, runs, None, rows), _key(), count)
    if runs is not None:
        rows += runs.count()

    def part(df: DataFrame | None, is_hot: bool) -> DataFrame | None:
        inside = places_of([key]).isin(hot)
        return df if df is None or not hot else df.where(inside if is_hot else ~inside)

    done = score(part(raw, False), part(runs, False), buckets.cell_of(_key(), rows, count), rows)
    return done.unionByName(buckets.spread(score(part(raw, True), part(runs, True), None, rows), _key(), count)) if hot else done


def refresh_scored(spark: SparkSession, base: str, reference: str = "silver", count: int = buckets.BUCKETS) -> dict[str, list[int]]:
    """Score the buckets whose sources have changed; the buckets rewritten or added to for each table.

    ``reference`` is the layer of the published network and rates.
    """
    raw, scored = ({n: table_path(base, layer, n) for n in (RUNS, LEGS)} for layer in (RAW, SCORED))
    at = {n: versions.current(spark, table_path(base, reference, n)) for n in (NETWORK, RATES)}
    network, rates = (spark.read.parquet(at[n]) for n in (NETWORK, RATES))
    seen = {n: path.rsplit("/", 1)[1] for n, path in at.items()}

    def raw_rows(name: str, only: Iterable[int], names: dict[int, list[str]]) -> DataFrame:
        return buckets.read(spark, raw[name], buckets.schema_of(spark, raw[name]), only, names)

    run_parts = buckets.manifest(spark, raw[RUNS])
    leg_parts = buckets.manifest(spark, raw[LEGS])
    run_schema = silver_tms(spark.createDataFrame([], FEEDS[RUNS].schema), network, rates).schema
    old_runs = buckets.manifest(spark, scored[RUNS])
    runs_due = _outdated(old_runs, {b: _sources(_names(run_parts, b), [seen[NETWORK], seen[RATES]]) for b in run_parts})
    if runs_due:
        new = {b: names for b, (names,) in _added(old_runs, runs_due).items()}
        if new:
            shared = _shared(_trucks(raw_rows(RUNS, new, new), count), _trucks(buckets.read(spark, scored[RUNS], run_schema, new), count))
            new = {b: names for b, names in new.items() if b not in shared}

        def runs_scored(some: DataFrame, _, cell: Column | None, rows: int) -> DataFrame:
            return silver_tms(some, network, rates, cell=cell, rows=rows)

        buckets.rewrite(_scored(runs_scored, raw_rows(RUNS, runs_due, new), None, network, count),
                        scored[RUNS], _key(), runs_due, count, new)

    run_made, old_legs = buckets.manifest(spark, scored[RUNS]), buckets.manifest(spark, scored[LEGS])
    legs_due = _outdated(old_legs, {
        b: _sources(_names(leg_parts, b), _names(run_made, b), [seen[NETWORK]]) for b in leg_parts})
    if legs_due:
        added = _added(old_legs, legs_due)
        new, new_runs = ({b: names[i] for b, names in added.items()} for i in (0, 1))
        if added:
            legs_of = _trucks(raw_rows(LEGS, new, new), count)
            runs_of = _trucks(buckets.read(spark, scored[RUNS], run_schema, new_runs, new_runs), count)
            rows_of = _trucks(buckets.read(spark, scored[LEGS], buckets.schema_of(spark, scored[LEGS]), added), count)
            shared = _shared(legs_of.unionByName(runs_of), rows_of)
            new = {b: names for b, names in new.items() if b not in shared}
            # new legs of runs that were there before need those
            before = {b: sorted(set(_names(run_made, b)) - set(new_runs[b])) for b in new}
            back = _shared(legs_of, _trucks(buckets.read(spark, scored[RUNS], run_schema, before, before), count))
            new_runs = {b: new_runs[b] for b in new if b not in back}

        def legs_scored(some: DataFrame, runs: DataFrame, cell: Column | None, rows: int) -> DataFrame:
            return silver_wms(some, runs, network, cell, rows)

        runs = buckets.read(spark, scored[RUNS], run_schema, legs_due, new_runs)
        buckets.rewrite(_scored(legs_scored, raw_rows(LEGS, legs_due, new), runs, network, count),
                        scored[LEGS], _key(), legs_due, count, new)
    return {RUNS: sorted(runs_due), LEGS: sorted(legs_due)}


def read_scored(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scored runs or legs of all buckets as of the last refresh."""
    path = table_path(base, SCORED, name)
    return buckets.read(spark, path, buckets.schema_of(spark, path))
