"""Quality-scored shipment legs.

This is the largest table by far, so the shape of its plan is what matters:

* full rows move twice: once to collapse copies of (shipment, truck), once to meet their truck run;
* the per-truck leg count and the search for ids spelled in several ways share one aggregate of two columns;
* no step needs all legs of one truck, or all copies of one leg, in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightloom.functions.casting import norm, parse_date, trim_all
from freightloom.functions.flags import flag, reference_rules, score
from freightloom.operators.keep_first import COPIES, by_group, dealt, first_rows, hot_places, null_safe_key, ordinal_columns
from freightloom.operators.lookup import bounded, node_lookup

# Id format and container type prefixes.
SHIPMENT_ID_FORMAT = r"^SHP_[0-9]{9}\z"
CONTAINER_TYPES = ("MTL", "BOX")

COLUMNS = (
    "shipment_id", "truck_id", "container_id", "order_date",
    "origin_node_id", "destination_node_id", "sort_code",
)
KEYS = ("_shipment_key", "_truck_key")
#: What a leg is compared with, of its run.
RUN = {"_run": "truck_id", "_departure": "departure_datetime", "_o": "origin_node_id", "_d": "destination_node_id",
       "_packages": "package_count"}


def container_type(container_id):
    return F.substring(container_id, 1, 3)


def _key_text(key: str):
    """Trimmed id behind a null-safe key; NULL for the NULL key."""
    return F.when(F.col(key) != "", trim_all(F.expr(f"substring({key}, 2)")))


def _keyed(bronze: DataFrame) -> DataFrame:
    """Legs with null-safe keys that stand for the two ids, so the rows that move carry each id once."""
    ids = ("shipment_id", "truck_id")
    return bronze.withColumns({k: null_safe_key(F.col(c)) for k, c in zip(KEYS, ids, strict=True)}).drop(*ids)


def id_pairs(bronze: DataFrame, places: tuple[list[int], float, int] | None = None) -> DataFrame:
    """Null-safe raw ids with their number of rows ``_n``, and the trimmed ids; reads two columns.

    What is asked of it below always uses ``_n``, or the optimizer would drop it in one place and not in another, and the
    legs would be read and shuffled once for each instead of once for all.
    """
    pairs = by_group(_keyed(bronze).select(*KEYS), KEYS, lambda rows: rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_n")), places)
    return pairs.withColumns({t: null_safe_key(_key_text(k)) for t, k in zip(("_s", "_t"), KEYS, strict=True)})


def legs_per_truck(pairs: DataFrame) -> DataFrame:
    """Legs with a shipment id per truck (as a null-safe key) after deduplication, from ``id_pairs``."""
    return pairs.groupBy(F.col("_t").alias("_truck")).agg(
        F.count_if((F.col("_s") != "") & (F.col("_n") > 0)).alias("_legs"))


def spelled_apart(pairs: DataFrame) -> DataFrame:
    """Raw keys that may share their trimmed key with another spelling, from ``id_pairs``.

    A trimmed key counts if it has several rows and at least one of them carries white space.  That
    includes one spelling with several rows, which is a repetition too.
    """
    padded = (F.col("_s") != F.col(KEYS[0])) | (F.col("_t") != F.col(KEYS[1]))
    several = pairs.groupBy("_s", "_t").agg(F.sum("_n").alias("_rows"), F.bool_or(padded).alias("_any")).filter(
        (F.col("_rows") > 1) & F.col("_any")).select("_s", "_t")
    with_space = pairs.filter(F.when(padded, F.col("_n")) > 0).join(several, ["_s", "_t"]).select(*KEYS)
    clean = several.select(F.col("_s").alias(KEYS[0]), F.col("_t").alias(KEYS[1]))
    return with_space.unionByName(clean).withColumn("_apart", F.lit(True))


def _typed(*more: Column | str) -> list[Column | str]:
    """Columns of a leg from its keys and texts, and ``more``."""
    ids = ("shipment_id", "truck_id")
    return [
        *[_key_text(k).alias(c) for k, c in zip(KEYS, ids, strict=True)],
        *[norm(F.col(c)).alias(c) for c in COLUMNS if c not in (*ids, "order_date")],
        parse_date(F.col("order_date")).alias("order_date"), *more]


def _run_columns() -> list[Column]:
    return [(F.to_date(c) if n == "_departure" else F.col(c)).alias(n) for n, c in RUN.items()]


def _met(bronze: DataFrame, tms: DataFrame) -> DataFrame:
    """Typed legs with their run and the number of legs of their truck; no task needs all legs of a truck."""
    ids = ("shipment_id", "truck_id")
    keyed, order = _keyed(bronze), [c for c in ordinal_columns(bronze) if c not in ids]
    places = hot_places(keyed, KEYS)
    pairs = id_pairs(bronze, places)
    apart = spelled_apart(pairs)
    # the aggregate is already partitioned and sorted by the keys, this join moves no full rows
    flagged_keys = by_group(keyed, KEYS, lambda rows: first_rows(rows, KEYS, order, COPIES).join(
        apart, list(KEYS), "left"), places)
    legs = flagged_keys.select(*_typed(((F.col(COPIES) > 1) | F.coalesce("_apart", F.lit(False))).alias("_repeated")))
    # Joined on the null-safe key, so the runs are shuffled once more (few rows) for the join with the
    # legs.  Both sides of that join are then plain shuffles, which adaptive execution can split when
    # one truck, or the missing truck id, holds a large part of the legs.
    runs = tms.select(*_run_columns()).join(
        legs_per_truck(pairs), null_safe_key(F.col("_run")) == F.col("_truck"), "left").drop("_truck")
    return legs.join(runs, F.col("truck_id") == F.col("_run"), "left")


def _met_in_cells(bronze: DataFrame, tms: DataFrame, cell: Column, rows: int) -> DataFrame:
    """As ``_met``, with legs and runs dealt together once, by ``cell``, and all legs of a truck in one task.

    ``tms`` has one row for each truck id.
    """
    ids = ("shipment_id", "truck_id")
    order = [c for c in ordinal_columns(bronze) if c not in ids]
    rest = [c for c in bronze.columns if c not in (*ids, *order)]
    legs = _keyed(bronze.withColumn("_cell", cell))
    # legs know the trimmed id, so a run whose id has white space is nobody's; runs have no shipment key, not even the missing one
    runs = tms.where(F.col("truck_id") == trim_all(F.col("truck_id"))).select(
        cell.alias("_cell"), null_safe_key(F.col("truck_id")).alias(KEYS[1]), F.struct(*_run_columns()).alias("_of"))
    both = dealt(legs.unionByName(runs, allowMissingColumns=True), ["_cell"], rows).withColumns({
        "_s": F.when(F.col(KEYS[0]).isNotNull(), null_safe_key(_key_text(KEYS[0]))), "_t": null_safe_key(_key_text(KEYS[1]))})
    # grouped in the order the windows need
    groups = both.groupBy("_cell", "_t", "_s", *KEYS).agg(
        F.count(F.lit(1)).alias(COPIES), F.min(F.struct(*order, *rest)).alias("_row"), F.max("_of").alias("_of"))
    truck, leg = Window.partitionBy("_cell", "_t"), Window.partitionBy("_cell", "_t", "_s")
    padded = (F.col("_s") != F.col(KEYS[0])) | (F.col("_t") != F.col(KEYS[1]))
    seen = groups.withColumns({
        "_legs": F.count_if(F.col("_s") != "").over(truck), "_of": F.max("_of").over(truck),
        "_spelled": F.bool_or(padded).over(leg), "_rows": F.sum(COPIES).over(leg)})
    repeated = (F.col(COPIES) > 1) | (F.col("_rows") > 1) & F.col("_spelled")
    return seen.where(F.col("_s").isNotNull()).select(*KEYS, "_row.*", "_of.*", COPIES, "_legs", "_rows", "_spelled").select(
        *_typed(repeated.alias("_repeated"), *RUN, "_legs"))


def silver_wms(bronze: DataFrame, tms: DataFrame, network: DataFrame, cell: Column | None = None, rows: int = 0) -> DataFrame:
    """One scored row per (shipment, truck).

    ``cell``, a number made from the trimmed truck id, says that no truck is hot: legs and runs are then dealt by it once, and
    the result lies by it.  ``rows`` is their number.
    """
    joined = _met(bronze, tms) if cell is None else _met_in_cells(bronze, tms, cell, rows)
    joined = node_lookup(joined, bounded(network), "sort_code", {"node_id": "_sort", "node_type": "_sort_type"})

    shipment, container = F.col("shipment_id"), F.col("container_id")

    def agrees(mine: str, run: str, label: str):
        return flag([
            (F.col(mine).isNull(), "null_in_source"),
            (F.col(run).isNull(), "ok"),
            (F.col(mine) != F.col(run), label),
        ])

    flags = {
        "order_date_quality_flag": flag([
            (F.col("order_date").isNull(), "null_in_source"),
            (F.col("_departure").isNull(), "ok"),
            (F.col("order_date") > F.col("_departure"), "date_integrity_fail"),
        ]),
        "truck_integrity_quality_flag": flag([
            (F.col("truck_id").isNull(), "null_in_source"), (F.col("_run").isNull(), "truck_integrity_fail")]),
        "origin_integrity_quality_flag": agrees("origin_node_id", "_o", "origin_integrity_fail"),
        "destination_integrity_quality_flag": agrees("destination_node_id", "_d", "destination_integrity_fail"),
        "container_integrity_quality_flag": flag([
            (container.isNull(), "null_in_source"),
            (~container_type(container).isin(*CONTAINER_TYPES), "invalid_container"),
        ]),
        "shipment_integrity_quality_flag": flag([
            (shipment.isNull(), "null_in_source"),
            (F.col("_repeated"), "duplicate_shipment_in_truck"),
            (~shipment.rlike(SHIPMENT_ID_FORMAT), "invalid_format"),
        ]),
        "sort_code_quality_flag": flag(reference_rules(
            F.col("sort_code"), F.col("_sort"), F.col("_sort_type") != "delivery_node",
            "cant_be_a_sort_code", missing_label="sort_code_integrity_fail")),
    }
    inherited = F.col("shipment_integrity_quality_flag")
    coherence = {
        "container_coherence_flag": F.col("container_integrity_quality_flag"),
        "shipment_coherence_flag": F.when(inherited != "ok", inherited).otherwise(flag([
            (F.col("_packages").isNull(), "ok"),
            (F.coalesce("_legs", F.lit(0)) != F.col("_packages"), "incoherent_package_count"),
        ])),
    }
    critical = [
        "order_date_quality_flag", "truck_integrity_quality_flag", "origin_integrity_quality_flag",
        "destination_integrity_quality_flag", "sort_code_quality_flag", *coherence,
    ]
    return (
        joined.withColumns(flags).withColumns(coherence)
        .select(*COLUMNS, *flags, *coherence)
        .withColumn("quality_record", score(critical=critical))
    )
