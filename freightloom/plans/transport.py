"""Quality-scored truck runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom.functions.casting import blank_to_null, norm, parse_datetime, safe_cast
from freightloom.functions.flags import flag, number_rules, reference_rules, score, usable
from freightloom.operators.keep_first import COPIES, dealt, first_rows, keep_first, ordinal_columns
from freightloom.operators.lookup import bounded, member_flag, node_lookup

# Id format and truck capacity.
TRUCK_ID_FORMAT = r"^TRK_[0-9]{7}\z"
MAX_CONTAINERS = 32

COLUMNS = (
    "truck_id", "origin_node_id", "destination_node_id", "carrier", "departure_datetime",
    "transit_time_hours", "arrival_datetime", "container_count", "package_count", "cbm",
)
CRITICAL_FLAGS = (
    "origin_integrity_quality_flag", "destination_integrity_quality_flag", "truck_id_quality_flag",
    "transit_time_quality_flag", "container_count_quality_flag", "arrival_datetime_quality_flag",
    "departure_datetime_quality_flag",
)


def clock_flag(raw, parsed, *more):
    return flag([(raw.isNull(), "null_in_source"), (parsed.isNull(), "unexpected_format"), *more])


def silver_tms(
    bronze: DataFrame, network: DataFrame, rates: DataFrame, cbm_is_critical: bool = False,
    cell: Column | None = None, rows: int = 0,
) -> DataFrame:
    """One scored row per truck run.

    ``cbm_is_critical=True`` lets load above capacity lower the score, as the written contract says;
    by default the volume and package flags are informative only.

    ``cell``, a number made from the trimmed truck id, says that no truck is hot: the ``rows`` runs are then dealt by it, and
    the result lies by it.
    """
    if cell is None:
        first = keep_first(bronze, ["truck_id"], copies=COPIES)
    else:
        in_cells = dealt(bronze.withColumn("_cell", cell), ["_cell"], rows)
        first = first_rows(in_cells, ["_cell", "truck_id"], ordinal_columns(bronze), COPIES)
    typed = first.select(
        "truck_id",
        norm(F.col("origin_node_id"), "upper").alias("origin_node_id"),
        norm(F.col("destination_node_id"), "upper").alias("destination_node_id"),
        norm(F.col("carrier")).alias("carrier"),
        parse_datetime(F.col("departure_datetime")).alias("departure_datetime"),
        safe_cast(blank_to_null(F.col("transit_time_hours")), "double").alias("transit_time_hours"),
        parse_datetime(F.col("arrival_datetime")).alias("arrival_datetime"),
        safe_cast(blank_to_null(F.col("container_count"), trim=False), "bigint").alias("container_count"),
        safe_cast(blank_to_null(F.col("package_count"), trim=False), "bigint").alias("package_count"),
        safe_cast(blank_to_null(F.col("cbm"), trim=False), "double").alias("cbm"),
        F.col("departure_datetime").alias("_raw_departure"),
        F.col("arrival_datetime").alias("_raw_arrival"),
        COPIES,
    )
    network = bounded(network)
    ends = node_lookup(typed, network, "origin_node_id", {"node_id": "_o", "node_type": "_o_type"})
    ends = node_lookup(ends, network, "destination_node_id", {"node_id": "_d", "node_type": "_d_type"})
    checked = member_flag(ends, "carrier", usable(rates).select("carrier"), "_no_rate")

    truck, departure, arrival = F.col("truck_id"), F.col("departure_datetime"), F.col("arrival_datetime")
    containers, cbm = F.col("container_count"), F.col("cbm")
    # minute boundaries crossed <= 0, i.e. the arrival minute is not after the departure minute
    not_after = F.date_trunc("minute", arrival) <= F.date_trunc("minute", departure)
    flags = {
        "origin_integrity_quality_flag": flag(reference_rules(
            F.col("origin_node_id"), F.col("_o"), F.col("_o_type") == "delivery_node", "cant_be_an_origin")),
        "destination_integrity_quality_flag": flag(reference_rules(
            F.col("destination_node_id"), F.col("_d"), F.col("_d_type") == "origin_node", "cant_be_a_destination")),
        "carrier_integrity_quality_flag": flag([
            (F.col("carrier").isNull(), "null_in_source"), (F.col("_no_rate"), "unknown_node")]),
        "transit_time_quality_flag": flag(number_rules(F.col("transit_time_hours"), above=0)),
        "truck_id_quality_flag": flag([
            (truck.isNull(), "null_in_source"),
            (~truck.rlike(TRUCK_ID_FORMAT), "invalid_format"),
            (F.col(COPIES) > 1, "duplicate"),
        ]),
        "departure_datetime_quality_flag": clock_flag(F.col("_raw_departure"), departure),
        "arrival_datetime_quality_flag": clock_flag(
            F.col("_raw_arrival"), arrival,
            (departure.isNull(), "ok"),
            (not_after, "arrival_before_departure")),
        "container_count_quality_flag": flag(
            number_rules(containers, above=0, limits=(None, MAX_CONTAINERS))),
        "package_count_quality_flag": flag(number_rules(F.col("package_count"), at_least=0)),
        "cbm_quality_flag": flag([
            *number_rules(cbm, at_least=0),
            (containers.isNull(), "ok"),
            (cbm > containers, "out_of_range"),
        ]),
    }
    critical = CRITICAL_FLAGS + (("cbm_quality_flag",) if cbm_is_critical else ())
    return checked.withColumns(flags).select(*COLUMNS, *flags).withColumn(
        "quality_record", score(critical=critical, warning=("carrier_integrity_quality_flag",)))
