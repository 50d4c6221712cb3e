"""Quality-scored reference tables: network, rates, handling, procurement, configured times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.functions.casting import (
    NUMERIC, blank_to_null, correct_enum, norm, parse_bool, safe_cast,
)
from freightloom.functions.flags import flag, in_range, number_rules, reference_rules, score
from freightloom.operators.keep_first import COPIES, keep_first
from freightloom.operators.lookup import bounded, node_lookup

# Vocabularies, formats and business limits of the reference data.
NODE_TYPES = {"ON": "origin_node", "CH": "consolidation_hub", "DN": "delivery_node"}
NODE_ID_FORMAT = r"^(ON|CH|DN)_[A-Z]{2,4}\z"
CAPABILITIES = ("BOX", "MTL", "ALL")
COUNTRIES = ("FR", "DE", "ES", "IT", "NL", "BE", "PL", "CZ")
LATITUDE_LIMITS = (35, 72)
LONGITUDE_LIMITS = (-10, 40)
FIXED_COST_LIMITS = (200, 500)
COST_PER_KM_LIMITS = (0.5, 5)
HANDLING_COST_LIMITS = (1, 2.5)
UNKNOWN_PREFIX = "unknown_prefix"


def expected_node_type(node_id):
    """Node type implied by the first two letters of the id."""
    prefix = F.substring(norm(node_id, "upper"), 1, 2)
    return flag([(prefix == p, t) for p, t in NODE_TYPES.items()], default=UNKNOWN_PREFIX)


def silver_network(bronze: DataFrame, upper_country: bool = False) -> DataFrame:
    """One scored row per node: typed, node type corrected from the id prefix, first row kept.

    ``upper_country=True`` folds the country code as the written contract says; the default keeps
    the case of the source.
    """
    first = keep_first(bronze, ["node_id"])
    raw_type = norm(F.col("node_type"), "lower")
    cast = first.select(
        norm(F.col("node_id"), "upper").alias("node_id"),
        F.coalesce(F.col("node_id").rlike(NODE_ID_FORMAT), F.lit(False)).alias("_well_formed"),
        raw_type.alias("_raw_type"),
        correct_enum(raw_type, tuple(NODE_TYPES.values()), expected_node_type(F.col("node_id"))).alias("node_type"),
        blank_to_null(F.col("city")).alias("city"),
        blank_to_null(F.upper("country") if upper_country else F.col("country")).alias("country"),
        *[safe_cast(blank_to_null(F.col(c)), NUMERIC).alias(c) for c in ("latitude", "longitude")],
        norm(F.col("node_capability"), "upper").alias("node_capability"),
    )
    lat, lon, capability = F.col("latitude"), F.col("longitude"), F.col("node_capability")
    on_map = in_range(lat, *LATITUDE_LIMITS) & in_range(lon, *LONGITUDE_LIMITS)
    flagged = cast.withColumns({
        "node_quality_flag": flag([
            (F.col("node_id").isNull(), "null_in_source"),
            (~F.col("_well_formed"), "unexpected_node_format"),
        ]),
        "node_type_quality_flag": flag([
            (F.col("node_type") == UNKNOWN_PREFIX, "invalid_value"),
            (F.col("_raw_type").isNull(), "null_in_source"),
            (F.col("node_type") != F.col("_raw_type"), "corrected"),
        ]),
        "city_quality_flag": flag([(F.col("city").isNull(), "null_in_source")]),
        "country_quality_flag": flag([
            (F.col("country").isNull(), "null_in_source"),
            (F.length("country") != 2, "not_iso_format"),
        ]),
        "coordinates_quality_flag": flag([
            (lat.isNull() | lon.isNull(), "null_in_source"),
            (~on_map, "invalid_value"),
        ]),
        "capabilities_quality_flag": flag([
            (capability.isNull(), "null_in_source"),
            (~capability.isin(*CAPABILITIES), "unexpected_capability"),
        ]),
    })
    return flagged.drop("_well_formed", "_raw_type").withColumn("quality_record", score(
        critical={
            "node_quality_flag": ("ok",),
            "node_type_quality_flag": ("ok", "corrected"),
            "coordinates_quality_flag": ("ok",),
        },
        warning=("city_quality_flag", "capabilities_quality_flag", "country_quality_flag"),
    ))


def silver_rates(bronze: DataFrame) -> DataFrame:
    """One scored row per (country, carrier).  A trimmed carrier or a repeated key is critical."""
    cleaned = bronze.withColumns({
        "_raw_carrier": F.col("carrier"),
        "country": norm(F.col("country"), "upper"),
        "carrier": norm(F.col("carrier")),
    })
    first = keep_first(cleaned, ["country", "carrier"], copies=COPIES)
    typed = first.withColumns({
        c: safe_cast(blank_to_null(F.col(c), trim=False), "double") for c in ("fixed_cost_eur", "cost_per_km_eur")
    })
    country = F.col("country")
    flags = {
        "duplicates_flag": flag([(F.col(COPIES) > 1, "duplicate")]),
        "country_quality_flag": flag([
            (country.isNull(), "null_in_source"),
            (F.length(country) != 2, "invalid_format"),
            (~country.isin(*COUNTRIES), "invalid_country"),
        ]),
        "carrier_quality_flag": flag([
            (F.col("_raw_carrier").isNull(), "null_in_source"),
            (F.col("carrier") != F.col("_raw_carrier"), "corrected"),
        ]),
        "fixed_cost_quality_flag": flag(
            number_rules(F.col("fixed_cost_eur"), above=0, limits=FIXED_COST_LIMITS)),
        "cost_per_km_quality_flag": flag(
            number_rules(F.col("cost_per_km_eur"), above=0, limits=COST_PER_KM_LIMITS)),
    }
    return (
        typed.withColumns(flags)
        .select("country", "carrier", "fixed_cost_eur", "cost_per_km_eur", *flags)
        .withColumn("quality_record", score(critical=list(flags)))
    )


def silver_handling(bronze: DataFrame, network: DataFrame) -> DataFrame:
    """One scored row per hub with its cost per package."""
    cleaned = bronze.withColumn("node_id", norm(F.col("node_id"), "upper"))
    first = keep_first(cleaned, ["node_id"], copies=COPIES)
    typed = first.withColumn(
        "cost_per_package_eur", safe_cast(blank_to_null(F.col("cost_per_package_eur"), trim=False), NUMERIC))
    joined = node_lookup(typed, bounded(network), "node_id", {"node_id": "_node", "node_type": "_type"})
    flags = {
        "node_integrity_quality_flag": flag([
            *reference_rules(F.col("node_id"), F.col("_node"),
                             F.col("_type") != "consolidation_hub", "invalid_node_type"),
            (F.col(COPIES) > 1, "duplicate"),
        ]),
        "cost_quality_flag": flag(number_rules(
            F.col("cost_per_package_eur"), above=0, bad="invalid_cost", limits=HANDLING_COST_LIMITS)),
    }
    return (
        joined.withColumns(flags)
        .select("node_id", "cost_per_package_eur", *flags)
        .withColumn("quality_record", score(critical=list(flags)))
    )


def silver_procurement(bronze: DataFrame) -> DataFrame:
    """Scored container prices; no deduplication."""
    flags = {
        "item_quality_flag": flag([(F.col("item").isNull(), "null_in_source")]),
        "cost_per_unit_quality_flag": flag(
            number_rules(F.col("cost_per_unit_eur"), above=0, bad="invalid_cost")),
        "reusable_quality_flag": flag([(F.col("reusable").isNull(), "invalid_format")]),
    }
    return (
        bronze.select(
            norm(F.col("item"), "upper").alias("item"),
            safe_cast(F.col("cost_per_unit_eur"), "double").alias("cost_per_unit_eur"),
            parse_bool(F.col("reusable")).alias("reusable"),
            "description",
        )
        .withColumns(flags)
        .withColumn("quality_record", score(
            critical=("item_quality_flag", "cost_per_unit_quality_flag"), warning=("reusable_quality_flag",)))
    )


def silver_configured(bronze: DataFrame, network: DataFrame) -> DataFrame:
    """Scored configured transit times; ids are taken as they are, no deduplication."""
    hours = F.col("configured_transit_time_hours")
    typed = bronze.select(
        "origin_node_id", "destination_node_id", safe_cast(hours, "double").alias("configured_transit_time_hours"),
        "configuration_type",
    )
    network = bounded(network)
    ends = node_lookup(typed, network, "origin_node_id", {"node_id": "_o", "node_type": "_o_type"})
    ends = node_lookup(ends, network, "destination_node_id", {"node_id": "_d", "node_type": "_d_type"})
    flags = {
        "origin_node_integrity_quality_flag": flag(reference_rules(
            F.col("origin_node_id"), F.col("_o"),
            ~F.col("_o_type").isin("origin_node", "consolidation_hub"), "cant_be_an_origin",
            null_label="null_in_origin", missing_label="unknown_node")),
        "transit_time_quality_flag": flag(number_rules(hours, above=0)),
        "destination_node_integrity_quality_flag": flag(reference_rules(
            F.col("destination_node_id"), F.col("_d"),
            ~F.col("_d_type").isin("consolidation_hub", "delivery_node"), "cant_be_a_destination",
            missing_label="unknown_node")),
    }
    return (
        ends.withColumns(flags).drop("_o", "_o_type", "_d", "_d_type")
        .withColumn("quality_record", score(critical=list(flags)))
    )
