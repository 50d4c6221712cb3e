"""Table catalogue: raw columns, keys and the typed columns consumers may rely on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)
S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
DATE, NTZ = T.DateType(), T.TimestampNTZType()


@dataclass(frozen=True)
class Feed:
    """One raw extract: its columns, grain and refresh mode."""

    columns: tuple[str, ...]
    grain: tuple[str, ...]
    append_only: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, S, True) for c in self.columns])


# The extracts and their header columns.
FEEDS: dict[str, Feed] = {
    "mdm_network": Feed(
        ("node_id", "node_type", "city", "country", "latitude", "longitude", "node_capability"), ("node_id",)
    ),
    "fin_transport_rates": Feed(
        ("country", "carrier", "fixed_cost_eur", "cost_per_km_eur"), ("country", "carrier")
    ),
    "fin_handling_costs": Feed(("node_id", "cost_per_package_eur"), ("node_id",)),
    "fin_procurement": Feed(("item", "cost_per_unit_eur", "reusable", "description"), ("item",)),
    "mdm_configured_transit_times": Feed(
        ("origin_node_id", "destination_node_id", "configured_transit_time_hours", "configuration_type"),
        ("origin_node_id", "destination_node_id"),
    ),
    "tms_transportation": Feed(
        (
            "truck_id", "origin_node_id", "destination_node_id", "carrier", "departure_datetime",
            "transit_time_hours", "arrival_datetime", "container_count", "package_count", "cbm",
        ),
        ("truck_id",),
        append_only=True,
    ),
    "wms_shipment_details": Feed(
        (
            "shipment_id", "truck_id", "container_id", "order_date",
            "origin_node_id", "destination_node_id", "sort_code",
        ),
        ("shipment_id", "truck_id"),
        append_only=True,
    ),
}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Typed columns of the quality-scored tables (flag columns, all strings, come on top).
CONTRACT: dict[str, T.StructType] = {
    "mdm_network": _struct(
        node_id=S, node_type=S, city=S, country=S, latitude=NUMERIC, longitude=NUMERIC,
        node_capability=S, quality_record=S,
    ),
    "fin_transport_rates": _struct(
        country=S, carrier=S, fixed_cost_eur=D, cost_per_km_eur=D, quality_record=S
    ),
    "fin_handling_costs": _struct(node_id=S, cost_per_package_eur=NUMERIC, quality_record=S),
    "fin_procurement": _struct(
        item=S, cost_per_unit_eur=D, reusable=B, description=S, quality_record=S
    ),
    "mdm_configured_transit_times": _struct(
        origin_node_id=S, destination_node_id=S, configured_transit_time_hours=D,
        configuration_type=S, quality_record=S,
    ),
    "tms_transportation": _struct(
        truck_id=S, origin_node_id=S, destination_node_id=S, carrier=S, departure_datetime=NTZ,
        transit_time_hours=D, arrival_datetime=NTZ, container_count=L, package_count=L, cbm=D,
        quality_record=S,
    ),
    "wms_shipment_details": _struct(
        shipment_id=S, truck_id=S, container_id=S, order_date=DATE, origin_node_id=S,
        destination_node_id=S, sort_code=S, quality_record=S,
    ),
}

# Flag columns of the quality-scored tables, all strings, between the typed columns and the score.
FLAGS: dict[str, tuple[str, ...]] = {
    "mdm_network": (
        "node_quality_flag", "node_type_quality_flag", "city_quality_flag", "country_quality_flag",
        "coordinates_quality_flag", "capabilities_quality_flag",
    ),
    "fin_transport_rates": (
        "duplicates_flag", "country_quality_flag", "carrier_quality_flag", "fixed_cost_quality_flag", "cost_per_km_quality_flag",
    ),
    "fin_handling_costs": ("node_integrity_quality_flag", "cost_quality_flag"),
    "fin_procurement": ("item_quality_flag", "cost_per_unit_quality_flag", "reusable_quality_flag"),
    "mdm_configured_transit_times": (
        "origin_node_integrity_quality_flag", "transit_time_quality_flag", "destination_node_integrity_quality_flag",
    ),
    "tms_transportation": (
        "origin_integrity_quality_flag", "destination_integrity_quality_flag", "carrier_integrity_quality_flag",
        "transit_time_quality_flag", "truck_id_quality_flag", "departure_datetime_quality_flag", "arrival_datetime_quality_flag",
        "container_count_quality_flag", "package_count_quality_flag", "cbm_quality_flag",
    ),
    "wms_shipment_details": (
        "order_date_quality_flag", "truck_integrity_quality_flag", "origin_integrity_quality_flag",
        "destination_integrity_quality_flag", "container_integrity_quality_flag", "shipment_integrity_quality_flag",
        "sort_code_quality_flag", "container_coherence_flag", "shipment_coherence_flag",
    ),
}

# Columns and keys of the facts; a transit time has no key of its own.
FACTS: dict[str, T.StructType] = {
    "fact_lane_daily": _struct(
        date=DATE, origin_node_country=S, origin_node_id=S, origin_node_type=S, destination_node_country=S,
        destination_node_id=S, destination_node_type=S, carrier=S, distance_km=D, daily_trucks=L, daily_packages=L,
        daily_cbm=D, daily_linehaul_cost_eur=D, cost_is_imputed=B, rolling_avg_cbm_30d=D, rolling_avg_cost_30d=D,
    ),
    "fact_lane_simulation": _struct(
        departure_month=DATE, origin_node_id=S, origin_node_country=S, destination_node_id=S, destination_node_country=S,
        distance1_km=D, distance2_km=D, direct_distance_km=D, sort_code=S, triplet_type=S, adjusted_triplet_cbm=D,
        monthly_triplet_packages=L, current_monthly_cost_ratio=D, monthly_triplet_cbm=D, processing_cost_ratio=D,
        leg1_avg_fixed_cost_eur=D, leg1_avg_cost_per_km_eur=D, leg2_avg_fixed_cost_eur=D, leg2_avg_cost_per_km_eur=D,
        current_monthly_costs=D, monthly_processing_costs=D, category=S, recommended_hub=S, deprecation_feasible=B,
        cost_of_recommended_design=D, cost_reduction=D,
    ),
    "fact_container_compliance": _struct(
        departure_date=DATE, origin_node_id=S, destination_node_id=S, node_capability=S, mtl_container_count=L,
        box_container_count=L, is_compliant=B, compliance_percentage=D, avoidable_cost=D,
    ),
    "fact_transit_time": _struct(
        departure_date=DATE, departure_hour=T.IntegerType(), origin_node_id=S, destination_node_id=S, carrier=S,
        transit_time_hours=D, configured_transit_time_hours=D,
    ),
}
FACT_KEYS: dict[str, tuple[str, ...]] = {
    "fact_lane_daily": ("date", "origin_node_id", "destination_node_id", "carrier"),
    "fact_lane_simulation": ("departure_month", "origin_node_id", "destination_node_id", "sort_code"),
    "fact_container_compliance": ("departure_date", "origin_node_id", "destination_node_id"),
    "fact_transit_time": (),
}


def declared() -> dict[str, tuple[T.StructType, tuple[str, ...]]]:
    """Full schema, flags included, and key of every published table."""
    scored = {}
    for name, typed in CONTRACT.items():
        fields = [f for f in typed if f.name != "quality_record"]
        last = [T.StructField(c, S, True) for c in (*FLAGS[name], "quality_record")]
        scored[name] = (T.StructType(fields + last), FEEDS[name].grain)
    return scored | {name: (schema, FACT_KEYS[name]) for name, schema in FACTS.items()}
