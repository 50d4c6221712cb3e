"""Contract audits.  Each returns the violations, so an empty frame means the rule holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.operators.keep_first import by_group
from freightloom.operators.lookup import bounded
from freightloom.plans.lane_daily import LANE
from freightloom.plans.simulation import classify_triplet


def _direct() -> Column:
    return classify_triplet(F.col(LANE[0]), F.col(LANE[1]), F.col("sort_code")) == "direct"


def package_count_mismatch(tms: DataFrame, wms: DataFrame) -> DataFrame:
    """Trucks whose package count is not the number of their shipment legs."""
    legs = wms.groupBy("truck_id").agg(F.count("shipment_id").alias("shipment_legs"))
    return (
        tms.select("truck_id", "package_count").join(legs, "truck_id", "left")
        .withColumn("shipment_legs", F.coalesce("shipment_legs", F.lit(0)))
        .filter(F.col("package_count") != F.col("shipment_legs"))
    )


def cbm_over_capacity(tms: DataFrame) -> DataFrame:
    """Trucks loaded above one cubic metre per container."""
    return tms.filter(F.col("cbm") > F.col("container_count")).select("truck_id", "container_count", "cbm")


def truck_with_several_lanes(wms: DataFrame) -> DataFrame:
    """Trucks whose legs name more than one origin or destination."""
    lanes = wms.filter(F.col("truck_id").isNotNull()).select("truck_id", *LANE).distinct()
    # one row per truck and endpoint value, then a plain count: no distinct aggregate on raw legs
    ends = lanes.select("truck_id", F.explode(F.array(
        F.struct(F.lit("o").alias("end"), F.col(LANE[0]).alias("node")),
        F.struct(F.lit("d").alias("end"), F.col(LANE[1]).alias("node")))).alias("e")).select("truck_id", "e.*")
    counts = ends.filter(F.col("node").isNotNull()).distinct().groupBy("truck_id").agg(
        F.count_if(F.col("end") == "o").alias("origins"), F.count_if(F.col("end") == "d").alias("destinations"))
    return counts.filter((F.col("origins") > 1) | (F.col("destinations") > 1))


def shipment_not_at_sort_code(wms: DataFrame, tms: DataFrame) -> DataFrame:
    """Shipments whose last leg (by departure, then truck) does not end at the sort code."""
    departures = tms.select("truck_id", "departure_datetime")
    legs = wms.filter(F.col("shipment_id").isNotNull()).select("shipment_id", "truck_id", LANE[1], "sort_code")
    last = legs.join(departures, "truck_id").groupBy("shipment_id").agg(
        F.max(F.struct("departure_datetime", "truck_id", LANE[1], "sort_code")).alias("leg"))
    return last.select("shipment_id", "leg.truck_id", f"leg.{LANE[1]}", "leg.sort_code").filter(
        F.col(LANE[1]) != F.col("sort_code"))


def leg_count_violations(wms: DataFrame) -> DataFrame:
    """Shipments with a direct leg and other legs beside it, or without one and not exactly two legs."""
    counts = wms.filter(F.col("shipment_id").isNotNull()).groupBy("shipment_id").agg(
        F.count(F.lit(1)).alias("legs"), F.coalesce(F.bool_or(_direct()), F.lit(False)).alias("is_direct"))
    expected = F.when(F.col("is_direct"), 1).otherwise(2)
    return counts.filter(F.col("legs") != expected).withColumn(
        "rule", F.when(F.col("is_direct"), "direct_has_one_leg").otherwise("indirect_has_two_legs"))


def direct_leg_violations(wms: DataFrame) -> DataFrame:
    return leg_count_violations(wms).filter(F.col("is_direct"))


def indirect_leg_violations(wms: DataFrame) -> DataFrame:
    return leg_count_violations(wms).filter(~F.col("is_direct"))


def mixed_path_types(wms: DataFrame) -> DataFrame:
    """(origin, sort code) pairs served both directly and through a hub."""
    return (
        wms.filter(F.col(LANE[0]).startswith("ON_") & F.col("sort_code").isNotNull())
        .groupBy(LANE[0], "sort_code")
        .agg(F.count_if(_direct()).alias("direct_legs"), F.count_if(~_direct()).alias("indirect_legs"))
        .filter((F.col("direct_legs") > 0) & (F.col("indirect_legs") > 0))
    )


def reused_hub_containers(wms: DataFrame) -> DataFrame:
    """Containers that both enter and leave the same hub."""
    def side(node, inbound):
        return wms.filter(F.col(node).startswith("CH_") & F.col("container_id").isNotNull()).select(
            F.col(node).alias("hub_node_id"), "container_id", F.lit(inbound).alias("_in"))

    both, keys = side(LANE[1], True).unionByName(side(LANE[0], False)), ("hub_node_id", "container_id")
    return by_group(both, keys, lambda rows: rows.groupBy(*keys).agg(
        F.count_if(F.col("_in")).alias("inbound_legs"), F.count_if(~F.col("_in")).alias("outbound_legs")
    ).filter((F.col("inbound_legs") > 0) & (F.col("outbound_legs") > 0)))


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, key: str, table: str) -> DataFrame:
    """Values of foreign keys to one parent without a row there, with the number of rows that carry them.

    The child is read once: its combinations of keys are counted first and taken apart then.
    """
    combined = child.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    each = combined.select("rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("k"))
    values = each.select("k.*", "rows").filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.sum("rows").alias("row_count"))
    keys = parent.select(F.col(key).alias("value"))
    return values.join(keys, "value", "left_anti").select(
        F.lit(table).alias("table_name"), "column_name", "value", "row_count")


def foreign_key_orphans(
    network: DataFrame, tms: DataFrame, wms: DataFrame, handling: DataFrame | None = None
) -> DataFrame:
    """Orphans of every foreign key in the contract."""
    network = bounded(network)
    # Spark goes by the bytes of the files, in which ids take next to nothing, and would collect all trucks in the driver
    trucks = tms.select("truck_id").hint("shuffle_merge")
    checks = [
        orphans(tms, LANE, network, "node_id", "tms_transportation"),
        orphans(wms, (*LANE, "sort_code"), network, "node_id", "wms_shipment_details"),
        orphans(wms, ("truck_id",), trucks, "truck_id", "wms_shipment_details"),
    ]
    if handling is not None:
        checks.append(orphans(handling, ("node_id",), network, "node_id", "fin_handling_costs"))
    return reduce(DataFrame.unionByName, checks)


def unreachable_nodes(network: DataFrame, lanes: DataFrame) -> DataFrame:
    """Delivery nodes at which no lane of ``lanes`` ends."""
    served = lanes.select(F.col("destination_node_id").alias("node_id")).distinct()
    return network.filter(F.col("node_type") == "delivery_node").select("node_id", "city", "country").join(
        served, "node_id", "left_anti")


def container_reconciliation(tms: DataFrame, wms: DataFrame) -> DataFrame:
    """Trucks whose distinct container ids differ from the declared container count."""
    seen = wms.filter(F.col("container_id").isNotNull()).select("truck_id", "container_id").distinct().groupBy(
        "truck_id").agg(F.count(F.lit(1)).alias("containers_seen"))
    return (
        tms.select("truck_id", "container_count").join(seen, "truck_id", "left")
        .withColumn("containers_seen", F.coalesce("containers_seen", F.lit(0)))
        .filter(F.col("container_count") != F.col("containers_seen"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Primary-key values (as one text) that occur more than once."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("NULL")) for k in keys])
    found = by_group(df.select(*keys), keys, lambda rows: rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1))
    return found.select(F.lit(table).alias("table_name"), text.alias("key_value"), "row_count")


def primary_key_violations(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [duplicate_keys(df, keys, name) for name, (df, keys) in tables.items()])


def schema_changes(spark: SparkSession, actual: T.StructType, contract: T.StructType) -> DataFrame:
    """Differences between a schema and its contract; removals and type changes break consumers."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in contract}
    rows = [(c, "removed", want[c], None, True) for c in want if c not in have]
    rows += [(c, "retyped", want[c], have[c], True) for c in want if c in have and have[c] != want[c]]
    rows += [(c, "added", None, have[c], False) for c in have if c not in want]
    return spark.createDataFrame(
        rows, "column_name string, change string, expected_type string, actual_type string, is_breaking boolean")
