"""Container compliance per day and lane, with the avoidable cost of cardboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.functions.casting import stable_round
from freightloom.functions.flags import SCORE, usable
from freightloom.operators.keep_first import by_group
from freightloom.operators.lookup import attach, bounded, node_lookup
from freightloom.plans.lane_daily import LANE
from freightloom.plans.shipments import container_type

BOX_ITEM = "BOX_CONTAINER"
LEG = ["truck_id", *LANE]


def loaded_containers(wms: DataFrame, tms: DataFrame) -> DataFrame:
    """Container, lane and date of what was loaded on runs of the same lane, truck by truck.

    The lane is compared outside the keys of the join, so that tables bucketed by truck meet without a shuffle.
    """
    loaded = usable(wms).select(*LEG, "container_id").distinct()
    runs = usable(tms).select(
        F.col("truck_id").alias("_run"), *[F.col(c).alias(f"_{c}") for c in LANE],
        F.to_date("departure_datetime").alias("departure_date"))
    same_lane = [F.coalesce(F.col(c) == F.col(f"_{c}"), F.lit(False)) for c in LANE]
    return loaded.join(runs, [F.col("truck_id") == F.col("_run"), *same_lane]).select("departure_date", *LANE, "container_id")


def container_counts(wms: DataFrame, tms: DataFrame) -> DataFrame:
    """Distinct metal and cardboard containers per (date, lane).

    Containers are made distinct first and then summed: no row is multiplied per distinct aggregate,
    and copies collapse before each shuffle.
    """
    legs = wms.select(*LEG, "container_id", SCORE)
    return counted_containers(by_group(legs, ["truck_id"], lambda rows: loaded_containers(rows, tms)))


def counted_containers(loaded: DataFrame) -> DataFrame:
    daily = loaded.distinct()
    kind = container_type(F.col("container_id"))
    return daily.groupBy("departure_date", *LANE).agg(
        F.count_if(kind == "MTL").alias("mtl_container_count"),
        F.count_if(kind == "BOX").alias("box_container_count"))


def container_compliance(wms: DataFrame, tms: DataFrame, network: DataFrame, procurement: DataFrame) -> DataFrame:
    return compliance_of(container_counts(wms, tms), network, procurement)


def compliance_of(counts: DataFrame, network: DataFrame, procurement: DataFrame) -> DataFrame:
    """Compliance from counts per (date, lane)."""
    counts = node_lookup(counts, bounded(usable(network)), "destination_node_id",
                         {"node_capability": "node_capability"})
    # the item is every row's, so only a broadcast or a split of the counts keeps this join from one task
    prices = usable(procurement).filter(F.col("item") == BOX_ITEM).select("item", "cost_per_unit_eur")
    priced = attach(counts.withColumn("_item", F.lit(BOX_ITEM)), bounded(prices), {"_item": "item"}, {"cost_per_unit_eur": "_price"})
    mtl, box, capability = (F.col(c) for c in ("mtl_container_count", "box_container_count", "node_capability"))
    total = mtl + box
    return priced.withColumns({
        "is_compliant": ~F.coalesce(
            ((capability == "MTL") & (box > 0)) | ((capability == "BOX") & (mtl > 0)), F.lit(False)),
        "compliance_percentage": F.when(capability == "MTL", stable_round(F.try_divide(mtl, total) * 100, 2))
        .when(capability == "BOX", stable_round(F.try_divide(box, total) * 100, 2)),
        "avoidable_cost": F.when(capability == "MTL", stable_round(box * F.col("_price"), 2))
        .when(capability == "BOX", F.lit(0.0)),
    }).select("departure_date", *LANE, "node_capability", "mtl_container_count", "box_container_count",
              "is_compliant", "compliance_percentage", "avoidable_cost")
