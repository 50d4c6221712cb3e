"""Monthly lane simulation: classify triplets, recommend a hub, price the redesign.

A triplet is (origin, destination, sort code).  The shipment table is read once; after the monthly
roll-up the frame has one row per triplet and month, and every later step keeps that grain with
window functions instead of joining the frame to itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from freightloom.functions.flags import usable
from freightloom.operators.distances import lane_distance
from freightloom.operators.lookup import attach, bounded
from freightloom.plans.lane_daily import LANE, average_rates

# Volume thresholds per month and the volume of a redesigned truck.
THIN_CBM, THICK_CBM = 138, 322
TRUCK_CBM = 28
NOT_APPLICABLE = "not applicable"

TRIPLET = ["departure_month", *LANE, "sort_code", "triplet_type"]
LANE_MONTH = [*LANE, "departure_month"]
OUTPUT = (
    "departure_month", "origin_node_id", "origin_node_country", "destination_node_id",
    "destination_node_country", "distance1_km", "distance2_km", "direct_distance_km", "sort_code",
    "triplet_type", "adjusted_triplet_cbm", "monthly_triplet_packages", "current_monthly_cost_ratio",
    "monthly_triplet_cbm", "processing_cost_ratio", "leg1_avg_fixed_cost_eur", "leg1_avg_cost_per_km_eur",
    "leg2_avg_fixed_cost_eur", "leg2_avg_cost_per_km_eur", "current_monthly_costs",
    "monthly_processing_costs", "category", "recommended_hub", "deprecation_feasible",
    "cost_of_recommended_design", "cost_reduction",
)


def classify_triplet(origin, destination, sort_code):
    """Direct only if an origin node delivers straight to the sort code."""
    return F.when((destination == sort_code) & origin.like("ON_%"), "direct").otherwise("indirect")


def truck_triplets(wms: DataFrame, tms: DataFrame) -> DataFrame:
    """Packages and pro-rated volume per truck and triplet; legs are counted before they meet the runs."""
    counted = usable(wms).groupBy("truck_id", *LANE, "sort_code").agg(
        F.count("shipment_id").alias("triplet_shipment_count"))
    runs = usable(tms).select(
        "truck_id", F.trunc(F.to_date("departure_datetime"), "MM").alias("departure_month"),
        F.col("cbm").alias("truck_cbm"), F.col("package_count").alias("truck_packages"))
    share = F.try_divide(F.col("triplet_shipment_count").cast("double"), F.col("truck_packages"))
    return counted.join(runs, "truck_id").withColumns({
        "triplet_type": classify_triplet(F.col(LANE[0]), F.col(LANE[1]), F.col("sort_code")),
        "triplet_cbm": share * F.col("truck_cbm"),
    })


def monthly_triplets(wms: DataFrame, tms: DataFrame) -> DataFrame:
    return summed_triplets(truck_triplets(wms, tms))


def summed_triplets(per_truck: DataFrame) -> DataFrame:
    """Packages and volume per triplet and month, over all trucks."""
    return per_truck.groupBy(*TRIPLET).agg(
        F.sum("triplet_shipment_count").alias("monthly_triplet_packages"),
        F.sum("triplet_cbm").alias("monthly_triplet_cbm"))


def hub_totals(triplets: DataFrame) -> DataFrame:
    """Indirect packages and volume per (hub, sort code, month)."""
    return triplets.filter(F.col("triplet_type") == "indirect").groupBy(
        F.col("destination_node_id").alias("hub_node_id"), "sort_code", "departure_month"
    ).agg(F.sum("monthly_triplet_packages").alias("total_hub_dn_packages"),
          F.sum("monthly_triplet_cbm").alias("total_hub_dn_cbm"))


def prorate_cbm(triplets: DataFrame) -> DataFrame:
    """Indirect triplets get their package share of the hub's volume for that sort code and month."""
    same_hub = W.partitionBy("destination_node_id", "sort_code", "departure_month")
    indirect = F.col("triplet_type") == "indirect"
    packages = F.sum(F.when(indirect, F.col("monthly_triplet_packages"))).over(same_hub)
    volume = F.sum(F.when(indirect, F.col("monthly_triplet_cbm"))).over(same_hub)
    return triplets.withColumn("adjusted_triplet_cbm", F.when(
        indirect, F.try_divide(F.col("monthly_triplet_packages"), packages) * volume
    ).otherwise(F.col("monthly_triplet_cbm")))


def enrich_triplets(triplets: DataFrame, network: DataFrame, rates: DataFrame) -> DataFrame:
    """Distances of both legs and of the direct lane, and the country-average rates of both legs."""
    network, mean = bounded(usable(network)), bounded(average_rates(rates))
    leg1 = lane_distance(triplets, network, *LANE, "distance1_km", {
        "start_type": "origin_node_type", "start_country": "origin_node_country",
        "end_type": "destination_node_type", "end_country": "destination_node_country",
    }).filter(F.col("origin_node_type") == "origin_node")
    both = lane_distance(leg1, network, "origin_node_id", "sort_code", "direct_distance_km")
    both = lane_distance(both, network, "destination_node_id", "sort_code", "distance2_km")
    for leg, country in (("leg1", "origin_node_country"), ("leg2", "destination_node_country")):
        both = attach(both, mean, {country: "country"}, {
            "avg_fixed_cost": f"{leg}_avg_fixed_cost_eur", "avg_cost_per_km": f"{leg}_avg_cost_per_km_eur"})
    return both


def nearest_hub(enriched: DataFrame, out: str = "_hub") -> DataFrame:
    """Closest hub seen in any month on the way from the origin to the sort code; ties by hub id."""
    route = W.partitionBy("origin_node_id", "sort_code")
    hub = F.when(F.col("destination_node_type") == "consolidation_hub", F.struct("distance1_km", "destination_node_id"))
    return enriched.withColumn(out, F.min(hub).over(route)["destination_node_id"])


def monthly_lane_costs(lane_daily: DataFrame) -> DataFrame:
    """Cost and volume of a lane per month over all carriers."""
    return lane_daily.groupBy(*LANE, F.trunc("date", "MM").alias("departure_month")).agg(
        F.sum("daily_linehaul_cost_eur").alias("monthly_linehaul_cost_eur"),
        F.sum("daily_cbm").alias("monthly_cbm"))


def triplet_costs(enriched: DataFrame, lane_daily: DataFrame, handling: DataFrame) -> DataFrame:
    """Share of the lane's monthly cost, and hub processing cost; lanes without cost drop out."""
    lane_cost = monthly_lane_costs(lane_daily).select(
        *LANE_MONTH, F.col("monthly_linehaul_cost_eur").alias("current_monthly_costs"))
    joined = enriched.join(lane_cost, LANE_MONTH)
    joined = attach(joined, bounded(usable(handling)), {"destination_node_id": "node_id"}, {"cost_per_package_eur": "_handling"})
    packages = F.col("monthly_triplet_packages")
    processing = F.when(
        F.col("triplet_type") == "indirect", F.col("_handling").cast("double") * packages).otherwise(F.lit(0.0))
    share = packages / F.sum(packages).over(W.partitionBy(*LANE_MONTH))
    return joined.withColumn("monthly_processing_costs", processing).withColumn("_share", share).withColumns({
        "current_monthly_cost_ratio": F.col("_share") * F.col("current_monthly_costs"),
        "processing_cost_ratio": F.col("_share") * F.col("monthly_processing_costs"),
    }).drop("_handling", "_share")


def categorise(df: DataFrame, thin: float | DataFrame = THIN_CBM, thick: float = THICK_CBM) -> DataFrame:
    """thick, thin or healthy by monthly volume.

    ``thin`` may be a one-row frame with columns ``thin_cbm`` and ``thick_cbm`` measured from data.
    """
    if isinstance(thin, DataFrame):
        low, high = (thin.select(c).scalar() for c in ("thin_cbm", "thick_cbm"))
    else:
        low, high = F.lit(thin), F.lit(thick)
    cbm, kind = F.col("adjusted_triplet_cbm"), F.col("triplet_type")
    return df.withColumn("category", F.when((kind == "indirect") & (cbm > high), "thick")
                         .when((kind == "direct") & (cbm < low), "thin").otherwise("healthy"))


def recommend_hub(df: DataFrame) -> DataFrame:
    """Hub for thin lanes, NULL if none qualifies."""
    return df.withColumn("recommended_hub", F.when(F.col("category") == "thin", F.col("_hub"))
                         .otherwise(NOT_APPLICABLE)).drop("_hub")


def simulate_cost(df: DataFrame, network: DataFrame, rates: DataFrame, hub_leg: bool = False) -> DataFrame:
    """Feasibility, cost of the redesign and saving.

    The default prices leg 1 of a thin redesign over the origin-to-destination distance and leg 2 at
    the destination country's rate.  ``hub_leg=True`` prices leg 1 to the hub and leg 2 from it.
    """
    network = bounded(usable(network))
    df = lane_distance(df, network, "recommended_hub", "sort_code", "_hub_km", {"start_country": "_hub_country"})
    leg1_km, fixed2, per_km2 = (F.col(c) for c in
                                ("distance1_km", "leg2_avg_fixed_cost_eur", "leg2_avg_cost_per_km_eur"))
    if hub_leg:
        df = lane_distance(df, network, "origin_node_id", "recommended_hub", "_to_hub_km")
        df = attach(df, bounded(average_rates(rates)), {"_hub_country": "country"},
                    {"avg_fixed_cost": "_hub_fixed", "avg_cost_per_km": "_hub_per_km"})
        leg1_km, fixed2, per_km2 = F.col("_to_hub_km"), F.col("_hub_fixed"), F.col("_hub_per_km")
    trucks = F.col("adjusted_triplet_cbm") / TRUCK_CBM
    fixed1, per_km1 = F.col("leg1_avg_fixed_cost_eur"), F.col("leg1_avg_cost_per_km_eur")
    thin, thick = F.col("category") == "thin", F.col("category") == "thick"
    through_hub = (fixed1 + per_km1 * leg1_km) * trucks + (fixed2 + per_km2 * F.col("_hub_km")) * trucks
    cost = (F.when(thin, through_hub + F.col("processing_cost_ratio"))
            .when(thick, (fixed1 + per_km1 * F.col("direct_distance_km")) * trucks))
    return df.withColumns({
        "deprecation_feasible": F.when(thin, F.col("recommended_hub").isNotNull()),
        "cost_of_recommended_design": cost,
        "cost_reduction": F.col("current_monthly_cost_ratio") - cost,
    })


def lane_simulation(
    wms: DataFrame, tms: DataFrame, network: DataFrame, rates: DataFrame, handling: DataFrame,
    lane_daily: DataFrame, thin: float | DataFrame = THIN_CBM, thick: float = THICK_CBM, hub_leg: bool = False,
) -> DataFrame:
    """Simulation fact: one row per (origin, destination, sort code, month)."""
    return simulation_of(monthly_triplets(wms, tms), network, rates, handling, lane_daily, thin, thick, hub_leg)


def simulation_of(
    monthly: DataFrame, network: DataFrame, rates: DataFrame, handling: DataFrame,
    lane_daily: DataFrame, thin: float | DataFrame = THIN_CBM, thick: float = THICK_CBM, hub_leg: bool = False,
) -> DataFrame:
    """Simulation fact from monthly triplets."""
    triplets = prorate_cbm(monthly)
    enriched = nearest_hub(enrich_triplets(triplets, network, rates))
    costed = triplet_costs(enriched, lane_daily, handling)
    advised = recommend_hub(categorise(costed, thin, thick))
    return simulate_cost(advised, network, rates, hub_leg).select(*OUTPUT)
