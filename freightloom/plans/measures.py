"""Summary measures over the scored tables and the facts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.functions.casting import stable_round
from freightloom.functions.geo import expected_transit_hours, haversine_km, leg_type
from freightloom.operators.lookup import bounded, node_lookup
from freightloom.operators.percentiles import percentiles
from freightloom.plans.lane_daily import LANE

# Service hours, hub dispatch window, container bands, calibration percentiles.
ON_TIME_HOUR = 10
WINDOW_FROM_HOUR, WINDOW_TO_HOUR = 22, 5
CONTAINER_BANDS = (("light", 1, 9), ("mid", 10, 25), ("heavy", 26, 29), ("peak", 30, 32))
THIN_POINT, THICK_POINT = 0.10, 0.90


def _leg():
    return leg_type(F.col(LANE[0]), F.col(LANE[1]))


def _share(part, whole, places: int = 4):
    return stable_round(F.try_divide(part, whole), places)


def quality_distribution(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, flag column and label (the record score included).

    Rows are counted per combination of labels first; only those few combinations are unpivoted.
    """
    def one(name: str, df: DataFrame) -> DataFrame:
        flags = [c for c in df.columns if c.endswith("_flag") or c == "quality_record"]
        combos = df.groupBy(*flags).agg(F.count(F.lit(1)).alias("_n"))
        labels = F.explode(F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).alias("label")) for c in flags]))
        return combos.select("_n", labels.alias("f")).groupBy(
            F.lit(name).alias("table_name"), "f.flag", "f.label").agg(F.sum("_n").alias("row_count"))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def compliance_summary(fact: DataFrame) -> DataFrame:
    """Compliant share and avoidable cost per lane."""
    rolled = fact.groupBy(*LANE).agg(
        F.count(F.lit(1)).alias("lane_days"), F.count_if("is_compliant").alias("compliant_days"),
        F.sum("mtl_container_count").alias("mtl_containers"), F.sum("box_container_count").alias("box_containers"),
        F.sum("avoidable_cost").alias("avoidable_cost"))
    return rolled.withColumns({
        "avoidable_cost": stable_round(F.col("avoidable_cost"), 2),
        "compliant_share": _share(F.col("compliant_days"), F.col("lane_days"))})


def compliance_by_origin(fact: DataFrame) -> DataFrame:
    """The same roll-up per origin."""
    rolled = fact.groupBy(LANE[0]).agg(
        F.count(F.lit(1)).alias("lane_days"), F.count_if("is_compliant").alias("compliant_days"),
        F.sum("avoidable_cost").alias("avoidable_cost"))
    return rolled.withColumns({
        "avoidable_cost": stable_round(F.col("avoidable_cost"), 2),
        "compliant_share": _share(F.col("compliant_days"), F.col("lane_days"))})


def savings_summary(simulation: DataFrame) -> DataFrame:
    """Costs, saving and non-actionable triplets (negative saving) per category and month."""
    money = {
        "current_cost": "current_monthly_cost_ratio", "recommended_cost": "cost_of_recommended_design",
        "saving": "cost_reduction",
    }
    return simulation.groupBy("category", "departure_month").agg(
        F.count(F.lit(1)).alias("triplets"),
        *[stable_round(F.sum(column), 2).alias(name) for name, column in money.items()],
        F.count_if(F.col("cost_reduction") < 0).alias("non_actionable"))


def ranked_interventions(simulation: DataFrame, limit: int = 50) -> DataFrame:
    """Top redesigns by saving, best first; equal savings in key order."""
    keys = ("departure_month", *LANE, "sort_code")
    ranked = simulation.filter(F.col("cost_reduction").isNotNull()).select(
        *keys, "category", "recommended_hub", stable_round(F.col("cost_reduction"), 2).alias("cost_reduction"))
    return ranked.orderBy(F.desc("cost_reduction"), *keys).limit(limit)


def on_time_share(tms: DataFrame) -> DataFrame:
    """Share of direct and second-leg trucks that arrive before ten."""
    return (
        tms.withColumn("leg_type", _leg())
        .filter(F.col("leg_type").isin("direct", "indirect_leg2") & F.col("arrival_datetime").isNotNull())
        .groupBy("leg_type")
        .agg(F.count(F.lit(1)).alias("trucks"),
             F.count_if(F.hour("arrival_datetime") < ON_TIME_HOUR).alias("on_time"))
        .withColumn("on_time_share", _share(F.col("on_time"), F.col("trucks")))
    )


def departure_window_share(tms: DataFrame) -> DataFrame:
    """Share of trucks leaving a hub between 22:00 and 05:59, per hub."""
    hour = F.hour("departure_datetime")
    inside = (hour >= WINDOW_FROM_HOUR) | (hour <= WINDOW_TO_HOUR)
    return (
        tms.filter((_leg() == "indirect_leg2") & F.col("departure_datetime").isNotNull())
        .groupBy(F.col(LANE[0]).alias("hub_node_id"))
        .agg(F.count(F.lit(1)).alias("trucks"), F.count_if(inside).alias("in_window"))
        .withColumn("in_window_share", _share(F.col("in_window"), F.col("trucks")))
    )


def container_bands(tms: DataFrame) -> DataFrame:
    """Trucks per load band with their share of all trucks in a band."""
    count = F.col("container_count")
    band = reduce(lambda c, b: c.when(count.between(b[1], b[2]), b[0]), CONTAINER_BANDS[1:],
                  F.when(count.between(*CONTAINER_BANDS[0][1:]), CONTAINER_BANDS[0][0]))
    bands = tms.select(band.alias("band")).filter(F.col("band").isNotNull()).groupBy("band").agg(
        F.count(F.lit(1)).alias("trucks"))
    total = bands.agg(F.sum("trucks")).scalar()
    return bands.withColumn("share", _share(F.col("trucks"), total))


def fill_rate(tms: DataFrame) -> DataFrame:
    """Mean volume per container by lane role."""
    return (
        tms.filter(F.col("container_count") > 0).groupBy(_leg().alias("leg_type"))
        .agg(F.count(F.lit(1)).alias("trucks"),
             stable_round(F.avg(F.col("cbm") / F.col("container_count")), 4).alias("avg_fill_rate"))
    )


def lane_leg_types(tms: DataFrame) -> DataFrame:
    """Every lane driven, with its role and number of runs."""
    return tms.groupBy(*LANE).agg(F.count(F.lit(1)).alias("runs")).withColumn("leg_type", _leg())


def hub_coverage(tms: DataFrame) -> DataFrame:
    """Delivery nodes each hub has served."""
    return tms.filter(_leg() == "indirect_leg2").select(
        F.col(LANE[0]).alias("hub_node_id"), F.col(LANE[1]).alias("delivery_node_id")).distinct()


def calibrated_thresholds(triplets: DataFrame) -> DataFrame:
    """Volume thresholds from data: p10 of direct and p90 of indirect monthly volume."""
    points = percentiles(triplets, ["triplet_type"], "adjusted_triplet_cbm", {"thin": THIN_POINT, "thick": THICK_POINT})
    kind = F.col("triplet_type")
    return points.agg(
        stable_round(F.max(F.when(kind == "direct", F.col("thin"))), 2).alias("thin_cbm"),
        stable_round(F.max(F.when(kind == "indirect", F.col("thick"))), 2).alias("thick_cbm"))


def cross_border_lanes(lanes: DataFrame, network: DataFrame) -> DataFrame:
    """Distinct lanes of ``lanes`` between known nodes, marked where the countries differ."""
    pairs, network = lanes.select(*LANE).distinct(), bounded(network)
    for node, role in zip(LANE, ("origin", "destination"), strict=True):
        pairs = node_lookup(pairs, network, node, {"country": f"{role}_country"}, how="inner")
    return pairs.withColumn(
        "is_cross_border", ~F.upper("origin_country").eqNullSafe(F.upper("destination_country")))


def transit_delay(tms: DataFrame, network: DataFrame) -> DataFrame:
    """Expected hours at truck speed and the delay beyond them, as a mean per lane."""
    lanes = tms.filter(F.col("transit_time_hours").isNotNull()).groupBy(*LANE).agg(
        F.count(F.lit(1)).alias("runs"), F.avg("transit_time_hours").alias("_actual"))
    network = bounded(network)
    for node, role in zip(LANE, ("_o", "_d"), strict=True):
        lanes = node_lookup(lanes, network, node, {"latitude": f"{role}_lat", "longitude": f"{role}_lon"}, how="inner")
    km = haversine_km(F.col("_o_lat"), F.col("_o_lon"), F.col("_d_lat"), F.col("_d_lon"))
    return lanes.withColumn("distance_km", km).select(
        *LANE, "runs", "distance_km",
        stable_round(expected_transit_hours(F.col("distance_km")), 4).alias("expected_transit_hours"),
        stable_round(F.col("_actual") - expected_transit_hours(F.col("distance_km")), 4).alias("avg_delay_hours"))
