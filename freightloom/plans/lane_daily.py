"""Daily lane volume and cost, gap-filled, with 30-day averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from freightloom.functions.casting import impute_label, stable_round
from freightloom.functions.flags import usable
from freightloom.functions.geo import haversine_km
from freightloom.operators.lookup import attach, bounded, usable_endpoints
from freightloom.sources.spine import days

# Default period, label of a missing carrier, length of the average.
START, END = "2025-07-01", "2025-12-31"
UNKNOWN = "UNKNOWN"
AVERAGE_ROWS = 30

LANE = ["origin_node_id", "destination_node_id"]
LANE_CARRIER = [*LANE, "carrier"]
MEASURES = ("daily_trucks", "daily_packages", "daily_cbm")
COLUMNS = (
    "date", "origin_node_country", "origin_node_id", "origin_node_type",
    "destination_node_country", "destination_node_id", "destination_node_type",
    "carrier", "distance_km", *MEASURES, "daily_linehaul_cost_eur", "cost_is_imputed",
    "rolling_avg_cbm_30d", "rolling_avg_cost_30d",
)


def daily_actuals(tms: DataFrame) -> DataFrame:
    """Trucks, packages and volume per (date, lane, carrier) over usable runs."""
    return (
        usable(tms)
        .groupBy(F.to_date("departure_datetime").alias("departure_date"), *LANE,
                 impute_label(F.col("carrier"), UNKNOWN).alias("carrier"))
        .agg(F.count("truck_id").alias("daily_trucks"), F.sum("package_count").alias("daily_packages"),
             F.sum("cbm").alias("daily_cbm"))
    )


def average_rates(rates: DataFrame) -> DataFrame:
    """Mean rate per country over usable rates."""
    return usable(rates).groupBy("country").agg(
        F.avg("fixed_cost_eur").alias("avg_fixed_cost"), F.avg("cost_per_km_eur").alias("avg_cost_per_km"))


def lane_carriers(tms: DataFrame, network: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """One row per (lane, carrier) ever run, with endpoint attributes, distance and its days in the period.

    ``_days`` lists the measures of its run dates and cannot hold more entries than the period has days.  Lanes with an unusable endpoint drop out here, after the runs have been aggregated.
    """
    in_period = F.col("departure_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    entry = F.when(in_period, F.struct(F.col("departure_date").alias("date"), *MEASURES))
    grouped = daily_actuals(tms).groupBy(*LANE_CARRIER).agg(F.collect_list(entry).alias("_days"))
    ends = usable_endpoints(grouped, network, *LANE)
    return ends.withColumn("distance_km", haversine_km(*[
        F.col(f"{end}_node_{axis}") for end in ("origin", "destination") for axis in ("latitude", "longitude")
    ])).drop(*[f"{end}_node_{axis}" for end in ("origin", "destination") for axis in ("latitude", "longitude")])


def fill_days(lanes: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """One row per day: all days of the period for a known carrier, run days only for the unknown one.

    A known carrier's run days are added to a zero entry per day.  The aggregate keeps the partitioning by lane
    and carrier, so nothing is shuffled, and its work is linear in the days.
    """
    types = {f.name: f.dataType for f in lanes.schema["_days"].dataType.elementType}
    zero = F.transform(days(start, end), lambda day: F.struct(
        day.alias("date"), *[F.lit(0).cast(types[m]).alias(m) for m in MEASURES]))
    entries = F.when(F.col("carrier") == UNKNOWN, F.col("_days")).otherwise(F.concat("_days", zero))
    attributes = [c for c in lanes.columns if c != "_days"]
    return (
        lanes.select(*attributes, F.explode(entries).alias("_day")).select(*attributes, "_day.*")
        .groupBy("date", *attributes).agg(*[F.sum(m).alias(m) for m in MEASURES])
    )


def linehaul_cost(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Cost of a day's trucks: the carrier's rate, or the country average for the unknown carrier."""
    quoted = attach(df, bounded(usable(rates)), {"origin_node_country": "country", "carrier": "carrier"},
                    {"fixed_cost_eur": "_fixed", "cost_per_km_eur": "_per_km"})
    both = attach(quoted, average_rates(rates), {"origin_node_country": "country"},
                  {"avg_fixed_cost": "_avg_fixed", "avg_cost_per_km": "_avg_per_km"})
    unknown = F.col("carrier") == UNKNOWN
    fixed, per_km = (F.when(unknown, F.col(a)).otherwise(F.col(q))
                     for a, q in (("_avg_fixed", "_fixed"), ("_avg_per_km", "_per_km")))
    cost = (fixed + F.col("distance_km") * per_km) * F.col("daily_trucks")
    return both.withColumns({
        "daily_linehaul_cost_eur": F.coalesce(cost, F.lit(0.0)), "cost_is_imputed": unknown,
    }).drop("_fixed", "_per_km", "_avg_fixed", "_avg_per_km")


def rolling_average(column: str, rows: int = AVERAGE_ROWS):
    """Mean of the last ``rows`` rows of a lane and carrier (rows, not days)."""
    frame = W.partitionBy(*LANE_CARRIER).orderBy("date").rowsBetween(-(rows - 1), W.currentRow)
    return stable_round(F.avg(column).over(frame), 2)


def lane_daily(
    tms: DataFrame, network: DataFrame, rates: DataFrame, start: str = START, end: str = END
) -> DataFrame:
    """Daily lane fact.

    Runs are aggregated before anything is joined.  Two shuffles carry the whole fact: by
    (date, lane, carrier) for the actuals, then by (lane, carrier); gap filling and the averages
    reuse the second one.
    """
    costed = linehaul_cost(fill_days(lane_carriers(tms, network, start, end), start, end), rates)
    averaged = costed.withColumns({
        "rolling_avg_cbm_30d": rolling_average("daily_cbm"),
        "rolling_avg_cost_30d": rolling_average("daily_linehaul_cost_eur"),
    })
    return averaged.withColumn(
        "daily_linehaul_cost_eur", stable_round(F.col("daily_linehaul_cost_eur"), 2)).select(*COLUMNS)
