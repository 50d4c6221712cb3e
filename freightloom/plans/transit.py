"""Transit times: runs against configuration, observed percentiles, configuration status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.functions.casting import stable_round
from freightloom.functions.flags import usable
from freightloom.operators.lookup import attach, bounded
from freightloom.operators.percentiles import percentiles
from freightloom.plans.lane_daily import LANE

# The percentiles published per lane, and the slack that makes a configuration too long.
POINTS = {"p50": 0.50, "p90": 0.90, "p95": 0.95, "p98": 0.98}
OVER_SLACK_HOURS = 3


def transit_time(tms: DataFrame, configured: DataFrame) -> DataFrame:
    """Usable runs on configured lanes with both times."""
    joined = attach(usable(tms), bounded(usable(configured)),
                    {"origin_node_id": "origin_node_id", "destination_node_id": "destination_node_id"},
                    {"configured_transit_time_hours": "configured_transit_time_hours"}, how="inner")
    return joined.select(
        F.to_date("departure_datetime").alias("departure_date"), F.hour("departure_datetime").alias("departure_hour"),
        *LANE, "carrier", "transit_time_hours", "configured_transit_time_hours")


def transit_percentiles(tms: DataFrame) -> DataFrame:
    """Observed transit-time percentiles per lane over usable runs."""
    out = percentiles(usable(tms), LANE, "transit_time_hours", POINTS)
    return out.select(*LANE, *[stable_round(F.col(p), 2).alias(p) for p in POINTS])


def transit_drift(fact: DataFrame) -> DataFrame:
    """Measured p95 per lane and carrier against the configured time; drifting where it is longer."""
    keys = [*LANE, "carrier", "configured_transit_time_hours"]
    measured = percentiles(fact, keys, "transit_time_hours", {"p95": 0.95}, count="runs")
    p95 = stable_round(F.col("p95"), 2)
    return measured.select(*keys, "runs", p95.alias("p95_transit_time_hours")).withColumn(
        "is_drifting", F.col("p95_transit_time_hours") > F.col("configured_transit_time_hours"))


def configuration_status(tms: DataFrame, configured: DataFrame) -> DataFrame:
    """Is the configured time of a lane under, over or in line with what is observed?"""
    joined = attach(transit_percentiles(tms), bounded(usable(configured)),
                    {"origin_node_id": "origin_node_id", "destination_node_id": "destination_node_id"},
                    {"configured_transit_time_hours": "configured_transit_time_hours"}, how="inner")
    hours = F.col("configured_transit_time_hours")
    status = (F.when(hours < F.col("p90"), "under_configured")
              .when(hours > F.col("p98") + OVER_SLACK_HOURS, "over_configured").otherwise("correct"))
    return joined.withColumn("configuration_status", status)
