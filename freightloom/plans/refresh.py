"""Full refresh: bronze tables in, scored tables and facts out, in dependency order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freightloom.plans.compliance import compliance_of, counted_containers, loaded_containers
from freightloom.plans.lane_daily import END, LANE, START, lane_daily
from freightloom.plans.master_data import (
    silver_configured, silver_handling, silver_network, silver_procurement, silver_rates,
)
from freightloom.plans.shipments import silver_wms
from freightloom.plans.simulation import simulation_of, summed_triplets, truck_triplets
from freightloom.plans.transit import transit_time
from freightloom.plans.transport import silver_tms
from freightloom.sources.colocated import BUCKETS, Pair, publish_pair
from freightloom.sources.sinks import publish, read_table, table_path

SILVER, GOLD, BRONZE = "silver", "gold", "bronze"
LEGS_AND_RUNS = "legs_and_runs_by_truck"


def refresh_silver(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Build and publish the scored tables.  Each is read back before the next one uses it."""
    def raw(name: str) -> DataFrame:
        return read_table(spark, base, BRONZE, name)

    out: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> None:
        out[name] = publish(df, base, SILVER, name)

    put("mdm_network", silver_network(raw("mdm_network")))
    put("fin_transport_rates", silver_rates(raw("fin_transport_rates")))
    put("fin_procurement", silver_procurement(raw("fin_procurement")))
    network = out["mdm_network"]
    put("fin_handling_costs", silver_handling(raw("fin_handling_costs"), network))
    put("mdm_configured_transit_times", silver_configured(raw("mdm_configured_transit_times"), network))
    put("tms_transportation", silver_tms(raw("tms_transportation"), network, out["fin_transport_rates"]))
    put("wms_shipment_details", silver_wms(raw("wms_shipment_details"), out["tms_transportation"], network))
    return out


def colocate_legs(spark: SparkSession, base: str, buckets: int = BUCKETS) -> Pair:
    """Published legs and runs once more, bucketed by truck: worth it when several jobs by truck follow a refresh."""
    legs, runs = (read_table(spark, base, SILVER, name) for name in ("wms_shipment_details", "tms_transportation"))
    return publish_pair(legs, runs, table_path(base, SILVER, LEGS_AND_RUNS), "truck_id", buckets)


def refresh_gold(
    spark: SparkSession, base: str, start: str = START, end: str = END, by_truck: Pair | None = None
) -> dict[str, DataFrame]:
    """Build and publish the facts from the published scored tables.

    With ``by_truck`` from ``colocate_legs`` the legs are not shuffled to meet their runs.
    """
    names = ("mdm_network", "fin_transport_rates", "fin_handling_costs", "fin_procurement",
             "mdm_configured_transit_times", "tms_transportation", "wms_shipment_details")
    network, rates, handling, procurement, configured, tms, wms = (
        read_table(spark, base, SILVER, name) for name in names)
    daily = publish(lane_daily(tms, network, rates, start, end), base, GOLD, "fact_lane_daily", [*LANE, "date"])
    by_truck = by_truck or Pair((wms, tms), None)
    simulation = simulation_of(summed_triplets(by_truck.by_key(truck_triplets)), network, rates, handling, daily)
    compliance = compliance_of(counted_containers(by_truck.by_key(loaded_containers)), network, procurement)
    return {
        "fact_lane_daily": daily,
        "fact_lane_simulation": publish(simulation, base, GOLD, "fact_lane_simulation", LANE),
        "fact_container_compliance": publish(compliance, base, GOLD, "fact_container_compliance", LANE),
        "fact_transit_time": publish(transit_time(tms, configured), base, GOLD, "fact_transit_time", LANE),
    }
