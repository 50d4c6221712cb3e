from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freightloom.functions.geo import haversine_km
from freightloom.plans import simulation as sim
from freightloom.plans.compliance import container_compliance
from freightloom.plans.lane_daily import lane_daily
from freightloom.plans.measures import calibrated_thresholds
from freightloom.plans.transit import configuration_status, transit_drift, transit_percentiles, transit_time
from tests.conftest import by

DAY = dt.datetime(2025, 7, 1, 8)


def run(n, day=0, origin="ON_AA", destination="DN_AA", carrier="Alpha", packages=10, cbm=5.0, **more):
    return {"truck_id": f"TRK_{n:07d}", "origin_node_id": origin, "destination_node_id": destination, "carrier": carrier,
            "departure_datetime": DAY + dt.timedelta(days=day), "package_count": packages, "cbm": cbm,
            "transit_time_hours": 5.0, **more}


def km(spark, a, b):
    df = spark.createDataFrame([(*a, *b)], "a double, b double, c double, d double")
    return df.select(haversine_km(*map(F.col, "abcd"))).first()[0]


PARIS, LYON = (48.86, 2.35), (45.75, 4.85)


def test_lane_daily(spark, typed, network, rates):
    tms = typed("tms_transportation", run(1), run(2), run(3, 2), run(4, 1, carrier=None), run(5, -1, carrier="Beta"),
                run(6, 1, carrier=None, quality_record="critical"), run(7, 99, carrier=None),
                run(8, 0, destination="DN_ZZ"), run(9, 3, carrier="Ghost", quality_record="warning"))
    rows = lane_daily(tms, network, rates, "2025-07-01", "2025-08-09").collect()
    assert len(rows) == 3 * 40 + 1  # known carriers on every day, the unknown one on its run day
    cell = {(r.carrier, r.date.isoformat()): r for r in rows}
    distance = km(spark, LYON, PARIS)
    first = cell["Alpha", "2025-07-01"]
    assert (first.daily_trucks, first.daily_packages, first.daily_cbm, first.distance_km) == (2, 20, 10.0, distance)
    assert first.daily_linehaul_cost_eur == round(2 * (300 + distance), 2) and not first.cost_is_imputed
    gap = cell["Alpha", "2025-07-02"]
    assert (gap.daily_trucks, gap.daily_packages, gap.daily_cbm, gap.daily_linehaul_cost_eur) == (0, 0, 0.0, 0.0)
    assert gap.rolling_avg_cbm_30d == 5.0
    assert cell["Alpha", "2025-07-30"].rolling_avg_cbm_30d == 0.5  # 15 over 30 rows
    assert cell["Alpha", "2025-07-31"].rolling_avg_cbm_30d == 0.17  # the first day has left the frame
    unknown = cell["UNKNOWN", "2025-07-02"]
    assert unknown.cost_is_imputed and unknown.daily_linehaul_cost_eur == round(350 + 1.5 * distance, 2)
    assert all(cell["Beta", d].daily_trucks == 0 for c, d in cell if c == "Beta")  # ran before the period only
    assert cell["Ghost", "2025-07-04"].daily_linehaul_cost_eur == 0.0  # no rate


def test_lane_daily_lowercase_country_has_no_rate(typed, network, rates):
    tms = typed("tms_transportation", run(1, origin="ON_CC"))
    assert lane_daily(tms, network, rates, "2025-07-01", "2025-07-01").first().daily_linehaul_cost_eur == 0.0


def test_lane_daily_null_volume(typed, network, rates):
    tms = typed("tms_transportation", run(1, packages=None, cbm=None), run(2, carrier=None, packages=None, cbm=None))
    got = by(lane_daily(tms, network, rates, "2025-07-01", "2025-07-01"), "carrier", "daily_packages", "daily_cbm")
    assert got == {"Alpha": (0, 0.0), "UNKNOWN": (None, None)}


def test_lane_daily_plan_shuffles_twice(typed, network, rates):
    tms = typed("tms_transportation", run(1))
    df = lane_daily(tms, network, rates)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan


def leg(n, truck, origin, destination, sort, container="MTL_1", **more):
    return {"shipment_id": f"SHP_{n:09d}", "truck_id": f"TRK_{truck:07d}", "container_id": container,
            "origin_node_id": origin, "destination_node_id": destination, "sort_code": sort, **more}


@pytest.fixture(scope="module")
def small(spark, typed, network, rates):
    """Direct ON_AA->DN_AA; ON_AA and ON_BB through CH_AA to DN_AA; leg 2 runs; one truck without packages."""
    tms = typed("tms_transportation",
                run(1, packages=4, cbm=100.0), run(2, destination="CH_AA", packages=3, cbm=30.0),
                run(3, origin="ON_BB", destination="CH_AA", packages=1, cbm=10.0),
                run(4, origin="CH_AA", packages=4, cbm=40.0), run(5, origin="ON_BB", destination="DN_BB", packages=0, cbm=9.0))
    wms = typed("wms_shipment_details",
                *[leg(i, 1, "ON_AA", "DN_AA", "DN_AA") for i in range(4)],
                *[leg(10 + i, 2, "ON_AA", "CH_AA", "DN_AA") for i in range(3)],
                leg(13, 3, "ON_BB", "CH_AA", "DN_AA"),
                *[leg(10 + i, 4, "CH_AA", "DN_AA", "DN_AA") for i in range(4)],
                leg(20, 5, "ON_BB", "DN_BB", "DN_BB"), leg(21, 1, "ON_AA", "DN_AA", "DN_AA", quality_record="critical"))
    handling = typed("fin_handling_costs", {"node_id": "CH_AA", "cost_per_package_eur": Decimal(2)})
    daily = lane_daily(tms, network, rates).persist()
    return wms, tms, network, rates, handling, daily


def test_triplets_and_prorating(small):
    wms, tms, *_ = small
    got = {(r.origin_node_id, r.destination_node_id): r for r in sim.prorate_cbm(sim.monthly_triplets(wms, tms)).collect()}
    assert got["ON_AA", "DN_AA"].triplet_type == "direct" and got["CH_AA", "DN_AA"].triplet_type == "indirect"
    assert got["ON_AA", "DN_AA"].adjusted_triplet_cbm == 100.0
    assert got["ON_AA", "CH_AA"].adjusted_triplet_cbm == 30.0  # 3/4 of the hub's 40
    assert got["ON_BB", "CH_AA"].adjusted_triplet_cbm == 10.0
    assert got["ON_BB", "DN_BB"].monthly_triplet_cbm is None  # no packages declared on the truck
    totals = sim.hub_totals(sim.monthly_triplets(wms, tms))
    assert by(totals, "hub_node_id", "total_hub_dn_packages", "total_hub_dn_cbm") == {
        "CH_AA": (4, 40.0), "DN_AA": (4, 40.0)}


def test_simulation(spark, small):
    rows = sim.lane_simulation(*small, thin=138, thick=25).collect()
    got = {(r.origin_node_id, r.destination_node_id): r for r in rows}
    assert set(got) == {("ON_AA", "DN_AA"), ("ON_AA", "CH_AA"), ("ON_BB", "CH_AA"), ("ON_BB", "DN_BB")}
    thin = got["ON_AA", "DN_AA"]
    direct, hub = km(spark, LYON, PARIS), km(spark, (49.12, 6.18), PARIS)
    assert (thin.category, thin.recommended_hub, thin.deprecation_feasible) == ("thin", "CH_AA", True)
    assert thin.distance2_km is None and thin.direct_distance_km == thin.distance1_km == direct
    mean_fr = (350.0, 1.5)
    cost = (mean_fr[0] + mean_fr[1] * direct) * 100 / 28 + (mean_fr[0] + mean_fr[1] * hub) * 100 / 28
    assert thin.cost_of_recommended_design == pytest.approx(cost)
    assert thin.cost_reduction == pytest.approx(thin.current_monthly_cost_ratio - cost)
    thick = got["ON_AA", "CH_AA"]
    assert (thick.category, thick.recommended_hub, thick.deprecation_feasible) == ("thick", "not applicable", None)
    assert thick.cost_of_recommended_design == pytest.approx((350 + 1.5 * direct) * 30 / 28)
    assert thick.monthly_processing_costs == thick.processing_cost_ratio == 6.0  # alone on its lane
    healthy = got["ON_BB", "CH_AA"]
    assert (healthy.category, healthy.cost_of_recommended_design) == ("healthy", None)
    shares = {}
    for r in rows:
        shares.setdefault((r.origin_node_id, r.destination_node_id), []).append(r.current_monthly_cost_ratio)
        assert sum(shares[r.origin_node_id, r.destination_node_id]) == pytest.approx(r.current_monthly_costs)


def test_simulation_hub_leg_variant(spark, small):
    row = [r for r in sim.lane_simulation(*small, hub_leg=True).collect() if r.category == "thin"
           and r.recommended_hub == "CH_AA"][0]
    to_hub, hub = km(spark, LYON, (49.12, 6.18)), km(spark, (49.12, 6.18), PARIS)
    assert row.cost_of_recommended_design == pytest.approx(
        (350 + 1.5 * to_hub) * 100 / 28 + (350 + 1.5 * hub) * 100 / 28)


def test_category_limits_are_strict(spark):
    df = spark.createDataFrame([("direct", 137.99), ("direct", 138.0), ("indirect", 322.0), ("indirect", 322.01),
                                ("indirect", 1.0), ("direct", None)], "triplet_type string, adjusted_triplet_cbm double")
    assert [r.category for r in sim.categorise(df).collect()] == [
        "thin", "healthy", "healthy", "thick", "healthy", "healthy"]
    measured = spark.createDataFrame([(138.0, 322.0)], "thin_cbm double, thick_cbm double")
    assert [r.category for r in sim.categorise(df, measured).collect()] == [
        "thin", "healthy", "healthy", "thick", "healthy", "healthy"]
    limits = calibrated_thresholds(df).first()
    assert (limits.thin_cbm, limits.thick_cbm) == (137.99, 322.01) or limits.thin_cbm == 137.99


def test_hub_ties_go_to_the_smaller_id_and_no_hub_is_null(spark):
    df = spark.createDataFrame(
        [("O", "CH_B", "consolidation_hub", 5.0, "S"), ("O", "CH_A", "consolidation_hub", 5.0, "S"),
         ("O", "CH_C", "consolidation_hub", 9.0, "S"), ("P", "DN_A", "delivery_node", 1.0, "S")],
        "origin_node_id string, destination_node_id string, destination_node_type string, distance1_km double, sort_code string")
    hubs = sim.nearest_hub(df, "hub").collect()
    assert {(r.origin_node_id, r.hub) for r in hubs} == {("O", "CH_A"), ("P", None)}
    thin = spark.createDataFrame([("thin", None), ("thin", "H"), ("thick", "H")], "category string, _hub string")
    assert [r.recommended_hub for r in sim.recommend_hub(thin).collect()] == [None, "H", "not applicable"]


def test_simulation_reads_the_legs_once(small):
    plan = sim.lane_simulation(*small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("container_id") <= 1 and plan.count("sort_code#") > 0


def test_compliance(typed, network):
    tms = typed("tms_transportation", run(1), run(2), run(3, destination="DN_BB"), run(4, destination="DN_CC"),
                run(5, destination="DN_DD"), run(6, 1), run(7, 2, quality_record="critical"))
    wms = typed("wms_shipment_details",
                leg(1, 1, "ON_AA", "DN_AA", "DN_AA", "MTL_1"), leg(2, 1, "ON_AA", "DN_AA", "DN_AA", "MTL_1"),
                leg(3, 2, "ON_AA", "DN_AA", "DN_AA", "BOX_1"), leg(4, 2, "ON_AA", "DN_AA", "DN_AA", "BOX_2"),
                leg(5, 3, "ON_AA", "DN_BB", "DN_BB", "BOX_1"), leg(6, 3, "ON_AA", "DN_BB", "DN_BB", "MTL_9"),
                leg(7, 4, "ON_AA", "DN_CC", "DN_CC", "BOX_1"), leg(8, 5, "ON_AA", "DN_DD", "DN_DD", "BOX_1"),
                leg(9, 6, "ON_AA", "DN_AA", "DN_AA", "MTL_1"), leg(10, 7, "ON_AA", "DN_AA", "DN_AA", "MTL_1"),
                leg(11, 6, "ON_BB", "DN_AA", "DN_AA", "MTL_2"), leg(12, 6, "ON_AA", "DN_AA", "DN_AA", "MTL_7", quality_record="critical"))
    price = typed("fin_procurement", {"item": "BOX_CONTAINER", "cost_per_unit_eur": 12.345})
    got = {(r.destination_node_id, r.departure_date.day): tuple(r)[3:] for r in
           container_compliance(wms, tms, network, price).collect()}
    assert got == {
        ("DN_AA", 1): ("MTL", 1, 2, False, 33.33, 24.69), ("DN_AA", 2): ("MTL", 1, 0, True, 100.0, 0.0),
        ("DN_BB", 1): ("BOX", 1, 1, False, 50.0, 0.0), ("DN_CC", 1): ("ALL", 0, 1, True, None, None),
        ("DN_DD", 1): (None, 0, 1, True, None, None)}
    unpriced = container_compliance(wms, tms, network, typed("fin_procurement"))
    assert by(unpriced.filter("departure_date = '2025-07-01'"), "destination_node_id", "avoidable_cost")["DN_AA"] is None


def test_transit_time_percentiles_and_status(typed):
    hours = [float(h) for h in range(1, 22)]
    tms = typed("tms_transportation", *[run(i, transit_time_hours=h) for i, h in enumerate(hours)],
                run(90, destination="DN_BB"), run(91, transit_time_hours=99.0, quality_record="critical"))

    def configured(value, **more):
        return typed("mdm_configured_transit_times", {
            "origin_node_id": "ON_AA", "destination_node_id": "DN_AA", "configured_transit_time_hours": value, **more})

    fact = transit_time(tms, configured(19.0))
    assert fact.count() == 21 and fact.first().departure_hour == 8 and fact.first().departure_date == dt.date(2025, 7, 1)
    assert transit_time(tms, configured(19.0, quality_record="critical")).count() == 0
    row = transit_percentiles(tms).filter("destination_node_id = 'DN_AA'").first()
    assert (row.p50, row.p90, row.p95, row.p98) == (11.0, 19.0, 20.0, 20.6)
    drift = transit_drift(fact).first()
    assert (drift.runs, drift.p95_transit_time_hours, drift.is_drifting) == (21, 20.0, True)
    status = {v: configuration_status(tms, configured(v)).first().configuration_status for v in (18.99, 19.0, 23.6, 23.61)}
    assert status == {18.99: "under_configured", 19.0: "correct", 23.6: "correct", 23.61: "over_configured"}
