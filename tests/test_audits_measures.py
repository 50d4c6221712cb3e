from __future__ import annotations

import datetime as dt

from freightloom.plans import audits as A
from freightloom.plans import measures as M
from freightloom.schemas import CONTRACT
from tests.conftest import by
from tests.test_facts import leg, run


def test_package_count_and_capacity(typed):
    tms = typed("tms_transportation", run(1, packages=2, container_count=5), run(2, packages=2, container_count=4),
                run(3, packages=1), run(4, packages=0))
    wms = typed("wms_shipment_details", leg(1, 1, "ON_AA", "DN_AA", "DN_AA"), leg(2, 1, "ON_AA", "DN_AA", "DN_AA"),
                leg(3, 2, "ON_AA", "DN_AA", "DN_AA"))
    assert by(A.package_count_mismatch(tms, wms), "truck_id", "shipment_legs") == {"TRK_0000002": 1, "TRK_0000003": 0}
    assert [r.truck_id for r in A.cbm_over_capacity(tms).collect()] == ["TRK_0000002"]


def test_truck_lane_and_paths(typed):
    wms = typed("wms_shipment_details", leg(1, 1, "ON_AA", "DN_AA", "DN_AA"), leg(2, 1, "ON_BB", "DN_AA", "DN_AA"),
                leg(3, 2, "ON_AA", "CH_AA", "DN_AA"), leg(4, 2, "ON_AA", "CH_AA", "DN_AA"), leg(5, 3, "ON_BB", "DN_AA", "DN_AA"))
    assert [tuple(r) for r in A.truck_with_several_lanes(wms).collect()] == [("TRK_0000001", 2, 1)]
    assert [tuple(r) for r in A.mixed_path_types(wms).collect()] == [("ON_AA", "DN_AA", 1, 2)]


def test_shipment_legs_and_final_stop(typed):
    tms = typed("tms_transportation", run(1), run(2, 1, origin="CH_AA"), run(3, 2))
    wms = typed("wms_shipment_details",
                leg(1, 1, "ON_AA", "DN_AA", "DN_AA"),
                leg(2, 1, "ON_AA", "CH_AA", "DN_AA"), leg(2, 2, "CH_AA", "DN_AA", "DN_AA"),
                leg(3, 1, "ON_AA", "CH_AA", "DN_AA"),
                leg(4, 1, "ON_AA", "DN_AA", "DN_AA"), leg(4, 3, "ON_AA", "DN_BB", "DN_AA"))
    assert by(A.leg_count_violations(wms), "shipment_id", "legs", "rule") == {
        "SHP_000000003": (1, "indirect_has_two_legs"), "SHP_000000004": (2, "direct_has_one_leg")}
    assert A.direct_leg_violations(wms).count() == A.indirect_leg_violations(wms).count() == 1
    assert by(A.shipment_not_at_sort_code(wms, tms), "shipment_id", "destination_node_id") == {
        "SHP_000000003": "CH_AA", "SHP_000000004": "DN_BB"}


def test_hub_containers(typed):
    wms = typed("wms_shipment_details",
                leg(1, 1, "ON_AA", "CH_AA", "DN_AA", "MTL_1"), leg(1, 2, "CH_AA", "DN_AA", "DN_AA", "MTL_1"),
                leg(2, 1, "ON_AA", "CH_AA", "DN_AA", "MTL_2"), leg(2, 2, "CH_BB", "DN_AA", "DN_AA", "MTL_2"))
    assert [tuple(r) for r in A.reused_hub_containers(wms).collect()] == [("CH_AA", "MTL_1", 1, 1)]


def test_orphans_reach_and_reconciliation(typed, network):
    tms = typed("tms_transportation", run(1, container_count=2), run(2, destination="DN_ZZ", container_count=0))
    wms = typed("wms_shipment_details", leg(1, 1, "ON_AA", "DN_AA", "DN_AA", "MTL_1"),
                leg(2, 1, "ON_ZZ", "DN_AA", None, "MTL_1"), leg(3, 9, "ON_AA", "DN_AA", "DN_AA"))
    handling = typed("fin_handling_costs", {"node_id": "CH_ZZ"})
    got = {(r.table_name, r.column_name, r.value, r.row_count) for r in
           A.foreign_key_orphans(network, tms, wms, handling).collect()}
    assert got == {("tms_transportation", "destination_node_id", "DN_ZZ", 1),
                   ("wms_shipment_details", "origin_node_id", "ON_ZZ", 1),
                   ("wms_shipment_details", "truck_id", "TRK_0000009", 1), ("fin_handling_costs", "node_id", "CH_ZZ", 1)}
    assert {r.node_id for r in A.unreachable_nodes(network, tms).collect()} == {"DN_BB", "DN_CC", "DN_DD"}
    assert by(A.container_reconciliation(tms, wms), "truck_id", "container_count", "containers_seen") == {"TRK_0000001": (2, 1)}


def test_keys_and_schema(spark, typed):
    df = typed("fin_procurement", {"item": "A"}, {"item": "A"}, {"item": None}, {"item": "B"})
    assert [tuple(r) for r in A.primary_key_violations({"p": (df, ["item"])}).collect()] == [("p", "A", 2)]
    contract = CONTRACT["fin_procurement"]
    assert A.schema_changes(spark, df.schema, contract).count() == 0
    changed = df.selectExpr("item", "cast(cost_per_unit_eur as string) cost_per_unit_eur", "description",
                            "quality_record", "1 as extra")
    assert by(A.schema_changes(spark, changed.schema, contract), "column_name", "change", "is_breaking") == {
        "reusable": ("removed", True), "cost_per_unit_eur": ("retyped", True), "extra": ("added", False)}


def at(hour, day=1, minute=0):
    return dt.datetime(2025, 7, day, hour, minute)


def test_service_measures(typed):
    tms = typed("tms_transportation",
                run(1, arrival_datetime=at(9, minute=59), container_count=9), run(2, arrival_datetime=at(10), container_count=10),
                run(3, origin="CH_AA", arrival_datetime=at(4), departure_datetime=at(22), container_count=29),
                run(4, origin="CH_AA", departure_datetime=at(5, minute=59), container_count=30),
                run(5, origin="CH_AA", departure_datetime=at(6), destination="DN_BB", container_count=33),
                run(6, destination="CH_AA", arrival_datetime=at(4), container_count=0))
    assert by(M.on_time_share(tms), "leg_type", "trucks", "on_time", "on_time_share") == {
        "direct": (2, 1, 0.5), "indirect_leg2": (1, 1, 1.0)}
    assert by(M.departure_window_share(tms), "hub_node_id", "trucks", "in_window_share") == {"CH_AA": (3, 0.6667)}
    assert by(M.container_bands(tms), "band", "trucks", "share") == {
        "light": (1, 0.25), "mid": (1, 0.25), "heavy": (1, 0.25), "peak": (1, 0.25)}
    assert by(M.fill_rate(tms), "leg_type", "trucks") == {"direct": 2, "indirect_leg2": 3}
    assert {(r.hub_node_id, r.delivery_node_id) for r in M.hub_coverage(tms).collect()} == {("CH_AA", "DN_AA"), ("CH_AA", "DN_BB")}
    assert M.lane_leg_types(tms).filter("leg_type = 'indirect_leg1'").first().runs == 1


def test_lane_measures(typed, network):
    tms = typed("tms_transportation", run(1, transit_time_hours=8.0), run(2, destination="DN_BB"), run(3, destination="DN_ZZ"))
    assert by(M.cross_border_lanes(tms, network), "destination_node_id", "is_cross_border") == {"DN_AA": False, "DN_BB": True}
    delay = by(M.transit_delay(tms, network), "destination_node_id", "distance_km", "expected_transit_hours", "avg_delay_hours")
    km, expected, late = delay["DN_AA"]
    assert expected == round(km / 80, 4) and late == round(8 - km / 80, 4) and set(delay) == {"DN_AA", "DN_BB"}


def test_quality_distribution_adds_up(network, rates):
    got = M.quality_distribution({"n": network, "r": rates}).collect()
    totals = {}
    for r in got:
        totals[r.table_name, r.flag] = totals.get((r.table_name, r.flag), 0) + r.row_count
    assert set(totals.values()) == {9, 3} and ("n", "quality_record") in totals
    assert {r.label for r in got if (r.table_name, r.flag) == ("n", "capabilities_quality_flag")} == {"ok", "null_in_source"}


def test_rollups(spark):
    fact = spark.createDataFrame(
        [("O", "D", True, 1, 0, 0.0), ("O", "D", False, 1, 1, 2.5), ("O", "E", True, 0, 1, None)],
        "origin_node_id string, destination_node_id string, is_compliant boolean, mtl_container_count bigint, "
        "box_container_count bigint, avoidable_cost double")
    assert by(M.compliance_summary(fact), "destination_node_id", "compliant_share", "avoidable_cost") == {
        "D": (0.5, 2.5), "E": (1.0, None)}
    assert by(M.compliance_by_origin(fact), "origin_node_id", "lane_days", "compliant_share") == {"O": (3, 0.6667)}
    sim = spark.createDataFrame(
        [("thin", 1, "O", "D", "S", "H", 10.0, 4.0, 6.0), ("thin", 1, "O", "E", "S", "H", 1.0, 4.0, -3.0),
         ("thick", 1, "O", "F", "S", None, 9.0, 3.0, 6.0), ("healthy", 1, "O", "G", "S", None, 5.0, None, None)],
        "category string, departure_month int, origin_node_id string, destination_node_id string, sort_code string, "
        "recommended_hub string, current_monthly_cost_ratio double, cost_of_recommended_design double, cost_reduction double")
    assert by(M.savings_summary(sim), "category", "triplets", "saving", "non_actionable") == {
        "thin": (2, 3.0, 1), "thick": (1, 6.0, 0), "healthy": (1, None, 0)}
    assert [r.destination_node_id for r in M.ranked_interventions(sim, 2).collect()] == ["D", "F"]
