from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.plans.shipments import silver_wms
from freightloom.plans.transport import silver_tms
from tests.conftest import by

GOOD = {
    "origin_node_id": "ON_AA", "destination_node_id": "DN_AA", "carrier": "Alpha",
    "departure_datetime": "2025-07-01 08:00:00", "transit_time_hours": "5", "arrival_datetime": "2025-07-01 13:00:00",
    "container_count": "10", "package_count": "3", "cbm": "9.5",
}


def run(number, **changes):
    truck = number if isinstance(number, (str, type(None))) else f"TRK_{number:07d}"
    return (truck, *{**GOOD, **changes}.values())


def test_tms_flags(raw, network, rates):
    cases = {
        1: ({}, None, "ok", "clean"),
        2: ({"origin_node_id": None}, "origin_integrity_quality_flag", "null_in_source", "critical"),
        3: ({"origin_node_id": "ON_ZZ"}, "origin_integrity_quality_flag", "referential_integrity_fail", "critical"),
        4: ({"origin_node_id": "DN_BB"}, "origin_integrity_quality_flag", "cant_be_an_origin", "critical"),
        5: ({"destination_node_id": "ON_BB"}, "destination_integrity_quality_flag", "cant_be_a_destination", "critical"),
        6: ({"destination_node_id": None}, "destination_integrity_quality_flag", "null_in_source", "critical"),
        7: ({"carrier": None}, "carrier_integrity_quality_flag", "null_in_source", "warning"),
        8: ({"carrier": "Ghost"}, "carrier_integrity_quality_flag", "unknown_node", "warning"),
        9: ({"carrier": " Alpha "}, "carrier_integrity_quality_flag", "ok", "clean"),
        10: ({"transit_time_hours": "-2"}, "transit_time_quality_flag", "invalid_value", "critical"),
        11: ({"transit_time_hours": " "}, "transit_time_quality_flag", "null_in_source", "critical"),
        12: ({"departure_datetime": None}, "departure_datetime_quality_flag", "null_in_source", "critical"),
        13: ({"departure_datetime": "soon"}, "departure_datetime_quality_flag", "unexpected_format", "critical"),
        14: ({"departure_datetime": "01/07/2025 08:00:00"}, "departure_datetime_quality_flag", "ok", "clean"),
        15: ({"arrival_datetime": None}, "arrival_datetime_quality_flag", "null_in_source", "critical"),
        16: ({"arrival_datetime": "later"}, "arrival_datetime_quality_flag", "unexpected_format", "critical"),
        17: ({"arrival_datetime": "2025-07-01 07:00:00"}, "arrival_datetime_quality_flag", "arrival_before_departure", "critical"),
        18: ({"arrival_datetime": "2025-07-01 08:00:59"}, "arrival_datetime_quality_flag", "arrival_before_departure", "critical"),
        19: ({"departure_datetime": "2025-07-01 08:00:59", "arrival_datetime": "2025-07-01 08:01:00"},
             "arrival_datetime_quality_flag", "ok", "clean"),
        20: ({"departure_datetime": "soon"}, "arrival_datetime_quality_flag", "ok", "critical"),
        21: ({"container_count": "0"}, "container_count_quality_flag", "invalid_value", "critical"),
        22: ({"container_count": "32"}, "container_count_quality_flag", "ok", "clean"),
        23: ({"container_count": "33"}, "container_count_quality_flag", "out_of_range", "critical"),
        24: ({"container_count": ""}, "container_count_quality_flag", "null_in_source", "critical"),
        25: ({"container_count": ""}, "cbm_quality_flag", "ok", "critical"),
        26: ({"package_count": "-1"}, "package_count_quality_flag", "invalid_value", "clean"),
        27: ({"package_count": "0"}, "package_count_quality_flag", "ok", "clean"),
        28: ({"package_count": "many"}, "package_count_quality_flag", "null_in_source", "clean"),
        29: ({"cbm": "10.5"}, "cbm_quality_flag", "out_of_range", "clean"),
        30: ({"cbm": "-1"}, "cbm_quality_flag", "invalid_value", "clean"),
        31: ({"cbm": ""}, "cbm_quality_flag", "null_in_source", "clean"),
        32: ({"origin_node_id": " on_aa"}, "origin_integrity_quality_flag", "ok", "clean"),
    }
    rows = [run(n, **c[0]) for n, c in cases.items()]
    rows += [run("TRUCK-0000001"), run(None), run(None), run(900), run(900, cbm="1")]
    df = silver_tms(raw("tms_transportation", *rows), network, rates)
    got = {r.truck_id: r for r in df.collect()}
    assert len(got) == len(cases) + 3 == df.count()
    for n, (_, column, label, record) in cases.items():
        row = got[f"TRK_{n:07d}"]
        assert row.quality_record == record, n
        if column:
            assert row[column] == label, n
    assert got["TRUCK-0000001"].truck_id_quality_flag == "invalid_format"
    assert got[None].truck_id_quality_flag == "null_in_source"
    assert got["TRK_0000900"].truck_id_quality_flag == "duplicate" and got["TRK_0000900"].cbm == 1.0
    strict = silver_tms(raw("tms_transportation", run(29, cbm="10.5")), network, rates, cbm_is_critical=True)
    assert strict.first().quality_record == "critical"


def leg(shipment, truck=1, container="MTL_1", date="2025-06-30", origin="ON_AA", destination="DN_AA", sort="DN_AA"):
    ship = f"SHP_{shipment:09d}" if isinstance(shipment, int) else shipment
    return ship, f"TRK_{truck:07d}" if isinstance(truck, int) else truck, container, date, origin, destination, sort


def tms_of(raw, network, rates, *packages):
    return silver_tms(raw("tms_transportation", *[
        run(i, package_count=p) for i, p in enumerate(packages, start=1)]), network, rates)


def test_wms_flags(raw, network, rates):
    tms = tms_of(raw, network, rates, "21", "1", "5", "2")
    df = silver_wms(raw(
        "wms_shipment_details",
        leg(1), leg(2, date=None), leg(3, date="2025-07-02"), leg(4, date="01/07/2025"), leg(5, date="n/a"),
        leg(6, origin=None), leg(7, origin="ON_BB"), leg(8, destination="DN_BB"), leg(9, container=None),
        leg(10, container="M-1"), leg(11, container="BOX_1"), leg(12, sort=None), leg(13, sort="CH_AA"),
        leg(14, sort="DN_ZZ"), leg("S-1"), leg(None), leg(16), leg(16), leg(" SHP_000000017"), leg(18),
        leg("SHP_000000019 "), leg("SHP_000000019"), leg(21),
        leg(30, truck=2), leg(31, truck=3), leg(32, truck=99), leg(33, truck=None),
        leg(40, truck=4), leg(40, truck=4, container="BOX_9"), leg(41, truck=4)), tms, network)
    rows = df.collect()
    assert len(rows) == 28  # one copy of 16 and of 40 is gone, both spellings of 19 stay

    def one(ship, truck="TRK_0000001"):
        found = [r for r in rows if r.shipment_id == ship and r.truck_id == truck]
        assert len(found) == 1, (ship, len(found))
        return found[0]

    def check(ship, column, label, record="critical", truck="TRK_0000001"):
        row = one(f"SHP_{ship:09d}" if isinstance(ship, int) else ship, truck)
        assert (row[column], row.quality_record) == (label, record), (ship, row)

    check(1, "shipment_coherence_flag", "ok", "clean")
    check(2, "order_date_quality_flag", "null_in_source")
    check(3, "order_date_quality_flag", "date_integrity_fail")
    check(4, "order_date_quality_flag", "ok", "clean")
    check(5, "order_date_quality_flag", "null_in_source")
    check(6, "origin_integrity_quality_flag", "null_in_source")
    check(7, "origin_integrity_quality_flag", "origin_integrity_fail")
    check(8, "destination_integrity_quality_flag", "destination_integrity_fail")
    check(9, "container_coherence_flag", "null_in_source")
    check(10, "container_coherence_flag", "invalid_container")
    check(11, "container_coherence_flag", "ok", "clean")
    check(12, "sort_code_quality_flag", "null_in_source")
    check(13, "sort_code_quality_flag", "cant_be_a_sort_code")
    check(14, "sort_code_quality_flag", "sort_code_integrity_fail")
    check("S-1", "shipment_integrity_quality_flag", "invalid_format")
    check(None, "shipment_coherence_flag", "null_in_source")
    check(16, "shipment_coherence_flag", "duplicate_shipment_in_truck")
    check(17, "shipment_coherence_flag", "ok", "clean")  # a padded id without a twin is fine
    assert [r.shipment_integrity_quality_flag for r in rows if r.shipment_id == "SHP_000000019"] == [
        "duplicate_shipment_in_truck"] * 2
    check(30, "shipment_coherence_flag", "ok", "clean", "TRK_0000002")
    check(31, "shipment_coherence_flag", "incoherent_package_count", truck="TRK_0000003")
    check(32, "truck_integrity_quality_flag", "truck_integrity_fail", truck="TRK_0000099")
    check(33, "truck_integrity_quality_flag", "null_in_source", truck=None)
    check(40, "shipment_integrity_quality_flag", "duplicate_shipment_in_truck", truck="TRK_0000004")
    check(41, "shipment_coherence_flag", "ok", "clean", truck="TRK_0000004")  # counted after deduplication


def test_wms_same_on_any_partitioning_and_under_skew(spark, raw, network, rates):
    tms = tms_of(raw, network, rates, "2000", "3")
    hot = spark.range(3000).select(
        F.format_string("SHP_%09d", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("shipment_id"),
        F.lit("TRK_0000001").alias("truck_id"), F.concat(F.lit("MTL_"), "id").alias("container_id"),
        F.lit("2025-06-30").alias("order_date"), F.lit("ON_AA").alias("origin_node_id"),
        F.lit("DN_AA").alias("destination_node_id"), F.lit("DN_AA").alias("sort_code"))
    one = silver_wms(hot.coalesce(1), tms, network)
    many = silver_wms(hot.repartition(8, F.rand(3)), tms, network)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    got = by(many, "shipment_id", "shipment_integrity_quality_flag")
    assert got["SHP_000000007"] == "duplicate_shipment_in_truck"
    assert sum(f != "ok" for f in got.values()) == 1 and len(got) == 2000
    assert {r.quality_record for r in many.filter("shipment_id <> 'SHP_000000007'").collect()} == {"clean"}


def test_wms_join_splits_a_hot_truck(spark, raw, network, rates, tmp_path):
    """Two thirds of the legs on one truck: the join with the runs is split at run time."""
    tms_of(raw, network, rates, *["5"] * 40).write.parquet(str(tmp_path / "tms"))
    spark.range(60000).select(
        F.format_string("SHP_%09d", "id").alias("shipment_id"),
        F.format_string("TRK_%07d", F.when(F.col("id") % 3 > 0, 1).otherwise(1 + F.col("id") % 40)).alias("truck_id"),
        F.concat(F.lit("MTL_"), "id").alias("container_id"), F.lit("2025-06-30").alias("order_date"),
        F.lit("ON_AA").alias("origin_node_id"), F.lit("DN_AA").alias("destination_node_id"),
        F.lit("DN_AA").alias("sort_code")).write.parquet(str(tmp_path / "wms"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        # a partition is split along the tasks that wrote it, so keep these apart on this small input
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = silver_wms(spark.read.parquet(str(tmp_path / "wms")), spark.read.parquet(str(tmp_path / "tms")), network)
        assert df.count() == 60000
        df = silver_wms(spark.read.parquet(str(tmp_path / "wms")), spark.read.parquet(str(tmp_path / "tms")), network)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert "skew=true" in plan


def test_wms_plan_has_no_window_and_no_cross_join(spark, raw, network, rates):
    df = silver_wms(raw("wms_shipment_details", leg(1)), tms_of(raw, network, rates, "1"), network)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
