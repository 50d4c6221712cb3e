from __future__ import annotations

import pytest

from freightloom.plans.refresh import colocate_legs, refresh_gold, refresh_silver
from freightloom.schemas import CONTRACT, FEEDS
from freightloom.sources.bronze import load_all, overlong_rows, read_bronze_csv
from freightloom.sources.sinks import publish, read_table
from freightloom.sources.workspace import new_workspace
from freightloom.streaming.append import append_bronze


def write(folder, table, *lines, name=None):
    path = folder / (name or f"{table}.csv")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(FEEDS[table].columns), *lines]) + "\n")
    return str(path)


def test_csv_stays_text(spark, tmp_path):
    path = write(tmp_path, "fin_procurement", 'A,1.50,yes,"two', 'lines, ""quoted"""', "B,,", "C, 2 ,no,x")
    df = read_bronze_csv(spark, path)
    assert df.schema == FEEDS["fin_procurement"].schema
    assert [tuple(r) for r in df.collect()] == [
        ("A", "1.50", "yes", 'two\nlines, "quoted"'), ("B", None, None, None), ("C", " 2 ", "no", "x")]
    assert [r._ord for r in read_bronze_csv(spark, path, "fin_procurement", with_ordinal=True).collect()] == [0, 1, 2]


@pytest.mark.parametrize("line", ["A,1,yes,x,surplus", "A,1,yes,x,", "A,1,yes,x,,,", '"A,B",1,yes,"x\ny",z'])
def test_overlong_rows_are_found(spark, tmp_path, line):
    path = write(tmp_path, "fin_procurement", "B,1", "C,1,no,", '"D,d,d,d,d",1', line)
    assert overlong_rows(spark, path, 4).count() == 1


def test_load_all_statuses(spark, tmp_path):
    write(tmp_path, "fin_handling_costs", "CH_AA,1.5", "CH_BB,2.0")
    write(tmp_path, "fin_procurement", "A,1,yes,x,surplus")
    (tmp_path / "mdm_network.csv").write_text("wrong,header,here,a,b,c,d\nON_AA,1,2,3,4,5,6\n")
    got = {r.table_name: (r.status, r.row_count) for r in load_all(spark, str(tmp_path), str(tmp_path / "out")).collect()}
    assert got["fin_handling_costs"] == ("OK", 2) and got["fin_procurement"] == ("REJECTED", 0)
    assert got["mdm_network"] == ("FAILED", 0)
    messages = {r.table_name: r.message for r in load_all(spark, str(tmp_path), str(tmp_path / "again")).collect()}
    assert messages["fin_handling_costs"] is None and messages["mdm_network"] and "fields" in messages["fin_procurement"]
    assert {t: s for t, (s, _) in got.items() if s == "SKIPPED"}.keys() == set(FEEDS) - {
        "fin_handling_costs", "fin_procurement", "mdm_network"}


def test_publish_clusters_and_splits_one_hot_value(spark, tmp_path):
    df = spark.range(8000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        back = publish(df, str(tmp_path), "gold", "t", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert back.count() == 8000 == read_table(spark, str(tmp_path), "gold", "t").count()
    files = back.filter("k = 'hot'").selectExpr("_metadata.file_name f").distinct().count()
    assert files > 1


def test_workspace_is_in_the_shared_folder(spark):
    first, second = new_workspace(spark), new_workspace(spark)
    assert first != second and first.startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_append_loads_each_file_once(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def load():
        append_bronze(spark, str(source), out, mark, "tms_transportation").awaitTermination(60)
        return spark.read.parquet(out)

    write(source, "tms_transportation", "TRK_0000001,ON_AA,DN_AA,Alpha", name="a.csv")
    assert load().count() == 1
    write(source, "tms_transportation", "TRK_0000002,ON_AA,DN_AA,Alpha", "TRK_0000003", name="b.csv")
    df = load()
    assert df.count() == 3 and load().count() == 3
    assert {"_src_file", "_load_date"} < set(df.columns) and dict(df.dtypes)["cbm"] == "string"
    with pytest.raises(ValueError):
        append_bronze(spark, str(source), out, mark, "mdm_network")


def test_append_rejects_overlong_rows(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    bad = write(source, "wms_shipment_details", "SHP_1,T,M,2025-01-01,A,B,C", "SHP_2,T,M,2025-01-01,A,B,C,more", name="a.csv")
    with pytest.raises(Exception, match="1 rows with more fields"):
        append_bronze(spark, str(source), out, mark, "wms_shipment_details").awaitTermination(60)
    assert not (tmp_path / "out").exists()
    write(source, "wms_shipment_details", "SHP_1,T,M,2025-01-01,A,B,C", 'SHP_2,T,"M,1",2025-01-01', name=bad.rsplit("/", 1)[1])
    append_bronze(spark, str(source), out, str(tmp_path / "mark2"), "wms_shipment_details").awaitTermination(60)
    assert {r.shipment_id: r.container_id for r in spark.read.parquet(out).collect()} == {"SHP_1": "M", "SHP_2": "M,1"}


def test_append_and_full_load_have_the_same_first_rows(spark, tmp_path):
    from freightloom.operators.keep_first import keep_first
    source = tmp_path / "in" / "wms_shipment_details.csv"
    write(source, "wms_shipment_details", "SHP_1,T,M_9,2025-01-01,A,B,C", "SHP_1,T,M_1,2025-01-01,A,B,C", name="a.csv")
    out = str(tmp_path / "appended")

    def append():
        append_bronze(spark, str(source), out, str(tmp_path / "mark"), "wms_shipment_details").awaitTermination(60)

    append()
    write(source, "wms_shipment_details", "SHP_1,T,M_0,2025-01-01,A,B,C", "SHP_2,T,M_5,2025-01-01,A,B,C", name="b.csv")
    append()
    assert load_all(spark, str(tmp_path / "in"), str(tmp_path / "full")).where("status = 'OK'").count() == 1
    firsts = [
        {r.shipment_id: r.container_id for r in keep_first(df.select(*FEEDS["wms_shipment_details"].columns, "_src_file", "_ord"),
                                                           ["shipment_id", "truck_id"]).collect()}
        for df in (spark.read.parquet(out), read_table(spark, str(tmp_path), "full", "wms_shipment_details"))]
    assert firsts[0] == firsts[1] == {"SHP_1": "M_9", "SHP_2": "M_5"}


def test_refresh_end_to_end(spark, tmp_path):
    source, base = tmp_path / "csv", str(tmp_path / "lake")
    write(source, "mdm_network", "ON_AA,origin_node,Lyon,FR,45.75,4.85,ALL", "DN_AA,delivery_node,Paris,FR,48.86,2.35,MTL",
          "CH_AA,consolidation_hub,Metz,FR,49.12,6.18,MTL", "ON_AA,orign_node,Lyon,FR,45.75,4.85,ALL")
    write(source, "fin_transport_rates", "FR,Alpha,300,1.0")
    write(source, "fin_handling_costs", "CH_AA,1.5")
    write(source, "fin_procurement", "BOX_CONTAINER,12.5,no,cardboard")
    write(source, "mdm_configured_transit_times", "ON_AA,DN_AA,6,correct")
    write(source, "tms_transportation", "TRK_0000001,ON_AA,DN_AA,Alpha,2025-07-01 08:00:00,5,2025-07-01 13:00:00,3,2,2.5")
    write(source, "wms_shipment_details", "SHP_000000001,TRK_0000001,MTL_1,2025-06-30,ON_AA,DN_AA,DN_AA",
          "SHP_000000002,TRK_0000001,BOX_1,2025-06-30,ON_AA,DN_AA,DN_AA",
          "SHP_000000002,TRK_0000001,BOX_2,2025-06-30,ON_AA,DN_AA,DN_AA")
    status = load_all(spark, str(source), f"{base}/bronze").collect()
    assert {r.status for r in status} == {"OK"}
    silver = refresh_silver(spark, base)
    for name, df in silver.items():
        types = {f.name: f.dataType for f in df.schema}
        assert {f.name: types[f.name] for f in CONTRACT[name]} == {f.name: f.dataType for f in CONTRACT[name]}
    assert silver["mdm_network"].count() == 3
    legs = {r.shipment_id: (r.container_id, r.quality_record) for r in silver["wms_shipment_details"].collect()}
    assert legs == {"SHP_000000001": ("MTL_1", "clean"), "SHP_000000002": ("BOX_1", "critical")}  # first in file order
    gold = refresh_gold(spark, base)
    assert {n: df.count() for n, df in gold.items()} == {
        "fact_lane_daily": 184, "fact_lane_simulation": 1, "fact_container_compliance": 1, "fact_transit_time": 1}
    rows = {n: df.collect() for n, df in gold.items()}
    again = refresh_gold(spark, base, by_truck=colocate_legs(spark, base, buckets=4))
    assert {n: df.collect() for n, df in again.items()} == rows
