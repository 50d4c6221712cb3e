"""Plans that must not depend on how well a table is compressed, and portions that grow in number with it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import feeds
from freightloom.operators import keep_first as kf
from freightloom.operators.keep_first import keep_first
from freightloom.plans import audits


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trucks_are_not_collected_for_the_foreign_keys(spark, typed, tmp_path):
    """Under a threshold that their files stay below, the ids of all trucks went through the driver."""
    runs = [dict(truck_id=f"TRK_{i:07d}", origin_node_id="ON_AA", destination_node_id="DN_AA") for i in range(50)]
    typed("tms_transportation", *runs).write.parquet(str(tmp_path / "runs"))
    legs = [dict(shipment_id=f"S{i}", truck_id=f"TRK_{i:07d}", origin_node_id="ON_AA", destination_node_id="DN_AA",
                 sort_code="DN_AA") for i in range(52)]
    typed("wms_shipment_details", *legs).write.parquet(str(tmp_path / "legs"))
    nodes = typed("mdm_network", dict(node_id="ON_AA"), dict(node_id="DN_AA"))
    out = audits.foreign_key_orphans(nodes, spark.read.parquet(str(tmp_path / "runs")), spark.read.parquet(str(tmp_path / "legs")))
    on_trucks = [x for x in plan_of(out).splitlines() if "LeftAnti" in x]
    assert len(on_trucks) == 3 and sum("SortMergeJoin" in x for x in on_trucks) == 1
    assert sorted(r.value for r in out.collect()) == ["TRK_0000050", "TRK_0000051"]


def _below_first_exchange(plan):
    """The plan under its first exchange: what tasks do before rows are dealt."""
    lines = plan.splitlines()
    return "\n".join(lines[next(i for i, x in enumerate(lines) if "Exchange" in x):])


def test_rows_of_small_groups_are_dealt_before_they_are_aggregated(spark):
    """The tasks that read sorted all they read by key, which grew with how well a file is compressed."""
    df = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], copies="c")
    assert "Aggregate" not in _below_first_exchange(plan_of(out))
    assert {r.c for r in out.collect()} == {3} and {r.v for r in out.collect()} == set(range(1000))


@pytest.mark.parametrize("third", ["hot", None])
def test_hot_groups_go_another_way_with_the_same_rows(spark, monkeypatch, third):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).when(F.col("id") % 2 == 0, F.lit(third)).alias("k"),
        F.col("id").alias("v"))
    want = sorted(map(str, keep_first(df, ["k"], copies="c").collect()))
    monkeypatch.setattr(kf, "HOT_ROWS", 100)
    out = keep_first(df, ["k"], copies="c")
    assert "Union" in plan_of(out) and sorted(map(str, out.collect())) == want


def test_portions_of_a_source_grow_with_its_rows(spark, tmp_path, monkeypatch):
    spark.range(5000).selectExpr("id AS o_orderkey").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    assert feeds.source(spark, str(tmp_path), "orders").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(feeds, "ROWS", 100, raising=False)
    df = feeds.source(spark, str(tmp_path), "orders")
    assert df.rdd.getNumPartitions() == 50 and df.count() == 5000


def test_rows_dealt_by_key_do_not_fill_a_task_as_the_table_grows(spark, monkeypatch):
    monkeypatch.setattr(kf, "PORTION", 100)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows in (50 * few, 300 * few):
        df = spark.range(rows).select(F.col("id").cast("string").alias("truck_id"), (F.col("id") % 7).alias("n"))
        portions = []
        out = kf.by_group(df, ["truck_id"], lambda r: portions.append(r.rdd.getNumPartitions()) or kf.first_rows(
            r, ["truck_id"], ["n"]))
        assert out.count() == rows
        assert portions[0] <= few if rows == 50 * few else portions == [3 * few]
