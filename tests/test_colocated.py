"""Legs and runs bucketed by truck: same results, no shuffle of the legs, hot trucks apart."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from freightloom.plans.audits import package_count_mismatch
from freightloom.plans.compliance import container_counts, counted_containers, loaded_containers
from freightloom.plans.simulation import truck_triplets
from freightloom.sources import colocated, versions
from freightloom.sources.colocated import frequent_keys, publish_pair, read_pair
from freightloom.sources.workspace import new_workspace

BUCKETS = 8


def _legs(spark, rows: int, trucks: int):
    """Legs of evenly loaded trucks; every seventh run is on another lane than its legs."""
    return spark.range(rows).select(
        F.format_string("SHP_%09d", "id").alias("shipment_id"), F.format_string("TRK_%07d", F.col("id") % trucks).alias("truck_id"),
        F.concat(F.when(F.col("id") % 3 == 0, "MTL").otherwise("BOX"), (F.col("id") % 11).cast("string")).alias("container_id"),
        F.lit("ON_AA").alias("origin_node_id"), F.lit("DN_AA").alias("destination_node_id"), F.lit("DN_AA").alias("sort_code"),
        F.lit("clean").alias("quality_record"))


def _runs(spark, trucks: int):
    return spark.range(trucks).select(
        F.format_string("TRK_%07d", "id").alias("truck_id"), F.lit("ON_AA").alias("origin_node_id"),
        F.when(F.col("id") % 7 == 0, "DN_BB").when(F.col("id") % 7 == 1, None).otherwise("DN_AA").alias("destination_node_id"),
        F.timestamp_seconds(F.lit(1751328000) + F.col("id") * 86400 * 9).alias("departure_datetime"),
        (F.col("id") % 30).cast("double").alias("cbm"), F.lit(20).alias("package_count"), F.lit("clean").alias("quality_record"))


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def _plan(df) -> list[str]:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue().split("\n")


def _exchanges_over(df, column: str) -> int:
    """Exchanges between the join of legs and runs and the scan that reads ``column``."""
    lines = _plan(df)
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and column in x)
    depth = [len(re.match(r"[\s:+\-*()\d]*", x).group()) for x in lines]
    above, here = [], depth[scan]
    for i in range(scan - 1, -1, -1):
        if depth[i] < here:
            above.append(lines[i])
            here = depth[i]
    joins = [i for i, x in enumerate(above) if "SortMergeJoin" in x or "ShuffledHashJoin" in x]
    assert joins, lines
    return sum("Exchange" in x for x in above[:joins[0]])


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Tables of a test are small enough to broadcast; those it stands for are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


JOBS = {
    "triplets": (truck_triplets, "sort_code"),
    "containers": (loaded_containers, "container_id"),
    "packages": (lambda legs, runs: package_count_mismatch(runs, legs), "shipment_id"),
}


@pytest.mark.parametrize("job", JOBS)
def test_even_trucks_meet_without_a_shuffle(spark, no_broadcast, job):
    build, column = JOBS[job]
    legs, runs = _legs(spark, 600, 40), _runs(spark, 45)
    pair = publish_pair(legs, runs, f"{new_workspace(spark)}/pair", "truck_id", BUCKETS)
    assert pair.loose is None
    _same(pair.by_key(build), build(legs, runs))
    assert _exchanges_over(pair.by_key(build), column) == 0


def test_plain_tables_do_shuffle(spark, no_broadcast):
    """The plan reader above sees an exchange where there is one."""
    folder = new_workspace(spark)
    _legs(spark, 60, 6).write.parquet(f"{folder}/legs")
    _runs(spark, 6).write.parquet(f"{folder}/runs")
    legs, runs = (spark.read.parquet(f"{folder}/{x}") for x in ("legs", "runs"))
    assert _exchanges_over(truck_triplets(legs, runs), "sort_code") > 0


@pytest.mark.parametrize("hot", ["TRK_0000003", None])
def test_a_hot_truck_and_the_missing_truck_lie_apart(spark, hot):
    legs = _legs(spark, 600, 60).withColumn("truck_id", F.when(F.substring("shipment_id", -1, 1) < "4", F.lit(hot)).otherwise(F.col("truck_id")))
    runs = _runs(spark, 60)
    pair = publish_pair(legs, runs, f"{new_workspace(spark)}/pair", "truck_id", BUCKETS)
    assert frequent_keys(legs, "truck_id", BUCKETS) == [hot]
    assert [r[0] for r in pair.loose[0].select("truck_id").distinct().collect()] == [hot]
    assert pair.even[0].filter(F.col("truck_id").eqNullSafe(F.lit(hot))).count() == 0
    assert pair.even[0].count() + pair.loose[0].count() == 600
    for build, _ in JOBS.values():
        _same(pair.by_key(build), build(legs, runs))
    _same(counted_containers(pair.by_key(loaded_containers)), container_counts(legs, runs))


def test_lanes_must_agree_and_null_lanes_do_not(spark):
    got = {r.departure_date for r in loaded_containers(_legs(spark, 14, 7), _runs(spark, 7)).collect()}
    other = {r[0] for r in _runs(spark, 7).filter(F.col("destination_node_id") == "DN_AA").select(
        F.to_date("departure_datetime")).collect()}
    assert got == other and len(other) == 5


def test_empty_tables(spark):
    legs, runs = _legs(spark, 0, 1), _runs(spark, 0)
    pair = publish_pair(legs, runs, f"{new_workspace(spark)}/pair", "truck_id", BUCKETS)
    assert pair.by_key(truck_triplets).count() == 0
    assert pair.even[0].columns == legs.columns


def test_a_failed_replacement_leaves_the_old_pair(spark):
    path = f"{new_workspace(spark)}/pair"
    legs, runs = _legs(spark, 60, 6), _runs(spark, 6)
    publish_pair(legs, runs, path, "truck_id", BUCKETS)
    broken = _runs(spark, 6).withColumn("cbm", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        publish_pair(legs.limit(1), broken, path, "truck_id", BUCKETS)
    assert versions.commits(spark, path) == [0]
    _same(read_pair(spark, path).even[0], legs)


def test_a_replacement_may_read_the_pair_and_other_sessions_find_it(spark):
    path = f"{new_workspace(spark)}/o'hare pair"
    pair = publish_pair(_legs(spark, 60, 6), _runs(spark, 6), path, "truck_id", BUCKETS)
    publish_pair(pair.even[0].filter("truck_id = 'TRK_0000001'"), pair.even[1], path, "truck_id", 3)
    again = read_pair(spark.newSession(), path)
    assert again.even[0].unionByName(again.loose[0]).count() == 10
    assert pair.even[0].unionByName(pair.loose[0]).count() == 60 if pair.loose else pair.even[0].count() == 60


def test_buckets_of_the_query_follow_the_rows(spark, monkeypatch):
    from checks import queries

    legs, runs = _legs(spark, 1000, 50), _runs(spark, 50)
    given = []
    monkeypatch.setattr(queries, "publish_pair", lambda left, right, path, key, buckets: given.append(buckets))
    for double in (False, True):
        t = queries.Tables(spark, "unused")
        t._published = {"derived/wms": legs.unionByName(legs) if double else legs, "derived/tms": runs}
        monkeypatch.setattr(queries, "buckets_for", lambda *a, least: colocated.buckets_for(*a, least=least, rows=50))
        t.by_truck  # noqa: B018
    assert given == [21, 41]
    assert colocated.buckets_for(legs, runs, least=16) == 16
