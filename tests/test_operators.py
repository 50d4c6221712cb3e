from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freightloom.functions.geo import haversine_km
from freightloom.operators.distances import lane_distances, nearest_nodes
from freightloom.operators.keep_first import keep_first, qualify_first
from freightloom.operators.lookup import bounded, member_flag, row_bytes
from freightloom.operators.percentiles import RANK_ERROR, percentiles, sketched_percentiles, value_cuts, value_sketches
from freightloom.sources.spine import date_spine, spread_over_days


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", ""]), st.sampled_from([None, "x", "y"]),
                          st.integers(0, 3)), min_size=1, max_size=30))
def test_keep_first_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, v string, n int")
    got = {r.k: (r.v, r.n, r.c) for r in keep_first(df, ["k"], order=["n", "v"], copies="c").collect()}
    want = {}
    for k in {d[0] for d in data}:
        group = [d for d in data if d[0] == k]
        best = min(group, key=lambda d: (d[2], d[1] is not None, d[1] or ""))
        want[k] = (best[1], best[2], len(group))
    assert got == want


def test_keep_first_uses_the_ingest_order(spark):
    df = spark.createDataFrame([("a", "late", "f", 7), ("a", "early", "f", 2), ("a", "other", "g", 0)],
                               "k string, v string, _src_file string, _ord bigint")
    assert [r.v for r in keep_first(df, ["k"]).collect()] == ["early"]


def test_keep_first_same_result_on_any_partitioning(spark):
    df = spark.range(4000).select((F.col("id") % 7).cast("string").alias("k"), F.hash("id").alias("v"))
    first = sorted(map(tuple, keep_first(df.repartition(1), ["k"]).collect()))
    assert first == sorted(map(tuple, keep_first(df.repartition(8, F.rand(1)), ["k"]).collect()))


def test_keep_first_combines_hot_keys_before_the_shuffle(spark):
    """A key with a third of all rows: the plan aggregates in the map tasks and has no window."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], copies="c")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    assert out.count() == 20001 and out.filter("k = 'hot'").first().c == 10000


def test_qualify_first_descending(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, n int, v string")
    assert {r.k: r.v for r in qualify_first(df, ["k"], ["n"], desc=True).collect()} == {"a": "y", "b": "z"}


def test_bounded_broadcasts_small_frames_only(spark):
    def joined(limit):
        dim = spark.range(50).withColumnRenamed("id", "d")
        return spark.range(1000).join(bounded(dim, limit), F.col("id") == F.col("d"))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = joined(50), joined(49)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (small, large)]
        assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
        assert small.count() == large.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bounded_measures_bytes_too(spark):
    wide = spark.range(10).select(F.col("id").alias("d.e"), F.lit("é" * 500).alias("t"), F.array(F.lit("x" * 500)).alias("a"))
    size = wide.agg(F.sum(row_bytes(wide))).first()[0]
    assert size >= 10 * (1000 + 500)

    def hinted(max_bytes):
        return "ResolvedHint" in bounded(wide, max_bytes=max_bytes)._jdf.queryExecution().analyzed().toString()

    assert hinted(size) and not hinted(size - 1)
    assert "ResolvedHint" in bounded(wide.limit(0), max_bytes=0)._jdf.queryExecution().analyzed().toString()


def test_member_flag_three_valued(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "x string")

    def absent(*members):
        ref = spark.createDataFrame([(m,) for m in members], "m string")
        return {r.x: r.out for r in member_flag(df, "x", ref, "out").collect()}

    assert absent("a", "b") == {"a": False, "z": True, None: None}
    assert absent("a", None) == {"a": False, "z": None, None: None}
    assert absent() == {"a": True, "z": True, None: True}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=40))
def test_percentiles_against_numpy(spark, data):
    df = spark.createDataFrame([(k, None if v is None else v / 4) for k, v in data], "k string, v double")
    points = {"p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: [r[p] for p in points] for r in percentiles(df, ["k"], "v", points).collect()}
    for k in {k for k, v in data if v is not None}:
        sample = [v / 4 for key, v in data if key == k and v is not None]
        assert np.allclose(got.pop(k), [np.percentile(sample, q * 100) for q in points.values()])
    assert not got


def test_nearest_nodes_against_brute_force(spark):
    rng = np.random.default_rng(5)
    nodes = [(f"N{i:03d}", "FR" if i % 3 else "DE", float(rng.uniform(36, 60)), float(rng.uniform(-5, 30))) for i in range(120)]
    schema = "node_id string, country string, latitude double, longitude double"
    sources, candidates = spark.createDataFrame(nodes[:20], schema), spark.createDataFrame(nodes[20:], schema)
    pairs = sources.alias("a").crossJoin(candidates.alias("b")).select(
        F.col("a.node_id").alias("s"), F.col("b.node_id").alias("c"), F.expr("a.country <> b.country").alias("foreign"),
        haversine_km(*[F.col(c) for c in ("a.latitude", "a.longitude", "b.latitude", "b.longitude")]).alias("km")).collect()
    for prefer in (False, True):
        got = nearest_nodes(sources, candidates, 5, same_country_first=prefer, block=16).collect()
        for s, *_ in nodes[:20]:
            rank = sorted((p.foreign and prefer, p.km, p.c) for p in pairs if p.s == s)[:5]
            mine = sorted((r["rank"], r.distance_km, r.node_id) for r in got if r.source_id == s)
            assert [(km, c) for _, km, c in mine] == [(km, c) for _, km, c in rank]


def test_nearest_nodes_fewer_candidates_than_k(spark):
    schema = "node_id string, country string, latitude double, longitude double"
    one = spark.createDataFrame([("A", "FR", 45.0, 5.0), ("B", "FR", None, 5.0)], schema)
    assert [(r.source_id, r.node_id) for r in nearest_nodes(one, one, 9).collect()] == [("A", "A")]


def test_lane_distances_only_for_valid_lanes(spark, network):
    pairs = spark.createDataFrame(
        [("ON_AA", "CH_AA"), ("ON_AA", "DN_AA"), ("CH_AA", "DN_AA"), ("DN_AA", "ON_AA"), ("CH_AA", "CH_BB"),
         ("ON_AA", "XX"), ("ON_AA", "DN_AA")], "o string, d string")
    got = {(r.origin_node, r.destination_node) for r in lane_distances(pairs, network).collect()}
    assert got == {("ON_AA", "CH_AA"), ("ON_AA", "DN_AA"), ("CH_AA", "DN_AA")}


def test_spine(spark):
    assert date_spine(spark, "2025-07-01", "2025-12-31").count() == 184
    assert spread_over_days(spark.range(3), "2025-07-01", "2025-07-05").count() == 15


def test_percentiles_of_a_group_with_most_rows(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.pmod(F.hash("id"), F.lit(5000)) / 7).alias("v"))
    points = {"p10": 0.1, "p90": 0.9}
    got = {r.k: (r.n, r.p10, r.p90) for r in percentiles(df, ["k"], "v", points, count="n").collect()}
    sample = df.toPandas().groupby("k")["v"]
    assert set(got) == set(sample.groups)
    for k, v in sample:
        assert got[k][0] == len(v) and np.allclose(got[k][1:], np.percentile(v, [10, 90]))


def test_percentiles_with_null_group_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None)], "k string, v double")
    assert [(r.k, r.m) for r in percentiles(df, ["k"], "v", {"m": 0.5}).collect()] == [(None, 2.0)]
    assert percentiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_percentiles_gather_nothing_in_one_task(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 as string)) as k", "cast(id * 37 % 4999 as double) as v")
    got = percentiles(df, ["k"], "v", {"m": 0.5})
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    cuts = {r.k: len(r["_cuts"]) for r in value_cuts(df.groupBy("k", "v").count(), ["k"], "v", 4).collect()}
    assert cuts.pop("hot") in range(1, 12) and all(n < 12 for n in cuts.values())
    values = sorted(r.v for r in df.where("k = 'hot'").collect())
    assert np.isclose(got.where("k = 'hot'").first().m, np.percentile(values, 50))


def test_nearest_by_cells_against_brute_force(spark, monkeypatch):
    """Clusters, copies of one place, both poles, the date line and lone sources."""
    rng = np.random.default_rng(8)
    places = [(float(a), float(b)) for a, b in zip(rng.normal(48, 1.5, 150), rng.normal(2, 2, 150))]
    places += [(10.0, 20.0)] * 12 + [(89.9, x) for x in (0.0, 90.0, -180.0)] + [(-89.5, 45.0), (-90.0, 0.0), (90.0, 10.0)]
    places += [(float(a), float(b)) for a, b in zip(rng.uniform(-5, 5, 30), [*rng.uniform(178, 180, 15), *rng.uniform(-180, -178, 15)])]
    places += [(float(a), float(b)) for a, b in zip(rng.uniform(-80, 80, 40), rng.uniform(-180, 180, 40))]
    rng.shuffle(places)
    nodes = [(f"N{i:03d}", ["FR", "DE", "RARE" if i < 20 else "FR", None][i % 4], *p) for i, p in enumerate(places)]
    schema = "node_id string, country string, latitude double, longitude double"
    asked = nodes[:60] + [("S1", "FR", 0.0, 180.0), ("S2", "DE", 0.0, -180.0), ("S3", "XX", 90.0, 77.0), ("S4", "FR", None, 1.0)]
    sources, candidates = spark.createDataFrame(asked, schema), spark.createDataFrame(nodes, schema)
    pairs = sources.filter("latitude IS NOT NULL").alias("a").crossJoin(candidates.alias("b")).select(
        F.col("a.node_id").alias("s"), F.col("b.node_id").alias("c"), F.expr("NOT a.country <=> b.country").alias("foreign"),
        haversine_km(*[F.col(c) for c in ("a.latitude", "a.longitude", "b.latitude", "b.longitude")]).alias("km")).collect()
    for prefer in (False, True):
        got = nearest_nodes(sources, candidates, 4, same_country_first=prefer, block=8).collect()
        want = {}
        for p in sorted(pairs, key=lambda p: (p.s, p.foreign and prefer, p.km, p.c)):
            want.setdefault(p.s, []).append((p.km, p.c))
        mine = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            mine.setdefault(r.source_id, []).append((r.distance_km, r.node_id))
        assert mine == {s: found[:4] for s, found in want.items()}
    everyone = nearest_nodes(sources, candidates, None, block=64)
    assert everyone.count() == len(pairs) and everyone.filter("rank = 1 AND node_id <> source_id").count() > 0


def test_cells_bound_the_pairs(spark):
    rng = np.random.default_rng(9)
    schema = "node_id string, country string, latitude double, longitude double"
    nodes = [(f"N{i:04d}", "FR", float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-60, 60, 3000), rng.uniform(-180, 180, 3000)))]
    frame = spark.createDataFrame(nodes, schema)
    from freightloom.operators import distances
    asked = distances._sources(frame).withColumn("_needed", F.lit(0).cast("long"))
    assert distances.cell_pairs(asked, frame, 7, False).count() < 3000 * 20  # nine cells of 2.8 degrees, not 3000 candidates


def test_sketches_merge_and_keep_their_rank_error(spark):
    rng = np.random.default_rng(4)
    rows = [(f"L{i % 3}", int(d), float(v)) for i, (d, v) in enumerate(zip(rng.integers(0, 40, 30000), rng.gamma(2, 3, 30000)))]
    rows += [("small", d, float(d)) for d in range(11)] + [("L0", 1, None)]
    df = spark.createDataFrame(rows, "lane string, day int, hours double")
    daily = value_sketches(df, ["lane", "day"], "hours")
    points = {"p05": .05, "p50": .5, "p95": .95}
    for r in sketched_percentiles(daily, ["lane"], points, "runs").collect():
        values = np.sort([v for lane, _, v in rows if lane == r.lane and v is not None])
        assert r.runs == len(values)
        for name, p in points.items():
            low, high = np.searchsorted(values, r[name], "left") / len(values), np.searchsorted(values, r[name], "right") / len(values)
            assert low - RANK_ERROR <= p <= high + RANK_ERROR
    few = sketched_percentiles(daily.filter("lane = 'small'"), ["lane"], points).first()
    assert few.p50 == 5.0 and few.p95 == 10.0
