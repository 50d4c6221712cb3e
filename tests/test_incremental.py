"""Scored tables kept up to date by buckets equal a full rebuild and leave other buckets alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freightloom.plans import incremental as inc
from freightloom.plans.shipments import silver_wms
from freightloom.plans.transport import silver_tms
from freightloom.sources import buckets, versions
from freightloom.sources.sinks import publish, table_path

N = 16


def runs_of(raw, ids):
    return raw(inc.RUNS, *[(i, "ON_AA", "DN_AA", "Alpha", f"2025-07-{1 + n % 28:02d} 08:00:00", "5", f"2025-07-{1 + n % 28:02d} 13:00:00",
                            "2", "2", "1.5") for n, i in enumerate(ids)])


def legs_of(raw, *pairs):
    return raw(inc.LEGS, *[(s, t, "MTL_1", "2025-07-01", "ON_AA", "DN_AA", "DN_AA") for s, t in pairs])


def truck(n):
    return f"TRUCK-{n:07d}"


def ship(n):
    return f"SHP_{n:09d}"


@pytest.fixture
def base(spark, network, rates, tmp_path):
    publish(network, str(tmp_path), "silver", inc.NETWORK)
    publish(rates, str(tmp_path), "silver", inc.RATES)
    return str(tmp_path)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def same_as_rebuild(spark, base, runs, legs, network, rates):
    tms = silver_tms(runs, network, rates)
    assert rows(inc.read_scored(spark, base, inc.RUNS)) == rows(tms)
    assert rows(inc.read_scored(spark, base, inc.LEGS)) == rows(silver_wms(legs, tms, network))


def files(spark, base, name):
    return {b: p for b, p in buckets.manifest(spark, table_path(base, inc.SCORED, name)).items()}


def test_appends_equal_a_rebuild(spark, raw, base, network, rates):
    runs = runs_of(raw, [truck(i) for i in range(30)])
    legs = legs_of(raw, *[(ship(i), truck(i // 2)) for i in range(60)], ("SHP_X", None))
    inc.append_raw(runs, base, inc.RUNS, N)
    inc.append_raw(legs, base, inc.LEGS, N)
    inc.refresh_scored(spark, base, count=N)
    same_as_rebuild(spark, base, runs, legs, network, rates)
    before = files(spark, base, inc.LEGS)

    # a copy in another spelling, one leg more for a run, a leg whose run comes later
    late = legs_of(raw, (ship(1), f" {truck(0)} "), (ship(99), truck(3)), (ship(100), truck(40)))
    touched = inc.append_raw(late, base, inc.LEGS, N)
    done = inc.refresh_scored(spark, base, count=N)
    assert done == {inc.RUNS: [], inc.LEGS: sorted(touched)} and 0 < len(touched) <= 3
    legs = legs.unionByName(late)
    same_as_rebuild(spark, base, runs, legs, network, rates)
    after = files(spark, base, inc.LEGS)
    assert {b for b in after if after[b] != before.get(b)} == set(touched)

    # the run arrives: its bucket alone is scored again, in both tables
    late_run = runs_of(raw, [truck(40)])
    touched = inc.append_raw(late_run, base, inc.RUNS, N)
    assert inc.refresh_scored(spark, base, count=N) == {inc.RUNS: touched, inc.LEGS: touched}
    same_as_rebuild(spark, base, runs.unionByName(late_run), legs, network, rates)
    assert inc.refresh_scored(spark, base, count=N) == {inc.RUNS: [], inc.LEGS: []}


def test_failed_refresh_is_made_up_for(spark, raw, base, network, rates, monkeypatch):
    runs, legs = runs_of(raw, [truck(1)]), legs_of(raw, (ship(1), truck(1)), (ship(2), truck(1)))
    inc.append_raw(runs, base, inc.RUNS, N)
    inc.append_raw(legs, base, inc.LEGS, N)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(inc, "silver_wms", fails)
        with pytest.raises(RuntimeError):
            inc.refresh_scored(spark, base, count=N)
    done = inc.refresh_scored(spark, base, count=N)
    assert done[inc.RUNS] == [] and len(done[inc.LEGS]) == 1
    same_as_rebuild(spark, base, runs, legs, network, rates)


def test_new_reference_version_touches_every_bucket(spark, raw, base, network, rates):
    runs, legs = runs_of(raw, [truck(i) for i in range(5)]), legs_of(raw, *[(ship(i), truck(i)) for i in range(5)])
    inc.append_raw(runs, base, inc.RUNS, N)
    inc.append_raw(legs, base, inc.LEGS, N)
    first = inc.refresh_scored(spark, base, count=N)
    smaller = network.where("node_id <> 'DN_AA'")
    publish(smaller, base, "silver", inc.NETWORK)
    assert inc.refresh_scored(spark, base, count=N) == first
    same_as_rebuild(spark, base, runs, legs, smaller, rates)


def test_buckets(spark, tmp_path):
    path, key = str(tmp_path / "t"), F.col("k")
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    first = buckets.append(df, path, key, 8)
    assert buckets.append(df.where("k = 'a'"), path, key, 8)[0] in first
    schema = buckets.schema_of(spark, path)
    assert buckets.read(spark, path, schema).count() == 4
    mine = df.select(buckets.bucket_of(key, 8)).where("k is null").first()[0]
    assert {r.v for r in buckets.read(spark, path, schema, [mine]).collect()} >= {3}
    assert buckets.compact(spark, path, key, 8) >= 1 and buckets.compact(spark, path, key, 8) == 0
    assert sorted(r.v for r in buckets.read(spark, path, schema).collect()) == [1, 1, 2, 3]
    with pytest.raises(ValueError, match="8 buckets"):
        buckets.append(df, path, key, 4)
    with pytest.raises(ValueError, match="not replaced"):
        buckets.rewrite(df, path, key, {}, 8)
    everything = dict.fromkeys(range(8), "x")
    buckets.rewrite(df.limit(0), path, key, everything, 8)
    assert buckets.read(spark, path, schema).count() == 0
    last = versions.commits(spark, path)[-1]
    buckets.append(df, path, key, 8)
    assert buckets.manifest(spark, path, last) != buckets.manifest(spark, path)


def parts(spark, base, name):
    return {b: {p.name for p in ps} for b, ps in files(spark, base, name).items()}


@pytest.mark.parametrize("hot", [False, True])
def test_new_trucks_leave_scored_parts_alone(spark, raw, base, network, rates, monkeypatch, hot):
    if hot:
        from freightloom.operators import keep_first
        monkeypatch.setattr(keep_first, "PLACES", 8)
        monkeypatch.setattr(keep_first, "HOT_ROWS", 15)
    monkeypatch.setattr(buckets, "CELL", 2)  # several pieces a bucket
    runs = runs_of(raw, [*[truck(i) for i in range(20)], truck(3), f" {truck(4)} ", None, None])
    legs = legs_of(raw, *[(ship(i), truck(i // 2)) for i in range(60)], (ship(8), truck(4)), (ship(9), f"{truck(4)} "), (" ", truck(5)),
                   (None, truck(6)), (None, None), (ship(1), None), *[(ship(200 + i), truck(7)) for i in range(60 * hot)])
    inc.append_raw(runs, base, inc.RUNS, N)
    inc.append_raw(legs, base, inc.LEGS, N)
    inc.refresh_scored(spark, base, count=N)
    if hot:
        same_as_rebuild(spark, base, runs, legs, network, rates)
        return
    before = {n: parts(spark, base, n) for n in (inc.RUNS, inc.LEGS)}

    # trucks nobody has seen, in every bucket; the last runs get no legs yet
    late_runs, late_legs = runs_of(raw, [truck(i) for i in range(100, 160)]), legs_of(
        raw, *[(ship(500 + i), truck(100 + i // 2)) for i in range(80)], (ship(500), f"{truck(100)}\t"), (ship(501), truck(100)))
    inc.append_raw(late_runs, base, inc.RUNS, N)
    inc.append_raw(late_legs, base, inc.LEGS, N)
    inc.refresh_scored(spark, base, count=N)
    runs, legs = runs.unionByName(late_runs), legs.unionByName(late_legs)
    for n, had in before.items():
        now = parts(spark, base, n)
        assert all(had[b] - {""} <= now[b] for b in had) and any(len(now[b]) == 2 for b in now)

    # legs of runs that had none need old runs, one leg more of a truck a rewrite
    had = parts(spark, base, inc.LEGS)
    late = legs_of(raw, *[(ship(900 + i), truck(150 + i)) for i in range(10)], (ship(1), truck(2)))
    inc.append_raw(late, base, inc.LEGS, N)
    inc.refresh_scored(spark, base, count=N)
    same_as_rebuild(spark, base, runs, legs.unionByName(late), network, rates)
    assert any(had[b] - now for b, now in parts(spark, base, inc.LEGS).items() if b in had)
    assert buckets.compact(spark, table_path(base, inc.SCORED, inc.LEGS), F.trim("truck_id"), N) > 0
    assert inc.refresh_scored(spark, base, count=N) == {inc.RUNS: [], inc.LEGS: []}


def test_trucks_are_not_collected_to_find_those_in_common(spark, raw, base, network, rates, monkeypatch):
    """Under a threshold that the bytes of their files stay below, the scored trucks all went through the driver."""
    frame, plans = type(spark.range(1)), []
    collect = frame.collect

    def seen(df):
        out = collect(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    runs, legs = runs_of(raw, [truck(i) for i in range(20)]), legs_of(raw, *[(ship(i), truck(i // 2)) for i in range(40)])
    inc.append_raw(runs, base, inc.RUNS, N)
    inc.append_raw(legs, base, inc.LEGS, N)
    inc.refresh_scored(spark, base, count=N)
    late_runs = runs_of(raw, [truck(3), truck(40), None])
    late_legs = legs_of(raw, (ship(90), f" {truck(5)}"), (ship(91), truck(40)), (ship(92), truck(41)), (ship(93), None))
    inc.append_raw(late_runs, base, inc.RUNS, N)
    inc.append_raw(late_legs, base, inc.LEGS, N)
    with monkeypatch.context() as m:
        m.setattr(frame, "collect", seen)
        inc.refresh_scored(spark, base, count=N)
    of_trucks = [p for p in plans if "_h#" in p]
    assert len(of_trucks) == 3 and not any("Broadcast" in p for p in of_trucks)
    same_as_rebuild(spark, base, runs.unionByName(late_runs), legs.unionByName(late_legs), network, rates)
