"""Contracts: kinds of change, versions and their history; the published tables keep their declared contract."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freightloom.plans import contracts as K
from freightloom.plans.master_data import silver_rates
from freightloom.schemas import CONTRACT, FEEDS, declared


def told(df):
    return {(r.table_name, r.column_name, r.change, r.before, r.after, r.is_breaking) for r in df.collect()}


@pytest.fixture
def first(spark):
    return spark.createDataFrame([("a", 1, "x", "ok"), ("b", 2, None, "bad")], "id string, n int, note string, n_quality_flag string")


def test_observed_columns(first):
    got = {r.column_name: r for r in K.observe("t", first, ["n", "id"]).collect()}
    assert list(got) == first.columns
    assert (got["id"].key_position, got["n"].key_position, got["note"].key_position) == (2, 1, None)
    assert (got["note"].row_count, got["note"].null_count, got["note"].flag_values) == (2, 1, None)
    assert got["n_quality_flag"].flag_values == ["bad", "ok"] and got["n"].data_type == "int"
    empty = {r.column_name: r for r in K.observe("t", first.limit(0), []).collect()}
    assert (empty["note"].row_count, empty["n_quality_flag"].flag_values) == (0, [])


def test_kinds_of_change(first):
    before = K.observe("t", first, ["id"])
    assert told(K.changes(before, before)) == set()
    other = first.drop("note").withColumns({"n": F.col("n").cast("long"), "more": F.lit(1.5)}).withColumn(
        "n_quality_flag", F.when(F.col("id") == "a", "odd").otherwise(F.col("n_quality_flag")))
    assert told(K.changes(before, K.observe("t", other, ["id", "n"]))) == {
        ("t", "note", "removed", "string", None, True), ("t", "n", "retyped", "int", "bigint", True),
        ("t", "more", "added", None, "double", False), ("t", "n_quality_flag", "flag_value_added", None, "odd", False),
        ("t", None, "key_changed", "id", "id,n", True)}
    # a table that is new adds its columns, one that is gone removes them; neither has its key changed
    assert {(r[1], r[2], r[5]) for r in told(K.changes(before, K.observe("u", first.select("id"), ["id"])))} == {
        *((c, "removed", True) for c in first.columns), ("id", "added", False)}


def test_versions_and_history(spark, first, tmp_path):
    path = str(tmp_path / "contract")
    assert K.publish_contract(spark, path, K.observe("t", first, ["id"])) == (1, 0)
    assert K.publish_contract(spark, path, K.observe("t", first, ["id"])) == (1, 0)
    wider = first.withColumn("more", F.lit(True))
    assert K.publish_contract(spark, path, K.observe("t", wider, ["id"])) == (1, 1)
    narrow = K.observe("t", wider.drop("note"), ["id"])
    with pytest.raises(K.BreakingChange, match="t note removed"):
        K.publish_contract(spark, path, narrow)
    assert K.publish_contract(spark, path, narrow, announced=True) == (2, 0)
    got = {(r.major, r.minor, r.column_name, r.change, r.is_breaking) for r in K.history(spark, path).collect()}
    assert got == {(1, 1, "more", "added", False), (2, 0, "note", "removed", True)}


def test_scored_tables_keep_their_contract(spark, network, rates):
    tables = {"mdm_network": network, "fin_transport_rates": rates}
    want = K.declared_contract(spark, {n: declared()[n] for n in tables})
    assert told(K.changes(want, K.observed({n: (df, FEEDS[n].grain) for n, df in tables.items()}))) == set()
    assert set(declared()) >= set(CONTRACT) and len(declared()) == 11


def test_a_lost_flag_is_noticed(spark, raw):
    scored = silver_rates(raw("fin_transport_rates", ("FR", "Alpha", "300", "1.0"))).drop("carrier_quality_flag")
    want = K.declared_contract(spark, {"fin_transport_rates": declared()["fin_transport_rates"]})
    got = told(K.changes(want, K.observe("fin_transport_rates", scored, FEEDS["fin_transport_rates"].grain)))
    assert got == {("fin_transport_rates", "carrier_quality_flag", "removed", "string", None, True)}
