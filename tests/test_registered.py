"""Registered queries against their SQL twins on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import rows
from checks.feeds import TABLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
CHECKED = ("silver_network", "silver_rates", "silver_tms", "silver_wms", "lane_days_filled", "lane_simulation",
           "container_compliance", "transit_drift", "quality_distribution", "hub_coverage_by_distance")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(oracle_sql()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_twin_agrees(spark, duck, name):
    df = queries()[name](spark, SF)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())
