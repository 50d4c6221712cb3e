from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freightloom.schemas import CONTRACT, FEEDS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("freightloom-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Raw feed from literal rows; missing trailing columns are NULL."""
    def make(table: str, *rows) -> DataFrame:
        width = len(FEEDS[table].columns)
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], FEEDS[table].schema)
    return make


@pytest.fixture(scope="session")
def typed(spark):
    """Scored table from dicts; the score is clean unless given, other missing columns are NULL."""
    def make(table: str, *rows) -> DataFrame:
        schema: T.StructType = CONTRACT[table]
        full = [{"quality_record": "clean", **r} for r in rows]
        return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in full], schema)
    return make


@pytest.fixture(scope="session")
def network(raw):
    """Three origins, two hubs and four delivery nodes, scored."""
    from freightloom.plans.master_data import silver_network
    return silver_network(raw(
        "mdm_network",
        ("ON_AA", "origin_node", "Lyon", "FR", "45.75", "4.85", "ALL"),
        ("ON_BB", "origin_node", "Bonn", "DE", "50.73", "7.10", "ALL"),
        ("ON_CC", "origin_node", "Pisa", "it", "43.72", "10.40", "ALL"),
        ("CH_AA", "consolidation_hub", "Metz", "FR", "49.12", "6.18", "MTL"),
        ("CH_BB", "consolidation_hub", "Ulm", "DE", "48.40", "9.99", "MTL"),
        ("DN_AA", "delivery_node", "Paris", "FR", "48.86", "2.35", "MTL"),
        ("DN_BB", "delivery_node", "Berlin", "DE", "52.52", "13.40", "BOX"),
        ("DN_CC", "delivery_node", "Rome", "IT", "41.90", "12.50", "ALL"),
        ("DN_DD", "delivery_node", "Lille", "FR", "50.63", "3.06", None),
    )).persist()


@pytest.fixture(scope="session")
def rates(raw):
    from freightloom.plans.master_data import silver_rates
    return silver_rates(raw(
        "fin_transport_rates",
        ("FR", "Alpha", "300", "1.0"), ("FR", "Beta", "400", "2.0"), ("DE", "Alpha", "250", "1.5"),
    )).persist()


def by(df: DataFrame, key: str, *columns: str) -> dict:
    """Rows as {key: value} or {key: (values...)}."""
    return {r[key]: r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns) for r in df.collect()}
