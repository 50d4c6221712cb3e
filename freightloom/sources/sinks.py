"""Published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.sources import versions


def table_path(base: str, layer: str, name: str) -> str:
    return f"{base}/{layer}/{name}"


def publish(df: DataFrame, base: str, layer: str, name: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table and return it as read back, which cuts the lineage of what follows.

    The new rows are a version that becomes the table when it is complete (see ``versions``): a job that fails half way leaves
    the table as it was, and ``df`` may read it.  ``cluster_by`` range-partitions and sorts on filter
    columns so that Parquet statistics skip files.  A hash of the row breaks ties in the range
    bounds: one value that fills a third of the table is spread over several files.
    """
    if cluster_by:
        tie = F.xxhash64(*df.columns)
        df = df.repartitionByRange(*cluster_by, tie).sortWithinPartitions(*cluster_by)
    return versions.replace(df, table_path(base, layer, name))


def read_table(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """The last committed version of a table."""
    return versions.read(spark, table_path(base, layer, name))
