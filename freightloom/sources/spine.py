"""Generated date series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days(start: date | str, end: date | str) -> Column:
    """Array of all days from ``start`` to ``end``, both included."""
    bounds = [F.lit(str(d)).cast("date") for d in (start, end)]
    return F.sequence(*bounds, F.expr("interval 1 day"))


def date_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day."""
    return spark.range(1).select(F.explode(days(start, end)).alias("date"))


def spread_over_days(df: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Every row once per day: rows times spine as an explode, with no join."""
    return df.select(F.explode(days(start, end)).alias("date"), "*")
