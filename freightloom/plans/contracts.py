"""Contracts of published tables: what consumers may rely on, as a table with a history.

A contract has one row for a column: its type, its place in the key, and, where it was observed and not only declared, the rows
and nulls of the table and the values a flag takes.  ``changes`` compares two of them.  A removed column, another type and
another key break consumers; an added column and a new flag value do not, but are reported.  ``publish_contract`` keeps
each accepted contract as a committed version, numbered major.minor by what has changed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.schemas import declared
from freightloom.sources import versions

CONTRACT_COLUMNS = ("table_name string, column_name string, data_type string, key_position int, row_count long, "
                    "null_count long, flag_values array<string>")
COLUMN = ["table_name", "column_name"]
CHANGES = ("change", "before", "after", "is_breaking", "nulls_before", "nulls_after")


class BreakingChange(ValueError):
    """A contract that breaks consumers was published without being announced."""


def is_flag(name: str) -> bool:
    return name.endswith("_flag") or name == "quality_record"


def observe(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Contract rows of a table as it is: one aggregate over it; a flag has a few labels, so its values fit a row."""
    found = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)],
        *[F.array_sort(F.collect_set(F.col(f"`{c}`"))).alias(f"_v{i}") for i, c in enumerate(df.columns) if is_flag(c)])
    rows = [F.struct(
        F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.lit(keys.index(f.name) + 1 if f.name in keys else None).cast("int").alias("key_position"),
        F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
        (F.col(f"_v{i}") if is_flag(f.name) else F.lit(None).cast("array<string>")).alias("flag_values"),
    ) for i, f in enumerate(df.schema)]
    return found.select(F.inline(F.array(*rows)))


def observed(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [observe(n, df, list(keys)) for n, (df, keys) in tables.items()])


def declared_contract(spark: SparkSession, tables: Mapping[str, tuple[T.StructType, Sequence[str]]] | None = None) -> DataFrame:
    """Contract rows of declared schemas, by default those of all published tables; nothing is known of their rows."""
    rows = [(name, f.name, f.dataType.simpleString(), keys.index(f.name) + 1 if f.name in keys else None, None, None, None)
            for name, (schema, keys) in (declared() if tables is None else tables).items() for f in schema]
    return spark.createDataFrame(rows, CONTRACT_COLUMNS)


def _keys(contract: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    place = F.when(F.col("key_position").isNotNull(), F.struct("key_position", "column_name"))
    names = F.transform(F.array_sort(F.collect_list(place)), lambda k: k["column_name"])
    return contract.groupBy(*by, "table_name").agg(F.array_join(names, ",").alias(out))


def changes(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Differences of two contracts: table, column (NULL for the key), change, before, after, whether it breaks, nulls.

    ``by`` names further columns on which the two are matched, such as a version.
    """
    on = [*by, *COLUMN]
    columns = ("data_type", "null_count", "flag_values")
    old = before.select(*on, *[F.col(c).alias(f"_old_{c}") for c in columns])
    new = after.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    # COLUMN is never NULL, so a NULL type on one side means that the column is not there
    both = old.join(new, on, "full")
    was, now = F.col("_old_data_type"), F.col("_new_data_type")
    kind = F.when(now.isNull(), "removed").when(was.isNull(), "added").when(was != now, "retyped")
    out = both.withColumn("change", kind).filter(F.col("change").isNotNull()).select(
        *on, "change", was.alias("before"), now.alias("after"), (F.col("change") != "added").alias("is_breaking"),
        F.col("_old_null_count").alias("nulls_before"), F.col("_new_null_count").alias("nulls_after"))
    none, count = F.lit(None).cast("string"), F.lit(None).cast("long")
    labels = both.filter(was.isNotNull() & now.isNotNull()).select(
        *on, F.lit("flag_value_added").alias("change"), none.alias("before"),
        F.explode(F.array_except("_new_flag_values", "_old_flag_values")).alias("after"), F.lit(False).alias("is_breaking"),
        count.alias("nulls_before"), count.alias("nulls_after"))
    keys = _keys(before, by, "before").join(_keys(after, by, "after"), [*by, "table_name"]).filter("before <> after").select(
        *by, "table_name", none.alias("column_name"), F.lit("key_changed").alias("change"), "before", "after",
        F.lit(True).alias("is_breaking"), count.alias("nulls_before"), count.alias("nulls_after"))
    return out.unionByName(labels).unionByName(keys)


def publish_contract(spark: SparkSession, path: str, contract: DataFrame, announced: bool = False) -> tuple[int, int]:
    """Make ``contract`` the current one; its version (major, minor).

    A contract that changes nothing leaves the version as it is.  One that breaks consumers raises ``BreakingChange`` unless it
    was ``announced`` to them; it then counts as a major version.  A commit by another writer in between is a conflict.
    """
    numbers = versions.commits(spark, path)
    major, minor = 1, 0
    if numbers:
        last = versions.read(spark, path, numbers[-1])
        major, minor = last.select("major", "minor").first()
        kinds = changes(last.drop("major", "minor"), contract).groupBy("is_breaking").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.concat_ws(" ", "table_name", "column_name", "change")).alias("example")).collect()
        breaking = [r for r in kinds if r.is_breaking]
        if not kinds:
            return major, minor
        if breaking and not announced:
            raise BreakingChange(f"{breaking[0].n} breaking changes, one of them: {breaking[0].example}")
        major, minor = (major + 1, 0) if breaking else (major, minor + 1)
    numbered = contract.withColumns({"major": F.lit(major), "minor": F.lit(minor)}).coalesce(1)
    versions.commit(spark, path, versions.stage(numbered, path), numbers[-1] if numbers else -1)
    return major, minor


def history(spark: SparkSession, path: str) -> DataFrame:
    """Every change since the first contract, with the version that brought it."""
    numbers = versions.commits(spark, path)
    every = reduce(DataFrame.unionByName, [versions.read(spark, path, n).withColumn("_at", F.lit(i)) for i, n in enumerate(numbers)])
    before = every.drop("major", "minor").withColumn("_at", F.col("_at") + 1).filter(F.col("_at") < len(numbers))
    after = every.drop("major", "minor").filter(F.col("_at") > 0)
    version = every.select("_at", "major", "minor").distinct()
    return changes(before, after, ["_at"]).join(version, "_at").select("major", "minor", *COLUMN, *CHANGES)
