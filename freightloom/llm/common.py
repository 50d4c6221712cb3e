"""Small helpers shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.sources.workspace import new_workspace

#: ASCII white space, the only kind the text contracts name.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` below ``folder`` (shared by the cluster) and read it back: lineage ends here."""
    path = f"{folder}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def workspace(spark: SparkSession) -> str:
    return new_workspace(spark)


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
             schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with plain column lists: ``rows`` gets and yields {column: list}, batch by batch."""
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(kind)
        taken = (b.to_pydict() for b in batches)
        for out in rows(taken):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def numbered(docs: DataFrame, folder: str) -> tuple[DataFrame, str]:
    """The table, written with a number per row, and the name of that column; numbers do not change on a retry."""
    name = "row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return kept(docs.withColumn(name, F.monotonically_increasing_id()), folder, "numbered"), name


def place(doc_id: str = "doc_id", row: str = "row"):
    """(doc_id, row) as one number of fixed width, NULL ids last: its minimum needs no sort."""
    last = F.coalesce(F.col(doc_id), F.lit(2**63 - 1)).cast("decimal(19,0)")
    return (last * F.lit(Decimal(10**19)) + F.col(row)).cast("decimal(38,0)")


def rank_of(doc_id: int | None) -> int:
    """crc32 of the decimal id (empty for NULL), modulo 5: rows with 0 are held out from learning."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5


def held_out(column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5 == 0
