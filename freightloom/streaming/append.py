"""Append-only refresh of the transactional extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freightloom.schemas import FEEDS
from freightloom.sources.bronze import CORRUPT, too_long


def read_arrivals(spark: SparkSession, source_dir: str, table: str, multiline: bool = True) -> DataFrame:
    """Stream of new CSV files in a folder: all strings, the file and load date of each row, malformed text."""
    schema = FEEDS[table].schema.add(CORRUPT, "string")
    reader = spark.readStream.schema(schema).options(
        header=True, multiLine=multiline, escape='"', enforceSchema=False, columnNameOfCorruptRecord=CORRUPT)
    return reader.csv(source_dir).withColumns({
        "_src_file": F.col("_metadata.file_path"), "_load_date": F.current_date()})


def append_bronze(
    spark: SparkSession, source_dir: str, out: str, checkpoint: str, table: str, multiline: bool = True
) -> StreamingQuery:
    """Append the files not yet seen, then stop.  Each file is loaded once, also after a restart.

    A row with more fields than the header fails the batch before anything is written; its files are met again
    after they have been mended.  Rows carry the ingest order of a full load (``_src_file``, ``_ord``), so the
    first row per key is the same either way.  A batch has a folder of its own, which a repeated batch replaces.
    """
    if not FEEDS[table].append_only:
        raise ValueError(f"{table} is refreshed in full; use load_table")
    columns = len(FEEDS[table].columns)

    def append(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("_ord", F.monotonically_increasing_id())
        # the test reads every column, as a reader of few would not see the width of a row
        staged = f"{out}/_batch={number}"
        bad = batch.filter(too_long(columns) & (F.concat_ws(",", *FEEDS[table].columns) != CORRUPT)).count()
        if bad:
            raise ValueError(f"{table}: {bad} rows with more fields than the header; batch {number} was not loaded")
        numbered.drop(CORRUPT).write.mode("overwrite").partitionBy("_load_date").parquet(staged)

    return (
        read_arrivals(spark, source_dir, table, multiline)
        .writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
