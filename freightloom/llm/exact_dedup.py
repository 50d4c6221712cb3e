"""Exact duplicates by content-defined chunk recipes, with built-in expressions only.

Each text is cut into chunks where its content says so; a document becomes the ordered list of its chunk
identifiers (the recipe).  Documents are equal when their recipes are.  Texts never leave the task that reads
them: 64-bit identifiers, chunk digests and one text digest move instead.

An identifier is verified by the SHA-256 of its chunk.  Should two different chunks share an identifier, every
recipe that holds it is compared together with the digest of the whole text.

Nulls, empty texts and ties: a NULL text is an empty one; empty texts are equal to each other; a NULL ``doc_id``
comes after all others and of rows with the same id and text one stays (the first read).  Other columns are
ignored whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept, place

#: A chunk ends after a space that follows letters of alternating halves of the alphabet, between these lengths.
SHORTEST, LONGEST = 512, 4096
CUT = r"[a-m][n-z][a-m][n-z] "
CHUNK = rf"(?s).{{{SHORTEST},{LONGEST - 5}}}?{CUT}|.{{1,{LONGEST}}}"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space.  Single spaces, most of all runs, are left alone."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, identify=F.xxhash64, row: str | None = None) -> DataFrame:
    """row (a column of the table or a new number), doc_id, text_sha256 and ``parts``: (identifier, digest) per chunk in order."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    text = docs.select(number.alias("row"), F.col("doc_id").cast("long"), normalised(F.col("text")).alias("text"))
    return text.select(
        "row", "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(chunks(F.col("text")), lambda c: F.struct(
            identify(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("digest"))).alias("parts"))


def exact_dedup(docs: DataFrame, folder: str, identify=F.xxhash64, row: str | None = None) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept, text_sha256 and the number of chunks, one row per input row."""
    slim = kept(recipes(docs, identify, row), folder, "recipes")
    forms = slim.select(F.explode("parts").alias("p")).select("p.id", "p.digest").distinct()
    unsafe = kept(forms.groupBy("id").count().where("count > 1").select("id"), folder, "unsafe")
    keyed = slim.select("row", "doc_id", "text_sha256", F.col("parts.id").alias("recipe"), F.lit("").alias("tie"))
    if not unsafe.isEmpty():
        doubtful = slim.select("row", F.explode("parts.id").alias("id")).join(unsafe, "id", "left_semi").select(
            "row").distinct().withColumn("doubtful", F.lit(True))
        keyed = keyed.join(doubtful, "row", "left").withColumn(
            "tie", F.when(F.col("doubtful"), F.col("text_sha256")).otherwise("")).drop("doubtful")
    keyed = keyed.withColumn("place", place())
    # Written, so that both sides of the last join are plain shuffles, which adaptive execution splits at a hot recipe.
    groups = kept(keyed.groupBy("recipe", "tie").agg(
        F.min("doc_id").alias("keep_id"), F.min("place").alias("first"), F.count(F.lit(1)).alias("group_size")).where(
        "group_size > 1"), folder, "groups")
    met = keyed.join(groups, ["recipe", "tie"], "left")
    alone = F.col("group_size").isNull()
    return met.select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("place") == F.col("first"))).alias("kept"), "text_sha256",
        F.size("recipe").cast("long").alias("n_chunks"))
