"""Tables as committed versions: a replacement is seen whole or not at all.

A version is written to a folder of its own below ``_versions``.  It becomes the table when a commit, a small file that names it,
appears below ``_commits`` under the next number.  The commit is written under another name first and renamed, which fails if
the number is taken, so of two writers one wins and the other is told.  A write that fails half way leaves the last
commit in place.  A reader resolves the last commit once and then reads files that nobody changes.

Both folders start with an underscore, so reading the table's own folder by mistake fails instead of mixing versions.
The rename must be atomic, as it is on HDFS and local disks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.readwriter import DataFrameWriter

VERSIONS, COMMITS, DIGITS = "_versions", "_commits", 20


class CommitConflict(RuntimeError):
    """Another writer committed first."""


def _path(spark: SparkSession, path: str):
    """Hadoop path and file system of ``path``."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(found), files


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none if it is not there."""
    here, files = _path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(here)) if files.exists(here) else []


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits of a table, ascending."""
    return [int(n) for n in listed(spark, f"{path}/{COMMITS}") if len(n) == DIGITS and n.isdigit()]


def version_of(spark: SparkSession, path: str, number: int) -> str:
    """Folder of the version a commit names."""
    here, files = _path(spark, f"{path}/{COMMITS}/{number:0{DIGITS}d}")
    stream = files.open(here)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{VERSIONS}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    return bool(commits(spark, path))


def current(spark: SparkSession, path: str) -> str:
    """Folder of the last committed version."""
    numbers = commits(spark, path)
    if not numbers:
        raise FileNotFoundError(f"no committed table at {path}")
    return version_of(spark, path, numbers[-1])


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of the last commit, or of commit ``number``."""
    return spark.read.parquet(current(spark, path) if number is None else version_of(spark, path, number))


def stage(df: DataFrame, path: str, how: Callable[[DataFrameWriter], DataFrameWriter] = lambda w: w) -> str:
    """Write a version that nobody sees yet; its name."""
    name = uuid.uuid4().hex
    how(df.write.mode("errorifexists")).parquet(f"{path}/{VERSIONS}/{name}")
    return name


def discard(spark: SparkSession, path: str, version: str) -> None:
    """Remove a version that was staged and will not be committed."""
    here, files = _path(spark, f"{path}/{VERSIONS}/{version}")
    files.delete(here, True)


def commit(spark: SparkSession, path: str, version: str, after: int | None = None) -> int:
    """Make a staged version the table; the commit's number.

    ``after`` is the last commit the writer has seen: with it, any commit since is a conflict.  Without it the last
    writer wins.
    """
    while True:
        seen = (commits(spark, path) or [-1])[-1]
        if after is not None and seen != after:
            raise CommitConflict(f"{path}: commit {seen} came after {after}")
        here, files = _path(spark, f"{path}/{COMMITS}/_{version}")
        out = files.create(here, True)
        out.write(version.encode())
        out.close()
        there, _ = _path(spark, f"{path}/{COMMITS}/{seen + 1:0{DIGITS}d}")
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(here.toUri(), spark._jsc.hadoopConfiguration())
        no_overwrite = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(here, there, no_overwrite)
            return seen + 1
        except Py4JJavaError as error:
            files.delete(here, False)
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            if after is not None:
                raise CommitConflict(f"{path}: commit {seen + 1} is taken") from error


def replace(df: DataFrame, path: str, how: Callable[[DataFrameWriter], DataFrameWriter] = lambda w: w) -> DataFrame:
    """Replace a table, which ``df`` may read, and return the new version as read back."""
    spark = df.sparkSession
    version = stage(df, path, how)
    commit(spark, path, version)
    return spark.read.parquet(f"{path}/{VERSIONS}/{version}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` committed versions and their commits; the names of the versions removed.

    Run it when no reader holds an older version and no writer is at work: staged versions go too.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    numbers = commits(spark, path)
    alive = {version_of(spark, path, n).rsplit("/", 1)[1] for n in numbers[-keep:]}
    for n in numbers[:-keep]:
        here, files = _path(spark, f"{path}/{COMMITS}/{n:0{DIGITS}d}")
        files.delete(here, False)
    gone = [v for v in listed(spark, f"{path}/{VERSIONS}") if v not in alive]
    for name in gone:
        discard(spark, path, name)
    return gone
