"""Committed versions of tables, and quoted CSV files read by ranges."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from freightloom.schemas import FEEDS
from freightloom.sources import versions
from freightloom.sources.bronze import load_all, read_bronze_csv
from freightloom.sources.quoted import quoted_records, read_quoted_csv
from freightloom.sources.sinks import publish, read_table


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    base = str(tmp_path)
    publish(spark.range(5).coalesce(1), base, "gold", "t")
    # the first task writes its rows, the second one fails
    broken = spark.range(0, 100, 1, 2).select(F.when(F.col("id") < 60, F.col("id")).otherwise(
        F.raise_error(F.lit("lost"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, base, "gold", "t")
    assert ids(read_table(spark, base, "gold", "t")) == [0, 1, 2, 3, 4]
    assert versions.commits(spark, f"{base}/gold/t") == [0]


def test_readers_see_old_or_new(spark, tmp_path):
    base, path = str(tmp_path), str(tmp_path / "gold/t")
    publish(spark.range(3), base, "gold", "t")
    before = read_table(spark, base, "gold", "t")
    staged = versions.stage(spark.range(10, 12), path)
    assert ids(read_table(spark, base, "gold", "t")) == [0, 1, 2]  # staged, not committed
    versions.commit(spark, path, staged)
    assert ids(read_table(spark, base, "gold", "t")) == [10, 11] and ids(before) == [0, 1, 2]
    assert ids(versions.read(spark, path, 0)) == [0, 1, 2]
    # a table may be replaced by what was read from it
    assert ids(publish(read_table(spark, base, "gold", "t").selectExpr("id + 1 AS id"), base, "gold", "t")) == [11, 12]
    with pytest.raises(Exception):
        spark.read.parquet(path).collect()


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(1), path)
    one, two = versions.stage(spark.range(2), path), versions.stage(spark.range(3), path)
    assert versions.commit(spark, path, one, after=0) == 1
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, path, two, after=0)
    assert versions.commit(spark, path, two) == 2 and ids(versions.read(spark, path)) == [0, 1, 2]
    staged = [versions.stage(spark.range(i), path) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda v: versions.commit(spark, path, v), staged))
    assert sorted(numbers) == [3, 4, 5, 6] and versions.commits(spark, path) == list(range(7))


def test_vacuum_keeps_the_last_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        versions.replace(spark.range(i + 1), path)
    versions.stage(spark.range(9), path)
    assert len(versions.vacuum(spark, path, 2)) == 3
    assert ids(versions.read(spark, path)) == [0, 1, 2, 3] and ids(versions.read(spark, path, 2)) == [0, 1, 2]
    assert versions.commits(spark, path) == [2, 3]
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, 0)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))


def test_rejected_load_keeps_the_table(spark, tmp_path):
    file, out = tmp_path / "fin_procurement.csv", str(tmp_path / "out")
    header = ",".join(FEEDS["fin_procurement"].columns)

    def load():
        return {r.table_name: r.status for r in load_all(spark, str(tmp_path), out).collect()}["fin_procurement"]

    file.write_text(f"{header}\nA,1,yes,x\n")
    assert load() == "OK"
    file.write_text(f"{header}\nB,1,yes,x\nC,1,yes,x,more\n")
    assert load() == "REJECTED"
    table = versions.read(spark, f"{out}/fin_procurement")
    assert [r["item"] for r in table.collect()] == ["A"]
    file.write_text("a,b\n1,2\n")
    assert load() == "FAILED" and versions.read(spark, f"{out}/fin_procurement").count() == 1


def test_an_extract_is_read_once(spark, tmp_path, monkeypatch):
    from freightloom.sources import bronze
    (tmp_path / "fin_procurement.csv").write_text("item,cost_per_unit_eur,reusable,description\nA,1,yes,x\n")
    plans, stage = [], bronze.versions.stage
    monkeypatch.setattr(bronze.versions, "stage", lambda df, out: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or stage(df, out))
    bronze.load_table(spark, str(tmp_path / "fin_procurement.csv"), str(tmp_path / "out"), "fin_procurement")
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1


# -- quoted line breaks -----------------------------------------------------------------------

NAMES = ["a", "b", "c"]


@pytest.fixture
def small_ranges(spark):
    """Byte ranges far shorter than a record."""
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def awkward(rng):
    word = lambda: rng.choice(["x", "", " y ", "é", "long word", "1,2"])
    inside = lambda: "".join(rng.choice(["\n", '""', ",", "z", "\r\n", "\n\n", "text "]) for _ in range(rng.randrange(12)))
    fields = [f'"{inside()}"' if rng.random() < .5 else word().replace(",", ";") for _ in range(rng.choice([3, 3, 3, 2, 4]))]
    return ",".join(fields)


@pytest.mark.parametrize("size", [7, 40, 1000])
def test_ranges_give_the_rows_of_the_multi_line_reader(spark, tmp_path, small_ranges, size):
    for n, end in enumerate(["\n", "", "\r\n"]):
        rng = random.Random(100 * size + n)
        rows = [r for r in (awkward(rng) for _ in range(40)) if r]
        line = "\r\n" if end == "\r\n" else "\n"
        (tmp_path / f"f{n}.csv").write_bytes((line.join([",".join(NAMES), *rows]) + end).encode())
    whole = spark.read.schema("a string, b string, c string").options(
        header=True, multiLine=True, escape='"', enforceSchema=False).csv(str(tmp_path))
    expected = sorted((tuple(r) for r in whole.withColumn("f", F.input_file_name()).collect()), key=str)
    small_ranges(size)
    got = read_quoted_csv(spark, str(tmp_path), NAMES)
    if size < 1000:
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 8
    rows = got.withColumn("f", F.col("_src_file")).drop("_src_file").collect()
    strip = lambda r: (*r[:3], r[-1].rsplit("/", 1)[1])
    assert sorted(map(strip, (tuple(r) for r in rows)), key=str) == sorted(map(strip, expected), key=str)
    # _ord follows the file
    first = [tuple(r)[:3] for r in sorted((r for r in rows if r["f"].endswith("f0.csv")), key=lambda r: r["_ord"])]
    assert first == [tuple(r)[:3] for r in whole.where(F.input_file_name().endswith("f0.csv")).collect()]


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    text = "\n".join(f"line {i}, and ""more" for i in range(200))
    (tmp_path / "f.csv").write_text(f'a,b,c\n1,"{text}",2\n"3","4\n5",6\n')
    small_ranges(20)
    rows = [tuple(r)[:3] for r in read_quoted_csv(spark, str(tmp_path), NAMES).orderBy("_ord").collect()]
    assert rows == [("1", text, "2"), ("3", "4\n5", "6")]
    assert quoted_records(spark, str(tmp_path)).count() == 3


def test_errors_of_split_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n1,"open,2\n3,4,5\n')
    with pytest.raises(Exception, match="quote without an end"):
        read_quoted_csv(spark, str(tmp_path), NAMES).collect()
    (tmp_path / "f.csv").write_text("a,b,d\n1,2,3\n")
    with pytest.raises(Exception, match="other column names"):
        read_quoted_csv(spark, str(tmp_path), NAMES).collect()
    (tmp_path / "f.csv").write_text("A,b,C\n")
    assert read_quoted_csv(spark, str(tmp_path), NAMES).count() == 0


def test_split_load_rejects_long_rows_and_pads_short_ones(spark, tmp_path):
    path = tmp_path / "fin_procurement.csv"
    path.write_text('item,cost_per_unit_eur,reusable,description\nA,1,yes,"x\ny"\nB\n')
    df = read_bronze_csv(spark, str(path), "fin_procurement", split=True)
    assert sorted(map(tuple, df.collect())) == [("A", "1", "yes", "x\ny"), ("B", None, None, None)]
    path.write_text('item,cost_per_unit_eur,reusable,description\nA,1,yes,"x\ny"\nB,1,yes,"z\n",4\n')
    status = {r.table_name: (r.status, r.bad_records) for r in load_all(
        spark, str(tmp_path), str(tmp_path / "out"), split=True).collect()}
    assert status["fin_procurement"] == ("REJECTED", 1)
