from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from millrace.schema import ACTIVITY, RESCUED
from millrace.sinks.predictions import append_rows
from millrace.sources import exists, scan
from millrace.sources.generate import activity_for, generate
from millrace.sources.rescue import conform

DAY = date(2024, 8, 30)
TWO = [(71, 0.5, -4.0, 9.25, "High", DAY, 1), (72, 6.0, 2.5, 0.0, "Low", DAY, 0)]


def test_generated_batch_has_the_schema_and_distributions(spark):
    df = generate(spark, DAY, 20_000).cache()
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ACTIVITY]
    s = df.agg(
        F.count("*").alias("n"),
        F.min("customer_number").alias("lo"),
        F.max("customer_number").alias("hi"),
        F.mean("feature1").alias("m1"),
        F.max("feature1").alias("x1"),
        F.mean("feature2").alias("m2"),
        F.mean("feature3").alias("m3"),
        F.stddev("feature3").alias("s3"),
        F.mean("target").alias("t"),
        F.mean((F.col("feature4") == "Unknown").cast("int")).alias("u"),
        F.mean((F.round("feature1", 2) == F.col("feature1")).cast("int")).alias("two_decimals"),
    ).first()
    assert s["n"] == 20_000 and s["lo"] == 1 and s["hi"] == 99 and s["x1"] <= 75
    assert s["m1"] == pytest.approx(37.5, abs=0.6)
    assert s["m2"] == pytest.approx(15, abs=0.3)
    assert s["m3"] == pytest.approx(3, abs=0.15) and s["s3"] == pytest.approx(5, abs=0.12)
    assert s["t"] == pytest.approx(0.6, abs=0.015) and s["u"] == pytest.approx(0.01, abs=0.004)
    assert s["two_decimals"] == 1.0
    assert df.select("feature4").distinct().count() == 4


def test_generation_does_not_depend_on_partitioning(spark):
    ids = spark.range(500)
    one = activity_for(ids.repartition(3), "id", DAY)
    other = activity_for(ids.repartition(7), "id", DAY)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert not generate(spark, DAY, 50).exceptAll(generate(spark, date(2024, 8, 31), 50)).isEmpty()


@pytest.mark.parametrize("had_data, size", [(False, 37), (True, 64)])
def test_appending_a_batch_keeps_earlier_rows(spark, tmp_path, had_data, size):
    path = str(tmp_path / "raw")
    if had_data:
        append_rows(spark.createDataFrame(TWO, ACTIVITY), path)
    append_rows(generate(spark, DAY, size), path)
    assert scan.scan(spark, path).count() == size + (2 if had_data else 0)


def test_data_exists(spark, tmp_path):
    full, empty = tmp_path / "full", tmp_path / "empty"
    full.mkdir(), empty.mkdir()
    for name in "abc":
        (full / name).write_text(name)
    assert exists.data_exists(spark, str(full))
    assert not exists.data_exists(spark, str(empty))
    assert not exists.data_exists(spark, str(tmp_path / "missing"))
    with pytest.raises(Exception):
        exists.data_exists(spark, "nosuchscheme://host/path")


def test_named_tables(spark, schema_name):
    assert not exists.table_exists(spark, f"{schema_name}.t")
    with pytest.raises(AnalysisException):
        scan.table(spark, f"{schema_name}.t")
    spark.sql(f"CREATE DATABASE {schema_name}")
    spark.range(3).write.saveAsTable(f"{schema_name}.t")
    assert exists.table_exists(spark, f"{schema_name}.t")
    assert scan.table(spark, f"{schema_name}.t").count() == 3


def test_windows_are_half_open(spark):
    df = spark.createDataFrame(
        [("2023-05-04", 1), ("2023-05-11", 2), ("2023-05-18", 3), ("2023-05-25", 4)], "Date string, feature1 int"
    ).withColumn("Date", F.to_date("Date"))
    begin, mid = date(2023, 5, 4), date(2023, 5, 18)
    assert rows(scan.between(df, begin, mid), "feature1") == [(1,), (2,)]
    assert rows(scan.between(df, mid, None), "feature1") == [(3,), (4,)]
    assert rows(scan.between(df, begin, date(2023, 5, 11)), "feature1") == [(1,)]
    assert rows(scan.since(df, date(2023, 5, 25), 14), "feature1") == [(2,), (3,), (4,)]


def test_date_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(TWO, ACTIVITY).write.parquet(path)
    plan = scan.since(scan.scan(spark, path), DAY, 30)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-07-31)" in plan


def test_conform_keeps_misfits_as_text(spark):
    raw = spark.createDataFrame(
        [
            ("1", 1.5, "x", "2024-01-01", 7),
            ("u2", 2.5, "y", "2024-01-02", None),
            ("3", None, None, "soon", None),
            (None, 4.5, "z", "2024-01-04", None),
        ],
        "customer_number string, feature1 double, feature4 string, date string, extra int",
    )
    df = conform(raw, ACTIVITY)
    assert df.columns == [*ACTIVITY.names, RESCUED]
    assert rows(df, "customer_number", "date", "feature2", RESCUED) == [
        (1, date(2024, 1, 1), None, '{"extra":7}'),
        (3, None, None, '{"date":"soon"}'),
        (None, date(2024, 1, 2), None, '{"customer_number":"u2"}'),
        (None, date(2024, 1, 4), None, None),
    ]


def test_conform_of_fitting_rows_changes_nothing(spark):
    df = spark.createDataFrame(TWO, ACTIVITY)
    out = conform(df, ACTIVITY)
    assert rows(out.drop(RESCUED)) == rows(df)
    assert out.where(f"{RESCUED} IS NOT NULL").isEmpty()


CASES = [
    # type of the source, declared type, value, what fits of it, whether it is rescued
    ("double", "int", "10.7", None, True), ("double", "int", "10.0", 10, False), ("double", "int", "1e12", None, True),
    ("double", "bigint", "double('NaN')", None, True), ("decimal(10,2)", "int", "3.50", None, True), ("decimal(10,2)", "int", "3.00", 3, False),
    ("bigint", "double", "9007199254740993", None, True), ("bigint", "double", "9007199254740992", 9007199254740992.0, False),
    ("double", "float", "0.1", None, True), ("double", "float", "0.5", 0.5, False), ("int", "string", "7", "7", False),
    ("timestamp", "date", "timestamp'2024-03-01 12:30:00'", None, True), ("timestamp", "date", "timestamp'2024-03-01 00:00:00'", DAY.replace(month=3, day=1), False),
    ("string", "date", "'2024-03-01 12:30:00'", None, True), ("string", "date", "'2024-03-01'", DAY.replace(month=3, day=1), False),
    ("string", "int", "'10.7'", None, True), ("string", "int", "'10'", 10, False), ("string", "int", "'x'", None, True),
    ("string", "double", "'0.1'", 0.1, False), ("string", "decimal(6,2)", "'1.239'", None, True), ("int", "boolean", "5", None, True),
    ("double", "int", "null", None, False), ("string", "int", "null", None, False),
]


def test_only_what_casts_without_loss_fits(spark):
    for source, declared, value, want, misfit in CASES:
        row = conform(spark.sql(f"SELECT CAST({value} AS {source}) AS v"), T._parse_datatype_string(f"v {declared}")).first()
        assert (row["v"], row[RESCUED] is not None) == (want, misfit), (source, declared, value)


def test_rescue_looks_into_structs_and_arrays(spark):
    df = spark.sql("""
        SELECT 1 AS id, named_struct('a', 1.5D, 'b', 'x') AS s, array(1D, 2.5D) AS l UNION ALL
        SELECT 2, named_struct('a', 2D, 'b', 'y'), array(3D) UNION ALL
        SELECT 3, CAST(NULL AS STRUCT<a: DOUBLE, b: STRING>), CAST(NULL AS ARRAY<DOUBLE>)""")
    got = rows(conform(df, T._parse_datatype_string("id int, s struct<a: int, b: string>, l array<int>")))
    assert got == [
        (1, (None, "x"), [1, None], '{"s":{"a":1.5,"b":"x"},"l":[1.0,2.5]}'), (2, (2, "y"), [3], None), (3, None, None, None),
    ]
    more = conform(df.select("id", "s"), T._parse_datatype_string("id int, s struct<B: string, c: int>"))
    assert [(r["s"], r[RESCUED] is not None) for r in more.orderBy("id").collect()] == [(("x", None), True), (("y", None), True), (None, False)]
