from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.schema import PREDICTION_DATE
from millrace.sinks import feature_tables as ft
from millrace.sinks import predictions, publish, snapshots
from millrace.sources.exists import child_names

SCHEMA = "date date, customer_number int, feature1 double"


def d(n):
    return date(2024, 1, n)


@pytest.fixture
def table(spark, schema_name, tmp_path):
    ft.ensure_schema(spark, schema_name, str(tmp_path))
    return f"{schema_name}.training"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_create_then_replace(spark, table):
    keys, parts = ["date", "customer_number"], ["date"]
    ft.update_table(frame(spark, (d(1), 1, 1.0)), table, keys, parts, "it's a table")
    assert rows(spark.table(table)) == [(d(1), 1, 1.0)]
    ft.update_table(frame(spark, (d(1), 1, 2.0), (d(2), 1, 3.0)), table, keys, parts)
    assert rows(spark.sql(f"SELECT * FROM {table} WHERE Date >= DATE'2024-01-02'")) == [(d(2), 1, 3.0)]
    known = ft.properties(spark, table)
    assert known["keys"] == "date,customer_number" and known["partition_columns"] == "date"
    assert known["description"] == "it's a table"


def test_a_table_can_be_replaced_from_itself(spark, table):
    ft.update_table(frame(spark, (d(1), 1, 1.0)), table, ["customer_number"])
    for _ in range(3):
        changed = spark.table(table).withColumn("feature1", F.col("feature1") + 1)
        ft.update_table(changed, table, ["customer_number"])
    assert rows(spark.table(table)) == [(d(1), 1, 4.0)]
    schema = table.split(".")[0]
    assert len([t for t in spark.catalog.listTables(schema) if "__" in t.name]) == 2


def test_a_reader_keeps_the_rows_it_started_with(spark, table):
    ft.update_table(frame(spark, (d(1), 1, 1.0)), table, ["customer_number"])
    before = spark.table(table)
    ft.update_table(frame(spark, (d(1), 2, 2.0)), table, ["customer_number"])
    assert rows(before) == [(d(1), 1, 1.0)] and rows(spark.table(table)) == [(d(1), 2, 2.0)]


def test_only_the_partitions_in_the_data_are_refreshed(spark, table):
    keys, parts = ["date", "customer_number"], ["date"]
    ft.update_table(frame(spark, (d(1), 1, 1.0), (d(2), 1, 1.0), (d(2), 2, 1.0)), table, keys, parts)
    for check in (True, False):
        ft.update_table(
            frame(spark, (d(2), 1, 9.0), (d(3), 1, 9.0)), table, keys, parts, mode="partitions", check=check
        )
        assert rows(spark.table(table)) == [(d(1), 1, 1.0), (d(2), 1, 9.0), (d(3), 1, 9.0)]


@pytest.mark.parametrize("bad", [[(d(1), 1, 1.0), (d(1), 1, 2.0)], [(d(1), None, 1.0)]])
def test_broken_keys_leave_the_table_as_it_was(spark, table, bad):
    keys = ["date", "customer_number"]
    with pytest.raises(ft.KeyViolation):
        ft.update_table(frame(spark, *bad), table, keys)
    ft.update_table(frame(spark, (d(1), 1, 1.0)), table, keys)
    with pytest.raises(ft.KeyViolation):
        ft.update_table(frame(spark, *bad), table, keys)
    assert rows(spark.table(table)) == [(d(1), 1, 1.0)]


def test_unknown_columns_and_modes(spark, table):
    with pytest.raises(ValueError):
        ft.update_table(frame(spark, (d(1), 1, 1.0)), table, ["customer_number"], ["week"])
    with pytest.raises(ValueError):
        ft.update_table(frame(spark, (d(1), 1, 1.0)), table, ["customer_number"], mode="append")


def test_publish_is_called_with_the_stored_table(spark, table, tmp_path):
    store = str(tmp_path / "store")
    for value in (1.0, 2.0, 3.0):
        df = frame(spark, (d(1), 1, value))
        ft.update_table(df, table, ["customer_number"], publish=lambda t: publish.publish_snapshot(t, store))
    assert rows(publish.read_published(spark, store, df.schema)) == [(d(1), 1, 3.0)]
    assert child_names(spark, store) == ["_snapshot=2", "_snapshot=3"]


def test_jdbc_options(spark, monkeypatch):
    calls = {}

    class Writer:
        def mode(self, m):
            calls["mode"] = m
            return self

        def option(self, k, v):
            calls[k] = v
            return self

        def options(self, **kw):
            calls.update(kw)
            return self

        def jdbc(self, url, table):
            calls.update(url=url, table=table)

    class Frame:
        write = Writer()

    publish.publish_jdbc(Frame(), "jdbc:x", "online_features", {"user": "u"})
    assert calls == {
        "mode": "overwrite", "truncate": "true", "numPartitions": 16, "user": "u",
        "url": "jdbc:x", "table": "online_features",
    }


def test_predictions_of_a_day_are_replaced_by_a_rerun(spark, tmp_path):
    path = str(tmp_path / "predictions")
    schema = "customer_number int, prediction int, probability double, prediction_date date"
    predictions.write_predictions(spark.createDataFrame([(1, 0, 0.1, d(1)), (2, 1, 0.9, d(1))], schema), path)
    predictions.write_predictions(spark.createDataFrame([(1, 1, 0.8, d(2))], schema), path)
    predictions.write_predictions(spark.createDataFrame([(1, 1, 0.7, d(1)), (2, 1, 0.9, d(1))], schema), path)
    found = predictions.read_predictions(spark, path)
    assert rows(found, "customer_number", "prediction", PREDICTION_DATE) == [(1, 1, d(1)), (1, 1, d(2)), (2, 1, d(1))]


CHANGE = "k int, day date, seq int, v string"


def merge(spark, root, version, *data, by=("day",), **options):
    snapshots.merge_changes(
        spark.createDataFrame(list(data), CHANGE), root, version, ["k", "day"], ["seq"], list(by), **options
    )


def current(spark, root, by=("day",)):
    schema = spark.createDataFrame([], CHANGE).schema
    return rows(snapshots.read_snapshot(spark, root, schema, list(by)))


@pytest.mark.parametrize("by", [("day",), (), (snapshots.bucket_column(5),)])
def test_merges_keep_the_newest_row(spark, tmp_path, by):
    root = str(tmp_path / "t")
    assert current(spark, root, by) == []
    merge(spark, root, 1, (1, d(1), 5, "a"), (2, d(1), 5, "b"), (1, d(2), 5, "c"), by=by)
    merge(spark, root, 2, (1, d(1), 4, "late"), (2, d(1), 6, "newer"), (3, d(3), 1, "added"), by=by)
    expected = [(1, d(1), 5, "a"), (1, d(2), 5, "c"), (2, d(1), 6, "newer"), (3, d(3), 1, "added")]
    assert current(spark, root, by) == expected


def test_a_merge_rewrites_only_touched_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    merge(spark, root, 1, (1, d(1), 1, "a"), (1, d(2), 1, "b"))
    merge(spark, root, 2, (2, d(2), 1, "c"))
    assert [n for n in child_names(spark, f"{root}/_snapshot=2") if "=" in n] == ["day=2024-01-02"]


def test_repeating_a_merge_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    merge(spark, root, 1, (1, d(1), 1, "a"))
    for _ in range(2):
        merge(spark, root, 2, (1, d(1), 2, "b"), (2, d(1), 1, "c"))
        assert current(spark, root) == [(1, d(1), 2, "b"), (2, d(1), 1, "c")]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    merge(spark, root, 1, (1, d(1), 1, "a"))
    merge(spark, root, 2, (1, d(1), 2, "b"))
    (tmp_path / "t" / "_snapshot=2" / "_SUCCESS").unlink()
    assert current(spark, root) == [(1, d(1), 1, "a")]
    merge(spark, root, 2, (1, d(1), 3, "c"))
    assert current(spark, root) == [(1, d(1), 3, "c")]


def test_late_rows_after_a_delete_stay_out(spark, tmp_path):
    root = str(tmp_path / "t")
    gone = dict(delete_when="v = 'delete'")
    merge(spark, root, 1, (1, d(1), 1, "a"), (2, d(1), 1, "b"), **gone)
    merge(spark, root, 2, (1, d(1), 5, "delete"), **gone)
    merge(spark, root, 3, (1, d(1), 3, "late"), **gone)
    assert current(spark, root) == [(2, d(1), 1, "b")]
    merge(spark, root, 4, (1, d(1), 6, "back"), **gone)
    assert current(spark, root) == [(1, d(1), 6, "back"), (2, d(1), 1, "b")]


def test_expiry_keeps_versions_in_use(spark, tmp_path):
    root = str(tmp_path / "t")
    merge(spark, root, 1, (1, d(1), 1, "a"))
    for v in range(2, 6):
        merge(spark, root, v, (1, d(2), v, f"v{v}"))
    assert snapshots.expire(spark, root, ["day"], keep=2) == [2, 3]
    assert current(spark, root) == [(1, d(1), 1, "a"), (1, d(2), 5, "v5")]


def test_partitions_have_to_be_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, d(1), 1, "a")], CHANGE)
    for column in ("seq", "v"):
        with pytest.raises(ValueError):
            snapshots.merge_changes(df, str(tmp_path / "t"), 1, ["k", "v"], ["seq"], [column])


def files_of(spark, table, day):
    found = spark.table(table).where(F.col("day") == F.lit(day)).select(F.input_file_name()).distinct().collect()
    return {r[0] for r in found}


DAYS = "k int, day date, v string"


def days_table(spark, table, keys=("k", "day")):
    df = spark.createDataFrame([(k, d(n), f"{k}-{n}") for k in (1, 2, 3) for n in (1, 2, 3, 4)], DAYS)
    ft.update_table(df, table, list(keys), ["day"])


def test_a_merge_by_key_writes_only_the_days_it_touches(spark, table):
    days_table(spark, table)
    before = {n: files_of(spark, table, d(n)) for n in (1, 2, 3, 4)}
    ft.update_table(spark.createDataFrame([(2, d(3), "new"), (9, d(5), "more")], DAYS), table, ["k", "day"], ["day"], mode="merge")
    assert {n: files_of(spark, table, d(n)) == before[n] for n in before} == {1: True, 2: True, 3: False, 4: True}
    found = rows(spark.table(table))
    assert (2, d(3), "new") in found and (9, d(5), "more") in found and (1, d(3), "1-3") in found and len(found) == 13


def test_a_merge_moves_a_key_to_another_day(spark, table):
    df = spark.createDataFrame([(1, d(1), "a"), (2, d(2), "b"), (3, d(2), "c")], DAYS)
    ft.update_table(df, table, ["k"], ["day"])
    ft.update_table(spark.createDataFrame([(1, d(2), "moved")], DAYS), table, ["k"], ["day"], mode="merge")
    assert rows(spark.table(table)) == [(1, d(2), "moved"), (2, d(2), "b"), (3, d(2), "c")]


def test_a_refresh_that_fails_half_way_leaves_every_day(spark, table, monkeypatch):
    days_table(spark, table)
    before = rows(spark.table(table))
    new = spark.createDataFrame([(1, d(2), "x"), (1, d(3), "x")], DAYS)

    def broken(*args):
        raise OSError("no metadata")

    with monkeypatch.context() as m:
        m.setattr(ft, "_point", broken)
        with pytest.raises(OSError):
            ft.replace_partitions(new, table)
    assert rows(spark.table(table)) == before
    failing = new.withColumn("v", F.when(F.col("day") == F.lit(d(3)), F.raise_error(F.lit("bad row"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="bad row"):
        ft.replace_partitions(failing, table)
    assert rows(spark.table(table)) == before
    ft.replace_partitions(new, table)
    assert [r for r in rows(spark.table(table)) if r[1] in (d(2), d(3))] == [(1, d(2), "x"), (1, d(3), "x")]
    assert spark.table(table).count() == 8


def test_many_refreshes_fold_into_two_data_tables(spark, table, monkeypatch):
    monkeypatch.setattr(ft, "MOST_PARTS", 3)
    days_table(spark, table)
    expected = {(k, n): f"{k}-{n}" for k in (1, 2, 3) for n in (1, 2, 3, 4)}
    for i in range(7):
        n = 1 + i % 4
        ft.replace_partitions(spark.createDataFrame([(1, d(n), f"r{i}")], DAYS), table)
        expected = {key: v for key, v in expected.items() if key[1] != n} | {(1, n): f"r{i}"}
        if i == 3:
            ft.drop_vanished(spark, table, spark.table(table).where(F.col("day") != F.lit(d(4))), "day", d(3))
            expected = {key: v for key, v in expected.items() if key[1] != 4}
        assert rows(spark.table(table)) == sorted((k, d(n), v) for (k, n), v in expected.items())
        assert len(ft.properties(spark, table)["data"].split(",")) <= 3


def test_a_day_in_the_view_reads_only_its_files(spark, table):
    days_table(spark, table)
    ft.replace_partitions(spark.createDataFrame([(1, d(2), "x")], DAYS), table)
    one = spark.table(table).where(F.col("day") == F.lit(d(3)))
    assert "PartitionFilters" in one._jdf.queryExecution().executedPlan().toString()
    assert one.select(F.input_file_name()).distinct().count() == len(files_of(spark, table, d(3)))


def buckets_of(spark, root, version):
    return {n for n in child_names(spark, f"{root}/_snapshot={version}") if "=" in n}


def test_a_merge_of_few_keys_rewrites_few_buckets(spark, tmp_path):
    root, by = str(tmp_path / "t"), [snapshots.bucket_column(32)]
    every = [(k, d(1), 1, f"v{k}") for k in range(400)]
    snapshots.merge_changes(spark.createDataFrame(every, CHANGE), root, 1, ["k"], ["seq"], by)
    assert len(buckets_of(spark, root, 1)) == 32
    few = [(3, d(2), 2, "new"), (7, d(2), 0, "late"), (900, d(1), 1, "more")]
    snapshots.merge_changes(spark.createDataFrame(few, CHANGE), root, 2, ["k"], ["seq"], by)
    assert 1 <= len(buckets_of(spark, root, 2)) <= 3
    schema = spark.createDataFrame([], CHANGE).schema
    found = rows(snapshots.read_snapshot(spark, root, schema, by))
    assert found == sorted([r for r in every if r[0] != 3] + [few[0], few[2]], key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("first, then", [((), (snapshots.bucket_column(8),)), ((snapshots.bucket_column(8),), (snapshots.bucket_column(9),))])
def test_another_layout_is_refused(spark, tmp_path, first, then):
    root, df = str(tmp_path / "t"), spark.createDataFrame([(1, d(1), 1, "a")], CHANGE)
    snapshots.merge_changes(df, root, 1, ["k"], ["seq"], list(first))
    with pytest.raises(ValueError, match="is partitioned by"):
        snapshots.merge_changes(df, root, 2, ["k"], ["seq"], list(then))
