import random
from datetime import date

import pytest

from conftest import rows
from millrace.operators import quality
from millrace.operators.latest import latest_by_key
from millrace.schema import ACTIVITY_RULES, RESCUED
from millrace.sinks import snapshots
from millrace.sources import scan
from millrace.sources.rescue import conform
from millrace.streaming import flows

SCHEMA = "customer_number int, date date, seq int, feature1 double, _rescued_data string"


@pytest.fixture
def history(spark):
    rng = random.Random(3)
    data = [
        (
            None if rng.random() < 0.05 else rng.choice([7, 7, 7, rng.randint(1, 30)]),
            date(2024, 1, rng.randint(1, 6)),
            i,
            round(rng.random(), 2),
            "{}" if rng.random() < 0.05 else None,
        )
        for i in range(400)
    ]
    rng.shuffle(data)
    return data


def arrive(spark, data, path, files):
    for i in range(files):
        part = spark.createDataFrame(data[i::files], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)


def test_files_are_ingested_once_across_restarts(spark, tmp_path, history):
    raw, bronze, mark = (str(tmp_path / n) for n in ("raw", "bronze", "mark"))
    for part in (history[:150], history[150:]):
        arrive(spark, part, raw, 3)
        flows.append_files(scan.stream(spark, raw, files_per_batch=2), bronze, mark)
    flows.append_files(scan.stream(spark, raw), bronze, mark)
    assert rows(spark.read.parquet(bronze)) == rows(spark.createDataFrame(history, SCHEMA))


@pytest.mark.parametrize("size, batches", [(1, 4), (1 << 40, 1)])
def test_micro_batches_are_bounded_by_bytes(spark, tmp_path, history, size, batches):
    raw, bronze, mark, counts = (str(tmp_path / n) for n in ("raw", "bronze", "mark", "counts"))
    arrive(spark, history, raw, 4)
    flows.land_files(spark, raw, bronze, mark, lambda df: df, ACTIVITY_RULES, counts, bytes_per_batch=size)
    assert flows.last_batch(spark, bronze) == batches - 1
    assert rows(spark.read.parquet(f"{bronze}/{flows.BATCH}*").select(*history_columns())) == rows(spark.createDataFrame(history, SCHEMA).select(*history_columns()))


def history_columns():
    return [c.split()[0] for c in SCHEMA.split(", ")]


def test_stream_and_batch_give_the_same_checked_rows_and_counts(spark, tmp_path, history):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    arrive(spark, history, raw, 4)
    stream = scan.stream(spark, raw, files_per_batch=1)
    flows.append_files(quality.expect_or_drop(stream, ACTIVITY_RULES), out, str(tmp_path / "mark"))
    counts = str(tmp_path / "counts")
    flows.count_rules(stream, ACTIVITY_RULES, counts, str(tmp_path / "counted"))
    batch = spark.createDataFrame(history, SCHEMA)
    assert rows(spark.read.parquet(out)) == rows(quality.expect_or_drop(batch, ACTIVITY_RULES))
    assert rows(flows.stored_counts(spark, counts, ACTIVITY_RULES)) == rows(quality.rule_counts(batch, ACTIVITY_RULES))


def test_another_checkpoint_is_refused(spark, tmp_path, history):
    raw, out, silver = (str(tmp_path / n) for n in ("raw", "out", "silver"))
    arrive(spark, history, raw, 2)
    for mark in ("first", "second"):
        place = str(tmp_path / mark)
        writes = [
            lambda: flows.append_files(scan.stream(spark, raw), out, f"{place}/a"),
            lambda: flows.upsert_snapshot(
                quality.expect_or_drop(scan.stream(spark, raw), ACTIVITY_RULES),
                silver, f"{place}/b", ["customer_number"], ["date", "seq"], drop=[RESCUED],
            ),
        ]
        for write in writes:
            if mark == "first":
                write()
            else:
                with pytest.raises(ValueError, match="another checkpoint"):
                    write()


def test_an_order_within_the_keys_is_refused(spark, tmp_path, history):
    arrive(spark, history, str(tmp_path / "raw"), 1)
    stream = scan.stream(spark, str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="outside the keys"):
        flows.upsert_snapshot(stream, str(tmp_path / "s"), str(tmp_path / "m"), ["date", "customer_number"], ["date"])


@pytest.mark.parametrize(
    "keys, by", [(["customer_number"], []), (["date", "customer_number"], ["date"])]
)
@pytest.mark.parametrize("delete", [None, "feature1 < 0.2"])
def test_stream_upsert_equals_batch(spark, tmp_path, history, keys, by, delete):
    raw, silver, mark = (str(tmp_path / n) for n in ("raw", "silver", "mark"))
    order = ["date", "seq"]

    def run():
        checked = quality.expect_or_drop(scan.stream(spark, raw, files_per_batch=1), ACTIVITY_RULES)
        flows.upsert_snapshot(checked, silver, mark, keys, order, by, delete, drop=[RESCUED])

    # Two runs with a restart between them; rows arrive in random order.
    for part in (history[:180], history[180:]):
        arrive(spark, part, raw, 2)
        run()
    batch = quality.expect_or_drop(spark.createDataFrame(history, SCHEMA), ACTIVITY_RULES)
    expected = latest_by_key(batch, keys, order, delete, drop=[RESCUED])
    got = snapshots.read_snapshot(spark, silver, expected.schema, by)
    assert rows(got, *expected.columns) == rows(expected)


def test_a_failed_batch_is_repeated(spark, tmp_path, history, monkeypatch):
    raw, silver, mark = (str(tmp_path / n) for n in ("raw", "silver", "mark"))
    arrive(spark, history, raw, 2)
    stream = lambda: quality.expect_or_drop(scan.stream(spark, raw, files_per_batch=1), ACTIVITY_RULES)
    args = (silver, mark, ["customer_number"], ["date", "seq"])
    whole = snapshots.write_version
    calls = []

    def fail_after_writing(*a, **options):
        whole(*a, **options)
        calls.append(a[2])
        if len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(snapshots, "write_version", fail_after_writing)
    with pytest.raises(Exception):
        flows.upsert_snapshot(stream(), *args, drop=[RESCUED])
    flows.upsert_snapshot(stream(), *args, drop=[RESCUED])
    assert calls == [1, 2, 2]
    batch = quality.expect_or_drop(spark.createDataFrame(history, SCHEMA), ACTIVITY_RULES)
    expected = latest_by_key(batch, ["customer_number"], ["date", "seq"], drop=[RESCUED])
    assert rows(snapshots.read_snapshot(spark, silver, expected.schema), *expected.columns) == rows(expected)


def test_conform_on_a_stream(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    spark.createDataFrame([("1", "2.5"), ("x", "3.5")], "customer_number string, feature1 string").write.parquet(raw)
    declared = spark.createDataFrame([], "customer_number int, feature1 double").schema
    flows.append_files(conform(scan.stream(spark, raw), declared), out, str(tmp_path / "mark"))
    assert rows(spark.read.parquet(out)) == [(1, 2.5, None), (None, 3.5, '{"customer_number":"x"}')]
