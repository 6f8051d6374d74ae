from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import features
from millrace.operators.latest import DELETED, first_per_group, latest_by_key

CHANGES = [
    (1, 10, 1, "a"),
    (1, 12, 1, None),
    (1, 11, 9, "late"),
    (2, 5, 1, "x"),
    (2, 5, 2, "tie winner"),
    (3, 1, 1, "gone"),
    (3, 2, 1, "delete"),
]
SCHEMA = "k int, s int, tie int, v string"


def test_newest_row_wins_and_keeps_its_null(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    assert rows(latest_by_key(df, ["k"], ["s", "tie"])) == [
        (1, 12, 1, None),
        (2, 5, 2, "tie winner"),
        (3, 2, 1, "delete"),
    ]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_row_order_and_partitioning_do_not_matter(spark, parts):
    expected = rows(latest_by_key(spark.createDataFrame(CHANGES, SCHEMA), ["k"], ["s"]))
    shuffled = spark.createDataFrame(CHANGES[::-1], SCHEMA).repartition(parts)
    assert rows(latest_by_key(shuffled, ["k"], ["s"])) == expected


def test_deletes_and_tombstones(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    kept = latest_by_key(df, ["k"], ["s", "tie"], delete_when="v = 'delete'", drop=["tie"])
    assert kept.columns == ["k", "s", "v"]
    assert rows(kept, "k") == [(1,), (2,)]
    marked = latest_by_key(df, ["k"], ["s", "tie"], delete_when="v = 'delete'", keep_deleted=True)
    assert rows(marked, "k", DELETED) == [(1, False), (2, False), (3, True)]


def test_key_of_several_columns_that_include_the_order(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    assert latest_by_key(df, ["k", "s"], ["s", "tie"]).count() == 6


def test_first_per_group(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    out = first_per_group(df, ["k"], [F.desc("s"), F.desc("tie")])
    assert rows(out) == rows(latest_by_key(df, ["k"], ["s", "tie"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # before and after the shuffle


ACTIVITY = "customer_number string, feature1 int, feature2 int, feature3 int, feature4 int, target int"
CASES = [
    (
        [("ann", 7, -3, -20, 2, 0), ("bob", 0, 0, 4, 9, 1), ("ann", None, 8, 11, 6, 1), ("bob", -5, None, 4, 1, 0)],
        [("ann", 7, 8, -9, 6, 1), ("bob", -5, 0, 8, 1, 0)],
    ),
    (
        [("cy", 3, 3, None, 5, 0), ("cy", 3, 9, -7, 5, 1), ("dee", None, 2, 1, 8, 1)],
        [("cy", 3, 9, -7, 5, 1), ("dee", None, 2, 1, 8, 1)],
    ),
]


def _dated(spark, given):
    dated = [(*r, date(2024, 8, 1 + i)) for i, r in enumerate(given)]
    return spark.createDataFrame(dated, ACTIVITY + ", date date")


@pytest.mark.parametrize("given, expected", CASES)
def test_training_features(spark, given, expected):
    out = features.training_features(_dated(spark, given), date(2024, 8, 30))
    assert out.columns == [c.split()[0] for c in ACTIVITY.split(", ")]
    assert rows(out) == expected


@pytest.mark.parametrize("given, expected", CASES)
def test_online_features(spark, given, expected):
    out = features.online_features(_dated(spark, given))
    assert rows(out) == [r[:5] for r in expected]


def test_training_horizon(spark):
    df = _dated(spark, CASES[0][0])
    assert features.training_features(df, date(2026, 8, 2)).count() == 2  # 730 days reach 2024-08-02
    assert features.training_features(df, date(2026, 8, 6)).count() == 0


def test_sum_with_known_decimals_is_exact(spark):
    given = [("a", 1, 1, v, "x", date(2024, 1, 1 + i)) for i, v in enumerate([0.1, 0.2, 0.3, -0.6])]
    df = spark.createDataFrame(
        given, "customer_number string, feature1 int, feature2 int, feature3 double, feature4 string, date date"
    )
    assert rows(features.online_features(df, sum_digits=2), "feature3") == [(0.0,)]


def test_training_rows(spark):
    given = [("eve", 30, -1, 12, 7, "2023-02-27", 1)]
    schema = "customer_number string, feature1 int, feature2 int, feature3 int, feature4 int, date string, target int"
    df = spark.createDataFrame(given * 2 + [("eve", 31, 0, 13, 7, "2023-02-28", 0)], schema)
    assert rows(features.training_rows(df)) == [
        ("eve", 30, -1, 12, 7, "2023-02-27", 1),
        ("eve", 31, 0, 13, 7, "2023-02-28", 0),
    ]
    assert features.training_rows(df.limit(0)).isEmpty()
