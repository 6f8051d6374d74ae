import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import evaluation as ev

AS_OF = date(2024, 8, 30)
LABELS = "date date, customer_number int, target bigint"
PREDICTIONS = "prediction_date date, customer_number int, prediction bigint"


def day(d):
    return date(2024, 8, d)


@pytest.mark.parametrize(
    "predictions, labels, score, retrain",
    [
        ([(day(28), 1, 0), (day(29), 1, 0)], [(day(28), 1, 1), (day(29), 1, 1)], 0.0, True),
        ([(day(28), 1, 1), (day(29), 1, 0)], [(day(28), 1, 1), (day(29), 1, 0)], 1.0, False),
    ],
)
@pytest.mark.parametrize("keys", [["date"], ["date", "customer_number"]])
def test_retrain_decision(spark, predictions, labels, score, retrain, keys):
    p = ev.recent_predictions(spark.createDataFrame(predictions, PREDICTIONS), AS_OF)
    t = ev.evaluation_window(spark.createDataFrame(labels, LABELS), AS_OF, label_delay=1)
    for counts in (ev.confusion(ev.evaluation_pairs(t, p, keys)), ev.confusion_by_key(t, p, keys)):
        assert rows(ev.retrain_decision(ev.with_f1(counts))) == [(score, retrain)]


def test_counting_per_key_equals_counting_pairs(spark):
    rng = random.Random(5)
    # One date holds a third of the rows, some labels and predictions are NULL.
    dates = [day(1)] * 40 + [day(rng.randint(2, 9)) for _ in range(80)]
    labels = [(d, rng.randint(1, 4), rng.choice([0, 1, 1, None])) for d in dates]
    predictions = [(d, rng.randint(1, 4), rng.choice([0, 0, 1, None])) for d in dates]
    t = spark.createDataFrame(labels, LABELS)
    p = spark.createDataFrame(predictions, PREDICTIONS).withColumnRenamed("prediction_date", "date")
    for keys in (["date"], ["date", "customer_number"]):
        plain = rows(ev.confusion(ev.evaluation_pairs(t, p, keys)))
        counted = rows(ev.confusion_by_key(t, p, keys))
        assert [tuple(map(int, r)) for r in counted] == plain


def test_no_rows_have_no_score(spark):
    t = spark.createDataFrame([], LABELS)
    p = spark.createDataFrame([], PREDICTIONS).withColumnRenamed("prediction_date", "date")
    assert rows(ev.retrain_decision(ev.with_f1(ev.confusion_by_key(t, p)))) == [(None, False)]


def test_windows(spark):
    p = spark.createDataFrame(
        [(date(2024, 7, 28), 1, 1), (date(2024, 7, 29), 1, 1), (AS_OF, 1, 1)], PREDICTIONS
    )
    assert rows(ev.recent_predictions(p, AS_OF), "date") == [(date(2024, 7, 29),), (AS_OF,)]
    t = p.select(F.col("prediction_date").alias("date"), "customer_number", F.lit(1).alias("target"))
    assert rows(ev.evaluation_window(t, AS_OF, label_delay=1), "date") == [(date(2024, 7, 29),)]
    assert rows(ev.evaluation_window(t, AS_OF), "date") == [(date(2024, 7, 29),), (AS_OF,)]


def test_threshold_is_exclusive(spark):
    df = spark.createDataFrame([(0.6,), (0.59,)], "f1 double")
    assert rows(ev.retrain_decision(df)) == [(0.59, True), (0.6, False)]
