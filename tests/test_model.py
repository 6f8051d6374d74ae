from datetime import date

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from conftest import rows
from millrace.models import logistic
from millrace.models.registry import Registry, current_stages, latest_run, latest_runs

DAY = date(2024, 8, 30)
SCHEMA = "customer_number int, feature1 double, feature2 double, feature3 double, feature4 string, target int"


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(1)
    data = []
    for i in range(400):
        f = rng.normal(size=3)
        level = ["Low", "Medium", "High"][rng.integers(3)]
        p = 1 / (1 + np.exp(-(0.5 + f[0] - 0.7 * f[1] + (level == "High"))))
        data.append((i, *map(float, f), level, int(rng.random() < p)))
    return data


@pytest.fixture(scope="module")
def model(spark, training):
    return logistic.fit(spark.createDataFrame(training, SCHEMA), {"tol": 1e-9, "max_iter": 300})


def minimum(training, c=1.0):
    """Newton steps on 0.5 |w|^2 + c * sum(log loss), intercept not penalised."""
    levels = ["High", "Low", "Medium"]
    x = np.array([[1.0, *[float(r[4] == v) for v in levels], *r[1:4]] for r in training])
    y = np.array([r[5] for r in training])
    w, penalty = np.zeros(x.shape[1]), np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(penalty + c * (x.T * (p * (1 - p))) @ x, penalty @ w + c * x.T @ (p - y))
    return w, 1 / (1 + np.exp(-x @ w))


def test_fit_minimises_the_penalised_loss(model, training):
    fitted, n = model
    weights = logistic.coefficients(fitted)
    assert n == len(training)
    assert [name for name, _ in weights] == [
        "intercept", "feature4=High", "feature4=Low", "feature4=Medium", "feature1", "feature2", "feature3",
    ]
    assert [w for _, w in weights] == pytest.approx(minimum(training)[0], abs=2e-4)


def test_predictions(spark, model, training):
    fitted, _ = model
    _, probability = minimum(training)
    out = logistic.predict(fitted, spark.createDataFrame(training, SCHEMA), DAY).orderBy("customer_number")
    assert out.columns == ["customer_number", "prediction", "probability", "prediction_date"]
    got = out.collect()
    assert [r["probability"] for r in got] == pytest.approx(probability, abs=1e-4)
    assert all(r["prediction"] == int(r["probability"] > 0.5) and r["prediction_date"] == DAY for r in got)


def test_every_row_is_scored_and_incomplete_ones_get_no_guess(spark, model):
    fitted, _ = model
    data = [
        (1, 0.1, 0.2, 0.3, "Low", 1),
        (2, None, 0.2, 0.3, "Low", 1),
        (3, 0.1, float("nan"), 0.3, "Low", 1),
        (4, 0.1, 0.2, 0.3, "never seen", 1),
        (5, 0.1, 0.2, 0.3, None, 1),
    ]
    out = logistic.predict(fitted, spark.createDataFrame(data, SCHEMA), DAY).orderBy("customer_number").collect()
    assert [r["prediction"] is None for r in out] == [False, True, True, False, False]
    assert out[3]["probability"] == out[4]["probability"]


def test_one_hot_of_unseen_and_null_is_zero(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("c",)], "feature4 string")
    df = spark.createDataFrame([("a",), ("c",), ("x",), (None,)], "feature4 string")
    out = logistic.one_hot(seen, df).select("feature4", vector_to_array("feature4_hot").alias("hot"))
    assert {r[0]: r[1] for r in out.collect()} == {
        "a": [1, 0, 0], "c": [0, 0, 1], "x": [0, 0, 0], None: [0, 0, 0],
    }


def test_fit_needs_rows_and_supported_parameters(spark, training):
    df = spark.createDataFrame(training, SCHEMA)
    with pytest.raises(ValueError):
        logistic.fit(df.limit(0))
    with pytest.raises(ValueError):
        logistic.fit(df, {"penalty": "l1"})


def test_registry(spark, model, training, tmp_path):
    fitted, _ = model
    df = spark.createDataFrame(training, SCHEMA)
    registry = Registry(spark, str(tmp_path / "registry"))
    assert registry.find("m") is None
    with pytest.raises(LookupError):
        registry.load("m")
    parameters = {"param1": 0.1, "param2": 0.2}
    assert registry.register(fitted, df, "m", parameters=parameters, user="ann", stage="Staging", as_of=DAY) == 1
    assert registry.register(fitted, df, "m", parameters=parameters, user="ann", stage="Staging", as_of=DAY) == 2
    assert registry.register(fitted, df, "other", stage="Production", as_of=DAY) == 1
    assert rows(registry.stages(), "model", "version", "stage") == [
        ("m", 1, "Archived"), ("m", 2, "Staging"), ("other", 1, "Production"),
    ]
    assert registry.find("m") is None and registry.find("m", "Staging")[0] == 2
    registry.transition("m", 1, "Production", "bob", DAY)
    described = {(r["model"], r["version"]): r for r in registry.stages().collect()}
    assert described["m", 1]["description"] == "Version 1 was moved to Production on 2024-08-30 by bob"
    stored = registry.versions().where("model = 'm' AND version = 2").first()
    assert '"param1": 0.1' in stored["parameters"] and "feature1" in stored["signature"]
    assert latest_run(registry.versions().where("model = 'm'")).first()["version"] == 2
    expected = rows(logistic.predict(fitted, df, DAY))
    assert rows(logistic.predict(registry.load("m"), df, DAY)) == expected


def test_missing_model_is_trained_first(spark, model, training, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))
    df = spark.createDataFrame(training, SCHEMA)
    trained = []

    def train():
        trained.append(registry.register(model[0], df, "m"))

    registry.load("m", train=train)
    registry.load("m", train=train)
    assert trained == [1]


def test_stage_history(spark):
    events = [
        ("m", 1, "Production", 1), ("m", 2, "Production", 2), ("m", 2, "Staging", 3),
        ("m", 3, "None", 4), ("m", 4, "None", 5), ("n", 1, "Production", 1),
    ]
    df = spark.createDataFrame(events, "model string, version int, stage string, seq bigint")
    # Version 1 was archived by version 2 and does not come back when that moves on.
    assert rows(current_stages(df)) == [
        ("m", 1, "Archived"), ("m", 2, "Staging"), ("m", 3, "None"), ("m", 4, "None"), ("n", 1, "Production"),
    ]


def test_newest_run_is_by_end_time(spark):
    runs = spark.createDataFrame(
        [("e", 1, date(2024, 1, 3)), ("e", 2, date(2024, 1, 5)), ("e", 3, date(2024, 1, 4)), ("f", 9, date(2024, 1, 1))],
        "experiment string, version int, end_time date",
    )
    assert latest_run(runs).first()["version"] == 2
    assert rows(latest_runs(runs, ["experiment"]), "experiment", "version") == [("e", 2), ("f", 9)]
