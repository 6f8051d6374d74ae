from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.models.registry import Registry
from millrace.plans import jobs
from millrace.schema import ACTIVITY, RESCUED, Settings
from millrace.sinks import publish

AS_OF = date(2024, 8, 30)


@pytest.fixture(scope="module")
def installed(spark, tmp_path_factory):
    """Forty days of generated batches, through every stored layer."""
    settings = Settings(
        root=str(tmp_path_factory.mktemp("root")),
        layer_schema="jobs_layers",
        offline_schema="jobs_offline",
        online_schema="jobs_online",
        sum_digits=2,
    )
    for n in (40, 20, 9, 3, 1, 0):
        jobs.generate_activity(spark, settings, AS_OF - timedelta(days=n), 300)
        if n in (20, 0):
            jobs.run_medallion(spark, settings, files_per_batch=100)
    jobs.refresh_training_table(spark, settings)
    jobs.refresh_serving_table(spark, settings)
    jobs.refresh_online_features(spark, settings)
    return settings


def test_silver_holds_one_row_per_day_and_customer(spark, installed):
    raw, silver = spark.read.parquet(installed.raw), jobs.silver(spark, installed)
    assert raw.count() == 1800
    assert silver.count() == raw.select("date", "customer_number").distinct().count()
    assert silver.join(raw, silver.columns, "left_semi").count() == silver.count()
    assert rows(spark.table(installed.training)) == rows(silver.select(*spark.table(installed.training).columns))


def test_layers_have_names_and_properties(spark, installed):
    silver, bronze = spark.table(installed.silver_table), spark.table(installed.bronze_table)
    assert rows(silver) == rows(jobs.silver(spark, installed))
    assert bronze.count() == 1800 and bronze.columns[-1] == "_rescued_data"
    for name, quality in ((installed.silver_table, "silver"), (installed.bronze_table, "bronze")):
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        assert found["quality"] == quality
        assert quality in spark.catalog.getTable(name).description.lower()
    plan = silver.where(F.col("date") >= F.lit(AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "InMemoryFileIndex(1 paths)" in plan


def test_silver_keyed_by_customer(spark, tmp_path):
    settings = Settings(root=str(tmp_path), keys=["customer_number"], layer_schema="jobs_single")
    for n in (2, 1):
        jobs.generate_activity(spark, settings, AS_OF - timedelta(days=n), 200)
        jobs.run_medallion(spark, settings)
    silver = spark.table(settings.silver_table)
    assert silver.count() == spark.read.parquet(settings.raw).select("customer_number").distinct().count()
    assert rows(silver) == rows(jobs.silver(spark, settings))


def test_online_features_are_published(spark, installed):
    stored = spark.table(installed.online_serving)
    assert rows(publish.read_published(spark, installed.online_store, stored.schema)) == rows(stored)
    expected = spark.table(installed.offline_serving).groupBy("customer_number").agg(
        F.min("feature1"), F.max("feature2"), F.round(F.sum("feature3"), 2),
    )
    assert rows(stored.select("customer_number", "feature1", "feature2", F.round("feature3", 2))) == rows(expected)


def test_refresh_of_new_days_only(spark, installed):
    before = rows(spark.table(installed.training))
    assert jobs.refresh_training_table(spark, installed, since=AS_OF - timedelta(days=3))
    assert rows(spark.table(installed.training)) == before


def test_empty_silver_updates_nothing(spark, tmp_path):
    settings = Settings(root=str(tmp_path), offline_schema="jobs_none")
    assert not jobs.refresh_training_table(spark, settings)
    assert not spark.catalog.tableExists(settings.training)


def test_rule_counts_of_a_run(spark, tmp_path):
    settings = Settings(root=str(tmp_path), layer_schema="jobs_counts")
    raw = "customer_number string, feature1 double, date date, target int"
    day = date(2024, 1, 1)
    data = [("1", 1.0, day, 0), ("x", 2.0, day, 0), (None, 3.0, day, 1)]
    spark.createDataFrame(data, raw).write.parquet(settings.raw)
    counts = jobs.run_medallion(spark, settings)
    assert counts == {
        "customer_number": {"passed": 1, "failed": 2},
        "_rescued_data": {"passed": 2, "failed": 1},
    }
    assert rows(jobs.silver(spark, settings), "customer_number", "feature1") == [(1, 1.0)]
    assert jobs.run_medallion(spark, settings) == {
        "customer_number": {"passed": 0, "failed": 0},
        "_rescued_data": {"passed": 0, "failed": 0},
    }


SOME = "customer_number int, feature1 double, date date, target int"


@pytest.mark.parametrize("names", [("a", "b", "c"), ("c", "b", "a")])
def test_files_of_differing_schemas(spark, tmp_path, names):
    settings = Settings(root=str(tmp_path), layer_schema=f"jobs_mixed_{names[0]}")
    day = date(2024, 5, 1)
    files = [
        ([(4, 1.5, day, 0)], SOME),
        ([(5, 2.5, day, 1, "x")], SOME + ", more string"),
        ([("6", 3.5, day), ("six", 4.5, day)], "customer_number string, feature1 double, date date"),
    ]
    for name, (data, schema) in zip(names, files):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "made" / name))
    raw = tmp_path / "raw" / "activity"
    raw.mkdir(parents=True)
    assert jobs.run_medallion(spark, settings)["customer_number"] == {"passed": 0, "failed": 0}
    for group in (names[:2], names[2:]):
        for name in group:
            made = next((tmp_path / "made" / name).glob("*.parquet"))
            (raw / f"{name}.parquet").write_bytes(made.read_bytes())
        jobs.run_medallion(spark, settings)
    bronze = spark.table(settings.bronze_table).select("customer_number", "feature1", "target", RESCUED)
    assert rows(bronze) == rows(
        spark.createDataFrame(
            [(4, 1.5, 0, None), (5, 2.5, 1, '{"more":"x"}'), (6, 3.5, None, None), (None, 4.5, None, '{"customer_number":"six"}')],
            bronze.schema,
        )
    )
    assert rows(jobs.silver(spark, settings), "customer_number", "feature1") == [(4, 1.5), (6, 3.5)]


def test_a_later_row_of_the_same_day_corrects_and_deletes(spark, tmp_path):
    settings = Settings(
        root=str(tmp_path), layer_schema="jobs_later", offline_schema="jobs_later_off", delete_when="target < 0"
    )
    day, other = date(2024, 5, 1), date(2024, 5, 2)
    runs = [
        [(1, 50.0, day, 0), (2, 60.0, day, 0), (3, 70.0, day, 0), (9, 1.0, other, 0)],
        [(1, 10.0, day, 0), (2, None, day, 0), (9, 1.0, other, -1)],
    ]
    for data in runs:
        spark.createDataFrame(data, SOME).coalesce(1).write.mode("append").parquet(settings.raw)
        jobs.run_medallion(spark, settings)
        assert jobs.refresh_training_table(spark, settings, since=day)
    expected = [(1, 10.0), (2, None), (3, 70.0)]
    assert sorted((r[0], r[1]) for r in jobs.silver(spark, settings).select("customer_number", "feature1").collect()) == expected
    # The day emptied by the delete has left the refreshed table too.
    assert sorted((r[0], r[1]) for r in spark.table(settings.training).select("customer_number", "feature1").collect()) == expected


def test_train_score_evaluate(spark, installed):
    registry = Registry(spark, installed.registry)
    # No model yet: scoring trains one first.
    scored = jobs.score_batch(spark, installed, AS_OF - timedelta(days=1))
    assert registry.find(installed.model_name)[0] == 1
    customers = spark.table(installed.online_serving).count()
    assert scored.count() == customers
    assert jobs.score_batch(spark, installed, AS_OF - timedelta(days=1)).count() == customers
    assert jobs.score_batch(spark, installed, AS_OF).count() == 2 * customers
    result = jobs.evaluate_model(spark, installed, AS_OF, threshold=0.0)
    assert 0 <= result["f1"] <= 1 and not result["retrain"] and result["version"] is None
    result = jobs.evaluate_model(spark, installed, AS_OF, threshold=1.1)
    assert result["retrain"] and result["version"] == 2
    assert registry.find(installed.model_name)[0] == 2


def test_drift_decides_on_training(spark, installed, monkeypatch):
    trained = []
    monkeypatch.setattr(jobs, "train_model", lambda *a: trained.append(a[2]) or 7)
    calm = jobs.check_drift(spark, installed, AS_OF, default_threshold=1e-9, categorical=[])
    assert calm["any_drift"] is False and calm["version"] is None and trained == []
    assert set(calm) == {"feature1", "feature2", "feature3", "any_drift", "version"}
    moved = jobs.check_drift(spark, installed, AS_OF, thresholds={"feature1": 1.0}, default_threshold=1e-9, categorical=[])
    assert moved["feature1"] and moved["any_drift"] and moved["version"] == 7 and trained == [AS_OF]


def test_settings():
    settings = Settings(root="/data")
    assert settings.training == "offline.training" and settings.online_serving == "online.serving"
    assert settings.keys == ["date", "customer_number"] and settings.raw == "/data/raw/activity"
    assert [f.name for f in ACTIVITY][:1] == ["customer_number"]
