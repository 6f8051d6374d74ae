"""One query per operator, over the shared tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.models import logistic
from millrace.models.registry import Registry, current_stages, latest_run, latest_runs
from millrace.operators import drift, evaluation, features, quality
from millrace.operators.latest import first_per_group, latest_by_key
from millrace.plans import jobs, views
from millrace.schema import (
    ACTIVITY_RULES,
    CUSTOMER,
    DATE,
    DRIFT_DAYS,
    EVAL_DAYS,
    FEATURES,
    PREDICTION,
    PREDICTION_DATE,
    RESCUED,
    Settings,
    TRAIN_DAYS,
)
from millrace.sinks import feature_tables, predictions, publish, snapshots
from millrace.sources import scan
from millrace.sources.generate import activity_for
from millrace.sources.rescue import conform
from millrace.streaming import flows
from millrace.workspace import run_folder

Query = Callable[[SparkSession, str], DataFrame]

EVENT_ORDER = [DATE, "event_id"]
ORDER_ORDER = [DATE, "order_key"]


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return quality.expect_or_drop(views.activity_events(spark, sf), ACTIVITY_RULES)


def _raw_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = scan.infer_schema(spark, views.events_path(sf))
    rows = scan.stream(spark, views.events_glob(sf), schema)
    return conform(views.raw_events(rows), views.EVENT_ACTIVITY)


def _settings(spark: SparkSession, sf: str, purpose: str) -> Settings:
    tag = uuid.uuid4().hex[:8]
    return Settings(
        root=run_folder(spark, purpose),
        raw_path=views.events_glob(sf),
        order=list(EVENT_ORDER),
        layer_schema=f"layers_{tag}",
        offline_schema=f"offline_{tag}",
        online_schema=f"online_{tag}",
        sum_digits=2,
    )


def _medallion(spark: SparkSession, settings: Settings) -> dict:
    return jobs.run_medallion(spark, settings, views.EVENT_ACTIVITY, prepare=views.raw_events)


# --- sources -------------------------------------------------------------------------


def scan_activity(spark: SparkSession, sf: str) -> DataFrame:
    return views.activity_events(spark, sf)


def scan_named_table(spark: SparkSession, sf: str) -> DataFrame:
    settings = _settings(spark, sf, "scan")
    feature_tables.ensure_schema(spark, settings.offline_schema, settings.root)
    rows = views.activity_orders(spark, sf)
    feature_tables.create_table(rows, settings.training, ["order_key"])
    return scan.table(spark, settings.training)


def cutoff_training(spark: SparkSession, sf: str) -> DataFrame:
    return scan.since(views.activity_orders(spark, sf), views.ORDERS_AS_OF, TRAIN_DAYS)


def cutoff_eval(spark: SparkSession, sf: str) -> DataFrame:
    return scan.since(views.activity_orders(spark, sf), views.ORDERS_AS_OF, EVAL_DAYS)


def cutoff_drift(spark: SparkSession, sf: str) -> DataFrame:
    return scan.since(views.activity_orders(spark, sf), views.ORDERS_AS_OF, DRIFT_DAYS)


def rescue_conform(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.raw_events(scan.scan(spark, views.events_path(sf)))
    return conform(raw, views.EVENT_ACTIVITY)


def rescue_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with fractions, dates with a time of day and a field inside a struct that do not fit as they are."""
    o, i = spark.read.parquet(f"{sf}/orders.parquet"), F.col("o_orderkey")
    noon = F.col("o_orderdate").cast("date").cast("timestamp") + F.when(i % 11 == 0, F.expr("INTERVAL 12 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    raw = o.select(
        i.alias("order_key"),
        (F.col("o_custkey") + F.when(i % 7 == 0, 0.5).otherwise(0.0)).alias(CUSTOMER),
        noon.alias(DATE),
        F.struct((i % 3 + F.when(i % 5 == 0, 0.25).otherwise(0.0)).alias("part")).alias("nested"),
    )
    schema = "order_key bigint, customer_number int, date date, nested struct<part: int>"
    found = conform(raw, T._parse_datatype_string(schema))
    text = F.col(RESCUED)
    return found.select(
        "order_key", CUSTOMER, DATE, F.get_json_object(text, "$.customer_number").cast("double").alias("key_rescued"),
        F.get_json_object(text, "$.date").isNotNull().alias("date_rescued"), F.col("nested.part").alias("nested"),
        text.isNotNull().alias("rescued"),
    )


def generate_activity(spark: SparkSession, sf: str) -> DataFrame:
    ids = scan.scan(spark, views.events_path(sf)).select("event_id")
    return activity_for(ids, "event_id", views.EVENTS_AS_OF)


# --- row rules -----------------------------------------------------------------------


def dq_expect_or_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf)


def dq_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rule_counts(views.activity_events(spark, sf), ACTIVITY_RULES)


# --- newest row per key --------------------------------------------------------------


def silver_scd1(spark: SparkSession, sf: str) -> DataFrame:
    return latest_by_key(_checked(spark, sf), [CUSTOMER], EVENT_ORDER, drop=[RESCUED])


def silver_scd1_daily(spark: SparkSession, sf: str) -> DataFrame:
    return latest_by_key(_checked(spark, sf), [DATE, CUSTOMER], EVENT_ORDER, drop=[RESCUED])


def scd1_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """The later half of the history arrives first, the earlier half after it."""
    rows = views.activity_orders(spark, sf)
    root = run_folder(spark, "late")
    late = F.col(DATE) < F.lit(date(1999, 1, 1))
    for version, part in enumerate([rows.where(~late), rows.where(late)], start=1):
        snapshots.merge_changes(part, root, version, [CUSTOMER], ORDER_ORDER)
    return snapshots.read_snapshot(spark, root, rows.schema)


def scd1_deletes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _checked(spark, sf)
    return latest_by_key(
        rows, [CUSTOMER], EVENT_ORDER, delete_when="feature4 = 'error'", drop=[RESCUED]
    )


def latest_per_partition(spark: SparkSession, sf: str) -> DataFrame:
    newest = [F.col(DATE).desc(), F.col("order_key").desc()]
    return first_per_group(views.activity_orders(spark, sf), [CUSTOMER], newest)


def latest_per_date(spark: SparkSession, sf: str) -> DataFrame:
    newest = [F.col(DATE).desc(), F.col("order_key").desc()]
    return first_per_group(views.activity_orders(spark, sf), [DATE], newest)


# --- feature tables ------------------------------------------------------------------


def training_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_rows(views.activity_orders(spark, sf), order=ORDER_ORDER)


def online_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.online_features(_checked(spark, sf), EVENT_ORDER, sum_digits=2)


def training_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_features(
        views.activity_orders(spark, sf), views.ORDERS_AS_OF, ORDER_ORDER, sum_digits=2
    )


def feature_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Create from the first weeks, then replace with all rows, then read by name in SQL."""
    settings = _settings(spark, sf, "table")
    feature_tables.ensure_schema(spark, settings.offline_schema, settings.root)
    rows = features.training_rows(_checked(spark, sf), order=EVENT_ORDER)
    early = scan.between(rows, date(2024, 1, 1), date(2024, 1, 15))
    for df in (early, rows):
        feature_tables.update_table(df, settings.training, [DATE, CUSTOMER], [DATE], "Training rows")
    return spark.sql(f"SELECT * FROM {settings.training}")


def feature_table_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Create from the first weeks, then refresh the days from the 10th on."""
    settings = _settings(spark, sf, "refresh")
    feature_tables.ensure_schema(spark, settings.offline_schema, settings.root)
    rows = features.training_rows(_checked(spark, sf), order=EVENT_ORDER)
    early = scan.between(rows, date(2024, 1, 1), date(2024, 1, 15)).withColumn("feature1", -F.col("feature1"))
    feature_tables.update_table(early, settings.training, [DATE, CUSTOMER], [DATE])
    feature_tables.update_table(
        scan.between(rows, date(2024, 1, 10), None),
        settings.training, [DATE, CUSTOMER], [DATE], mode="partitions",
    )
    return scan.table(spark, settings.training)


def online_publish(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.online_features(_checked(spark, sf), EVENT_ORDER, sum_digits=2)
    root = run_folder(spark, "publish")
    publish.publish_snapshot(rows.limit(0), root)
    publish.publish_snapshot(rows, root)
    return publish.read_published(spark, root, rows.schema)


def predictions_write(spark: SparkSession, sf: str) -> DataFrame:
    """Store all days, then one week again: the rerun replaces its days."""
    rows = views.prediction_events(spark, sf)
    path = run_folder(spark, "predictions")
    predictions.write_predictions(rows, path)
    again = scan.since(rows, views.EVENTS_AS_OF, 7, PREDICTION_DATE)
    predictions.write_predictions(again, path)
    return predictions.read_predictions(spark, path, rows.schema[CUSTOMER].dataType)


# --- evaluation ----------------------------------------------------------------------


def cutoff_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.recent_predictions(views.prediction_orders(spark, sf), views.ORDERS_AS_OF)


def _labels_and_predictions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    stored = views.prediction_orders(spark, sf).withColumnRenamed(PREDICTION_DATE, DATE)
    return views.activity_orders(spark, sf), stored


def eval_join(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.evaluation_pairs(*_labels_and_predictions(spark, sf))


def _plain_counts(counts: DataFrame) -> DataFrame:
    return counts.select(*[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")])


def eval_join_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return _plain_counts(evaluation.confusion_by_key(*_labels_and_predictions(spark, sf), [DATE]))


def f1_eval(spark: SparkSession, sf: str) -> DataFrame:
    counts = evaluation.confusion_by_key(*_labels_and_predictions(spark, sf))
    return evaluation.with_f1(_plain_counts(counts))


def f1_eval_by_date(spark: SparkSession, sf: str) -> DataFrame:
    counts = evaluation.confusion_by_key(*_labels_and_predictions(spark, sf), [DATE])
    return evaluation.with_f1(_plain_counts(counts))


def retrain_decision(spark: SparkSession, sf: str) -> DataFrame:
    labels = evaluation.evaluation_window(
        views.activity_orders(spark, sf), views.ORDERS_AS_OF, label_delay=1
    )
    recent = evaluation.recent_predictions(views.prediction_orders(spark, sf), views.ORDERS_AS_OF)
    counts = evaluation.confusion_by_key(labels, recent)
    return evaluation.retrain_decision(evaluation.with_f1(counts))


# --- drift ---------------------------------------------------------------------------


def _event_windows(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_windows(views.activity_events(spark, sf), views.EVENTS_AS_OF)


def _order_windows(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_windows(views.activity_orders(spark, sf), views.ORDERS_AS_OF)


def _rounded(report: DataFrame, digits: int = 7) -> DataFrame:
    return report.withColumn("score", F.round("score", digits))


def drift_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _event_windows(spark, sf)


def drift_ks(spark: SparkSession, sf: str) -> DataFrame:
    scores = drift.ks_distance(_event_windows(spark, sf))
    return scores.select("feature", "n1", "n2", F.round("d", 9).alias("d"))


def drift_ks_orders(spark: SparkSession, sf: str) -> DataFrame:
    scores = drift.ks_scores(_order_windows(spark, sf), method="exact")
    return scores.select(
        "feature", "n1", "n2", F.round("d", 9).alias("d"), F.round("p_value", 7).alias("p_value")
    )


def drift_ks_history(spark: SparkSession, sf: str) -> DataFrame:
    scores = drift.ks_distance(_history_windows(spark, sf))
    return scores.select("feature", "n1", "n2", F.round("d", 9).alias("d"))


def _history_windows(spark: SparkSession, sf: str) -> DataFrame:
    """All orders in two windows split at mid-2000: both samples grow with the table."""
    return drift.drift_windows(views.activity_orders(spark, sf), views.ORDERS_AS_OF, begin_days=3000, mid_days=400)


def drift_ks_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A heavy-tailed feature with few buckets: what stays undecided is put in order by ranges."""
    spread = F.exp(4 * ((F.col("order_key") * 7919 % 1000003) / 1000003.0 - 0.5))
    rows = views.activity_orders(spark, sf).select(DATE, (spread * F.col("feature1")).alias("feature1"), *[
        F.lit(None).cast("double").alias(c) for c in ("feature2", "feature3")
    ])
    windows = drift.drift_windows(rows, views.ORDERS_AS_OF, begin_days=3000, mid_days=400)
    scores = drift.ks_distance(windows, most_buckets=16, range_rows=2000)
    return scores.where("n1 > 0").select("feature", "n1", "n2", F.round("d", 9).alias("d"))


def drift_psi_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(drift.binned_scores(_order_windows(spark, sf)), 9)


def drift_jensen_shannon_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(drift.binned_scores(_history_windows(spark, sf), test=drift.JENSEN_SHANNON), 9)


def drift_jensen_shannon(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(drift.categorical_scores(_order_windows(spark, sf), ["feature4", CUSTOMER], drift.JENSEN_SHANNON), 9)


def drift_chi_square(spark: SparkSession, sf: str) -> DataFrame:
    """Few categories, a number taken as a category, and thousands of categories some of which one window lacks."""
    return _rounded(drift.categorical_scores(_history_windows(spark, sf), ["feature4", "feature2", CUSTOMER]))


def drift_wasserstein(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(drift.wasserstein_scores(_history_windows(spark, sf), range_rows=4000)).withColumn(
        "distance", F.round("distance", 4)
    )


def drift_report_tests(spark: SparkSession, sf: str) -> DataFrame:
    """A test of its own for every feature, all from one pass of counts."""
    report = drift.drift_report(
        _history_windows(spark, sf), num_stattest="ks", cat_stattest="chisquare", categorical_threshold=0.05,
        stattests={"feature2": "wasserstein", "feature3": "jensenshannon"}, thresholds={"feature2": 0.1},
    )
    return _rounded(report)


def drift_psi(spark: SparkSession, sf: str) -> DataFrame:
    scores = drift.psi_scores(_event_windows(spark, sf))
    return scores.withColumn("psi", F.round("psi", 9))


def drift_psi_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Two categories on small windows: the customer column has values one window lacks."""
    scores = drift.psi_scores(_order_windows(spark, sf), ["feature4", CUSTOMER])
    return scores.withColumn("psi", F.round("psi", 9))


def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(drift.drift_report(_event_windows(spark, sf)))


def drift_report_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A threshold of its own for one feature, the default for the others."""
    return _rounded(drift.drift_report(_order_windows(spark, sf), thresholds={"feature2": 0.9}))


def drift_any(spark: SparkSession, sf: str) -> DataFrame:
    return drift.any_drift(drift.drift_report(_event_windows(spark, sf)))


def drift_detection(spark: SparkSession, sf: str) -> DataFrame:
    """The drift job on a stored training table: flags, and whether a model was fitted."""
    settings = _settings(spark, sf, "drift")
    feature_tables.ensure_schema(spark, settings.offline_schema, settings.root)
    rows = features.training_rows(_checked(spark, sf), order=EVENT_ORDER)
    feature_tables.update_table(rows, settings.training, [DATE, CUSTOMER], [DATE], check=False)
    report = jobs.check_drift(spark, settings, views.EVENTS_AS_OF)
    flags = [(k, report[k]) for k in (*FEATURES, "any_drift")]
    return spark.createDataFrame(
        [*flags, ("retrained", report["version"] is not None)], "item string, flag boolean"
    )


# --- model ---------------------------------------------------------------------------


def ohe_features(spark: SparkSession, sf: str) -> DataFrame:
    """Encoder fitted without one category and applied to all rows."""
    rows = views.activity_events(spark, sf)
    encoded = logistic.one_hot(rows.where(F.col("feature4") != "error"), rows)
    slots = vector_to_array("feature4_hot")
    names = ["click", "purchase", "signup", "view"]
    return encoded.select(
        "event_id",
        "feature4",
        *[slots[i].cast("int").alias(f"is_{name}") for i, name in enumerate(names)],
        F.size(slots).alias("slots"),
    )


def _order_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_features(
        views.activity_orders(spark, sf), views.ORDERS_AS_OF, ORDER_ORDER, sum_digits=2
    )


# Fitted until nothing moves, so that another method gives the same digits.
TIGHT = {"tol": 1e-13, "max_iter": 1000}


def train_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Weights at the minimum, in 3 digits; prices weigh little and have 10."""
    model, _ = logistic.fit(_order_features(spark, sf), TIGHT)
    weights = spark.createDataFrame(logistic.coefficients(model), "feature string, weight double")
    small = F.col("feature").isin("feature1", "feature3")
    return weights.withColumn("weight", F.when(small, F.round("weight", 10)).otherwise(F.round("weight", 3)))


def predict_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A prediction for every customer; probabilities in 2 digits."""
    rows = _order_features(spark, sf)
    model, _ = logistic.fit(rows, TIGHT)
    scored = logistic.predict(model, rows, views.ORDERS_AS_OF)
    return scored.withColumn("probability", F.round("probability", 2))


def registry_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Register two versions, load the one in production and score with it."""
    rows = _order_features(spark, sf)
    model, n = logistic.fit(rows)
    registry = Registry(spark, run_folder(spark, "registry"))
    for _ in range(2):
        registry.register(model, rows, "orders_model", tags={"rows": str(n)}, as_of=views.ORDERS_AS_OF)
    scored = logistic.predict(registry.load("orders_model"), rows, views.ORDERS_AS_OF)
    counted = scored.agg(F.count(PREDICTION)).first()[0]
    return registry.stages().select("version", "stage").withColumn("scored", F.lit(counted).cast("bigint"))


def registry_latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return latest_run(views.order_runs(spark, sf))


def registry_latest_runs(spark: SparkSession, sf: str) -> DataFrame:
    return latest_runs(views.order_runs(spark, sf), ["experiment"])


def registry_stage(spark: SparkSession, sf: str) -> DataFrame:
    return current_stages(views.stage_events(spark, sf))


# --- streams -------------------------------------------------------------------------


def bronze_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    root = run_folder(spark, "bronze")
    rows = _raw_stream(spark, sf)
    flows.append_files(rows, f"{root}/table", f"{root}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{root}/table")


def dq_expect_or_drop_stream(spark: SparkSession, sf: str) -> DataFrame:
    root = run_folder(spark, "checked")
    rows = quality.expect_or_drop(_raw_stream(spark, sf), ACTIVITY_RULES)
    flows.append_files(rows, f"{root}/table", f"{root}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{root}/table")


def dq_metrics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Rule counts a stream stores per micro-batch: two numbers per rule."""
    root = run_folder(spark, "counts")
    flows.count_rules(_raw_stream(spark, sf), ACTIVITY_RULES, f"{root}/counts", f"{root}/checkpoint")
    return flows.stored_counts(spark, f"{root}/counts", ACTIVITY_RULES)


def _silver_stream(
    spark: SparkSession, sf: str, keys: list[str], partition_by: list[str], delete_when: str | None = None
) -> DataFrame:
    root = run_folder(spark, "silver")
    rows = quality.expect_or_drop(_raw_stream(spark, sf), ACTIVITY_RULES)
    flows.upsert_snapshot(
        rows, f"{root}/table", f"{root}/checkpoint", keys, EVENT_ORDER, partition_by, delete_when, drop=[RESCUED]
    )
    return snapshots.read_snapshot(spark, f"{root}/table", views.EVENT_ACTIVITY, partition_by)


def silver_scd1_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_stream(spark, sf, [CUSTOMER], [snapshots.bucket_column(16)])


def silver_scd1_daily_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_stream(spark, sf, [DATE, CUSTOMER], [DATE])


def silver_deletes_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_stream(spark, sf, [CUSTOMER], [snapshots.bucket_column(16)], delete_when="feature4 = 'error'")


# --- jobs ----------------------------------------------------------------------------


def run_medallion(spark: SparkSession, sf: str) -> DataFrame:
    settings = _settings(spark, sf, "medallion")
    _medallion(spark, settings)
    return scan.table(spark, settings.silver_table)


def bronze_mixed_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Files with a column too many, with a key as text and without a column, over two runs."""
    settings = replace(_settings(spark, sf, "mixed"), raw_path=run_folder(spark, "mixed-raw"))
    rows, i = views.activity_events(spark, sf).drop(RESCUED), F.col("event_id")
    number = F.col(CUSTOMER).cast("string")
    parts = [
        [
            rows.where(i % 3 == 0).withColumn("extra", F.when(i % 2 == 0, F.col("feature4"))),
            rows.where(i % 3 == 1).withColumn(
                CUSTOMER, F.when(i % 41 == 0, F.concat(F.lit("u"), number)).otherwise(number)
            ),
        ],
        [rows.where(i % 3 == 2).drop("target")],
    ]
    for run in parts:
        for part in run:
            part.write.mode("append").parquet(settings.raw)
        jobs.run_medallion(spark, settings, views.EVENT_ACTIVITY)
    return scan.table(spark, settings.bronze_table)


def silver_same_day_correction(spark: SparkSession, sf: str) -> DataFrame:
    """Default keys and order: rows of a second run correct those of the first for the same day."""
    settings = replace(_settings(spark, sf, "correct"), raw_path=run_folder(spark, "correct-raw"), order=[DATE])
    rows, i = _checked(spark, sf).drop(RESCUED), F.col("event_id")
    later = F.when(i % 3 != 0, F.col("feature1") - 1000)
    for part in (rows.where(i % 2 == 0), rows.where(i % 2 == 1).withColumn("feature1", later)):
        day = latest_by_key(part, [DATE, CUSTOMER], EVENT_ORDER)
        day.write.mode("append").parquet(settings.raw)
        jobs.run_medallion(spark, settings, views.EVENT_ACTIVITY)
    return scan.table(spark, settings.silver_table)


def feature_table_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Create from the first weeks, then merge by key the rows from the 10th on."""
    settings = _settings(spark, sf, "merge")
    feature_tables.ensure_schema(spark, settings.offline_schema, settings.root)
    rows = features.training_rows(_checked(spark, sf), order=EVENT_ORDER)
    early = scan.between(rows, date(2024, 1, 1), date(2024, 1, 15)).withColumn("feature1", -F.col("feature1"))
    late = scan.between(rows, date(2024, 1, 10), None)
    for df in (early, late):
        feature_tables.update_table(df, settings.training, [DATE, CUSTOMER], [DATE], mode="merge", check=False)
    return scan.table(spark, settings.training)


def refresh_training_table(spark: SparkSession, sf: str) -> DataFrame:
    settings = _settings(spark, sf, "training")
    _medallion(spark, settings)
    jobs.refresh_training_table(spark, settings, views.EVENT_ACTIVITY)
    return scan.table(spark, settings.training)


def refresh_online_features(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files to the published table, through every stored layer."""
    settings = _settings(spark, sf, "online")
    _medallion(spark, settings)
    jobs.refresh_serving_table(spark, settings, views.EVENT_ACTIVITY)
    jobs.refresh_online_features(spark, settings)
    schema = spark.table(settings.online_serving).schema
    return publish.read_published(spark, settings.online_store, schema)


def score_and_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """Train, score and evaluate on stored tables: F1, decision and model versions."""
    settings = _settings(spark, sf, "evaluate")
    _medallion(spark, settings)
    jobs.refresh_training_table(spark, settings, views.EVENT_ACTIVITY)
    jobs.refresh_serving_table(spark, settings, views.EVENT_ACTIVITY)
    jobs.refresh_online_features(spark, settings)
    day = views.EVENTS_AS_OF - timedelta(days=2)
    jobs.train_model(spark, settings, day, TIGHT)
    jobs.score_batch(spark, settings, day)
    result = jobs.evaluate_model(spark, settings, views.EVENTS_AS_OF)
    row = (result["f1"], result["retrain"], result["version"])
    return spark.createDataFrame([row], "f1 double, retrain boolean, version int")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_activity, scan_named_table, cutoff_training, cutoff_eval, cutoff_drift,
        rescue_conform, generate_activity, dq_expect_or_drop, dq_metrics,
        silver_scd1, silver_scd1_daily, scd1_out_of_order, scd1_deletes,
        latest_per_partition, latest_per_date, training_table, online_features,
        training_features, feature_table_roundtrip, feature_table_refresh, online_publish,
        predictions_write, cutoff_predictions, eval_join, eval_join_by_date, f1_eval,
        f1_eval_by_date, retrain_decision, drift_windows, drift_ks, drift_ks_orders,
        drift_ks_history, drift_psi, drift_psi_orders, drift_report, drift_report_orders,
        drift_any, drift_detection, ohe_features, train_logistic, predict_batch,
        registry_roundtrip, registry_latest_run, registry_latest_runs, registry_stage,
        bronze_stream_ingest, dq_expect_or_drop_stream, dq_metrics_stream,
        silver_scd1_stream, silver_scd1_daily_stream, run_medallion, refresh_training_table,
        refresh_online_features, score_and_evaluate, silver_deletes_stream, bronze_mixed_schemas,
        silver_same_day_correction, feature_table_merge, drift_ks_ranges, drift_psi_numeric,
        drift_jensen_shannon_numeric, drift_jensen_shannon, drift_chi_square, drift_wasserstein, drift_report_tests,
        rescue_fractions,
    )
}
