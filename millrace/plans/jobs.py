"""The scheduled jobs. Each takes the session, the settings and the day it runs for."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.models import logistic
from millrace.models.registry import Registry
from millrace.operators import drift, evaluation, features, quality
from millrace.schema import (
    ACTIVITY,
    ARRIVAL,
    CUSTOMER,
    DATE,
    DRIFT_DAYS,
    HYPERPARAMETERS,
    LABEL_DELAY_DAYS,
    OFFLINE_KEYS,
    OFFLINE_PARTITION,
    ONLINE_KEYS,
    RESCUED,
    RETRAIN_BELOW_F1,
    TRAINING_COLUMNS,
    Settings,
)
from millrace.sinks import feature_tables, layers, predictions, publish, snapshots
from millrace.sources import generate as generator
from millrace.sources import scan
from millrace.sources.rescue import conform
from millrace.streaming import flows


def _history_partition(settings: Settings) -> list[str]:
    # A snapshot keyed by day is partitioned by day: a merge then touches few days. Any other is dealt into buckets.
    return [DATE] if DATE in settings.keys else [snapshots.bucket_column(settings.key_buckets)]


def _snapshot_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def generate_activity(
    spark: SparkSession, settings: Settings, as_of: date, sample_size: int = generator.SAMPLE_SIZE
) -> None:
    """Add one synthetic batch to the raw folder."""
    predictions.append_rows(generator.generate(spark, as_of, sample_size), settings.raw)


def run_medallion(
    spark: SparkSession,
    settings: Settings,
    schema: T.StructType = ACTIVITY,
    files_per_batch: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, dict]:
    """New raw files to bronze, rows that meet the rules to silver; returns the rule counts.

    Both layers are named in the catalog: ``<table>_bronze`` and ``<table>_silver``.
    ``prepare`` maps a source with other column names onto those of the schema and has to keep
    ``ARRIVAL``. Files may differ in schema. Of the rows of a key that tie in ``settings.order`` the
    one that arrived last is kept. The counts are of all rows landed since the last finished run; a
    run without new files counts zero. A micro-batch takes ``files_per_batch`` files, or else
    ``settings.bytes_per_batch``.
    """
    arrived = T.StructType([T.StructField("time", T.TimestampType()), T.StructField("file", T.StringType()), T.StructField("row", T.LongType())])
    stored = T.StructType([*schema.fields, T.StructField(ARRIVAL, arrived)])

    def shape(rows: DataFrame) -> DataFrame:
        rows = prepare(rows) if prepare is not None else rows
        if ARRIVAL not in rows.columns:
            raise ValueError(f"prepare has to keep {ARRIVAL}")
        return conform(rows, stored)

    counts, finished = f"{settings.bronze}_counts", f"{settings.bronze}_finished"
    before = flows.last_batch(spark, finished)
    flows.land_files(
        spark, settings.raw, settings.bronze, f"{settings.checkpoints}/bronze", shape, settings.rules, counts,
        files_per_batch, settings.bytes_per_batch,
    )
    found = flows.stored_counts(spark, counts, settings.rules, before).collect()
    by_rule = {r["rule"]: {"passed": r["passed"], "failed": r["failed"]} for r in found}
    result = {rule: by_rule[rule] for rule in settings.rules}
    newest = flows.last_batch(spark, settings.bronze)
    if newest < 0:
        return result
    landed = T.StructType([*_snapshot_schema(stored).fields, T.StructField(RESCUED, T.StringType())])
    bronze = scan.stream(
        spark, f"{settings.bronze}/{flows.BATCH}*", landed, files_per_batch=files_per_batch, bytes_per_batch=settings.bytes_per_batch
    )
    flows.upsert_snapshot(
        quality.expect_or_drop(bronze, settings.rules),
        settings.silver,
        f"{settings.checkpoints}/silver",
        settings.keys,
        [*settings.order, ARRIVAL],
        partition_by=_history_partition(settings),
        delete_when=settings.delete_when,
        drop=[RESCUED],
    )
    name_layers(spark, settings, schema)
    snapshots.expire(spark, settings.silver, _history_partition(settings), settings.keep_versions)
    if newest > before:
        # An empty folder is the mark that the counts up to this micro-batch were returned.
        spark.createDataFrame([], "rule string").write.mode("overwrite").parquet(flows.batch_folder(finished, newest))
    return result


def name_layers(spark: SparkSession, settings: Settings, schema: T.StructType = ACTIVITY) -> None:
    """Give bronze and silver their names, comments and quality properties."""
    feature_tables.ensure_schema(spark, settings.layer_schema, settings.root)
    stored = T.StructType([*_snapshot_schema(schema).fields, T.StructField(RESCUED, T.StringType())])
    layers.name_folder(
        spark, settings.bronze_table, settings.bronze, stored, f"Bronze table of {settings.table}", "bronze"
    )
    layers.name_snapshot(
        spark,
        settings.silver_table,
        settings.silver,
        _snapshot_schema(schema),
        _history_partition(settings),
        f"Silver table of {settings.table}",
        "silver",
    )


def silver(spark: SparkSession, settings: Settings, schema: T.StructType = ACTIVITY) -> DataFrame:
    """The silver table as it is now."""
    return snapshots.read_snapshot(
        spark, settings.silver, _snapshot_schema(schema), _history_partition(settings)
    )


def _refresh(
    spark: SparkSession, settings: Settings, name: str, description: str, schema: T.StructType,
    since: date | None,
) -> bool:
    rows = silver(spark, settings, schema)
    if since:
        rows = rows.where(F.col(DATE) >= F.lit(since))
    # Silver that has the keys of the table is copied day by day without a shuffle.
    same_keys = set(settings.keys) == set(OFFLINE_KEYS)
    if set(settings.keys) <= set(OFFLINE_KEYS):
        rows = rows.select(*TRAINING_COLUMNS)
    else:
        rows = features.training_rows(rows, OFFLINE_KEYS, settings.order)
    vanished = since is not None and feature_tables.table_exists(spark, name)
    if silver(spark, settings, schema).where(F.col(DATE) >= F.lit(since) if since else F.lit(True)).isEmpty():
        if vanished:
            feature_tables.drop_vanished(spark, name, silver(spark, settings, schema), DATE, since)
        return False
    feature_tables.ensure_schema(spark, settings.offline_schema, settings.root)
    feature_tables.update_table(
        rows,
        name,
        OFFLINE_KEYS,
        OFFLINE_PARTITION,
        description,
        mode="partitions" if since else "overwrite",
        keep=settings.keep_versions,
        check=False,
        rebalance=not same_keys,
    )
    if vanished:
        # Days that silver no longer has, emptied by deletes.
        feature_tables.drop_vanished(spark, name, silver(spark, settings, schema), DATE, since)
    return True


def refresh_training_table(
    spark: SparkSession, settings: Settings, schema: T.StructType = ACTIVITY, since: date | None = None
) -> bool:
    """Training table from silver, one row per (date, customer); False when there are no rows.

    ``since`` refreshes only the days from then on and leaves the history as it is.
    """
    return _refresh(spark, settings, settings.training, "Training feature table", schema, since)


def refresh_serving_table(
    spark: SparkSession, settings: Settings, schema: T.StructType = ACTIVITY, since: date | None = None
) -> bool:
    """Offline serving table from silver, refreshed in the same way."""
    return _refresh(spark, settings, settings.offline_serving, "Serving feature table", schema, since)


def refresh_online_features(
    spark: SparkSession, settings: Settings, publish_to: Callable[[DataFrame], object] | None = None
) -> None:
    """One feature row per customer from the offline serving table, then publish it.

    ``publish_to`` is called with the stored table; by default it becomes the next version
    of the snapshot in the online store folder.
    """
    rows = features.online_features(
        spark.table(settings.offline_serving), [DATE], settings.sum_digits
    )
    feature_tables.ensure_schema(spark, settings.online_schema, settings.root)
    feature_tables.update_table(
        rows,
        settings.online_serving,
        ONLINE_KEYS,
        (),
        "Online feature table",
        publish=publish_to or (lambda df: publish.publish_snapshot(df, settings.online_store)),
        keep=settings.keep_versions,
        check=False,
    )


def train_model(
    spark: SparkSession, settings: Settings, as_of: date, parameters: dict | None = None
) -> int:
    """Fit on the training horizon and register the result; returns the version."""
    rows = features.training_features(
        spark.table(settings.training), as_of, [DATE], sum_digits=settings.sum_digits
    )
    model, n = logistic.fit(rows, parameters)
    return Registry(spark, settings.registry).register(
        model,
        rows,
        settings.model_name,
        user=settings.user,
        parameters={**HYPERPARAMETERS, **(parameters or {})},
        tags={"rows": str(n)},
        stage=settings.stage,
        as_of=as_of,
    )


def score_batch(spark: SparkSession, settings: Settings, as_of: date) -> DataFrame:
    """Score every customer of the online table and store the predictions of the day."""
    model = Registry(spark, settings.registry).load(
        settings.model_name, settings.stage, train=lambda: train_model(spark, settings, as_of)
    )
    scored = logistic.predict(model, spark.table(settings.online_serving), as_of)
    predictions.write_predictions(scored, settings.predictions)
    return predictions.read_predictions(spark, settings.predictions, scored.schema[CUSTOMER].dataType)


def evaluate_model(
    spark: SparkSession, settings: Settings, as_of: date, threshold: float = RETRAIN_BELOW_F1
) -> dict:
    """F1 of the stored predictions against the labels; retrain below the threshold."""
    labels = evaluation.evaluation_window(
        spark.table(settings.training), as_of, label_delay=LABEL_DELAY_DAYS
    )
    stored = predictions.read_predictions(
        spark, settings.predictions, labels.schema[CUSTOMER].dataType
    )
    counts = evaluation.confusion_by_key(labels, evaluation.recent_predictions(stored, as_of))
    row = evaluation.retrain_decision(evaluation.with_f1(counts), threshold).first()
    version = train_model(spark, settings, as_of) if row["retrain"] else None
    return {"f1": row["f1"], "retrain": row["retrain"], "version": version}


def check_drift(spark: SparkSession, settings: Settings, as_of: date, **options) -> dict:
    """Drift report of the two last weeks of the training table; retrain on any drift.

    The report is one entry per configured feature.
    """
    rows = scan.since(spark.table(settings.training), as_of, DRIFT_DAYS)
    report = drift.drift_report(drift.drift_windows(rows, as_of), **options)
    found = {r["feature"]: r["detected"] for r in report.select("feature", "detected").collect()}
    any_drift = any(bool(v) for v in found.values())
    version = train_model(spark, settings, as_of) if any_drift else None
    return {**found, "any_drift": any_drift, "version": version}


JOBS = {
    "generate": lambda spark, settings, as_of, since: generate_activity(spark, settings, as_of),
    "medallion": lambda spark, settings, as_of, since: run_medallion(spark, settings),
    "training-table": lambda spark, settings, as_of, since: refresh_training_table(spark, settings, since=since),
    "serving-table": lambda spark, settings, as_of, since: refresh_serving_table(spark, settings, since=since),
    "online-features": lambda spark, settings, as_of, since: refresh_online_features(spark, settings),
    "train": lambda spark, settings, as_of, since: train_model(spark, settings, as_of),
    "score": lambda spark, settings, as_of, since: score_batch(spark, settings, as_of),
    "evaluate": lambda spark, settings, as_of, since: evaluate_model(spark, settings, as_of),
    "drift": lambda spark, settings, as_of, since: check_drift(spark, settings, as_of),
}
