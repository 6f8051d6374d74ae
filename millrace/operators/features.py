"""Per-customer features and the training table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import newest, total
from millrace.operators.latest import latest_by_key
from millrace.schema import CUSTOMER, DATE, OFFLINE_KEYS, TARGET, TRAIN_DAYS, TRAINING_COLUMNS
from millrace.sources.scan import since


def customer_features(
    df: DataFrame,
    order: Sequence[str] = (DATE,),
    last: Sequence[str] = ("feature4",),
    sum_digits: int | None = None,
) -> DataFrame:
    """Per customer: least feature1, greatest feature2, sum of feature3, newest ``last`` values.

    One shuffle on the customer, with every aggregate reduced in the map tasks first.
    """
    grouped = df.groupBy(CUSTOMER).agg(
        F.min("feature1").alias("feature1"),
        F.max("feature2").alias("feature2"),
        total("feature3", sum_digits).alias("feature3"),
        newest(order, last).alias("_last"),
    )
    return grouped.select(
        CUSTOMER, "feature1", "feature2", "feature3", *[F.col(f"_last.{c}").alias(c) for c in last]
    )


def online_features(
    df: DataFrame, order: Sequence[str] = (DATE,), sum_digits: int | None = None
) -> DataFrame:
    """Features a customer is scored on."""
    return customer_features(df, order, ["feature4"], sum_digits)


def training_features(
    df: DataFrame,
    as_of: date,
    order: Sequence[str] = (DATE,),
    days: int = TRAIN_DAYS,
    sum_digits: int | None = None,
) -> DataFrame:
    """Features and newest label per customer over the training horizon."""
    return customer_features(since(df, as_of, days), order, ["feature4", TARGET], sum_digits)


def training_rows(
    df: DataFrame, keys: Sequence[str] = tuple(OFFLINE_KEYS), order: Sequence[str] = (DATE,)
) -> DataFrame:
    """The training table: newest row per key, in the table's column order."""
    kept = df.select(*dict.fromkeys([*TRAINING_COLUMNS, *keys, *order]))
    return latest_by_key(kept, keys, order).select(*TRAINING_COLUMNS)
