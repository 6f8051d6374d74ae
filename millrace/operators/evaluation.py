"""Compare stored predictions with labels that arrive later."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import f1
from millrace.schema import (
    CUSTOMER,
    DATE,
    EVAL_DAYS,
    PREDICTION,
    PREDICTION_DATE,
    RETRAIN_BELOW_F1,
    TARGET,
)
from millrace.sources.scan import since


def recent_predictions(predictions: DataFrame, as_of: date, days: int = EVAL_DAYS) -> DataFrame:
    """Predictions of the last days, dated like the labels they are compared with."""
    return since(predictions, as_of, days, PREDICTION_DATE).withColumnRenamed(PREDICTION_DATE, DATE)


def evaluation_window(
    labels: DataFrame, as_of: date, days: int = EVAL_DAYS, label_delay: int | None = None
) -> DataFrame:
    """Labels of the last days; with ``label_delay`` the newest days, not yet labelled, are left out."""
    kept = since(labels, as_of, days)
    if label_delay is None:
        return kept
    return kept.where(F.col(DATE) <= F.date_sub(F.lit(as_of), label_delay))


def evaluation_pairs(
    labels: DataFrame, predictions: DataFrame, keys: Sequence[str] = (DATE, CUSTOMER)
) -> DataFrame:
    """Row-level inner join of labels and predictions."""
    return labels.select(*keys, TARGET).join(predictions.select(*keys, PREDICTION), list(keys), "inner")


def confusion(pairs: DataFrame) -> DataFrame:
    """One row (tp, fp, fn, tn) of joined labels and predictions."""
    t, p = F.col(TARGET), F.col(PREDICTION)
    return pairs.agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    )


def confusion_by_key(
    labels: DataFrame, predictions: DataFrame, keys: Sequence[str] = (DATE, CUSTOMER)
) -> DataFrame:
    """Same counts as ``confusion(evaluation_pairs(..))`` without building the pairs.

    Labels and predictions of a key are counted, then the counts are multiplied; a key only
    one side has multiplies by zero, so no join is needed. Joined on a key that repeats on
    both sides (the date alone), the pairs of a key grow with the product of its rows; here a
    key is one row after the map tasks, and all rows go through one shuffle.
    """

    def marks(df: DataFrame, column: str, name: str) -> DataFrame:
        counted = {f"{name}1": F.col(column) == 1, f"{name}0": F.col(column) == 0}
        known = df.dropna(subset=list(keys))
        return known.select(
            *keys,
            *[counted.get(c, F.lit(False)).alias(c) for c in ("t1", "t0", "p1", "p0")],
        )

    both = marks(labels, TARGET, "t").unionByName(marks(predictions, PREDICTION, "p"))
    counts = both.groupBy(*keys).agg(
        *[F.count_if(c).cast("decimal(19,0)").alias(c) for c in ("t1", "t0", "p1", "p0")]
    )

    def pairs(left: str, right: str):
        product = (F.col(left) * F.col(right)).cast("decimal(38,0)")
        return F.coalesce(F.sum(product), F.lit(0)).cast("decimal(38,0)")

    return counts.agg(
        pairs("t1", "p1").alias("tp"),
        pairs("t0", "p1").alias("fp"),
        pairs("t1", "p0").alias("fn"),
        pairs("t0", "p0").alias("tn"),
    )


def with_f1(counts: DataFrame) -> DataFrame:
    """F1 of counts, NULL where there was nothing to count."""
    pairs = sum((F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "fp", "fn", "tn")), F.lit(0))
    return counts.withColumn("f1", F.when(pairs > 0, f1(F.col("tp"), F.col("fp"), F.col("fn"))))


def retrain_decision(scored: DataFrame, threshold: float = RETRAIN_BELOW_F1) -> DataFrame:
    """(f1, retrain): retrain when the score is below the threshold; without a score, don't."""
    return scored.select("f1", F.coalesce(F.col("f1") < F.lit(threshold), F.lit(False)).alias("retrain"))
