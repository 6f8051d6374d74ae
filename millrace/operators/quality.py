"""Row rules: keep the rows that meet all of them, count those that do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _met(condition: str) -> Column:
    # A condition that evaluates to NULL is not met.
    return F.coalesce(F.expr(condition), F.lit(False))


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that meet every rule. A plain filter, so it serves batch and stream."""
    for condition in rules.values():
        df = df.where(F.expr(condition))
    return df


def _counts(rules: dict[str, str]) -> list[Column]:
    failed = [F.count_if(~_met(c)).alias(f"failed_{i}") for i, c in enumerate(rules.values())]
    return [F.count(F.lit(1)).alias("rows"), *failed]


def rule_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule: (rule, passed, failed), from a single pass over the rows."""
    one = df.agg(*_counts(rules))
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            (F.col("rows") - F.col(f"failed_{i}")).alias("passed"),
            F.col(f"failed_{i}").alias("failed"),
        )
        for i, name in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*entries)))


def observed(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, Observation]:
    """``df``, which counts its rows and those that break a rule while it is written."""
    counts = Observation()
    return df.observe(counts, *_counts(rules)), counts


def observed_counts(spark: SparkSession, counts: Observation, rules: dict[str, str]) -> DataFrame:
    """One row per rule (rule, passed, failed) of what has been written."""
    found = counts.get
    rows = [(name, found["rows"] - found[f"failed_{i}"], found[f"failed_{i}"]) for i, name in enumerate(rules)]
    return spark.createDataFrame(rows, "rule string, passed bigint, failed bigint")
