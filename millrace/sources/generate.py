"""Synthetic activity batches."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.draws import choice, normal, uniform
from millrace.schema import ACTIVITY, CUSTOMER, DATE, TARGET

# Size and distributions of a generated batch.
SAMPLE_SIZE = 10_000
CUSTOMER_RANGE = (1, 100)
FEATURE1_MAX = 75
FEATURE2_MAX = 30
FEATURE3_MEAN, FEATURE3_SD = 3, 5
FEATURE4 = {"Low": 0.33, "Medium": 0.33, "High": 0.33, "Unknown": 0.01}
TARGETS = {0: 0.4, 1: 0.6}


def activity_for(ids: DataFrame, id_column: str, as_of: date) -> DataFrame:
    """One activity row per id, the same for an id however the ids are partitioned."""
    i = F.col(id_column)
    low, high = CUSTOMER_RANGE
    columns = {
        CUSTOMER: F.floor(low + uniform(i, 0) * (high - low)),
        "feature1": F.round(uniform(i, 1) * FEATURE1_MAX, 2),
        "feature2": F.round(uniform(i, 2) * FEATURE2_MAX, 2),
        "feature3": F.round(normal(i, 4, FEATURE3_MEAN, FEATURE3_SD), 2),
        "feature4": choice(uniform(i, 3), FEATURE4),
        DATE: F.lit(as_of),
        TARGET: choice(uniform(i, 6), TARGETS),
    }
    return ids.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in ACTIVITY.fields]
    )


def generate(
    spark: SparkSession, as_of: date, sample_size: int = SAMPLE_SIZE, seed: int = 0
) -> DataFrame:
    """A batch of ``sample_size`` rows for one date, made on the executors.

    The id of a row mixes in the date and the seed, so batches of different days
    differ and a rerun of a day gives the same batch.
    """
    ids = spark.range(sample_size).select(
        F.concat_ws("/", F.lit(f"{as_of.isoformat()}/{seed}"), F.col("id").cast("string")).alias("id")
    )
    return activity_for(ids, "id", as_of)
