"""The shared test tables seen as activity data.

The tables have no NULL keys, no misfits and no late rows, so the views add them by
arithmetic on the row ids. Every view is one projection of one table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schema import ARRIVAL, CUSTOMER, DATE, PREDICTION, PREDICTION_DATE, RESCUED, TARGET

EVENTS_AS_OF = date(2024, 1, 31)
ORDERS_AS_OF = date(2001, 8, 1)

# Activity of the events table as declared at ingest: the event id is kept as tie-break.
EVENT_ACTIVITY = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField(CUSTOMER, T.LongType()),
        T.StructField("feature1", T.DoubleType()),
        T.StructField("feature2", T.DoubleType()),
        T.StructField("feature3", T.DoubleType()),
        T.StructField("feature4", T.StringType()),
        T.StructField(DATE, T.DateType()),
        T.StructField(TARGET, T.IntegerType()),
    ]
)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def events_glob(sf_dir: str) -> str:
    """Pattern that names just this table: a file stream cannot start at a single file."""
    return f"{sf_dir}/events.parque[t]"


def _k():
    return F.expr(r"""try_cast(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE)""")


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(events_path(sf_dir))
    i = F.col("event_id")
    return e.select(
        i,
        F.when(i % 50 != 0, F.col("user_id")).alias(CUSTOMER),
        F.col("value").alias("feature1"),
        _k().alias("feature2"),
        (F.col("value") - 3).alias("feature3"),
        F.col("event_type").alias("feature4"),
        F.col("ts").cast("date").alias(DATE),
        (F.col("event_type") == "purchase").cast("int").alias(TARGET),
        F.when(i % 37 == 0, F.col("props")).alias(RESCUED),
    )


def raw_events(e: DataFrame) -> DataFrame:
    """Events as a source would deliver them: text columns, values that do not fit, an extra column."""
    i = F.col("event_id")
    user = F.col("user_id").cast("string")
    return e.select(
        i,
        F.when(i % 41 == 0, F.concat(F.lit("u"), user)).when(i % 50 != 0, user).alias(CUSTOMER),
        F.when(i % 43 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("feature1"),
        _k().alias("feature2"),
        (F.col("value") - 3).alias("feature3"),
        F.col("event_type").alias("feature4"),
        F.col("ts").cast("date").cast("string").alias(DATE),
        (F.col("event_type") == "purchase").cast("int").alias(TARGET),
        F.when(i % 37 == 0, F.col("props")).alias("props"),
        *[c for c in e.columns if c == ARRIVAL],
    )


def activity_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias(CUSTOMER),
        F.col("o_totalprice").alias("feature1"),
        (F.col("o_orderkey") % 30).cast("double").alias("feature2"),
        (F.col("o_totalprice") - 250000).alias("feature3"),
        F.col("o_orderpriority").alias("feature4"),
        F.col("o_orderdate").cast("date").alias(DATE),
        (F.col("o_orderstatus") == "F").cast("int").alias(TARGET),
    )


def prediction_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the orders view: positive above a fixed price."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.col("o_custkey").alias(CUSTOMER),
        (F.col("o_totalprice") > 250000).cast("int").alias(PREDICTION),
        F.col("o_orderdate").cast("date").alias(PREDICTION_DATE),
    )


def prediction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions per event, with the value as a stand-in for the probability."""
    e = spark.read.parquet(events_path(sf_dir))
    return e.select(
        F.col("user_id").alias(CUSTOMER),
        (F.col("value") > 20).cast("int").alias(PREDICTION),
        F.col("value").alias("probability"),
        F.col("ts").cast("date").alias(PREDICTION_DATE),
    )


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stage changes: user = model, k = version."""
    e = spark.read.parquet(events_path(sf_dir))
    kind = F.col("event_type")
    return e.select(
        F.col("user_id").alias("model"),
        _k().cast("int").alias("version"),
        F.when(kind == "purchase", "Production")
        .when(kind == "signup", "Staging")
        .when(kind == "error", "Archived")
        .otherwise("None")
        .alias("stage"),
        F.col("event_id").alias("seq"),
    )


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs of experiments: customer = experiment, order = run."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.col("o_custkey").alias("experiment"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("end_time"),
    )
