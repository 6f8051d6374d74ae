"""The predictions table, one folder per prediction date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.schema import CUSTOMER, PREDICTION, PREDICTION_DATE


def write_predictions(df: DataFrame, path: str) -> None:
    """Add the dates in ``df``; a date written before is replaced, so a rerun adds no copies."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PREDICTION_DATE)
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append to a parquet folder, creating it when it does not exist."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_predictions(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField(CUSTOMER, key_type or T.IntegerType()),
            T.StructField(PREDICTION, T.IntegerType()),
            T.StructField("probability", T.DoubleType()),
            T.StructField(PREDICTION_DATE, T.DateType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)
