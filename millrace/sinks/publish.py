"""Publish an online feature table: to a SQL database, or as a parquet snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sinks.snapshots import expire, read_snapshot, versions, write_version


def publish_jdbc(
    df: DataFrame, url: str, table: str, options: dict[str, str] | None = None,
    mode: str = "overwrite", connections: int = 16,
) -> None:
    """Write to a database table; overwrite keeps the table definition and grants.

    ``connections`` bounds how many tasks write at a time. Truncate and insert are not one
    transaction: where readers must not see a partly filled table, write to a staging table
    and swap the names in the database.
    """
    writer = df.write.mode(mode).option("truncate", "true").option("numPartitions", connections)
    writer.options(**(options or {})).jdbc(url, table)


def publish_snapshot(df: DataFrame, root: str, keep: int = 2) -> int:
    """Write the next full version of a published table and return its number."""
    spark = df.sparkSession
    version = max(versions(spark, root), default=0) + 1
    write_version(df, root, version)
    expire(spark, root, keep=keep)
    return version


def read_published(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return read_snapshot(spark, root, schema)
