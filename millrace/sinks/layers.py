"""Catalog names, comments and properties for the bronze folder and the silver snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from millrace.operators.latest import DELETED
from millrace.sinks.feature_tables import quoted
from millrace.sinks.snapshots import current_folders, folder_path
from millrace.sources.exists import table_exists


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def name_folder(
    spark: SparkSession, name: str, path: str, schema: T.StructType, comment: str, quality: str
) -> None:
    """A table over a folder a stream adds to, in folders of its micro-batches."""
    if table_exists(spark, name):
        spark.sql(f"REFRESH TABLE {name}")
        return
    spark.sql(
        f"CREATE TABLE {name} ({_columns(schema)}) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION {quoted(path)} "
        f"COMMENT {quoted(comment)} TBLPROPERTIES ('quality' = {quoted(quality)})"
    )


def name_snapshot(
    spark: SparkSession,
    name: str,
    root: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    comment: str,
    quality: str,
) -> None:
    """A view of the current rows of a snapshot.

    Below it is a table whose partitions point at the folders of their newest version; after
    a merge only the partitions it wrote are pointed anew.
    """
    files = f"{name}__files"
    current = current_folders(spark, root, len(partition_by))
    if not current:
        return
    dealt = [T.StructField(c, T.IntegerType()) for c in partition_by if c not in schema.names]
    stored = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType()), *dealt])
    if not table_exists(spark, files):
        by = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(
            f"CREATE TABLE {files} ({_columns(stored)}) USING parquet {by} LOCATION {quoted(root)} "
            "TBLPROPERTIES ('snapshot' = '0')"
        )
    known = int(spark.sql(f"SHOW TBLPROPERTIES {files} ('snapshot')").first()["value"])
    newer = {folder: v for folder, v in current.items() if v > known}
    if not partition_by:
        for folder, v in newer.items():
            spark.sql(f"ALTER TABLE {files} SET LOCATION {quoted(folder_path(root, v))}")
    else:
        known_parts = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {files}").collect()}
        added = []
        for folder, v in newer.items():
            part = folder.strip("/")
            pairs = [p.split("=", 1) for p in part.split("/")]
            spec = f"PARTITION ({', '.join(f'`{c}` = {quoted(value)}' for c, value in pairs)})"
            place = f"LOCATION {quoted(folder_path(root, v) + folder)}"
            if part in known_parts:
                spark.sql(f"ALTER TABLE {files} {spec} SET {place}")
            else:
                added.append(f"{spec} {place}")
        if added:
            spark.sql(f"ALTER TABLE {files} ADD {' '.join(added)}")
    newest = max(current.values())
    spark.sql(f"ALTER TABLE {files} SET TBLPROPERTIES ('snapshot' = '{newest}')")
    spark.sql(f"REFRESH TABLE {files}")
    listed = ", ".join(f"`{c}`" for c in schema.names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT {quoted(comment)} TBLPROPERTIES ('quality' = {quoted(quality)}) "
        f"AS SELECT {listed} FROM {files} WHERE NOT coalesce({DELETED}, false)"
    )
