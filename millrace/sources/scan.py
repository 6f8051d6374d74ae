"""Reading activity data: files, file streams, named tables and date-bounded scans."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from millrace.schema import ARRIVAL, DATE

# Columns of Spark's file listing source; the contents are never asked for.
LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch scan of a folder or file in a named format."""
    return spark.read.format(fmt).load(path)


def infer_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType:
    """Column types of the files now in ``path``, to hand to a file stream."""
    return spark.read.format(fmt).load(path).schema


def stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Unbounded scan: each run picks up the files its checkpoint has not seen.

    ``files_per_batch``, or else ``bytes_per_batch``, bounds one micro-batch, which takes one file
    at least; without either a first run over a long history is a single batch.
    """
    reader = spark.readStream.format(fmt).schema(schema or infer_schema(spark, path, fmt))
    return _bounded(reader, files_per_batch, bytes_per_batch).load(path)


def _bounded(reader: DataStreamReader, files: int | None, size: int | None) -> DataStreamReader:
    # The source takes one of the two bounds.
    if files:
        return reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", size) if size else reader


def new_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Stream of the paths of files the checkpoint has not seen; it reads no file. Bounds as in ``stream``."""
    reader = spark.readStream.format("binaryFile").schema(LISTING)
    return _bounded(reader, files_per_batch, bytes_per_batch).load(path).select("path")


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    from pyarrow import parquet as pq

    for batch in batches:
        paths = batch.column("path").to_pylist()
        shapes = []
        for path in paths:
            files, place = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path[5:7] != "//" else path)
            with files.open_input_file(place) as opened:
                shapes.append("|".join(f"{f.name} {f.type}" for f in pq.read_schema(opened)))
        yield pa.RecordBatch.from_pydict({"path": paths, "shape": pa.array(shapes, pa.string())})


def by_schema(spark: SparkSession, files: DataFrame) -> list[DataFrame]:
    """The rows of some parquet files, one frame for the files of each schema.

    Tasks read the footers, through Arrow's file systems. Each frame has the columns and types of
    its own files, so that no column is lost and no type clashes, and ``ARRIVAL``: when a row came,
    by modification time, path and place in its file. No files give no frames. The paths come to
    the driver, as those of a micro-batch do anyway.
    """
    groups: dict[str, list[str]] = {}
    for row in files.select("path").mapInArrow(_shapes, "path string, shape string").collect():
        groups.setdefault(row["shape"], []).append(row["path"])
    arrival = F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    return [
        spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths).select("*", arrival.alias(ARRIVAL))
        for _, paths in sorted(groups.items())
    ]


def table(spark: SparkSession, name: str) -> DataFrame:
    """Scan of a named table; raises ``AnalysisException`` when it does not exist."""
    return spark.table(name)


def since(df: DataFrame, as_of: date, days: int, column: str = DATE) -> DataFrame:
    """Rows dated ``days`` before ``as_of`` or later.

    The bound is a typed date literal, so it reaches the scan as a partition or
    parquet filter.
    """
    return df.where(F.col(column) >= F.lit(as_of - timedelta(days=days)))


def between(df: DataFrame, start: date, end: date | None, column: str = DATE) -> DataFrame:
    """Rows in the half-open window [start, end), or from ``start`` on without an end."""
    kept = df.where(F.col(column) >= F.lit(start))
    return kept if end is None else kept.where(F.col(column) < F.lit(end))
