"""Incremental flows. Each call handles what arrived since its checkpoint and returns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.quality import observed, observed_counts, rule_counts
from millrace.sinks.snapshots import PREFIX, merge_changes
from millrace.sources import scan
from millrace.sources.exists import data_exists, matching_paths

# Folder of one micro-batch; not named like a partition, since its number is no column.
BATCH = "batch-"


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root}/{BATCH}{batch_id:09d}"


def _run(writer: DataStreamWriter, checkpoint: str, target: str, written: str) -> None:
    """Handle everything available.

    Micro-batches are numbered by the checkpoint. A new checkpoint starts from 0 again and would
    write over what an earlier one wrote, so it is refused where ``target`` holds ``written``.
    """
    spark = SparkSession.active()
    if not data_exists(spark, checkpoint) and matching_paths(spark, target, written):
        raise ValueError(f"{target} was written with another checkpoint than {checkpoint}; use that one, or a new target")
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_files(
    rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Append a stream to a parquet folder, each input file exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    _run(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint, path, "_spark_metadata")


def land_files(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame],
    rules: dict[str, str],
    counts: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> None:
    """Write new parquet files, whatever the schema of each, to a folder per micro-batch.

    ``shape`` brings the rows of one schema into the common one. Rule counts are stored per
    micro-batch below ``counts``. A micro-batch repeated after a failure replaces its folders.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        parts = [shape(rows) for rows in scan.by_schema(batch.sparkSession, batch)]
        if not parts:
            return
        # Counted in the pass that writes.
        rows, counted = observed(reduce(DataFrame.unionByName, parts), rules)
        rows.write.mode("overwrite").parquet(batch_folder(target, batch_id))
        found = observed_counts(batch.sparkSession, counted, rules)
        found.coalesce(1).write.mode("overwrite").parquet(batch_folder(counts, batch_id))

    files = scan.new_files(spark, path, files_per_batch, bytes_per_batch)
    _run(files.writeStream.foreachBatch(land), checkpoint, target, f"{BATCH}*")


def count_rules(rows: DataFrame, rules: dict[str, str], counts: str, checkpoint: str) -> None:
    """Store the rule counts of a stream per micro-batch; a repeated one replaces its own."""

    def store(batch: DataFrame, batch_id: int) -> None:
        rule_counts(batch, rules).coalesce(1).write.mode("overwrite").parquet(batch_folder(counts, batch_id))

    _run(rows.writeStream.foreachBatch(store), checkpoint, counts, f"{BATCH}*")


def stored_counts(spark: SparkSession, counts: str, rules: dict[str, str], after: int = -1) -> DataFrame:
    """One row per rule (rule, passed, failed), added over the micro-batches numbered above ``after``."""
    schema = "rule string, passed bigint, failed bigint"
    named = spark.createDataFrame([(r, 0, 0) for r in rules], schema)
    newer = [f"{counts}/{b}" for b in matching_paths(spark, counts, f"{BATCH}*") if int(b.removeprefix(BATCH)) > after]
    if newer:
        named = named.unionByName(spark.read.schema(schema).parquet(*newer))
    return named.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def last_batch(spark: SparkSession, root: str) -> int:
    """Number of the newest micro-batch with a folder below ``root``; -1 without any."""
    return max((int(b.removeprefix(BATCH)) for b in matching_paths(spark, root, f"{BATCH}*")), default=-1)


def upsert_snapshot(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    delete_when: str | None = None,
    drop: Sequence[str] = (),
) -> None:
    """Keep the newest row per key of a stream of changes in a snapshot.

    The snapshot itself is the state, so nothing grows in the streaming engine. Micro-batch
    n writes version n + 1 from the versions below it; a batch repeated after a failure
    writes the same version again.
    """

    if not set(order) - set(keys):
        raise ValueError("the order needs a column outside the keys to tell the newest row of a key")

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_changes(batch, root, batch_id + 1, keys, order, partition_by, delete_when, drop)

    _run(rows.writeStream.foreachBatch(merge), checkpoint, root, f"{PREFIX}*")
