"""A keyed table kept as parquet folders, one per version.

``<root>/_snapshot=<n>/`` holds the partitions version n wrote, and Spark's ``_SUCCESS`` file in
it says that the write finished. A version replaces only the partitions it contains; the
current table is, for each partition, the newest finished version that has it. A merge
therefore reads and rewrites only the partitions its changes fall into, never a folder the
same plan reads, and a write that failed or is repeated leaves readers untouched.

A snapshot whose keys hold no date or number to partition by is dealt into buckets by a hash of its keys, so that
there, too, a merge rewrites only the buckets of its changes. The number of buckets is part of the folder names and
stays for the life of a snapshot.

One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.latest import DELETED, latest_by_key, with_deletes
from millrace.sources.exists import child_names, matching_paths, remove

# Folder names look like a partition, so that one scan can take folders of several versions.
PREFIX = "_snapshot="
BUCKETS = "bucket_of_"
# Up to this many partitions in a merge, every task writes its own file into each of them.
FEW_PARTITIONS = 4


def bucket_column(buckets: int) -> str:
    """The partition column of a snapshot that is dealt into ``buckets`` by its keys."""
    return f"{BUCKETS}{buckets}"


def _buckets(partition_by: Sequence[str]) -> int:
    name = partition_by[0] if len(partition_by) == 1 else ""
    return int(name.removeprefix(BUCKETS)) if name.startswith(BUCKETS) else 0


def with_bucket(rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """``rows`` with their bucket, where ``partition_by`` is a column of buckets."""
    buckets = _buckets(partition_by)
    if not buckets:
        return rows
    return rows.withColumn(partition_by[0], F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def folder_path(root: str, version: int) -> str:
    return f"{root}/{PREFIX}{version}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions, oldest first."""
    marks = matching_paths(spark, root, f"{PREFIX}*/_SUCCESS")
    return sorted(int(m.split("/")[0].removeprefix(PREFIX)) for m in marks)


def current_folders(spark: SparkSession, root: str, depth: int, below: int | None = None) -> dict[str, int]:
    """Partition path -> newest finished version holding it (older than ``below`` if given)."""
    finished = {v for v in versions(spark, root) if below is None or v < below}
    current: dict[str, int] = {}
    for path in matching_paths(spark, root, f"{PREFIX}*" + "/*=*" * depth):
        name, *partition = path.split("/")
        v = int(name.removeprefix(PREFIX))
        folder = "".join(f"/{p}" for p in partition)
        if v in finished and v >= current.get(folder, v):
            current[folder] = v
    return current


def read_snapshot(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    below: int | None = None,
    only: Iterable[str] | None = None,
    keep_deleted: bool = False,
) -> DataFrame:
    """The current rows; ``only`` restricts them to some partition folders.

    ``schema`` names the columns, partition columns included; an empty table has it too.
    """
    current = current_folders(spark, root, len(partition_by), below)
    wanted = current if only is None else {f: current[f] for f in only if f in current}
    stored = T.StructType(list(schema.fields))
    if DELETED not in stored.names:
        stored.add(DELETED, T.BooleanType())
    dealt = [c for c in partition_by if _buckets(partition_by) and c not in stored.names]
    for c in dealt:
        stored.add(c, T.IntegerType())
    by_version: dict[int, list[str]] = {}
    for folder, v in wanted.items():
        by_version.setdefault(v, []).append(f"{folder_path(root, v)}{folder}")
    if not by_version:
        rows = spark.createDataFrame([], stored)
    else:
        paths = [p for v in sorted(by_version) for p in by_version[v]]
        # With the root as base path the version shows up as a partition column; the given
        # schema leaves it out.
        rows = spark.read.schema(stored).option("basePath", root).parquet(*paths).select(*stored.names)
    rows = rows.drop(*dealt)
    if keep_deleted:
        return rows
    return rows.where(~F.coalesce(DELETED, F.lit(False))).drop(DELETED)


def write_version(
    df: DataFrame, root: str, version: int, partition_by: Sequence[str] = (), rebalance: bool = True
) -> None:
    """Write one version; the same version again replaces its earlier, unfinished self.

    ``rebalance`` brings the rows of a partition value together, and splits a large one, so
    that few files are written; it costs a shuffle.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder_path(root, version))


def touched_partitions(changes: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Partition folders the changes fall into: a list of dates, not of rows."""
    if not partition_by:
        return [""]
    pieces = [
        F.concat(F.lit(f"/{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        for c in partition_by
    ]
    return [r[0] for r in changes.select(F.concat(*pieces)).distinct().collect()]


def _same_layout(spark: SparkSession, root: str, version: int, partition_by: Sequence[str]) -> None:
    """Raise where earlier versions are partitioned by other columns: their rows would not be found."""
    earlier = [v for v in versions(spark, root) if v < version]
    for v in earlier[-1:]:
        names = {n.split("=")[0] for n in child_names(spark, folder_path(root, v)) if "=" in n}
        if names != set(partition_by[:1]):
            raise ValueError(f"{root} is partitioned by {sorted(names)}, not by {list(partition_by)}")


def merge_changes(
    changes: DataFrame,
    root: str,
    version: int,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    delete_when: str | None = None,
    drop: Sequence[str] = (),
) -> None:
    """Upsert ``changes`` into the snapshot as version ``version``.

    ``partition_by`` has to be part of the keys, so that a key never moves between
    partitions, or the ``bucket_column`` that the keys are dealt by. Changes and current rows of the touched partitions go through one
    newest-per-key aggregation, which also keeps an older change from replacing a newer
    row. Only versions below ``version`` are read: repeating a merge gives the same result.
    """
    spark = changes.sparkSession
    changes = with_bucket(changes, keys, partition_by)
    if _buckets(partition_by):
        keys = [*keys, *partition_by]
    _same_layout(spark, root, version, partition_by)
    for c in partition_by:
        kind = changes.schema[c].dataType
        if c not in keys or not isinstance(kind, (T.DateType, T.IntegralType)):
            raise ValueError(f"partition column {c} has to be a key and a date or whole number")
    if set(drop) & {*keys, *order}:
        raise ValueError("keys and order columns have to be stored")
    rows = with_deletes(changes, delete_when or "false").drop(*drop)
    touched = touched_partitions(changes, partition_by)
    if not touched:
        return
    current = read_snapshot(
        spark, root, rows.schema, partition_by, below=version, only=touched, keep_deleted=True
    )
    merged = latest_by_key(current.unionByName(rows), keys, order, keep_deleted=True)
    write_version(merged, root, version, partition_by, rebalance=len(touched) > FEW_PARTITIONS)


def expire(spark: SparkSession, root: str, partition_by: Sequence[str] = (), keep: int = 2) -> list[int]:
    """Remove versions none of whose partitions is current, except the newest ``keep``."""
    finished = versions(spark, root)
    in_use = set(current_folders(spark, root, len(partition_by)).values())
    old = [v for v in finished[:-keep] if v not in in_use]
    for v in old:
        remove(spark, folder_path(root, v))
    return old
