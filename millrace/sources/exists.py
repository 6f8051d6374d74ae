"""Does a path hold data, does a table exist."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty for a missing path."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def matching_paths(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below ``root`` that match a glob pattern, relative to it."""
    fs, p = _path(spark, f"{root}/{pattern}")
    found = fs.globStatus(p) or []
    depth = pattern.count("/") + 1
    return sorted("/".join(str(f.getPath()).split("/")[-depth:]) for f in found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of superseded data."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def data_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a folder with entries or a file; False for an empty or missing one.

    Errors other than a missing path (no permission, unknown file system) are raised: a
    writer that took them for "no data" could overwrite data.
    """
    return bool(child_names(spark, path))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
