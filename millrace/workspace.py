"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster such a folder would exist on one machine only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared root, used by one run only."""
    return f"{shared_root(spark)}/millrace/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a run folder and read it from there; returns the folder too.

    Cuts the lineage, survives the loss of executors, and a later pass reads columns.
    """
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
