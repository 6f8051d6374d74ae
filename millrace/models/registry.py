"""Model versions and their stages, kept as two append-only parquet tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.latest import latest_by_key
from millrace.sinks.predictions import append_rows
from millrace.sources.exists import data_exists

VERSIONS = (
    "model string, version int, run_name string, user string, parameters string, tags string, "
    "signature string, path string, end_time timestamp"
)
EVENTS = "model string, version int, stage string, seq bigint, at timestamp, description string"

# A version moved into one of these stages archives its predecessors there.
EXCLUSIVE = ("Staging", "Production")
ARCHIVED = "Archived"


def latest_run(runs: DataFrame, order: Sequence[str] = ("end_time", "version")) -> DataFrame:
    """The newest run of one experiment."""
    return runs.orderBy(*[F.desc(c) for c in order]).limit(1)


def latest_runs(
    runs: DataFrame, experiment: Sequence[str], order: Sequence[str] = ("end_time", "version")
) -> DataFrame:
    """The newest run of every experiment."""
    return latest_by_key(runs, experiment, order)


def current_stages(
    events: DataFrame,
    model: str = "model",
    version: str = "version",
    stage: str = "stage",
    seq: str = "seq",
    exclusive: Sequence[str] = EXCLUSIVE,
) -> DataFrame:
    """(model, version, stage) after all stage events.

    A version is in the stage of its newest event, unless a later event moved another
    version of the model into that stage: then it is archived. Events are first reduced to
    one per (model, version, stage), which is all that both steps need.
    """
    last = events.groupBy(model, version, stage).agg(F.max(seq).alias(seq))
    own = latest_by_key(last, [model, version], [seq])
    holder = (
        last.where(F.col(stage).isin(*exclusive))
        .groupBy(model, stage)
        .agg(F.max(seq).alias("_holder"))
    )
    outdated = F.coalesce(F.col(seq) < F.col("_holder"), F.lit(False))
    return own.join(holder, [model, stage], "left").select(
        model, version, F.when(outdated, ARCHIVED).otherwise(F.col(stage)).alias(stage)
    )


class Registry:
    """Versions of fitted models below one folder. One writer at a time is assumed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _read(self, table: str, schema: str) -> DataFrame:
        path = f"{self.root}/{table}"
        if not data_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _append(self, table: str, schema: str, row: tuple) -> None:
        named = zip(row, (c.split() for c in schema.split(", ")))
        columns = [F.lit(v).cast(kind).alias(name) for v, (name, kind) in named]
        append_rows(self.spark.range(0, 1, 1, 1).select(*columns), f"{self.root}/{table}")

    def versions(self) -> DataFrame:
        return self._read("versions", VERSIONS)

    def events(self) -> DataFrame:
        return self._read("stage_events", EVENTS)

    def stages(self) -> DataFrame:
        """(model, version, stage, description) as of now."""
        told = latest_by_key(self.events(), ["model", "version"], ["seq"]).select(
            "model", "version", "description"
        )
        return current_stages(self.events()).join(told, ["model", "version"])

    def register(
        self,
        model: PipelineModel,
        data: DataFrame,
        name: str,
        run_name: str = "run",
        user: str = "batch",
        parameters: dict | None = None,
        tags: dict | None = None,
        stage: str = "Production",
        as_of: date | None = None,
    ) -> int:
        """Store a fitted model as the next version and move it to ``stage``."""
        newest = self.versions().where(F.col("model") == name).agg(F.max("version")).first()[0]
        version = (newest or 0) + 1
        path = f"{self.root}/models/{name}/version={version}"
        # A version folder without a row in the table is left over from a failed call.
        model.write().overwrite().save(path)
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        signature = json.dumps(
            {
                "inputs": json.loads(data.schema.json()),
                "outputs": json.loads(model.transform(data).select("prediction", "probability").schema.json()),
            }
        )
        row = (
            name, version, run_name, user, json.dumps(parameters or {}, sort_keys=True),
            json.dumps({"run_name": run_name, **(tags or {})}, sort_keys=True), signature, path, now,
        )
        self._append("versions", VERSIONS, row)
        self.transition(name, version, stage, user, as_of)
        return version

    def transition(
        self, name: str, version: int, stage: str, user: str = "batch", as_of: date | None = None
    ) -> None:
        """Move a version to a stage; versions that were there are archived by it."""
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        seq = (self.events().where(F.col("model") == name).agg(F.max("seq")).first()[0] or 0) + 1
        day = (as_of or now.date()).isoformat()
        description = f"Version {version} was moved to {stage} on {day} by {user}"
        row = (name, version, stage, seq, now, description)
        self._append("stage_events", EVENTS, row)

    def find(self, name: str, stage: str = "Production") -> tuple[int, str] | None:
        """(version, path) of the model now in a stage."""
        held = self.stages().where((F.col("model") == name) & (F.col("stage") == stage))
        row = (
            held.join(self.versions(), ["model", "version"])
            .orderBy(F.desc("version")).select("version", "path").first()
        )
        return (row["version"], row["path"]) if row else None

    def load(self, name: str, stage: str = "Production", train=None) -> PipelineModel:
        """The model in a stage; ``train`` is called first when there is none."""
        found = self.find(name, stage)
        if found is None and train is not None:
            train()
            found = self.find(name, stage)
        if found is None:
            raise LookupError(f"no version of {name} in stage {stage}")
        return PipelineModel.load(found[1])
