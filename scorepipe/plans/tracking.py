"""Runs, parameters, metrics and models as plain tables in a shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

import pyspark
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.operators.metrics import compare_runs
from scorepipe.operators.models import Fitted, score
from scorepipe.sources.tables import write_table

SCHEMAS = {
    "runs": "run_id STRING, experiment STRING, name STRING, started_at TIMESTAMP",
    "run_params": "run_id STRING, key STRING, value STRING",
    "run_metrics": "run_id STRING, key STRING, value DOUBLE",
    "models": "model_id STRING, run_id STRING, name STRING, path STRING, flavor STRING, library_version STRING, "
    "size_bytes BIGINT, created_at TIMESTAMP, features ARRAY<STRING>, label STRING",
}
LOGGED = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "recall_no_default", "recall_default"]


class RunStore:
    """Append-only tracking tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _append(self, table: str, rows: list[tuple]) -> None:
        frame = self.spark.createDataFrame(rows, SCHEMAS[table]).coalesce(1)
        frame.write.mode("append").parquet(f"{self.root}/{table}")

    def table(self, name: str) -> DataFrame:
        """One of the tables; empty while nothing was logged."""
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def start_run(self, experiment: str, name: str) -> str:
        run_id = uuid.uuid4().hex
        self._append("runs", [(run_id, experiment, name, dt.datetime.now(dt.timezone.utc))])
        return run_id

    def log_params(self, run_id: str, params: dict) -> None:
        self._append("run_params", [(run_id, str(k), str(v)) for k, v in params.items()])

    def log_metrics(self, run_id: str, values: dict[str, float]) -> None:
        self._append("run_metrics", [(run_id, k, None if v is None else float(v)) for k, v in values.items()])

    def log_model(self, run_id: str, fitted: Fitted, name: str) -> str:
        """Save the model below the store and record where it is, how large, and what wrote it."""
        model_id = f"m-{uuid.uuid4().hex}"
        path = fitted.save(f"{self.root}/artifacts/{model_id}")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        size = files.agg(F.sum("length")).first()[0]
        row = (model_id, run_id, name, path, fitted.kind, pyspark.__version__, size, dt.datetime.now(dt.timezone.utc), fitted.features, fitted.label)
        self._append("models", [row])
        return model_id

    def load_model(self, model_id: str) -> Fitted:
        """A logged model, ready to score: its pipeline holds the scaling of its inputs."""
        row = self.table("models").filter(F.col("model_id") == model_id).first()
        if row is None:
            raise KeyError(model_id)
        params = {r["key"]: r["value"] for r in self.table("run_params").filter(F.col("run_id") == row["run_id"]).collect()}
        return Fitted.load(self.spark, row["flavor"], row["path"], list(row["features"]), row["label"], params)

    def score_table(self, model_id: str, df: DataFrame, key: str, name: str) -> str:
        """Batch scoring: load a model, score a frame, replace the table by the result."""
        return write_table(score(self.load_model(model_id), df, key), name)

    def log_outcome(self, experiment: str, name: str, strategy: str | None, fitted: Fitted, summary: DataFrame, extra: dict = {}) -> str:
        """One run with its parameters, its six named metrics (a one-row frame) and its model."""
        run_id = self.start_run(experiment, name)
        params = {**fitted.params, **extra}
        if strategy:
            params["sampling_strategy"] = strategy
        self.log_params(run_id, params)
        self.log_metrics(run_id, summary.select(*LOGGED).first().asDict())
        self.log_model(run_id, fitted, artifact_name(fitted.kind, strategy))
        return run_id

    def compare(self, baseline: str, names: list[str] = LOGGED, experiment: str | None = None) -> DataFrame:
        """One row per run name with its metrics and their differences to the baseline run.

        Of runs with the same name the latest counts, as a whole; ``experiment`` leaves the others out.
        """
        runs = self.table("runs")
        if experiment is not None:
            runs = runs.filter(F.col("experiment") == experiment)
        latest = runs.groupBy("name").agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))
        if experiment is None and runs.select("experiment").distinct().count() > 1:
            raise ValueError("runs of several experiments; say which to compare")
        runs = latest.select("run_id", F.col("name").alias("run"))
        long = self.table("run_metrics").join(runs, "run_id").select("run", F.col("key").alias("metric"), "value")
        return compare_runs(long, baseline, names)


def artifact_name(kind: str, strategy: str | None) -> str:
    stem = kind if not strategy else f"{kind}_{strategy}"
    return stem.lower().replace(" ", "_")
