"""Run log, model versions and the champion, as append-only tables.

Two Parquet tables below one folder: ``runs`` and ``model_versions``. Models are
saved with Spark ML persistence next to their signature and an input example.
The champion of a model name is its newest version (unconditionally, as in the
reference); the best run of a sweep is the child with the highest score.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_names, path_exists, shared_dir

RUNS_SCHEMA = (
    "run_id string, parent_run_id string, run_name string, description string, env string, "
    "training_cutoff date, params map<string,string>, train_score double, started_at timestamp"
)
VERSIONS_SCHEMA = (
    "model string, version bigint, path string, run_id string, training_cutoff date, created_at timestamp"
)
EXAMPLE_ROWS = 5


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or shared_dir(spark, "records")

    # tables -----------------------------------------------------------------
    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS_SCHEMA)

    def versions(self) -> DataFrame:
        return self._read("model_versions", VERSIONS_SCHEMA)

    def _append(self, name: str, row: tuple, schema: str) -> None:
        # One folder per record: concurrent runs of a sweep never share a
        # job's temporary folder, and a record is visible only once complete.
        self.spark.createDataFrame([row], schema).coalesce(1).write.parquet(
            f"{self.root}/{name}/{uuid.uuid4().hex}"
        )

    # R1 / R5 ----------------------------------------------------------------
    def start_parent(self, run_name: str, description: str | None = None, env: str | None = None) -> str:
        run_id = uuid.uuid4().hex
        self._append(
            "runs", (run_id, None, run_name, description, env, None, {}, None, _now()), RUNS_SCHEMA
        )
        return run_id

    def log_run(
        self,
        *,
        run_name: str,
        params: dict,
        train_score: float | None,
        training_cutoff: date | None = None,
        description: str | None = None,
        env: str | None = None,
        parent_run_id: str | None = None,
    ) -> str:
        run_id = uuid.uuid4().hex
        row = (
            run_id,
            parent_run_id,
            run_name,
            description,
            env,
            training_cutoff,
            {str(k): str(v) for k, v in params.items()},
            None if train_score is None else float(train_score),
            _now(),
        )
        self._append("runs", row, RUNS_SCHEMA)
        return run_id

    def log_runs(self, runs: Sequence[tuple[str, dict, float | None]], parent_run_id: str) -> list[str]:
        """Log many runs ``(name, params, score)`` of one parent in a single append."""
        ids = [uuid.uuid4().hex for _ in runs]
        rows = [
            (run_id, parent_run_id, name, None, None, None, {str(k): str(v) for k, v in params.items()},
             None if score is None else float(score), _now())
            for run_id, (name, params, score) in zip(ids, runs, strict=True)
        ]
        if rows:
            self.spark.createDataFrame(rows, RUNS_SCHEMA).coalesce(1).write.parquet(f"{self.root}/runs/{uuid.uuid4().hex}")
        return ids

    def best_child(self, parent_run_id: str) -> DataFrame:
        """The child run with the highest score (lazy, one row)."""
        return (
            self.runs()
            .where(F.col("parent_run_id") == parent_run_id)
            .agg(
                F.max_by("run_id", "train_score").alias("run_id"),
                F.max("train_score").alias("train_score"),
                F.count(F.lit(1)).alias("runs"),
            )
        )

    # R2 / R3 / R4 -------------------------------------------------------------
    def _claim_version(self, name: str) -> int:
        """The next version number, claimed by creating its marker file (atomic where ``create`` is)."""
        claims = f"{self.root}/models/{name}/claims"
        taken = [int(n) for n in list_names(self.spark, claims) if n.isdigit()]
        version = max(taken, default=0) + 1
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        while True:
            marker = jvm.org.apache.hadoop.fs.Path(f"{claims}/{version}")
            fs = marker.getFileSystem(conf)
            fs.mkdirs(marker.getParent())
            if fs.getScheme() == "file":
                # Hadoop's local file system checks and creates in two steps; this is one
                mine = jvm.java.io.File(fs.makeQualified(marker).toUri().getPath()).createNewFile()
            else:
                try:
                    fs.create(marker, False).close()
                    mine = True
                except Exception:  # noqa: BLE001  another registration was faster
                    if not fs.exists(marker):
                        raise
                    mine = False
            if mine:
                return version
            version += 1

    def register_model(
        self,
        name: str,
        model: PipelineModel,
        *,
        run_id: str,
        training_cutoff: date | None,
        example: DataFrame | None = None,
    ) -> int:
        version = self._claim_version(name)
        path = f"{self.root}/models/{name}/version={version}"
        model.write().save(f"{path}/model")
        if example is not None:
            self.save_signature(example, path)
        self._append(
            "model_versions", (name, version, path, run_id, training_cutoff, _now()), VERSIONS_SCHEMA
        )
        return version

    def save_signature(self, example: DataFrame, path: str) -> None:
        """Input schema (JSON) and the first rows as an example."""
        self.spark.createDataFrame([(example.schema.json(),)], "signature string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/signature")
        example.limit(EXAMPLE_ROWS).coalesce(1).write.mode("overwrite").parquet(f"{path}/input_example")

    def signature(self, path: str) -> str:
        return self.spark.read.parquet(f"{path}/signature").collect()[0].signature

    def check_signature(self, path: str, df: DataFrame) -> None:
        """The input must have every signature column with the same type."""
        import json

        from pyspark.sql import types as T

        expected = T.StructType.fromJson(json.loads(self.signature(path)))
        have = {f.name: f.dataType for f in df.schema.fields}
        problems = []
        for f in expected.fields:
            if f.name not in have:
                problems.append(f"missing column {f.name!r}")
            elif have[f.name] != f.dataType:
                problems.append(
                    f"column {f.name!r} is {have[f.name].simpleString()}, model expects {f.dataType.simpleString()}"
                )
        if problems:
            raise ValueError("input does not match the model signature: " + "; ".join(problems))

    def champions(self) -> DataFrame:
        """The newest version of every model name (lazy)."""
        return self.versions().groupBy("model").agg(
            F.max("version").alias("version"),
            F.max_by("path", "version").alias("path"),
            F.max_by("training_cutoff", "version").alias("training_cutoff"),
        )

    def champion_path(self, name: str) -> str:
        rows = self.champions().where(F.col("model") == name).collect()
        if not rows:
            raise KeyError(f"no registered version of model {name!r}")
        return rows[0].path

    def load_champion(self, name: str) -> PipelineModel:
        return PipelineModel.load(f"{self.champion_path(name)}/model")
