"""F12, F18-F20 and the train / predict jobs.

``train``: window -> ``fetch_data`` (snapshot, validation) -> process (P1, ML
types) -> keep the raw table (its snapshot location, or a copy: S8) -> fit ->
score -> log the run (R1) ->
register the model and make it champion (R2/R3) -> in ``dev`` also write the
transformed features (S9). ``predict``: window -> fetch -> process -> champion
-> predictions written or returned as a lazy frame keyed by the identifiers.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import PREDICTION_DAYS, TRAINING_DAYS, prediction_window, training_window
from ..operators.model import DataModel
from ..operators.process import process_frame
from ..session import shared_dir
from .pipeline import fit, predict as predict_rows, score as score_model, transform_until_last
from .records import RunStore
from .snapshot import SnapshotCache, fetch_data, write_parquet


def _keep_raw(raw: DataFrame, run_dir: str, copy_raw: bool) -> str:
    """Where the run's raw table lives.

    The fetched table already is a Parquet (zstd) snapshot, so by default the run
    records its location instead of writing a second copy of the whole table. It is
    leased from its fetch, and no purge deletes what the run log records;
    ``copy_raw=True`` writes ``raw.parquet`` into the run folder as the reference
    does.
    """
    if copy_raw:
        return write_parquet(raw, f"{run_dir}/raw.parquet")
    files = raw.inputFiles()
    return files[0].rsplit("/", 1)[0] if files else ""


def _proven(raw_model: type[DataModel], processed_model: type[DataModel]) -> list[str]:
    """Uniqueness checks of the processed model that the raw snapshot already passed."""
    raw_sets = {tuple(sorted(v)) for v in raw_model._unique.values()}
    return [n for n, cols in processed_model._unique.items() if tuple(sorted(cols)) in raw_sets]


@dataclass
class TrainResult:
    score: float
    run_id: str
    version: int | None
    model: PipelineModel
    run_dir: str


def _regressor_params(model) -> dict[str, str]:
    """Every parameter of the fitted regressor, as ``model.<name>``."""
    found = model.stages[-1].extractParamMap()
    return {f"model.{p.name}": str(v) for p, v in found.items()}


def train(
    spark: SparkSession,
    *,
    queries: Mapping[str, str],
    raw_model: type[DataModel],
    processed_model: type[DataModel],
    pipeline: Pipeline,
    target: str = "target",
    training_cutoff: date | None = None,
    num_samples: int = TRAINING_DAYS,
    register_model: str | None = None,
    run_name: str | None = None,
    run_description: str | None = None,
    env: str | None = None,
    filters: Sequence[Column] | None = None,
    params: Mapping[str, object] | None = None,
    store: RunStore | None = None,
    cache: SnapshotCache | None = None,
    parent_run_id: str | None = None,
    copy_raw: bool = False,
) -> TrainResult:
    start, end = training_window(training_cutoff, num_samples)
    raw = fetch_data(
        spark, {"start_date": start, "end_date": end}, queries, data_model=raw_model, cache=cache
    )
    if filters is None:
        filters = [F.col(f"`{target}`").isNotNull()]
    # fetch_data proved the identifiers unique; filters only drop rows
    frame = process_frame(
        raw, data_model=processed_model, filters=filters, proven_unique=_proven(raw_model, processed_model)
    )

    run_dir = shared_dir(spark, "runs", uuid.uuid4().hex)
    raw_location = _keep_raw(raw, run_dir, copy_raw)

    model = fit(pipeline, frame)
    score = score_model(model, frame, target)

    store = store or RunStore(spark)
    run_params = {"start_date": start, "end_date": end, "num_samples": num_samples,
                  "raw_data": raw_location, **_regressor_params(model), **dict(params or {})}
    run_id = store.log_run(
        run_name=run_name or f"train_{end.isoformat()}",
        description=run_description,
        env=env,
        training_cutoff=end,
        params=run_params,
        train_score=score,
        parent_run_id=parent_run_id,
    )
    version = None
    if register_model:
        version = store.register_model(
            register_model, model, run_id=run_id, training_cutoff=end, example=frame.drop(target)
        )
    if env == "dev":
        write_parquet(transform_until_last(model, frame), f"{run_dir}/transformed.parquet")
    return TrainResult(score=score, run_id=run_id, version=version, model=model, run_dir=run_dir)


def predict(
    spark: SparkSession,
    *,
    queries: Mapping[str, str],
    raw_model: type[DataModel],
    processed_model: type[DataModel],
    model: PipelineModel | None = None,
    model_name: str | None = None,
    keys: Sequence[str] = ("id", "date"),
    start_date: date | None = None,
    num_samples: int = PREDICTION_DAYS,
    store: RunStore | None = None,
    cache: SnapshotCache | None = None,
    output: str | None = None,
    copy_raw_to: str | None = None,
) -> DataFrame:
    """Predictions for the window; the model defaults to the champion."""
    start, end = prediction_window(start_date, num_samples)
    signature_path = None
    if model is None:
        if not model_name:
            raise ValueError("pass a fitted model or the name of a registered model")
        store = store or RunStore(spark)
        signature_path = store.champion_path(model_name)
        model = store.load_champion(model_name)
    raw = fetch_data(
        spark, {"start_date": start, "end_date": end}, queries, data_model=raw_model, cache=cache
    )
    if copy_raw_to:
        write_parquet(raw, copy_raw_to)
    frame = process_frame(raw, data_model=processed_model, proven_unique=_proven(raw_model, processed_model))
    if signature_path:
        store.check_signature(signature_path, frame)  # R4, before any prediction job
    out = predict_rows(model, frame, keys)
    if output:
        write_parquet(out, output)
        return spark.read.parquet(output)
    return out
