"""ML pipelines as ``pyspark.ml`` stages.

Steps are Estimators. The column steps fit into ``SQLTransformer`` models (a
projection that runs in the JVM); the final step assembles the remaining
feature columns into a vector and fits a regressor: Spark's own, or the unbounded
forest of ``forest.py``. A fitted pipeline is a flat ``PipelineModel``, so Spark ML
persistence saves and loads it as is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import (
    Center,
    ColumnTransformer,
    ImputeConstant,
    OneHot,
    build_transformers,
    by_dtype,
)
from .forest import DeepForestRegressor

FEATURES = "features"
PREDICTION = "prediction"


class ColumnStep(Estimator):
    """A :class:`ColumnTransformer` as a pipeline stage; fits to ``SQLTransformer``."""

    def __init__(self, transformer: ColumnTransformer):
        super().__init__()
        self.transformer = transformer

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        return SQLTransformer(statement=self.transformer.fit_statement(dataset))


class RegressorStep(Estimator):
    """Vector-assemble every non-carried column in order, then fit ``estimator``."""

    def __init__(self, estimator, label: str, carry: Sequence[str] = ()):
        super().__init__()
        self.estimator = estimator
        self.label = label
        self.carry = list(carry)

    def feature_columns(self, dataset: DataFrame) -> list[str]:
        skip = set(self.carry) | {self.label}
        return [c for c in dataset.columns if c not in skip]

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        cols = self.feature_columns(dataset)
        if not cols:
            raise ValueError("no feature columns left for the regressor")
        nulls = dataset.where(dataset[f"`{self.label}`"].isNull()).limit(1).count()
        if nulls:
            raise ValueError(
                f"target {self.label!r} has null values; filter them (P1) before fitting"
            )
        assembler = VectorAssembler(inputCols=cols, outputCol=FEATURES, handleInvalid="error")
        est = self.estimator.copy(
            {self.estimator.featuresCol: FEATURES, self.estimator.labelCol: self.label}
        )
        if est.hasParam("keyCols") and not est.getOrDefault("keyCols"):
            # draws follow the identifiers of a row, wherever it lies
            est.set(est.keyCols, [c for c in self.carry if c in dataset.columns and c != self.label])
        model = est.fit(assembler.transform(dataset))
        return PipelineModel(stages=[assembler, model])


def deep_forest(seed: int = 42, num_trees: int = 100, **kw) -> DeepForestRegressor:
    """all features per split, bootstrap, fixed seed, trees grown until their leaves are pure."""
    return DeepForestRegressor(numTrees=num_trees, seed=seed, **kw)


def random_forest(seed: int = 42, num_trees: int = 100, max_depth: int = 12, **kw) -> RandomForestRegressor:
    """Spark's own forest, for a model of bounded depth (at most 30) and size.

    All features per split, bootstrap, fixed seed; splits are on binned values.
    Node ids are cached and checkpointed (to the shared checkpoint folder); 512 MB
    per iteration means fewer passes per level.
    """
    return RandomForestRegressor(
        numTrees=num_trees,
        maxDepth=max_depth,
        featureSubsetStrategy="all",
        bootstrap=True,
        subsamplingRate=1.0,
        seed=seed,
        cacheNodeIds=True,
        checkpointInterval=10,
        maxMemoryInMB=512,
        **kw,
    )


def linear_regression() -> LinearRegression:
    """ordinary least squares, exact normal-equation solve."""
    return LinearRegression(regParam=0.0, elasticNetParam=0.0, solver="normal", fitIntercept=True)


def column_steps(
    *,
    label: str = "target",
    carry: Sequence[str] = ("id", "date"),
    center: Sequence[str] = ("spend", "clicks"),
    selected: Sequence[str] | None = None,
    handle_unknown: str = "error",
) -> list[ColumnStep]:
    """The column steps of the ``prod`` model (everything but the regressor).

    impute numeric nulls with 0 -> centre ``center`` and one-hot the categories
    -> keep ``selected`` in order (all columns when None).
    """
    carried = [*carry, label]
    preprocessing = ColumnStep(
        ColumnTransformer(
            build_transformers(numeric=dict(transformer=ImputeConstant(0.0), columns=by_dtype("number"))),
            remainder="passthrough",
            carry=carried,
        )
    )
    features = ColumnStep(
        ColumnTransformer(
            build_transformers(
                example=dict(transformer=Center(), columns=list(center)),
                ohe=dict(transformer=OneHot(handle_unknown), columns=by_dtype("category")),
            ),
            remainder="passthrough",
            carry=carried,
        )
    )
    steps = [preprocessing, features]
    if selected is not None:
        steps.append(
            ColumnStep(
                ColumnTransformer(
                    build_transformers(passthrough=dict(transformer="passthrough", columns=list(selected))),
                    remainder="drop",
                    carry=carried,
                )
            )
        )
    return steps


def make_model(
    name: str = "prod",
    *,
    label: str = "target",
    carry: Sequence[str] = ("id", "date"),
    center: Sequence[str] = ("spend", "clicks"),
    selected: Sequence[str] | None = None,
    regressor=None,
    num_trees: int = 100,
    max_depth: int | None = None,
    handle_unknown: str = "error",
) -> Pipeline:
    """F8: the named model pipelines.

    ``prod``: :func:`column_steps` then a forest of unbounded trees (of Spark's
    bounded ones if ``max_depth`` is given). ``baseline``: linear regression on the
    numeric columns only. ``handle_unknown="ignore"`` lets rows
    with categories (or nulls) that were not fitted through as all zeros.
    """
    carried = [*carry, label]
    if name == "baseline":
        numeric = ColumnStep(
            ColumnTransformer(
                build_transformers(numeric=dict(transformer="passthrough", columns=by_dtype("number"))),
                remainder="drop",
                carry=carried,
            )
        )
        return Pipeline(stages=[numeric, RegressorStep(regressor or linear_regression(), label, carried)])
    if name != "prod":
        raise KeyError(f"unknown model {name!r}")
    stages = column_steps(label=label, carry=carry, center=center, selected=selected, handle_unknown=handle_unknown)
    if regressor is None:
        regressor = deep_forest(num_trees=num_trees) if max_depth is None else random_forest(num_trees=num_trees, max_depth=max_depth)
    return Pipeline(stages=[*stages, RegressorStep(regressor, label, carried)])


FIT_PARTITIONS = 32
FIT_ROWS = 1_000_000


def fit_partitions(n_rows: int) -> int:
    """Partitions of an iterative fit: at least ``FIT_PARTITIONS``, else one for ``FIT_ROWS`` rows.

    A function of the table alone, so that a seeded forest is the same on any cluster,
    that grows with it, so that a larger cluster has work for its cores.
    """
    return max(FIT_PARTITIONS, -(-n_rows // FIT_ROWS))


def laid_out(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Rows in ``partitions`` partitions by their keys, sorted inside each.

    The layout depends on the keys and the stated number only, not on the input's
    files or the size of the cluster, so a seeded forest is the same everywhere.
    """
    keys = [F.col(f"`{k}`") for k in keys]
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def _iterative(pipeline: Pipeline) -> bool:
    """Whether the regressor makes many passes (trees, L-BFGS) -- worth laying out for.

    The normal-equation solve is a single aggregate and a deep forest deals its
    rows itself; a layout would only add a shuffle.
    """
    stages = pipeline.getStages()
    last = stages[-1] if stages else None
    est = getattr(last, "estimator", None)
    if isinstance(est, LinearRegression):
        return est.getSolver() == "l-bfgs"
    return est is not None and not isinstance(est, DeepForestRegressor)


def fit(pipeline: Pipeline, df: DataFrame, *, partitions: int | None = None) -> PipelineModel:
    """Fit and flatten into one ``PipelineModel``.

    The last two stages are always the vector assembler and the regressor.
    Iterative fits read the rows laid out by the carried identifiers in
    ``partitions`` partitions (:func:`fit_partitions` of the number of rows).
    """
    if _iterative(pipeline):
        last = pipeline.getStages()[-1]
        keys = [c for c in last.carry if c in df.columns and c != last.label]
        df = laid_out(df, keys or df.columns, partitions or fit_partitions(df.count()))
    fitted = pipeline.fit(df)
    flat = []
    for stage in fitted.stages:
        flat.extend(stage.stages if isinstance(stage, PipelineModel) else [stage])
    return PipelineModel(stages=flat)


def require_fitted(model) -> PipelineModel:
    """only a fitted pipeline may score or predict."""
    if not isinstance(model, PipelineModel):
        raise TypeError(f"expected a fitted PipelineModel, got {type(model).__name__}")
    return model


def label_of(model: PipelineModel) -> str:
    return require_fitted(model).stages[-1].getLabelCol()


def _with_label(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The column steps carry the label through; at prediction time it is unknown."""
    label = label_of(model)
    if label in df.columns:
        return df
    return df.withColumn(label, F.lit(None).cast("double"))


def transform_until_last(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The output of every step but the regressor (named columns)."""
    return PipelineModel(stages=require_fitted(model).stages[:-2]).transform(_with_label(model, df))


def score(model: PipelineModel, df: DataFrame, label: str = "target") -> float:
    """R^2 of the model on ``df``."""
    predictions = require_fitted(model).transform(df)
    return RegressionEvaluator(labelCol=label, predictionCol=PREDICTION, metricName="r2").evaluate(predictions)


def predict(model: PipelineModel, df: DataFrame, keys: Sequence[str] = ("id", "date")) -> DataFrame:
    """identifiers and prediction, lazily; nothing goes to the driver."""
    out = require_fitted(model).transform(_with_label(model, df))
    return out.select(*[f"`{k}`" for k in keys], PREDICTION)
