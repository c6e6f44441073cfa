"""F15/F16 for linear models: any number of trials from one pass over the rows.

A least-squares fit needs of its table only the means and the cross-products of the
features and the target. ``moments`` gets those of all columns at once, in one
aggregate with stable partial sums; every trial, a subset of the columns, is then a
sub-matrix solved on the driver (its size is the number of columns, never of rows),
and its R2 follows from the same numbers. Centring or scaling a feature changes
neither, so trials that differ in that share a solution.

Columns that are constant or depend on others get the least-norm solution, as a
pseudo-inverse gives it: the predictions, and so R2, are those of any solution. Rows
with a null or NaN in a column are refused, as fitting on them would be.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import RunStore

RESULT_SCHEMA = "trial int, run_id string, params map<string,string>, train_score double"
# Directions whose share of a correlation matrix's spread is below this count as dependent.
RCOND = 1e-10


@dataclass
class Moments:
    """``n`` rows, ``means`` and mean cross-products ``cov`` of ``columns``; the last one is the target."""

    columns: list[str]
    n: int
    means: np.ndarray
    cov: np.ndarray

    def solve(self, features: Sequence[str]) -> Solution:
        """The least-squares fit on some of the columns."""
        at = [self.columns.index(c) for c in features]
        y = len(self.columns) - 1
        spread = np.sqrt(np.diag(self.cov))
        scale = np.where(spread > 0, spread, 1.0)[at]
        inner = self.cov[np.ix_(at, at)] / np.outer(scale, scale)
        with_y = self.cov[at, y] / scale
        values, vectors = np.linalg.eigh(inner) if at else (np.zeros(0), np.zeros((0, 0)))
        keep = values > RCOND * max(values.max(initial=0.0), 1e-300)
        along = vectors[:, keep].T @ with_y
        coefficients = (vectors[:, keep] @ (along / values[keep])) / scale
        explained = float(np.sum(along * along / values[keep]))
        total = self.cov[y, y]
        r2 = explained / total if total > 0 else float("nan")
        intercept = float(self.means[y] - coefficients @ self.means[at])
        return Solution(list(features), coefficients, intercept, r2)


@dataclass
class Solution:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    r2: float

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        out = F.lit(self.intercept)
        for c, b in zip(self.features, self.coefficients, strict=True):
            out = out + F.col(f"`{c}`").cast("double") * F.lit(float(b))
        return df.withColumn(name, out)


def moments(df: DataFrame, features: Sequence[str], target: str) -> Moments:
    """Means and cross-products of all columns, in one aggregate."""
    columns = [*dict.fromkeys(features), target]
    if target in features:
        raise ValueError(f"target {target!r} is among the features")
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(v.isNull() | F.isnan(v)).alias(f"null_{i}") for i, v in enumerate(value)],
        *[F.avg(v).alias(f"mean_{i}") for i, v in enumerate(value)],
        *[F.covar_pop(value[i], value[j]).alias(f"c_{i}_{j}") for i, j in pairs],
    ).first()
    if not row["n"]:
        raise ValueError("no rows to fit")
    empty = [c for i, c in enumerate(columns) if row[f"null_{i}"]]
    if empty:
        raise ValueError(f"columns with null or NaN values: {empty}")
    cov = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c_{i}_{j}"]
    return Moments(columns, row["n"], np.array([row[f"mean_{i}"] for i in range(len(columns))]), cov)


def linear_sweep(
    spark: SparkSession,
    frame: DataFrame,
    trials: Sequence[dict],
    columns_of: Callable[[dict], Sequence[str]],
    *,
    target: str = "target",
    name: str = "linear_sweep",
    description: str | None = None,
    store: RunStore | None = None,
) -> tuple[str, DataFrame]:
    """Score least squares on the columns of every trial; ``(parent_run_id, results)`` as ``sweep`` gives them.

    The table is read once, however many trials there are. Runs are logged below
    one parent in a single append.
    """
    if not trials:
        raise ValueError("no trials")
    store = store or RunStore(spark)
    wanted = [list(columns_of(t)) for t in trials]
    shared = moments(frame, [c for cols in wanted for c in cols], target)
    solved: dict[frozenset, float] = {}
    for cols in wanted:
        key = frozenset(cols)
        if key not in solved:
            solved[key] = shared.solve(sorted(key)).r2
    scores = [solved[frozenset(cols)] for cols in wanted]
    parent = store.start_parent(name, description)
    ids = store.log_runs(
        [(f"{name}_{i}", trial, score) for i, (trial, score) in enumerate(zip(trials, scores, strict=True))], parent
    )
    rows = [
        (i, run_id, {k: str(v) for k, v in trial.items()}, float(score))
        for i, (run_id, trial, score) in enumerate(zip(ids, trials, scores, strict=True))
    ]
    return parent, spark.createDataFrame(rows, RESULT_SCHEMA)
