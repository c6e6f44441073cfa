"""Grid sweeps, seeded random search, successive halving and single overrides.

The training table is materialised once (a written table in the shared
folder, so a lost executor never forces the whole assembly again); every
combination is then a separate fit on it, run as concurrent Spark jobs. All
runs hang under one parent run (R5). Only the per-run scores come back to the
driver.
"""

from __future__ import annotations

import itertools
import math
import random
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.folds import key_text
from ..session import shared_dir
from .pipeline import fit, score
from .records import RunStore

RESULT_SCHEMA = "trial int, run_id string, params map<string,string>, train_score double"


def grid(choices: Mapping[str, Sequence]) -> list[dict]:
    """every combination, in the order of the choices."""
    keys = list(choices)
    return [dict(zip(keys, combo)) for combo in itertools.product(*[choices[k] for k in keys])]


def sample_trials(choices: Mapping[str, Sequence], n_trials: int, seed: int = 42) -> list[dict]:
    """F16: a seeded sample without replacement from the combinations.

    Combinations are drawn by number, so the whole product is never built.
    """
    total = math.prod(len(v) for v in choices.values())
    picked = range(total) if n_trials >= total else random.Random(seed).sample(range(total), n_trials)
    trials = []
    for number in picked:
        trial = {}
        for key, values in reversed(choices.items()):
            number, at = divmod(number, len(values))
            trial[key] = values[at]
        trials.append({k: trial[k] for k in choices})
    return trials


def materialise(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """Write the training table once and read it back (lineage cut)."""
    path = shared_dir(spark, "sweeps", uuid.uuid4().hex)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def sweep(
    spark: SparkSession,
    frame: DataFrame,
    trials: Sequence[dict],
    make_pipeline: Callable[[dict], Pipeline],
    *,
    target: str = "target",
    name: str = "sweep",
    description: str | None = None,
    parallelism: int = 8,
    store: RunStore | None = None,
) -> tuple[str, DataFrame]:
    """Fit and score each trial; returns ``(parent_run_id, results)``."""
    store = store or RunStore(spark)
    data = materialise(spark, frame)
    parent = store.start_parent(name, description)

    def run(i_trial):
        i, trial = i_trial
        model = fit(make_pipeline(trial), data)
        value = score(model, data, target)
        run_id = store.log_run(
            run_name=f"{name}_{i}", params=trial, train_score=value, parent_run_id=parent
        )
        return (i, run_id, {k: str(v) for k, v in trial.items()}, float(value))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(trials)))) as pool:
        rows = list(pool.map(run, enumerate(trials)))
    return parent, spark.createDataFrame(rows, RESULT_SCHEMA)


# ---------------------------------------------------------------------------
# F16: a search that spends its passes on the promising trials


SHARE = "__share"


def _with_share(frame: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """A seeded number in [0, 1) for every row: rows below a fraction are nested in those below a larger one."""
    digest = F.md5(F.concat(key_text(keys), F.lit(f":rung:{seed}")))
    return frame.withColumn(SHARE, F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32)))


def rungs(n_trials: int, eta: int, least: float) -> list[float]:
    """Fractions of the rows from the first rung to the last, which is all of them."""
    steps = max(0, math.ceil(math.log(max(n_trials, 1), eta) - 1e-9))
    return [max(least, float(eta) ** (k - steps)) for k in range(steps)] + [1.0]


def successive_halving(
    spark: SparkSession,
    frame: DataFrame,
    trials: Sequence[dict],
    make_pipeline: Callable[[dict], Pipeline],
    *,
    keys: Sequence[str],
    target: str = "target",
    name: str = "halving",
    eta: int = 3,
    least_fraction: float = 0.02,
    seed: int = 42,
    parallelism: int = 8,
    store: RunStore | None = None,
    parent_run_id: str | None = None,
) -> tuple[str, DataFrame]:
    """Search for the highest score; ``(parent_run_id, results)`` with one row a finished trial and rung.

    All trials are fitted on a small seeded fraction of the rows; the best ``1/eta`` of
    them go on to ``eta`` times as many, and so on. Rungs are nested, and the last one
    is the whole table, so the score that decides is always over all rows. Fits of a
    rung run as concurrent jobs.

    Every fit is logged below the parent with its rung. With ``parent_run_id`` of an
    interrupted search, what that one logged is read and not fitted again. Ties go to
    the earlier trial.
    """
    if not trials:
        raise ValueError("no trials")
    if eta < 2:
        raise ValueError("eta must be at least 2")
    store = store or RunStore(spark)
    data = materialise(spark, _with_share(frame, keys, seed))
    parent = parent_run_id or store.start_parent(name)
    done: dict[tuple[int, int], tuple[str, float]] = {}
    if parent_run_id:
        for r in store.runs().where(F.col("parent_run_id") == parent_run_id).collect():
            if "rung" in r.params and r.train_score is not None:
                done[int(r.params["rung"]), int(r.params["trial"])] = (r.run_id, r.train_score)
    alive, rows = list(range(len(trials))), []
    fractions = rungs(len(trials), eta, least_fraction)
    for rung, fraction in enumerate(fractions):
        part = (data if fraction >= 1 else data.where(F.col(SHARE) < fraction)).drop(SHARE)

        def run(i: int, rung=rung, part=part, fraction=fraction):
            if (rung, i) in done:
                return (rung, fraction, i, *done[rung, i])
            value = float(score(fit(make_pipeline(trials[i]), part), part, target))
            run_id = store.log_run(
                run_name=f"{name}_{rung}_{i}", train_score=value, parent_run_id=parent,
                params={**trials[i], "rung": rung, "trial": i, "fraction": fraction},
            )
            return rung, fraction, i, run_id, value

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(alive)))) as pool:
            found = list(pool.map(run, alive))
        rows += found
        left = max(1, math.ceil(len(trials) / eta ** (rung + 1) - 1e-9))
        best = sorted(found, key=lambda r: (math.isnan(r[4]), -r[4], r[2]))
        alive = sorted(r[2] for r in best[:left])
    params = [{k: str(v) for k, v in t.items()} for t in trials]
    out = [(rung, fraction, i, run_id, params[i], value) for rung, fraction, i, run_id, value in rows]
    return parent, spark.createDataFrame(
        out, "rung int, fraction double, trial int, run_id string, params map<string,string>, train_score double"
    )
