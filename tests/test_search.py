"""Sweeps from shared moments, and successive halving."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.plans import experiments
from tablewright.plans.experiments import rungs, successive_halving
from tablewright.plans.moments import linear_sweep, moments
from tablewright.plans.pipeline import linear_regression, make_model
from tablewright.plans.records import RunStore


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 3)) * [1, 100, 1e-3] + [5, 1e6, 0]
    y = x @ [2.0, -0.03, 50.0] + rng.normal(size=900)
    rows = [(i, *map(float, r), float(r[0] + 2 * r[2]), 7.0, i % 3 == 0, float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, mix double, flat double, bit boolean, target double").cache()


def _least_squares(rows, cols):
    x = np.array([[float(r[c]) for c in cols] for r in rows]).reshape(len(rows), len(cols))
    y = np.array([r["target"] for r in rows])
    x = x - x.mean(axis=0)
    x = x / np.maximum(x.std(axis=0), 1e-12)
    fitted = x @ np.linalg.lstsq(x, y - y.mean(), rcond=1e-9)[0]
    return 1 - ((y - y.mean() - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def test_every_subset_equals_its_own_fit(spark, table):
    names = ["a", "b", "c", "mix", "flat", "bit"]
    found, rows = moments(table, names, "target"), table.collect()
    for n in range(1, 7):
        for cols in itertools.combinations(names, n):
            got = found.solve(cols)
            assert got.r2 == pytest.approx(_least_squares(rows, cols), abs=1e-8)
            if n == 6:
                predicted = got.predict(table).select("target", "prediction").collect()
                rss = sum((r.target - r.prediction) ** 2 for r in predicted)
                tss = np.var([r.target for r in predicted]) * len(predicted)
                assert 1 - rss / tss == pytest.approx(got.r2, abs=1e-6)
    assert found.solve([]).r2 == 0


def test_sweep_reads_the_table_once(spark, table):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        reads.add(1)
        return x

    frame = table.withColumn("a", seen("a"))
    trials = [{"cols": c} for n in (1, 2, 3) for c in itertools.combinations(["a", "b", "c"], n)] * 5
    parent, results = linear_sweep(spark, frame, trials, lambda t: t["cols"])
    assert reads.value == 900 and results.count() == 35
    children = RunStore(spark).runs().where(F.col("parent_run_id") == parent)
    assert children.count() == 35
    assert RunStore(spark).best_child(parent).first().train_score == max(r.train_score for r in results.collect())


def test_moments_refuse_what_a_fit_refuses(spark, table):
    with pytest.raises(ValueError, match="null or NaN"):
        moments(table.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), ["a", "b"], "target")
    with pytest.raises(ValueError, match="no rows"):
        moments(table.limit(0), ["a"], "target")
    with pytest.raises(ValueError, match="among"):
        moments(table, ["a", "target"], "target")
    assert np.isnan(moments(table.withColumn("target", F.lit(1.0)), ["a"], "target").solve(["a"]).r2)


def test_rungs():
    assert rungs(9, 3, 0.0) == pytest.approx([1 / 9, 1 / 3, 1.0])
    assert rungs(1, 3, 0.0) == [1.0] and rungs(10, 3, 0.2)[0] == 0.2
    assert len(rungs(10, 3, 0.0)) == 4


def _make(trial):
    return make_model("prod", selected=list(trial["cols"]), center=(), carry=("id",), regressor=linear_regression())


def test_halving_finds_the_best_of_the_grid_with_fewer_full_fits_and_resumes(spark, table, monkeypatch):
    frame = table.drop("bit")
    trials = [{"cols": c} for n in (1, 2, 3) for c in itertools.combinations(["a", "b", "c", "flat"], n)]
    parent, results = successive_halving(spark, frame, trials, _make, keys=["id"], eta=3, parallelism=4)
    rows = results.collect()
    full = [r for r in rows if r.fraction == 1.0]
    shared = moments(frame, ["a", "b", "c", "flat"], "target")
    scores = [shared.solve(t["cols"]).r2 for t in trials]
    winner = max(full, key=lambda r: r.train_score)
    assert scores[winner.trial] == pytest.approx(max(scores)) and winner.train_score == pytest.approx(max(scores), abs=1e-9)
    assert len(full) < len(trials) / 4 and len([r for r in rows if r.rung == 0]) == len(trials)

    # an interrupted search: only the first rung was logged; the rest is fitted, no more
    store = RunStore(spark)
    half = store.start_parent("half")
    for r in rows:
        if r.rung == 0:
            store.log_run(run_name="x", params={"rung": 0, "trial": r.trial}, train_score=r.train_score, parent_run_id=half)
    fits = []
    real = experiments.fit
    monkeypatch.setattr(experiments, "fit", lambda *a, **k: fits.append(1) or real(*a, **k))
    _, again = successive_halving(spark, frame, trials, _make, keys=["id"], eta=3, parallelism=1, parent_run_id=half)
    key = lambda r: (r.rung, r.trial, round(r.train_score, 9))
    assert sorted(map(key, again.collect())) == sorted(map(key, rows))
    assert len(fits) == len(rows) - len(trials)
