"""forests grown until their leaves are pure."""

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablewright.operators.folds import key_text
from tablewright.plans import forest
from tablewright.plans.forest import DeepForestRegressor, bag_weights, descend, grow


def _plain_tree(x, y, w):
    """Recursive exact growth with rational arithmetic; a function from a row to its leaf's mean."""
    rows = [(tuple(map(float, r)), Fraction(float(v)), Fraction(float(k))) for r, v, k in zip(x, y, w, strict=True)]

    def build(rows):
        total, sums = sum(k for _, _, k in rows), sum(k * v for _, v, k in rows)
        best = None
        if len({v for _, v, _ in rows}) > 1:
            for j in range(len(rows[0][0])):
                values = sorted({r[j] for r, _, _ in rows})
                for a, b in zip(values, values[1:], strict=False):
                    lw = sum(k for r, _, k in rows if r[j] <= a)
                    ls = sum(k * v for r, v, k in rows if r[j] <= a)
                    gain = ls * ls / lw + (sums - ls) ** 2 / (total - lw)
                    if best is None or gain > best[0]:
                        best = (gain, j, (a + b) / 2)
        if best is None:
            return lambda r: sums / total
        _, j, cut = best
        low, high = build([r for r in rows if r[0][j] <= cut]), build([r for r in rows if r[0][j] > cut])
        return lambda r: (low if r[j] <= cut else high)(r)

    return build(rows)


@pytest.mark.parametrize("seed", range(6))
def test_exact_growth_matches_a_plain_tree(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 60)), int(rng.integers(1, 4))
    x = rng.integers(0, [2, 5, 40][seed % 3], (n, k)).astype(float)
    # targets without equal gains at different cuts
    y, w = rng.integers(0, 1 << 20, n).astype(float), rng.integers(1, 4, n).astype(float)
    tree, plain = grow(x, y, w), _plain_tree(x, y, w)
    points = np.concatenate([x, rng.uniform(-1, 41, (50, k))])
    assert descend(tree, points) == pytest.approx([float(plain(tuple(p))) for p in points], rel=1e-12)


def test_growth_ends_on_hard_tables():
    assert grow(np.ones((50, 2)), np.arange(50.0), np.ones(50))["value"].tolist() == [24.5]
    assert len(grow(np.arange(50.0)[:, None], np.zeros(50), np.ones(50))["value"]) == 1
    x = np.array([[0.0], [np.nextafter(0, 1)], [1e300], [-1e300]])
    assert descend(grow(x, np.arange(4.0), np.ones(4)), x).tolist() == [0, 1, 2, 3]
    deep = np.arange(3000.0)[:, None]
    assert np.array_equal(descend(grow(deep, 2.0 ** (deep[:, 0] % 40), np.ones(3000)), deep), 2.0 ** (deep[:, 0] % 40))


@pytest.fixture(scope="module")
def table(spark):
    """Few kinds of rows, one of them a third of all, and one continuous column."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(1500):
        a, b = (0.0, 0.0) if i % 3 == 0 else (float(rng.integers(6)), float(rng.integers(5)))
        rows.append((i, a, b, float(i % 7 == 0) * i, float(rng.integers(100)) + 10 * a))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, target double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def _fit(df, **kw):
    kw = {"numTrees": 6, "keyCols": ["id"], **kw}
    return DeepForestRegressor(**kw)._set(labelCol="target").fit(df)


@pytest.mark.parametrize("bound", [100_000, 40])
def test_leaves_are_means_of_the_drawn_rows(spark, table, bound):
    model = _fit(table, rowBound=bound)
    if bound == 40:
        assert model.top.where("feature >= 0").count() > 6
        assert model.subtrees.count() > 6
    from pyspark.ml.functions import vector_to_array

    rows = table.select("a", "b", "c", "target", bag_weights(key_text(["id"]), 6, 42).alias("w"),
                        model.tree_predictions(vector_to_array("features")).alias("p")).collect()
    sums = defaultdict(lambda: [0.0, 0.0])
    for r in rows:
        for t in range(6):
            sums[t, r.a, r.b, r.c][0] += r.w[t] * r.target
            sums[t, r.a, r.b, r.c][1] += r.w[t]
    drawn = 0
    for r in rows:
        for t in range(6):
            s, w = sums[t, r.a, r.b, r.c]
            if w:
                drawn += 1
                assert r.p[t] == pytest.approx(s / w, rel=1e-12)
    assert drawn > 4000


def test_without_draws_all_trees_reproduce_the_group_means(spark, table):
    model = _fit(table, bootstrap=False, numTrees=2, rowBound=30)
    got = model.transform(table).groupBy("a", "b", "c").agg(F.avg("target").alias("m"), F.min("prediction").alias("lo"), F.max("prediction").alias("hi"))
    assert all(r.lo == r.hi == pytest.approx(r.m, rel=1e-12) for r in got.collect())


def test_groups_never_exceed_the_bound(spark, table, monkeypatch):
    sizes = []
    real = forest._finish

    def finish(t):
        if len(t) > 40:
            raise ValueError(f"{len(t)} rows in a group")
        return real(t)

    monkeypatch.setattr(forest, "_finish", finish)
    assert _fit(table, rowBound=40).subtrees.count() > 6
    assert sizes == []


def test_joined_predictions_equal_the_broadcast_ones(spark, table, monkeypatch):
    model = _fit(table, rowBound=40)
    want = {r.id: r.prediction for r in model.transform(table).collect()}
    monkeypatch.setattr(forest, "BROADCAST_BYTES", 0)
    got = {r.id: r.prediction for r in model.transform(table).collect()}
    assert got == pytest.approx(want, rel=1e-12)


def test_same_forest_on_any_layout_and_after_saving(spark, table, tmp_path):
    def predictions(model):
        return {r.id: r.prediction for r in model.transform(table).collect()}

    model = _fit(table)
    assert predictions(_fit(table.repartition(11, "c"))) == predictions(model)
    assert predictions(_fit(table, seed=7)) != predictions(model)
    pipeline = PipelineModel(stages=[model])
    pipeline.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert predictions(again.stages[0]) == predictions(model)
    assert again.stages[0].getLabelCol() == "target" and again.stages[0].getOrDefault("numTrees") == 6


def test_draws_are_poisson(spark):
    w = spark.range(20_000).select(F.explode(bag_weights(key_text(["id"]), 10, 1)).alias("w"))
    share = {r.w: r["count"] / 200_000 for r in w.groupBy("w").count().collect()}
    assert share[0] == pytest.approx(0.3679, abs=0.01) and share[1] == pytest.approx(0.3679, abs=0.01)
    assert share[2] == pytest.approx(0.1839, abs=0.01)


def test_empty_table_is_refused(spark, table):
    with pytest.raises(ValueError, match="no rows"):
        _fit(table.limit(0))


def test_a_large_model_never_passes_the_driver(spark, table, monkeypatch):
    """Prediction and the values of single trees with every broadcast from Python refused and no subtree in a broadcast."""
    from pyspark.ml.functions import vector_to_array

    model = _fit(table, numTrees=2, rowBound=300)
    want = {r.id: r.p for r in table.select("id", model.tree_predictions(vector_to_array("features")).alias("p")).collect()}
    monkeypatch.setattr(forest, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(forest.DeepForestModel, "_broadcast_trees", lambda self: pytest.fail("trees sent from the driver"))
    with pytest.raises(ValueError, match="too large"):
        model.tree_predictions(F.col("features"))
    out = model.with_tree_values(table, "said")
    assert out.columns == [*table.columns, "said"]
    assert {r.id: list(r.said) for r in out.collect()} == want
    predicted = model.transform(table)
    assert {r.id: r.prediction for r in predicted.collect()} == {i: sum(p) / 2 for i, p in want.items()}
    assert "BroadcastExchange" not in predicted._jdf.queryExecution().executedPlan().toString()


def test_equal_rows_grow_as_one(spark, monkeypatch):
    """A table of few kinds is handed off at once however many rows it has, and its trees are the same."""
    seen = []
    real = forest.grow_forest
    monkeypatch.setattr(forest, "grow_forest", lambda rows, k, n, folder, **kw: (seen.append((n, rows.count())), real(rows, k, n, folder, **kw)))
    rows = spark.range(600).selectExpr("id", "double(id % 3) AS a", "double(id % 2) AS target")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    model = _fit(df, numTrees=2, bootstrap=False, rowBound=6)
    assert seen == [(6, 12)] and model.top.count() == 0
    assert {r.prediction for r in model.transform(df).collect()} == {0.5}


def test_large_trees_grow_from_rows_read_once(spark, table, monkeypatch):
    """Above the hand-off no row is dealt to every tree, and a node between two quantiles parts all the same."""
    real, finish = forest.grow_forest, forest._finish

    def without_rows(rows, k, n, folder, **kw):
        return real(rows.withColumn("tree", F.raise_error(F.lit("a row for every tree")).cast("int")), k, n, folder, **kw)

    def bounded(t):
        if len(t) > 25:
            raise ValueError(f"{len(t)} rows in a group")
        return finish(t)

    monkeypatch.setattr(forest, "grow_forest", without_rows)
    monkeypatch.setattr(forest, "_finish", bounded)
    monkeypatch.setattr(forest, "QUANTILES", 2)
    model = _fit(table, bootstrap=False, numTrees=2, rowBound=25)
    assert model.top.where("feature >= 0").count() > 20
    for size in (forest.BROADCAST_BYTES, 0):
        monkeypatch.setattr(forest, "BROADCAST_BYTES", size)
        got = model.transform(table).groupBy("a", "b", "c").agg(F.avg("target").alias("m"), F.min("prediction").alias("lo"), F.max("prediction").alias("hi"))
        assert all(r.lo == pytest.approx(r.m, rel=1e-12) and r.hi == pytest.approx(r.m, rel=1e-12) for r in got.collect())


def test_draws_are_those_of_the_digests(spark):
    from hashlib import md5

    got = spark.createDataFrame([("a",), ("",), (None,)], "key string").select("key", bag_weights(F.col("key"), 6, 7).alias("w")).collect()
    for r in got:
        want = [0] * 6
        for t in range(6 if r.key is not None else 0):
            draw = int(md5(f"{r.key}:7:{t // 4}".encode()).hexdigest()[8 * (t % 4):][:8], 16)
            want[t] = sum(draw >= c for c in forest.poisson_cuts())
        assert list(r.w) == want
