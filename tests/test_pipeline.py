"""F8-F14, F18-F20 and R1-R5 on a small panel."""

from datetime import date, timedelta

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tablewright.functions.calendar import calendar_spine, prediction_window, training_window
from tablewright.operators.folds import kfold_assign
from tablewright.plans.experiments import grid, sample_trials, sweep
from tablewright.plans.pipeline import (
    fit,
    make_model,
    predict,
    random_forest,
    require_fitted,
    score,
    transform_until_last,
)
from tablewright.plans.records import RunStore


@pytest.fixture(scope="module")
def panel(spark):
    rows = []
    for i in range(60):
        rows.append((i % 6, date(2024, 1, 1) + timedelta(days=i // 6), float(i % 5), float(i % 3),
                     i % 2 == 0, ["a", "b", "c"][i % 3], float(2 * (i % 5) + (i % 3))))
    return spark.createDataFrame(
        rows, "id bigint, date date, spend double, clicks double, err boolean, top_type string, target double")


def test_prod_pipeline_fits_scores_and_predicts(spark, panel, tmp_path):
    model = fit(make_model("prod", selected=["spend", "clicks", "err", "top_type_a", "top_type_b"],
                           regressor=random_forest(num_trees=10, max_depth=5)), panel)
    assert score(model, panel) > 0.5
    assert transform_until_last(model, panel).columns == [
        "id", "date", "target", "spend", "clicks", "err", "top_type_a", "top_type_b"]
    preds = predict(model, panel.drop("target"))
    assert preds.columns == ["id", "date", "prediction"] and preds.count() == 60
    path = str(tmp_path / "m")
    model.write().save(path)
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(path)
    a = predict(model, panel).orderBy("id", "date").collect()
    b = predict(again, panel).orderBy("id", "date").collect()
    assert a == b


def test_layout_of_iterative_fits_grows_with_the_table():
    from tablewright.plans.pipeline import FIT_ROWS, fit_partitions

    assert [fit_partitions(n) for n in (0, 1, 32 * FIT_ROWS, 32 * FIT_ROWS + 1, 10**11)] == [32, 32, 32, 33, 100_000]


def test_baseline_is_linear_on_numbers(spark, panel):
    model = fit(make_model("baseline"), panel)
    assert score(model, panel) == pytest.approx(1.0)
    lr = model.stages[-1]
    assert list(lr.coefficients) == pytest.approx([2.0, 1.0])


def test_null_target_is_refused(spark, panel):
    with pytest.raises(ValueError, match="null"):
        fit(make_model("baseline"), panel.withColumn("target", F.lit(None).cast("double")))


def test_unfitted_pipeline_is_refused(panel):
    with pytest.raises(TypeError):
        require_fitted(make_model("prod"))
    with pytest.raises(TypeError):
        require_fitted(Pipeline(stages=[]))


def test_windows():
    assert training_window(date(2024, 1, 30), 30) == (date(2024, 1, 1), date(2024, 1, 30))
    assert prediction_window(date(2024, 1, 1), 60) == (date(2024, 1, 1), date(2024, 2, 29))
    with pytest.raises(ValueError):
        training_window(date.today() + timedelta(days=1), 5)
    with pytest.raises(ValueError):
        training_window(date(2024, 1, 1), 0)
    with pytest.raises(ValueError):
        prediction_window(date(2024, 1, 1), -3)


def test_spine_is_inclusive_and_uncapped(spark):
    spine = calendar_spine(spark, date(2020, 1, 1), date(2024, 12, 30))
    assert spine.count() == 1826


def test_folds_are_stable_and_balanced(spark):
    df = kfold_assign(spark.range(10_000).withColumnRenamed("id", "k"), ["k"], 5, 42)
    sizes = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1, 2, 3, 4} and min(sizes.values()) > 1800
    again = kfold_assign(spark.range(10_000).withColumnRenamed("id", "k").repartition(7), ["k"], 5, 42)
    assert df.join(again, ["k"]).where(df.fold != again.fold).count() == 0


def test_grid_and_search_trials():
    assert grid({"a": [1, 2], "b": [True, False]}) == [
        {"a": 1, "b": True}, {"a": 1, "b": False}, {"a": 2, "b": True}, {"a": 2, "b": False}]
    assert len(sample_trials({"n": [10, 50, 100, 500], "c": [True, False]}, 8)) == 8
    picked = sample_trials({"n": [1, 2, 3, 4], "c": [True, False]}, 3, seed=42)
    assert picked == sample_trials({"n": [1, 2, 3, 4], "c": [True, False]}, 3, seed=42) and len(picked) == 3


def test_records_champion_and_sweep(spark, panel, tmp_path):
    store = RunStore(spark, str(tmp_path / "rec"))
    model = fit(make_model("baseline"), panel)
    run = store.log_run(run_name="r", params={"a": 1}, train_score=0.5, training_cutoff=date(2024, 1, 10))
    assert store.register_model("m", model, run_id=run, training_cutoff=date(2024, 1, 10),
                                example=panel.drop("target")) == 1
    assert store.register_model("m", model, run_id=run, training_cutoff=date(2024, 1, 11)) == 2
    champ = store.champions().collect()
    assert [(r.model, r.version) for r in champ] == [("m", 2)]
    assert store.load_champion("m").stages[-1].coefficients == model.stages[-1].coefficients
    v1 = store.versions().where("version = 1").collect()[0].path
    assert "spend" in store.signature(v1)
    parent, results = sweep(spark, panel, grid({"center": [["spend"], ["clicks"]]}),
                            lambda t: make_model("baseline"), store=store, parallelism=2)
    assert results.count() == 2
    best = store.best_child(parent).collect()[0]
    assert best.runs == 2 and best.run_id is not None


def test_seeded_forest_is_reproducible(spark, panel):
    pipe = lambda: make_model("prod", selected=["spend", "clicks", "err"],
                              regressor=random_forest(num_trees=8, max_depth=4))
    a = predict(fit(pipe(), panel), panel).orderBy("id", "date").collect()
    b = predict(fit(pipe(), panel), panel).orderBy("id", "date").collect()
    assert a == b


def test_train_and_predict_end_to_end(spark, tmp_path):
    from tablewright.plans import panel as P
    from tablewright.plans.jobs import predict as predict_job, train
    from tablewright.plans.snapshot import SnapshotCache
    from tablewright.session import path_exists

    from .conftest import SF001

    P.register_events(spark, SF001)
    first, last = P.window(spark).values()
    store = RunStore(spark, str(tmp_path / "rec"))
    cache = SnapshotCache(spark, str(tmp_path / "snap"))
    pipe = make_model("prod", selected=["spend", "clicks", "err"], regressor=random_forest(num_trees=5, max_depth=4))
    result = train(spark, queries=P.panel_queries(), raw_model=P.EventPanelRaw,
                   processed_model=P.EventPanelProcessed, pipeline=pipe, training_cutoff=last,
                   num_samples=30, register_model="e2e", store=store, cache=cache, copy_raw=True)
    run = store.runs().where(F.col("run_id") == result.run_id).collect()[0]
    assert run.params["raw_data"].endswith("raw.parquet") and path_exists(spark, run.params["raw_data"])
    assert result.version == 1 and 0.0 <= result.score <= 1.0
    queries = {k: v for k, v in P.panel_queries().items() if k != "target"}
    out = predict_job(spark, queries=queries, raw_model=P.EventPanelInputs, processed_model=P.EventPanelPredict,
                      model_name="e2e", start_date=first, num_samples=30, store=store, cache=cache)
    assert out.columns == ["id", "date", "prediction"]
    assert out.count() == spark.sql("select count(distinct user_id) * 30 from events").collect()[0][0]
    again = train(spark, queries=P.panel_queries(), raw_model=P.EventPanelRaw,
                  processed_model=P.EventPanelProcessed, pipeline=pipe, training_cutoff=last,
                  num_samples=30, store=store, cache=cache)
    pointer = store.runs().where(F.col("run_id") == again.run_id).collect()[0].params["raw_data"]
    assert "/data/key=" in pointer and path_exists(spark, pointer)


def test_signature_mismatch_is_refused(spark, panel, tmp_path):
    store = RunStore(spark, str(tmp_path / "rec"))
    model = fit(make_model("baseline"), panel)
    store.register_model("sig", model, run_id="r", training_cutoff=None, example=panel.drop("target"))
    path = store.champion_path("sig")
    store.check_signature(path, panel)
    with pytest.raises(ValueError, match="spend"):
        store.check_signature(path, panel.withColumn("spend", F.col("spend").cast("string")))
    with pytest.raises(ValueError, match="missing column 'clicks'"):
        store.check_signature(path, panel.drop("clicks"))


def test_the_forest_depends_on_the_stated_layout_only(spark):
    """The same rows in other files and partitions give the same forest."""
    from tablewright.plans.pipeline import fit

    rows = [(i, float(i % 7), float(i % 3), float(i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, spend double, clicks double, target double")
    pipe = lambda: make_model("prod", selected=["spend", "clicks"], carry=["id"],
                              regressor=random_forest(num_trees=4, max_depth=4))
    totals = [
        sum(r.prediction for r in fit(pipe(), d).transform(df).orderBy("id").collect())
        for d in (df.repartition(1), df.repartition(2), df.repartition(13).orderBy("spend"))
    ]
    assert totals[0] == totals[1] == totals[2]


def test_versions_are_claimed_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = RunStore(spark, str(tmp_path / "claims"))
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: store._claim_version("m"), range(16)))
    assert sorted(got) == list(range(1, 17))


def test_fold_keys_never_share_a_text(spark):
    from tablewright.operators.folds import kfold_assign

    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None)], "x string, y string")
    folds = [r.fold for r in kfold_assign(df, ["x", "y"], n_splits=1_000_003).collect()]
    assert len(set(folds)) == 4
