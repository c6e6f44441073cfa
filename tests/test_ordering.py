"""V12 by physical position, F14 in equal folds, S3 with long lists, Q9 as a clustered sink."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablewright.operators import folds
from tablewright.operators.folds import kfold_exact
from tablewright.operators.ordering import file_summary, order_report
from tablewright.plans.clustered import file_stats, read_range, write_clustered
from tablewright.sources import params
from tablewright.sources.params import run_sql

from .conftest import SF01


def _write(spark, path, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame([(x,) for x in part], "row_nr long").coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    return [f"{path}/{i}" for i in range(len(parts))]


@pytest.mark.parametrize(("parts", "failed"), [
    ([[0, 1, 2], [3, 4]], 0), ([[0, 2, 1], [3, 4]], 2), ([[3, 4], [0, 1, 2]], 5), ([[1, 2, 3]], 3),
    ([[0, None, 2]], 1), ([[0, 1, 1, 3]], 1), ([[0, 1], [2, 3, 4, 6]], 1),
])
def test_order_of_rows_in_files(spark, tmp_path, parts, failed):
    paths = _write(spark, str(tmp_path), parts)
    r = order_report(spark, "row_nr", *paths).collect()
    assert [(x.failed_rows, x.total_rows, x.passed) for x in r] == [(failed, sum(map(len, parts)), failed == 0)]


def test_a_table_in_order_is_read_once_without_a_shuffle_of_rows(spark):
    path = f"{SF01}/events.parquet"
    assert order_report(spark, "event_id", path).first().passed
    df = file_summary(spark, "event_id", path)
    assert [(r.start, r.n_rows, r["shift"]) for r in df.collect()] == [(0, 10_000, 0)]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "ReadSchema: struct<event_id:bigint,_tmp_metadata_row_index:bigint>" in text


def test_equal_folds(spark, monkeypatch):
    df = spark.range(10_003).withColumnRenamed("id", "k").withColumn("fold", F.lit("old"))
    got = kfold_exact(df, ["k"], 5, 42)
    sizes = sorted(r["count"] for r in got.groupBy("fold").count().collect())
    assert sizes == [2000, 2000, 2001, 2001, 2001] and got.columns == ["k", "fold"]
    one = {r.k: r.fold for r in got.collect()}
    monkeypatch.setattr(folds, "PREFIX_ROWS", 3)  # longer prefixes, same ranks
    assert {r.k: r.fold for r in kfold_exact(df.repartition(9), ["k"], 5, 42).collect()} == one
    assert {r.k: r.fold for r in kfold_exact(df, ["k"], 5, 1).collect()} != one
    twice = kfold_exact(spark.createDataFrame([(1,)] * 6 + [(None,)] * 5, "k long"), ["k"], 3)
    assert sorted(r["count"] for r in twice.groupBy("fold").count().collect()) == [3, 4, 4]
    assert kfold_exact(df.limit(0), ["k"], 3).collect() == []
    with pytest.raises(ValueError):
        kfold_exact(df, ["k"], 1)


@pytest.mark.parametrize("values", [
    (1, 5, 5, 9), (1, None, 7), (), (None, None), (2.5, 3.0, 4),
])
@pytest.mark.parametrize("what", ["k IN :ids", "k NOT IN :ids", "v > 3 AND k IN :ids"])
def test_long_lists_behave_like_literals(spark, monkeypatch, values, what):
    spark.createDataFrame([(i if i % 7 else None, i % 5) for i in range(30)], "k int, v int").createOrReplaceTempView("numbers")
    query = f"select k, v from numbers where {what}"
    want = sorted(map(tuple, run_sql(spark, query, {"ids": values}).collect()), key=str)
    monkeypatch.setattr(params, "LITERAL_LIMIT", -1)
    got = run_sql(spark, query, {"ids": values} if values else {"ids": ()})
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_long_lists_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(params, "LITERAL_LIMIT", 0)
    spark.sql("select 'a' as s, date'2024-01-02' as d, timestamp'2024-01-02 03:04:05' as t").createOrReplaceTempView("one")
    assert run_sql(spark, "select * from one where s in :x and d in :y and t in :z", {
        "x": ("a", "b"), "y": (date(2024, 1, 2),), "z": [datetime(2024, 1, 2, 3, 4, 5)]}).count() == 1
    with pytest.raises(TypeError):
        run_sql(spark, "select * from one where s in :x", {"x": ("a", 1)})


def test_a_hundred_thousand_ids_plan_as_a_join(spark):
    import time

    spark.range(1000).createOrReplaceTempView("ids_table")
    start = time.perf_counter()
    df = run_sql(spark, "select id from ids_table where id in :ids", {"ids": tuple(range(500, 100_500))})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 10 and "LeftSemi" in plan
    assert df.count() == 500


def test_clustered_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i * 37 % 1000, i % 3, f"x{i}") for i in range(4000)] + [(None, 1, "n")]
    df = spark.createDataFrame(rows, "k long, b int, s string")
    write_clustered(df, path, ["k", "b"], 8)
    stats = sorted(file_stats(spark, path).collect(), key=lambda r: r.file)
    assert len(stats) >= 6 and sum(r.n_rows for r in stats) == 4001 and sum(r.n_null for r in stats) == 1
    assert all(a.greatest is None or a.greatest <= b.least for a, b in zip(stats, stats[1:], strict=False))
    got = read_range(spark, path, 100, 120)
    assert len(got.inputFiles()) < len(stats)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] is not None and 100 <= r[0] <= 120)
    assert read_range(spark, path, 5000, 6000).count() == 0
    import pyarrow.parquet as pq

    ordered = [r for s in stats for r in pq.read_table(f"{path}/{s.file}").to_pylist()]
    key = [(-1 if r["k"] is None else r["k"], r["b"]) for r in ordered]
    assert key == sorted(key)
