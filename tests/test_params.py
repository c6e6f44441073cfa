"""Parameter binding and IN-list expansion."""

from datetime import date

import pytest

from tablewright.sources.params import bind_sql_params, markers, run_sql


def test_markers_skip_strings_comments_and_casts():
    q = "select ':no', x::int, `a:b` -- :gone\n from t where a = :yes /* :nope */ and b in :ids"
    assert markers(q) == ["yes", "ids"]


def test_tuple_expands_and_unused_are_ignored():
    text, args = bind_sql_params("select * from t where id in :ids and v >= :v", {"ids": (1, 2), "v": 3, "x": 9})
    assert "(:ids__0, :ids__1)" in text
    assert args == {"ids__0": 1, "ids__1": 2, "v": 3}


def test_empty_tuple_matches_nothing(spark):
    df = run_sql(spark, "select * from values (1), (2) as t(id) where id in :ids", {"ids": ()})
    assert df.count() == 0


def test_scalar_and_list_binding_runs(spark):
    df = run_sql(
        spark,
        "select id from values (1, date'2024-01-02'), (2, date'2024-01-05'), (3, date'2024-01-03') as t(id, d) "
        "where id in :ids and d <= :end;",
        {"ids": (1, 2, 3), "end": date(2024, 1, 3), "unused": "x"},
    )
    assert sorted(r.id for r in df.collect()) == [1, 3]


def test_in_list_is_pushed_into_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("t_push")
    df = run_sql(spark, "select id from t_push where id in :ids", {"ids": (1, 2)})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(id" in plan


def test_missing_parameter_raises(spark):
    with pytest.raises(Exception, match="UNBOUND|unbound"):
        run_sql(spark, "select :a as x", {"b": 1}).collect()


def test_date_columns_are_parsed(spark):
    from datetime import datetime

    from tablewright.sources.dates import parse_date_columns

    df = spark.createDataFrame([("2024-01-02", 86400, "x"), ("nope", 0, "y")], "date string, ts bigint, other string")
    out = parse_date_columns(df, names=("date", "ts"))
    rows = sorted(out.collect(), key=lambda r: r.other)
    assert rows[0].date == datetime(2024, 1, 2) and rows[1].date is None
    assert rows[0].ts == datetime(1970, 1, 2) and rows[1].ts == datetime(1970, 1, 1)
    assert out.schema["other"].dataType.simpleString() == "string"
