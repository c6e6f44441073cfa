"""V1-V16 and M1-M4 (FIXTURES B, C, D)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.conform import LEVELS_KEY, TooManyLevelsError, distinct_levels, ml_conform
from tablewright.operators.model import (
    DataModel,
    Field,
    ValidationError,
    failure_rows,
    report,
    row_check,
    table_check,
    validate,
)


class DummyModel(DataModel):
    _pre_rename = {"misspelled": "float32_col"}
    float_col = Field("double")
    float32_col = Field("float")
    int_col = Field("bigint", nullable=True)
    date_col = Field("timestamp")
    bool_col = Field("boolean", nullable=True)


BASE_SCHEMA = "float_col double, float32_col double, int_col double, date_col timestamp_ntz, bool_col boolean"
BASE_ROWS = [
    (1.2, 2.0, 2.0, datetime(2025, 1, 1), True),
    (0.0, -3.0, -3.0, datetime(2025, 1, 2), False),
    (3.14, 42.0, None, datetime(2025, 1, 3), None),
]
EXPECTED_COLUMNS = ["float_col", "float32_col", "int_col", "date_col", "bool_col"]


@pytest.fixture()
def base(spark):
    return spark.createDataFrame(BASE_ROWS, BASE_SCHEMA)


def test_renames_columns(base):
    out = validate(base.withColumnRenamed("float32_col", "misspelled"), DummyModel)
    assert out.columns == EXPECTED_COLUMNS


def test_drops_extra_columns(base):
    out = validate(base.withColumn("extra_col", F.lit(1)), DummyModel)
    assert out.columns == EXPECTED_COLUMNS


def test_coerces_types(base):
    out = validate(base, DummyModel)
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types == {
        "float_col": T.DoubleType(), "float32_col": T.FloatType(), "int_col": T.LongType(),
        "date_col": T.TimestampType(), "bool_col": T.BooleanType(),
    }
    got = {r.float_col: (r.float32_col, r.int_col, r.bool_col) for r in out.collect()}
    assert got == {1.2: (2.0, 2, True), 0.0: (-3.0, -3, False), 3.14: (42.0, None, None)}
    naive = out.select(F.col("date_col").cast("timestamp_ntz").alias("d")).orderBy("d").collect()
    assert [r.d for r in naive] == [datetime(2025, 1, d) for d in (1, 2, 3)]


def test_converts_zoned_text_to_utc(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0, f"2025-01-0{d}T00:00:00+01:00", True) for d in (1, 2, 3)],
        "float_col double, float32_col double, int_col double, date_col string, bool_col boolean")
    out = validate(df, DummyModel).select(F.col("date_col").cast("timestamp_ntz").alias("d"))
    assert sorted(r.d for r in out.collect()) == [datetime(2024, 12, 31, 23), datetime(2025, 1, 1, 23),
                                                 datetime(2025, 1, 2, 23)]


def test_empty_table_fails_non_empty(spark):
    with pytest.raises(ValidationError, match="non_empty"):
        validate(spark.createDataFrame([], BASE_SCHEMA), DummyModel)


def test_all_null_column_fails_at_least_one_value(base):
    with pytest.raises(ValidationError, match="at_least_one_value"):
        validate(base.withColumn("int_col", F.lit(None).cast("double")), DummyModel)


class Ordered(DataModel):
    _ordinal = "row_nr"
    row_nr = Field("bigint")
    x = Field("double")


@pytest.mark.parametrize("ordinal,ok", [([0, 1, 2], True), ([2, 0, 1], True), ([2, 0, 2], False),
                                        ([1, 2, 3], False), ([-1, 0, 1], False)])
def test_ordinal_must_be_zero_to_n_minus_one(spark, ordinal, ok):
    df = spark.createDataFrame([(o, 1.0) for o in ordinal], "row_nr bigint, x double")
    if ok:
        validate(df, Ordered)
    else:
        with pytest.raises(ValidationError, match="monotonically_increasing"):
            validate(df, Ordered)


def test_lossy_casts_are_failures(spark):
    class M(DataModel):
        i = Field("bigint", nullable=True)
        b = Field("boolean", nullable=True)
        u = Field("uint32", nullable=True)

    df = spark.createDataFrame([(5.5, 2, -1), (1.0, 1, 3), (float("nan"), 0, None)], "i double, b int, u int")
    rep = {(r.check, r.column): r.failed_rows for r in report(df, M).collect() if r.check.startswith("coerce")}
    assert rep == {("coerce_dtype('int64')", "i"): 1, ("coerce_dtype('bool')", "b"): 1,
                   ("coerce_dtype('uint32')", "u"): 1}
    out = {r.i for r in validate(df.where("b < 2 and (u >= 0 or u is null) and i <> 5.5"), M).collect()}
    assert out == {1, None}


def test_nan_is_missing_for_ranges(spark):
    class M(DataModel):
        x = Field("double", nullable=True, ge=0, lt=10)

    df = spark.createDataFrame([(float("nan"),), (5.0,), (11.0,)], "x double")
    rep = {r.check: r.failed_rows for r in report(df, M).collect()}
    assert rep["greater_than_or_equal_to(0)"] == 0 and rep["less_than(10)"] == 1


# FIXTURES D: the reference's sample raw model --------------------------------
FRUITS = ("Apple", "Banana", "Cherry", "Date")


class RawDataModel(DataModel):
    id = Field("bigint")
    date = Field("timestamp")
    col1 = Field("float", ge=0, lt=8000)
    col2 = Field("uint64", ge=0, nullable=True)
    col3 = Field("boolean", nullable=True)
    col4 = Field("category", levels=FRUITS, nullable=True)
    target = Field("double", nullable=True)
    _unique = {"identifiers_are_unique": ["id", "date"]}


def test_duplicate_identifier_pairs_fail(spark):
    df = spark.createDataFrame(
        [(0, "2024-01-01", 0, 0, 0, "Apple", 0), (1, "2024-01-01", 0, 0, 0, None, 0),
         (1, "2024-01-01", 0, 0, 0, None, 0)],
        "id bigint, date string, col1 bigint, col2 bigint, col3 bigint, col4 string, target bigint")
    with pytest.raises(ValidationError, match="identifiers_are_unique"):
        validate(df, RawDataModel)
    flagged = failure_rows(df, RawDataModel).select("id", "failed_checks").collect()
    assert sorted((r.id, tuple(r.failed_checks)) for r in flagged) == [
        (1, ("identifiers_are_unique",)), (1, ("identifiers_are_unique",))]


def test_unknown_level_fails_or_nulls(spark):
    df = spark.createDataFrame([("Apple",), ("Kiwi",)], "c string")

    class Strict(DataModel):
        c = Field("category", levels=FRUITS)

    class Lenient(DataModel):
        c = Field("category", levels=FRUITS, on_unknown="null", nullable=True)

    with pytest.raises(ValidationError, match="coerce_dtype"):
        validate(df, Strict)
    assert sorted(r.c or "" for r in validate(df, Lenient).collect()) == ["", "Apple"]


def test_custom_checks_and_inheritance(spark):
    class Base(DataModel):
        a = Field("bigint")

    class Child(Base):
        b = Field("bigint")

        @row_check("a_below_b")
        def a_below_b(cls):
            return F.col("a") < F.col("b")

        @table_check("sum_positive")
        def sum_positive(cls):
            return F.sum("a") > 0

    assert list(Child.fields()) == ["a", "b"]
    df = spark.createDataFrame([(1, 2), (3, 1)], "a bigint, b bigint")
    rep = {r.check: (r.failed_rows, r.passed) for r in report(df, Child).collect()}
    assert rep["a_below_b"] == (1, False) and rep["sum_positive"] == (None, True)
    with pytest.raises(ValidationError, match="a_below_b"):
        validate(df, Child)


def test_report_is_one_aggregate_job_plus_one_per_unique_set(spark):
    df = spark.range(100).selectExpr("id", "cast(id % 7 as double) as x")

    class M(DataModel):
        id = Field("bigint")
        x = Field("double", ge=0)
        _unique = {"u": ["id"]}

    plan = report(df, M)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "Generate inline" in plan


# FIXTURES C: ML-conform -------------------------------------------------------
def test_ml_drops_zone_keeping_utc_wall_time(spark):
    class M(DataModel):
        _ml_conform = True
        col = Field("timestamp")

    df = spark.createDataFrame([("2025-04-02T03:00:00+02:00",)], "col string")
    out = validate(df, M)
    assert out.schema["col"].dataType == T.TimestampNTZType()
    assert out.collect()[0].col == datetime(2025, 4, 2, 1)


def test_ml_keeps_naive_timestamps(spark):
    class M(DataModel):
        _ml_conform = True
        col = Field("timestamp_ntz")

    df = spark.createDataFrame([(datetime(2025, 4, 2),)], "col timestamp_ntz")
    assert validate(df, M).collect()[0].col == datetime(2025, 4, 2)


def test_ml_boolean_nulls_become_false(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "col boolean")
    assert sorted(r.col for r in ml_conform(df).collect()) == [False, False, True]


def test_ml_strings_become_categories_and_others_stay(spark):
    df = spark.createDataFrame([("Foo", {"a": 1}), ("Bar", {}), ("Bay", None)], "col string, col2 map<string,int>")
    out = ml_conform(df, find_levels=True)
    assert out.schema["col"].metadata[LEVELS_KEY] == ["Bar", "Bay", "Foo"]
    assert out.schema["col2"].dataType == df.schema["col2"].dataType


def test_ml_numbers_become_double(spark):
    df = spark.createDataFrame([(2, 3.0, 4.0)], "col bigint, col2 float, col3 double")
    out = ml_conform(df)
    assert all(f.dataType == T.DoubleType() for f in out.schema.fields)
    assert tuple(out.collect()[0]) == (2.0, 3.0, 4.0)


def test_level_count_is_bounded(spark):
    df = spark.range(50).selectExpr("cast(id as string) as s")
    assert len(distinct_levels(df, "s", 50)) == 50
    with pytest.raises(TooManyLevelsError):
        distinct_levels(df, "s", 10)


def test_levels_are_bounded_only_when_asked(spark):
    df = spark.range(1500).selectExpr("cast(id as string) as s")
    assert len(distinct_levels(df, "s")) == 1500
    with pytest.raises(TooManyLevelsError):
        distinct_levels(df, "s", 1499)



def test_wrong_type_is_reported_not_raised_by_a_bound(spark):
    class Typed(DataModel):
        _coerce = False
        x = Field("bigint", ge=0)

    df = spark.createDataFrame([("abc",), ("5",)], "x string")
    rows = {r.check: r.passed for r in report(df, Typed).collect()}
    assert rows["dtype('int64')"] is False and "greater_than_or_equal_to(0)" not in rows
    with pytest.raises(ValidationError, match="to have type int"):
        validate(df, Typed)
