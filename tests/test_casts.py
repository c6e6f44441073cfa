"""V4: coercion is lossless or reported, checked against Python semantics (hypothesis)."""

import math
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.casts import coerce

doubles = st.lists(
    st.one_of(
        st.floats(allow_nan=True, allow_infinity=True),
        st.integers(min_value=-(2**40), max_value=2**40).map(float),
        st.sampled_from([0.0, 1.0, -1.0, 5.5, 2.0**63, -(2.0**63), 4294967295.0, 4294967296.0]),
    ),
    min_size=1, max_size=12,
)
texts = st.lists(
    st.one_of(st.integers(min_value=-(2**70), max_value=2**70).map(str),
              st.sampled_from(["1.5", "2.0", " 7", "abc", "", "1e3", "-0", "12x"])),
    min_size=1, max_size=12,
)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
LONG = (-(2**63), 2**63 - 1)
RANGES = {"bigint": LONG, "uint32": (0, 2**32 - 1)}


def _expected_int(x, dtype):
    lo, hi = RANGES[dtype]
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return True, None
    if isinstance(x, float) and (math.isinf(x) or x != math.floor(x)):
        return False, None
    v = int(x)
    return (lo <= v <= hi), (v if lo <= v <= hi else None)


def _run(spark, values, spark_type, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType(
        [T.StructField("i", T.LongType()), T.StructField("x", spark_type)]))
    value, ok = coerce(F.col("x"), spark_type, dtype)
    return {r.i: (r.ok, r.v) for r in df.select("i", ok.alias("ok"), value.alias("v")).collect()}


@SETTINGS
@given(values=doubles)
def test_double_to_integers(spark, values):
    for dtype in ("bigint", "uint32"):
        got = _run(spark, values, T.DoubleType(), dtype)
        for i, x in enumerate(values):
            assert got[i] == _expected_int(x, dtype), (dtype, x, got[i])


@SETTINGS
@given(values=texts)
def test_text_to_bigint(spark, values):
    got = _run(spark, values, T.StringType(), "bigint")
    for i, s in enumerate(values):
        try:
            d = Decimal(s.strip())
            whole = d == d.to_integral_value() and not s.strip().lower().count("e")
        except InvalidOperation:
            d, whole = None, False
        if d is None or not whole:
            # anything Spark cannot read exactly as a whole number must be reported
            assert got[i][0] is False or (d is not None and got[i][1] == int(d)), (s, got[i])
            continue
        v = int(d)
        if LONG[0] <= v <= LONG[1]:
            assert got[i] == (True, v), (s, got[i])
        else:
            assert got[i] == (False, None), (s, got[i])


@SETTINGS
@given(values=st.lists(st.integers(min_value=-3, max_value=3), min_size=1, max_size=8))
def test_integers_to_boolean(spark, values):
    got = _run(spark, values, T.LongType(), "boolean")
    for i, x in enumerate(values):
        assert got[i] == ((True, x == 1) if x in (0, 1) else (False, None)), (x, got[i])


def test_integer_bounds_of_doubles(spark):
    values = [2.0**63, -(2.0**63), 2.0**62, 4294967295.0, 4294967296.0, -1.0]
    big = _run(spark, values, T.DoubleType(), "bigint")
    assert [big[i] for i in range(6)] == [(False, None), (True, -(2**63)), (True, 2**62),
                                          (True, 4294967295), (True, 4294967296), (True, -1)]
    small = _run(spark, values, T.DoubleType(), "uint32")
    assert [small[i][0] for i in range(6)] == [False, False, False, True, False, False]


def test_text_is_never_rounded_into_an_integer(spark):
    texts_ = ["5.00000000001", "5.0", "5.", "+7", "5.0000000000000000000000000000000000000001", None]
    df = spark.createDataFrame([(t,) for t in texts_], "t string").coalesce(1)
    value, ok = coerce(F.col("t"), T.StringType(), "bigint")
    assert [(r.v, r.ok) for r in df.select(value.alias("v"), ok.alias("ok")).collect()] == [
        (None, False), (5, True), (5, True), (7, True), (None, False), (None, True)
    ]


def test_a_time_of_day_is_not_dropped_by_a_date(spark):
    rows = [("2024-01-01 13:45",), ("2024-01-01",), ("2024-01-01 00:00:00",), (None,), ("nonsense",)]
    df = spark.createDataFrame(rows, "t string").coalesce(1)
    value, ok = coerce(F.col("t"), T.StringType(), "date")
    assert [(str(r.v), r.ok) for r in df.select(value.alias("v"), ok.alias("ok")).collect()] == [
        ("None", False), ("2024-01-01", True), ("2024-01-01", True), ("None", True), ("None", False)
    ]
    stamps = df.selectExpr("try_cast(t as timestamp) as t")
    value, ok = coerce(F.col("t"), T.TimestampType(), "date")
    assert [r.ok for r in stamps.select(ok.alias("ok")).collect()] == [False, True, True, True, True]
