"""Lossless coercion as Column expressions (V4-V6).

``coerce(col, source_type, target)`` returns ``(value, ok)``: the converted
value and a flag that is false where a non-null input cannot be converted
without loss. Plain Spark casts are not enough: ``cast(5.5 as bigint)`` is 5,
``cast(2 as boolean)`` is true and ``NaN >= 0`` is true, so every rule below
first folds NaN to null and then tests the value before casting it.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names and their Spark storage types. Spark has no unsigned
# integers: uint32 is stored as bigint with a range check, uint64 as
# decimal(20,0) so that the whole range fits.
SPARK_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "category": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
}

# Names used in messages, after the pandas dtype each declared type stands for.
DISPLAY_NAMES = {
    "bigint": "int64",
    "int": "int32",
    "uint32": "uint32",
    "uint64": "uint64",
    "double": "float64",
    "float": "float32",
    "boolean": "bool",
    "string": "string",
    "category": "category",
    "timestamp": "datetime64[us, UTC]",
    "timestamp_ntz": "datetime64[us]",
    "date": "date",
}

_INT_RANGES = {
    "bigint": (-(2**63), 2**63 - 1),
    "int": (-(2**31), 2**31 - 1),
    "uint32": (0, 2**32 - 1),
    "uint64": (0, 2**64 - 1),
}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def spark_type(dtype: str) -> T.DataType:
    try:
        return SPARK_TYPES[dtype]
    except KeyError:
        raise ValueError(f"unknown declared type {dtype!r}; known: {sorted(SPARK_TYPES)}") from None


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def nan_to_null(col: Column, source: T.DataType) -> Column:
    """NaN is a value in Spark and a missing value in the reference; fold it."""
    if isinstance(source, _FRACTIONAL):
        return F.when(~F.isnan(col), col)
    return col


def coerce(
    col: Column,
    source: T.DataType,
    dtype: str,
    *,
    levels: Sequence[str] | None = None,
    on_unknown: str = "error",
) -> tuple[Column, Column]:
    """Convert ``col`` of type ``source`` to the declared ``dtype``.

    Returns ``(value, ok)``; ``ok`` is true for null input and for every input
    that converts without loss, and ``value`` is null wherever ``ok`` is false.
    """
    target = spark_type(dtype)
    x = nan_to_null(col, source)
    if source == target and dtype not in ("uint32", "uint64", "category"):
        return x, F.lit(True)  # already the declared type: nothing to convert

    if dtype in _INT_RANGES:
        lo, hi = _INT_RANGES[dtype]
        if isinstance(source, T.BooleanType):
            return x.cast(target), F.lit(True)
        if isinstance(source, T.StringType):
            # digits with at most zeros after the point: nothing is rounded on the way
            plain = F.regexp_extract(x, r"^\s*([+-]?\d+)(?:\.0*)?\s*$", 1)
            num = F.when(plain != "", plain).try_cast(T.DecimalType(38, 0))
        elif isinstance(source, _INTEGRAL + (T.DecimalType,) + _FRACTIONAL):
            num = x
        else:
            return F.lit(None).cast(target), x.isNull()
        if isinstance(source, _INTEGRAL) and dtype in ("bigint",):
            ok = F.lit(True)
        else:
            whole = num == F.floor(num) if not isinstance(source, _INTEGRAL) else F.lit(True)
            if isinstance(source, _FRACTIONAL):
                # compare as doubles against the exclusive bound hi + 1 (a power
                # of two, exact in a double); hi itself would round up to it
                in_range = (num >= F.lit(float(lo))) & (num < F.lit(float(hi + 1)))
            else:
                in_range = (num >= F.lit(Decimal(lo))) & (num <= F.lit(Decimal(hi)))
            ok = whole & in_range
        ok = x.isNull() | F.coalesce(ok, F.lit(False))
        value = F.when(ok & x.isNotNull(), num.try_cast(target))
        return value, ok & (x.isNull() | value.isNotNull())

    if dtype in ("double", "float"):
        if isinstance(source, T.StringType):
            value = x.try_cast(target)
        elif is_numeric(source) or isinstance(source, T.BooleanType):
            value = x.cast(target)
        else:
            return F.lit(None).cast(target), x.isNull()
        value = nan_to_null(value, target)
        return value, x.isNull() | value.isNotNull()

    if dtype == "boolean":
        if isinstance(source, T.BooleanType):
            return x, F.lit(True)
        if is_numeric(source):
            ok = x.isNull() | x.isin(0, 1)
            return F.when(ok, x != 0), ok
        return F.lit(None).cast(target), x.isNull()

    if dtype == "string":
        return x.cast(target), F.lit(True)

    if dtype == "category":
        text = x if isinstance(source, T.StringType) else x.cast(T.StringType())
        if levels is None:
            return text, F.lit(True)
        known = text.isin(*levels)
        value = F.when(known, text)
        if on_unknown == "null":
            return value, F.lit(True)
        return value, x.isNull() | known

    if dtype in ("timestamp", "timestamp_ntz", "date"):
        if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            value = x.cast(target)
        elif isinstance(source, T.StringType):
            # Through a zoned timestamp so that offsets in the text are applied.
            parsed = x.try_cast(T.TimestampType()) if dtype != "date" else x.try_cast(T.DateType())
            value = parsed.cast(target)
        else:
            return F.lit(None).cast(target), x.isNull()
        ok = value.isNotNull()
        if dtype == "date" and not isinstance(source, T.DateType):
            # a time of day would be lost
            moment = x.try_cast(T.TimestampNTZType()) if isinstance(source, T.StringType) else x.cast(T.TimestampNTZType())
            ok = ok & F.coalesce(moment == value.cast(T.TimestampNTZType()), F.lit(False))
            value = F.when(ok, value)
        return value, x.isNull() | ok

    raise ValueError(f"no coercion rule for {dtype!r}")
