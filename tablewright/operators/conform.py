"""M1-M4: convert a validated table to the four ML types.

Only four kinds of column leave this step: ``double`` (every numeric column,
identifiers included unless kept), ``boolean`` (nulls become false),
``string`` categories (levels recorded in the column metadata) and
``timestamp_ntz`` (zoned timestamps as UTC wall time). Other types are left as
they are. One ``select``; nothing is computed unless levels must be found.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVELS_KEY = "levels"


class TooManyLevelsError(ValueError):
    """A category column has more distinct values than allowed."""


def ml_conform(
    df: DataFrame,
    *,
    levels: Mapping[str, Sequence[str]] | None = None,
    keep: Sequence[str] = (),
    find_levels: bool = False,
    max_levels: int | None = None,
) -> DataFrame:
    """Apply M1-M4 in one projection.

    ``levels`` gives declared categories; with ``find_levels=True`` the levels
    of the other string columns are computed (a distinct per column, bounded
    by ``max_levels``). Columns in ``keep`` are passed through untouched.
    """
    levels = dict(levels or {})
    if find_levels:
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StringType) and f.name not in levels and f.name not in keep:
                levels[f.name] = distinct_levels(df, f.name, max_levels)
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        dt = f.dataType
        if f.name in keep:
            out.append(col)
        elif isinstance(dt, T.TimestampType):  # M1
            out.append(col.cast(T.TimestampNTZType()).alias(f.name))
        elif isinstance(dt, T.BooleanType):  # M2
            out.append(F.coalesce(col, F.lit(False)).alias(f.name))
        elif isinstance(dt, T.StringType):  # M3
            meta = {LEVELS_KEY: list(levels[f.name])} if f.name in levels else {}
            out.append(col.alias(f.name, metadata=meta))
        elif isinstance(dt, T.NumericType):  # M4
            out.append(col.cast(T.DoubleType()).alias(f.name))
        else:
            out.append(col)
    return df.select(*out)


def distinct_levels(df: DataFrame, column: str, max_levels: int | None = None) -> list[str]:
    """Sorted distinct non-null values of a column, by a grouped distinct (partial per partition).

    The levels become columns or column metadata, so they must fit a schema; a
    caller that wants more than ``max_levels`` of them to be an error says so.
    """
    values = df.select(F.col(f"`{column}`").alias("v")).where(F.col("v").isNotNull()).distinct()
    if max_levels is not None:
        values = values.limit(max_levels + 1)
    rows = values.collect()
    if max_levels is not None and len(rows) > max_levels:
        raise TooManyLevelsError(f"column {column!r} has more than {max_levels} levels")
    return sorted(r.v for r in rows)


def column_levels(df: DataFrame, column: str) -> list[str] | None:
    """Levels recorded in the metadata of a category column, if any."""
    meta = df.schema[column].metadata
    return list(meta[LEVELS_KEY]) if LEVELS_KEY in meta else None
