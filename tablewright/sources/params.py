"""Bind ``:name`` parameters of a query to values.

Scalars are handed to ``spark.sql(text, args=...)`` as named parameters, so a
value is never pasted into the SQL text. A tuple (or list) value is expanded
the way an ``IN :ids`` list needs it: the marker becomes ``(:ids__0, :ids__1,
...)``; Catalyst then sees a plain ``In`` predicate and pushes it into the scan.
A list longer than ``LITERAL_LIMIT`` is not pasted into the plan: it becomes a
relation of its distinct values and the marker ``(SELECT value FROM ...)``, a semi
join whose side Spark broadcasts or shuffles by its measured size, with the null
rules of the literal form. Parameters the query does not use are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from typing import Union

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession

SqlPrimitive = Union[str, int, float, date, datetime]
SqlParam = Union[SqlPrimitive, tuple, list]
SqlParams = Mapping[str, SqlParam]

LITERAL_LIMIT = 1000

# Pieces of SQL text that may contain a colon without being a marker: string
# literals, quoted identifiers, comments, and ``::`` casts. Everything else that
# looks like ``:name`` is a marker.
_TOKENS = re.compile(
    r"""
    (?P<skip>
        '(?:[^'\\]|\\.|'')*'
      | "(?:[^"\\]|\\.|"")*"
      | `(?:[^`]|``)*`
      | --[^\n]*
      | /\*.*?\*/
      | ::
    )
    | (?<![\w:]):(?P<name>[A-Za-z_][A-Za-z0-9_]*)
    """,
    re.VERBOSE | re.DOTALL,
)


def markers(query: str) -> list[str]:
    """Names of the ``:name`` markers in ``query``, in order of appearance."""
    return [m.group("name") for m in _TOKENS.finditer(query) if m.group("name")]


def bind_sql_params(
    query: str, params: SqlParams | None = None, relations: Mapping[str, str] | None = None
) -> tuple[str, dict]:
    """Return ``(text, args)`` ready for ``spark.sql(text, args=args)``.

    Only parameters that appear as markers are bound; tuple values are
    expanded into one marker per element (an empty tuple becomes ``(NULL)``,
    which matches no row). ``relations`` names a view for each list that is bound
    as one.
    """
    params = dict(params or {})
    used = set(markers(query))
    args: dict[str, SqlPrimitive] = {}
    expand: dict[str, str] = {}
    for name, value in params.items():
        if name not in used:
            continue
        if relations and name in relations:
            expand[name] = f"(SELECT value FROM {relations[name]})"
        elif isinstance(value, (tuple, list)):
            parts = []
            for i, item in enumerate(value):
                key = f"{name}__{i}"
                args[key] = item
                parts.append(f":{key}")
            expand[name] = "(" + (", ".join(parts) if parts else "NULL") + ")"
        else:
            args[name] = value

    if not expand:
        return query, args

    def substitute(m: re.Match) -> str:
        name = m.group("name")
        if name and name in expand:
            return expand[name]
        return m.group(0)

    return _TOKENS.sub(substitute, query), args


def list_relation(spark: SparkSession, values: Sequence[SqlPrimitive]) -> str:
    """A temporary view ``value`` of the distinct values of a long list."""
    distinct = list(dict.fromkeys(values)) or [None]  # as the literal form of an empty list
    kinds = {type(v) for v in distinct if v is not None}
    if kinds == {int, float}:
        distinct = [v if v is None else float(v) for v in distinct]
    elif len(kinds) > 1:
        raise TypeError(f"a list holds values of several types: {sorted(k.__name__ for k in kinds)}")
    column = pa.array(distinct, pa.timestamp("us") if kinds == {datetime} else None)
    if not kinds:
        column = column.cast(pa.string())
    name = f"__list_{uuid.uuid4().hex}"
    spark.createDataFrame(pa.table({"value": column})).createOrReplaceTempView(name)
    return name


def run_sql(spark: SparkSession, query: str, params: SqlParams | None = None) -> DataFrame:
    """Run one parameterised query lazily (no job is started)."""
    used = set(markers(query))
    relations = {
        name: list_relation(spark, value)
        for name, value in dict(params or {}).items()
        if name in used and isinstance(value, (tuple, list)) and len(value) > LITERAL_LIMIT
    }
    text, args = bind_sql_params(query, params, relations)
    text = text.strip().rstrip(";").strip()
    out = spark.sql(text, args=args) if args else spark.sql(text)
    for name in relations.values():  # the plan holds the relation itself
        spark.catalog.dropTempView(name)
    return out
