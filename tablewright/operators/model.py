"""Declared data models, coercion and checks.

A data model is a Python class whose attributes are :class:`Field` declarations
and whose methods may add checks. Models inherit and combine like any Python
class; fields and checks are merged along the MRO.

Validation order: rename (V1) -> keep declared columns (V2) -> coerce (V4-V6) or
compare types (V7) -> checks. All scalar checks of a table run in **one**
aggregate; each uniqueness check is one grouped count; the report is the union
of those and is computed by a single action (V14). ``validate`` raises
:class:`ValidationError` listing every failed check; ``failure_rows`` (V15) tags
each row with the checks it fails.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import DISPLAY_NAMES, coerce, nan_to_null, spark_type

REPORT_SCHEMA = "check string, column string, failed_rows bigint, total_rows bigint, passed boolean"
# Columns whose name ends with "_" are exempt from the "has a value" check.
HAS_VALUE_PATTERN = re.compile(r"^.*[^_]$")


class ValidationError(ValueError):
    """One or more checks of a data model failed."""

    def __init__(self, message: str, failures: list[dict] | None = None):
        super().__init__(message)
        self.failures = failures or []


@dataclass(frozen=True)
class Field:
    """A declared column.

    ``dtype`` is one of the names in :data:`tablewright.functions.casts.SPARK_TYPES`.
    Bounds are checked after coercion and skip nulls. ``levels`` fixes the
    categories of a ``category`` column; an unknown level fails coercion, or
    becomes null with ``on_unknown="null"``.
    """

    dtype: str
    nullable: bool = False
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    lt: float | None = None
    levels: tuple[str, ...] | None = None
    on_unknown: str = "error"
    coerce: bool | None = None  # None: the model's ``_coerce``

    def __post_init__(self):
        spark_type(self.dtype)
        if self.levels is not None:
            object.__setattr__(self, "levels", tuple(self.levels))
        if self.on_unknown not in ("error", "null"):
            raise ValueError("on_unknown must be 'error' or 'null'")

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.dtype)


def row_check(name: str) -> Callable:
    """Declare a row-level check: ``fn(cls) -> Column`` of booleans.

    A row fails where the expression is false; null results are skipped.
    """

    def wrap(fn):
        fn.__check__ = ("row", name)
        return classmethod(fn)

    return wrap


def table_check(name: str) -> Callable:
    """Declare a table-level check: ``fn(cls) -> Column`` aggregate boolean."""

    def wrap(fn):
        fn.__check__ = ("table", name)
        return classmethod(fn)

    return wrap


class DataModel:
    """Base of all data models.

    Class options (override in subclasses):

    * ``_pre_rename`` -- ``{old: new}`` applied before anything else (V1)
    * ``_coerce`` -- convert to the declared types (V4) instead of requiring them (V7)
    * ``_strict`` -- ``"filter"`` drops undeclared columns (V2), ``True`` rejects them
    * ``_unique`` -- ``{check_name: [columns]}`` uniqueness checks (V13)
    * ``_ordinal`` -- optional column that must hold 0..n-1 (V12)
    * ``_ml_conform`` -- after the checks, convert to the four ML types (M1-M4)
    * ``_ml_keep`` -- columns the ML conversion leaves as they are (exact ids)
    """

    _pre_rename: dict[str, str] = {}
    _coerce: bool = True
    _strict: Any = "filter"
    _unique: dict[str, Sequence[str]] = {}
    _ordinal: str | None = None
    _ml_conform: bool = False
    _ml_keep: tuple[str, ...] = ()

    @classmethod
    def fields(cls) -> dict[str, Field]:
        out: dict[str, Field] = {}
        for klass in reversed(cls.__mro__):
            for name, value in vars(klass).items():
                if isinstance(value, Field):
                    out[name] = value  # an override keeps the inherited position
        return out

    @classmethod
    def checks(cls) -> list[tuple[str, str, Callable]]:
        found: dict[str, tuple[str, str, Callable]] = {}
        for klass in reversed(cls.__mro__):
            for attr, value in vars(klass).items():
                fn = getattr(value, "__func__", None)
                if fn is not None and hasattr(fn, "__check__"):
                    kind, name = fn.__check__
                    found[attr] = (kind, name, getattr(cls, attr))
        return list(found.values())

    @classmethod
    def schema(cls) -> T.StructType:
        return T.StructType(
            [T.StructField(n, f.spark_type, f.nullable) for n, f in cls.fields().items()]
        )

    @classmethod
    def category_levels(cls) -> dict[str, tuple[str, ...]]:
        return {n: f.levels for n, f in cls.fields().items() if f.dtype == "category" and f.levels}

    @classmethod
    def declaration(cls) -> dict:
        """Everything the model does to a table, as plain values: equal only for equal models.

        Checks are given by their expressions, so a changed body or bound shows.
        """
        return {
            "fields": [(n, repr(f)) for n, f in cls.fields().items()],
            "checks": [(kind, name, str(fn())) for kind, name, fn in cls.checks()],
            "unique": sorted((k, list(v)) for k, v in cls._unique.items()),
            "rename": sorted(cls._pre_rename.items()),
            "options": [repr(x) for x in (cls._coerce, cls._strict, cls._ordinal, cls._ml_conform, cls._ml_keep)],
        }

    # Convenience entry points -------------------------------------------------
    @classmethod
    def validate(cls, df: DataFrame, **kw) -> DataFrame:
        return validate(df, cls, **kw)

    @classmethod
    def report(cls, df: DataFrame, **kw) -> DataFrame:
        return report(df, cls, **kw)


# --------------------------------------------------------------------------
# Preparation: rename, select, coerce


@dataclass
class _Prepared:
    frame: DataFrame  # renamed, undeclared columns dropped
    checked: DataFrame  # coerced values under their names + raw inputs under _raw()
    ok: dict[str, Column]  # declared column -> lossless flag (over the raw inputs)
    declared: list[str]  # declared columns present, in input order
    missing: list[str]
    wrong_type: dict[str, str]  # column -> actual type
    extra: list[str]


def _q(name: str) -> str:
    return f"`{name}`"


def _raw(name: str) -> str:
    return f"__raw__{name}"


def _prepare(df: DataFrame, model: type[DataModel]) -> _Prepared:
    renames = {o: n for o, n in model._pre_rename.items() if o in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    fields = model.fields()
    extra = [c for c in df.columns if c not in fields]
    kept = [c for c in df.columns if c in fields]  # input order kept
    frame = df.select(*[_q(c) for c in kept]) if model._strict == "filter" else df
    types = {f.name: f.dataType for f in frame.schema.fields}
    values, ok, wrong = {}, {}, {}
    missing = [c for c in fields if c not in types]
    for name, fld in fields.items():
        if name not in types:
            continue
        src = types[name]
        col = F.col(_q(_raw(name)))
        if fld.coerce if fld.coerce is not None else model._coerce:
            values[name], ok[name] = coerce(
                col, src, fld.dtype, levels=fld.levels, on_unknown=fld.on_unknown
            )
        else:
            if src != fld.spark_type:
                wrong[name] = src.simpleString()
            values[name], ok[name] = nan_to_null(col, src), F.lit(True)
    raw = frame.select(*[F.col(_q(c)).alias(_raw(c)) for c in frame.columns])
    checked = raw.select(
        *[
            (values[c] if c in values else F.col(_q(_raw(c)))).alias(c)
            for c in frame.columns
        ],
        *[_q(_raw(c)) for c in frame.columns],
    )
    declared = [c for c in frame.columns if c in values]
    return _Prepared(frame, checked, ok, declared, missing, wrong, extra)


def coerced(df: DataFrame, model: type[DataModel]) -> DataFrame:
    """The renamed, filtered and coerced frame (lazy, no checks)."""
    prep = _prepare(df, model)
    return _coerced_frame(prep, model)


def _coerced_frame(prep: _Prepared, model: type[DataModel]) -> DataFrame:
    out = prep.checked.select(*[_q(c) for c in prep.frame.columns])
    if model._ml_conform:
        from .conform import ml_conform

        out = ml_conform(out, levels=model.category_levels(), keep=model._ml_keep)
    return out


# --------------------------------------------------------------------------
# Checks


@dataclass
class _Spec:
    check: str
    column: str | None
    fails: Column | None = None  # row-level: true where the row fails
    passed: Column | None = None  # table-level aggregate
    static_fail: bool = False  # schema failure, no data needed


def _row_specs(prep: _Prepared, model: type[DataModel]) -> list[_Spec]:
    fields = model.fields()
    specs: list[_Spec] = []
    for name in prep.missing:
        specs.append(_Spec("column_in_dataframe", name, static_fail=True))
    for name, actual in prep.wrong_type.items():
        specs.append(_Spec(f"dtype('{DISPLAY_NAMES[fields[name].dtype]}')", name, static_fail=True))
    if model._strict is True:
        for name in prep.extra:
            specs.append(_Spec("column_in_schema", name, static_fail=True))
    for name, fld in fields.items():
        if name not in prep.declared:
            continue
        v = F.col(_q(name))
        if name not in prep.wrong_type and (fld.coerce if fld.coerce is not None else model._coerce):
            specs.append(_Spec(f"coerce_dtype('{DISPLAY_NAMES[fld.dtype]}')", name, fails=~prep.ok[name]))
        if not fld.nullable:
            specs.append(_Spec("not_nullable", name, fails=v.isNull()))
        if name in prep.wrong_type:
            continue  # already failed on its type; comparing it could raise a cast error
        for op, bound in (("ge", fld.ge), ("gt", fld.gt), ("le", fld.le), ("lt", fld.lt)):
            if bound is None:
                continue
            test = {"ge": v >= bound, "gt": v > bound, "le": v <= bound, "lt": v < bound}[op]
            label = {
                "ge": "greater_than_or_equal_to",
                "gt": "greater_than",
                "le": "less_than_or_equal_to",
                "lt": "less_than",
            }[op]
            specs.append(_Spec(f"{label}({bound})", name, fails=v.isNotNull() & ~test))
    return specs


def _table_specs(prep: _Prepared, model: type[DataModel]) -> list[_Spec]:
    specs: list[_Spec] = []
    n = F.count(F.lit(1))
    for name in model.fields():
        if name in prep.declared and HAS_VALUE_PATTERN.match(name):
            specs.append(
                _Spec(
                    "has_at_least_one_value",
                    name,
                    passed=(F.count(F.col(_q(name))) > 0) | (n == 0),
                )
            )
    specs.append(_Spec("dataframe_is_non_empty", None, passed=n > 0))
    if model._ordinal and model._ordinal in prep.declared:
        o = F.col(_q(model._ordinal))
        specs.append(
            _Spec(
                "index_is_monotonically_increasing",
                model._ordinal,
                passed=(n == 0) | ((F.min(o) == 0) & (F.max(o) == n - 1) & (F.count(o) == n)),
            )
        )
    return specs


def _custom_specs(model: type[DataModel]) -> list[_Spec]:
    specs = []
    for kind, name, fn in model.checks():
        expr = fn()
        if kind == "row":
            specs.append(_Spec(name, None, fails=~F.coalesce(expr, F.lit(True))))
        else:
            specs.append(_Spec(name, None, passed=F.coalesce(expr, F.lit(False))))
    return specs


def _unique_sets(prep: _Prepared, model: type[DataModel]) -> dict[str, list[str]]:
    sets = {name: list(cols) for name, cols in model._unique.items()}
    if model._ordinal:
        sets["index_is_monotonically_increasing"] = [model._ordinal]
    return {k: v for k, v in sets.items() if all(c in prep.declared for c in v)}


def _check_plan(prep: _Prepared, model: type[DataModel], skip: Sequence[str]):
    """Aggregates for every scalar check and how each report row reads them.

    Returns ``(aggs, entries)``; an entry is ``(spec, failed_key, passed_key)``
    where a key names an aggregate (None: no value / statically failed).
    """
    specs = _row_specs(prep, model) + _table_specs(prep, model) + _custom_specs(model)
    specs = [s for s in specs if s.check not in skip]
    aggs = [F.count(F.lit(1)).alias("__n")]
    entries = []
    for i, s in enumerate(specs):
        if s.static_fail:
            entries.append((s, None, None))
        elif s.fails is not None:
            aggs.append(F.count_if(s.fails).alias(f"__c{i}"))
            entries.append((s, f"__c{i}", None))
        else:
            aggs.append(s.passed.alias(f"__p{i}"))
            entries.append((s, None, f"__p{i}"))
    return aggs, entries


def _unique_frame(values: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """One report row for a uniqueness set: a partial grouped count, then a sum."""
    return (
        values.groupBy(*[_q(c) for c in cols])
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0)).alias("failed_rows"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        )
        .select(
            F.lit(name).alias("check"),
            F.lit(",".join(cols)).alias("column"),
            F.col("failed_rows").cast("bigint").alias("failed_rows"),
            F.col("total_rows").cast("bigint").alias("total_rows"),
            (F.col("failed_rows") == 0).alias("passed"),
        )
    )


def report(df: DataFrame, model: type[DataModel], *, skip: Sequence[str] = ()) -> DataFrame:
    """One row per check -- ``check, column, failed_rows, total_rows, passed``.

    Lazy. When executed, every scalar check comes from one aggregate over the
    coerced values and every uniqueness check from one grouped count; nothing
    but the report rows reaches the driver.
    """
    prep = _prepare(df, model)
    sets = {k: v for k, v in _unique_sets(prep, model).items() if k not in skip}
    if len(sets) == 1 and not any(kind == "table" for kind, _, _ in model.checks()):
        return _report_one_pass(prep, model, skip, sets)
    return _report_two_pass(prep, model, skip, sets)


def _report_two_pass(
    prep: _Prepared, model: type[DataModel], skip: Sequence[str], sets: dict[str, list[str]]
) -> DataFrame:
    """One global aggregate plus one grouped count per uniqueness set."""
    values = prep.checked
    aggs, entries = _check_plan(prep, model, skip)
    summary = values.agg(*aggs)

    def failed(key):
        return F.col(key) if key else F.lit(None).cast("bigint")

    def passed(fkey, pkey):
        if fkey:
            return F.col(fkey) == 0
        return F.col(pkey) if pkey else F.lit(False)

    rows = F.array(
        *[
            F.struct(
                F.lit(s.check).alias("check"),
                F.lit(s.column).cast("string").alias("column"),
                failed(fkey).alias("failed_rows"),
                F.col("__n").alias("total_rows"),
                passed(fkey, pkey).alias("passed"),
            )
            for s, fkey, pkey in entries
        ]
    )
    out = summary.select(F.inline(rows))
    for name, cols in sets.items():
        out = out.unionByName(_unique_frame(values, name, cols))
    return out


def _report_one_pass(
    prep: _Prepared, model: type[DataModel], skip: Sequence[str], sets: dict[str, list[str]]
) -> DataFrame:
    """The report in a single pass when there is one uniqueness set.

    Every built-in check decomposes over groups: rows are grouped by the
    uniqueness columns (partial aggregation per partition, so a hot key is
    combined before the shuffle), each group keeps its row count and its check
    counters, and a global aggregate sums them. The input is read once instead
    of once per aggregate.
    """
    ((unique_name, unique_cols),) = sets.items()
    specs = _row_specs(prep, model) + _table_specs(prep, model) + _custom_specs(model)
    specs = [s for s in specs if s.check not in skip]
    per_group = [F.count(F.lit(1)).alias("__rows")]
    totals = [F.sum("__rows").alias("__n")]
    n = F.col("__n")
    entries = []
    for i, s in enumerate(specs):
        if s.static_fail:
            entries.append((s, F.lit(None).cast("bigint"), F.lit(False)))
        elif s.fails is not None:
            per_group.append(F.count_if(s.fails).alias(f"__g{i}"))
            totals.append(F.sum(f"__g{i}").alias(f"__c{i}"))
            entries.append((s, F.col(f"__c{i}"), F.col(f"__c{i}") == 0))
        elif s.check == "has_at_least_one_value":
            per_group.append(F.count(F.col(_q(s.column))).alias(f"__g{i}"))
            totals.append(F.sum(f"__g{i}").alias(f"__h{i}"))
            entries.append((s, F.lit(None).cast("bigint"), (F.col(f"__h{i}") > 0) | F.coalesce(n == 0, F.lit(True))))
        elif s.check == "dataframe_is_non_empty":
            entries.append((s, F.lit(None).cast("bigint"), F.coalesce(n > 0, F.lit(False))))
        elif s.check == "index_is_monotonically_increasing":
            o = F.col(_q(s.column))
            per_group += [F.min(o).alias(f"__lo{i}"), F.max(o).alias(f"__hi{i}"), F.count(o).alias(f"__k{i}")]
            totals += [F.min(f"__lo{i}").alias(f"__mn{i}"), F.max(f"__hi{i}").alias(f"__mx{i}"),
                       F.sum(f"__k{i}").alias(f"__ct{i}")]
            ok = (F.col(f"__mn{i}") == 0) & (F.col(f"__mx{i}") == n - 1) & (F.col(f"__ct{i}") == n)
            entries.append((s, F.lit(None).cast("bigint"), F.coalesce(n == 0, F.lit(True)) | F.coalesce(ok, F.lit(False))))
        else:  # not decomposable over groups: two passes
            return _report_two_pass(prep, model, skip, sets)
    dup = F.when(F.col("__rows") > 1, F.col("__rows"))
    totals.append(F.coalesce(F.sum(dup), F.lit(0)).alias("__dup"))
    grouped = prep.checked.groupBy(*[_q(c) for c in unique_cols]).agg(*per_group)
    summary = grouped.agg(*totals).withColumn("__n", F.coalesce(n, F.lit(0)))
    total = F.col("__n").cast("bigint")
    rows = [
        F.struct(
            F.lit(s.check).alias("check"),
            F.lit(s.column).cast("string").alias("column"),
            (F.coalesce(failed, F.lit(0)) if s.fails is not None and not s.static_fail else failed)
            .cast("bigint").alias("failed_rows"),
            total.alias("total_rows"),
            passed.alias("passed"),
        )
        for s, failed, passed in entries
    ]
    rows.append(
        F.struct(
            F.lit(unique_name).alias("check"),
            F.lit(",".join(unique_cols)).alias("column"),
            F.col("__dup").cast("bigint").alias("failed_rows"),
            total.alias("total_rows"),
            (F.col("__dup") == 0).alias("passed"),
        )
    )
    return summary.select(F.inline(F.array(*rows)))


@dataclass
class ObservedChecks:
    """A coerced frame whose scalar checks are collected while it is written.

    ``frame`` is the coerced table with an ``Observation`` attached; after an
    action on it, :meth:`rows` gives the report rows of every scalar check.
    ``static`` are schema failures known without data; ``unique`` are the
    uniqueness sets still to be checked (each needs its own grouped count).
    """

    frame: DataFrame
    observation: Any
    checked: DataFrame
    aggregates: list
    entries: list
    static: list[dict]
    unique: dict[str, list[str]]

    def _metrics(self) -> dict:
        """The observed aggregates, or the same aggregates as a job.

        The optimiser drops the observation of a plan it finds to be empty, and
        some aggregates (distinct counts) cannot be observed at all.
        """
        jo = getattr(self.observation, "_jo", None)
        if jo is not None and jo.future().isCompleted():
            try:
                return self.observation.get
            except Exception:  # noqa: BLE001  completed without metrics: compute them
                pass
        return self.checked.agg(*self.aggregates).first().asDict()

    def rows(self) -> list[dict]:
        metrics = self._metrics()
        n = metrics["__n"]
        out = []
        for s, fkey, pkey in self.entries:
            if s.static_fail:
                continue
            failed = metrics[fkey] if fkey else None
            ok = failed == 0 if fkey else bool(metrics[pkey])
            out.append(dict(check=s.check, column=s.column, failed_rows=failed, total_rows=n, passed=ok))
        return out


def observe_checks(
    df: DataFrame, model: type[DataModel], *, skip: Sequence[str] = ()
) -> ObservedChecks:
    """The coerced frame with all scalar checks as one observation (no job yet).

    Writing the frame computes the checks in the same pass: one scan for the
    data and the report instead of two.
    """
    from pyspark.errors import AnalysisException
    from pyspark.sql import Observation

    prep = _prepare(df, model)
    aggs, entries = _check_plan(prep, model, skip)
    obs = Observation(f"checks_{model.__name__}")
    try:
        observed = prep.checked.observe(obs, *aggs)
    except AnalysisException:  # an aggregate that cannot be observed
        obs, observed = None, prep.checked
    frame = _coerced_frame(
        _Prepared(prep.frame, observed, prep.ok, prep.declared, prep.missing, prep.wrong_type, prep.extra),
        model,
    )
    static = [
        dict(check=s.check, column=s.column, failed_rows=None, total_rows=None, passed=False)
        for s, _, _ in entries
        if s.static_fail
    ]
    unique = {k: v for k, v in _unique_sets(prep, model).items() if k not in skip}
    return ObservedChecks(frame, obs, prep.checked, aggs, entries, static, unique)


def unique_rows(df: DataFrame, sets: dict[str, list[str]]) -> list[dict]:
    """Report rows of the given uniqueness sets over ``df`` (one action)."""
    if not sets:
        return []
    frames = [_unique_frame(df, name, cols) for name, cols in sets.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return [r.asDict() for r in out.collect()]


def _message(rows: list) -> str:
    lines = []
    for r in rows:
        if r["check"] == "column_in_dataframe":
            lines.append(f"column '{r['column']}' not in dataframe")
        elif r["check"].startswith("dtype("):
            expected = r["check"][len("dtype('") : -2]
            lines.append(f"expected series '{r['column']}' to have type {expected}")
        elif r["column"] is None:
            lines.append(f"DataFrameSchema failed check '{r['check']}'")
        else:
            failed = "" if r["failed_rows"] is None else f" ({r['failed_rows']} of {r['total_rows']} rows)"
            lines.append(f"Column '{r['column']}' failed check '{r['check']}'{failed}")
    return "; ".join(lines)


def validate(
    df: DataFrame, model: type[DataModel], *, skip: Sequence[str] = ()
) -> DataFrame:
    """Run the report (one action) and return the coerced frame, or raise."""
    rows = [r.asDict() for r in report(df, model, skip=skip).collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise ValidationError(_message(failed), failed)
    return coerced(df, model)


def failure_rows(
    df: DataFrame, model: type[DataModel], *, only_failed: bool = True
) -> DataFrame:
    """The coerced rows with ``failed_checks`` -- the row checks each fails.

    Uniqueness is row-level too: every member of a duplicated group is tagged.
    The duplicated keys are found by a partial grouped count and joined back on
    the key columns (null keys match null keys, as in grouping).
    """
    prep = _prepare(df, model)
    specs = [s for s in _row_specs(prep, model) + _custom_specs(model) if s.fails is not None]
    values = prep.checked
    flags = [F.when(F.coalesce(s.fails, F.lit(False)), F.lit(s.check)) for s in specs]
    out = values.select("*", *[f.alias(f"__f{i}") for i, f in enumerate(flags)])
    names = [F.col(f"__f{i}") for i in range(len(flags))]
    for j, (name, cols) in enumerate(_unique_sets(prep, model).items()):
        dups = (
            values.groupBy(*[_q(c) for c in cols])
            .agg(F.count(F.lit(1)).alias("__rows"))
            .where(F.col("__rows") > 1)
            .select(*[F.col(_q(c)).alias(f"__u{j}_{k}") for k, c in enumerate(cols)], F.lit(True).alias(f"__dup{j}"))
        )
        cond = None
        for k, c in enumerate(cols):
            term = out[_q(c)].eqNullSafe(dups[f"__u{j}_{k}"])
            cond = term if cond is None else cond & term
        out = out.join(dups, on=cond, how="left").drop(*[f"__u{j}_{k}" for k in range(len(cols))])
        names.append(F.when(F.col(f"__dup{j}"), F.lit(name)))
    helper = [c for c in out.columns if c.startswith("__f") or c.startswith("__dup") or c.startswith("__raw__")]
    out = out.withColumn("failed_checks", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))
    out = out.drop(*helper)
    if only_failed:
        out = out.where(F.size("failed_checks") > 0)
    return out
