"""Column selection and per-column transforms, fitted into SQL.

A :class:`ColumnTransformer` applies named transformers to column subsets and
passes or drops the rest, like the reference's pre-processing steps. Fitting
a step runs one aggregate for all its statistics (means, null flags), plus a
bounded distinct only for categories without declared levels; the
fitted result is a single ``SELECT`` over the input, so applying it is a plain
projection inside whole-stage codegen -- no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import column_levels, distinct_levels

# A column spec is a list of names or positions, or a function of the schema.
ColumnSpec = Sequence[str | int] | Callable[[T.StructType], list[str]]


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


# F1 -------------------------------------------------------------------------


def select_by_dtype(schema: T.StructType, include: str | Sequence[str]) -> list[str]:
    """Names of the columns of the given kinds, in schema order.

    Kinds: ``number`` (numeric, not boolean), ``category`` (string),
    ``boolean``, ``datetime`` (timestamps and dates).
    """
    kinds = {include} if isinstance(include, str) else set(include)
    out = []
    for f in schema.fields:
        dt = f.dataType
        kind = (
            "number" if isinstance(dt, T.NumericType)
            else "category" if isinstance(dt, T.StringType)
            else "boolean" if isinstance(dt, T.BooleanType)
            else "datetime" if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))
            else None
        )
        if kind in kinds:
            out.append(f.name)
    return out


def by_dtype(include: str | Sequence[str]) -> Callable[[T.StructType], list[str]]:
    """A column spec resolved against the schema at fit time."""
    return lambda schema: select_by_dtype(schema, include)


# F5 -------------------------------------------------------------------------


@dataclass(frozen=True)
class Toggles:
    """An ordered choice of input columns, each a name or a position that is on or off."""

    switches: tuple[tuple[str | int, bool], ...]

    @classmethod
    def of(cls, switches: Mapping[str | int, bool]) -> Toggles:
        return cls(tuple((key, bool(on)) for key, on in switches.items()))

    def switched(self, **changes: bool) -> Toggles:
        """the same order with some toggles changed; names that are none are refused."""
        known = dict(self.switches)
        unknown = [k for k in changes if k not in known]
        if unknown:
            raise KeyError(f"unknown feature toggle(s): {unknown}")
        return Toggles.of({**known, **changes})

    def columns(self, schema: T.StructType | None = None) -> list[str | int]:
        """What is on; with a schema as names that are all in it."""
        chosen: list[str | int] = []
        for key, on in self.switches:
            if on:
                chosen.append(key)
        return chosen if schema is None else resolve(chosen, schema)


def build_columns(index: dict[int, bool] | None = None, **columns: bool) -> list[str | int]:
    """Names switched on, in the order given; positions where ``index`` is given."""
    return Toggles.of(columns if index is None else index).columns()


def feature_list(base: dict[str, bool], **overrides: bool) -> list[str]:
    """the base toggles with some switched, as a column list."""
    return Toggles.of(base).switched(**overrides).columns()


def resolve(spec: ColumnSpec, schema: T.StructType) -> list[str]:
    if callable(spec):
        return list(spec(schema))
    names = schema.names
    out = []
    for item in spec:
        if isinstance(item, int):
            out.append(names[item])
        else:
            if item not in names:
                raise KeyError(f"column {item!r} not in the input")
            out.append(item)
    return out


# Transformers ---------------------------------------------------------------


class Transformer:
    """A per-column transform fitted into SQL expressions.

    ``stats`` names the aggregates the fit needs (``{name: Column}``; a step
    computes those of all its transformers in one job); ``build`` turns their
    values into ``[(sql_expression, output_name)]``.
    """

    def stats(self, df: DataFrame, columns: list[str]) -> dict:
        return {}

    def build(self, df: DataFrame, columns: list[str], stats: dict) -> list[tuple[str, str]]:
        raise NotImplementedError

    def fit(self, df: DataFrame, columns: list[str]) -> list[tuple[str, str]]:
        aggs = self.stats(df, columns)
        values = _aggregate(df, aggs)
        return self.build(df, columns, values)


class Passthrough(Transformer):
    def build(self, df, columns, stats):
        return [(q(c), c) for c in columns]


@dataclass
class ImputeConstant(Transformer):
    """nulls become ``fill_value``."""

    fill_value: float = 0.0

    def build(self, df, columns, stats):
        return [(f"coalesce({q(c)}, {sql_double(self.fill_value)})", c) for c in columns]


@dataclass
class Center(Transformer):
    """subtract the mean (no scaling)."""

    def stats(self, df, columns):
        return {f"mean:{c}": F.avg(F.col(q(c))) for c in columns}

    def build(self, df, columns, stats):
        out = []
        for c in columns:
            mean = stats.get(f"mean:{c}")
            out.append((f"{q(c)} - {sql_double(0.0 if mean is None else mean)}", c))
        return out


@dataclass
class OneHot(Transformer):
    """dense 0/1 columns ``<col>_<level>``, levels in sorted order.

    Levels come from the column metadata (declared categories), else from the
    data. A null in the fitted data gets its own ``<col>_nan`` column. Levels, and
    nulls, that were not fitted raise at transform time unless
    ``handle_unknown="ignore"`` (all zeros).
    """

    handle_unknown: str = "error"
    levels: dict[str, list[str]] = field(default_factory=dict)

    def stats(self, df, columns):
        return {f"has_null:{c}": F.max(F.col(q(c)).isNull()) for c in columns}

    def build(self, df, columns, stats):
        out = []
        for c in columns:
            levels = self.levels.get(c) or column_levels(df, c) or distinct_levels(df, c)
            levels = sorted(levels)
            guard = ""
            if self.handle_unknown == "error":
                listed = ", ".join(sql_string(v) for v in levels)
                guard = (
                    f"WHEN {q(c)} IS NOT NULL AND {q(c)} NOT IN ({listed}) "
                    f"THEN raise_error(concat('Found unknown categories in column {c}: ', {q(c)})) "
                )
                if not stats.get(f"has_null:{c}"):
                    guard += f"WHEN {q(c)} IS NULL THEN raise_error('Found unknown categories in column {c}: null') "
            for i, level in enumerate(levels):
                check = guard if i == 0 else ""
                out.append(
                    (f"CASE {check}WHEN {q(c)} = {sql_string(level)} THEN 1.0D ELSE 0.0D END", f"{c}_{level}")
                )
            if stats.get(f"has_null:{c}"):
                out.append((f"CASE WHEN {q(c)} IS NULL THEN 1.0D ELSE 0.0D END", f"{c}_nan"))
        return out


# F6/F7 ----------------------------------------------------------------------


@dataclass
class ColumnTransformer:
    """Named transformers over column subsets, then the remainder.

    Output order: each transformer's columns in turn, then the untouched
    columns in input order when ``remainder="passthrough"``. Output names are
    plain (F7). ``carry`` columns (identifiers, label) are never transformed
    and always kept in front, so rows stay addressable.
    """

    transformers: list[tuple[str, Transformer | str, ColumnSpec]]
    remainder: str = "passthrough"
    carry: Sequence[str] = ()

    def __post_init__(self):
        if self.remainder not in ("passthrough", "drop"):
            raise ValueError("remainder must be 'passthrough' or 'drop'")

    def fit_select(self, df: DataFrame) -> list[tuple[str, str]]:
        """Fit every transformer and return the output ``[(expr, name)]``."""
        carry = [c for c in self.carry if c in df.columns]
        schema = T.StructType([f for f in df.schema.fields if f.name not in carry])
        used: list[str] = []
        exprs: list[tuple[str, str]] = [(q(c), c) for c in carry]
        plan = []
        for name, transformer, spec in self.transformers:
            cols = resolve(spec, schema)
            used.extend(cols)
            if transformer == "drop":
                continue
            if transformer == "passthrough":
                transformer = Passthrough()
            plan.append((f"{name}/", transformer, cols))
        # every statistic of every transformer of this step: one aggregate, one job
        wanted = {}
        for prefix, t, cols in plan:
            wanted.update({prefix + k: v for k, v in t.stats(df, cols).items()})
        row = _aggregate(df, wanted)
        for prefix, t, cols in plan:
            values = {k[len(prefix):]: v for k, v in row.items() if k.startswith(prefix)}
            exprs.extend(t.build(df, cols, values))
        if self.remainder == "passthrough":
            exprs.extend((q(c), c) for c in schema.names if c not in used)
        names = [n for _, n in exprs]
        dup = sorted({n for n in names if names.count(n) > 1})
        if dup:
            raise ValueError(f"duplicate output column(s) {dup}")
        return exprs

    def fit_statement(self, df: DataFrame) -> str:
        exprs = self.fit_select(df)
        return "SELECT " + ", ".join(f"{e} AS {q(n)}" for e, n in exprs) + " FROM __THIS__"

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return df.selectExpr(*[f"{e} AS {q(n)}" for e, n in self.fit_select(df)])


def _aggregate(df: DataFrame, aggs: dict) -> dict:
    """Evaluate named aggregates in one job; returns ``{name: value}``."""
    if not aggs:
        return {}
    names = list(aggs)
    row = df.agg(*[aggs[n].alias(f"s{i}") for i, n in enumerate(names)]).collect()[0]
    return {n: row[f"s{i}"] for i, n in enumerate(names)}


def build_transformers(**specs: dict) -> list[tuple[str, Transformer | str, ColumnSpec]]:
    """F8 helper: ``name=dict(transformer=..., columns=...)`` to a list."""
    out = []
    for name, spec in specs.items():
        for key in ("transformer", "columns"):
            if key not in spec:
                raise KeyError(key)
        out.append((name, spec["transformer"], spec["columns"]))
    return out
