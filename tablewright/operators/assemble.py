"""Left-join every query result one-to-one onto the ``index`` query.

``assemble`` builds one lazy plan: the index and every feature query are bound
and run as Spark SQL, the identifiers are the index columns, and the feature
frames are left-joined onto the index in query order.

Frames are joined as they are; no row or value is ever merged. One-to-one is
guarded on the plan itself: ``panel`` filters on a scalar subquery, the size of
the largest group of equal identifiers over all frames (keys only, partial
counts), and raises when it exceeds one. The subquery has no column of the panel
in it, so neither column pruning nor an empty frame can remove it, and every
action on ``panel`` fails on duplicates, whether their key is in the index or
not. :meth:`Assembly.check_one_to_one` is the same check as a job of its own that
names the queries and keys; ``joined`` is the plan without the guard for callers
that have run it.

A frame that is grouped (or made distinct) by identifiers has unique ones by
construction, and Spark's optimiser knows: :func:`unique_by_plan` asks its plan for
columns known to be distinct. Such a frame is not counted at all; the guard computes
only those that may hold duplicates.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.dates import parse_date_columns
from ..sources.params import SqlParams, run_sql

MAX_REPORTED_KEYS = 20


class NotUniqueError(ValueError):
    """Identifiers are not unique in the index or in a feature query."""


class ColumnOverlapError(ValueError):
    """Two queries produce a non-identifier column of the same name."""


def _q(name: str) -> str:
    return f"`{name}`"


def _items(jvm_collection) -> list:
    it, out = jvm_collection.iterator(), []
    while it.hasNext():
        out.append(it.next())
    return out


def unique_by_plan(df: DataFrame, columns: list[str]) -> bool:
    """Whether the optimised plan alone shows that no two rows share these columns.

    False where nothing is known (or Spark doesn't tell); no job is started.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        named = {a.exprId().id() for a in _items(plan.output()) if a.name() in columns}
        return any(
            all(e.references().size() == 1 and e.exprId().id() in named for e in _items(key))
            for key in _items(plan.distinctKeys())
        )
    except (AttributeError, Py4JError, TypeError):
        return False


@dataclass
class Assembly:
    """The lazy assembled table plus what is needed to check it."""

    identifiers: list[str]
    frames: dict[str, DataFrame]
    joined: DataFrame

    def uncertain(self) -> dict[str, DataFrame]:
        """The frames whose plans don't show their identifiers unique; only these need counting."""
        return {n: df for n, df in self.frames.items() if not unique_by_plan(df, self.identifiers)}

    def duplicates(self) -> DataFrame:
        """J2 as a query: every duplicated identifier tuple, per query.

        One job over all frames (a union of grouped counts); the grouping is
        partial per partition, so one hot key never lands in a single task with
        all of its rows.
        """
        parts = []
        for name, df in (self.uncertain() or {"index": self.frames["index"].limit(0)}).items():
            parts.append(
                df.groupBy(*[_q(c) for c in self.identifiers])
                .agg(F.count(F.lit(1)).alias("rows"))
                .where(F.col("rows") > 1)
                .select(F.lit(name).alias("source"), *[_q(c) for c in self.identifiers], "rows")
            )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def largest_group(self, frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """One row, ``n``: rows of the most frequent identifier tuple of any frame."""
        ids = [_q(c) for c in self.identifiers]
        out = None
        for df in (frames or self.frames).values():
            part = df.groupBy(*ids).agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows").alias("n"))
            out = part if out is None else out.union(part)
        return out.agg(F.max("n").alias("n"))

    @property
    def panel(self) -> DataFrame:
        """The joined table; every action on it raises if a frame has duplicate keys."""
        uncertain = self.uncertain()
        if not uncertain:
            return self.joined
        twice = F.coalesce(self.largest_group(uncertain).scalar(), F.lit(0)) > 1
        message = F.lit("Merge keys are not unique; check_one_to_one() lists them")
        return self.joined.where(F.when(twice, F.raise_error(message)).otherwise(F.lit(True)))

    def check_one_to_one(self) -> None:
        """Raises :class:`NotUniqueError` naming every query with duplicate keys."""
        dups = self.duplicates()
        sources = sorted(r["source"] for r in dups.select("source").distinct().collect())
        if not sources:
            return
        sample = dups.limit(MAX_REPORTED_KEYS + 1).collect()
        keys = [tuple(r[c] for c in ["source", *self.identifiers]) for r in sample]
        more = " ..." if len(keys) > MAX_REPORTED_KEYS else ""
        raise NotUniqueError(
            f"Merge keys are not unique in {', '.join(sources)}: {keys[:MAX_REPORTED_KEYS]}{more}"
        )


def run_queries(
    spark: SparkSession, queries: Mapping[str, str], params: SqlParams | None = None
) -> dict[str, DataFrame]:
    """Bind and run each query lazily; text ``date`` columns are parsed."""
    return {name: parse_date_columns(run_sql(spark, q, params)) for name, q in queries.items()}


def assemble(
    spark: SparkSession,
    queries: Mapping[str, str],
    params: SqlParams | None = None,
    *,
    null_safe: bool = False,
) -> Assembly:
    """Left-join every query onto the mandatory ``index`` query.

    ``null_safe=True`` matches null identifiers to null identifiers (as the
    reference's index join does); leave it off when identifiers are declared
    non-null, since a plain ``=`` lets a grouped feature frame keep its
    partitioning.
    """
    queries = dict(queries)
    if "index" not in queries:
        raise KeyError("index")
    frames = run_queries(spark, {"index": queries.pop("index"), **queries}, params)
    return assemble_frames(frames, null_safe=null_safe)


def assemble_frames(
    frames: Mapping[str, DataFrame], *, null_safe: bool = False
) -> Assembly:
    """Same as :func:`assemble` for frames that are already DataFrames."""
    frames = dict(frames)
    if "index" not in frames:
        raise KeyError("index")
    index = frames["index"]
    ids = list(index.columns)  # J5: every index column is an identifier
    seen = {c: "index" for c in ids}
    for name, df in frames.items():
        if name == "index":
            continue
        missing = [c for c in ids if c not in df.columns]
        if missing:
            raise KeyError(f"query {name!r} lacks the identifier column(s) {missing}")
        for c in df.columns:
            if c in ids:
                continue
            if c in seen:  # J3
                raise ColumnOverlapError(
                    f"columns overlap but no suffix specified: {c!r} in {seen[c]!r} and {name!r}"
                )
            seen[c] = name

    joined = index
    for name, df in frames.items():
        if name != "index":
            joined = _left_join(joined, df, ids, null_safe)
    return Assembly(identifiers=ids, frames=frames, joined=joined)


def _left_join(left: DataFrame, right: DataFrame, ids: list[str], null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, on=ids, how="left")
    renamed = right.select(
        *[F.col(_q(c)).alias(f"__key_{i}") for i, c in enumerate(ids)],
        *[_q(c) for c in right.columns if c not in ids],
    )
    cond = None
    for i, c in enumerate(ids):
        term = left[_q(c)].eqNullSafe(renamed[f"__key_{i}"])
        cond = term if cond is None else cond & term
    joined = left.join(renamed, on=cond, how="left")
    return joined.drop(*[f"__key_{i}" for i in range(len(ids))])
