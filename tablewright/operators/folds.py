"""k-fold assignment by the row key and a seed: by hash, or in folds of equal size.

Each row's fold is ``md5("<key>:<seed>")`` (first 32 bits) modulo k, where a key
is the length and text of each part (``n`` for a null), so that different keys
never share a text -- a pure
function of the key, so it needs no shuffle, no global rank and no collect,
gives the same folds on every engine, and survives re-partitioning. Folds are
close to, not exactly, equal in size.

:func:`kfold_exact` deals the rows in the order of their seeded digests, so the
sizes of the folds differ by at most one. The rank of a row is the number of rows
of lower digest prefixes (grouped counts, summed over one row a prefix) plus its
rank among the rows of its own prefix; prefixes are as long as it takes for one to
hold about ``PREFIX_ROWS`` rows, so no task ranks more. Keys name rows: repeated
keys are different rows of neighbouring ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLD = "fold"
PREFIX_ROWS = 50_000
TOP_DIGITS = 2


def key_text(keys: Sequence[str]) -> Column:
    """One text for the key columns; different keys never share one."""
    parts = [F.col(f"`{k}`").cast("string") for k in keys]
    return F.concat(
        *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("n")) for p in parts]
    )


def fold_of(keys: Sequence[str], n_splits: int = 5, seed: int = 42) -> Column:
    """Fold number in ``[0, n_splits)`` for the key columns."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    digest = F.md5(F.concat(key_text(keys), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (bucket % F.lit(n_splits)).cast("int")


def kfold_assign(df: DataFrame, keys: Sequence[str], n_splits: int = 5, seed: int = 42) -> DataFrame:
    """Add a ``fold`` column, usable as ``CrossValidator(foldCol="fold")``."""
    return df.withColumn(FOLD, fold_of(keys, n_splits, seed))


def kfold_exact(df: DataFrame, keys: Sequence[str], n_splits: int = 5, seed: int = 42) -> DataFrame:
    """Add a ``fold`` column; the folds differ in size by at most one row."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    text = key_text(keys)
    rows = df.withColumn("__digest", F.md5(F.concat(text, F.lit(f":{seed}"))))
    digits, n = TOP_DIGITS, df.count()
    while n > PREFIX_ROWS * 16**digits:
        digits += 1
    rows = rows.withColumn("__prefix", F.substring("__digest", 1, digits))
    counts = rows.groupBy("__prefix").agg(F.count(F.lit(1)).alias("n"))
    # rows below each of the 256 two-digit prefixes, then inside those by the rest of the prefix
    top = F.substring("__prefix", 1, TOP_DIGITS)
    before, below = 0, {}
    for r in counts.groupBy(top.alias("top")).agg(F.sum("n").alias("n")).orderBy("top").collect():
        below[r.top], before = before, before + r.n
    start = F.coalesce(*(F.when(top == t, F.lit(b)) for t, b in below.items()), F.lit(0))
    inside = Window.partitionBy(top).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__prefix", (start + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__prefix").orderBy("__digest", text)) - 1
    ranked = rows.withColumn("__rank", rank).join(offsets, "__prefix")
    fold = ((F.col("__before") + F.col("__rank")) % n_splits).cast("int")
    return ranked.withColumn(FOLD, fold).select(*[f"`{c}`" for c in df.columns if c != FOLD], FOLD)
