"""Site-relative line removal: lines on too many pages of one host are boilerplate.

For every host (a column, the source by default) the share of its pages that
contain a line is compared with a ratio; lines above it are dropped from the
pages of that host, and stay everywhere else. A line counts once per page, after
trimming; blank lines are never counted and never dropped. A line of a single page
is nothing its host repeats, so two pages (``min_pages``) are the least a share is
taken of, whatever the size of the host.

All counting is by a 128-bit digest of the line in grouped aggregates with
map-side partial sums; a hot host or a hot line is only a large partial sum.
The boilerplate table is small by arithmetic: a host has at most
(lines per page / ratio) lines above the ratio.

Null text counts as empty and stays null; a null host is a host of its own.
Line breaks are ``\\n``. Rows keep their columns and their number, repeated rows
and ids included; a page whose lines are all dropped has an empty text. Columns
named ``n_lines`` or ``n_dropped`` are replaced when the counts are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.work import work_dir, written

# Helper columns, named so that they clash with no column of a page table.
_HOST, _DROP, _KEPT = "__line_dedup_host", "__line_dedup_drop", "__line_dedup_kept"

RATIO = 0.05
MIN_PAGES = 2


def _key(line: Column) -> Column:
    """128-bit digest of a trimmed line (null for a blank one)."""
    trimmed = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit(1), trimmed).alias("h2")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def page_lines(pages: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """One row per page and distinct line: ``host, h1, h2``."""
    keys = F.array_distinct(F.transform(_lines(F.col(text_col)), _key))
    return pages.select(F.col(host_col).alias("host"), F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("k")).select(
        "host", "k.h1", "k.h2"
    )


def boilerplate(
    pages: DataFrame,
    *,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``host, h1, h2, pages, share`` of the lines on more than ``ratio`` of a host's pages."""
    total = pages.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("total"))
    count = (
        page_lines(pages, host_col, text_col).groupBy("host", "h1", "h2").agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    joined = count.alias("c").join(total.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    share = F.col("c.pages") / F.col("t.total")
    return joined.where(share > ratio).select("c.host", "c.h1", "c.h2", "c.pages", share.alias("share"))


def drop_boilerplate_lines(
    pages: DataFrame,
    *,
    id_col: str = "doc_id",
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = True,
) -> DataFrame:
    """``pages`` with the boilerplate lines cut from ``text_col``; with ``counts`` also ``n_lines`` and ``n_dropped``.

    The table of boilerplate lines is written to the shared folder. Its lines are
    gathered per host (a bounded list, see above) and joined with the pages, so
    the texts themselves are not shuffled when that table is small.
    """
    folder = work_dir(pages.sparkSession)
    found = boilerplate(pages, host_col=host_col, text_col=text_col, ratio=ratio, min_pages=min_pages)
    per_host = written(
        found.groupBy("host").agg(F.collect_set(F.struct("h1", "h2")).alias("drop")), folder, "boilerplate"
    ).select(F.col("host").alias(_HOST), F.col("drop").alias(_DROP))
    marked = pages.join(per_host, F.col(host_col).eqNullSafe(F.col(_HOST)), "left")
    lines = _lines(F.col(text_col))
    # a line without a key (blank) is never in the list
    stays = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(_DROP, _key(x)), F.lit(False)))
    out = marked.withColumn(_KEPT, F.when(F.col(_DROP).isNull(), lines).otherwise(stays))
    if counts:
        total, kept = F.size(lines), F.size(_KEPT)
        has_text = F.col(text_col).isNotNull()
        out = out.withColumn("n_lines", F.when(has_text, total).otherwise(0).cast("long")).withColumn(
            "n_dropped", F.when(has_text, total - kept).otherwise(0).cast("long")
        )
    return out.withColumn(text_col, F.array_join(_KEPT, "\n")).drop(_HOST, _DROP, _KEPT)
