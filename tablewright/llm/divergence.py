"""How far the sources of a language are apart, and by which terms.

Every (lang, source) group gives each kept term of its language the smoothed share
``1 + floor(10**9 * (count + 5) / (N + 5 * V))``; a language keeps the ``V`` terms
that at least ``MIN_DOCS`` of its documents hold, ``N`` counts the group's kept
terms. Part ``pair`` compares the groups of a language two by two (sum of absolute
differences over all kept terms), part ``term`` lists the terms a group has more of
than its language.

The pairs are computed by Gustavson's row accumulation. The index is term-major
(term -> groups that hold it); a task has the index of a block of terms. Each group,
a row, walks its own terms and scatters what each has in common with later groups
into one dense array, an accumulator for every peer; no posting pair is ever a row.
A term that only one of two groups holds differs by that group's share from the
other's share of an absent term (its baseline): sorted shares and their prefix sums
give these for all peers at once, and terms that both hold are corrected as they are
scattered. Terms that neither holds differ by the two baselines: ``V`` times their
difference is added at the end. Everything is integer arithmetic.

Counting is one pass over the texts: a task sums counts and documents of its terms
by group in memory of at most ``FLUSH`` entries, so a hot group or term is a few
partial sums a task. A block has about as many postings as the language has pairs of
groups, so that its accumulators are no more than what they sum (``LEAST_BLOCK`` to
``BLOCK``), and rows enough for ``CELLS`` accumulators; these are units of work only:
nothing is capped.

Null lang, source and text read as ''. Repeated rows are documents of their own.
Groups without terms are groups; a language without kept terms has pairs of value 0.
Ids and other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.work import small_batches, work_dir, written

MIN_DOCS = 30
TOP_TERMS = 50
SCALE, SMOOTH = 10**9, 5
FLUSH = 400_000
LEAST_BLOCK, BLOCK = 1 << 15, 1 << 20
CELLS = 1 << 22
# ASCII letters lower-cased, every other ASCII byte a space, bytes of other characters as they are.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial ``lang, source, term, n, docs``."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}

    def flushed() -> pa.RecordBatch:
        lang, source, term, n, docs = [], [], [], [], []
        for (a, b), (count, seen) in groups.items():
            lang += [a] * len(count)
            source += [b] * len(count)
            term += count
            n += count.values()
            docs += [seen[t] for t in count]
        groups.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
             pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            names=["lang", "source", "term", "n", "docs"],
        )

    for batch in batches:
        lang, source, text = (batch.column(c) for c in ("lang", "source", "text"))
        for a, b, data in zip(lang.to_pylist(), source.to_pylist(), text.cast(pa.binary()).to_pylist(), strict=True):
            terms = data.translate(_TERM_BYTES).split()
            count, seen = groups.setdefault((a, b), (Counter(), Counter()))
            count.update(terms)
            seen.update(set(terms))
            if sum(len(c) for c, _ in groups.values()) >= FLUSH:
                yield flushed()
    if groups:
        yield flushed()


def _share(count: Column, size: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (size + SMOOTH * terms)), exact; 0 without terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(20,0)")
    below = (size + terms * SMOOTH).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", top, below) + 1).otherwise(F.lit(0)).cast("long")


def term_index(docs: DataFrame, folder: str, *, min_docs: int = MIN_DOCS) -> DataFrame:
    """The term-major index: ``lang, term, term_id, total, postings array<struct<source, n>>`` of kept terms."""
    small_batches(docs.sparkSession)
    parts = docs.select("lang", "source", "text").mapInArrow(
        _count_terms, "lang string, source string, term string, n long, docs long"
    )
    counts = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    index = (
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings"))
        .where(F.col("docs") >= min_docs)
        .select("lang", "term", F.monotonically_increasing_id().alias("term_id"), "total", "postings")
    )
    return written(index, folder, "index")


def _groups(docs: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Every (lang, source) with its number in the language, sizes and baseline share, and how its language is cut."""
    langs = index.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("total").alias("lang_size"), F.sum(F.size("postings")).alias("postings")
    )
    sizes = index.select("lang", F.explode("postings").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(
        F.sum("x.n").alias("size")
    )
    zero = {"terms": 0, "lang_size": 0, "postings": 0, "size": 0}
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero)
    mine = Window.partitionBy("lang")
    peers = F.count("*").over(mine)
    block = F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(BLOCK), peers * peers))
    rows = F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("peers"))).cast("long")
    groups = groups.select(
        "*", (F.row_number().over(mine.orderBy("source")) - 1).alias("number"), peers.alias("peers"),
        _share(F.lit(0).cast("long"), F.col("size"), F.col("terms")).alias("baseline"),
        F.greatest(F.lit(1), F.ceil(F.col("postings") / block)).cast("long").alias("blocks"),
    ).withColumn("rows", rows)
    return written(groups, folder, "groups")


def _accumulate(table: pa.Table) -> pa.Table:
    """Differences of each group of a chunk to every peer, over one block of terms, less the two baselines' ones.

    Rows without a term are the groups and their baselines; the others the postings.
    Part of a pair comes from either of its groups, so the sums are by unordered pairs.
    """
    term, number, share = (table.column(c).to_numpy(zero_copy_only=False) for c in ("term_id", "number", "share"))
    lang, chunk, rows = (table.column(c)[0].as_py() for c in ("lang", "chunk", "rows"))
    own = term < 0
    base = np.zeros(int(number[own].max()) + 1, np.int64)
    base[number[own]] = share[own]
    term, number, share = term[~own], number[~own], share[~own]
    order = np.lexsort((number, term))
    term, number, share = term[order], number[order], share[order]
    ends = np.searchsorted(term, term, side="right")  # of each posting's term
    by_group = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[by_group], np.arange(len(base) + 1))
    found = []
    for a in range(chunk * rows, min((chunk + 1) * rows, len(base))):
        mine = by_group[bounds[a]:bounds[a + 1]]
        apart = np.abs(base[a] - base)
        # terms of this group against every peer's baseline
        sorted_ = np.sort(share[mine])
        sums = np.concatenate([[0], np.cumsum(sorted_)])
        below = np.searchsorted(sorted_, base)
        acc = base * (2 * below - len(mine)) + sums[-1] - 2 * sums[below] - len(mine) * apart
        # terms that later peers hold too: the difference itself, instead of the two to a baseline
        counts = ends[mine] - mine - 1
        at = np.repeat(mine + 1 - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        peer, theirs, ours = number[at], share[at], np.repeat(share[mine], counts)
        np.add.at(
            acc, peer,
            np.abs(ours - theirs) - np.abs(ours - base[peer]) - np.abs(base[a] - theirs) + apart[peer],
        )
        found.append(acc)
    numbers = range(chunk * rows, chunk * rows + len(found))
    return pa.table({
        "lang": pa.array([lang] * len(found), pa.string()), "number": pa.array(numbers, pa.int32()),
        "apart": pa.array(found, pa.list_(pa.int64())),
    })


def _pairs(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two different sources of a language."""
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("peers") - 1) / F.col("rows")).cast("long")))
    shares = postings.select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), chunks.alias("chunk"), "rows",
        "term_id", "number", "share",
    )
    baselines = groups.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    ).select(
        "lang", "block", chunks.alias("chunk"), "rows", F.lit(-1).cast("long").alias("term_id"), "number",
        F.col("baseline").alias("share"),
    )
    rows = shares.unionByName(baselines).groupBy("lang", "block", "chunk").applyInArrow(
        _accumulate, "lang string, number int, apart array<long>"
    )
    cells = rows.select("lang", "number", F.posexplode("apart").alias("peer", "apart")).where("number <> peer")
    sums = cells.groupBy("lang", F.least("number", "peer").alias("a"), F.greatest("number", "peer").alias("b")).agg(
        F.sum("apart").alias("apart")
    )
    side = lambda n: groups.select(
        "lang", F.col("number").alias(n), F.col("source").alias(f"source_{n}"), F.col("baseline").alias(f"base_{n}"), F.col("terms").alias(f"terms_{n}")
    )
    named = sums.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
    value = F.col("apart") + F.col("terms_a") * F.abs(F.col("base_a") - F.col("base_b"))
    both = F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
    )
    return named.select("lang", value.alias("value"), F.explode(both).alias("x")).select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of the sources of ``lang, source, text``."""
    folder = work_dir(docs.sparkSession)
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    index = term_index(docs, folder, min_docs=min_docs)
    groups = _groups(docs, index, folder)
    postings = written(
        index.select("lang", "term", "term_id", "total", F.explode("postings").alias("x"))
        .select("lang", "term", "term_id", "total", "x.source", "x.n")
        .join(groups, ["lang", "source"])
        .select(
            "lang", "source", "term", "term_id", "number", "peers", "rows", "blocks",
            _share(F.col("n"), F.col("size"), F.col("terms")).alias("share"),
            _share(F.col("total"), F.col("lang_size"), F.col("terms")).alias("usual"),
        ),
        folder, "postings",
    )
    rank = lambda: F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    )
    names = ["lang", "source", "part", "item", "value", "rank"]
    pairs = _pairs(postings, groups).select("*", rank().alias("rank"), F.lit("pair").alias("part"))
    more = postings.where(F.col("share") > F.col("usual")).select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value")
    )
    terms = more.select("*", rank().alias("rank")).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return pairs.select(*names).unionByName(terms.select(*names))
