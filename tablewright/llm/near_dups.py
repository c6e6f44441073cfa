"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard, components.

Method. A document's set holds the hashes of its distinct k-word shingles.
Circulant MinHash needs two permutations of the 32-bit universe only: ``sigma``
scatters the elements once, and coordinate j of the signature is the minimum of
``pi`` shifted circularly by j, ``min pi(sigma(x) - j)``. Both permutations are
bijective integer mixers, so no table of the universe is kept.

Bands of ``rows`` coordinates make buckets. Documents with identical sets are
collapsed first (one representative per set), so thousands of copies cost one
row in each bucket. No bucket is expanded into pairs:

1. In every bucket each member is compared with one leader, the member whose
   buckets are the fullest (the text most of a family still resembles). Pairs
   are verified on the full sets; verified links give components.
2. Buckets that still hold several components name the open documents. Among
   those an exact prefix-filter join finds every remaining pair that can reach
   the threshold: order all shingles by rising frequency; two sets with
   similarity t share one of the first ``n - ceil(t n) + 1`` shingles of each,
   and from the first one they share on, both must have enough shingles left for
   the overlap that t asks for. Pairs inside one component are not emitted; the
   others are verified too.

Every pair that shares a bucket is therefore verified or already connected. The
only loss is a pair at or above the threshold that shares no bucket: ``band_plan``
takes as many bands of 5 rows as bring that chance below ``MISS`` at the threshold
itself (28 at similarity 0.85, 41 at 0.8); above it the chance is smaller still.

Shingles are compared by 64-bit hashes. A document without words has an empty
set and no links. Null text counts as empty. Rows with the same id are one node,
linked through any of their texts. A row without an id is kept and has no
component. Extra columns are ignored (only the id and the text are read).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.graph import components
from tablewright.llm.work import small_batches, work_dir, written

ROWS = 5
MISS = 1e-7
# Odd multipliers of the two 32-bit permutations (murmur-style finishers).
_SIGMA = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_PI = (np.uint32(0x9E3779B1), np.uint32(0x846CA68B))
_CHUNK = 1 << 15


def band_plan(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at the threshold shares a bucket but for a chance of ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def _sigma(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(16))
    x = x * _SIGMA[0]
    x = x ^ (x >> np.uint32(13))
    x = x * _SIGMA[1]
    return x ^ (x >> np.uint32(16))


def signatures(elements: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash signatures (texts x coordinates) of non-empty sets.

    ``elements``: 64-bit shingle hashes; ``bounds[i]:bounds[i + 1]`` are those of set i.
    """
    out = np.empty((len(bounds) - 1, coordinates), np.uint32)
    scattered = _sigma((elements >> np.uint64(32)).astype(np.uint32))
    i = 0
    while i < len(bounds) - 1:  # some sets at a time, so that the arrays stay in cache
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + _CHUNK, side="right")) - 1)
        part = scattered[bounds[i]:bounds[j]]
        heads = (bounds[i:j] - bounds[i]).astype(np.intp)
        shifted, tmp = np.empty_like(part), np.empty_like(part)
        for c in range(coordinates):
            np.subtract(part, np.uint32(c), out=shifted)  # the circular shift
            np.right_shift(shifted, np.uint32(15), out=tmp)
            np.bitwise_xor(shifted, tmp, out=shifted)
            np.multiply(shifted, _PI[0], out=shifted)
            np.right_shift(shifted, np.uint32(13), out=tmp)
            np.bitwise_xor(shifted, tmp, out=shifted)
            np.multiply(shifted, _PI[1], out=shifted)
            out[i:j, c] = np.minimum.reduceat(shifted, heads)
        i = j
    return out


def _sets(block: arrays.Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted inside each text, and their bounds."""
    starts, ends = block.words()
    values, owner = arrays.shingles(block.hashes(starts, ends), block.owners(starts), k)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(block.n + 1))


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            ids = batch.column(0)
            for raw in arrays.blocks(batch.column(1)):
                values, bounds = _sets(raw.lower(), k)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes > 0)
                d1, d2 = np.zeros(raw.n, np.uint64), np.zeros(raw.n, np.uint64)
                keys = np.zeros((len(full), bands), np.uint64)
                if len(full):
                    heads = bounds[full]
                    d1[full] = np.add.reduceat(arrays.mix64(values), heads)
                    d2[full] = np.add.reduceat(arrays.mix64(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), heads)
                    sig = signatures(values, np.append(heads, len(values)), bands * rows)
                    keys += salt
                    for r in range(rows):
                        keys = arrays.mix64(keys ^ sig[:, r::rows].astype(np.uint64))
                offsets = np.zeros(raw.n + 1, np.int32)
                offsets[full + 1] = bands
                offsets = np.cumsum(offsets, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(raw.first, raw.n),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(arrays.signed(d1)),
                        pa.array(arrays.signed(d2)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(arrays.signed(keys.ravel()))),
                    ],
                    names=["id", "n", "d1", "d2", "bands"],
                )

    return run


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for raw in arrays.blocks(batch.column(1)):
                values, bounds = _sets(raw.lower(), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(raw.first, raw.n),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(arrays.signed(values))
                        ),
                    ],
                    names=["id", "items"],
                )

    return run


def similar(inter: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * inter >= percent * (size_a + size_b - inter)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    inter = F.size(F.array_intersect("items_a", "items_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(similar(inter, F.size("items_a"), F.size("items_b"), percent))
        .select("a", "b")
    )


def _prefix_pairs(open_sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Cross-component pairs that share a prefix shingle (every pair at the threshold does)."""
    items = open_sets.select("id", "component", F.size("items").alias("n"), F.explode("items").alias("s"))
    freq = written(items.groupBy("s").agg(F.count("*").alias("df")), folder, "frequency")
    # a shingle of one document cannot make a pair, but it takes a place in the prefix
    ranked = items.join(freq, "s").groupBy("id", "component", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("ranked")
    )
    need = (F.col("n") * percent + 99) / 100  # ceil(t n) after the floor below
    prefix = ranked.select(
        "id", "component", "n",
        F.posexplode(F.slice("ranked", 1, (F.col("n") - F.floor(need) + 1).cast("int"))).alias("at", "p"),
    ).where("p.df > 1").select("id", "component", "n", "p.s", "at")
    prefix = written(prefix, folder, "prefix")
    x, y = prefix.alias("x"), prefix.alias("y")
    # if this is the first common shingle, no more than the shingles from here on are common
    reach = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    can_reach = reach * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    return (
        x.join(y, F.col("x.s") == F.col("y.s"))
        .where((F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component")) & can_reach)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every document.

    Links join documents with 100 * intersection >= percent * union of their
    distinct ``words``-word shingles; a component is named by its smallest id
    and keeps that document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = work_dir(spark)
    bands = band_plan(percent / 100, rows, miss)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sig = written(
        texts.mapInArrow(_sign(words, bands, rows), "id long, n long, d1 long, d2 long, bands array<long>"),
        folder, "signatures",
    )

    # one representative per distinct set
    same_set = ["n", "d1", "d2"]
    reps = written(
        sig.where("n > 0 AND id IS NOT NULL").groupBy(*same_set).agg(F.min(F.struct("id", "bands")).alias("r"))
        .select(*same_set, F.col("r.id").alias("rep"), F.col("r.bands").alias("bands")),
        folder, "representatives",
    )
    slots = reps.select("rep", F.explode("bands").alias("bucket"))
    # aggregates that a large side is joined with are written first: a join of two plain
    # exchanges is one whose hot keys Spark can split
    shared = written(
        slots.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), folder, "shared"
    )
    slots = written(slots.join(shared, "bucket"), folder, "buckets")
    weight = written(slots.groupBy("rep").agg(F.sum("members").alias("weight")), folder, "weight")
    slots = written(slots.join(weight, "rep").select("rep", "bucket", "weight"), folder, "weighted")
    leaders = written(
        slots.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("top"))
        .select("bucket", (-F.col("top.minus")).alias("leader")),
        folder, "leaders",
    )
    stars = (
        slots.join(leaders, "bucket").where("rep <> leader")
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
    )

    needed = weight.select(F.col("rep").alias("id"))
    sets = written(
        texts.join(needed, "id", "left_semi").mapInArrow(_set_rows(words), "id long, items array<long>"),
        folder, "sets",
    )
    links = written(_verified(stars, sets, percent), folder, "links")
    cc = components(links, folder, "first")

    # buckets with several components: the exact join among their members
    named = slots.join(cc.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")
    )
    named = written(named, folder, "named")
    mixed = written(
        named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi"),
        folder, "mixed",
    )
    open_docs = named.join(mixed, "bucket", "left_semi").select(F.col("rep").alias("id"), "component").distinct()
    open_sets = written(sets.join(open_docs, "id"), folder, "open")
    more = written(_verified(_prefix_pairs(open_sets, percent, folder), sets, percent), folder, "more")
    if more.head(1):
        cc = components(cc.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), folder, "all")

    member = sig.join(reps.select(*same_set, "rep"), same_set, "left").select("id", "n", F.coalesce("rep", "id").alias("rep"))
    grouped = member.join(cc.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep"))
    return grouped.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
