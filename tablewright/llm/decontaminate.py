"""Benchmark decontamination: SimHash of item-sized windows, Hamming index, exact check.

Text is reduced to words (letters and digits, lower case); a shingle is five
consecutive words, weighted by how often it occurs. An item matches a document
if some window of as many words as the item has a weighted similarity
(sum of minima / sum of maxima of the shingle weights) of at least ``threshold``.

1. Windows. Every position of every document is looked up among the shingles of
   the benchmark. Similarity t of bags of a and b shingles takes a sum of minima of
   at least t (a + b) / (1 + t), and a window's positions that hold a shingle of the
   item, wherever it stands there, are no fewer than that sum. So every window of
   n words (the whole text if it is shorter) with that many such positions is
   proposed for an item of n words, in whatever order its parts stand; all others
   stay below the threshold. At the edges of a text, the part inside it of a window
   that sticks out is proposed as well if a shingle stands where the item has it.
2. Fingerprints. Each proposed window gets a 128-bit SimHash of its weighted
   shingles, each item likewise.
3. Search. Fingerprints are cut into 16 blocks of 8 bits. If two differ in at
   most ``radius`` bits, they differ in at most radius // 16 bits in some block, so
   windows joined with all block values within that distance of an item's find
   every fingerprint within the radius (multi-index Hamming search).
4. Check. Windows within the radius are compared exactly with the item by the
   weighted similarity of their full shingle bags.

At similarity 0.8 the expected distance is about 19 of 128 bits with a deviation
of 4; the default radius of 40 is five deviations out. Items of k < 5 words are one
shingle, their whole word sequence, and are looked up among the k-word sequences of
every document; the first place of a text is reported.

The benchmark is the query set. One pass over the documents serves as many items as
have ``WORDS_AT_ONCE`` words (some tens of thousands of items; about 32 bytes a word
are sent to the tasks); a larger benchmark is taken in blocks of that many words, so
what is sent is bounded however many items there are. The documents are never paired
with all items, and hits join by block keys.

Null texts count as empty; empty documents and items match nothing. Repeated
item texts each match. Extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.work import small_batches, work_dir, written

WORDS = 5
THRESHOLD = 0.8
BITS, BLOCKS, BLOCK_BITS = 128, 16, 8
RADIUS = 40
WORDS_AT_ONCE = 2_000_000
INDEX_BYTES = 32 << 20  # of block keys that are broadcast; a larger index is joined by its keys
U = np.uint64


def _word_hashes(block: arrays.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased texts and the bounds of each text."""
    low = block.lower()
    starts, ends = low.runs(arrays.LETTER[low.data])
    return low.hashes(starts, ends), low.owners(starts)


def bag(words: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of one word sequence and their weights."""
    values, _ = arrays.shingles(words, np.array([0, len(words)]), k)
    return np.unique(values, return_counts=True)


def simhash(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """128-bit SimHash as 16 bytes."""
    high = arrays.mix64(values)
    low = arrays.mix64(values ^ U(0x6A09E667F3BCC909))
    raw = np.stack([high, low], axis=1).view(np.uint8).reshape(len(values), 16)
    bits = np.unpackbits(raw, axis=1).astype(np.int64) * 2 - 1
    return np.packbits((weights[:, None] * bits).sum(axis=0) > 0)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted shingle similarity of two bags: sum of minima over sum of maxima."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    inter = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - inter
    return float(inter) / float(total) if total else 0.0


def _items(rows: list[tuple]) -> dict:
    """Lookup arrays of one block of items: sorted shingle hashes with the item, its size and the shingle's position."""
    ids = [r[0] for r in rows]
    block = next(arrays.blocks(pa.array([r[1] for r in rows], pa.string()), size=1 << 62))
    hashes, bounds = _word_hashes(block)
    keys, owners, sizes, offsets, prints, bags = [], [], [], [], [], []
    for i in range(len(ids)):
        words = hashes[bounds[i]:bounds[i + 1]]
        values, _ = arrays.shingles(words, np.array([0, len(words)]), WORDS)
        keys.append(values)
        owners.append(np.full(len(values), i))
        sizes.append(np.full(len(values), len(words)))
        offsets.append(np.arange(len(values)))
        bags.append(bag(words))
        prints.append(simhash(*bags[-1]) if len(words) else np.zeros(16, np.uint8))
    keys, owners, sizes, offsets = map(np.concatenate, (keys, owners, sizes, offsets))
    order = np.argsort(keys, kind="stable")
    return {"ids": ids, "keys": keys[order], "owners": owners[order].astype(np.int64),
            "sizes": sizes[order].astype(np.int64), "offsets": offsets[order].astype(np.int64),
            "prints": prints, "bags": bags}


def _needed(a, b: int, threshold: float):
    """Least sum of minima with which bags of ``a`` and ``b`` shingles reach the threshold."""
    return np.maximum(1, np.ceil(threshold * (a + b) / (1 + threshold) - 1e-9)).astype(np.int64)


def _starts(at: np.ndarray, offset: np.ndarray, size: int, n_words: int, threshold: float) -> set:
    """Windows of a text that can reach an item of ``size`` words: ``at`` are the words at
    which shingles of the item begin, ``offset`` their positions in the item."""
    own = size - WORDS + 1
    places = np.unique(at)
    within = lambda lo, hi: np.searchsorted(places, hi - WORDS, side="right") - np.searchsorted(places, lo)
    found = set()
    if n_words <= size:
        if len(places) >= _needed(n_words - WORDS + 1, own, threshold):
            found.add((0, n_words))
    elif len(places) >= _needed(own, own, threshold):
        # only windows around some place, each start once
        lo = np.arange(max(0, places[0] - own + 1), min(n_words - size, places[-1]) + 1)
        lo = lo[within(lo, lo + size) >= _needed(own, own, threshold)]
        found.update(zip(lo.tolist(), (lo + size).tolist()))
    start = np.unique(at - offset)
    start = start[(start < 0) | (start + size > n_words)]
    lo, hi = np.maximum(start, 0), np.minimum(start + size, n_words)
    good = (hi - lo >= WORDS) & (within(lo, hi) >= _needed(hi - lo - WORDS + 1, own, threshold))
    found.update(zip(lo[good].tolist(), hi[good].tolist()))
    return found


def _hits(keys: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of an index into ``found`` and one into the sorted ``keys`` that holds the same hash."""
    lo, hi = np.searchsorted(keys, found), np.searchsorted(keys, found, side="right")
    times = hi - lo
    which = np.repeat(np.arange(len(found)), times)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + lo[which]


def _proposals(block: arrays.Block, lookup: tuple, threshold: float):
    """(text, first word, end word, hashes) of every window that can reach the threshold with some item."""
    keys, owners, sizes, offsets = lookup
    hashes, bounds = _word_hashes(block)
    counts = np.diff(bounds)
    windows: dict[int, set] = {}
    long = sizes >= WORDS
    values, text = arrays.shingles(hashes, bounds, WORDS)
    which, entry = _hits(keys[long], values)
    if len(which):
        item, offset, size = owners[long][entry], offsets[long][entry], sizes[long][entry]
        text, word = text[which], which - np.searchsorted(text, text[which])
        order = np.lexsort((word, item, text))
        text, item, offset, size, word = (x[order] for x in (text, item, offset, size, word))
        cuts = np.flatnonzero((text[1:] != text[:-1]) | (item[1:] != item[:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(text)]):
            i = int(text[lo])
            found = _starts(word[lo:hi], offset[lo:hi], int(size[lo]), int(counts[i]), threshold)
            if found:
                windows.setdefault(i, set()).update(found)
    for k in np.unique(sizes[~long]).tolist():
        for i, at in _short(hashes, bounds, keys[sizes == k], k):
            windows.setdefault(i, set()).add((at, at + k))
    for i in sorted(windows):
        words = hashes[bounds[i]:bounds[i + 1]]
        for lo, hi in sorted(windows[i]):
            yield i, lo, hi, words[lo:hi]


def _short(hashes: np.ndarray, bounds: np.ndarray, keys: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(text, word) of the first place of every item of ``k`` < WORDS words in every text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return []
    # the hash of a word sequence shorter than a shingle, as arrays.shingles has it
    value = np.full(n, k, U)
    for j in range(k):
        value = value * U(0x2545F4914F6CDD1D) + hashes[j:n + j]
    value = arrays.mix64(value ^ U(0x5DEECE66D))
    at = np.flatnonzero(np.isin(value, keys))
    text = np.searchsorted(bounds, at, side="right") - 1
    inside = at + k <= bounds[text + 1]
    at, text = at[inside], text[inside]
    _, first = np.unique(np.stack([text.astype(U), value[at]]), axis=1, return_index=True)
    return [(int(text[f]), int(at[f] - bounds[text[f]])) for f in first]


def _fingerprint(shared, threshold: float):
    """(id, text) -> one row per proposed window with its SimHash and shingle bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for block in arrays.blocks(batch.column(1)):
                out = {"id": [], "start": [], "words": [], "print": [], "items": [], "weights": []}
                for i, lo, hi, words in _proposals(block, lookup, threshold):
                    values, weights = bag(words)
                    out["id"].append(ids[block.first + i])
                    out["start"].append(lo)
                    out["words"].append(hi - lo)
                    out["print"].append(simhash(values, weights).tolist())
                    out["items"].append(arrays.signed(values).tolist())
                    out["weights"].append(weights.tolist())
                if out["id"]:
                    yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                        [("id", pa.int64()), ("start", pa.int64()), ("words", pa.int64()),
                         ("print", pa.list_(pa.int32())), ("items", pa.list_(pa.int64())),
                         ("weights", pa.list_(pa.int64()))]
                    ))

    return run


def block_neighbours(distance: int) -> list[int]:
    """All 8-bit masks with at most ``distance`` bits."""
    return [m for m in range(1 << BLOCK_BITS) if bin(m).count("1") <= distance]


def hamming(a, b):
    """Differing bits of two fingerprints held as arrays of byte values."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _within_radius(windows: DataFrame, items: dict, radius: int, folder: str) -> DataFrame:
    """Windows joined with the items whose fingerprint lies within ``radius``."""
    prints = windows.sparkSession.createDataFrame(
        [(n, p.tolist()) for n, p in enumerate(items["prints"]) if len(items["bags"][n][0])],
        "item int, item_print array<int>",
    )
    neighbours = block_neighbours(radius // BLOCKS)
    masks = F.array(*[F.lit(m) for m in neighbours])
    index = prints.select("item", F.posexplode("item_print").alias("block", "own"), masks.alias("masks")).select(
        "item", "block", F.explode(F.transform("masks", lambda m: F.col("own").bitwiseXOR(m))).alias("value")
    )
    if len(items["prints"]) * BLOCKS * len(neighbours) * 24 <= INDEX_BYTES:  # so many keys of at most 24 bytes
        index = F.broadcast(index)
    # a passage that many documents share is one fingerprint before its blocks are rows
    prints_found = written(windows.select("print").distinct(), folder, "prints")
    keyed = prints_found.select("print", F.posexplode("print").alias("block", "value"))
    near = (
        keyed.join(index, ["block", "value"]).select("print", "item").distinct()
        .join(prints, "item").where(hamming(F.col("print"), F.col("item_print")) <= radius).select("print", "item")
    )
    near = written(near, folder, "near")  # a passage in many documents stays a join Spark can split
    return windows.join(near, "print").select("id", "start", "words", "items", "weights", "item")


def _check(shared, threshold: float):
    """Exact weighted similarity of the remaining windows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, bags = shared.value
        for f in frames:
            rows = []
            for doc, start, words, values, weights, n in zip(f.id, f.start, f.words, f["items"], f.weights, f.item):
                window = np.asarray(values, np.int64).view(U), np.asarray(weights, np.int64)
                s = similarity(window, bags[n])
                if s >= threshold:
                    rows.append((doc, ids[n], start, words, s))
            yield pd.DataFrame(rows, columns=["id", "item_id", "start_word", "n_words", "similarity"])

    return run


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    words_at_once: int = WORDS_AT_ONCE,
) -> DataFrame:
    """``id, item_id, start_word, n_words, similarity``: the best window per document and item."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = work_dir(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    # blocks of the query set, each small enough for the driver and the tasks
    n_words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[A-Za-z0-9\x{80}-\x{10FFFF}]+")))).first()[0] or 0
    n_blocks = max(1, -(-n_words // words_at_once))
    block_of = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))
    found = None
    for b in range(n_blocks):
        part = _items([tuple(r) for r in items.where(block_of == b).toLocalIterator()] or [(None, "")])
        if not len(part["keys"]):
            continue
        lookup = spark.sparkContext.broadcast(tuple(part[c] for c in ("keys", "owners", "sizes", "offsets")))
        windows = written(
            texts.mapInArrow(
                _fingerprint(lookup, threshold),
                "id long, start long, words long, print array<int>, items array<long>, weights array<long>",
            ),
            folder, f"windows_{b}",
        )
        exact = spark.sparkContext.broadcast((part["ids"], part["bags"]))
        hits = _within_radius(windows, part, radius, f"{folder}/{b}").mapInPandas(
            _check(exact, threshold), "id long, item_id long, start_word long, n_words long, similarity double"
        )
        found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], "id long, item_id long, start_word long, n_words long, similarity double")
    best = found.groupBy("id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start_word")).alias("minus"), "n_words")).alias("b")
    )
    return best.select(
        F.col("id").alias(id_col), "item_id", (-F.col("b.minus")).alias("start_word"),
        F.col("b.n_words").alias("n_words"), F.round("b.similarity", 6).alias("similarity"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that match no item; rows without an id stay."""
    leaks = find_leaks(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias("_leak")).distinct()
    leaks = written(leaks, work_dir(docs.sparkSession), "leaks")
    return docs.join(leaks, F.col(id_col).cast("long") == F.col("_leak"), "left_anti")
