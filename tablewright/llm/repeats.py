"""Repeated byte passages by a sparse, distributed suffix array.

Every byte covered by a ``length``-byte string (400) that also starts anywhere
else in the table is found and can be removed.

Which suffixes. Sorting a suffix per byte of the corpus is not affordable at
100 TB, and not needed: two equal 400-byte strings contain the same k-byte grams,
so the leftmost gram of least hash inside each 400-byte window starts at the same
place of both. Only suffixes that start at such a place enter the suffix array
(about 2 in 370 bytes), and of those only the ones whose gram occurs again
(a grouped count). Each carries its ``right`` and ``left`` parts, the bytes from it on
and before it that its own windows reach.

Sorting. Suffixes with the same right and left parts are collapsed into one, with
their number (a partial aggregate, so thousands of copies cost one row). The rest
is sorted by merging: map tasks sort their suffixes into runs and front-code them
(length of the prefix shared with the predecessor, remaining bytes); the runs are
exchanged by gram; reduce tasks combine them with a loser tree that keeps, for
every run, the length of the prefix its head shares with the last winner. Heads
with different lengths are ordered by those lengths alone, and equal ones are
compared from that byte on, so a known prefix is never compared again. The merge
yields the suffix array and its LCP array.

Passages. A window with gram place p occurs again exactly if some other suffix q
has LCP(right) >= 400 - o and LCS(left) >= o for its offset o; the bytes covered
through p are then [p - LCS, p + LCP), and the union over q is one interval
around p. The LCP intervals are joined from the deepest up; each cluster keeps
its members ordered by the left part, and a join of two clusters inserts the
smaller into the larger and looks at the neighbours only: O(g log g) for a gram
with g different contexts, never all pairs.

Hot groups. A gram with more than ``hot`` different contexts (a short passage in
a large part of the corpus, with different surroundings) is not given to one
task. The offsets o are cut into strips; all windows of a strip contain the same
core around the place (400 bytes less the strip's width), so contexts that share
such a window share the core, and the group is refined by the hash of the core,
one row per strip a context has windows in. Groups that stay hot are refined
again with narrower strips, down to one offset, where the core is the window
itself and equality alone decides. Every level is a grouped count and exact.

Texts are taken as UTF-8 bytes, null as empty. Matches never cross documents.
Every row gets a key of its own in a written table first, and all steps go by it,
so rows with a null id or one id are documents like any other, with their own
places and spans. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.work import small_batches, work_dir, written

LENGTH = 400
GRAM = 32
HOT = 2000
STRIPS = 4  # strips of the first refinement, and how many times more in each next one
BUCKETS_PER_PARTITION = 4
BUCKET_BYTES = 32 << 20
_TEXTS_AT_ONCE = 1 << 16
U = np.uint64


# ---------------------------------------------------------------------------
# places: the leftmost least gram of every window


def gram_hashes(data: np.ndarray, k: int = GRAM) -> np.ndarray:
    """64-bit hash of every k-byte gram (k a power of two), by doubling."""
    h = arrays._VALUES[data]
    width = 1
    while width < k:
        h = h[:-width] * U(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        width *= 2
    return arrays.mix64(h)


def window_places(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every ``window`` consecutive hashes the position of the leftmost least one."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    bits = max(1, int(n - 1).bit_length())
    low = (hashes >> U(bits) << U(bits)) | np.arange(n, dtype=U)  # ties: the leftmost
    width = 1
    while width * 2 <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < window:
        low = np.minimum(low[:n - window + 1], low[window - width:])
    return (low & U((1 << bits) - 1)).astype(np.int64)


def text_places(data: np.ndarray, length: int = LENGTH, k: int = GRAM):
    """Places of one text, their gram hashes, and the first and last window each is the place of.

    Long texts go in overlapping pieces. The place never moves back from one
    window to the next, so the windows of a place are consecutive.
    """
    at, gram, window = [], [], []
    for lo in range(0, len(data) - length + 1, _TEXTS_AT_ONCE):
        h = gram_hashes(data[lo:lo + _TEXTS_AT_ONCE + length - 1], k)
        found = window_places(h, length - k + 1)
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        new[-1] = True  # keep the last window of the piece as well
        pick = np.unique(np.concatenate([np.flatnonzero(new), np.maximum(np.flatnonzero(new) - 1, 0)]))
        at.append(found[pick] + lo)
        gram.append(h[found[pick]])
        window.append(pick + lo)
    at, gram, window = np.concatenate(at), np.concatenate(gram), np.concatenate(window)
    heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    ends = np.append(heads[1:], len(at)) - 1
    return at[heads], gram[heads], window[heads], window[ends]


def _place_rows(length: int, k: int):
    """(id, text) -> places with the least and the largest offset in their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for raw in arrays.blocks(batch.column(1)):
                rows = []
                for i in np.flatnonzero(np.diff(raw.offsets) >= length):
                    at, gram, first, last = text_places(raw.data[raw.offsets[i]:raw.offsets[i + 1]], length, k)
                    rows.append((np.full(len(at), ids[raw.first + i], np.int64), at, gram, at - last, at - first))
                if rows:
                    doc, at, gram, least, most = (np.concatenate(c) for c in zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc), pa.array(at.astype(np.int32)), pa.array(arrays.signed(gram)),
                         pa.array(least.astype(np.int32)), pa.array(most.astype(np.int32))],
                        names=["id", "at", "gram", "least", "most"],
                    )

    return run


# ---------------------------------------------------------------------------
# contexts of the repeated places


def _contexts(length: int):
    """(id, text, places) -> one row per place with its left part (reversed) and right part.

    Together they are the bytes of the windows that have this place, and no more:
    inside a long periodic run all places then have one and the same context.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.flat(batch.column(1))
            rows: list[tuple] = []
            for i, (doc, marks) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                for mark in marks.as_py():
                    at, gram = mark["at"], mark["gram"]
                    left = text[at - mark["most"]:at][::-1]
                    right = text[at:at + length - mark["least"]]
                    digest = hashlib.blake2b(right + left, digest_size=14, salt=len(left).to_bytes(2, "big")).digest()
                    rows.append((gram, digest, doc, at, left, right))
                    if len(rows) >= 4096:
                        yield _context_batch(rows)
                        rows = []
            if rows:
                yield _context_batch(rows)

    return run


_CONTEXT = pa.schema(
    [("gram", pa.int64()), ("ctx", pa.binary()), ("id", pa.int64()), ("at", pa.int32()),
     ("left", pa.binary()), ("right", pa.binary())]
)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _CONTEXT)], schema=_CONTEXT
    )


# ---------------------------------------------------------------------------
# sorted runs, front coding, loser tree


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b``, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, step = start, 16
    while a[lo:lo + step] == b[lo:lo + step]:
        lo += step
        step *= 2
    hi = min(lo + step, n)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(run: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared prefix lengths and remaining bytes of a sorted run."""
    lengths, tails, last = [], [], b""
    for s in run:
        n = shared_prefix(last, s)
        lengths.append(n)
        tails.append(s[n:])
        last = s
    return lengths, tails


class Run:
    """Reads a front-coded run one suffix at a time."""

    def __init__(self, lengths, tails, payload):
        self._lengths, self._tails, self._payload = lengths, tails, payload
        self._i = -1
        self.head: bytes | None = b""

    def step(self) -> int:
        """Move to the next suffix; the length it shares with the one before."""
        self._i += 1
        if self._i >= len(self._lengths):
            self.head = None
            return -1
        n = int(self._lengths[self._i])
        self.head = self.head[:n] + self._tails[self._i]
        return n

    @property
    def item(self):
        return self._payload[self._i]


def merge_runs(runs: list[Run]) -> Iterator[tuple[bytes, int, object]]:
    """Merge front-coded runs: ``suffix, length shared with the suffix before, payload``.

    Loser tree over the run heads. ``known[r]`` is the prefix the head of run r
    shares with the last winner: every head on a leaf-to-root path lost against
    (or is) that winner, so the larger ``known`` is the smaller string, and only
    equal ones are compared, from that byte on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    known = [0] * size
    heads: list[bytes | None] = [None] * size
    for r, run in enumerate(runs):
        run.step()
        heads[r] = run.head

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes the one it shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = shared_prefix(x, y, known[a])
        if x[n:n + 1] <= y[n:n + 1]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    tree = [0] * size
    level = list(range(size))
    at = size
    while len(level) > 1:
        at //= 2
        nxt = []
        for i in range(0, len(level), 2):
            winner, loser = play(level[i], level[i + 1])
            tree[at + i // 2] = loser
            nxt.append(winner)
        level = nxt
    winner, lcp = level[0], 0
    while heads[winner] is not None:
        yield heads[winner], lcp, runs[winner].item
        known[winner] = max(0, runs[winner].step())
        heads[winner] = runs[winner].head
        node = (winner + size) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2
        lcp = known[winner]


def _write_runs(buckets: int):
    """Sort the suffixes of one batch into a front-coded run for each bucket of groups.

    A suffix is led by the eight bytes of its group, so groups stay apart in the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            ctx, left = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            suffix = [g + r for g, r in zip(_leads(group), batch.column(3).to_pylist())]
            bucket = (arrays.mix64(group) % U(buckets)).astype(np.int64).tolist()
            order = sorted(range(len(ctx)), key=lambda i: (bucket[i], suffix[i], left[i]))
            out = {"bucket": [], "lengths": [], "tails": [], "ctx": [], "left": []}
            i = 0
            while i < len(order):
                j = i
                while j < len(order) and bucket[order[j]] == bucket[order[i]]:
                    j += 1
                part = order[i:j]
                lengths, tails = front_code([suffix[x] for x in part])
                out["bucket"].append(bucket[order[i]])
                out["lengths"].append(lengths)
                out["tails"].append(tails)
                out["ctx"].append([ctx[x] for x in part])
                out["left"].append([left[x] for x in part])
                i = j
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("bucket", pa.int64()), ("lengths", pa.list_(pa.int32())), ("tails", pa.list_(pa.binary())),
                     ("ctx", pa.list_(pa.binary())), ("left", pa.list_(pa.binary()))]
                ),
            )

    return run


_LEAD = 8
_RUNS = "bucket long, lengths array<int>, tails array<binary>, ctx array<binary>, left array<binary>"


def _leads(group: np.ndarray) -> list[bytes]:
    raw = group.astype(">u8").tobytes()
    return [raw[i:i + _LEAD] for i in range(0, len(raw), _LEAD)]


# ---------------------------------------------------------------------------
# passages of the sorted suffixes


def reach(rights: list[int], lefts: list[bytes], length: int = LENGTH) -> tuple[list[int], list[int]]:
    """Per suffix, how many bytes before and after its place are covered by repeats.

    ``rights[i]`` is the LCP of suffix i with suffix i - 1 (sorted order), ``lefts``
    the reversed left parts. Clusters are joined from the deepest LCP up.
    """
    g = len(lefts)
    before, after = [0] * g, [0] * g
    rank = [0] * g
    by_left = sorted(range(g), key=lambda i: lefts[i])
    for r, i in enumerate(by_left):
        rank[i] = r
    cluster = list(range(g))
    members: list[list[int] | None] = [[rank[i]] for i in range(g)]  # sorted ranks

    def root(i: int) -> int:
        while cluster[i] != i:
            cluster[i] = cluster[cluster[i]]
            i = cluster[i]
        return i

    def meet(r: int, s: int, depth: int) -> None:
        x, y = by_left[r], by_left[s]
        same = shared_prefix(lefts[x], lefts[y])
        if same + depth >= length:
            for z in (x, y):
                before[z] = max(before[z], same)
                after[z] = max(after[z], depth)

    for i in sorted(range(1, g), key=lambda i: -rights[i]):
        a, b = root(i - 1), root(i)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        big, small = members[a], members[b]
        for r in small:
            big.insert(bisect_left(big, r), r)
        for r in small:
            p = bisect_left(big, r)
            if p:
                meet(r, big[p - 1], rights[i])
            if p + 1 < len(big):
                meet(r, big[p + 1], rights[i])
        cluster[b], members[b] = a, None
    return before, after


def _merge_bucket(length: int, k: int):
    """Merge the runs of one bucket and report the covered bytes around every context."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        runs = [
            Run(lengths, tails, list(zip(ctx, left)))
            for lengths, tails, ctx, left in zip(pdf.lengths, pdf.tails, pdf.ctx, pdf.left)
        ]
        group: list[tuple] = []
        out: list[tuple] = []
        for _, lcp, item in merge_runs(runs):
            if lcp < _LEAD + k and group:
                out += _close(group, length)
                group = []
            group.append((max(0, lcp - _LEAD), *item))
        out += _close(group, length)
        return pd.DataFrame(out, columns=["ctx", "before", "after"])

    return run


def _close(group: list[tuple], length: int) -> list[tuple]:
    before, after = reach([x[0] for x in group], [x[2] for x in group], length)
    return [(x[1], b, a) for x, b, a in zip(group, before, after) if a]


def _cores(length: int, k: int, strips: int):
    """(ctx, left, right) -> the hash of the core of every strip the context has windows in."""
    span = length - k + 1
    width = -(-span // strips)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners, numbers = [], [], []
            for ctx, left, right in zip(*(batch.column(c).to_pylist() for c in range(3))):
                text = left[::-1] + right
                for strip in range((length - len(right)) // width, len(left) // width + 1):
                    start = len(left) - strip * width
                    core = text[start:start + length - width + 1]
                    digest = hashlib.blake2b(core, digest_size=8, salt=strip.to_bytes(4, "big")).digest()
                    keys.append(int.from_bytes(digest, "big", signed=True))
                    owners.append(ctx)
                    numbers.append(strip)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(owners, pa.binary()), pa.array(numbers, pa.int32())],
                names=["group", "ctx", "strip"],
            )

    return run


def _groups(parts: DataFrame, folder: str, length: int, k: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Groups small enough for one task (``group, ctx, left, right``) and coverage found by equality alone."""
    span = length - k + 1
    texts = parts.select("ctx", "left", "right")
    small = parts.where(F.col("variants") <= hot).select(F.col("gram").alias("group"), "ctx", "left", "right")
    exact = parts.sparkSession.createDataFrame([], "ctx binary, before int, after int")
    rest = parts.where(F.col("variants") > hot).select("ctx", "left", "right")
    strips = 1
    while rest.head(1):
        strips = min(span, strips * STRIPS)
        name = f"strips_{strips}"
        cores = written(
            rest.mapInArrow(_cores(length, k, strips), "group long, ctx binary, strip int"), folder, name
        )
        sizes = written(
            cores.groupBy("group").agg(F.count("*").alias("variants")).where("variants > 1"), folder, f"{name}_sizes"
        )
        cores = written(cores.join(sizes, "group"), folder, f"{name}_groups")
        if strips == span:
            exact = cores.select("ctx", F.col("strip").alias("before"), (length - F.col("strip")).alias("after"))
            break
        refined = cores.where(F.col("variants") <= hot).select("group", "ctx")
        small = small.union(refined.join(texts, "ctx").select("group", "ctx", "left", "right"))
        again = cores.where(F.col("variants") > hot).select("ctx").distinct()
        rest = written(rest.join(again, "ctx", "left_semi"), folder, f"{name}_rest")
    return small, exact


# ---------------------------------------------------------------------------
# documents


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) -> merged spans, remaining text and its digest."""
    for batch in batches:
        data, offsets = arrays.flat(batch.column(1))
        n_bytes, n_removed, all_spans, kept, sha = [], [], [], [], []
        for i, spans in enumerate(batch.column(2).to_pylist()):
            text = data[offsets[i]:offsets[i + 1]].tobytes()
            merged: list[list[int]] = []
            for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            parts, last = [], 0
            for lo, hi in merged:
                parts.append(text[last:lo])
                last = hi
            left = b"".join([*parts, text[last:]])
            n_bytes.append(len(text))
            n_removed.append(len(text) - len(left))
            all_spans.append([{"start": lo, "stop": hi} for lo, hi in merged])
            kept.append(left)
            sha.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(all_spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                pa.array(kept, pa.binary()), pa.array(sha, pa.string()),
            ],
            names=["id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"],
        )


def repeated_spans(
    texts: DataFrame, folder: str, *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """``id, start, stop`` of covered bytes (may overlap) of the table ``id, text``."""
    spark = texts.sparkSession
    marks = texts.where(F.octet_length("text") >= length).mapInArrow(
        _place_rows(length, gram), "id long, at int, gram long, least int, most int"
    )
    marks = written(marks, folder, "places")
    # aggregates that a large side is joined with are written first: a join of two plain
    # exchanges is one whose hot keys Spark can split
    again = written(marks.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), folder, "again")
    per_doc = marks.join(again, "gram").groupBy("id").agg(
        F.collect_list(F.struct("at", "gram", "least", "most")).alias("places")
    )
    contexts = written(
        texts.join(per_doc, "id").select("id", "text", "places").mapInArrow(
            _contexts(length), "gram long, ctx binary, id long, at int, left binary, right binary"
        ),
        folder, "contexts",
    )
    # copies of one context become one row; a context that occurs twice is covered as a whole
    distinct = written(
        contexts.groupBy("gram", "ctx").agg(F.count("*").alias("copies"), F.min(F.struct("id", "at")).alias("first")),
        folder, "distinct",
    )
    variants = written(
        distinct.groupBy("gram").agg(F.count("*").alias("variants")).where("variants > 1"), folder, "variants"
    )
    open_ctx = distinct.join(variants, "gram").select(
        "gram", "ctx", "variants", F.col("first.id").alias("id"), F.col("first.at").alias("at")
    )
    parts = written(
        open_ctx.join(contexts.select("ctx", "id", "at", "left", "right"), ["id", "at", "ctx"])
        .select("gram", "ctx", "variants", "left", "right"),
        folder, "parts",
    )
    small, exact = _groups(parts, folder, length, gram, hot)
    # a bucket's runs meet in one task's memory: as many as the bytes of the contexts ask for
    size = parts.agg(F.sum(F.octet_length("left") + F.octet_length("right"))).first()[0] or 0
    buckets = max(BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    runs = small.mapInArrow(_write_runs(buckets), _RUNS)
    merged = runs.groupBy("bucket").applyInPandas(_merge_bucket(length, gram), "ctx binary, before int, after int")
    found = written(
        merged.union(exact).groupBy("ctx").agg(F.max("before").alias("before"), F.max("after").alias("after")),
        folder, "found",
    )

    whole = distinct.where("copies > 1").select("ctx")
    inside = contexts.select("ctx", "id", "at", F.octet_length("left").alias("l"), F.octet_length("right").alias("r"))
    full = inside.join(whole, "ctx").where(F.col("l") + F.col("r") >= length).select(
        "id", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + F.col("r")).alias("stop")
    )
    partly = inside.join(found, "ctx").select(
        "id", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("stop")
    )
    return full.union(partly)


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """``id, n_bytes, n_removed, spans, kept, kept_sha256`` for every document.

    ``spans`` are the maximal removed runs (start inclusive, stop exclusive),
    ``kept`` the remaining bytes.
    """
    small_batches(docs.sparkSession)
    folder = work_dir(docs.sparkSession)
    texts = written(
        docs.select(
            F.monotonically_increasing_id().alias("id"), F.col(id_col).cast("long").alias("doc"),
            F.col(text_col).cast("string").alias("text"),
        ),
        folder, "texts",
    )
    spans = repeated_spans(texts.select("id", "text"), folder, length=length, gram=gram, hot=hot)
    per_doc = written(
        spans.groupBy("id").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), folder, "spans"
    )
    out = texts.join(per_doc, "id", "left").select("doc", "text", "spans").mapInArrow(
        _cut,
        "id long, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, "
        "kept binary, kept_sha256 string",
    )
    return out.withColumnRenamed("id", id_col)
