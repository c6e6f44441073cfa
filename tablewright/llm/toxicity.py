"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary text, give the probability of every byte of
a word after the bytes before it (up to ``ORDER - 1`` of them, words padded by a
start and an end mark). Words are runs of letters and digits, lower-cased. The highest order is counted per class
with absolute discounting; all lower orders are Kneser-Ney continuation counts
of both classes together. So an expression one class has hardly seen falls back
to the same shared estimate in both and says nothing, while the endings of an
unseen word of a known family are still recognised.

Score. Each word has a log-likelihood ratio. A text is described by its
length-normalised difference (mean per byte) and by the same difference over its
most suspicious words (so that a few expressions in a long text count), and a
logistic calibration turns them into a score between 0 and 1. It is fitted by
cross-fitting: every row is described with the counts of the other parts of the
sample, so it never meets its own counts. Texts without words get the prior.

Learning. Labels come only from documents whose crc32(doc_id as text) mod 5 is
not 0, at most ``max_rows`` of each class and as many as have ``max_bytes`` of text,
those of least seeded digest and each whole (stated bounds for fitting a classifier,
which also bound the model that is sent to the tasks; all rows are used below them,
and the first row of a class always). Both classes are
counted over all those labels: the prior is their share, and in the calibration
a row stands for as many as its class has rows in the sample, so the bound does
not move the scores. Counting n-grams runs as a
grouped aggregate over the n-grams of those rows. Every whole text of the table
is then scored in one pass; label, language, source and id are no inputs.

Null texts count as empty. Repeated label rows count once (the larger label);
labels without a document and null labels are ignored. With no label of one
class the prior is all there is: every score is the share of toxic labels (0 if
there are none). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.work import small_batches, work_dir, written

ORDER = 8
DISCOUNT = 0.75
MAX_ROWS = 6000
MAX_BYTES = 48 << 20
FOLDS, HELD_OUT = 5, 0
PARTS = 3  # of the sample, for cross-fitting
LEVELS = (1.5, 3.0, 4.5, 6.0)
N_FEATURES = 3 + len(LEVELS)
START, END = 0x01, 0x02
U = np.uint64


# ---------------------------------------------------------------------------
# n-grams of words


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed ORDER-byte n-grams (the byte and those before it) and the word of each."""
    if not words:
        return np.zeros(0, U), np.zeros(0, np.int64)
    pad = bytes([START]) * (ORDER - 1)
    data = np.frombuffer(pad + (bytes([END]) + pad).join(words) + bytes([END]), np.uint8).astype(U)
    packed = np.zeros(len(data) - ORDER + 1, U)
    for j in range(ORDER):
        packed = (packed << U(8)) | data[j:len(data) - ORDER + 1 + j]
    lengths = np.array([len(w) + 1 for w in words], np.int64)  # with the end mark
    steps = lengths + ORDER - 1
    begin = np.concatenate([[0], np.cumsum(steps)[:-1]])
    owner = np.repeat(np.arange(len(words)), lengths)
    inside = np.repeat(begin, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return packed[inside], owner


def lowered(column: pa.Array) -> Iterator[arrays.Block]:
    """Blocks of the lower-cased texts."""
    return arrays.blocks(pc.utf8_lower(pc.fill_null(column, "")))


def distinct_words(block: arrays.Block):
    """Distinct words of a block, the index of every word and the bounds of the texts."""
    starts, ends = block.runs(arrays.LETTER[block.data])
    hashes = block.hashes(starts, ends)
    _, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    raw = block.data.tobytes()
    words = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
    return words, index, block.owners(starts)


# ---------------------------------------------------------------------------
# the models


@dataclass
class Model:
    """Log-likelihood ratios of seen n-grams and of unseen ones after a seen context."""

    grams: np.ndarray  # sorted packed n-grams
    gram_llr: np.ndarray
    contexts: np.ndarray  # sorted packed contexts
    context_llr: np.ndarray
    weights: np.ndarray  # calibration
    centre: np.ndarray
    scale: np.ndarray
    prior: float


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, weights=values, minlength=len(unique))


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each wanted key and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def shared_backoff(grams: np.ndarray) -> np.ndarray:
    """Kneser-Ney continuation probability of the last byte, one order below, for every distinct n-gram."""
    probability = None
    types = grams  # distinct n-grams of the order above
    by_order = []
    for order in range(ORDER - 1, 0, -1):
        keep = U((1 << (8 * order)) - 1)
        key, count = _sums(types & keep, np.ones(len(types)))  # how many bytes precede it
        by_order.append((order, key, count))
        types = key
    for order, key, count in reversed(by_order):
        context, total = _sums(key >> U(8), count)
        _, kinds = _sums(key >> U(8), np.ones(len(key)))
        i, _ = _at(context, key >> U(8))
        lower = 1 / 256 if probability is None else None
        if lower is None:
            low_key, low_p = probability
            j, _ = _at(low_key, key & U((1 << (8 * (order - 1))) - 1))
            lower = low_p[j]
        p = np.maximum(count - DISCOUNT, 0) / total[i] + DISCOUNT * kinds[i] / total[i] * lower
        probability = key, p
    key, p = probability
    j, _ = _at(key, grams & U((1 << (8 * (ORDER - 1))) - 1))
    return p[j]


def fit_counts(grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray):
    """Log-likelihood ratios from the n-gram counts of both classes."""
    order = np.argsort(grams)
    grams, counts = grams[order], (toxic[order].astype(float), ordinary[order].astype(float))
    backoff = shared_backoff(grams)
    contexts = np.unique(grams >> U(8))
    at, _ = _at(contexts, grams >> U(8))
    log_p, log_rest = [], []
    for count in counts:
        total = np.bincount(at, weights=count, minlength=len(contexts))
        kinds = np.bincount(at, weights=count > 0, minlength=len(contexts))
        rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)  # mass left to the backoff
        p = np.maximum(count - DISCOUNT, 0) / np.maximum(total, 1)[at] + rest[at] * backoff
        log_p.append(np.log(p))
        log_rest.append(np.log(rest))
    return (
        grams, (log_p[0] - log_p[1]).astype(np.float32),
        contexts, (log_rest[0] - log_rest[1]).astype(np.float32),
    )


def word_ratios(words: list[bytes], model) -> np.ndarray:
    """Log-likelihood ratio of every word (sum over its bytes and the end mark)."""
    grams, gram_llr, contexts, context_llr = model
    packed, owner = ngrams(words)
    at, seen = _at(grams, packed)
    at2, known = _at(contexts, packed >> U(8))
    value = np.where(seen, gram_llr[at] if len(gram_llr) else 0.0,
                     np.where(known, context_llr[at2] if len(context_llr) else 0.0, 0.0))
    return np.bincount(owner, weights=value, minlength=len(words))


def features(block: arrays.Block, model) -> np.ndarray:
    """Per text: mean ratio per byte, the same over its most suspicious words, their number, its length."""
    words, index, bounds = distinct_words(block)
    out = np.zeros((block.n, N_FEATURES))
    counts = np.diff(bounds)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    ratio = word_ratios(words, model)
    size = np.array([len(w) + 1 for w in words], float)
    heads = bounds[:-1][full]
    total = np.add.reduceat(ratio[index], heads)
    bytes_ = np.add.reduceat(size[index], heads)
    out[full, 0] = total / bytes_
    top = ratio[index]
    out[full, 1] = np.maximum.reduceat(top, heads)
    # words at least e**level times likelier in toxic text, and the length, as log counts
    for j, level in enumerate(LEVELS):
        out[full, 2 + j] = np.log1p(np.add.reduceat((top > level).astype(float), heads))
    out[full, -1] = np.log1p(counts[full])
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 1.0):
    """Weights of a ridge logistic regression, each row counted ``times`` (Newton steps)."""
    centre = np.average(x, axis=0, weights=times)
    scale = np.sqrt(np.average((x - centre) ** 2, axis=0, weights=times)) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (times * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(penalty + 1e-9),
            z.T @ (times * (y - p)) - penalty * w,
        )
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w, centre, scale


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    if not len(model.weights):
        return np.full(len(x), model.prior)
    z = np.column_stack([np.ones(len(x)), (x - model.centre) / model.scale])
    p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -30, 30)))
    p[x[:, -1] == 0] = model.prior  # no words
    return p


# ---------------------------------------------------------------------------
# Spark

COLUMNS = [f"f{j}" for j in range(N_FEATURES)]
GROUPS = [f"{kind}_{part}" for part in range(PARTS) for kind in ("ordinary", "toxic")]


def fold_of(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5."""
    return F.crc32(id_col.cast("string")) % FOLDS


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, toxic, text) -> counts of packed n-grams by part and class, summed over each block."""
    for batch in batches:
        group = (2 * batch.column(0).to_numpy(zero_copy_only=False) + batch.column(1).to_numpy(zero_copy_only=False))
        for block in lowered(batch.column(2)):
            words, index, bounds = distinct_words(block)
            if not words:
                continue
            packed, owner = ngrams(words)
            keys, inverse = np.unique(packed, return_inverse=True)
            of_word = np.repeat(group[block.first:block.first + block.n], np.diff(bounds))
            columns = []
            for g in range(2 * PARTS):
                times = np.bincount(index, weights=of_word == g, minlength=len(words))[owner]
                columns.append(pa.array(np.bincount(inverse, weights=times, minlength=len(keys)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(keys)), *columns], names=["gram", *GROUPS])


def _training(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folder: str, max_rows: int, max_bytes: int
):
    """``part, toxic, text``: the bounded sample of labelled rows outside the held-out fold; all such rows by class."""
    marked = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_of(F.col("id")) != HELD_OUT))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0))
    copies = docs.select(F.col(id_col).cast("long").alias("id"), size.alias("size")).groupBy("id").agg(
        F.count("*").alias("copies"), F.sum("size").alias("size")
    )
    marked = written(marked.join(copies, "id"), folder, "marked")
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.sum("copies").alias("n")).collect()}
    digest = F.xxhash64(F.lit("toxicity"), F.col("id"))
    sample = None
    for value in (0, 1):
        part = marked.where(F.col("toxic") == value).select("id", "toxic", "size").orderBy(digest, "id").limit(max_rows)
        # at most max_rows rows of ids and sizes
        before = Window.orderBy(digest, "id").rowsBetween(Window.unboundedPreceding, -1)
        part = part.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(
            (F.col("before") == 0) | (F.col("before") + F.col("size") <= max_bytes)
        ).select("id", "toxic")
        sample = part if sample is None else sample.union(part)
    sample = written(sample, folder, "sample")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("id")), F.lit(PARTS))
    rows = texts.join(F.broadcast(sample), "id").select(part.alias("part"), "toxic", "text")
    return written(rows, folder, "training"), totals


def _feature_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in lowered(batch.column(1)):
                x = features(block, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n)] + [pa.array(x[:, j]) for j in range(N_FEATURES)],
                    names=["toxic", *COLUMNS],
                )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> Model:
    """The two models and the calibration, from the labelled rows outside the held-out fold.

    ``max_rows`` and ``max_bytes`` bound the sample of each class (``MAX_ROWS``, ``MAX_BYTES``).
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = work_dir(spark)
    max_rows, max_bytes = max_rows or MAX_ROWS, max_bytes or MAX_BYTES
    rows, totals = _training(docs, labels, id_col, text_col, label_col, folder, max_rows, max_bytes)
    empty = np.zeros(0)
    if not totals.get(0) or not totals.get(1):
        prior = 1.0 if totals.get(1) else 0.0
        return Model(np.zeros(0, U), empty, np.zeros(0, U), empty, empty, empty, empty, prior)
    counts = (
        rows.select(F.col("part").cast("int").alias("part"), "toxic", "text")
        .mapInArrow(_count_ngrams, "gram long, " + ", ".join(f"{g} long" for g in GROUPS))
        .groupBy("gram").agg(*[F.sum(g).cast("int").alias(g) for g in GROUPS])
        .toArrow()
    )
    grams = counts["gram"].to_numpy().view(U)
    by_part = {g: counts[g].to_numpy() for g in GROUPS}
    del counts

    def ratios(parts: list[int]):
        toxic = sum(by_part[f"toxic_{p}"] for p in parts)
        ordinary = sum(by_part[f"ordinary_{p}"] for p in parts)
        seen = toxic + ordinary > 0
        return fit_counts(grams[seen], toxic[seen], ordinary[seen])

    rated = []
    for part in range(PARTS):
        others = spark.sparkContext.broadcast(ratios([p for p in range(PARTS) if p != part]))
        rated.append(
            rows.where(F.col("part") == part).select("toxic", "text")
            .mapInArrow(_feature_rows(others), "toxic int, " + ", ".join(f"{c} double" for c in COLUMNS))
        )
    x = reduce(DataFrame.union, rated).orderBy("toxic", *COLUMNS).toArrow()
    llr = ratios(list(range(PARTS)))
    y = x["toxic"].to_numpy().astype(float)
    prior = totals[1] / (totals[0] + totals[1])
    times = np.where(y == 1, totals[1] / max(1, (y == 1).sum()), totals[0] / max(1, (y == 0).sum()))
    found = fit_logistic(np.column_stack([x[c].to_numpy() for c in COLUMNS]), y, times)
    return Model(*llr, *found, prior)


def _score_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        llr = (model.grams, model.gram_llr, model.contexts, model.context_llr)
        for batch in batches:
            for block in lowered(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n), pa.array(scores(features(block, llr), model))],
                    names=["id", "score"],
                )

    return run


def score_documents(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = texts.mapInArrow(_score_rows(shared), "id long, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(fold_of(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _keep(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        llr = (model.grams, model.gram_llr, model.contexts, model.context_llr)
        for batch in batches:
            found = [scores(features(block, llr), model) for block in lowered(batch.column(text_at))]
            if found:
                yield batch.filter(pa.array(np.concatenate(found) < 0.5))

    return run


def keep_ordinary(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keep(shared, docs.columns.index(text_col)), docs.schema)
