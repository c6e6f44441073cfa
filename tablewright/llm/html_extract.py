"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf text blocks (``html_blocks``). Each block becomes a
vector of its hashed tag path (tag names and class, id and role words), its
hashed words and a few lengths; a bidirectional LSTM in numpy reads the whole
sequence and labels every block as main text or not, with the context of the
document before and after it. The text of a page is its main blocks, joined by
one line break; nothing else is dropped or capped.

Training. Pages carry no labels, so a teacher labels ``TRAIN_PAGES`` of them (of at
most ``TRAIN_BYTES``, those of least seeded digest of the id; stated bounds for
fitting): a block inside an
article or main element (or a container named like one) and outside menus,
headers, footers, asides, forms, notices, adverts and comments is main text.
The teacher's pages are also shown in rearranged templates (other containers,
extra notices, forms, comments, menus), some with all names hidden, so that the
labeller reads content and context rather than one layout or a list of names. The seed is fixed; equal input gives equal
weights. The labeller is applied to every page in one pass over the table, to short
pages some thousand blocks at once, to a longer page alone and in stretches that hand
their states on, so its memory is that of a stretch and of the page's own blocks.

Null and empty pages have an empty text. Repeated rows stay. Extra columns are
ignored. A table without pages trains on the built-in templates alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.html_blocks import Leaf, leaves
from tablewright.llm.work import small_batches

TRAIN_PAGES = 300
PATH_SIZE, WORD_SIZE, LENGTHS = 48, 24, 6
INPUT = PATH_SIZE + WORD_SIZE + LENGTHS
HIDDEN = 12
EPOCHS = 20
BATCH = 32
TRAIN_BYTES = 200_000  # of a page to learn from
CELLS = 4096  # blocks of the pages that are labelled at once
RATE = 0.02
SEED = 7

# Names that web pages give to containers of main text and of the rest.
MAIN_TAGS = frozenset(("article", "main"))
MAIN_LABELS = frozenset("article content post entry story main body text articlebody maincontent".split())
OTHER_TAGS = frozenset("nav header footer aside form menu dialog button select fieldset noscript".split())
OTHER_LABELS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb "
    "breadcrumbs header footer sidebar aside widget related share social comment comments respond reply disqus notice "
    "cookie cookies consent alert popup modal newsletter subscribe signup login search pagination pager".split()
)


def teacher(leaf: Leaf) -> int:
    """1 if the path says main text."""
    inside = False
    for tag, labels in leaf.path:
        if tag in OTHER_TAGS and not (tag == "header" and inside) or OTHER_LABELS.intersection(labels):
            return 0
        if tag in MAIN_TAGS or (tag in ("div", "section") and MAIN_LABELS.intersection(labels)):
            inside = True
    return int(inside)


# ---------------------------------------------------------------------------
# features


@lru_cache(maxsize=4096)
def _path_vector(path: tuple) -> np.ndarray:
    """Hashed tag names and labels; the deeper, the heavier."""
    v = np.zeros(PATH_SIZE)
    for depth, (tag, labels) in enumerate(path):
        weight = 0.5 + (depth + 1) / len(path)
        for word, share in ((tag, 1.0), *((f".{x}", 1.0) for x in labels)):
            h = zlib.crc32(word.encode())
            v[h % PATH_SIZE] += weight * share * (1 if h & 0x10000 else -1)
    return v


def vectors(blocks: list[Leaf]) -> np.ndarray:
    """One input vector per block (a flat sequence, pages one after the other)."""
    out = np.zeros((len(blocks), INPUT))
    if not blocks:
        return out
    column = pa.array([b.text for b in blocks], pa.string())
    for part in arrays.blocks(column):
        low = part.lower()
        starts, ends = low.words()
        bounds = low.owners(starts)
        counts = np.diff(bounds)
        h = low.hashes(starts, ends)
        owner = np.repeat(np.arange(part.n), counts)
        slot = (h % np.uint64(WORD_SIZE)).astype(np.int64)
        sign = np.where(h >> np.uint64(63), 1.0, -1.0)
        bag = np.bincount(owner * WORD_SIZE + slot, weights=sign, minlength=part.n * WORD_SIZE)
        rows = out[part.first:part.first + part.n]
        bag = bag.reshape(part.n, WORD_SIZE)
        rows[:, PATH_SIZE:PATH_SIZE + WORD_SIZE] = bag / np.maximum(np.linalg.norm(bag, axis=1), 1)[:, None]
        chars = np.diff(part.offsets)
        rows[:, -6] = np.log1p(chars) / 5
        rows[:, -5] = np.log1p(counts) / 4
        rows[:, -4] = part.counts(np.isin(part.data, (46, 44, 63, 33))) / np.maximum(counts, 1)
    for i, b in enumerate(blocks):
        out[i, :PATH_SIZE] = _path_vector(b.path)
        out[i, -3] = b.linked / len(b.text)
        out[i, -2] = len(b.path) / 10
        out[i, -1] = 1.0
    return out


# ---------------------------------------------------------------------------
# the network: padded sequences, time first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {}
    for side in "fb":
        w[f"{side}_x"] = rng.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * HIDDEN))
        w[f"{side}_h"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        w[f"{side}_c"] = np.zeros(4 * HIDDEN)
        w[f"{side}_c"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first
    w["o"] = rng.normal(0, 0.3, (2 * HIDDEN, 1))
    w["o_c"] = np.zeros(1)
    return w


def _lstm(x: np.ndarray, mask: np.ndarray, w, side: str, keep: bool, state=None):
    """Hidden states of one direction (x: time, pages, input), the tape, the last state; masked steps carry it on."""
    steps, pages = mask.shape
    h, c = state or (np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)))
    out = np.zeros((steps, pages, HIDDEN))
    pre = x @ w[f"{side}_x"] + w[f"{side}_c"]
    tape = []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        a = pre[t] + h @ w[f"{side}_h"]
        gates = _sigmoid(a[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(a[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        if keep:
            tape.append((t, h, c, i, f, o, g, tc, m))
        h = m * (o * tc) + (1 - m) * h
        c = m * c_new + (1 - m) * c
        out[t] = h
    return out, tape, (h, c)


def _lstm_back(grad_out, tape, x, w, side, grads) -> None:
    dh, dc = np.zeros_like(grad_out[0]), np.zeros_like(grad_out[0])
    for t, h, c, i, f, o, g, tc, m in reversed(tape):
        dh = dh + grad_out[t]
        do = m * dh * tc
        dcn = m * (dc + dh * o * (1 - tc * tc))
        da = np.concatenate(
            [dcn * g * i * (1 - i), dcn * c * f * (1 - f), do * o * (1 - o), dcn * i * (1 - g * g)], axis=1
        )
        grads[f"{side}_x"] += x[t].T @ da
        grads[f"{side}_h"] += h.T @ da
        grads[f"{side}_c"] += da.sum(axis=0)
        dh = (1 - m) * dh + da @ w[f"{side}_h"].T
        dc = dcn * f + (1 - m) * dc


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(s) for s in sequences)
    x = np.zeros((steps, len(sequences), INPUT))
    mask = np.zeros((steps, len(sequences)))
    for j, s in enumerate(sequences):
        x[:len(s), j] = s
        mask[:len(s), j] = 1
    return x, mask


def _outputs(x, mask, w, keep=False):
    hf, tape_f, _ = _lstm(x, mask, w, "f", keep)
    hb, tape_b, _ = _lstm(x, mask, w, "b", keep)
    h = np.concatenate([hf, hb], axis=2)
    return _sigmoid(h @ w["o"] + w["o_c"])[:, :, 0], h, tape_f, tape_b


def train(sequences: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Fit by back-propagation through time with Adam; deterministic."""
    rng = np.random.default_rng(SEED)
    w = initial(rng)
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), BATCH):
            part = sorted(order[at:at + BATCH], key=lambda j: len(sequences[j]))
            x, mask = _padded([sequences[j] for j in part])
            y = np.zeros_like(mask)
            for col, j in enumerate(part):
                y[:len(labels[j]), col] = labels[j]
            p, h, tape_f, tape_b = _outputs(x, mask, w, keep=True)
            d = ((p - y) * mask / mask.sum())[:, :, None]
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            grads["o"] = np.einsum("tph,tpo->ho", h, d)
            grads["o_c"] = d.sum(axis=(0, 1))
            dh = d @ w["o"].T
            _lstm_back(dh[:, :, :HIDDEN], tape_f, x, w, "f", grads)
            _lstm_back(dh[:, :, HIDDEN:], tape_b, x, w, "b", grads)
            step += 1
            for k in w:
                g = np.clip(grads[k], -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                w[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return w


def _long_page(blocks: list[Leaf], w: dict[str, np.ndarray]) -> np.ndarray:
    """Main-text flags of one long page, in stretches: forth with one direction, back with the other."""
    logit = np.full(len(blocks), w["o_c"][0])
    starts = range(0, len(blocks), CELLS)
    for side, stretches, out in (("f", starts, w["o"][:HIDDEN, 0]), ("b", reversed(starts), w["o"][HIDDEN:, 0])):
        state = None
        for at in stretches:
            x = vectors(blocks[at:at + CELLS])[:, None, :]
            h, _, state = _lstm(x, np.ones(x.shape[:2]), w, side, False, state)
            logit[at:at + CELLS] += h[:, 0] @ out
    return logit >= 0


def label_pages(pages: list[list[Leaf]], w: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Main-text flag of every block of every page; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((j for j in range(len(pages)) if pages[j]), key=lambda j: len(pages[j]))
    at = 0
    while at < len(order):
        if len(pages[order[at]]) > CELLS:
            out[order[at]] = _long_page(pages[order[at]], w)
            at += 1
            continue
        stop = at + 1  # as many as fit when padded to the longest
        while stop < len(order) and len(pages[order[stop]]) * (stop + 1 - at) <= CELLS:
            stop += 1
        part = order[at:stop]
        flat = vectors([b for j in part for b in pages[j]])
        bounds = np.concatenate([[0], np.cumsum([len(pages[j]) for j in part])]).astype(int)
        x, mask = _padded([flat[lo:hi] for lo, hi in zip(bounds, bounds[1:], strict=False)])
        p, *_ = _outputs(x, mask, w)
        for col, j in enumerate(part):
            out[j] = p[:len(pages[j]), col] >= 0.5
        at = stop
    return out


# ---------------------------------------------------------------------------
# training pages


MAIN_PATHS = (
    (("article", ()),), (("main", ()),), (("main", ()), ("article", ())), (("div", ("content",)),),
    (("div", ("post", "content")),), (("div", ("entry", "content")),), (("section", ("story",)),),
    (("div", ("main", "content")),), (("div", ("article", "body")),),
)
OTHER_PATHS = (
    (("nav", ()), ("ul", ()), ("li", ())), (("header", ()), ("p", ())), (("header", ()), ("div", ("menu",))),
    (("footer", ()),), (("footer", ()), ("p", ())), (("aside", ()), ("p", ())), (("aside", ()), ("ul", ()), ("li", ())),
    (("div", ("sidebar",)), ("p", ())), (("div", ("sidebar", "widget")), ("li", ())), (("div", ("ad",)),),
    (("div", ("advert",)), ("p", ())), (("div", ("banner",)),), (("div", ("sponsored",)),), (("form", ()), ("p", ())),
    (("form", ()), ("label", ())), (("form", ("search",)), ("button", ())), (("div", ("cookie", "notice")), ("p", ())),
    (("div", ("notice",)),), (("div", ("alert",)), ("p", ())), (("div", ("newsletter",)), ("form", ()), ("p", ())),
    (("div", ("comments",)), ("p", ())), (("section", ("comments",)), ("div", ("comment",)), ("p", ())),
    (("ul", ("comment", "list")), ("li", ()), ("p", ())), (("div", ("comment",)),), (("div", ("share",)),),
    (("div", ("related",)), ("ul", ()), ("li", ())), (("div", ("breadcrumb",)),), (("div", ("pagination",)),),
)
ROOTS = ((("html", ()), ("body", ())), (("html", ()), ("body", ()), ("div", ("page",))),
         (("html", ()), ("body", ()), ("div", ("wrapper",)), ("div", ("container",))))
INNER = (("p", ()), ("p", ()), ("p", ()), ("h2", ()), ("h3", ()), ("li", ()), ("blockquote", ()), ("div", ()))
FILLER = "of the in and a is it on by to was for as with der die das und la le les de el que".split()


def _nameless(path: tuple, names: dict, rng: np.random.Generator) -> tuple:
    """The path below the body with every container a div of a name that says nothing."""
    out = []
    for tag, labels in path:
        if tag in ("html", "body", "p", "h1", "h2", "h3", "li", "ul", "blockquote"):
            out.append((tag, ()))
        else:
            out.append(names.setdefault((tag, labels), ("div", (f"c{rng.integers(10**6)}",))))
    return tuple(out)


def rearranged(page: list[Leaf], rng: np.random.Generator, hidden: float = 0.0) -> tuple[list[Leaf], np.ndarray]:
    """The texts of a page in another template, with the labels that template implies.

    With a chance of ``hidden`` the containers have no telling names; then every
    container has the texts of its own kind.
    """
    nameless = rng.random() < hidden
    main = [b for b in page if teacher(b)]
    rest = [b for b in page if not teacher(b)]
    texts = [b.text for b in rest] or [" ".join(rng.choice(FILLER, int(rng.integers(1, 12))))]
    root = ROOTS[rng.integers(len(ROOTS))]
    wrap = MAIN_PATHS[rng.integers(len(MAIN_PATHS))]

    def other() -> list[Leaf]:
        path = root + OTHER_PATHS[rng.integers(len(OTHER_PATHS))]
        pool = texts if rng.random() < 0.6 or nameless or not main else [b.text for b in main]
        found = []
        for _ in range(int(rng.integers(1, 6))):
            text = pool[rng.integers(len(pool))]
            found.append(Leaf(path, text, len(text) if rng.random() < 0.3 else 0))
        return found

    out: list[Leaf] = []
    for _ in range(int(rng.integers(0, 4))):
        out += other()
    body = []
    for n, b in enumerate(main):
        tag = ("h1", ()) if n == 0 and rng.random() < 0.7 else INNER[rng.integers(len(INNER))]
        body.append(Leaf(root + wrap + (tag,), b.text, b.linked))
        if rng.random() < 0.05 and not nameless:  # an advert or a notice in between
            path = root + wrap + OTHER_PATHS[rng.integers(len(OTHER_PATHS))]
            body.append(Leaf(path, texts[rng.integers(len(texts))], 0))
    out += body
    for _ in range(int(rng.integers(0, 4))):
        out += other()
    labels = np.array([teacher(b) for b in out], float)
    if nameless:
        names: dict = {}
        out = [Leaf(_nameless(b.path, names, rng), b.text, b.linked) for b in out]
    return out, labels


def _built_in(rng: np.random.Generator) -> list[Leaf]:
    """A page of filler words, for a table that has none to learn from."""
    sentence = lambda n: " ".join(rng.choice(FILLER, n)).capitalize() + "."
    body = [Leaf((("html", ()), ("body", ()), ("article", ()), ("p", ())), sentence(int(rng.integers(8, 60))), 0)
            for _ in range(int(rng.integers(1, 9)))]
    return [Leaf((("html", ()), ("body", ()), ("nav", ())), sentence(2), 8), *body]


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> dict[str, np.ndarray]:
    """Weights from a bounded sample of the pages."""
    # the sample is chosen by digests; only its own texts leave the tasks
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).cast("string").alias("html")).where(
        (F.length("html") > 0) & (F.octet_length("html") <= TRAIN_BYTES)
    )
    keys = [F.xxhash64(F.lit("html"), "id").alias("k1"), F.xxhash64("html").alias("k2")]
    least = rows.select(*keys).distinct().orderBy("k1", "k2").limit(TRAIN_PAGES).collect()
    if least:
        table = pages.sparkSession.createDataFrame(least, "k1 long, k2 long")
        chosen = rows.select("html", *keys).join(F.broadcast(table), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
        rows = sorted(chosen.collect(), key=lambda r: (r.k1, r.k2))
    else:
        rows = []
    rng = np.random.default_rng(SEED)
    real = [leaves(r["html"]) for r in rows]
    real = [p for p in real if p]
    source = real or [_built_in(rng) for _ in range(40)]
    blocks = [(p, np.array([teacher(b) for b in p], float)) for p in real if any(teacher(b) for b in p)]
    blocks += [rearranged(p, rng, hidden) for hidden in (0.0, 0.0, 1.0) for p in source]
    blocks = [(p, y) for p, y in blocks if p]
    return train([vectors(p) for p, _ in blocks], [y for _, y in blocks])


# ---------------------------------------------------------------------------
# Spark


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            pages = [leaves(h) if h else [] for h in batch.column(2).to_pylist()]
            texts = [
                "\n".join(b.text for b, main in zip(page, flags) if main)
                for page, flags in zip(pages, label_pages(pages, w))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(p) for p in pages], pa.int64())],
                names=["id", "url", "text", "n_blocks"],
            )

    return run


def extract_main_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    weights: dict[str, np.ndarray] | None = None,
) -> DataFrame:
    """``id, url, text, n_chars, n_blocks`` of every page; ``weights`` as from ``fit``."""
    spark = pages.sparkSession
    small_batches(spark)
    if weights is None:
        weights = fit(pages, id_col=id_col, html_col=html_col)
    shared = spark.sparkContext.broadcast(weights)
    out = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    ).mapInArrow(_extract(shared), "id long, url string, text string, n_blocks long")
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
        F.length("text").cast("long").alias("n_chars"), "n_blocks",
    )
