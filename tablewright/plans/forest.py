"""a bagged forest of trees grown until their leaves are pure.

Every tree weighs the rows by Poisson(1) draws that are a function of the row's key,
the seed and the tree's number (:func:`bag_weights`), so the forest is the same
however the rows lie on whatever cluster.

Growth has two steps. A node with more than ``row_bound`` rows is split by a pass
over all such nodes of all trees at once: candidate cuts are above and below the
table's quantiles of each feature, their gains come from grouped sums; a node that lies
between two of them is cut at the middle of its range, so that a node with two different
rows always parts. A pass reads the rows once, with their draws by all trees, and never
a row a tree. A node within the bound is handed off:
its rows meet in one group, keyed by (tree, node), and are finished there by exact
splits at every midpoint. With a table within the bound that is the whole tree. A
group is never larger than the bound, whatever the table, and a large node that is pure or
whose rows are all alike is a leaf at once, so a hot row never makes a large group.
Rows that are equal in features and target are one row with the sum of their draws
before they are dealt to the trees.

A model is two tables in the shared folder: the cuts and leaves above the hand-off
(``top``) and the nodes of the finished subtrees, a row each (``subtrees``). To predict,
a model of at most ``BROADCAST_BYTES`` (measured) is sent to the tasks; of a larger one
only the top (a row for every ``row_bound`` rows of a tree, about) passes the driver: the
different points go down it, meet their subtrees in groups of bounded size, and what the
trees say is joined to the rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.folds import key_text
from ..session import shared_dir

ROW_BOUND = 200_000
QUANTILES = 512
ACCURACY = 10_000
BROADCAST_BYTES = 8 << 20
BLOCK_ROWS = 1 << 16  # rows that a task takes down the top of the trees at once
TREES_PER_DIGEST = 4
SUBTREE_SCHEMA = "tree int, node string, at int, feature int, threshold double, left int, value double"
PARTS = ("feature", "threshold", "left", "value")
TOP_SCHEMA = "tree int, node string, feature int, threshold double, value double"


def poisson_cuts() -> list[int]:
    """Cumulative Poisson(1) probabilities as 32-bit integers: a uniform draw counts the cuts at or below it."""
    cuts, total = [], 0.0
    for k in range(20):
        total += math.exp(-1) / math.factorial(k)
        cut = int(total * 2**32)
        if cut < 2**32 - 1:
            cuts.append(cut)
    return cuts


def bag_weights(text: Column, num_trees: int, seed: int) -> Column:
    """``array<int>``: how often each tree draws the row with this key text (four trees a digest)."""
    digests = F.transform(
        F.sequence(F.lit(0), F.lit((num_trees - 1) // TREES_PER_DIGEST)),
        lambda i: F.md5(F.concat(F.coalesce(text, F.lit("")), F.lit(f":{seed}:"), i.cast("string"))),
    )
    cuts = np.array(poisson_cuts(), np.uint32)

    @F.arrow_udf("array<int>")
    def weights(digests: pa.Array) -> pa.Array:
        uniform = np.frombuffer(b"".join(digests.to_pylist()), ">u4").reshape(len(digests), -1)[:, :num_trees]
        found = np.searchsorted(cuts, uniform.astype(np.uint32).ravel(), side="right").astype(np.int32)
        return _lists(found.reshape(-1, num_trees))

    return F.when(text.isNull(), F.array_repeat(F.lit(0), num_trees)).otherwise(weights(F.unhex(F.array_join(digests, ""))))


# ---------------------------------------------------------------------------
# exact trees of one group


def _parted(order: np.ndarray, child: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """``order``, grouped by node, with the rows of each node's first child before those of its second (else as they were)."""
    right = child & 1
    second = np.cumsum(right) - right  # rows of second children so far
    at = np.arange(len(order))
    before = second[begin[child - right]]  # of the nodes before this one
    out = np.empty_like(order)
    out[np.where(right == 1, begin[child] + second - before, at - (second - before))] = order
    return out


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """A tree of exact least-squares splits grown until every leaf is pure.

    Nodes are numbered level by level (0 the root); ``left`` is the first of two
    neighbouring children, -1 in a leaf. Equal rows are one row first. All nodes of a
    level are split together over one sorted order a feature. Of equal gains the first
    feature and the lowest cut count.
    """
    order = np.lexsort((w, y, *x.T[::-1]))
    x, y, w = x[order], y[order], w[order]
    heads = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)]))
    sizes, sums = np.add.reduceat(w, heads), np.add.reduceat(w * y, heads)
    low, high = np.minimum.reduceat(y, heads), np.maximum.reduceat(y, heads)
    x = x[heads]
    feature, threshold = [np.array([-1], np.int32)], [np.zeros(1)]
    left, value = [np.array([-1], np.int32)], [np.array([sums.sum() / sizes.sum()])]
    node = np.zeros(len(x), np.int64)  # of the rows still in play, counted within the level
    first = 0  # number of the level's first node
    # of the features that differ within a node; one that does not never will below it
    orders = {j: np.argsort(x[:, j], kind="stable") for j in range(x.shape[1])}
    while len(node):
        count = int(node.max()) + 1
        # a node is done if it is pure or a single kind of row
        by = next(iter(orders.values()), None)
        by = np.argsort(node, kind="stable") if by is None else by
        starts = np.searchsorted(node[by], np.arange(count))
        done = (np.minimum.reduceat(low[by], starts) == np.maximum.reduceat(high[by], starts)) | (
            np.diff(np.append(starts, len(node))) == 1
        )
        stay = ~done[node]
        if not stay.any():
            break
        renumber = np.cumsum(~done) - 1
        back = np.cumsum(stay) - 1
        if not stay.all():
            orders = {j: back[o[stay[o]]] for j, o in orders.items()}
        x, sizes, sums, low, high = x[stay], sizes[stay], sums[stay], low[stay], high[stay]
        node, numbers = renumber[node[stay]], np.flatnonzero(~done)
        count = len(numbers)

        best = np.full(count, -np.inf)
        which, cut = np.zeros(count, np.int32), np.zeros(count)
        for j, o in list(orders.items()):
            n, v = node[o], x[o, j]
            fits = np.zeros(len(n), bool)
            fits[:-1] = (n[1:] == n[:-1]) & (v[1:] > v[:-1])
            if not fits.any():
                del orders[j]
                continue
            begin = np.searchsorted(n, np.arange(count))
            cw, cs = np.cumsum(sizes[o]), np.cumsum(sums[o])
            bw, bs = cw[begin] - sizes[o][begin], cs[begin] - sums[o][begin]
            end = np.append(begin[1:], len(n)) - 1
            tw, ts = cw[end] - bw, cs[end] - bs
            lw, ls = cw - bw[n], cs - bs[n]
            rw = np.where(fits, tw[n] - lw, 1.0)
            gain = np.where(fits, ls * ls / lw + (ts[n] - ls) ** 2 / rw, -np.inf)
            top = np.maximum.reduceat(gain, begin)
            better = top > best
            if not better.any():
                continue
            at = np.minimum.reduceat(np.where(gain == top[n], np.arange(len(n)), len(n)), begin)[better]
            middle = (v[at] + v[at + 1]) / 2
            best[better], which[better] = top[better], j
            cut[better] = np.where(middle < v[at + 1], middle, v[at])

        # the level's cuts, then its children as the next level
        feature[-1][numbers], threshold[-1][numbers] = which, cut
        left[-1][numbers] = first + len(feature[-1]) + 2 * np.arange(count)
        first += len(feature[-1])
        node = 2 * node + (x[np.arange(len(x)), which[node]] > cut[node])
        w_of, s_of = np.bincount(node, sizes, 2 * count), np.bincount(node, sums, 2 * count)
        feature.append(np.full(2 * count, -1, np.int32))
        threshold.append(np.zeros(2 * count))
        left.append(np.full(2 * count, -1, np.int32))
        value.append(s_of / w_of)
        begin = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=2 * count))])
        orders = {j: _parted(o, node[o], begin) for j, o in orders.items()}
    parts = {"feature": feature, "threshold": threshold, "left": left, "value": value}
    return {k: np.concatenate(v) for k, v in parts.items()}


def descend(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The leaf values of the rows of ``x``."""
    node = np.zeros(len(x), np.int64)
    todo = np.flatnonzero(tree["left"][node] >= 0)
    while len(todo):
        at = node[todo]
        node[todo] = tree["left"][at] + (x[todo, tree["feature"][at]] > tree["threshold"][at])
        todo = todo[tree["left"][node[todo]] >= 0]
    return tree["value"][node]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """A list a row of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _finish(table: pa.Table) -> pa.Table:
    tree = grow(*(f(table.column(c)) for f, c in ((_matrix, "x"), (pa.ChunkedArray.to_numpy, "y"), (pa.ChunkedArray.to_numpy, "w"))))
    n = len(tree["left"])
    return pa.table({
        "tree": pa.array(np.full(n, table.column("tree")[0].as_py(), np.int32)),
        "node": pa.repeat(pa.scalar(table.column("node")[0].as_py(), pa.string()), n),
        "at": pa.array(np.arange(n, dtype=np.int32)),
        "feature": pa.array(tree["feature"].astype(np.int32)),
        "threshold": pa.array(tree["threshold"]),
        "left": pa.array(tree["left"].astype(np.int32)),
        "value": pa.array(tree["value"]),
    })


def _arrays(nodes: pa.Table) -> dict[str, np.ndarray]:
    """The arrays of one subtree from its rows in any order."""
    order = np.argsort(nodes.column("at").to_numpy())
    return {k: nodes.column(k).to_numpy()[order] for k in PARTS}


# ---------------------------------------------------------------------------
# growth above the hand-off


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spread(df: DataFrame) -> DataFrame:
    """Work on a row is for every core, however few files the rows lie in."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if any(map(len, held)):
        yield pa.Table.from_batches(held)


def _below(x: np.ndarray, cuts: dict[str, tuple[int, float]]) -> tuple[list[str], np.ndarray]:
    """The nodes below the cuts of a tree, and in which of them each row is."""
    names: list[str] = []
    at = np.zeros(len(x), np.int64)
    todo = [("", np.arange(len(x)))]
    while todo:
        node, here = todo.pop()
        if node not in cuts:
            at[here] = len(names)
            names.append(node)
            continue
        feature, threshold = cuts[node]
        right = ~(x[here, feature] <= threshold)
        todo += [(node + "L", here[~right]), (node + "R", here[right])]
    return names, at


def _drawn(block: pa.Table, trees: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``tree, x, y, w`` of the rows of ``y, x, w`` that each tree drew."""
    x, y, w = _matrix(block.column("x")), block.column("y").to_numpy(), _matrix(block.column("w"))
    for tree in trees:
        rows = np.flatnonzero(w[:, tree])
        yield tree, x[rows], y[rows], w[rows, tree].astype(float)


SUMS_SCHEMA = "tree int, node string, feature int, bin int, n long, w double, s double, low double, high double"


def _sums(kinds: DataFrame, edges: list[np.ndarray], cuts: dict, active: dict) -> DataFrame:
    """Grouped sums of every active node by feature and bin: 2 i + 1 is edge i, 2 i lies below it. Feature -1: the target."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for tree, x, y, w in _drawn(block, active):
                names, at = _below(x, cuts.get(tree, {}))
                number = np.array([active[tree].get(n, -1) for n in names])[at]
                here = np.flatnonzero(number >= 0)
                if not len(here):
                    continue
                x, y, w, number = x[here], y[here], w[here], number[here]
                of = {i: n for n, i in active[tree].items()}
                for j in range(-1, x.shape[1]):
                    v, bins = (y, 1) if j < 0 else (x[:, j], 2 * len(edges[j]) + 1)
                    key = number * bins
                    if j >= 0:
                        i = np.searchsorted(edges[j], v)
                        key += 2 * i + (edges[j][np.minimum(i, len(edges[j]) - 1)] == v)
                    found, key = np.unique(key, return_inverse=True)
                    low, high = np.full(len(found), np.inf), np.full(len(found), -np.inf)
                    np.minimum.at(low, key, v)
                    np.maximum.at(high, key, v)
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array(np.full(len(found), tree, np.int32)),
                        "node": pa.array([of[i] for i in (found // bins).tolist()], pa.string()),
                        "feature": pa.array(np.full(len(found), j, np.int32)),
                        "bin": pa.array((found % bins).astype(np.int32)),
                        "n": pa.array(np.bincount(key)), "w": pa.array(np.bincount(key, w)),
                        "s": pa.array(np.bincount(key, w * y)), "low": pa.array(low), "high": pa.array(high),
                    })

    return _spread(kinds).mapInArrow(add, SUMS_SCHEMA).groupBy("tree", "node", "feature", "bin").agg(
        *(F.sum(c).alias(c) for c in ("n", "w", "s")), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _best(sums: DataFrame) -> DataFrame:
    """A row for every node: its totals, whether it is pure, its best cut, and the first feature that has two values."""
    whole = Window.partitionBy("tree", "node", "feature")
    below = whole.orderBy("bin")
    gains = sums.select(
        "tree", "node", "feature", "bin", F.sum("n").over(below).alias("ln"),
        F.sum("w").over(below).alias("lw"), F.sum("s").over(below).alias("ls"),
        *(F.sum(c).over(whole).alias(f"t{c}") for c in ("n", "w", "s")),
        F.min("low").over(whole).alias("low"), F.max("high").over(whole).alias("high"),
    )
    rest = F.col("tn") - F.col("ln")
    gain = F.col("ls") * F.col("ls") / F.col("lw") + (F.col("ts") - F.col("ls")) ** 2 / (F.col("tw") - F.col("lw"))
    cut = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "ln")
    target = F.col("feature") < 0
    return gains.groupBy("tree", "node").agg(
        F.max(F.when(target, F.col("tn"))).alias("n"), F.max(F.when(target, F.col("ts") / F.col("tw"))).alias("value"),
        F.max(F.when(target, F.col("low") == F.col("high"))).alias("pure"),
        F.max(F.when(~target & (rest > 0), cut)).alias("best"),
        F.min(F.when(~target & (F.col("low") < F.col("high")), F.struct("feature", "low", "high"))).alias("range"),
    )


def _edges(kinds: DataFrame, k: int) -> list[np.ndarray]:
    """The least value and the quantiles of every feature."""
    shares = [q / QUANTILES for q in range(1, QUANTILES)]
    found = _spread(kinds).agg(*(
        F.concat(F.array(F.min(F.col("x")[j])), F.percentile_approx(F.col("x")[j], shares, ACCURACY)) for j in range(k)
    )).first()
    return [np.unique(np.array(e, float)) for e in found]


def _top(kinds: DataFrame, k: int, trees: Iterable[int], bound: int) -> tuple[dict, dict]:
    """Cuts and leaves of the trees above the hand-off: ``{tree: {node: (feature, threshold)}}``, ``{tree: {node: value}}``."""
    edges = _edges(kinds, k)
    cuts: dict = {}
    leaves: dict = {}
    active = {tree: {"": 0} for tree in trees}
    while active:
        deeper: dict = {}
        # a row a node: never more than the drawn rows divided by the bound, and nodes cut in the middle
        for r in _best(_sums(kinds, edges, cuts, active)).collect():
            if r.pure or r.range is None:
                leaves.setdefault(r.tree, {})[r.node] = r.value
                continue
            if r.n <= bound:
                continue
            if r.best is not None:
                edge = edges[-r.best.f][-r.best.b // 2]
                cut, left = (-r.best.f, float(edge if r.best.b % 2 else np.nextafter(edge, -np.inf))), r.best.ln
                sizes = (left, r.n - left)
            else:
                middle = r.range.low / 2 + r.range.high / 2
                cut, sizes = (r.range.feature, middle if r.range.low <= middle < r.range.high else r.range.low), (r.n, r.n)
            cuts.setdefault(r.tree, {})[r.node] = cut
            for side, size in zip("LR", sizes, strict=True):
                if size > bound:
                    nodes = deeper.setdefault(r.tree, {})
                    nodes[r.node + side] = len(nodes)
        active = deeper
    return cuts, leaves


def _handed(kinds: DataFrame, trees: int, cuts: dict, leaves: dict) -> DataFrame:
    """``tree, node, w, y, x`` of the rows below the cuts that are in no leaf."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for tree, x, y, w in _drawn(block, range(trees)):
                names, at = _below(x, cuts.get(tree, {}))
                done = leaves.get(tree, {})
                here = np.flatnonzero(~np.array([n in done for n in names])[at])
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(len(here), tree, np.int32)), "node": pa.array(names, pa.string()).take(pa.array(at[here])),
                    "w": pa.array(w[here]), "y": pa.array(y[here]), "x": _lists(x[here]),
                })

    return _spread(kinds).mapInArrow(deal, "tree int, node string, w double, y double, x array<double>")


def grow_forest(
    rows: DataFrame, k: int, n_rows: int, folder: str, *, kinds: DataFrame, trees: int, row_bound: int = ROW_BOUND
) -> None:
    """Write the ``top`` and ``subtrees`` of the trees over ``tree, w, y, x`` below ``folder``; ``kinds`` are those rows as ``y, x, w`` with a draw a tree."""
    cuts, leaves = _top(kinds, k, range(trees), row_bound) if n_rows > row_bound else ({}, {})
    top = [(t, n, f, v, None) for t, of in cuts.items() for n, (f, v) in of.items()]
    top += [(t, n, -1, 0.0, v) for t, of in leaves.items() for n, v in of.items()]
    rows.sparkSession.createDataFrame(top, TOP_SCHEMA).coalesce(1).write.parquet(f"{folder}/top")
    groups = _handed(kinds, trees, cuts, leaves) if top else rows.withColumn("node", F.lit(""))
    groups.select("tree", "node", "w", "y", "x").groupBy("tree", "node").applyInArrow(_finish, SUBTREE_SCHEMA).write.parquet(
        f"{folder}/subtrees"
    )


# ---------------------------------------------------------------------------
# the estimator and its model


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    bootstrap = Param(Params._dummy(), "bootstrap", "whether each tree draws its rows", TypeConverters.toBoolean)
    rowBound = Param(Params._dummy(), "rowBound", "rows of a node that are finished in one group", TypeConverters.toInt)
    keyCols = Param(Params._dummy(), "keyCols", "columns that name a row (draws follow them)", TypeConverters.toListString)

    def _defaults(self):
        self._setDefault(numTrees=100, bootstrap=True, rowBound=ROW_BOUND, keyCols=[], seed=42)


class DeepForestRegressor(Estimator, _ForestParams):
    """Least-squares trees over bootstrap draws, all features at every split, no depth limit."""

    @keyword_only
    def __init__(self, *, numTrees=100, seed=42, bootstrap=True, rowBound=ROW_BOUND, keyCols=()):
        super().__init__()
        self._defaults()
        kwargs = {k: v for k, v in self._input_kwargs.items() if k != "keyCols"}
        self._set(**kwargs, keyCols=list(keyCols))

    def _fit(self, dataset: DataFrame) -> DeepForestModel:
        get = self.getOrDefault
        spark, keys = dataset.sparkSession, get("keyCols") or [c for c in dataset.columns if c != get("featuresCol")]
        trees = get("numTrees")
        weights = bag_weights(F.col("key"), trees, get("seed")) if get("bootstrap") else F.array_repeat(F.lit(1), trees)
        base = dataset.select(
            F.col(get("labelCol")).cast("double").alias("y"), vector_to_array(F.col(get("featuresCol"))).alias("x"),
            key_text(keys).alias("key"),
        )
        first = base.select(F.size("x")).first()
        if first is None:
            raise ValueError("no rows to fit")
        spread = _spread(base).select("y", "x", weights.alias("w"))
        # equal rows are one row in every tree, with their draws added (whole numbers, so in any order)
        drawn = F.array(*(F.sum(F.col("w")[t]) for t in range(trees)))
        kinds = _written(
            spread.groupBy("x", "y").agg(drawn.alias("w")), shared_dir(spark, "work", uuid.uuid4().hex, "kinds")
        )
        rows = _spread(kinds).select("y", "x", F.posexplode("w").alias("tree", "w")).where("w > 0").select(
            "tree", F.col("w").cast("double").alias("w"), "y", "x"
        )
        folder = shared_dir(spark, "forests", uuid.uuid4().hex)
        grow_forest(rows, first[0], kinds.count(), folder, kinds=kinds, trees=trees, row_bound=get("rowBound"))
        return self._copyValues(DeepForestModel(folder))


class DeepForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """The fitted trees: two tables below ``folder``."""

    def __init__(self, folder: str = ""):
        super().__init__()
        self._defaults()
        self.folder = folder
        self._sent = None

    def _read(self, name: str) -> DataFrame:
        schema = TOP_SCHEMA if name == "top" else SUBTREE_SCHEMA
        return SparkSession.active().read.schema(schema).parquet(f"{self.folder}/{name}")

    @property
    def top(self) -> DataFrame:
        return self._read("top")

    @property
    def subtrees(self) -> DataFrame:
        return self._read("subtrees")

    def size(self) -> int:
        """Bytes of the trees as arrays."""
        return 24 * self.subtrees.count() + 64 * self.top.count()

    # -- a model that fits into a task ---------------------------------------
    def _trees(self) -> list[dict[str, np.ndarray]]:
        """Every tree as one set of arrays: subtrees hung under the cuts of the top."""
        finished: dict[tuple[int, str], dict] = {}
        nodes = self.subtrees.orderBy("tree", "node", "at").toArrow()
        heads = np.flatnonzero(nodes.column("at").to_numpy() == 0).tolist()
        for lo, hi in zip(heads, [*heads[1:], len(nodes)], strict=True):
            part = nodes.slice(lo, hi - lo)
            finished[part.column("tree")[0].as_py(), part.column("node")[0].as_py()] = _arrays(part)
        cuts = {(r.tree, r.node): r for r in self.top.collect()}
        out = []
        for tree in range(self.getOrDefault("numTrees")):
            size, todo, places = 1, [("", 0)], []
            for node, at in todo:  # breadth first; children are neighbours
                places.append((node, at))
                if (cut := cuts.get((tree, node))) is not None and cut.feature >= 0:
                    todo += [(node + "L", size), (node + "R", size + 1)]
                    size += 2
                elif (tree, node) in finished:
                    size += len(finished[tree, node]["left"]) - 1
            parts = {"feature": np.zeros(size, np.int64), "threshold": np.zeros(size), "left": np.full(size, -1), "value": np.zeros(size)}
            taken = 1
            for node, at in places:
                cut = cuts.get((tree, node))
                if cut is not None and cut.feature >= 0:
                    parts["feature"][at], parts["threshold"][at], parts["left"][at] = cut.feature, cut.threshold, taken
                    taken += 2
                elif cut is not None:
                    parts["value"][at] = cut.value
                else:  # the root of a subtree takes this place, its other nodes the next free ones
                    sub = finished[tree, node]
                    index = np.concatenate([[at], taken + np.arange(len(sub["left"]) - 1)])
                    taken += len(sub["left"]) - 1
                    for k in ("feature", "threshold", "value"):
                        parts[k][index] = sub[k]
                    parts["left"][index] = np.where(sub["left"] >= 0, index[sub["left"]], -1)
            out.append(parts)
        return out

    def _broadcast_trees(self):
        spark = SparkSession.active()
        if self._sent is None or self._sent[0] != (self.folder, spark.sparkContext.applicationId):
            sent = spark.sparkContext.broadcast(self._trees())
            self._sent = ((self.folder, spark.sparkContext.applicationId), sent)
        return self._sent[1]

    def tree_predictions(self, features: Column) -> Column:
        """``array<double>``: what every tree says, for a model of at most ``BROADCAST_BYTES``."""
        if self.size() > BROADCAST_BYTES:
            raise ValueError("the model is too large to be sent to every task; with_tree_values joins it to the rows")
        sent = self._broadcast_trees()

        @F.arrow_udf("array<double>")
        def each(x: pa.Array) -> pa.Array:
            m = _matrix(x)
            return _lists(np.stack([descend(t, m) for t in sent.value], axis=1))

        return each(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault("predictionCol")
        if self.size() > BROADCAST_BYTES:
            total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
            return self._joined(dataset, total / F.size("values"), name)
        sent = self._broadcast_trees()

        @F.arrow_udf("double")
        def mean(x: pa.Array) -> pa.Array:
            m = _matrix(x)
            return pa.array(sum(descend(t, m) for t in sent.value) / len(sent.value))

        return dataset.withColumn(name, mean(vector_to_array(F.col(self.getOrDefault("featuresCol")))))

    # -- a model of any size --------------------------------------------------
    def with_tree_values(self, dataset: DataFrame, name: str) -> DataFrame:
        """The rows with what every tree says of them (``array<double>``, null of a tree without rows)."""
        trees = self.getOrDefault("numTrees")
        of = F.map_from_arrays("trees", "values")
        each = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: of[t])
        return self._joined(dataset, F.when(F.size("trees") == trees, F.col("values")).otherwise(each), name)

    def _joined(self, dataset: DataFrame, said: Column, name: str) -> DataFrame:
        """``said``, made of ``trees`` and ``values``, found once for the different points and joined to all rows."""
        work = shared_dir(dataset.sparkSession, "work", uuid.uuid4().hex)
        x = vector_to_array(F.col(self.getOrDefault("featuresCol")))
        rows = _written(dataset.drop(name).withColumn("__x", x), f"{work}/rows")
        points = _written(
            rows.select(F.col("__x").alias("x")).distinct().withColumn("point", F.monotonically_increasing_id()),
            f"{work}/points",
        )
        # in the order of the trees, so that sums are the same in every run
        of_point = F.sort_array(F.collect_list(F.struct("tree", "value")))
        # merge joins: a compressed file tells little of what its rows take in a hash table, which the driver would build
        values = self._values(points, work).groupBy("point").agg(of_point.alias("v")).select(
            "point", F.col("v.tree").alias("trees"), F.col("v.value").alias("values")
        )
        found = _written(
            points.hint("merge").join(values.select("point", said.alias(name)), "point").select(F.col("x").alias("__x"), name),
            f"{work}/found",
        )
        return rows.hint("merge").join(found, "__x", "left").select(*[F.col(f"`{c}`") for c in rows.columns if c != "__x"], name)

    def _values(self, points: DataFrame, work: str) -> DataFrame:
        """``point, tree, value`` of the table ``point, x``; no group holds more than ``rowBound`` points."""
        bound, trees, subtrees = self.getOrDefault("rowBound"), self.getOrDefault("numTrees"), self.subtrees
        cuts: dict = {}
        leaves: dict = {}
        for r in self.top.collect():
            (cuts if r.feature >= 0 else leaves).setdefault(r.tree, {})[r.node] = (r.feature, r.threshold) if r.feature >= 0 else r.value
        at = self._routed(points, trees, cuts, leaves)
        sizes = _written(self._counted(points, trees, cuts), f"{work}/sizes")
        # only tables with a row a node of the top are sent to all tasks; points and subtrees never are
        parts = F.broadcast(sizes.join(subtrees.where("at = 0").select("tree", "node"), ["tree", "node"]).select(
            "tree", "node", F.ceil(F.col("n") / bound).cast("int").alias("parts")
        ))
        salted = at.join(parts, ["tree", "node"]).select(
            "tree", "node", F.pmod(F.xxhash64("point"), F.col("parts")).alias("part"), "point", "x"
        )
        spread = subtrees.join(parts, ["tree", "node"]).select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part")
        ).drop("parts")

        def meet(points: pa.Table, nodes: pa.Table) -> pa.Table:
            found = descend(_arrays(nodes), _matrix(points.column("x"))) if len(points) else np.zeros(0)
            return pa.table({"point": points.column("point"), "tree": points.column("tree"), "value": pa.array(found)})

        key = ["tree", "node", "part"]
        found = salted.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(meet, "point long, tree int, value double")
        return found.unionByName(self._in_leaves(points, cuts, leaves)) if leaves else found

    @staticmethod
    def _routed(points: DataFrame, trees: int, cuts: dict, leaves: dict) -> DataFrame:
        """``tree, node, point, x``: every point below the top of every tree, but for the leaves there."""

        def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                x, point = _matrix(block.column("x")), block.column("point").to_numpy()
                for tree in range(trees):
                    names, at = _below(x, cuts.get(tree, {}))
                    done = leaves.get(tree, {})
                    here = np.flatnonzero(~np.array([n in done for n in names])[at])
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array(np.full(len(here), tree, np.int32)), "node": pa.array(names, pa.string()).take(pa.array(at[here])),
                        "point": pa.array(point[here]), "x": _lists(x[here]),
                    })

        return _spread(points).mapInArrow(go, "tree int, node string, point long, x array<double>")

    @staticmethod
    def _counted(points: DataFrame, trees: int, cuts: dict) -> DataFrame:
        """``tree, node, n``: how many points are below the top in every node."""

        def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                x = _matrix(block.column("x"))
                for tree in range(trees):
                    names, at = _below(x, cuts.get(tree, {}))
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array(np.full(len(names), tree, np.int32)), "node": pa.array(names, pa.string()),
                        "n": pa.array(np.bincount(at, minlength=len(names))),
                    })

        return _spread(points).mapInArrow(count, "tree int, node string, n long").groupBy("tree", "node").agg(F.sum("n").alias("n"))

    @staticmethod
    def _in_leaves(points: DataFrame, cuts: dict, leaves: dict) -> DataFrame:
        """``point, tree, value`` of the points in a leaf of the top."""

        def say(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                x, point = _matrix(block.column("x")), block.column("point").to_numpy()
                for tree, of in leaves.items():
                    names, at = _below(x, cuts.get(tree, {}))
                    value = np.array([of.get(n, np.nan) for n in names])[at]
                    here = np.flatnonzero(np.array([n in of for n in names])[at])
                    yield pa.RecordBatch.from_pydict({
                        "point": pa.array(point[here]), "tree": pa.array(np.full(len(here), tree, np.int32)), "value": pa.array(value[here]),
                    })

        return _spread(points).mapInArrow(say, "point long, tree int, value double")

    # -- persistence -----------------------------------------------------------
    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: DeepForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, SparkSession.active())
        self.instance.top.write.parquet(f"{path}/top")
        self.instance.subtrees.write.parquet(f"{path}/subtrees")


class _Reader(MLReader):
    def load(self, path: str) -> DeepForestModel:
        model = DeepForestModel(path)
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
