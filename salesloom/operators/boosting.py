"""Histogram gradient boosting of several models over the same rows, in shared passes.

Features are binned once, missing values in a bin of their own.  A pass adds up
gradients by (model, node, feature, bin) over blocks of rows, brings the sums of a node
together, and finds its best split where they meet; the driver sees one split a node.
All models (say, five folds and the main one) grow the same level of the same round
in one pass, so six models cost the passes of one.  A model whose rows are one block
(``ROWS_PER_BLOCK``) has its sums complete in that block and needs no exchange; there
the smaller child of a node is summed, and the larger one is what its parent has more.

Blocks are small objects of numpy arrays, kept by Spark between passes; what a round
adds to the scores is a step of their lineage, which a checkpoint in the shared folder
cuts every ``CHECKPOINT_EVERY`` rounds.  Planning a DataFrame 1800 times would take
longer than the passes, which is why this one operator works on an RDD.
Gradients are rounded to multiples of 2**-20, so that sums are exact and no order of
adding changes a tree.

A tree is grown level by level and then cut back to what best-first growth with
``max_leaves`` leaves gives, which is the same tree, as a node's best split depends on
its own rows only.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import shared_root, ship

MAX_BINS = 255  # of a feature, beside the one for missing values
LEAST_HESSIAN = 1e-3  # of a leaf
ROWS_PER_BLOCK = 1 << 20  # 36 bytes a row with 20 features
ROWS_PER_SUM = 1 << 16  # so many rows are summed at a time; see _ROW
CHECKPOINT_EVERY = 25  # rounds
ROUNDS_TOGETHER = 25  # of a model that is one block
_UNIT = float(1 << 20)
# A hessian is a quarter of _UNIT at most, so those of ROWS_PER_SUM rows stay below this weight
# of a row, and one sum (below 2**53) holds both the hessians and the number of rows.
_ROW = float(1 << 35)
_FEW = 2048  # rows whose cells are summed in one call for all features

CHUNKS = pa.schema([("block", pa.int64()), ("held", pa.binary()), ("label", pa.binary())])
NODES = "tree int, node int, feature string, cut double, missing_left boolean, value double"


@dataclass
class Tree:
    """Nodes by heap number (children of n: 2n and 2n + 1); feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(depth: int) -> Tree:
        n = 1 << (depth + 1)
        return Tree(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n))


@dataclass
class Bins:
    """Upper edges of each feature's bins; the last bin has none, and one more is for missing values."""

    edges: list[np.ndarray]

    def __post_init__(self) -> None:
        self.count = np.array([len(e) + 1 for e in self.edges])
        self.first = np.concatenate(([0], np.cumsum(self.count + 1)))
        self.cells = int(self.first[-1])

    def of(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(values.shape, np.uint8)
        for f, edges in enumerate(self.edges):
            column = values[:, f]
            out[:, f] = np.where(np.isnan(column), self.count[f], np.searchsorted(edges, column))
        return out


def bins_of(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> Bins:
    """Edges at quantiles of all rows, in one aggregate of bounded memory."""
    shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    row = df.agg(*[
        F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), shares, 40 * max_bins)
        .alias(f"q{i}") for i, f in enumerate(features)
    ]).first()
    return Bins([np.unique(np.array(q or [], float)) for q in row])


def _route(tree: Tree, bins: np.ndarray, count: np.ndarray, depth: int) -> np.ndarray:
    """The node each row ends in."""
    node = np.ones(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        feature = tree.feature[node]
        inner = feature >= 0
        if not inner.any():
            break
        held = bins[rows, feature]
        left = (held <= tree.bin[node]) | (tree.missing_left[node] & (held == count[feature]))
        node = np.where(inner, 2 * node + ~left, node)
    return node


def _weights(label: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of each row, and its hessian together with the row's own weight."""
    chance = 1.0 / (1.0 + np.exp(-raw))
    return np.rint((chance - label) * _UNIT), np.rint(chance * (1.0 - chance) * _UNIT) + _ROW


def _cell_sums(held: np.ndarray, rows: np.ndarray, gradient: np.ndarray, weight: np.ndarray,
               bins: Bins) -> np.ndarray:
    """Sums of gradient, hessian and rows by cell of some rows of a block."""
    out = np.zeros((3, bins.cells))
    for start in range(0, len(rows), ROWS_PER_SUM):
        some = rows[start:start + ROWS_PER_SUM]
        g, w = gradient[some], weight[some]
        if len(some) < _FEW:
            cells = (held[:, some] + bins.first[:-1, None]).ravel()
            gradients = np.bincount(cells, np.tile(g, len(held)), bins.cells)
            both = np.bincount(cells, np.tile(w, len(held)), bins.cells)
        else:
            gradients, both = np.empty(bins.cells), np.empty(bins.cells)
            for f, size in enumerate((bins.count + 1).tolist()):
                own = slice(bins.first[f], bins.first[f] + size)
                column = held[f][some].astype(np.intp)
                gradients[own] = np.bincount(column, g, size)
                both[own] = np.bincount(column, w, size)
        number = np.floor(both / _ROW)
        out += np.stack((gradients, both - number * _ROW, number))
    return out


def _sums(block: tuple, tree: Tree, active: np.ndarray, bins: Bins, depth: int) -> Iterable[tuple]:
    """((model, node), sums of gradient, hessian and rows by cell) of the active nodes."""
    model, held, label, raw = block
    if not len(label):
        return
    node = _route(tree, held.T, bins.count, depth)
    order = np.argsort(node, kind="stable")
    ordered = node[order]
    gradient, weight = _weights(label, raw)
    for n in active.tolist():
        rows = order[np.searchsorted(ordered, n):np.searchsorted(ordered, n, side="right")]
        yield (model, n), _cell_sums(held, rows, gradient, weight, bins)


def best_split(sums: np.ndarray, bins: Bins, least_rows: int) -> tuple | None:
    """(gain, feature, bin, missing left, left G H n, all G H n) of a node; None without any.

    Equal gains go to the first feature and bin, missing values to the right.
    """
    sums = sums / np.array([[_UNIT], [_UNIT], [1.0]])
    total = sums[:, :bins.first[1]].sum(1)
    run = np.cumsum(sums, 1)
    before = np.concatenate((np.zeros((3, 1)), run[:, bins.first[1:-1] - 1]), 1)
    left = run - np.repeat(before, bins.count + 1, 1)
    missing_cell = bins.first[1:] - 1
    missing = np.repeat(sums[:, missing_cell], bins.count + 1, 1)
    best = None
    for missing_left in (False, True) if missing[2].any() else (False,):
        g, h, n = left + missing if missing_left else left
        other_g, other_h, other_n = total[0] - g, total[1] - h, total[2] - n
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g * g / h + other_g * other_g / other_h - total[0] ** 2 / total[1]
        allowed = (n >= least_rows) & (other_n >= least_rows) & (h >= LEAST_HESSIAN) & (other_h >= LEAST_HESSIAN)
        if missing_left:
            allowed &= missing[2] > 0
        allowed[missing_cell] = False
        gain = np.where(allowed, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > 1e-12 and (best is None or gain[at] > best[0]):
            feature = int(np.searchsorted(bins.first, at, side="right")) - 1
            # values not missing in training go with the larger side
            unseen = missing[2, at] == 0 and n[at] > other_n[at]
            best = (float(gain[at]), feature, at - int(bins.first[feature]), bool(missing_left or unseen),
                    (float(g[at]), float(h[at]), float(n[at])), tuple(map(float, total)))
    return best


def _finished(splits: Mapping[int, tuple], whole: tuple, depth: int, max_leaves: int, step: float) -> Tree:
    """The tree of the splits that best-first growth takes."""
    tree = Tree.of(depth)
    sums = {1: whole}
    frontier = [(-splits[1][0], 1)] if 1 in splits else []
    leaves = 1
    while frontier and leaves < max_leaves:
        _, node = heapq.heappop(frontier)
        _, tree.feature[node], tree.bin[node], tree.missing_left[node], left, all_ = splits[node]
        sums[2 * node], sums[2 * node + 1] = left, tuple(a - b for a, b in zip(all_, left))
        leaves += 1
        for child in (2 * node, 2 * node + 1):
            if child in splits:
                heapq.heappush(frontier, (-splits[child][0], child))
    for node, (g, h, _) in sums.items():
        if tree.feature[node] < 0 and h > 0:
            tree.value[node] = -step * g / h
    return tree


def _split(at: tuple, sums: np.ndarray, bins: Bins, least_rows: int) -> tuple:
    """(model, node), its best split and its own sums."""
    total = sums[:, :bins.first[1]].sum(1) / np.array([_UNIT, _UNIT, 1.0])
    return at, best_split(sums, bins, least_rows), tuple(total.tolist())


def _grow(models: Sequence[int], splits_of: Callable, depth: int, least_rows: int, max_leaves: int,
          step: float) -> dict[int, Tree]:
    """The next tree of each model; ``splits_of`` gives the splits of a level's nodes."""
    splits: dict[int, dict[int, tuple]] = {m: {} for m in models}
    partial = {m: Tree.of(depth) for m in models}
    whole: dict[int, tuple] = {}
    active = {m: np.array([1]) for m in models}
    for level in range(depth):
        if not active:
            break
        following: dict[int, list[int]] = {}
        for (m, node), best, total in splits_of(partial, active, level):
            if node == 1:
                whole[m] = total
            if best is not None:
                splits[m][node] = best
                _, partial[m].feature[node], partial[m].bin[node], partial[m].missing_left[node], left, all_ = best
                for child, n in ((2 * node, left[2]), (2 * node + 1, all_[2] - left[2])):
                    if n >= 2 * least_rows:
                        following.setdefault(m, []).append(child)
        active = {m: np.array(sorted(a)) for m, a in following.items()}
    return {m: _finished(splits[m], whole[m], depth, max_leaves, step) for m in models}


def _with_tree(block: tuple, tree: Tree, bins: Bins) -> tuple:
    m, held, label, raw = block
    depth = len(tree.feature).bit_length() - 2
    return m, held, label, raw + tree.value[_route(tree, held.T, bins.count, depth)]


class _Alone:
    """A block that holds all rows of its model while one tree grows: rows and sums by node."""

    def __init__(self, block: tuple, bins: Bins, least_rows: int) -> None:
        self.model, self.held, self.label, self.raw = block
        self.bins, self.least_rows = bins, least_rows
        self.gradient, self.weight = _weights(self.label, self.raw)
        self.rows = {1: np.arange(len(self.label))}
        self.sums: dict[int, np.ndarray] = {}

    def rows_of(self, tree: Tree, node: int) -> np.ndarray:
        if node not in self.rows:
            up = node >> 1
            rows, feature = self.rows_of(tree, up), int(tree.feature[up])
            held = self.held[feature][rows]
            left = held <= tree.bin[up]
            if tree.missing_left[up]:
                left |= held == self.bins.count[feature]
            self.rows[2 * up], self.rows[2 * up + 1] = rows[left], rows[~left]
        return self.rows[node]

    def own_sums(self, tree: Tree, node: int) -> np.ndarray:
        return _cell_sums(self.held, self.rows_of(tree, node), self.gradient, self.weight, self.bins)

    def sums_of(self, tree: Tree, node: int) -> np.ndarray:
        """All sums are whole numbers, so what is left of the parent's is what adding would give."""
        if node not in self.sums:
            other = node ^ 1
            if node == 1 or len(self.rows_of(tree, node)) <= len(self.rows_of(tree, other)):
                self.sums[node] = self.own_sums(tree, node)
            else:
                if other not in self.sums:
                    self.sums[other] = self.own_sums(tree, other)
                self.sums[node] = self.sums[node >> 1] - self.sums[other]
        return self.sums[node]

    def splits(self, partial: dict[int, Tree], active: dict[int, np.ndarray], level: int) -> list[tuple]:
        tree, nodes = partial[self.model], active[self.model].tolist()
        found = [_split((self.model, n), self.sums_of(tree, n), self.bins, self.least_rows) for n in nodes]
        for n in [n for n in self.sums if n < 1 << level]:
            del self.sums[n]
        return found

    def with_tree(self, tree: Tree) -> tuple:
        raw, todo = self.raw.copy(), [1]
        while todo:
            n = todo.pop()
            if tree.feature[n] < 0:
                raw[self.rows_of(tree, n)] += tree.value[n]
            else:
                todo += [2 * n, 2 * n + 1]
        return self.model, self.held, self.label, raw


def _grown_alone(block: tuple, rounds: int, bins: Bins, how: Mapping) -> tuple:
    """Some rounds of a model all of whose rows are in this block, and their trees.

    The sums need no exchange then; the trees are those that exchanged sums would give.
    """
    trees = []
    for _ in range(rounds):
        alone = _Alone(block, bins, how["least_rows"])
        trees.append(_grow([alone.model], alone.splits, **how)[alone.model])
        block = alone.with_tree(trees[-1])
    return (*block, trees)


def _leaf_masks(tree: Tree, count: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray] | None:
    """For each feature of the tree, the leaves each bin leaves open, as bits; and the leaves' values.

    The masks of a row's bins have one leaf in common, the one it ends in.  None for
    trees of more than 64 leaves.
    """
    depth = len(tree.feature).bit_length() - 2
    inner, leaves, todo = [], [], [1]
    while todo:
        n = todo.pop()
        if tree.feature[n] < 0:
            leaves.append(n)
        else:
            inner.append(n)
            todo += [2 * n, 2 * n + 1]
    if len(leaves) > 64:
        return None
    below = np.zeros(len(tree.feature), np.uint64)
    below[leaves] = np.uint64(1) << np.arange(len(leaves), dtype=np.uint64)
    for level in reversed(range(depth)):
        own = slice(1 << level, 2 << level)
        below[own] |= below[2 << level:4 << level:2] | below[(2 << level) + 1:4 << level:2]
    nodes = np.array(sorted(inner, key=tree.feature.__getitem__), np.int64)
    feature, every = tree.feature[nodes], np.arange(MAX_BINS + 1)
    left = (every <= tree.bin[nodes][:, None]) | (
        tree.missing_left[nodes][:, None] & (every == count[feature][:, None]))
    opened = below[1] & ~np.where(left, below[2 * nodes + 1][:, None], below[2 * nodes][:, None])
    used, starts = np.unique(feature, return_index=True)
    masks = np.bitwise_and.reduceat(opened, starts) if len(nodes) else opened
    return list(zip(used.tolist(), masks)), tree.value[leaves]


@dataclass
class Boosted:
    """A fitted model: probability 1 / (1 + exp(-(base + values of the leaves)))."""

    features: list[str]
    base: float
    edges: list[np.ndarray]
    trees: list[Tree]

    def rows(self) -> list[tuple]:
        """The node table: tree, node, feature, cut, missing_left, value (of leaves).

        Values up to the cut go to node 2n, larger ones to 2n + 1, missing ones where
        the flag says.  Tree -1 has the base as its only leaf.
        """
        out: list[tuple] = [(-1, 1, None, None, None, float(self.base))]
        for t, tree in enumerate(self.trees):
            todo = [1]
            while todo:
                n = todo.pop()
                f = int(tree.feature[n])
                if f < 0:
                    out.append((t, n, None, None, None, float(tree.value[n])))
                    continue
                edges, b = self.edges[f], int(tree.bin[n])
                cut = float(edges[b]) if b < len(edges) else math.inf
                out.append((t, n, self.features[f], cut, bool(tree.missing_left[n]), None))
                todo += [2 * n, 2 * n + 1]
        return out

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), NODES)

    @cached_property
    def masks(self) -> list[tuple | None]:
        count = Bins(self.edges).count
        return [_leaf_masks(tree, count) for tree in self.trees]

    def predict(self, values: np.ndarray) -> np.ndarray:
        bins = Bins(self.edges)
        held = bins.of(values)
        columns = np.ascontiguousarray(held.T).astype(np.intp)
        raw = np.full(len(values), self.base)
        for tree, masks in zip(self.trees, self.masks):
            if masks is None:
                raw += tree.value[_route(tree, held, bins.count, len(tree.feature).bit_length() - 2)]
                continue
            by_feature, leaves = masks
            left = np.full(len(values), 1, np.uint64)
            for k, (f, mask) in enumerate(by_feature):
                left = left & mask[columns[f]] if k else mask[columns[f]]
            # the exponent of a power of two is the number of its bit
            raw += leaves[(left.astype(float).view(np.int64) >> 52) - 1023]
        return 1.0 / (1.0 + np.exp(-raw))

    def score(self, columns: Sequence[Column]) -> Column:
        """The probability, from columns in the order of ``features``; Arrow batches, no row at a time."""
        return score_by([self], F.lit(0), columns)

    def save(self, spark: SparkSession, path: str) -> None:
        """The node table with the edges beside it, one file each."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = json.dumps({"features": self.features, "edges": [e.tolist() for e in self.edges],
                           "depth": [len(t.feature).bit_length() - 2 for t in self.trees]})
        spark.createDataFrame([(head,)], "head string").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        head = json.loads(spark.read.parquet(f"{path}/head").first()["head"])
        edges = [np.array(e, float) for e in head["edges"]]
        trees, base = [Tree.of(d) for d in head["depth"]], 0.0
        for t, n, feature, cut, missing_left, value in spark.read.parquet(f"{path}/nodes").collect():
            if t < 0:
                base = value
            elif feature is None:
                trees[t].value[n] = value
            else:
                f = head["features"].index(feature)
                trees[t].feature[n], trees[t].missing_left[n] = f, missing_left
                trees[t].bin[n] = np.searchsorted(edges[f], cut)
        return Boosted(head["features"], base, edges, trees)


def score_by(models: Sequence[Boosted], which: Column, columns: Sequence[Column]) -> Column:
    """The probability by the model whose number ``which`` holds; NULL for any other number."""
    shared = SparkSession.getActiveSession()
    ship(shared)
    held = shared.sparkContext.broadcast(list(models))

    @F.pandas_udf("double")
    def predict(which: pd.Series, *series: pd.Series) -> pd.Series:
        values = np.column_stack([s.to_numpy(float, na_value=np.nan) for s in series])
        number, out = which.to_numpy(float, na_value=np.nan), np.full(len(which), np.nan)
        for k, model in enumerate(held.value):
            mine = number == k
            if mine.any():
                out[mine] = model.predict(values[mine])
        return pd.Series(out).astype("Float64").where(~np.isnan(out))

    return predict(which, *[c.cast("double") for c in columns])


def relational_scores(rows: DataFrame, nodes: DataFrame, key: str, depth: int, out: str = "score") -> DataFrame:
    """``key`` and score from the node table alone: a join for each level, then a sum.

    What any SQL engine can do with a model; every row meets every tree, so for whole
    tables ``Boosted.score`` is the faster way.
    """
    features = [c for c in rows.columns if c != key]
    values = F.array(*[F.col(c).cast("double") for c in features])
    place = F.create_map(*[p for i, c in enumerate(features) for p in (F.lit(c), F.lit(i))])
    # a row becomes one for each tree, so even a small table is dealt to many tasks
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = rows.select(key, values.alias("_values")).repartition(parts, key).select(
        key, "_values", F.explode(F.sequence(
            F.lit(-1), nodes.agg(F.max("tree")).scalar())).alias("_tree")).withColumn("_node", F.lit(1))
    inner = F.broadcast(nodes.where("feature is not null").select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), place[F.col("feature")].alias("_place"),
        "cut", "missing_left"))
    for _ in range(depth):
        value = F.col("_values")[F.col("_place")]
        left = F.when(value.isNull() | F.isnan(value), F.col("missing_left")).otherwise(value <= F.col("cut"))
        at = at.join(inner, (F.col("_tree") == F.col("_t")) & (F.col("_node") == F.col("_n")), "left").select(
            key, "_values", "_tree", F.when(F.col("_t").isNull(), F.col("_node")).otherwise(
                2 * F.col("_node") + F.when(left, 0).otherwise(1)).alias("_node"))
    leaves = F.broadcast(nodes.where("feature is null").select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), "value"))
    raw = at.join(leaves, (F.col("_tree") == F.col("_t")) & (F.col("_node") == F.col("_n"))).groupBy(key).agg(
        F.sum("value").alias("_raw"))
    return raw.select(key, (1 / (1 + F.exp(-F.col("_raw")))).alias(out))


def fit(
    df: DataFrame, features: Sequence[str], label: str, models: Mapping[str, Column], iterations: int,
    step: float, depth: int, least_rows: int, max_leaves: int = 31, max_bins: int = MAX_BINS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> dict[str, Boosted]:
    """A model for each condition in ``models``, fitted to the rows that meet it.

    ``df`` is read several times and should be stored.  Rows without label are left
    out.  A model without rows of both classes has no trees.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    ship(spark)
    known = df.where(F.col(label).isNotNull())
    bins = bins_of(known, features, max_bins)
    names = list(models)
    flags = [F.coalesce(c, F.lit(False)).alias(f"_m{i}") for i, c in enumerate(models.values())]
    shaped = known.select(F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
                          F.col(label).cast("double").alias("y"), *flags)
    sizes = shaped.agg(F.count(F.lit(1)), *[F.count_if(f"_m{i}") for i in range(len(names))],
                       *[F.sum(F.when(F.col(f"_m{i}"), F.col("y"))) for i in range(len(names))]).first()
    rows = sizes[1:1 + len(names)]
    base = []
    for n, positive in zip(rows, sizes[1 + len(names):]):
        share = (positive or 0.0) / n if n else 0.5
        base.append(math.log(share / (1 - share)) if 0 < share < 1 else 0.0)
    trained = [m for m, (n, s) in enumerate(zip(rows, sizes[1 + len(names):])) if n and 0 < (s or 0) < n]
    blocks = max(1, math.ceil(sizes[0] / rows_per_block))

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            number, x, y, *mine = (batch.column(i) for i in range(batch.num_columns))
            held = bins.of(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features)))
            y, number = y.to_numpy(), number.to_numpy()
            for k in np.unique(number).tolist():
                for m in trained:
                    rows = np.flatnonzero(mine[m].to_numpy(zero_copy_only=False) & (number == k))
                    if len(rows):
                        yield pa.RecordBatch.from_pydict({
                            "block": [k * len(names) + m], "held": [np.ascontiguousarray(held[rows].T).tobytes()],
                            "label": [y[rows].astype(float).tobytes()]}, CHUNKS)

    def joined(number: int, chunks: Iterable) -> Iterable[tuple]:
        held, label = [], []
        for _, (cells, y) in chunks:
            held.append(np.frombuffer(cells, np.uint8).reshape(len(features), -1))
            label.append(np.frombuffer(y, float))
        if held:
            m, y = number % len(names), np.concatenate(label)
            yield m, np.concatenate(held, axis=1), y, np.full(len(y), base[m])

    # a row goes to a block by its values, so a task that runs again makes a block of the same rows
    number = F.pmod(F.xxhash64("x", "y"), F.lit(blocks)).alias("number")
    chunks = shaped.select(number, "*")
    if blocks > 1:
        chunks = chunks.repartition(blocks, "number")
    chunks = chunks.mapInArrow(binned, "block long, held binary, label binary")
    tasks = blocks * len(names)
    state = chunks.rdd.map(lambda r: (r[0], (r[1], r[2]))).partitionBy(tasks, lambda k: k).mapPartitionsWithIndex(
        joined, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_root(spark))
    reducers = max(1, min(tasks, context.defaultParallelism))
    trees: dict[int, list[Tree]] = {m: [] for m in range(len(names))}
    how = {"depth": depth, "least_rows": least_rows, "max_leaves": max_leaves, "step": step}
    older, done = [], 0
    while trained and done < iterations:
        rounds = min(ROUNDS_TOGETHER, iterations - done) if blocks == 1 else 1
        if blocks == 1:
            def grown(block: tuple, rounds=rounds) -> tuple:
                return _grown_alone(block[:4], rounds, bins, how)
        else:
            def splits(partial: dict[int, Tree], active: dict[int, np.ndarray], level: int, state=state) -> list[tuple]:
                def sums(block: tuple) -> Iterable[tuple]:
                    if block[0] in active:
                        yield from _sums(block, partial[block[0]], active[block[0]], bins, level)

                return state.flatMap(sums).reduceByKey(np.add, reducers).map(
                    lambda entry: _split(*entry, bins, least_rows)).collect()

            added = _grow(trained, splits, **how)

            def grown(block: tuple, added=added) -> tuple:
                return _with_tree(block[:4], added[block[0]], bins)

        older.append(state)
        state = state.map(grown, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        done += rounds
        if done % CHECKPOINT_EVERY < rounds:
            state.checkpoint()
        if blocks == 1:
            added = dict(state.map(lambda block: (block[0], block[4])).collect())
            for m in trained:
                trees[m] += added[m]
        else:
            for m in trained:
                trees[m].append(added[m])
        if len(older) > 2:
            older.pop(0).unpersist()
    for held in (*older, state):
        held.unpersist()
    return {name: Boosted(list(features), base[m], bins.edges, trees[m]) for m, name in enumerate(names)}
