"""Histogram gradient boosting: second-order trees, grown leaf by leaf.

Features become bins once. A tree takes one aggregation per round of growth: every task adds up gradients and hessians per
(node, feature, bin), the sums are added by node and cell, and the driver, which gets a number of cells that does not depend on the
rows, chooses splits. Only the smaller of two children is summed, its sibling is the difference to the parent. A missing
value has a bin of its own and goes to the side that gains more. Neighbouring features with few bins share one code per row, so that
a row is counted once for all of them; their own sums are added up from the codes' afterwards. The leaf that gains most is split next; a round
sums the children of all leaves that may still be chosen, so a tree takes about as many rounds as it is deep.

Gradients are added as whole numbers, so a fit does not depend on the order of rows or on tasks that run twice.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.distribution import exact_quantiles
from riskspark.session import written

# Tasks carry this module's functions with them, so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Trees after which margins are written anew.
REFRESH = 10
#: Cells that one task adds up, and binned rows that one task reads, about.
CELLS_PER_TASK = 100_000
ROWS_PER_TASK = 100_000
#: Rows that are worked on together, and bins that the features of one code may have between them.
ROWS_AT_ONCE = 1 << 16
CODES = 1 << 12
#: Least sum of hessians on either side of a split.
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class Growth:
    """How trees grow."""

    max_leaf_nodes: int = 31
    max_depth: int | None = None
    min_samples_leaf: int = 20
    l2: float = 0.0
    learning_rate: float = 0.1


@dataclass(frozen=True)
class Layout:
    """Bins of all features side by side: upper edges of each feature's bins, then one bin for missing."""

    edges: tuple[np.ndarray, ...]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(e) + 2 for e in self.edges], np.int64)

    @property
    def offsets(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @cached_property
    def groups(self) -> tuple[range, ...]:
        """Neighbouring features that share a code: the bins of one are its digits, those of the last vary fastest."""
        found, first, codes = [], 0, 1
        for f, size in enumerate(self.sizes.tolist()):
            if f > first and codes * size > CODES:
                found.append(range(first, f))
                first, codes = f, 1
            codes *= size
        return (*found, range(first, len(self.edges)))

    @cached_property
    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Group of each feature, and what one bin of it adds to the code."""
        group = np.repeat(np.arange(len(self.groups)), [len(g) for g in self.groups])
        step = np.concatenate([np.cumprod([1, *self.sizes[g.start + 1 : g.stop][::-1]])[::-1] for g in self.groups])
        return group, step.astype(np.int64)

    @cached_property
    def codes_of(self) -> np.ndarray:
        """Number of codes of each group."""
        return np.array([int(np.prod(self.sizes[g.start : g.stop])) for g in self.groups], np.int64)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Codes of all groups; a value equal to an edge lies below it, NaN in the last bin."""
        group, step = self.places
        out = np.zeros((len(x), len(self.groups)), np.uint16)
        for f, edges in enumerate(self.edges):
            column = x[:, f]
            bins = np.where(np.isnan(column), len(edges) + 1, np.searchsorted(edges, column, "left"))
            out[:, group[f]] += (bins * step[f]).astype(np.uint16)
        return out

    def cells(self, sums: Sequence[np.ndarray]) -> np.ndarray:
        """Sums per feature and bin from sums per node and code of each group."""
        parts = []
        for g, own in zip(self.groups, sums):
            by_bin = own.reshape(-1, *self.sizes[g.start : g.stop])
            axes = range(1, len(g) + 1)
            parts += [by_bin.sum(axis=tuple(a for a in axes if a != k)) for k in axes]
        return np.concatenate(parts, axis=1)


@dataclass(frozen=True)
class Split:
    """The best split of a node: what goes left, and the sums of both sides."""

    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: tuple[int, int, int]
    right: tuple[int, int, int]


@dataclass
class Node:
    """A node while its tree grows; sums are gradients, hessians and rows."""

    depth: int
    sums: tuple[int, int, int]
    cells: np.ndarray | None = None
    split: Split | None = None
    children: tuple[int, int] | None = None
    chosen: bool = False


@dataclass
class Tree:
    """A grown tree as arrays by node; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)


def bin_edges(rows: DataFrame, x: str, width: int, max_bins: int) -> Layout:
    """Edges between all values of a feature with up to ``max_bins`` of them, its distinct quantiles otherwise."""
    long = rows.select(F.posexplode(x).alias("slot", "value")).where(~F.isnan("value") & F.col("value").isNotNull())
    values = written(long.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n")), "boosting-values")
    sizes = values.groupBy("slot").agg(F.count(F.lit(1)).alias("distinct"))
    few = values.join(F.broadcast(sizes.where(F.col("distinct") <= max_bins)), "slot")
    edges: list[np.ndarray] = [np.empty(0)] * width
    # Up to max_bins values per feature, however many rows there are.
    for r in few.groupBy("slot").agg(F.array_sort(F.collect_list("value")).alias("values")).toLocalIterator():
        known = np.array(r["values"])
        edges[r["slot"]] = (known[1:] + known[:-1]) / 2
    many = [r["slot"] for r in sizes.where(F.col("distinct") > max_bins).toLocalIterator()]
    if many:
        steps = [i / max_bins for i in range(1, max_bins)]
        for r in exact_quantiles(long.where(F.col("slot").isin(many)), ["slot"], "value", steps, out="q").toLocalIterator():
            edges[r["slot"]] = np.unique(np.array(r["q"]))
    return Layout(tuple(edges))


def binned_rows(rows: DataFrame, x: str, y: str, n: int, layout: Layout, margin: float) -> DataFrame:
    """The codes of the features, the label and a margin of each of ``n`` rows, written in even parts."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, width = batch.num_rows, len(layout.edges)
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            codes = layout.codes(values.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    batch.column(1).cast(pa.float64()),
                    pa.array(np.full(n, margin)),
                ],
                ["bins", "y", "margin"],
            )

    tasks = 1 + n // ROWS_PER_TASK
    found = rows.select(x, y).mapInArrow(binned, "bins binary, y double, margin double")
    return written(found.repartition(tasks), "boosting-rows")


def _descend(tree: Tree, codes: np.ndarray, layout: Layout) -> np.ndarray:
    """The node each row ends in."""
    feature = np.array(tree.feature)
    at = np.zeros(len(codes), np.int64)
    if feature[0] < 0:
        return at
    group, step = layout.places
    sizes, widest = layout.sizes, int(layout.codes_of.max())
    # The next node for each node and code; a leaf keeps its rows.
    after = np.repeat(np.arange(len(feature))[:, None], widest, axis=1)
    code = np.arange(widest)
    for node in np.flatnonzero(feature >= 0).tolist():
        f = feature[node]
        value = code // step[f] % sizes[f]
        goes = np.where(value == sizes[f] - 1, tree.missing_left[node], value <= tree.bin[node])
        after[node] = np.where(goes, tree.left[node], tree.right[node])
    after, flat = after.ravel(), codes.ravel()
    column = group[np.maximum(feature, 0)]
    rows = np.arange(len(codes)) * codes.shape[1]
    depth = [0] * len(feature)
    # A child has a greater number than its parent.
    for node in np.flatnonzero(feature >= 0).tolist():
        depth[tree.left[node]] = depth[tree.right[node]] = depth[node] + 1
    for _ in range(max(depth)):
        at = after[at * widest + flat[rows + column[at]]]
    return at


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), width)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches brought together, so that small ones cost no more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS_AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _margins(trees: Sequence[Tree], codes: np.ndarray, layout: Layout, margin: np.ndarray) -> np.ndarray:
    for tree in trees:
        margin = margin + np.array(tree.value)[_descend(tree, codes, layout)]
    return margin


def node_cells(
    rows: DataFrame, layout: Layout, trees: Sequence[Tree], growing: Tree, wanted: Sequence[int], scale: int
) -> DataFrame:
    """Sums of ``wanted`` nodes of the growing tree: ``node``, ``cell``, ``g``, ``h`` (whole numbers, times ``scale``) and ``n``.

    ``trees`` are those grown since the margins of ``rows`` were written.
    """
    place = np.full(len(growing.feature), -1)
    place[list(wanted)] = np.arange(len(wanted))
    total, width = int(layout.sizes.sum()), len(layout.groups)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_code = [np.zeros((3, len(wanted) * int(n)), np.int64) for n in layout.codes_of]
        for rows in _gathered(batches):
            codes = _matrix(rows.column(0), width)
            y, margin = (rows.column(i).to_numpy() for i in (1, 2))
            node = place[_descend(growing, codes, layout)]
            own = node >= 0
            codes, y, node = codes[own], y[own], node[own]
            p = 1 / (1 + np.exp(-_margins(trees, codes, layout, margin[own])))
            parts = (np.rint((p - y) * scale), np.rint(p * (1 - p) * scale), None)
            for column, n, sums in zip(codes.T, layout.codes_of.tolist(), by_code):
                place_of = node * n + column
                for k, part in enumerate(parts):
                    # Whole numbers below 2 ** 53 are added exactly as doubles.
                    sums[k] += np.bincount(place_of, part, len(wanted) * n).astype(np.int64)
        sums = np.stack([layout.cells([own[k].reshape(len(wanted), -1) for own in by_code]).ravel() for k in range(3)])
        seen = np.flatnonzero(sums[2])
        arrays = [seen // total, seen % total, *sums[:, seen]]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["node", "cell", "g", "h", "n"])

    # A task hands on each cell once; few cells need few tasks to add them up.
    tasks = 1 + len(wanted) * total // CELLS_PER_TASK
    parts = rows.mapInArrow(summed, "node long, cell long, g long, h long, n long").repartition(tasks, "node", "cell")
    return parts.groupBy("node", "cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])


def best_split(cells: np.ndarray, layout: Layout, scale: int, growth: Growth, features: Sequence[int] | None = None) -> Split | None:
    """The split of a node that gains most; the first feature, bin and then missing to the right of equal ones."""
    best: Split | None = None
    for f in range(len(layout.edges)) if features is None else features:
        own = cells[:, layout.offsets[f] : layout.offsets[f] + layout.sizes[f]]
        absent, running = own[:, -1], np.cumsum(own[:, :-1], axis=1)
        whole = running[:, -1] + absent
        found = []
        if absent[2]:
            found.append((running, False))
            found.append((running[:, :-1] + absent[:, None], True))
        else:
            found.append((running[:, :-1], False))
        g, h = whole[0] / scale, whole[1] / scale
        for left, missing_left in found:
            right = whole[:, None] - left
            lh, rh = left[1] / scale, right[1] / scale
            allowed = (np.minimum(left[2], right[2]) >= growth.min_samples_leaf) & (np.minimum(lh, rh) >= LEAST_HESSIAN)
            if not allowed.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (left[0] / scale) ** 2 / (lh + growth.l2) + (right[0] / scale) ** 2 / (rh + growth.l2) - g * g / (h + growth.l2)
            gain = np.where(allowed, gain, -np.inf)
            b = int(gain.argmax())
            if gain[b] > 1e-12 and (best is None or gain[b] > best.gain):
                # Without missing values seen, they go with most rows.
                toward = missing_left if absent[2] else bool(left[2, b] >= right[2, b])
                sides = [tuple(int(v) for v in side[:, b]) for side in (left, right)]
                best = Split(float(gain[b]), f, b, toward, *sides)
    return best


def _as_tree(nodes: list[Node], layout: Layout, scale: int, growth: Growth, chosen_only: bool) -> Tree:
    tree = Tree()
    for node in nodes:
        inner = node.children is not None and (node.chosen or not chosen_only)
        split = node.split if inner else None
        tree.feature.append(split.feature if split else -1)
        tree.bin.append(split.bin if split else 0)
        edges = layout.edges[split.feature] if split else ()
        # Beyond the last edge everything that is not missing goes left.
        tree.threshold.append(float(edges[split.bin]) if split and split.bin < len(edges) else float("inf"))
        tree.missing_left.append(bool(split and split.missing_left))
        left, right = node.children if inner else (-1, -1)
        tree.left.append(left)
        tree.right.append(right)
        g, h, n = node.sums
        weight = h / scale + growth.l2
        tree.value.append(0.0 if split or not weight else -growth.learning_rate * (g / scale) / weight)
        tree.gain.append(split.gain if split else 0.0)
        tree.rows.append(n)
    return tree


def _reachable(tree: Tree) -> Tree:
    """The tree without nodes that were summed and not chosen."""
    order, at = [0], 0
    while at < len(order):
        node = order[at]
        if tree.feature[node] >= 0:
            order += [tree.left[node], tree.right[node]]
        at += 1
    number = {node: i for i, node in enumerate(order)}
    kept = Tree(**{name: [values[i] for i in order] for name, values in vars(tree).items()})
    kept.left = [number.get(i, -1) for i in kept.left]
    kept.right = [number.get(i, -1) for i in kept.right]
    return kept


def grow_tree(rows: DataFrame, layout: Layout, trees: Sequence[Tree], scale: int, growth: Growth) -> Tree:
    """One tree on the gradients of ``rows`` after ``trees``, the most gaining leaf first."""
    total = int(layout.sizes.sum())
    nodes = [Node(0, (0, 0, 0))]

    def sums_of(wanted: list[int]) -> dict[int, np.ndarray]:
        growing = _as_tree(nodes, layout, scale, growth, False)
        # As many rows as the wanted nodes have cells.
        found = node_cells(rows, layout, trees, growing, wanted, scale).toArrow()
        columns = [found.column(c).to_numpy() for c in ("node", "cell", "g", "h", "n")]
        out = np.zeros((len(wanted), 3, total), np.int64)
        for k in range(3):
            out[columns[0], k, columns[1]] = columns[2 + k]
        return {node: out[i] for i, node in enumerate(wanted)}

    def splittable(node: Node) -> bool:
        return node.sums[2] >= 2 * growth.min_samples_leaf and (growth.max_depth is None or node.depth < growth.max_depth)

    def summed(node: Node, cells: np.ndarray) -> None:
        node.cells = cells
        node.split = best_split(cells, layout, scale, growth) if splittable(node) else None

    root = sums_of([0])[0]
    first = slice(0, int(layout.sizes[0]))
    nodes[0].sums = tuple(int(v) for v in root[:, first].sum(axis=1))
    summed(nodes[0], root)
    queue = [(-nodes[0].split.gain, 0)] if nodes[0].split else []
    leaves = 1
    while queue and leaves < growth.max_leaf_nodes:
        if nodes[queue[0][1]].children is None:
            # Only the best of these can still be chosen.
            open_nodes = [i for _, i in heapq.nsmallest(growth.max_leaf_nodes - leaves, queue) if nodes[i].children is None]
            smaller = []
            for i in open_nodes:
                split, depth = nodes[i].split, nodes[i].depth + 1
                nodes[i].children = (len(nodes), len(nodes) + 1)
                nodes += [Node(depth, split.left), Node(depth, split.right)]
                pair = nodes[i].children
                if leaves + 1 < growth.max_leaf_nodes and any(splittable(nodes[c]) for c in pair):
                    smaller.append(min(pair, key=lambda c: nodes[c].sums[2]))
            found = sums_of(smaller) if smaller else {}
            for i in open_nodes:
                a, b = nodes[i].children
                for own, other in ((a, b), (b, a)):
                    if own in found:
                        summed(nodes[own], found[own])
                        summed(nodes[other], nodes[i].cells - found[own])
                nodes[i].cells = None
        _, i = heapq.heappop(queue)
        nodes[i].chosen = True
        leaves += 1
        for c in nodes[i].children:
            if nodes[c].split:
                heapq.heappush(queue, (-nodes[c].split.gain, c))
    return _reachable(_as_tree(nodes, layout, scale, growth, True))


def boost(rows: DataFrame, layout: Layout, rounds: int, scale: int, growth: Growth) -> list[Tree]:
    """Trees one after the other; margins are written anew after some of them, so a round looks at few trees."""
    trees: list[Tree] = []
    since: list[Tree] = []
    width = len(layout.groups)
    for _ in range(rounds):
        if len(since) == REFRESH:
            grown = list(since)

            def moved(batches: Iterator[pa.RecordBatch], grown=grown) -> Iterator[pa.RecordBatch]:
                for own in _gathered(batches):
                    now = _margins(grown, _matrix(own.column(0), width), layout, own.column(2).to_numpy())
                    yield from own.set_column(2, "margin", pa.array(now)).to_batches()

            rows = written(rows.mapInArrow(moved, rows.schema), "boosting-rows")
            since = []
        tree = grow_tree(rows, layout, since, scale, growth)
        trees.append(tree)
        since.append(tree)
        if len(tree.feature) == 1 and abs(tree.value[0]) < 1e-12:
            break
    return trees


def gradient_scale(rows: int) -> int:
    """Parts of one that gradients are counted in, so that sums over all rows fit 64 bits."""
    return 1 << min(30, 62 - max(rows, 1).bit_length())


def prepared(df: DataFrame, x: str, y: str, max_bins: int) -> tuple[DataFrame, Layout, float, int]:
    """Binned rows with a label, their bins, the margin all rows start from, and the scale of gradients."""
    usable = written(df.select(F.col(x).alias("x"), F.col(y).cast("double").alias("y")).where("y IS NOT NULL"), "boosting-input")
    n, mean, width = usable.agg(F.count(F.lit(1)), F.avg("y"), F.max(F.size("x"))).first()
    if not n:
        raise ValueError("no labelled rows to fit")
    share = min(max(mean, 1e-9), 1 - 1e-9)
    layout = bin_edges(usable, "x", width, max_bins)
    margin = float(np.log(share / (1 - share)))
    return binned_rows(usable, "x", "y", n, layout, margin), layout, margin, gradient_scale(n)


def first_splits(df: DataFrame, features: Sequence[str], label: str, max_bins: int = 255, growth: Growth = Growth()) -> DataFrame:
    """The best first split on each feature alone: ``feature``, ``threshold``, ``missing_left``, ``gain``, ``left_rows``, ``right_rows``.

    What a first tree would choose from; null features are missing. Features without a split are left out.
    """
    rows = df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), label)
    nan = F.transform("x", lambda v: F.coalesce(v, F.lit(float("nan"))))
    binned, layout, _, scale = prepared(rows.withColumn("x", nan), "x", label, max_bins)
    root = Tree([-1], [0], [0.0], [False], [-1], [-1], [0.0], [0.0], [0])
    found = node_cells(binned, layout, [], root, [0], scale).toArrow()
    cells = np.zeros((3, int(layout.sizes.sum())), np.int64)
    for k, name in enumerate(("g", "h", "n")):
        cells[k, found.column("cell").to_numpy()] = found.column(name).to_numpy()
    out = []
    for f, name in enumerate(features):
        split = best_split(cells, layout, scale, growth, [f])
        if split:
            edges = layout.edges[f]
            threshold = float(edges[split.bin]) if split.bin < len(edges) else None
            out.append((name, threshold, split.missing_left, split.gain, split.left[2], split.right[2]))
    return df.sparkSession.createDataFrame(
        out, "feature string, threshold double, missing_left boolean, gain double, left_rows long, right_rows long"
    )


class _BoostingParams(HasFeaturesCol, HasLabelCol):
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "share of each leaf's value taken", TypeConverters.toFloat)
    maxLeafNodes = Param(Params._dummy(), "maxLeafNodes", "leaves of a tree at most", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree at most, 0 for any", TypeConverters.toInt)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "rows of a leaf at least", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty on leaf values", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature at most, 255 or fewer", TypeConverters.toInt)


class HistogramBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier over a vector column; NaN is missing. Rows without a label are not fitted on."""

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol="features",
        labelCol="label",
        maxIter=100,
        learningRate=0.1,
        maxLeafNodes=31,
        maxDepth=0,
        minSamplesLeaf=20,
        l2=0.0,
        maxBins=255,
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(
            maxIter=100, learningRate=0.1, maxLeafNodes=31, maxDepth=0, minSamplesLeaf=20, l2=0.0, maxBins=255
        )

    def _fit(self, dataset: DataFrame) -> HistogramBoostingModel:
        of = self.getOrDefault
        if not 2 <= of("maxBins") <= 255:
            raise ValueError("maxBins must be between 2 and 255")
        growth = Growth(of("maxLeafNodes"), of("maxDepth") or None, of("minSamplesLeaf"), of("l2"), of("learningRate"))
        rows = dataset.select(vector_to_array(of("featuresCol")).alias("x"), F.col(of("labelCol")).alias("y"))
        binned, layout, margin, scale = prepared(rows, "x", "y", of("maxBins"))
        trees = boost(binned, layout, of("maxIter"), scale, growth)
        return HistogramBoostingModel(featuresCol=of("featuresCol"), labelCol=of("labelCol")).of(margin, trees, len(layout.edges))


class HistogramBoostingModel(Model, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; they are one parameter, so the model is stored and loaded like any stage."""

    forest = Param(Params._dummy(), "forest", "base margin, number of features and trees, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label"):
        super().__init__()
        self._set(**self._input_kwargs)

    def of(self, margin: float, trees: Sequence[Tree], width: int) -> HistogramBoostingModel:
        text = json.dumps({"margin": margin, "width": width, "trees": [vars(t) for t in trees]})
        return self._set(forest=text)

    @property
    def margin(self) -> float:
        return json.loads(self.getOrDefault("forest"))["margin"]

    @property
    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault("forest"))["trees"]]

    @property
    def featureImportances(self):
        """Share of each feature in the gain of all splits."""
        total = np.zeros(json.loads(self.getOrDefault("forest"))["width"])
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    total[f] += gain
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def node_table(self, spark) -> DataFrame:
        """All nodes of all trees as rows, for replay and inspection."""
        rows = [
            (t, i, *(getattr(tree, c)[i] for c in ("feature", "threshold", "missing_left", "left", "right", "value", "gain", "rows")))
            for t, tree in enumerate(self.trees)
            for i in range(len(tree.feature))
        ]
        return spark.createDataFrame(
            rows,
            "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double, rows long",
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, trees = self.margin, self.trees

        @F.pandas_udf("double")
        def margins(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            arrays = [{name: np.array(values) for name, values in vars(t).items()} for t in trees]
            for batch in batches:
                x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, 1))
                out = np.full(len(x), base)
                for t in arrays:
                    at = np.zeros(len(x), np.int64)
                    moving = np.arange(len(x)) if t["feature"][0] >= 0 else np.empty(0, np.int64)
                    while len(moving):
                        node = at[moving]
                        value = x[moving, t["feature"][node]]
                        goes = np.where(np.isnan(value), t["missing_left"][node], value <= t["threshold"][node])
                        at[moving] = np.where(goes, t["left"][node], t["right"][node])
                        moving = moving[t["feature"][at[moving]] >= 0]
                    out += t["value"][at]
                yield pd.Series(out)

        margin = margins(vector_to_array(self.getOrDefault("featuresCol")))
        scored = dataset.withColumn("_margin", margin)
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                "probability": array_to_vector(F.array(1 - p, p)),
                "prediction": (p >= 0.5).cast("double"),
            }
        ).drop("_margin")
