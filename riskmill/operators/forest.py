"""Forests on many rows: the same trees as Spark's forest grows, dealt to tasks instead of level by level.

Rows are written once as binned blocks (32 bins a feature from a sample of rows, as in Spark's trees). Every tree draws its
own rows (a Poisson(1) count per row, from a hash of row and tree) and every node its own features. Nodes of many rows are
split with histograms that all tasks add up; the rows of a node that fits a task are dealt to one, which grows what is
below it. So neither the driver nor a task holds a forest, or all rows: the trees are a table, and scoring walks them one by one.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext, cloudpickle, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, functions as F

from riskmill.functions.durable import checkpoint_dir, discard, take_bounded

# Fixed values, as in Spark's forests: bins of a feature, and rows of the sample that gives their bounds, about.
BINS, SAMPLE_ROWS = 32, 10_000
#: Bytes of binned rows, at most, below which a node is grown by one task.
NODE_BYTES = 64 << 20
#: Rows that are dealt, or scored, at a time.
BLOCK_ROWS = 65_536
#: A gain below this share of a node's weight is rounding.
LEAST_GAIN = 1e-14
TREES_FOLDER = "trees"
_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BLOCK_SCHEMA = "first bigint, rows int, bins binary, labels binary"
_DEALT_SCHEMA = "tree int, root int, first bigint, rows int, bins binary, labels binary, copies binary"
_TREE_SCHEMA = "tree int, root int, feature binary, cut binary, left binary, share binary"
_SUM_SCHEMA = "tree int, root int, features binary, sums binary"
_SPLIT_SCHEMA = "tree int, root int, feature int, cut int, zeros bigint, ones bigint, left_zeros bigint, left_ones bigint"


# --- bins --------------------------------------------------------------------


def bounds_of(values: np.ndarray, bins: int = BINS) -> list[float]:
    """Upper bounds of all bins of a feature but the last: between all values if they are few, else after equal shares."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        return middles.tolist()
    bounds, stride = [], len(values) / bins
    target, before = stride, np.cumsum(counts)
    for i in range(1, len(found)):
        if abs(before[i - 1] - target) < abs(before[i] - target):
            bounds.append(float(middles[i - 1]))
            target += stride
    return bounds


def _bounds(rows: DataFrame, count: int, seed: int) -> list[list[float]]:
    sample = rows.sample(min(1.0, SAMPLE_ROWS / count), seed) if count > SAMPLE_ROWS else rows
    values = np.array([r[0] for r in take_bounded(sample.select("values"), 2 * SAMPLE_ROWS, "rows of the sample for bins")])
    return [bounds_of(values[:, i]) for i in range(values.shape[1])]


def _binned(values: np.ndarray, bounds: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins, one row per feature."""
    return np.stack([np.searchsorted(b, values[:, i]).astype(np.uint8) for i, b in enumerate(bounds)])


def _matrix(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _block_writer(bounds):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            if batch.num_rows:
                bins = _binned(_matrix(batch.column("values")), bounds)
                labels = batch.column("label").to_numpy().astype(np.uint8)
                yield _batch(_BLOCK_SCHEMA, (first, batch.num_rows, bins.tobytes(), labels.tobytes()))
                first += batch.num_rows

    return blocks


_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(schema: str, *rows) -> pa.RecordBatch:
    fields = [(f.split()[0], _TYPES[f.split()[1]]) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], [n for n, _ in fields])


def _blocks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple]:
    """(row numbers, bins, labels) of written blocks, several put together."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            size += row["rows"]
            if size >= BLOCK_ROWS:
                yield _joined(held, features)
                held, size = [], 0
    if held:
        yield _joined(held, features)


def _joined(held: Sequence[Mapping], features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers = np.concatenate([np.arange(h["first"], h["first"] + h["rows"], dtype=np.uint64) for h in held])
    bins = np.concatenate([np.frombuffer(h["bins"], np.uint8).reshape(features, -1) for h in held], axis=1)
    return numbers, bins, np.concatenate([np.frombuffer(h["labels"], np.uint8) for h in held])


def _poisson_table() -> np.ndarray:
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
    return np.searchsorted(shares, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def copies_of(numbers: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row, the same in every run."""
    z = numbers * _GOLDEN + np.uint64((seed * 1_000_003 + tree + 1) * 0xD1342543DE82EF95 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * _MIX1
    z = (z ^ (z >> np.uint64(27))) * _MIX2
    return _POISSON[(z >> np.uint64(48)).astype(np.intp)]


_POISSON = _poisson_table()
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of the library


# --- splits ------------------------------------------------------------------


def _purity(zeros, ones, weights):
    """Weighted rows less their weighted Gini impurity: the larger over both sides, the better the split."""
    a, b = zeros * weights[0], ones * weights[1]
    total = a + b
    return np.divide(a * a + b * b, total, out=np.zeros_like(total), where=total > 0)


def _best_of_sums(sums: np.ndarray, least: int, weights) -> tuple:
    """Best cut per node of one feature each, from sums (node, bin, class): gain, cut, zeros and ones to its left."""
    left = sums.cumsum(axis=1)
    totals = left[:, -1]
    left = left[:, :-1]
    right = totals[:, None] - left
    worth = _purity(left[..., 0], left[..., 1], weights) + _purity(right[..., 0], right[..., 1], weights)
    worth[(left.sum(axis=2) < least) | (right.sum(axis=2) < least)] = -1.0
    cut = worth.argmax(axis=1)
    nodes = np.arange(len(cut))
    return worth[nodes, cut], cut, left[nodes, cut, 0], left[nodes, cut, 1]


def _best_of_rows(key: np.ndarray, before, totals, least: int, weights, nodes: int) -> tuple:
    """The same from rows, as numbers of node, bin (5 bits), label (1) and copies (8), for nodes of few rows each.

    ``before`` counts the copies of the nodes before each node, by class.
    """
    key = np.sort(key)
    many = (key & 255).astype(np.float64)
    place = key >> 9
    last = np.flatnonzero(place[1:] != place[:-1])  # the last row of a bin, with more bins after it
    of = place >> 5
    last = last[of[last] == of[last + 1]]
    own = of[last]
    ones = np.cumsum(many * ((key >> 8) & 1))[last] - before[1][own]
    zeros = np.cumsum(many)[last] - before[0][own] - before[1][own] - ones
    right0, right1 = totals[0][own] - zeros, totals[1][own] - ones
    worth = _purity(zeros, ones, weights) + _purity(right0, right1, weights)
    worth[(zeros + ones < least) | (right0 + right1 < least)] = -1.0
    best, cut, left0, left1 = np.full(nodes, -1.0), np.zeros(nodes, np.int64), np.zeros(nodes), np.zeros(nodes)
    if len(own):
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        top = np.maximum.reduceat(worth, starts)
        best[own[starts]] = top
        where = np.flatnonzero(worth == best[own])[::-1]  # the first of equals is written last
        at = own[where]
        cut[at], left0[at], left1[at] = place[last[where]] & 31, zeros[where], ones[where]
    return best, cut, left0, left1


def _drawn(rng: np.random.Generator, nodes: int, features: int, many: int) -> np.ndarray:
    """``many`` different features for every node."""
    if many >= features:
        return np.broadcast_to(np.arange(features), (nodes, features))
    parts = [rng.random((min(20_000, nodes - at), features), np.float32) for at in range(0, nodes, 20_000)]
    return np.concatenate([np.argpartition(p, many, axis=1)[:, :many] for p in parts])


def grow(bins: np.ndarray, labels: np.ndarray, copies: np.ndarray, many: int, depth: int, least: int, weights, rng) -> dict[str, np.ndarray]:
    """A tree over binned rows (feature by row), as arrays of its nodes: a leaf has ``left`` below zero.

    ``left`` of an inner node is its left child, the right one follows it; of a leaf, minus one minus its place in
    ``share``, the weighted share of label 1. Sibling leaves of one class are one leaf, as in Spark's trees.
    """
    features, count = bins.shape
    flat = np.ascontiguousarray(bins).reshape(-1)
    rows = np.arange(count)
    node = np.zeros(count, np.int64)
    copies = copies.astype(np.float64)
    ones = np.array([(copies * labels).sum()])
    zeros = np.array([float(copies.sum()) - ones[0]])
    levels = []
    for level in range(depth + 1):
        nodes = len(zeros)
        splits = np.zeros(nodes, bool)
        feature, cut = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        left0, left1 = np.zeros(nodes), np.zeros(nodes)
        if level < depth and len(rows):
            # Rows are only left in nodes that may be split, so those are the ones looked at.
            asked = np.flatnonzero((zeros > 0) & (ones > 0) & (zeros + ones >= 2 * least))
            number = np.zeros(nodes, np.int64)
            number[asked] = np.arange(len(asked))
            local = number[node]
            totals = zeros[asked], ones[asked]
            before = tuple(np.cumsum(t) - t for t in totals)
            drawn = _drawn(rng, len(asked), features, many)
            worth = _purity(*totals, weights)
            weight = totals[0] * weights[0] + totals[1] * weights[1]
            best = worth + LEAST_GAIN * weight
            few = len(rows) < 2 * BINS * len(asked)
            w = copies[rows]
            base = (local << 14) + (labels[rows].astype(np.int64) << 8) + w.astype(np.int64) if few else local * (BINS * 2) + labels[rows]
            found = [np.zeros(len(asked), kind) for kind in (bool, np.int64, np.int64, float, float)]
            for slot in range(drawn.shape[1]):
                own = drawn[:, slot]
                place = (own * count).take(local)
                place += rows
                b = flat.take(place).astype(np.int64)
                if few:
                    offered = _best_of_rows(base + (b << 9), before, totals, least, weights, len(asked))
                else:
                    sums = np.bincount(base + 2 * b, weights=w, minlength=len(asked) * BINS * 2)
                    offered = _best_of_sums(sums.reshape(-1, BINS, 2), least, weights)
                better = offered[0] > best
                best = np.where(better, offered[0], best)
                for kept, new in zip(found, (better, own, *offered[1:])):
                    kept[better] = new[better]
            splits[asked], feature[asked], cut[asked], left0[asked], left1[asked] = found
        levels.append((splits, feature, cut, zeros, ones))
        if not splits.any():
            break
        child = np.cumsum(splits) - 1  # of a split node: the place of its children's pair
        of = feature[node]
        inside = splits[node]
        rows, node, of = rows[inside], node[inside], of[inside]
        node = child[node] * 2 + (flat[of * count + rows] > cut[node])
        pair0 = np.stack([left0[splits], zeros[splits] - left0[splits]], axis=1).reshape(-1)
        pair1 = np.stack([left1[splits], ones[splits] - left1[splits]], axis=1).reshape(-1)
        zeros, ones = pair0, pair1
        open_ = (zeros > 0) & (ones > 0) & (zeros + ones >= 2 * least)
        rows, node = rows[open_[node]], node[open_[node]]
    return _arrays(levels, weights)


def _arrays(levels: Sequence[tuple], weights) -> dict[str, np.ndarray]:
    """Nodes of all levels one after another, siblings of one class merged from below."""
    kept = [splits.copy() for splits, *_ in levels]
    for level in range(len(levels) - 2, -1, -1):
        splits, below = levels[level][0], kept[level + 1]
        says = levels[level + 1][4] * weights[1] > levels[level + 1][3] * weights[0]
        merge = ~below[0::2] & ~below[1::2] & (says[0::2] == says[1::2])
        kept[level][np.flatnonzero(splits)[merge]] = False
    reached, feature, cut, left, share = np.ones(1, bool), [], [], [], []
    start = leaves = 0
    for level, (splits, own, at, zeros, ones) in enumerate(levels):
        inner = kept[level] & reached
        many, leaf = int(reached.sum()), reached & ~inner
        links = np.zeros(len(splits), np.int64)
        links[inner] = start + many + 2 * np.arange(int(inner.sum()))
        links[leaf] = -1 - leaves - np.arange(int(leaf.sum()))
        a, b = zeros[leaf] * weights[0], ones[leaf] * weights[1]
        share.append(_rounded(b / (a + b)) if leaf.any() else b)
        for out, values in ((feature, own), (cut, at), (left, links)):
            out.append(values[reached])
        start, leaves = start + many, leaves + int(leaf.sum())
        if not inner.any():
            break
        reached = np.repeat(inner[splits], 2)
    return {
        "feature": np.concatenate(feature).astype(np.int32), "cut": np.concatenate(cut).astype(np.uint8),
        "left": np.concatenate(left).astype(np.int32), "share": np.concatenate(share),
    }


def _rounded(share):
    """Shares as multiples of 2^-40, so that their sum over up to 8,192 trees is the same in any order."""
    return np.round(share * 2.0**40) / 2.0**40


def walk(tree: Mapping[str, np.ndarray], bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The leaf (place in ``share``) of each of ``rows`` of binned rows."""
    count = bins.shape[1]
    flat = bins.reshape(-1)
    at, live = np.zeros(len(rows), np.int32), np.arange(len(rows))
    while len(live):
        node = at[live]
        left = tree["left"][node]
        inner = left >= 0
        live, node, left = live[inner], node[inner], left[inner]
        at[live] = left + (flat[tree["feature"][node].astype(np.int64) * count + rows[live]] > tree["cut"][node])
    return -1 - tree["left"][at]


# --- nodes of many rows ------------------------------------------------------


class _Top:
    """The upper part of a tree; its leaves are numbered by ``root``, in the order in which they came.

    A leaf is closed with its share of label 1, or open: grown on by a task.
    """

    def __init__(self, rows: int):
        self.feature, self.cut, self.left = [0], [0], [-1]
        self.counts, self.closed, self.depth = [(rows, 0)], [None], [0]

    def _share(self, counts, weights) -> float:
        zeros, ones = counts[0] * weights[0], counts[1] * weights[1]
        return float(_rounded(ones / (zeros + ones)))

    def split(self, root: int, feature: int, cut: int, sides: Sequence[tuple[int, int]], weights) -> None:
        node = self.left.index(-1 - root)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.left)
        self.closed[root] = 0.0  # no leaf any more
        for counts in sides:
            self._leaf(counts, None if all(counts) else self._share(counts, weights), self.depth[root] + 1)

    def _leaf(self, counts, closed, depth, node: int | None = None) -> None:
        if node is None:
            node = len(self.left)
            for column in (self.feature, self.cut, self.left):
                column.append(0)
        self.left[node] = -1 - len(self.counts)
        self.counts.append(counts)
        self.closed.append(closed)
        self.depth.append(depth)

    def close(self, root: int, counts, weights) -> None:
        self.counts[root], self.closed[root] = counts, self._share(counts, weights)

    def merge(self, ends: set[int], weights) -> None:
        """Sibling leaves of one class are one leaf; ``ends`` are the open leaves of which a task made no more."""
        says = lambda counts: counts[1] * weights[1] > counts[0] * weights[0]
        for node in range(len(self.left) - 1, -1, -1):
            if self.left[node] >= 0:
                roots = [-1 - self.left[self.left[node] + i] for i in (0, 1)]
                if all(r >= 0 and (self.closed[r] is not None or r in ends) for r in roots):
                    one, two = (self.counts[r] for r in roots)
                    if says(one) == says(two):
                        counts = (one[0] + two[0], one[1] + two[1])
                        self._leaf(counts, self._share(counts, weights), self.depth[roots[0]] - 1, node)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"feature": np.array(self.feature, np.int32), "cut": np.array(self.cut, np.uint8), "left": np.array(self.left, np.int32)}


def _grow_tops(written: DataFrame, features: int, total: int, trees: int, many: int, depth: int, least: int, weights, seed: int) -> dict[int, _Top]:
    """Every tree down to nodes whose rows fit a task, all trees level by level."""
    limit = max(1, NODE_BYTES // (features + 2))
    tops = {tree: _Top(total) for tree in range(trees)}
    while True:
        asked = {
            tree: roots for tree, top in tops.items()
            if (roots := [r for r, n in enumerate(top.counts) if sum(n) > limit and top.closed[r] is None and top.depth[r] < depth])
        }
        if not asked:
            return tops
        arrays = {tree: tops[tree].arrays() for tree in asked}

        drawn = {
            (tree, root): _drawn(np.random.default_rng([seed, tree, root]), 1, features, many)[0].astype(np.int32)
            for tree, roots in asked.items() for root in roots
        }

        def sums(batches, asked=asked, arrays=arrays, drawn=drawn):
            added = {node: np.zeros((len(own), BINS * 2)) for node, own in drawn.items()}
            for numbers, bins, labels in _blocks(batches, features):
                for tree, roots in asked.items():
                    copies = copies_of(numbers, tree, seed)
                    rows = np.flatnonzero(copies)
                    leaf = walk(arrays[tree], bins, rows)
                    for root in roots:
                        inside = rows[leaf == root]
                        for i, f in enumerate(drawn[tree, root]):
                            key = bins[f, inside].astype(np.int64) * 2 + labels[inside]
                            added[tree, root][i] += np.bincount(key, weights=copies[inside], minlength=BINS * 2)
            for node, values in added.items():
                yield _batch(_SUM_SCHEMA, (*node, drawn[node].tobytes(), values.tobytes()))

        def choose(table: pa.Table) -> pa.Table:
            listed = table.to_pylist()
            own = np.frombuffer(listed[0]["features"], np.int32)
            values = sum(np.frombuffer(r["sums"], np.float64) for r in listed).reshape(-1, BINS, 2)
            gain, cut, left0, left1 = _best_of_sums(values, least, weights)
            best = int(gain.argmax())
            zeros, ones = values[best].sum(axis=0)
            total_weight = zeros * weights[0] + ones * weights[1]
            better = gain[best] > float(_purity(np.array([zeros]), np.array([ones]), weights)[0]) + LEAST_GAIN * total_weight
            row = (listed[0]["tree"], listed[0]["root"], int(own[best]) if better else -1, int(cut[best]), zeros, ones, left0[best], left1[best])
            return pa.Table.from_batches([_batch(_SPLIT_SCHEMA, tuple(int(x) for x in row))])

        found = written.mapInArrow(sums, _SUM_SCHEMA).groupBy("tree", "root").applyInArrow(choose, _SPLIT_SCHEMA)
        for r in take_bounded(found, sum(map(len, asked.values())), "nodes of many rows"):
            top, root = tops[r["tree"]], r["root"]
            if r["feature"] < 0:
                top.close(root, (r["zeros"], r["ones"]), weights)
            else:
                sides = (r["left_zeros"], r["left_ones"]), (r["zeros"] - r["left_zeros"], r["ones"] - r["left_ones"])
                top.split(root, r["feature"], r["cut"], sides, weights)


# --- the forest --------------------------------------------------------------


def grow_forest(
    rows: DataFrame, features_col: str, label_col: str, total: int, *, trees: int, depth: int, least: int,
    weights: tuple[float, float], seed: int,
) -> "GrownForestModel":
    """A forest of ``trees`` trees on ``total`` rows of a 0/1 label; ``weights`` are those of both classes."""
    source = rows.where(F.col(label_col).isNotNull()).select(vector_to_array(features_col).alias("values"), F.col(label_col).cast("double").alias("label"))
    bounds = _bounds(source, total, seed)
    features, many = len(bounds), math.ceil(math.sqrt(len(bounds)))
    spark, name = rows.sparkSession, uuid.uuid4().hex
    kept = f"{checkpoint_dir(spark)}/forest-rows-{name}"
    source.mapInArrow(_block_writer(bounds), _BLOCK_SCHEMA).write.parquet(kept)
    written = spark.read.schema(_BLOCK_SCHEMA).parquet(kept)
    tops = _grow_tops(written, features, total, trees, many, depth, least, weights, seed)
    # The leaves that are closed by now need no task; merging may close more of them.
    arrays = {tree: top.arrays() for tree, top in tops.items()}
    wanted = {tree: [r for r, closed in enumerate(top.closed) if closed is None] for tree, top in tops.items()}
    levels = {tree: list(top.depth) for tree, top in tops.items()}

    def deal(batches):
        for numbers, bins, labels in _blocks(batches, features):
            for tree, roots in wanted.items():
                copies = copies_of(numbers, tree, seed)
                drawn = np.flatnonzero(copies)
                leaf = walk(arrays[tree], bins, drawn) if len(arrays[tree]["left"]) > 1 else np.zeros(len(drawn), np.int32)
                for root in roots:
                    own = drawn[leaf == root]
                    if len(own):
                        packed = (bins[:, own].tobytes(), labels[own].tobytes(), copies[own].tobytes())
                        yield _batch(_DEALT_SCHEMA, (tree, root, int(numbers[0]), len(own), *packed))

    def grow_one(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r["first"])
        tree, root = parts[0]["tree"], parts[0]["root"]
        bins = np.concatenate([np.frombuffer(p["bins"], np.uint8).reshape(features, -1) for p in parts], axis=1)
        labels, copies = (np.concatenate([np.frombuffer(p[c], np.uint8) for p in parts]) for c in ("labels", "copies"))
        rng = np.random.default_rng([seed, tree, root, 1])
        grown = grow(bins, labels, copies, many, depth - levels[tree][root], least, weights, rng)
        return pa.Table.from_batches([_batch(_TREE_SCHEMA, (tree, root, *(grown[c].tobytes() for c in ("feature", "cut", "left", "share"))))])

    groups = sum(map(len, wanted.values()))
    dealt = written.mapInArrow(deal, _DEALT_SCHEMA).repartition(max(1, groups), "tree", "root")
    path = f"{checkpoint_dir(spark)}/{TREES_FOLDER}-{name}"
    dealt.groupBy("tree", "root").applyInArrow(grow_one, _TREE_SCHEMA).write.parquet(path)
    discard(spark, kept)
    split = {tree: top for tree, top in tops.items() if len(top.left) > 1}
    if split:
        ends = spark.read.schema(_TREE_SCHEMA).parquet(path).where(F.octet_length("left") == 4).select("tree", "root")
        single = {tuple(r) for r in take_bounded(ends, groups, "leaves")}
        for tree, top in split.items():
            top.merge({root for t, root in single if t == tree}, weights)
    # Trees without an upper part are not listed.
    listed = {t: {**{k: v.tolist() for k, v in top.arrays().items()}, "closed": top.closed} for t, top in split.items()}
    state = {"bounds": bounds, "trees": trees, "tops": listed}
    return GrownForestModel(state=json.dumps(state), path=path)._set(featuresCol=features_col)


class _TreesWriter(DefaultParamsWriter):
    """Saves the table of trees inside the model's own folder."""

    def saveImpl(self, path: str) -> None:  # noqa: N802 (name of the base class)
        super().saveImpl(path)
        self.sparkSession.read.parquet(self.instance.getOrDefault("path")).write.mode("overwrite").parquet(f"{path}/{TREES_FOLDER}")


class _TreesReader(DefaultParamsReader):
    """Points a loaded model at the table beside its parameters."""

    def load(self, path: str) -> "GrownForestModel":
        return super().load(path)._set(path=f"{path.rstrip('/')}/{TREES_FOLDER}")


class GrownForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Mean share of label 1 over the trees of a table. Scoring is a projection: each task walks the trees one by one."""

    state = Param(Params._dummy(), "state", "bounds of bins, number and upper parts of trees", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "folder of the trees", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None, path=None):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> DefaultParamsWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _TreesReader(cls)

    @property
    def getNumTrees(self) -> int:
        return json.loads(self.getOrDefault(self.state))["trees"]

    def release(self, spark) -> None:
        """Delete the trees of a model that is not used again."""
        discard(spark, self.getOrDefault(self.path))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = json.loads(self.getOrDefault(self.state))
        files = _reachable(dataset.sparkSession, self.getOrDefault(self.path))
        share = F.arrow_udf(_scorer(state, files), "double")(vector_to_array(self.getOrDefault(self.featuresCol)))
        scored = dataset.withColumn("_share", share)
        two = lambda one: array_to_vector(F.array(one - F.col("_share") * one, F.col("_share") * one))
        return scored.withColumns({
            "rawPrediction": two(F.lit(float(state["trees"]))),
            "probability": two(F.lit(1.0)),
            "prediction": F.when(F.col("_share") > 0.5, 1.0).otherwise(0.0),
        }).drop("_share")


def _reachable(spark, path: str) -> list[str]:
    """Files of a table as tasks open them: by path in a shared folder, else fetched by Spark."""
    files = spark.read.schema(_TREE_SCHEMA).parquet(path).inputFiles()
    if all(f.startswith("file:") for f in files):
        return [f.removeprefix("file:").replace("//", "/", 1) if f.startswith("file:///") else f.removeprefix("file:") for f in files]
    for f in files:
        spark.sparkContext.addFile(f)
    return [f"fetched:{f.rsplit('/', 1)[1]}" for f in files]


def _trees(files: Sequence[str]) -> Iterator[dict]:
    import pyarrow.parquet as pq

    kinds = {"feature": np.int32, "cut": np.uint8, "left": np.int32, "share": np.float64}
    for f in files:
        with pq.ParquetFile(SparkFiles.get(f.removeprefix("fetched:")) if f.startswith("fetched:") else f) as file:
            for batch in file.iter_batches(1):
                for row in batch.to_pylist():
                    yield {"tree": row["tree"], "root": row["root"], **{c: np.frombuffer(row[c], kind) for c, kind in kinds.items()}}


def _scorer(state: Mapping, files: Sequence[str]):
    bounds, count = state["bounds"], state["trees"]
    tops = {
        int(t): {"feature": np.array(v["feature"], np.int32), "cut": np.array(v["cut"], np.uint8), "left": np.array(v["left"], np.int32), "closed": v["closed"]}
        for t, v in state["tops"].items()
    }

    def votes(bins: np.ndarray) -> np.ndarray:
        every = np.arange(bins.shape[1])
        total, leaf = np.zeros(len(every)), {}
        for tree, top in tops.items():
            leaf[tree] = walk(top, bins, every)
            total += np.array([c or 0.0 for c in top["closed"]])[leaf[tree]]
        for tree in _trees(files):
            rows = np.flatnonzero(leaf[tree["tree"]] == tree["root"]) if tree["tree"] in leaf else every
            total[rows] += tree["share"][walk(tree, bins, rows)]
        return total / count

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = []
        for values in batches:
            held.append(_binned(_matrix(values), bounds) if len(values) else np.empty((len(bounds), 0), np.uint8))
            if sum(h.shape[1] for h in held) >= BLOCK_ROWS:
                yield from scored(held)
                held = []
        yield from scored(held)

    def scored(held):
        if held:
            found = votes(np.ascontiguousarray(np.concatenate(held, axis=1)))
            yield from (pa.array(part) for part in np.split(found, np.cumsum([h.shape[1] for h in held])[:-1]))

    return score
