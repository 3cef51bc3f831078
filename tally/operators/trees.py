"""Classification trees and forests on many rows (M7, M8, M10): rows are binned once and counted a level of all trees at a time.

The method and the figures are Spark's: candidate thresholds from a sample of the rows, class counts per node, feature and bin,
the split of the largest gain, leaves of equal prediction joined; a single tree equals ``DecisionTreeClassifier``'s wherever the
sample is all rows. Spark goes through the vectors anew for each tree of a grid search and caches each row as objects, for a
forest with a count for every tree. Here a row is cached as one small integer per feature in a block of rows, numpy counts
a block for all trees before it takes the next one, and the bootstrap counts of a block are drawn again from its seed in each pass.
The driver reads one split per open node. The models returned are Spark's own classes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import drop_scratch, scratch_path, ship_package

#: bins and rows of a block at most, rows at least: few calls a row, and what is made of a line of it stays near a core
_BLOCK_BINS, _BLOCK_ROWS, _BLOCK_LEAST = 1 << 20, 65_536, 1024
#: bytes of blocks, or of histograms, that one task should read at most, and bytes of histograms that it should hold
_TASK_BYTES = 32 << 20
_PASS_BYTES = 32 << 20
#: Spark's bins of a feature, classes of a label without metadata, and least impurity of a node that is split
_BINS, _CLASSES, _EPSILON = 32, 100, 2.0**-52
#: inner nodes up to which rows are led by whole lines of comparisons
_SMALL = 63

_BLOCKS = "part int, number int, n int, x binary, y binary, fold binary"
_SPLITS = "item int, node int, variant int, feature int, cut int, gain double, lower array<double>, upper array<double>"

_CDF = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)]))
_LOW, _HIGH = (np.searchsorted(_CDF, (np.arange(65536) + i) / 65536, "right") for i in (0, 1))
_POISSON = np.where(_LOW == _HIGH, _LOW, 255).astype(np.uint8)


def poisson(gen: np.random.BitGenerator, n: int) -> np.ndarray:
    """``n`` Poisson(1) counts by inversion: 16 random bits decide nearly all, the others get 64 more."""
    u = gen.random_raw(-(-n // 4)).view(np.uint16)[:n]
    out = _POISSON.take(u)
    if len(unsure := np.flatnonzero(out == 255)):
        out[unsure] = np.searchsorted(_CDF, (u[unsure] + gen.random_raw(len(unsure)) / 2.0**64) / 65536, "right")
    return out


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Spark's candidate thresholds of a feature, ``most`` at most, from the values of a sample."""
    v, count = np.unique(values, return_counts=True)
    middle = (v[:-1] + v[1:]) / 2
    if len(middle) <= most:
        return middle
    stride, so_far = len(values) / (most + 1), np.cumsum(count).tolist()
    target, kept = stride, []
    for i in range(1, len(v)):
        if abs(so_far[i - 1] - target) < abs(so_far[i] - target):
            kept.append(i - 1)
            target += stride
    return middle[kept]


def impurity_of(counts: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy along the last axis, summed class by class as Spark does; 0 without rows."""
    total = counts.sum(axis=-1)
    out = np.full(total.shape, 1.0 if kind == "gini" else 0.0)
    for k in range(counts.shape[-1]):
        share = counts[..., k] / np.maximum(total, 1)
        out = out - (share * share if kind == "gini" else share * (np.log(np.where(share > 0, share, 1.0)) / np.log(2.0)))
    return np.where(total > 0, out, 0.0)


@dataclass
class Binned:
    """Rows as blocks. ``cuts[k][f]``: the edges of feature ``f`` that are thresholds of the rows without fold ``k`` (-1: of all)."""

    blocks: DataFrame
    parts: int
    edges: list[np.ndarray]
    cuts: dict[int, list[np.ndarray]]
    classes: int
    kind: type


@dataclass
class Tree:
    """A growing tree on the rows without one fold (-1: on all) or on a bootstrap sample (-1: none). Children of node ``i`` are
    ``child[2 i]``, bins up to ``cut[i]``, and ``child[2 i + 1]``; a leaf is its own child. ``open``: nodes to be split."""

    without: int = -1
    min_leaf: int = 1
    draw: int = -1
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    child: list[int] = field(default_factory=lambda: [0, 0])
    counts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])
    open: list[int] = field(default_factory=lambda: [0])

    def shape(self) -> tuple:
        """Equal for trees that need the same counts."""
        return (self.without, self.draw, *map(tuple, (self.feature, self.cut, self.child, self.open)))


@dataclass
class _Item:
    """Open nodes of one tree to be counted; ``subset``: the features of each node, none for all."""

    without: int
    draw: int
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: int
    nodes: list[int]
    subset: np.ndarray | None
    least: list[int]


def _numbers(features: Sequence[str]) -> list[Column]:
    return [F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)]


def bin_rows(rows: DataFrame, features: Sequence[str], label: str, fold: Column | None = None, folds: int = 0, seed: int = 42) -> Binned:
    """``rows`` as cached blocks (the caller unpersists ``blocks``). With ``folds``, ``fold`` numbers the rows' folds."""
    spark = rows.sparkSession
    ship_package(spark)
    y = F.col(label).cast("double")
    rows = rows.select(*_numbers(features), y.alias("_y"), (F.lit(-1) if fold is None else fold).cast("int").alias("_fold"))
    wrong = F.count(F.when(F.col("_y").isNull() | F.isnan("_y") | (F.col("_y") < 0) | (F.col("_y") != F.floor("_y")), 1))
    facts = {r["_fold"]: r for r in rows.groupBy("_fold").agg(F.count(F.lit(1)).alias("n"), F.max("_y").alias("top"), wrong.alias("wrong")).collect()}
    if missing := sorted(set(range(folds)) - set(facts)):
        raise ValueError(f"The validation data at fold {missing[0]} is empty.")
    if any(r["wrong"] for r in facts.values()) or max(r["top"] for r in facts.values()) >= _CLASSES:
        raise ValueError(f"Labels must be whole numbers from 0 to {_CLASSES - 1}, none missing.")
    n, classes = sum(r["n"] for r in facts.values()), int(max(r["top"] for r in facts.values())) + 1
    held = {k: n - (facts[k]["n"] if k >= 0 else 0) for k in (-1, *range(folds))}
    share = max(_BINS**2, 10_000) / min(held.values())
    some = rows.drop("_y") if share >= 1 else rows.drop("_y").sample(False, share, seed)
    found = np.array([tuple(r) for r in some.collect()], dtype=float).reshape(-1, len(features) + 1)
    _check(found)
    each = {k: [thresholds(found[found[:, -1] != k if k >= 0 else slice(None), i], min(_BINS, m) - 1) for i in range(len(features))] for k, m in held.items()}
    edges = [np.unique(np.concatenate([c[i] for c in each.values()])) for i in range(len(features))]
    cuts = {k: [np.searchsorted(e, c) for e, c in zip(edges, by)] for k, by in each.items()}
    kind = np.min_scalar_type(max(len(e) for e in edges)).type

    parts = max(2 * spark.sparkContext.defaultParallelism, -(-n * (len(features) * np.dtype(kind).itemsize + 3) // _TASK_BYTES))
    block = max(_BLOCK_LEAST, min(_BLOCK_ROWS, _BLOCK_BINS // len(features), n // (4 * parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(batches, edges, kind, block)

    return Binned(rows.mapInArrow(run, _BLOCKS).repartition(parts).persist(), parts, edges, cuts, classes, kind)


def _check(x: np.ndarray) -> None:
    if not np.isfinite(x).all():
        raise ValueError("Vector values MUST NOT be NaN or Infinity")


def _blocks(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray], kind: type, block: int) -> Iterator[pa.RecordBatch]:
    part, number, held = TaskContext.get().partitionId(), 0, []

    def cut(final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal number, held
        x, y, fold = (np.concatenate(a, axis=-1) for a in zip(*held))
        done = len(y) if final else len(y) - len(y) % block
        for at in range(0, done, block):
            to = min(at + block, done)
            row = {"part": part, "number": number, "n": to - at, "x": x[:, at:to].tobytes(), "y": y[at:to].tobytes(), "fold": fold[at:to].tobytes()}
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int32()) for v in row.values()], names=list(row))
            number += 1
        held = [(x[:, done:], y[done:], fold[done:])] if done < len(y) else []

    for b in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        x = np.empty((len(edges), b.num_rows), kind)
        for i, e in enumerate(edges):
            _check(columns[i])
            x[i] = np.searchsorted(e, columns[i], "left")
        held.append((x, columns[-2].astype(np.uint8), columns[-1].astype(np.int16)))
        if sum(len(h[1]) for h in held) >= block:
            yield from cut(False)
    if held:
        yield from cut(True)


def _read(batches: Iterator[pa.RecordBatch], features: int, kind: type) -> Iterator[tuple]:
    for b in batches:
        for part, number, n, x, y, fold in zip(*(c for c in b.columns)):
            parts = (np.frombuffer(v.as_buffer(), t) for v, t in ((x, kind), (y, np.uint8), (fold, np.int16)))
            yield part.as_py(), number.as_py(), n.as_py(), *parts


def _descend(x: np.ndarray, n: int, row: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row after ``depth`` steps from the root. ``x``: the bins of ``n`` rows, feature by feature."""
    at = np.zeros(n, np.intp)
    first = feature * n
    for _ in range(depth):
        place = first.take(at)
        place += row
        up = x.take(place) > cut.take(at)
        at += at
        at += up
        at = child.take(at)
    return at


def _layout(widths: list[int], classes: int, subset: int | None) -> np.ndarray:
    """Where the counts of each feature, or of each place in a subset, begin in a node's histogram, and where they end."""
    return np.cumsum([0, *([max(widths)] * subset if subset else widths)]) * classes


def _slots(x: np.ndarray, item: _Item) -> np.ndarray:
    """1 + the place among the open nodes of an item for each row, 0 for rows elsewhere. ``x``: bins, a line for each feature. Small
    trees compare whole lines at their nodes, which costs a row far less than a look-up per step; large ones go down row by row."""
    n = x.shape[1]
    inner = {i for i in range(len(item.feature)) if item.child[2 * i] != i}
    if len(inner) > _SMALL:
        slots = np.zeros(len(item.feature), np.intp)
        slots[item.nodes] = np.arange(len(item.nodes)) + 1
        return slots.take(_descend(x.ravel(), n, np.arange(n), item.feature, item.cut, item.child, item.depth))
    slot, place = np.zeros(n, np.uint8), {i: np.uint8(k + 1) for k, i in enumerate(item.nodes)}
    rest = [(0, np.ones(n, bool))]
    while rest:
        i, here = rest.pop()
        if i in place:
            slot += here.view(np.uint8) * place[i]
        elif i in inner:
            up = x[item.feature[i]] > item.cut[i]
            rest += [(item.child[2 * i], here > up), (item.child[2 * i + 1], here & up)]
    return slot


def _count(batches: Iterator[pa.RecordBatch], items: list[_Item], widths: list[int], classes: int, kind: type, seed: int) -> Iterator[pa.RecordBatch]:
    """Class counts per item, open node, feature and bin over the blocks of a task."""
    at = [_layout(widths, classes, None if i.subset is None else i.subset.shape[1]).tolist() for i in items]
    sums = [np.zeros((len(i.nodes), a[-1])) for i, a in zip(items, at)]
    # the first line, for rows elsewhere, is never read
    begins = [None if i.subset is None else np.ascontiguousarray(np.vstack([i.subset[:1], i.subset]).T) for i in items]
    seen = False
    for part, number, n, x, y, fold in _read(batches, len(widths), kind):
        seen, x, every = True, x.reshape(len(widths), n), np.arange(n)
        codes = x.astype(np.int32) * classes + y
        flat = codes.ravel()
        for item, begin, first, total in zip(items, at, begins, sums):
            size, row, weight = len(item.nodes) + 1, every, None
            slot = _slots(x, item)
            if item.without >= 0:
                slot[fold == item.without] = 0
            if item.draw >= 0:
                drawn = poisson(np.random.SFC64([seed, item.draw, part, number]), n)
                row = np.flatnonzero(drawn != 0)
                slot, weight = slot.take(row), drawn.take(row).astype(float)
            slot = slot.astype(np.intp)
            base, last = slot, 1
            for s in range(len(begin) - 1):
                width = begin[s + 1] - begin[s]
                if width != last:
                    base, last = slot * width, width
                if first is not None:
                    place = (first[s] * n).take(slot)
                    place += row
                    code = flat.take(place) + base
                else:
                    code = (codes[s] if item.draw < 0 else codes[s].take(row)) + base
                total[:, begin[s] : begin[s + 1]] += np.bincount(code, weight, size * width)[width:].reshape(size - 1, width)
    if seen:
        for k, total in enumerate(sums):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["item", "counts"])


def _best(counts: np.ndarray, columns: list[tuple[int, int, int]], cuts: list[np.ndarray], classes: int, least: Sequence[int], kind: str) -> list[tuple]:
    """For each least number of rows in a leaf: feature, cut, gain, lower and upper counts of a node's best split, the first of
    equals; a gain below 0 where there is none. ``columns``: feature and place of its counts."""
    best: list[tuple | None] = [None] * len(least)
    for f, begin, end in columns:
        below = counts[begin:end].reshape(-1, classes).cumsum(axis=0)
        total = below[-1]
        if not len(cuts[f]):
            best = [b or (f, 0, -1.0, total, total * 0) for b in best]
            continue
        lower = below[cuts[f]]
        upper = total - lower
        n_low, n_up = lower.sum(axis=1), upper.sum(axis=1)
        n = np.maximum(n_low + n_up, 1)
        gain = impurity_of(total, kind) - n_low / n * impurity_of(lower, kind) - n_up / n * impurity_of(upper, kind)
        for v, m in enumerate(least):
            valid = np.where((n_low >= m) & (n_up >= m), gain, -1.0)
            i = int(np.argmax(valid))
            if best[v] is None or valid[i] > best[v][2]:
                best[v] = (f, int(cuts[f][i]), float(valid[i]), lower[i], upper[i])
    return best


def _choose(batches: Iterator[pa.RecordBatch], items: list[_Item], widths: list[int], classes: int, cuts: dict[int, list[np.ndarray]], kind: str) -> Iterator[pa.RecordBatch]:
    """The best splits of each item's nodes, from the counts of all tasks."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, counts in zip(b.column(0).to_pylist(), b.column(1)):
            part = np.frombuffer(counts.as_buffer(), float)
            sums[k] = sums[k] + part if k in sums else part
    for k, counts in sums.items():
        item, out = items[k], []
        begin = _layout(widths, classes, None if item.subset is None else item.subset.shape[1]).tolist()
        for i, (node, own) in enumerate(zip(item.nodes, counts.reshape(len(item.nodes), -1))):
            of = range(len(widths)) if item.subset is None else item.subset[i].tolist()
            columns = [(f, a, a + widths[f] * classes) for f, a in zip(of, begin)]
            for v, (f, cut, gain, lower, upper) in enumerate(_best(own, columns, cuts[item.without], classes, item.least, kind)):
                out.append((k, node, v, f, cut, gain, lower.tolist(), upper.tolist()))
        kinds = [pa.int32()] * 5 + [pa.float64()] + [pa.list_(pa.float64())] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[c.split()[0] for c in _SPLITS.split(", ")])


def grow(data: Binned, trees: list[Tree], max_depth: int, impurity: str = "gini", subset: int | None = None, seed: int = 42) -> None:
    """Grow all ``trees``, one level of all of them at a time. ``subset``: how many features a node may choose from, drawn anew for
    each node. Trees that differ in their least leaf alone share their counts until they part."""
    if impurity not in ("gini", "entropy"):
        raise ValueError(f"impurity is {impurity}, not gini or entropy")
    widths, spark = [len(e) + 1 for e in data.edges], data.blocks.sparkSession
    draws = {t.draw: np.random.default_rng([seed, t.draw]) for t in trees if t.draw >= 0}
    row_bytes = 8 * int(_layout(widths, data.classes, subset)[-1])
    most = max(1, min(_PASS_BYTES, _TASK_BYTES // data.parts) // row_bytes)
    for depth in range(max_depth):
        same: dict[tuple, list[Tree]] = {}
        for t in trees:
            if t.open:
                same.setdefault(t.shape(), []).append(t)
        todo: list[tuple[_Item, list[Tree]]] = []
        for group in same.values():
            t = group[0]
            arrays = (np.array(t.feature, np.intp), np.array(t.cut, data.kind), np.array(t.child, np.intp))
            for at in range(0, len(t.open), most):
                nodes = t.open[at : at + most]
                drawn = np.array([draws[t.draw].choice(len(widths), subset, False) for _ in nodes]) if subset else None
                todo.append((_Item(t.without, t.draw, *arrays, depth, nodes, drawn, sorted({x.min_leaf for x in group})), group))
        for t in trees:
            t.open = []
        per_pass: list[list[tuple[_Item, list[Tree]]]] = []
        held = _PASS_BYTES + 1
        for entry in todo:
            size = len(entry[0].nodes) * row_bytes
            if held + size > _PASS_BYTES:
                per_pass.append([])
                held = 0
            per_pass[-1].append(entry)
            held += size
        for entries in per_pass:
            # in one order, since the numbers of new nodes and later draws of features follow it
            for r in sorted(_pass(spark, data, [e[0] for e in entries], widths, impurity, row_bytes, seed), key=lambda r: (r["item"], r["node"], r["variant"])):
                item, group = entries[r["item"]]
                for t in group:
                    if t.min_leaf == item.least[r["variant"]]:
                        _split(t, r, depth + 1 < max_depth, impurity)


def _pass(spark: SparkSession, data: Binned, items: list[_Item], widths: list[int], impurity: str, row_bytes: int, seed: int) -> list:
    classes, kind, cuts = data.classes, data.kind, data.cuts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(batches, items, widths, classes, kind, seed)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _choose(batches, items, widths, classes, cuts, impurity)

    counted = sum(len(i.nodes) for i in items) * row_bytes * data.parts
    parts = min(len(items), max(spark.sparkContext.defaultParallelism, -(-counted // _TASK_BYTES)))
    return data.blocks.mapInArrow(count, "item int, counts binary").repartition(parts, "item").mapInArrow(choose, _SPLITS).collect()


def _split(t: Tree, r, further: bool, impurity: str) -> None:
    """Take a node's best split; its children stay open where they may be split ``further``."""
    node, sides = r["node"], [np.array(r["lower"]), np.array(r["upper"])]
    if node == 0:
        t.counts[0] = sides[0] + sides[1]
    if r["gain"] <= 0:
        return
    t.feature[node], t.cut[node], t.gain[node] = r["feature"], r["cut"], r["gain"]
    for side, counts in enumerate(sides):
        new = len(t.feature)
        t.child[2 * node + side] = new
        t.feature.append(0)
        t.cut.append(0)
        t.gain.append(0.0)
        t.child += [new, new]
        t.counts.append(counts)
        if further and impurity_of(counts, impurity) >= _EPSILON:
            t.open.append(new)


def accuracies(data: Binned, asked: list[tuple[Tree, int]]) -> list[float]:
    """For each tree, cut off at a depth: the share of the rows of the fold it was grown without whose label it predicts."""
    features, classes, kind = len(data.edges), data.classes, data.kind
    plain = [
        (t.without, np.array(t.feature, np.intp), np.array(t.cut, kind), np.array(t.child, np.intp), depth, np.array([np.argmax(c) for c in t.counts]))
        for t, depth in asked
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n_rows = np.zeros(len(plain), np.int64), np.zeros(len(plain), np.int64)
        for _, _, n, x, y, fold in _read(batches, features, kind):
            x, own = x.reshape(features, n), {}
            for k, (without, feature, cut, child, depth, said) in enumerate(plain):
                if without not in own:
                    rows = np.flatnonzero(fold == without)
                    own[without] = x[:, rows].ravel(), y[rows]
                bins, labels = own[without]
                node = _descend(bins, len(labels), np.arange(len(labels)), feature, cut, child, depth)
                right[k] += np.count_nonzero(said[node] == labels)
                n_rows[k] += len(labels)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(plain))), pa.array(right), pa.array(n_rows)], names=["k", "right", "n"])

    out = data.blocks.mapInArrow(run, "k long, right long, n long").groupBy("k").agg(F.sum("right").alias("right"), F.sum("n").alias("n")).collect()
    by = {r["k"]: r["right"] / r["n"] for r in out}
    return [by[k] for k in range(len(asked))]


def _nodes(tree: Tree, data: Binned, depth: int, impurity: str) -> list[tuple]:
    """The nodes of a tree, cut off at ``depth``, as Spark's models store them: parents first, leaves of equal prediction joined."""
    out: list[tuple] = []

    def said(i: int) -> int:
        return int(np.argmax(tree.counts[i]))

    def leaf(i: int, left: int) -> bool:
        low, high = tree.child[2 * i : 2 * i + 2]
        return not left or low == i or (leaf(low, left - 1) and leaf(high, left - 1) and said(low) == said(high))

    def add(i: int, left: int) -> int:
        number = len(out)
        counts = [float(c) for c in tree.counts[i]]
        figures = float(said(i)), float(impurity_of(tree.counts[i], impurity)), counts, int(sum(counts))
        if leaf(i, left):
            out.append((number, *figures, -1.0, -1, -1, (-1, [], -1)))
            return number
        out.append(())
        low, high = (add(c, left - 1) for c in tree.child[2 * i : 2 * i + 2])
        split = tree.feature[i], [float(data.edges[tree.feature[i]][tree.cut[i]])], -1
        out[number] = (number, *figures, tree.gain[i], low, high, split)
        return number

    add(0, depth)
    return out


_NODE = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)


def _loaded(spark: SparkSession, kind: str, data: Binned, params: dict, tables: dict[str, DataFrame]):
    """A Spark model read from ``tables`` and its metadata, in the form that models are saved in."""
    from pyspark.ml import classification

    name = f"{kind}ClassificationModel"
    said = {"class": f"org.apache.spark.ml.classification.{name}", "timestamp": 0, "sparkVersion": spark.version, "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": params, "defaultParamMap": {}}
    path = scratch_path(spark)
    try:
        for table, rows in tables.items():
            rows.coalesce(1).write.parquet(f"{path}/{table}")
        count = {"numTrees": params["numTrees"]} if "numTrees" in params else {}
        text = json.dumps(said | {"numFeatures": len(data.edges), "numClasses": data.classes} | count)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return getattr(classification, name).load(path)
    finally:
        drop_scratch(spark, path)


def tree_model(spark: SparkSession, tree: Tree, data: Binned, depth: int, impurity: str = "gini"):
    """Spark's model of a grown tree, cut off at ``depth``."""
    nodes = spark.createDataFrame(_nodes(tree, data, depth, impurity), _NODE)
    return _loaded(spark, "DecisionTree", data, {"impurity": impurity, "maxDepth": depth}, {"data": nodes})


def forest_model(spark: SparkSession, trees: list[Tree], data: Binned, depth: int, impurity: str = "gini"):
    """Spark's model of a grown forest."""
    nodes = spark.createDataFrame([(k, n) for k, t in enumerate(trees) for n in _nodes(t, data, depth, impurity)], f"treeID int, nodeData struct<{_NODE}>")
    params = {"impurity": impurity, "maxDepth": depth}
    each = {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", "timestamp": 0, "sparkVersion": spark.version, "paramMap": params, "defaultParamMap": {}}
    known = spark.createDataFrame([(k, json.dumps(each | {"uid": f"tree_{k}"}), 1.0) for k in range(len(trees))], "_1 int, _2 string, _3 double")
    return _loaded(spark, "RandomForest", data, params | {"numTrees": len(trees)}, {"data": nodes, "treesMetadata": known})
