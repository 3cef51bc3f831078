"""Vector code compression: codebooks of each part of a vector, nearest entries found with a GNAT.

A vector of integers is cut into ``parts`` equal consecutive parts, and each part is coded by the index of the nearest
entry of its part's codebook. Codebooks start as the parts of the first vectors by id; a round assigns every part of
every vector and moves each entry to the componentwise floor of its parts' mean. A round is one pass over the written
integer vectors: each task adds up its parts per entry, Spark adds up the tasks' sums, and the driver gets one number
per component of the codebooks, whatever the data's size.

The nearest entry is found with a geometric near-neighbour access tree over the entries, one per part. A node keeps a
few split points, far from each other; every other entry goes to the child of its nearest split point. For each split
point i and child j the node stores the range of distances from i to the entries of j and to the split point j. Once
the distance from a part to split point i is known, child j is out if its range lies strictly beyond the distance to
the best entry so far. Bounds are square roots rounded outwards, so rounding never puts an entry out that is as near as
the best; entries that are reached are compared by their integer squared distance and, where equal, by index. Parts of
a batch go through a node together, each with the children that are left to it.

Vectors that are null or hold null or non-finite components are dropped. Vectors that are shorter than the longest one,
or whose length is no multiple of ``parts``, count as padded with zeros. Components are bounded by the power of two
that keeps a vector's squared distances below 2^62 (2^27 for 64 components, which is 32,768 before scaling by 4096).
Rows that repeat an id are vectors of their own, ordered by their components; a null id sorts last; with fewer vectors
than entries, codebooks have as many entries as there are vectors; an empty table gives an empty result; other columns
are ignored unless they are named to be kept.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import matrix
from tally.llm.topk import usable
from tally.session import cut_lineage

_UP, _DOWN = 1 + 2.0**-48, 1 - 2.0**-48  # wider than the rounding of a root, a product and a difference
ROWS = 1 << 14


@dataclass
class Node:
    ids: np.ndarray  # indexes of the split points
    points: np.ndarray
    low: np.ndarray  # [i, j]: least distance from split point i to what child j holds, its split point included
    high: np.ndarray
    children: list


def _squares(points: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.square(points - x).sum(axis=-1)


def build_tree(entries: np.ndarray, ids: np.ndarray | None = None, degree: int = 4) -> Node | None:
    """A tree over the rows of ``entries`` (integers); ``ids`` are the rows that it holds."""
    ids = np.arange(len(entries)) if ids is None else ids
    if not len(ids):
        return None
    chosen, away = [0], _squares(entries[ids], entries[ids[0]])
    while len(chosen) < min(degree, len(ids)):
        away[chosen] = -1  # equal entries: never the same one twice
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, _squares(entries[ids], entries[ids[chosen[-1]]]))
    splits = ids[chosen]
    others = np.setdiff1d(ids, splits)
    to_split = np.stack([_squares(entries[others], entries[s]) for s in splits])
    home = np.argmin(to_split, axis=0)
    low, high = np.empty((len(splits),) * 2), np.empty((len(splits),) * 2)
    for i, s in enumerate(splits):
        for j, t in enumerate(splits):
            d = np.append(to_split[i, home == j], _squares(entries[s], entries[t]))
            low[i, j], high[i, j] = np.sqrt(d.min()) * _DOWN, np.sqrt(d.max()) * _UP
    return Node(splits, entries[splits], low, high, [build_tree(entries, others[home == j], degree) for j in range(len(splits))])


class Search:
    """The nearest entry of each row of ``x``: ``best`` (squared distance) and ``at`` (index); ``met`` counts the
    distances that were computed."""

    def __init__(self, tree: Node, x: np.ndarray):
        self.x, self.met = x, 0
        self.best, self.at = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), np.iinfo(np.int64).max)
        self._go(tree, np.arange(len(x)))

    def _beyond(self, gap: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return gap * _DOWN > np.sqrt(self.best[rows]) * _UP

    def _go(self, node: Node, rows: np.ndarray) -> None:
        gap = np.full((len(rows), len(node.ids)), -1.0)  # how far each child lies off at least
        for i, point in enumerate(node.points):
            alive = np.flatnonzero(~self._beyond(gap[:, i], rows)) if i else np.arange(len(rows))
            if not len(alive):
                continue
            r = rows[alive]
            d = _squares(self.x[r], point)
            self.met += len(r)
            better = (d < self.best[r]) | ((d == self.best[r]) & (node.ids[i] < self.at[r]))
            self.best[r[better]], self.at[r[better]] = d[better], node.ids[i]
            root = np.sqrt(d)[:, None]
            gap[alive] = np.maximum(gap[alive], np.maximum(root * _DOWN - node.high[i], node.low[i] - root * _UP))
        for j, child in enumerate(node.children):
            if child is not None:
                left = rows[~self._beyond(gap[:, j], rows)]
                if len(left):
                    self._go(child, left)


@dataclass
class Codebooks:
    """``entries[part, index]``: the integer components of an entry."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def trees(self) -> list[Node]:
        return [build_tree(e) for e in self.entries]


def _assigned(trees: list[Node], lists: pa.ListArray, width: int):
    """For slices of rows: the parts (rows, parts, components), their indexes and their squared distances."""
    for a in range(0, len(lists), ROWS):
        x = matrix(lists[a : a + ROWS], width).reshape(-1, len(trees), width // len(trees))
        found = [Search(t, np.ascontiguousarray(x[:, p])) for p, t in enumerate(trees)]
        yield x, np.stack([f.at for f in found], axis=1), np.stack([f.best for f in found], axis=1)


def whole_vectors(df: DataFrame, factor: int = 4096, parts: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple = ()) -> tuple[DataFrame, int]:
    """(vec_id, v, kept columns) with integer components floor(factor * x), written, and the padded width."""
    kept = df.where(F.coalesce(usable(F.col(vector_col)), F.lit(False)))
    longest = kept.agg(F.max(F.size(vector_col))).first()[0] or 1
    width = -(-longest // parts) * parts
    bound = float(1 << ((62 - (width - 1).bit_length()) // 2 - 1))
    whole = F.transform(vector_col, lambda x: F.greatest(F.least(F.floor(x.cast("double") * float(factor)).cast("double"), F.lit(bound)), F.lit(-bound)).cast("int"))
    return cut_lineage(kept.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"), *keep)), width


def _sums(vectors: DataFrame, books: Codebooks) -> dict[int, int]:
    """Per part and entry the sum of each component of its parts and, one place on, how many they are."""
    trees, (parts, n, w) = books.trees(), books.entries.shape

    def run(batches):
        total = np.zeros((parts * n, w + 1), np.int64)
        for b in batches:
            for x, at, _ in _assigned(trees, b["v"], parts * w):
                for p in range(parts):
                    cell = p * n + at[:, p]
                    np.add.at(total, cell, np.concatenate((x[:, p], np.ones((len(x), 1), np.int64)), axis=1))
        used = np.flatnonzero(np.repeat(total[:, w] > 0, w + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total.ravel()[used])], names=["cell", "total"])

    cells = vectors.select("v").mapInArrow(run, "cell int, total long")
    return {r["cell"]: int(r["total"]) for r in cells.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total")).collect()}


def fit(vectors: DataFrame, width: int, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks:
    """Codebooks of (vec_id, v) rows; all rows are read in every round."""
    if width % parts:
        raise ValueError(f"{width} components do not make {parts} equal parts")
    first = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    w = width // parts
    start = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r["v"])] = r["v"]
    books = Codebooks(np.ascontiguousarray(start.reshape(len(first), parts, w).swapaxes(0, 1)))
    for _ in range(rounds if first else 0):
        sums, after = _sums(vectors, books), books.entries.copy()
        for p in range(parts):
            for e in range(len(first)):
                cell = (p * len(first) + e) * (w + 1)
                if n := sums.get(cell + w):
                    after[p, e] = [sums[cell + i] // n for i in range(w)]
        books = Codebooks(after)
    return books


def encode(vectors: DataFrame, books: Codebooks, keep: tuple = ()) -> DataFrame:
    """(vec_id, code, error, kept columns): two hex digits a part, and the sum of the squared distances."""
    trees, names = books.trees(), ["vec_id", "code", "error", *keep]

    def run(batches):
        for b in batches:
            codes, errors = [], [np.zeros(0, np.int64)]
            for _, at, d in _assigned(trees, b["v"], books.width):
                codes += [row.tobytes().hex() for row in at.astype(np.uint8)]
                errors.append(d.sum(axis=1))
            yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(codes, pa.string()), pa.array(np.concatenate(errors)), *(b[c] for c in keep)], names=names)

    if books.entries.shape[1] > 256:
        raise ValueError("a code has two hex digits a part: 256 entries at most")
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields if f.name in keep)
    return vectors.select("vec_id", "v", *keep).mapInArrow(run, f"vec_id long, code string, error long{kinds}")


def decode(code: str, books: Codebooks) -> list[int]:
    """The vector that a code stands for."""
    return [c for p, e in enumerate(bytes.fromhex(code)) for c in books.entries[p, e].tolist()]
