"""M6: hierarchical clustering with Ward's criterion on a bounded summary.

Ward joins, step by step, the two clusters whose union raises the sum of squared distances to the centres least. That
needs all pairs of leaves, so the rows are first summed up: equal points are one leaf with a weight, and while there are
more than ``most`` leaves, neighbouring ones are merged into micro-clusters. A micro-cluster is its number of rows,
their sum and the sum of their squares; two of them add up, so each task sums up its own rows and the tasks' summaries
are summed up again in a few rounds, none of which puts more than ``fan_in`` summaries into one task. At most ``most``
leaves reach the driver, where all merges are made exactly.

With ``most`` different points or fewer nothing is merged beforehand and the result is Ward's on all rows. Beyond that
the leaves are the cells of repeated halving along the widest feature: a merge is then exact for the leaves, and
``within`` of a leaf says what its rows lost.

Rows with a null or non-finite feature take no part; leaves are numbered in the order of their centres; of equal
increases the pair with the lower numbers is joined first; an empty table has no leaves and no merges.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.session import drop_scratch, write_scratch

MOST_LEAVES = 2000
_SCHEMA = "n double, s array<double>, q double"


def halves(x: np.ndarray, most: int) -> np.ndarray:
    """A cell number for each row: at most ``most`` cells, the widest cell halved at its middle row each time."""
    cell = np.zeros(len(x), np.int64)
    spread = lambda rows: np.ptp(x[rows], axis=0).max(initial=0.0) if len(rows) > 1 else 0.0
    members = {0: np.arange(len(x))}
    width = {0: spread(members[0])}
    while len(members) < most:
        # halve all cells of the upper half of the widths at once, so there are few passes
        order = sorted((c for c in members if width[c] > 0), key=lambda c: (-width[c], c))
        order = order[: min(max(1, len(order) // 2), most - len(members))]
        if not order:
            break
        for c in order:
            rows = members[c]
            by = rows[np.argsort(x[rows, np.argmax(np.ptp(x[rows], axis=0))], kind="stable")]
            new = len(members)
            members[c], members[new] = by[: len(by) // 2], by[len(by) // 2 :]
            width[c], width[new] = spread(members[c]), spread(members[new])
            cell[members[new]] = new
    return cell


def _reduced(n: np.ndarray, s: np.ndarray, q: np.ndarray, most: int):
    if len(n) <= most:
        return n, s, q
    # order of centres first: the cells do not depend on the order in which rows come
    centres = s / n[:, None]
    order = np.lexsort(centres.T[::-1])
    n, s, q, centres = n[order], s[order], q[order], centres[order]
    cell = halves(centres, most)
    k = int(cell.max()) + 1
    total = np.zeros((k, s.shape[1]))
    np.add.at(total, cell, s)
    return np.bincount(cell, n, k), total, np.bincount(cell, q, k)


def micro_clusters(df: DataFrame, features: Sequence[str], most: int = MOST_LEAVES, fan_in: int = 16) -> DataFrame:
    """(n, s, q): rows, sum and sum of squares of at most ``most`` micro-clusters, written."""
    cols = [F.col(c).cast("double") for c in features]
    known = df.select(*[c.alias(f"f{i}") for i, c in enumerate(cols)])
    for i in range(len(cols)):
        known = known.where(F.col(f"f{i}").isNotNull() & ~F.isnan(f"f{i}") & (F.abs(f"f{i}") < float("inf")))
    names = [f"f{i}" for i in range(len(cols))]
    points = known.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n"))
    square = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    leaves = points.select("n", F.array(*[F.col(c) * F.col("n") for c in names]).alias("s"), (square * F.col("n")).alias("q"))

    def reduce(batches):
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            new = pdf["n"].to_numpy(float), np.stack(pdf["s"].to_numpy()).astype(float), pdf["q"].to_numpy(float)
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
            if len(held[0]) > 2 * most:
                held = _reduced(*held, most)
        if held is not None:
            n, s, q = _reduced(*held, most)
            yield pd.DataFrame({"n": n, "s": s.tolist(), "q": q})

    spark, path = df.sparkSession, write_scratch(leaves.mapInPandas(reduce, _SCHEMA))
    while True:
        table = spark.read.schema(_SCHEMA).parquet(path)
        total = table.count()
        if total <= most:
            return table
        tasks = max(1, total // (fan_in * most))
        after = write_scratch(table.repartition(tasks).mapInPandas(reduce, _SCHEMA))
        drop_scratch(spark, path)
        path = after


def merges(n: np.ndarray, centres: np.ndarray) -> list[tuple[int, int, float, float]]:
    """All merges of leaves with weights: (left, right, increase, rows); leaf i has number i, the cluster of merge k
    number len(n) + k. Every cluster keeps its nearest one, so a merge looks at one row of pairs."""
    m = len(n)
    n, c = n.astype(float).copy(), centres.astype(float).copy()
    name = np.arange(m)

    def away(i: int) -> np.ndarray:
        d = n[i] * n / (n[i] + n) * np.square(c - c[i]).sum(axis=1)
        d[~alive] = np.inf
        d[i] = np.inf
        return d

    alive = np.ones(m, bool)
    near, least = np.zeros(m, np.int64), np.full(m, np.inf)

    def find(i: int) -> None:
        d = away(i)
        ties = np.flatnonzero(d == d.min())
        near[i] = ties[np.argmin(name[ties])]
        least[i] = d[near[i]]

    for i in range(m if m > 1 else 0):
        find(i)
    out = []
    for k in range(m - 1):
        ties = np.flatnonzero(alive & (least == least[alive].min()))
        i = min(ties.tolist(), key=lambda t: tuple(sorted((name[t], name[near[t]]))))
        j = int(near[i])
        a, b = sorted((int(name[i]), int(name[j])))
        out.append((a, b, float(least[i]), float(n[i] + n[j])))
        c[i] = (n[i] * c[i] + n[j] * c[j]) / (n[i] + n[j])
        n[i] += n[j]
        name[i] = m + k
        alive[j] = False
        least[j] = np.inf
        if k == m - 2:
            break
        find(i)
        d = away(i)
        for t in np.flatnonzero(alive & ((near == i) | (near == j))):
            if t != i:
                find(int(t))
        closer = alive & (d < least)
        closer[i] = False
        near[closer], least[closer] = i, d[closer]
    return out


class Ward:
    """The leaves and merges of ``df``; ``merges`` and ``leaves`` are small tables, ``segments`` labels all rows."""

    def __init__(self, df: DataFrame, features: Sequence[str], most: int = MOST_LEAVES):
        self.df, self.features = df, list(features)
        got = micro_clusters(df, features, most).toPandas()  # at most ``most`` rows
        n = got["n"].to_numpy(float)
        s = np.stack(got["s"].to_numpy()).astype(float) if len(got) else np.zeros((0, len(self.features)))
        centres = s / n[:, None] if len(got) else s
        order = np.lexsort(centres.T[::-1]) if len(got) else np.zeros(0, int)
        self.n, self.centres = n[order], centres[order]
        self.within = np.maximum(got["q"].to_numpy(float)[order] - (s[order] ** 2).sum(axis=1) / self.n, 0.0) if len(got) else np.zeros(0)
        self.steps = merges(self.n, self.centres)

    def merges(self) -> DataFrame:
        """The dendrogram: step, left, right, increase of the sum of squares, height (root of twice the increase) and
        rows of the new cluster."""
        rows = [(k + 1, a, b, inc, float(np.sqrt(2 * inc)), int(n)) for k, (a, b, inc, n) in enumerate(self.steps)]
        return self.df.sparkSession.createDataFrame(rows, "step int, left int, right int, increase double, height double, n_rows long")

    def leaves(self) -> DataFrame:
        """leaf, n_rows, within (sum of squares inside the leaf) and its centre."""
        rows = [(i, int(n), float(w), c.tolist()) for i, (n, w, c) in enumerate(zip(self.n, self.within, self.centres))]
        return self.df.sparkSession.createDataFrame(rows, "leaf int, n_rows long, within double, centre array<double>")

    def cut(self, k: int) -> np.ndarray:
        """Cluster of each leaf when ``k`` clusters are left, numbered by their lowest leaf."""
        m = len(self.n)
        root = list(range(2 * m))
        for step, (a, b, _, _) in enumerate(self.steps[: max(0, m - k)]):
            root[a] = root[b] = m + step

        def top(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        tops = [top(i) for i in range(m)]
        number = {t: i for i, t in enumerate(dict.fromkeys(tops))}
        return np.array([number[t] for t in tops], dtype=np.int64)

    def segments(self, k: int, col: str = "cluster") -> DataFrame:
        """``df`` with the cluster of the leaf whose centre is nearest (its own leaf where leaves are points)."""
        centres, of_leaf, features = self.centres, self.cut(k), self.features

        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            known = np.array([v is not None and all(u is not None and np.isfinite(u) for u in v) for v in x])
            out = pd.Series([None] * len(x), dtype="object")
            if known.any() and len(centres):
                p = np.stack(x[known].to_numpy()).astype(float)
                found = np.empty(len(p), np.int64)
                for a in range(0, len(p), 1024):
                    d = np.square(p[a : a + 1024, None, :] - centres[None]).sum(axis=2)
                    found[a : a + 1024] = of_leaf[d.argmin(axis=1)]
                out[known] = found
            return out

        return self.df.withColumn(col, nearest(F.array(*[F.col(c).cast("double") for c in features])))
