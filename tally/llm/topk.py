"""Exact top-k inner products by block-at-a-time pruning.

Vectors are laid out in blocks of ``block_rows`` rows. A block keeps its rows (the forward index) and, for each
component, the largest and the smallest value. Per query, the sum of weight times largest value (smallest, for
a negative weight) bounds every score of the block; blocks are taken in order of that bound, their rows scored
through the forward index, until the next bound falls below the k-th best score so far. A bound equal to it is
still taken, so ties are decided by vec_id and the result is exact.

The index is built once and stays where it is: rows are sorted into groups of bounded size by a hash of the row, inside
a group ordered by repeated halving along the widest component, so rows of a block lie together, and written. Queries
come to it in chunks of at most ``chunk_values`` components, each sent to all tasks, which read their part of the
index in place; nothing of the index is shuffled or copied per chunk. So that a task need not start from nothing, each
query is first scored against a few blocks of the index (the pilot): the k-th best score there is a bound from below
that every task starts with, and a task carries its k best scores from block to block. What a task returns per query is
at most k rows that reach the pilot's score; a window ranks these. The stated query set meets all rows, in blocks.

Vectors that are null or hold null or non-finite components take no part, nor do null ids; shorter vectors count
as padded with zeros; every row counts, also where ids or whole rows repeat, and a query row meets all rows but itself.
Scores are exact while sums stay below 2^62. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import matrix
from tally.session import cut_lineage, write_scratch


def usable(v: Column) -> Column:
    """True where a vector and all its components are finite."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def scaled(df: DataFrame, factor: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, v) with integer components floor(factor * x), written; ``row`` numbers the rows."""
    v = F.col(vector_col)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * float(factor)).cast("long"))
    kept = df.where(F.col(id_col).isNotNull()).where(F.coalesce(usable(v), F.lit(False)))
    return cut_lineage(kept.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")))


def _near_order(x: np.ndarray, block_rows: int) -> np.ndarray:
    """An order of rows in which each block of ``block_rows`` rows lies close together."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= block_rows:
            out.append(rows)
            continue
        part = x[rows]
        by = rows[np.argsort(part[:, np.argmax(part.max(axis=0) - part.min(axis=0))], kind="stable")]
        half = -(-len(rows) // (2 * block_rows)) * block_rows
        todo += [by[half:], by[:half]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


_BLOCK = "g int, b int, rows array<long>, ids array<long>, x array<long>, top array<long>, low array<long>"


def index(vectors: DataFrame, groups: int, block_rows: int) -> DataFrame:
    """One row per block of (row, vec_id, v): its group and number there, row numbers and ids, ``x`` its matrix row by
    row, and the largest and smallest value of each component."""

    def build(key, batch):
        order = np.argsort(batch["row"].to_numpy(), kind="stable")
        rows, ids = batch["row"].to_numpy()[order], batch["vec_id"].to_numpy()[order]
        lists = batch["v"].combine_chunks()
        width = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
        x = matrix(lists, width)[order]
        near = _near_order(x, block_rows)
        parts = [near[a : a + block_rows] for a in range(0, len(near), block_rows)]
        lists_of = pa.list_(pa.int64())
        cols = [[rows[p] for p in parts], [ids[p] for p in parts], [x[p].ravel() for p in parts], [x[p].max(axis=0) for p in parts], [x[p].min(axis=0) for p in parts]]
        numbers = [pa.array([key[0].as_py()] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32())]
        return pa.table([*numbers, *(pa.array(c, lists_of) for c in cols)], names=["g", "b", "rows", "ids", "x", "top", "low"])

    placed = vectors.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    return placed.groupBy("g").applyInArrow(build, _BLOCK)


class Search:
    """The ``k`` best rows of each query among the blocks that were added; ``least`` is a score that the k-th best row
    of all is known to reach. ``met`` counts the pairs of a query and a block that were scored, of ``seen``."""

    def __init__(self, rows: np.ndarray, q: np.ndarray, least: np.ndarray, k: int):
        self.rows, self.q, self.least, self.k = rows, q, least, k
        self.none = -(1 << 62)  # can be negated
        self.best, self.best_id = np.full((len(q), k), self.none), np.full((len(q), k), np.iinfo(np.int64).max)
        self.met = self.seen = 0

    def add(self, blocks: pa.RecordBatch) -> None:
        if not blocks.num_rows or not len(self.q):
            return
        col = {c: blocks[c].combine_chunks() if isinstance(blocks[c], pa.ChunkedArray) else blocks[c] for c in ("rows", "ids", "x", "top", "low")}
        own = np.diff(col["top"].offsets.to_numpy())
        width = max(int(own.max(initial=0)), self.q.shape[1])
        n = np.diff(col["ids"].offsets.to_numpy())
        most = int(n.max())
        filled = np.arange(most) < n[:, None]
        ids, rows = np.full(filled.shape, np.iinfo(np.int64).max), np.full(filled.shape, -1)
        ids[filled] = col["ids"].flatten().to_numpy(zero_copy_only=False)
        rows[filled] = col["rows"].flatten().to_numpy(zero_copy_only=False)
        x = np.zeros((len(n), most, width), dtype=np.int64)
        flat, at = col["x"].flatten().to_numpy(zero_copy_only=False), 0
        for i, (m, w) in enumerate(zip(n.tolist(), own.tolist(), strict=True)):
            x[i, :m, :w] = flat[at : at + m * w].reshape(m, w)
            at += m * w
        q = np.zeros((len(self.q), width), dtype=np.int64)
        q[:, : self.q.shape[1]] = self.q
        top, low = matrix(col["top"], width), matrix(col["low"], width)
        kind = np.float64 if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, width) < 2**53 else np.int64
        q, x = q.astype(kind), x.astype(kind)
        bound = np.maximum(q, 0) @ top.T.astype(kind) + np.minimum(q, 0) @ low.T.astype(kind)
        order = np.argsort(-bound, axis=1, kind="stable")
        live = np.arange(len(q))
        self.seen += len(q) * len(n)
        for step in range(len(n)):
            at = order[live, step]
            live = live[bound[live, at] >= np.maximum(self.best[live, -1], self.least[live])]
            if not len(live):
                break
            self.met += len(live)
            for part in (live[i : i + 256] for i in range(0, len(live), 256)):
                b = order[part, step]
                scores = np.matmul(x[b], q[part][:, :, None])[:, :, 0].astype(np.int64)
                scores[~filled[b] | (rows[b] == self.rows[part][:, None])] = self.none
                s, i = np.concatenate((self.best[part], scores), axis=1), np.concatenate((self.best_id[part], ids[b]), axis=1)
                pick = np.lexsort((i, -s), axis=1)[:, : self.k]
                self.best[part], self.best_id[part] = np.take_along_axis(s, pick, 1), np.take_along_axis(i, pick, 1)

    def table(self, query_ids: np.ndarray) -> pa.RecordBatch:
        found = (self.best > self.none) & (self.best >= self.least[:, None])
        n = found.sum(axis=1)
        cols = [np.repeat(self.rows, n), np.repeat(query_ids, n), self.best_id[found], self.best[found]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_row", "query_id", "vec_id", "score"])


def _parts(batch: pa.RecordBatch, blocks: int = 256):
    """Slices of a batch, so that one slice's matrix is in memory at a time."""
    return (batch.slice(a, blocks) for a in range(0, batch.num_rows, blocks))


def _width(lists) -> int:
    return int(np.diff(lists.offsets.to_numpy()).max(initial=0))


def with_least(queries: DataFrame, pilot: pa.Table, k: int) -> DataFrame:
    """``queries`` with ``least``: the k-th best score among the rows of some blocks, a bound from below."""

    def run(batches):
        blocks = pilot.combine_chunks().to_batches()
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                b = batch.slice(a, 1024)
                s = Search(b["row"].to_numpy(), matrix(b["v"], _width(b["v"])), np.full(b.num_rows, -(1 << 62)), k)
                for block in blocks:
                    for part in _parts(block):
                        s.add(part)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s.best[:, -1])], names=[*b.schema.names, "least"])

    return queries.mapInArrow(run, "row long, vec_id long, v array<long>, c int, least long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 64, group_rows: int = 16384, chunk_values: int = 1 << 20, pilot_blocks: int = 32, wave: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of each query row with all rows but itself;
    both are (row, vec_id, v) rows, ``queries`` being some of ``vectors``."""
    spark = vectors.sparkSession
    n, (n_queries, width) = vectors.count(), queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    groups, chunks = max(1, -(-n // group_rows)), max(1, -(-n_queries * max(1, width) // chunk_values))
    blocks = cut_lineage(index(vectors, groups, block_rows))
    pilot = blocks.where((F.col("g") == 0) & (F.col("b") < pilot_blocks)).toArrow()  # ``pilot_blocks`` rows
    chunk = F.pmod(F.xxhash64(F.lit(5), "row"), F.lit(chunks)).cast("int").alias("c")
    asked = cut_lineage(with_least(queries.select("row", "vec_id", "v", chunk), pilot, k))

    def searched(c: int) -> DataFrame:
        got = asked.where(F.col("c") == c).toArrow().combine_chunks()  # about ``chunk_values`` components
        lists = got["v"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int64()))
        shared = spark.sparkContext.broadcast((got["row"].to_numpy(), got["vec_id"].to_numpy(), matrix(lists, _width(lists)), got["least"].to_numpy()))

        def run(batches):
            rows, ids, q, least = shared.value
            s = Search(rows, q, least, k)
            for batch in batches:
                for part in _parts(batch):
                    s.add(part)
            yield s.table(ids)

        return blocks.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")

    paths = []
    for a in range(0, chunks, wave):
        some = [searched(c) for c in range(a, min(chunks, a + wave))]
        paths.append(write_scratch(reduce(DataFrame.unionByName, some)))
    found = spark.read.schema("query_row long, query_id long, vec_id long, score long").parquet(*paths)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
