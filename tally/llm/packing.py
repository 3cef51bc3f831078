"""Best-fit packing by linear grouping.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces of each length matters for a
plan, a table of at most ``capacity`` rows whatever the data's size:

1. Lengths above a part of ``capacity`` (a half, and a quarter: the better plan of both is taken) are large. Sorted,
   they are cut into ``groups`` groups of equal cardinality, and each group's lengths are rounded up to its largest.
2. The configurations of the few rounded sizes are optimised: the linear programme over how often each
   configuration is used, its columns generated by a knapsack over the shadow prices; whole parts are kept.
3. Actual pieces take the places of their group in order of length. Sequences with the same lengths in the same
   places stay together as one run, so a plan has some thousand runs, not a row per sequence.
4. What is left over (the large pieces of the fractions, then all small ones, longest first) goes where the
   remaining room is least, else into new sequences.

Pieces of exactly ``capacity`` tokens are sequences of their own. Every other piece gets its rank among the pieces
of its length, from counts per hash bucket and a running number inside a bucket, so a length that a third of all
pieces share is spread over buckets; the plan turns a rank into sequence and offset.

Null texts count as empty and hold the end id only; rows repeat as given and are separate documents; an empty table
gives an empty result; other columns are ignored.

With ``within``, a column of few values (languages), documents of different values never share a sequence; null is a
value of its own. Each value has a plan of its own, made on the driver from its number of pieces of each length.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tally.llm.common import as_texts, fresh, with_row_id
from tally.llm.tokens import encode
from tally.session import cut_lineage


def pieces(df: DataFrame, row: str, tokenizer: str, capacity: int, end_id: int, within: str | None = None) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32, within): the whole text's ids and the end id, cut from the end in
    pieces of ``capacity``, so only the first may be shorter."""
    names = ["row", "doc_id", "piece", "start", "length", "ids_crc32", "within"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for row_id, doc, of, text in zip(b["row"].to_pylist(), b["doc_id"].to_pylist(), b["within"].to_pylist(), as_texts(b["text"]), strict=True):
                ids = np.array([*encode(tokenizer, text), end_id], dtype="<u4")
                start, end = 0, len(ids) % capacity or min(len(ids), capacity)
                for piece in range(-(-len(ids) // capacity)):
                    out.append((row_id, doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()), of))
                    start, end = end, end + capacity
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    of = (F.lit(None) if within is None else F.col(within)).cast("string").alias("within")
    src = df.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), of)
    return src.mapInArrow(run, "row long, doc_id long, piece int, start long, length long, ids_crc32 long, within string")


@dataclass
class Plan:
    """Pieces of ``length`` with ranks from ``rank`` on, ``n`` of them, one each in the sequences from ``sequence``
    on, at ``offset``."""

    sequences: int = 0
    parts: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, rank, n, sequence, offset


class _Rooms:
    """Runs of sequences by the room that is left in them."""

    def __init__(self, capacity: int):
        self.of: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []  # sorted
        self.capacity = capacity

    def add(self, room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            if room not in self.of:
                bisect.insort(self.sizes, room)
            self.of.setdefault(room, []).append((first, n))

    def take(self, length: int, n: int) -> tuple[int, int, int] | None:
        """Up to ``n`` sequences with the least room of ``length`` or more: room, first, how many."""
        at = bisect.bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        room = self.sizes[at]
        runs = self.of[room]
        first, have = runs.pop()
        if have > n:
            runs.append((first + n, have - n))
        if not runs:
            del self.of[room]
            self.sizes.pop(at)
        return room, first, min(have, n)


def _knapsack(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of highest total price: value and how often each size."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.array(sizes)
    for c in range(1, capacity + 1):
        fit = order <= c
        best[c], last[c] = best[c - 1], -1
        if fit.any():
            v = np.where(fit, best[np.maximum(c - order, 0)] + prices, -1.0)
            k = int(np.argmax(v))
            if v[k] > best[c] + 1e-12:
                best[c], last[c] = v[k], k
    used, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            used[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[capacity]), used


def configurations(sizes: list[int], need: list[int], capacity: int, most_steps: int = 600) -> list[tuple[np.ndarray, float]]:
    """How often to use which configuration so that every size is covered: column generation with a basis of as many
    configurations as sizes. ``most_steps`` bounds the work; stopping early leaves a valid, less tight answer."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    want = np.array(need, dtype=np.float64)
    for _ in range(most_steps):
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, column = _knapsack(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        x, d = np.linalg.solve(basis, want), np.linalg.solve(basis, column)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    x = np.linalg.solve(basis, want)
    return [(basis[:, j].round().astype(int), float(x[j])) for j in range(k)]


def plan_packing(counts: dict[int, int], capacity: int = 1024, groups: int = 64, small_parts: tuple = (2, 4)) -> Plan:
    """The plan of fewest sequences for ``counts`` pieces of each length below ``capacity``, of those that call lengths
    above capacity / part large, for each of ``small_parts``."""
    return min((_plan(counts, capacity, groups, k) for k in small_parts), key=lambda p: p.sequences)


def _plan(counts: dict[int, int], capacity: int, groups: int, small_part: int) -> Plan:
    plan, rooms = Plan(), _Rooms(capacity)
    given: dict[int, int] = dict.fromkeys(counts, 0)  # ranks of each length that have a place
    large = [(n, counts[n]) for n in sorted(counts, reverse=True) if n > capacity // small_part and counts[n] > 0]
    total = sum(c for _, c in large)
    per = -(-total // groups) if total else 1
    members: list[list[list[int]]] = []  # of each group, longest first: [length, left]
    filled = per
    if len(large) <= groups:  # as many groups as lengths: nothing is rounded up
        members, large = [[[n, c]] for n, c in large], []
    for n, c in large:
        while c:
            if filled == per:
                members.append([])
                filled = 0
            take = min(c, per - filled)
            members[-1].append([n, take])
            filled, c = filled + take, c - take
    sizes, need = [g[0][0] for g in members], [sum(c for _, c in g) for g in members]
    merged: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        merged.setdefault(s, []).append(i)  # groups that round up to the same size are one
    sizes = list(merged)
    members = [[m for i in merged[s] for m in members[i]] for s in sizes]
    need = [sum(c for _, c in g) for g in members]

    def put(length: int, n: int, first: int, offset: int) -> None:
        plan.parts.append((length, given[length], n, first, offset))
        given[length] += n

    if sizes:
        for config, times in sorted(configurations(sizes, need, capacity), key=lambda c: -c[1]):
            slots = [j for j in range(len(sizes)) for _ in range(config[j])]
            left = int(times + 1e-9)
            left = min([left, *(sum(c for _, c in members[j]) // config[j] for j in set(slots))])
            while left > 0 and slots:
                # the longest run in which every place keeps its actual length
                heads = [members[j][0] for j in slots]
                asked: dict[int, int] = {}
                for j in slots:
                    asked[j] = asked.get(j, 0) + 1
                if all(members[j][0][1] >= asked[j] for j in asked):
                    run = min([left, *(members[j][0][1] // asked[j] for j in asked)])
                    lengths = [h[0] for h in heads]
                    for j in asked:
                        members[j][0][1] -= run * asked[j]
                else:
                    run, lengths = 1, []
                    for j in slots:  # a place or two go over to the next length of their group
                        lengths.append(members[j][0][0])
                        members[j][0][1] -= 1
                        while members[j] and not members[j][0][1]:
                            members[j].pop(0)
                for j in asked:
                    while members[j] and not members[j][0][1]:
                        members[j].pop(0)
                offset = 0
                for n in lengths:
                    put(n, run, plan.sequences, offset)
                    offset += n
                rooms.add(capacity - offset, plan.sequences, run)
                plan.sequences += run
                left -= run
    for n in sorted(counts, reverse=True):
        left = counts[n] - given[n]
        while left:
            got = rooms.take(n, left)
            if got is None:
                fresh_run = -(-left // max(1, capacity // n))
                rooms.add(capacity, plan.sequences, fresh_run)
                plan.sequences += fresh_run
                continue
            room, first, m = got
            put(n, m, first, capacity - room)
            rooms.add(room - n, first, m)
            left -= m
    return plan


def pack(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, row: str | None = None, within: str | None = None) -> DataFrame:
    """One row per piece of (doc_id, text) rows: row, doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the
    column ``within``, if one is named, whose values share no sequence. Sequences of full pieces have negative numbers."""
    if row is None:
        row = fresh(df, "row")
        df = with_row_id(df, row)
    cut = cut_lineage(pieces(df, row, tokenizer, capacity, end_id, within))
    short = cut.where(F.col("length") < capacity)
    counts: dict[str | None, dict[int, int]] = {}
    for r in short.groupBy("within", "length").count().collect():  # at most capacity rows for each value
        counts.setdefault(r["within"], {})[r["length"]] = r["count"]
    values = sorted(counts, key=lambda v: (v is not None, v or ""))
    plans = [plan_packing(counts[v], capacity) for v in values]
    buckets = 1 << max(6, (sum(sum(c.values()) for c in counts.values()) // 1_000_000).bit_length())
    named = [v for v in values if v is not None]
    part = F.lit(0) if not named else F.array_position(F.array(*[F.lit(v) for v in named]), F.col("within")) - F.lit(0 if None in counts else 1)
    where = short.withColumn("part", F.coalesce(part, F.lit(0)).cast("int"))
    where = where.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)).cast("int"))
    per = where.groupBy("part", "length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("part", "length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    inside = F.row_number().over(Window.partitionBy("part", "length", "bucket").orderBy("row", "piece"))
    ranked = where.withColumn("inside", inside).join(per.select("part", "length", "bucket", before.alias("before")), ["part", "length", "bucket"])
    place = _placer(plans, capacity)
    at = place(F.col("part"), F.col("length"), F.col("before") + F.col("inside") - 1)
    cols = ["row", "doc_id", "piece", "start", "length", "ids_crc32", *([] if within is None else ["within"])]
    packed = ranked.select(*cols, at.alias("p")).select(*cols, "p.sequence_id", "p.offset")
    full = cut.where(F.col("length") == capacity).select(*cols, (-(F.monotonically_increasing_id() + 1)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full).withColumnsRenamed({} if within is None else {"within": within})


def _placer(plans: list[Plan], capacity: int):
    """Column function from (number of the plan, length, rank) to (sequence_id, offset), by search among the plans' parts."""
    parts, first = [], 0
    for i, plan in enumerate(plans):
        parts += [(i * capacity + n, r, first + s, o) for n, r, _, s, o in plan.parts]
        first += plan.sequences
    parts = np.array(sorted(parts), dtype=np.int64).reshape(-1, 4)
    span = np.int64(1) << np.int64(40)
    keys = parts[:, 0] * span + parts[:, 1]

    @pandas_udf("struct<sequence_id: long, offset: long>")
    def place(part, length, rank):
        import pandas as pd

        n, r = part.to_numpy(np.int64) * capacity + length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(keys, n * span + r, side="right") - 1
        if not len(keys):
            return pd.DataFrame({"sequence_id": np.zeros(len(n), np.int64), "offset": np.zeros(len(n), np.int64)})
        return pd.DataFrame({"sequence_id": parts[at, 2] + r - parts[at, 1], "offset": parts[at, 3]})

    return place
