"""Substring dedup by content-defined chunking.

A gear hash runs over the bytes of a text: at each byte it is shifted by two bits and the byte's entry of a
random table is added, so its 32 bits depend on the last 16 bytes alone. A chunk ends where the hash falls
below a threshold and the byte before a character's start is reached, unless another such place lies within
the ``least`` bytes before; a chunk that gets longer than ``most`` bytes is cut every ``most`` bytes. All of that
looks at nearby bytes only, so text inserted elsewhere does not move the ends. Equal chunks are found by a
128-bit digest; a run of adjoining chunks that also stand in other documents is one repeated span.

The chunks at either end of a repeated passage hold text of their own and so differ. Each end of a run is therefore
compared, byte by byte, with the text around the same chunk in another holder (the one whose occurrences stay, or for
that one the last holder), up to ``reach`` bytes, and the span is extended by the whole words that are equal. Spans of
``min_words`` words or more are reported. Of equal chunks those in one row stay: the row with the least doc_id, of
repeated rows with that id the one with the least row number; the extension goes or stays with the chunk next to it.

The table of chunks is written once and read twice: for one aggregation by half the digest (least and largest row, with
partial results in each task, so a passage that very many documents share is one row per task there) and for a join
with the halves that two rows or more hold, whose skewed keys Spark splits. Only such chunks are looked at further, by
their whole digests, and the table is removed once they are written. The texts
are read a second time for the ends of runs; rows are numbered so that both scans agree. Spans are put together per
document.

Null and empty texts have no chunk; texts of any length are read whole; repeated rows are separate documents; a null
doc_id is the largest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tally.llm.common import as_texts, flat_list, fresh, numbered_rows
from tally.session import cut_lineage, drop_scratch, write_scratch

REACH = 16  # bytes that the rolling hash depends on
SLICE = 1 << 20


@lru_cache(maxsize=1)
def gear() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum over j < REACH of gear[raw[i - j]] << 2j, by doubling the reach four times."""
    h = gear()[raw]
    for reach in (1, 2, 4, 8):
        before = h[:-reach] << np.uint32(2 * reach)
        h = h.copy()
        h[reach:] += before
    return h


def chunk_ends(raw: bytes, mean: int = 32, least: int = 12, most: int = 256) -> np.ndarray:
    """Ends of the chunks of a whole text, the last one its length."""
    if not raw:
        return np.zeros(0, np.int64)
    b = np.frombuffer(raw, np.uint8)
    limit, found = np.uint32((1 << 32) // mean), []
    for a in range(0, len(b), SLICE):
        from_ = max(0, a - REACH + 1)
        found.append(np.flatnonzero(rolling_hash(b[from_ : a + SLICE])[a - from_ :] < limit) + a + 1)
    ends = np.concatenate(found)
    ends = ends[ends < len(b)]
    ends = ends[(b[ends] & 0xC0) != 0x80]
    ends = ends[np.diff(ends, prepend=-least) >= least]
    edges = np.concatenate(([0], ends, [len(b)]))
    wide = np.flatnonzero(np.diff(edges) > most)
    if len(wide):
        more = np.concatenate([np.arange(edges[i] + most, edges[i + 1], most) for i in wide])
        for _ in range(3):  # on to the start of a character
            more = more + ((more < len(b)) & ((b[np.minimum(more, len(b) - 1)] & 0xC0) == 0x80))
        edges = np.unique(np.concatenate((edges, more)))
    return edges[1:]


def _word_starts(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    return ~space & np.concatenate(([True], space[:-1]))


def chunks(df: DataFrame, row: str, mean: int, least: int, most: int) -> DataFrame:
    """(row, doc_id, ends, words, d1, d2): one row per document, arrays by chunk."""

    def run(batches):
        for b in batches:
            n, ends_of, words_of, digests = [], [], [], []
            for text in as_texts(b["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                ends = chunk_ends(raw, mean, least, most)
                n.append(len(ends))
                if not len(ends):
                    continue
                starts = np.concatenate(([0], ends[:-1]))
                ends_of.append(ends)
                words_of.append(np.add.reduceat(_word_starts(raw).astype(np.int32), starts))
                digests += [hashlib.blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    b["row"],
                    b["doc_id"],
                    flat_list(np.concatenate(ends_of or none).astype(np.int32), n, pa.int32()),
                    flat_list(np.concatenate(words_of or none).astype(np.int32), n, pa.int32()),
                    flat_list(np.ascontiguousarray(both[:, 0]), n, pa.int64()),
                    flat_list(np.ascontiguousarray(both[:, 1]), n, pa.int64()),
                ],
                names=["row", "doc_id", "ends", "words", "d1", "d2"],
            )

    src = df.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "row long, doc_id long, ends array<int>, words array<int>, d1 array<long>, d2 array<long>")


_LAST, _LENGTH, _START = 20, 10, 21  # bits of a place: start, last of its text, length, words


def _placed(table: DataFrame) -> DataFrame:
    """(row, doc_id, d1, d2, at): one row per chunk, with its place in one number."""
    k, c = F.col("k"), F.col("c")
    each = table.select("row", "doc_id", F.posexplode(F.arrays_zip("ends", "words", "d1", "d2")).alias("k", "c"), "ends")
    start = F.when(k > 0, F.get("ends", k - 1)).otherwise(0).cast("long")
    last = (k == F.size("ends") - 1).cast("long")
    at = F.shiftleft(start, _START) + F.shiftleft(last, _LAST) + F.shiftleft(c["ends"] - start, _LENGTH) + c["words"]
    return each.select("row", "doc_id", c["d1"].alias("d1"), c["d2"].alias("d2"), at.alias("at"))


def _field(at, shift: int, bits: int):
    return F.shiftright(at, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def repeated_chunks(df: DataFrame, row: str, mean: int = 32, least: int = 12, most: int = 256) -> DataFrame:
    """Every chunk that stands in two documents or more: row, doc_id, start, length, words, last (of its text), copies,
    first_doc_id and first (whether its row is the one whose occurrences stay), and where another holder has it: p_row,
    p_start and p_last."""
    if most > 1000:
        raise ValueError("chunks have at most 1000 bytes")
    kept = chunks(df, row, mean, least, most)
    path = write_scratch(kept)
    table = df.sparkSession.read.schema(kept.schema).parquet(path)
    # the first half of the digest tells which chunks to look at; what is equal is decided by the whole digest below
    by_half = table.select("row", F.explode("d1").alias("d1")).groupBy("d1")
    known = by_half.agg(F.min("row").alias("r0"), F.max("row").alias("r1")).where("r0 < r1").select("d1")
    hits = cut_lineage(_placed(table).join(known, "d1"))
    drop_scratch(df.sparkSession, path)
    # the complement turns the order round, so that null, the least in a struct, comes last
    turned = F.struct(F.bitwise_not("doc_id").alias("doc_id"), F.bitwise_not("row").alias("row"), F.bitwise_not("at").alias("at"))
    holders = hits.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"), F.max(turned).alias("keep"), F.min(turned).alias("other"))
    holders = holders.where(F.col("keep.row") != F.col("other.row"))
    j = hits.join(holders, ["d1", "d2"])
    first = F.col("row") == F.bitwise_not("keep.row")
    partner = F.when(first, F.col("other")).otherwise(F.col("keep"))
    at, p_at = F.col("at"), F.bitwise_not(partner["at"])
    return j.select(
        "row", "doc_id", F.shiftright(at, _START).alias("start"), _field(at, _LENGTH, 10).alias("length"), _field(at, 0, 10).alias("words"), (_field(at, _LAST, 1) == 1).alias("last"),
        "copies", F.bitwise_not("keep.doc_id").alias("first_doc_id"), first.alias("first"),
        F.bitwise_not(partner["row"]).alias("p_row"), F.shiftright(p_at, _START).alias("p_start"), (_field(p_at, _LAST, 1) == 1).alias("p_last"),
    )


def _runs(hit: DataFrame) -> DataFrame:
    """Runs of adjoining repeated chunks, with the places around which another holder's text goes on at either end."""
    by = Window.partitionBy("row").orderBy("start")
    breaks = (F.col("start") != F.lag(F.col("start") + F.col("length")).over(by)).cast("int")
    runs = hit.withColumn("new", F.coalesce(breaks, F.lit(1))).withColumn("run", F.sum("new").over(by))
    end = F.col("start") + F.col("length")
    gone = F.sort_array(F.collect_list(F.when(~F.col("first"), F.struct(F.col("start").alias("start"), end.alias("end")))))
    edge = F.struct("p_row", F.col("p_start").alias("at"), F.col("first").alias("stays"), F.col("p_last").alias("ends"))
    return runs.groupBy("row", "doc_id", "run").agg(
        F.min("start").alias("a"), F.max(end).alias("b"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("n_chunks"), F.max("copies").alias("copies"),
        F.min("first_doc_id").alias("first_doc_id"), gone.alias("removed"), F.max("last").alias("last"), F.min_by(edge, F.col("start")).alias("left"),
        F.max_by(F.struct("p_row", (F.col("p_start") + F.col("length")).alias("at"), F.col("first").alias("stays"), F.col("p_last").alias("ends")), F.col("start")).alias("right"),
    )


def _contexts(docs: DataFrame, wanted: DataFrame, reach: int) -> DataFrame:
    """(need, at, side, bytes, edge): the text before (side 0) or after (side 1) a place, at most ``reach`` bytes, with the
    byte before them on side 1, and whether the text begins or ends there."""
    per = wanted.select("need", "at", "side").distinct().groupBy("need").agg(F.collect_list(F.struct("at", "side")).alias("of"))

    def run(batches):
        names = ["need", "at", "side", "bytes", "edge"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
        for b in batches:
            out = []
            for need, text, of in zip(b["need"].to_pylist(), as_texts(b["text"]), b["of"].to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for w in of:
                    at = w["at"]
                    if w["side"]:
                        out.append((need, at, 1, raw[at - 1 : at + reach], at + reach >= len(raw)))
                    else:
                        out.append((need, at, 0, raw[max(0, at - reach) : at], at <= reach))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    j = docs.join(per, docs["row"] == per["need"]).select("need", "text", "of")
    return j.mapInArrow(run, "need long, at long, side int, bytes binary, edge boolean")


def common_words(own: bytes, other: bytes, side: int, own_edge: bool, other_edge: bool) -> tuple[int, int]:
    """How many bytes next to a run are equal in both, cut back to words that are whole in both, and how many words begin
    there. After a run (side 1) the first byte is the last one of the run; the edges tell that a text goes no further."""
    last, own, other = (own[:1], own[1:], other[1:]) if side else (b"", own, other)
    n = min(len(own), len(other))
    if side:
        x, y = np.frombuffer(own, np.uint8)[:n], np.frombuffer(other, np.uint8)[:n]
    else:
        x, y = np.frombuffer(own, np.uint8)[len(own) - n :][::-1], np.frombuffer(other, np.uint8)[len(other) - n :][::-1]
    off = np.flatnonzero(x != y)
    n = int(off[0]) if len(off) else n
    if not n:
        return 0, 0

    def space(b: np.ndarray) -> np.ndarray:
        return (b == 32) | ((b >= 9) & (b <= 13))

    if side:
        blank = space(x[:n])
        # white space, or nothing, must follow in both; inside the equal part both have the same
        beyond = all(space(np.frombuffer(t[n : n + 1], np.uint8))[0] if n < len(t) else edge for t, edge in ((own, own_edge), (other, other_edge)))
        ends = np.flatnonzero(~blank & np.append(blank[1:], beyond))
        n = int(ends[-1]) + 1 if len(ends) else 0
        return n, int((~blank & np.append([last.isspace()], blank[:-1]))[:n].sum())
    blank = space(x[:n])[::-1]
    before = all(t[-n - 1 : -n].isspace() if n < len(t) else edge for t, edge in ((own, own_edge), (other, other_edge)))
    begins = np.flatnonzero(~blank & np.append([before], blank[:-1]))
    return (n - int(begins[0]), len(begins)) if len(begins) else (0, 0)


@pandas_udf(T.StructType([T.StructField("n", T.IntegerType()), T.StructField("words", T.IntegerType())]))
def _extension(own, other, side, own_edge, other_edge):
    import pandas as pd

    return pd.DataFrame([common_words(*x) for x in zip(own, other, side, own_edge, other_edge, strict=True)], columns=["n", "words"])


def repeated_spans(df: DataFrame, row: str | None = None, min_words: int = 10, reach: int = 256, **chunking) -> DataFrame:
    """Repeated spans of ``min_words`` words or more: row, doc_id, span_start, span_bytes, span_words, n_chunks, copies
    (most of any chunk), first_doc_id (least), removed (the parts that go: start and end in bytes of the UTF-8 text).

    ``row`` names a column that numbers the rows, the same in every scan; without one they are numbered here."""
    if row is None:
        row = fresh(df, "row")
        df = numbered_rows(df, row)
    runs = cut_lineage(_runs(repeated_chunks(df, row, **chunking)))

    def ask(need, at, side: int, mine: bool):
        return F.struct(need.alias("need"), at.alias("at"), F.lit(side).alias("side"), F.lit(mine).alias("mine"))

    left, right = F.col("left"), F.col("right")
    open_left = (F.col("a") > 0) & (left["at"] > 0)
    open_right = ~F.col("last") & ~right["ends"]
    none = F.array().cast("array<struct<need: bigint, at: bigint, side: int, mine: boolean>>")
    asked = F.concat(
        F.when(open_left, F.array(ask(F.col("row"), F.col("a"), 0, True), ask(left["p_row"], left["at"], 0, False))).otherwise(none),
        F.when(open_right, F.array(ask(F.col("row"), F.col("b"), 1, True), ask(right["p_row"], right["at"], 1, False))).otherwise(none),
    )
    wanted = runs.select("row", "run", F.explode(asked).alias("w")).select("row", "run", "w.*")
    docs = df.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text"))
    seen = wanted.join(_contexts(docs, wanted, reach), ["need", "at", "side"])
    pairs = seen.groupBy("row", "run", "side").agg(*[F.max(F.when(m, F.struct("bytes", "edge"))).alias(n) for m, n in ((F.col("mine"), "own"), (~F.col("mine"), "other"))])
    grown = pairs.select("row", "run", "side", _extension("own.bytes", "other.bytes", "side", "own.edge", "other.edge").alias("x"))
    both = grown.groupBy("row", "run").agg(*[F.max(F.when(F.col("side") == s, F.col("x"))).alias(n) for s, n in ((0, "xl"), (1, "xr"))])
    more = lambda c, f: F.coalesce(F.col(c)[f], F.lit(0)).cast("long")
    wide = runs.join(both, ["row", "run"], "left").withColumns({"b2": F.col("b") + more("xr", "n"), "wr": more("xr", "words")})
    # a run that its neighbour on the left has reached is not extended into it
    before = F.lag("b2").over(Window.partitionBy("row").orderBy("a"))
    free = F.coalesce(before <= F.col("a") - more("xl", "n"), F.lit(True))
    wide = wide.withColumns({"a2": F.when(free, F.col("a") - more("xl", "n")).otherwise(F.col("a")), "wl": F.when(free, more("xl", "words")).otherwise(0)})
    ends = F.concat(
        F.when((F.col("a2") < F.col("a")) & ~F.col("left.stays"), F.array(F.struct(F.col("a2").alias("start"), F.col("a").alias("end")))).otherwise(F.slice("removed", 1, 0)),
        "removed",
        F.when((F.col("b2") > F.col("b")) & ~F.col("right.stays"), F.array(F.struct(F.col("b").alias("start"), F.col("b2").alias("end")))).otherwise(F.slice("removed", 1, 0)),
    )
    spans = wide.select(
        "row", "doc_id", F.col("a2").alias("span_start"), (F.col("b2") - F.col("a2")).alias("span_bytes"), (F.col("words") + F.col("wl") + F.col("wr")).alias("span_words"),
        "n_chunks", "copies", "first_doc_id", ends.alias("removed"),
    )
    return spans.where(F.col("span_words") >= min_words)


@pandas_udf(T.StringType())
def _without(text, parts):
    out = []
    for t, ranges in zip(text, parts, strict=True):
        if t is None or ranges is None or not len(ranges):
            out.append(t)
            continue
        raw, kept, at = t.encode("utf-8", "surrogatepass"), [], 0
        for a, b in sorted((r["start"], r["end"]) for r in ranges):
            kept.append(raw[at : max(a, at)])
            at = max(at, b)
        out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass"))
    import pandas as pd

    return pd.Series(out, dtype=object)


def remove_repeats(df: DataFrame, min_words: int = 10, **chunking) -> DataFrame:
    """``df`` with the repeated parts of spans cut out of ``text``; every row and column stays."""
    row = fresh(df, "row")
    numbered = numbered_rows(df, row)
    gone = fresh(df, "removed")
    spans = repeated_spans(numbered, row, min_words, **chunking).groupBy("row").agg(F.flatten(F.collect_list("removed")).alias(gone))
    joined = numbered.join(spans.withColumnRenamed("row", row) if row != "row" else spans, row, "left")
    return joined.withColumn("text", _without("text", gone)).select(*df.columns)
