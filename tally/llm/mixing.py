"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources get targets by weight, none above ``most_repeats`` times its size; what is cut off is shared again by
weight. The whole mix is a number of equal blocks of ``block_words`` words, given to the sources one by one to
the highest quotient target / (2 * seats + 1); a source's blocks are given to its shards (documents by hash)
in the same way by the shards' sizes. Each shard lays its documents out in a seeded random order; its quota is
that many blocks from the start, going round again once all is taken. So a document is taken at most as often
as its source repeats, rounded up, at most one document per shard is taken in part, and a rerun agrees.

A row's place and shard come from a hash of its doc_id, its text and its number among equal rows, so the mix is the
same however the input is split and on any number of cores: rows that are equal in doc_id, source and text are
numbered (by counts per hash bucket and a running number inside a bucket, so one row repeated very often is no task of
its own), and which of them gets which number does not matter.

Shards bound the work of a task and are computed in Spark; the driver gets one total per shard, at most
``max_shards`` and one more per source, and one row per source (names of collections, not of hosts or pages). Sources
sort by code point, null last. Null and empty texts and texts without a word have size 0, are never taken and are in no
shard; a text of any length is counted whole, and its words are in one shard; repeated rows are separate documents; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.common import WORD, fresh, with_row_id
from tally.session import cut_lineage

WEIGHTS = (3, 1, 2)


def targets(sizes: list[int], weights: list[float], total: float, most_repeats: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, each at most ``most_repeats`` times its size."""
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > most_repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = float(most_repeats * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 * seats + 1), none above ``most``; ties to the earlier. Starts from
    the seats that any apportionment of this kind gives and adds or takes back the few that are left."""
    everyone = sum(votes)
    if everyone <= 0 or seats <= 0:
        return [0] * len(votes)
    unit = everyone / seats
    got = [max(0, min(m, int(v / unit + 0.5))) for v, m in zip(votes, most, strict=True)]
    up = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, got, most, strict=True)) if g < m and v > 0]
    down = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g > 0]
    heapq.heapify(up)
    heapq.heapify(down)
    n = sum(got)
    while n < seats and up:
        _, i = heapq.heappop(up)
        got[i] += 1
        n += 1
        if got[i] < most[i]:
            heapq.heappush(up, (-votes[i] / (2 * got[i] + 1), i))
    while n > seats:
        _, j = heapq.heappop(down)
        got[-j] -= 1
        n -= 1
        if got[-j] > 0:
            heapq.heappush(down, (votes[-j] / (2 * got[-j] - 1), j))
    return got


def _with_copy(sized: DataFrame) -> DataFrame:
    """``copy``: the number of a row among the rows of equal doc_id, source and text, from 0."""
    key = ["doc_id", "source", "digest", "size"]
    named = [F.col(c).alias(f"k_{c}") for c in key]

    def same():
        return [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in key]

    repeated = cut_lineage(sized.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    most = repeated.agg(F.max("n")).first()[0] or 0
    if not most:
        return sized.withColumn("copy", F.lit(0).cast("long"))
    once = sized.join(repeated.select(*named), same(), "left_anti").withColumn("copy", F.lit(0).cast("long"))
    buckets = 1 << max(6, (most // 100_000).bit_length())
    again = sized.join(repeated.select(*named), same(), "left_semi").withColumn("b", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    per = again.groupBy(*key, "b").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per.select(*named, F.col("b").alias("k_b"), before.alias("before"))
    inside = F.row_number().over(Window.partitionBy(*key, "b").orderBy("row")) - 1
    numbered = again.withColumn("inside", inside).join(offsets, [*same(), F.col("b") == F.col("k_b")])
    return once.unionByName(numbered.select(*sized.columns, (F.col("before") + F.col("inside")).alias("copy")))


def mix(df: DataFrame, row: str | None = None, share: float = 1.5, weights: tuple = WEIGHTS, most_repeats: int = 2, block_words: int = 64, shard_words: int = 1 << 18, max_shards: int = 20_000, seed: int = 7) -> DataFrame:
    """One row per row of (doc_id, source, text): row, doc_id, source, size, source_size, target, taken."""
    spark = df.sparkSession
    if row is None:
        row = fresh(df, "row")
        df = with_row_id(df, row)
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    src = df.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), F.xxhash64(text).alias("digest"))
    sized = cut_lineage(src)
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [r["n"] for r in totals]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), most_repeats)
    per_shard = max(shard_words, sum(sizes) / max_shards)
    of_source = [(i, r["source"], r["n"], aims[i], max(1, int(r["n"] / per_shard))) for i, r in enumerate(totals)]
    # one row per source; as many as sources, so it is joined, not broadcast
    plan = spark.createDataFrame(of_source, "s int, of string, source_size long, target double, shards int")
    planned = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    out = ["row", "doc_id", "source", "size", "source_size", "target"]
    wordless = planned.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken"))
    counted = _with_copy(sized.where("size > 0")).join(plan, F.col("source").eqNullSafe(F.col("of")))
    identity = ["doc_id", "digest", "copy"]
    place = F.xxhash64(F.lit(seed), *identity)
    dealt = counted.select(*out, "digest", "copy", "s", place.alias("place"), F.pmod(F.xxhash64(F.lit(seed + 1), *identity), F.col("shards")).cast("int").alias("shard"))
    shards = dealt.groupBy("s", "shard").agg(F.sum("size").alias("n")).orderBy("s", "shard").collect()
    most = [most_repeats * -(-n // block_words) for n in sizes]
    blocks = sainte_lague(aims, round(sum(aims) / block_words), most)
    quotas = []
    for i in range(len(sizes)):
        own = _of(shards, i)
        seats = sainte_lague([float(r["n"]) for r in own], blocks[i], [most_repeats * -(-r["n"] // block_words) for r in own])
        quotas += [(i, r["shard"], r["n"], min(q * block_words, most_repeats * r["n"])) for r, q in zip(own, seats, strict=True)]
    quota = spark.createDataFrame(quotas, "s int, shard int, shard_size long, words long")
    before = F.sum("size").over(Window.partitionBy("s", "shard").orderBy("place", *identity).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    laid = dealt.withColumn("before", before).join(quota, ["s", "shard"])
    rounds = F.floor(F.col("words") / F.col("shard_size")).cast("long")
    rest = F.col("words") - F.col("rounds") * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    taken = laid.withColumn("rounds", rounds).select(*out, (F.col("rounds") * F.col("size") + part).alias("taken"))
    return taken.unionByName(wordless)


def _of(shards: list, s: int) -> list:
    import bisect

    a = bisect.bisect_left(shards, s, key=lambda r: r["s"])
    return shards[a : bisect.bisect_right(shards, s, key=lambda r: r["s"])]
