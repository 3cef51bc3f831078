"""Windows over sorted series of any length: buckets with a halo (W3-W6, T1-T6 on long series).

``Window.partitionBy(series)`` orders a whole series in one task. Here all rows are sorted by (series, order) with a
range partitioning, numbered from zero without a gap, and cut into buckets of ``bucket_rows`` neighbouring rows. A
frame that looks at most ``before`` rows back and ``after`` rows ahead needs only a bucket's own rows and a halo of that
many rows on either side, so those are copied into the bucket, the window runs per (bucket, series), and the copies
are dropped. A task holds a bucket and its halo, whether one series holds all rows or a million series share them:
small series lie together in a bucket, a long one spreads over many.

The row numbers need no window: the sorted rows are written once with the number of their partition and their place in
it, and the partitions' row counts (one number per partition) turn these into one running number.

Rows with equal (series, order) keep their places together in no stated order, as in a plain window; a null series is a
series; null orders come first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tally.session import cut_lineage

G, BUCKET, OWN = "_g", "_bucket", "_own"
_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below
BUCKET_ROWS = 1 << 18


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = G) -> DataFrame:
    """``df`` with the running number of each row in the order of (keys, order), written once."""
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id())
    rows = cut_lineage(placed)
    part = F.shiftright(name, _PLACE_BITS).cast("int")
    counts = sorted((r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    before = [0, *accumulate(n for _, n in counts)]
    offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_p int, _before long")
    place = F.col(name).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # as many rows as partitions were written
    return rows.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(name, F.col("_before") + place).drop("_p", "_before")


def with_halo(rows: DataFrame, before: int, after: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Numbered rows with their bucket, each also copied into the buckets whose halo it is in; ``_own`` marks the
    row that is no copy."""
    if bucket_rows < 1:
        raise ValueError("bucket_rows is at least 1")
    g = F.col(G)
    first = F.greatest(F.lit(0).cast("long"), F.floor((g - after) / bucket_rows))
    last = F.floor((g + before) / bucket_rows)
    spread = rows.withColumn(BUCKET, F.explode(F.sequence(first, last)))
    return spread.withColumn(OWN, F.col(BUCKET) == F.floor(g / bucket_rows))


def frames(df: DataFrame, series: str, ts: str, before: int, after: int, bucket_rows: int | None) -> tuple[DataFrame, WindowSpec]:
    """Rows and the window specification to run lags and row frames over; pass the result to ``owned``.

    Without ``bucket_rows`` a series is one window partition (short series)."""
    if bucket_rows is None:
        return df, Window.partitionBy(series).orderBy(ts)
    spread = with_halo(numbered(df, [series], [ts]), before, after, bucket_rows)
    return spread, Window.partitionBy(BUCKET, series).orderBy(G)


def owned(df: DataFrame) -> DataFrame:
    """The rows that are no copies; the number ``_g`` stays until it is dropped."""
    return df.where(OWN).drop(BUCKET, OWN) if OWN in df.columns else df


def position(df: DataFrame, series: str, ts: str, name: str = "_pos") -> DataFrame:
    """``name``: place of the row in its series from 1. Numbered rows need one minimum per series, others a window."""
    if G not in df.columns:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(series).orderBy(ts)))
    start = df.groupBy(F.col(series).alias("_of")).agg(F.min(G).alias("_first"))
    return df.join(start, F.col(series).eqNullSafe(F.col("_of"))).withColumn(name, F.col(G) - F.col("_first") + 1).drop("_of", "_first")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``cum_<value>`` of each value: sums inside a bucket, and the sums of the key's earlier buckets added."""
    rows = numbered(df, keys, order).withColumn(BUCKET, F.floor(F.col(G) / bucket_rows))
    inside = Window.partitionBy(BUCKET, *keys).orderBy(G).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy(BUCKET, *keys).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    # a key has one row per bucket here
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(BUCKET).alias("_cb"), *[F.col(k).alias(f"_ck_{k}") for k in keys], *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_c_{v}") for v in values])
    on: Column = F.col(BUCKET) == F.col("_cb")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_ck_{k}"))
    joined = rows.join(carried, on)
    return joined.select(*df.columns, *[(F.col(f"_c_{v}") + F.sum(v).over(inside)).alias(f"cum_{v}") for v in values])
