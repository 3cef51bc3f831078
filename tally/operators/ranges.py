"""Joining points to the intervals that hold them, without comparing all pairs.

Points and interval ends are whole numbers (days of a date, microseconds of a timestamp, integers). The axis is cut into
buckets of a width taken from the data, and buckets are joined two by two to buckets of the next level, up to a
level of which at least ``top_buckets`` cover all points. An interval is written as the few buckets of all levels
that it is made of (two of a level at most, but at the highest), so a long or open-ended one is a handful of rows and
not one a day; a point has one bucket in each level that occurs. The two meet in exactly one bucket, where an
equality join brings them together; an exact check of the ends follows, as the lowest buckets at either end may reach
over. No pair is met twice, so nothing has to be made distinct.

With ``on``, most keys have few points, and cutting their intervals would write many rows to save few comparisons. So where
a key has at most ``FEW`` points or at most ``FEW`` intervals, they meet by the key alone, and only the remaining keys
go by buckets. So a key's comparisons are at most ``FEW`` times its rows.

Intervals hold both ends; a null end is open; an interval whose lower end is above its upper end holds nothing; null
points match nothing. Rows repeat as given. ``on`` names columns that must be equal as well (null equals nothing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.session import cut_lineage


#: points (or intervals) of a key that are all compared
FEW = 200


def axis(df: DataFrame, col: str) -> Column:
    """A date, timestamp or whole number as a long."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("long")
    raise TypeError(f"{col} is {kind.simpleString()}: a date, a timestamp or a whole number is needed")


def _levels(shortest: int, lengths: list[float], span: int, top_buckets: int) -> tuple[int, int]:
    """Bits of the lowest buckets (about an eighth of a middling interval) and of the highest (``top_buckets`` of them
    over all points)."""
    middle = max(1.0, lengths[0] if lengths else 1.0)
    high = max(0, (max(1, span) // top_buckets).bit_length() - 1)
    return min(high, max(0, int(middle / 8).bit_length() - 1, shortest)), high


def cover(lo: Column, hi: Column, low_bits: int, high_bits: int) -> Column:
    """The buckets that [lo, hi] is made of, as array<struct<level, bucket>>; the lowest ones may reach over its ends."""
    first, end = F.shiftright(lo, low_bits), F.shiftright(hi, low_bits) + 1  # [first, end) in lowest buckets
    parts = []
    for k in range(high_bits - low_bits + 1):
        up = (1 << k) - 1
        l_k, r_k = F.shiftright(first + up, k), F.shiftright(end, k)  # whole buckets of this level
        level = F.lit(low_bits + k)

        def one(at: Column, level=level) -> Column:
            return F.array(F.struct(level.alias("level"), at.alias("bucket")))

        none = F.array().cast("array<struct<level:int,bucket:bigint>>")
        if low_bits + k == high_bits:
            each = F.transform(F.sequence(l_k, r_k - 1), lambda b: F.struct(F.lit(high_bits).alias("level"), b.alias("bucket")))
            parts.append(F.when(l_k < r_k, each).otherwise(none))
        else:
            left = F.when((l_k < r_k) & (F.pmod(l_k, F.lit(2)) == 1), one(l_k)).otherwise(none)
            # an odd bucket at the left end that is also the last one is not written twice
            right = F.when((l_k < r_k) & (F.pmod(r_k, F.lit(2)) == 1) & ~((l_k == r_k - 1) & (F.pmod(l_k, F.lit(2)) == 1)), one(r_k - 1)).otherwise(none)
            parts += [left, right]
    return F.concat(*parts)


def range_join(points: DataFrame, intervals: DataFrame, point: str, lo: str, hi: str, on: Sequence[str] = (), top_buckets: int | None = None) -> DataFrame:
    """Every (point row, interval row) with ``lo <= point <= hi`` and equal ``on`` columns: the points' columns, then the
    intervals' (without ``on``). Other columns must not have the same names.

    ``top_buckets``: how many of the widest buckets cover all points; more of them spread the points under a long interval
    over more tasks, but an interval over everything is written that often. Left out, one for about 200,000 points,
    4 to 256."""
    clash = ({c.lower() for c in points.columns} & {c.lower() for c in intervals.columns}) - {c.lower() for c in on}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    p = points.withColumn("_p", axis(points, point)).where(F.col("_p").isNotNull())
    if not on:
        return _bucket_join(points, p, intervals, lo, hi, on, top_buckets)
    i = intervals.withColumn("_lo", axis(intervals, lo)).withColumn("_hi", axis(intervals, hi))
    many = p.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select(*on)
    if many.isEmpty():
        return _key_join(points, p, intervals, i, on)
    many = cut_lineage(i.join(many, [*on], "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select(*on))
    light = _key_join(points, p.join(many, [*on], "left_anti"), intervals, i, on)
    return light.unionByName(_bucket_join(points, p.join(many, [*on], "left_semi"), intervals.join(many, [*on], "left_semi"), lo, hi, on, top_buckets))


def _key_join(points: DataFrame, p: DataFrame, intervals: DataFrame, i: DataFrame, on: Sequence[str]) -> DataFrame:
    """Points and intervals of equal keys, then the ends."""
    holds = (F.col("_lo").isNull() | (F.col("_p") >= F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_p") <= F.col("_hi")))
    return p.join(i, [*on]).where(holds).select(*points.columns, *[c for c in intervals.columns if c not in on])


def _bucket_join(points: DataFrame, p: DataFrame, intervals: DataFrame, lo: str, hi: str, on: Sequence[str], top_buckets: int | None) -> DataFrame:
    """Points and intervals that meet in a bucket, then the ends."""
    ends = p.agg(F.min("_p").alias("a"), F.max("_p").alias("b"), F.count(F.lit(1)).alias("n")).first()
    top_buckets = top_buckets or max(4, min(256, ends["n"] // 200_000))
    out = [*points.columns, *[c for c in intervals.columns if c not in on]]
    a, b = (ends["a"], ends["b"]) if ends["a"] is not None else (0, 0)
    # beyond the points an interval holds nothing, so open ends stop at the outermost points
    clipped = intervals.withColumn("_lo", F.greatest(F.coalesce(axis(intervals, lo), F.lit(a)), F.lit(a)))
    clipped = clipped.withColumn("_hi", F.least(F.coalesce(axis(intervals, hi), F.lit(b)), F.lit(b))).where("_lo <= _hi")
    size = clipped.agg(F.percentile_approx(F.col("_hi") - F.col("_lo") + 1, [0.5], 1000).alias("m")).first()["m"]
    low, high = _levels(0, [float(x) for x in size or []], b - a + 1, top_buckets)
    covered = clipped.withColumn("_c", F.explode(cover(F.col("_lo"), F.col("_hi"), low, high)))
    covered = covered.withColumns({"_level": F.col("_c.level"), "_bucket": F.col("_c.bucket")}).drop("_c")
    # points are written once for each level that some interval uses; there are a few dozen levels at most
    used = sorted(r[0] for r in covered.select("_level").distinct().collect())
    if not used:
        used = [high]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_p", k).alias("bucket")) for k in used]))
    placed = p.withColumn("_c", each).withColumns({"_level": F.col("_c.level"), "_bucket": F.col("_c.bucket")}).drop("_c")
    joined = placed.join(covered, [*on, "_level", "_bucket"])
    return joined.where((F.col("_p") >= F.col("_lo")) & (F.col("_p") <= F.col("_hi"))).select(*out)
