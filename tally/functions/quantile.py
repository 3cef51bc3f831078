"""Exact quantiles without gathering a group into one task.

``percentile(x, p)`` keeps every value of a group in one aggregation buffer, which does not
survive a billion-row group. Here the exact answer (linear interpolation at rank (n-1)p, as
pandas ``quantile`` and DuckDB ``quantile_cont``) is found in two distributed passes:

1. ``percentile_approx`` (a mergeable Greenwald-Khanna sketch, bounded memory) gives, per group,
   values just below and just above each wanted rank: the bracket ``[lo, hi]``.
2. Rows are reduced to ``(group, p, value) -> count`` for values inside the bracket (ties collapse),
   plus one count of rows below it. A running sum over those few distinct values finds the
   values at ranks ``floor(h)`` and ``floor(h)+1`` exactly.

The bracket holds about ``6 n / accuracy`` rows per group; for groups smaller than
``2 accuracy / 3`` the bracket is simply the whole group (then it is small anyway).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000


def _as_list(by) -> list[str]:
    if by is None:
        return []
    if isinstance(by, str):
        return [by]
    return list(by)


def quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: str | Sequence[str] | None = None,
    accuracy: int = DEFAULT_ACCURACY,
    exact: bool = True,
    broadcast_brackets: bool | None = None,
) -> DataFrame:
    """Quantiles of ``value`` per group, long form: ``*by, p_index, p, q``.

    Nulls are skipped; groups with no value give no row. ``exact=False`` returns the sketch
    answer only (one pass). ``broadcast_brackets`` broadcasts the per-group bracket table; the
    default keeps it a shuffle join keyed by the groups. Without grouping the one-row statistics
    become a scalar subquery.
    """
    keys = _as_list(by)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull())
    probs = [float(p) for p in probs]
    if not exact:
        stats = base.groupBy(*keys).agg(F.percentile_approx("_v", probs, accuracy).alias("_a"))
        return stats.select(
            *keys,
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("p_index"), F.lit(p).alias("p"), F.col("_a")[i].alias("q"))
                        for i, p in enumerate(probs)
                    ]
                )
            ),
        )

    delta = 3.0 / accuracy
    bracket_probs: list[float] = []
    for p in probs:
        bracket_probs += [max(0.0, p - delta), min(1.0, p + delta)]
    stats = base.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", bracket_probs, accuracy).alias("_a"),
    )
    if keys:
        src = stats
    else:
        # no grouping: the one-row stats travel as a scalar subquery, no join at all
        st = stats.select(F.struct("_n", "_min", "_max", "_a").alias("s")).scalar()
        src = base.select(
            "_v", st["_n"].alias("_n"), st["_min"].alias("_min"), st["_max"].alias("_max"), st["_a"].alias("_a")
        )
    small = F.col("_n") * F.lit(delta) < F.lit(2.0)
    structs = []
    for i, p in enumerate(probs):
        lo = F.when(small | F.lit(bracket_probs[2 * i] == 0.0), F.col("_min")).otherwise(F.col("_a")[2 * i])
        hi = F.when(small | F.lit(bracket_probs[2 * i + 1] == 1.0), F.col("_max")).otherwise(F.col("_a")[2 * i + 1])
        structs.append(
            F.struct(F.lit(i).alias("p_index"), F.lit(p).alias("p"), lo.alias("_lo"), hi.alias("_hi"))
        )
    h = (F.col("_n") - 1).cast("double") * F.col("p")
    pass_cols = keys if keys else ["_v"]
    brackets = (
        src.select(*pass_cols, "_n", F.inline(F.array(*structs)))
        .withColumn("_h", h)
        .withColumn("_r0", F.floor(F.col("_h")))
        .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_n") - 1))
    )
    if keys:
        # The sketch merge depends on shuffle-fetch order, so a recomputed stats stage could give
        # other bounds; the small bracket table is written once so every task sees the same one.
        from tally.session import cut_lineage

        brackets = cut_lineage(brackets)
        if broadcast_brackets:
            brackets_side = F.broadcast(brackets)
        else:
            brackets_side = brackets
        joined = base.join(brackets_side, on=keys, how="inner")
    else:
        joined = brackets
    # values below the bracket collapse into one (null) bucket; above it they are dropped
    cand = (
        joined.filter(F.col("_v") <= F.col("_hi"))
        .withColumn("_cv", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")))
        .groupBy(*keys, "p_index", "p", "_h", "_r0", "_r1", "_cv")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    w = Window.partitionBy(*keys, "p_index").orderBy(F.col("_cv").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cand = cand.withColumn("_cum", F.sum("_c").over(w))
    picked = cand.groupBy(*keys, "p_index", "p", "_h", "_r0", "_r1").agg(
        F.min(F.when(F.col("_cv").isNotNull() & (F.col("_cum") > F.col("_r0")), F.col("_cv"))).alias("_x0"),
        F.min(F.when(F.col("_cv").isNotNull() & (F.col("_cum") > F.col("_r1")), F.col("_cv"))).alias("_x1"),
        F.max(F.when(F.col("_cv").isNull(), F.col("_cum"))).alias("_below"),
        F.max("_cum").alias("_upto"),
    )
    outside = (F.coalesce(F.col("_below"), F.lit(0)) > F.col("_r0")) | (F.col("_upto") <= F.col("_r1"))
    q = F.col("_x0") + (F.col("_h") - F.col("_r0")) * (F.col("_x1") - F.col("_x0"))
    # never a silent neighbour: if the sketch's bound did not hold, say so
    checked = F.when(outside, F.raise_error(F.lit("a wanted rank lies outside its bracket: raise accuracy")).cast("double")).otherwise(q)
    return picked.select(*keys, "p_index", "p", checked.alias("q"))


def quantiles_wide(
    df: DataFrame,
    value: str | Column,
    named_probs: Mapping[str, float],
    by: str | Sequence[str] | None = None,
    **kw,
) -> DataFrame:
    """One row per group with one column per named probability."""
    keys = _as_list(by)
    names = list(named_probs)
    long = quantiles(df, value, [named_probs[n] for n in names], by=keys, **kw)
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("p_index") == i, F.col("q"))).alias(n) for i, n in enumerate(names)]
    )


def quantile_struct(
    df: DataFrame,
    columns: Sequence[str],
    named_probs: Mapping[str, float],
    **kw,
) -> Column:
    """Quantiles of several columns in one job, as one scalar-subquery struct:
    ``s[column][name]``. The columns are stacked into (column, value) rows and the few column
    groups are handled by the bracketed quantile with a broadcast bracket table."""
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {stack}) as (_col, _val)")
    wide = quantiles_wide(long, "_val", named_probs, by="_col", broadcast_brackets=True, **kw)
    fields = [
        F.max(F.when(F.col("_col") == c, F.struct(*[F.col(n) for n in named_probs]))).alias(c) for c in columns
    ]
    return wide.agg(*fields).select(F.struct(*columns).alias("s")).scalar()
