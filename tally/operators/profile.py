"""Table profiling.

Wide tables are profiled in long form: ``stack`` turns the chosen columns into
``(column_name, value)`` rows inside the scan's stage, so per-column statistics become an
ordinary grouped aggregation with map-side partial aggregation. Results are small (one row per
column or per column value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.quantile import quantiles_wide
from tally.session import cut_lineage


def stack_columns(df: DataFrame, columns: Sequence[str], cast: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(*keep, column_name, value)`` of the given columns."""
    parts = ", ".join(f"'{c}', cast(`{c}` as {cast})" for c in columns)
    keep_sql = ", ".join(f"`{k}`" for k in keep)
    expr = f"stack({len(columns)}, {parts}) as (column_name, value)"
    return df.selectExpr(*([keep_sql] if keep else []), expr)


def _distinct_text(df: DataFrame, column: str) -> Column | None:
    """A string that is equal exactly for equal values of an atomic column; None for nested types."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0).cast(kind)).cast("string")  # -0.0 equals 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    return None if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else c.cast("string")


def profile_nulls(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """A17 + A18 + P16: rows, nulls, percent null and distinct count per column.

    Plain counts are one aggregate row. Exact distinct counts group the long form by (column, value), with
    partial aggregation before the shuffle, then count per column; columns of nested types use ``count_distinct``.
    ``exact_distinct=False`` uses HyperLogLog++ (``approx_count_distinct``) in the same pass as the counts.
    """
    cols = list(columns or df.columns)
    texts = {c: _distinct_text(df, c) for c in cols} if exact_distinct else {}
    dc = F.count_distinct if exact_distinct else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"_nn{i}"))
        if texts.get(c) is None:
            aggs.append(dc(F.col(f"`{c}`")).alias(f"_nd{i}"))
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"_nn{i}")).alias("n_null"),
            (F.col(f"_nd{i}").cast("bigint") if texts.get(c) is None else F.lit(None).cast("bigint")).alias("n_distinct"),
        )
        for i, c in enumerate(cols)
    ]
    out = df.agg(*aggs).select(F.inline(F.array(*structs)))
    long = [F.struct(F.lit(c).alias("column_name"), x.alias("value")) for c, x in texts.items() if x is not None]
    if long:
        values = df.select(F.inline(F.array(*long))).filter(F.col("value").isNotNull()).distinct()
        counted = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("_nd"))
        atomic = F.col("column_name").isin([c for c, x in texts.items() if x is not None])
        out = out.join(counted, "column_name", "left").withColumn(
            "n_distinct", F.when(atomic, F.coalesce("_nd", F.lit(0).cast("bigint"))).otherwise(F.col("n_distinct"))
        ).drop("_nd")
    return out.withColumn("pct_null", F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")))


def profile_numeric(df: DataFrame, columns: Sequence[str], decimals: int = 6) -> DataFrame:
    """A15 (``describe``): count, mean, sample std, min, quartiles (exact, linear), max per column.

    Mean and std are rounded to ``decimals`` so the result does not hinge on summation order.
    """
    long = stack_columns(df, columns)
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), decimals).alias("mean"),
        F.round(F.stddev_samp("value"), decimals).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = quantiles_wide(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by="column_name", broadcast_brackets=True)
    return basic.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def profile_dates(df: DataFrame, column: str) -> DataFrame:
    """A15 for a date column: count, first, last."""
    return df.agg(
        F.count(column).alias("count"), F.min(column).alias("first"), F.max(column).alias("last")
    ).withColumn("column_name", F.lit(column))


def profile_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, unique, top (most frequent, ties to the smallest value) and its frequency."""
    long = stack_columns(df, columns, cast="string").filter(F.col("value").isNotNull())
    freq = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return freq.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table, most frequent first (value breaks ties)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(column))


def crosstab_counts(df: DataFrame, a: str, b: str, complete: bool = False) -> DataFrame:
    """Counts per (a, b). ``complete`` adds zero rows for unseen pairs of seen values.

    Meant for declared small categories when ``complete``: the counts are materialised (one pass over the data), and the
    distinct values of ``b`` in them are exploded next to each distinct ``a``. Nulls count as a value of their own.
    """
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if not complete:
        return counts
    counts = cut_lineage(counts)
    b_values = counts.agg(F.array_sort(F.collect_set(F.struct(F.col(b).alias("v"))))).scalar()
    grid = counts.select(F.col(a).alias("_a")).distinct().select("_a", F.explode(b_values).alias("_s")).select("_a", F.col("_s.v").alias("_b"))
    same = grid["_a"].eqNullSafe(counts[a]) & grid["_b"].eqNullSafe(counts[b])
    return grid.join(counts, same, "left").select(
        F.col("_a").alias(a), F.col("_b").alias(b), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def histogram_by_class(df: DataFrame, value: str, cls: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over the global [min, max], counted per class.

    Bin ``i`` (1..bins) covers ``[lo + (i-1) w, lo + i w)``; the maximum falls in the last bin
    (as ``numpy.histogram``). Bounds travel as a scalar subquery.
    """
    mm = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("s")).scalar()
    lo, hi = mm["lo"], mm["hi"]
    width = (hi - lo) / F.lit(bins)
    x = F.col(value).cast("double")
    # a constant column (hi = lo) puts every value in bin 1
    b = F.coalesce(F.least(F.floor(F.try_divide(x - lo, hi - lo) * F.lit(bins)) + 1, F.lit(bins)), F.lit(1)).cast("int")
    binned = df.filter(F.col(value).isNotNull()).select(cls, b.alias("bin"))
    return (
        binned.groupBy(cls, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"bin_lo": lo + (F.col("bin") - 1) * width, "bin_hi": lo + F.col("bin") * width})
    )


def outlier_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Box-plot fences Q1 - k IQR and Q3 + k IQR per column, and how many values fall outside.

    The per-column fences (one row per column: bounded) are broadcast back onto the long rows.
    """
    long = stack_columns(df, columns)
    q = quantiles_wide(long, "value", {"q1": 0.25, "q3": 0.75}, by="column_name", broadcast_brackets=True)
    f = q.withColumns(
        {
            "iqr": F.col("q3") - F.col("q1"),
            "lower": F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1")),
            "upper": F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1")),
        }
    )
    counted = (
        long.join(F.broadcast(f.select("column_name", "lower", "upper")), "column_name")
        .groupBy("column_name")
        .agg(
            F.count(F.when(F.col("value") < F.col("lower"), 1)).alias("n_below"),
            F.count(F.when(F.col("value") > F.col("upper"), 1)).alias("n_above"),
        )
    )
    return f.join(counted, "column_name", "left")


def corr_matrix(df: DataFrame, columns: Sequence[str], decimals: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair, one aggregation pass, long form."""
    cols = list(columns)
    aggs = []
    pairs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}_{j}"))
            pairs.append((i, j))
    one = df.agg(*aggs)
    structs = []
    for i, j in pairs:
        v = F.lit(1.0) if i == j else F.round(F.col(f"_c{i}_{j}"), decimals)
        structs.append(F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), v.alias("corr")))
        if i != j:
            structs.append(F.struct(F.lit(cols[j]).alias("col_a"), F.lit(cols[i]).alias("col_b"), v.alias("corr")))
    return one.select(F.inline(F.array(*structs)))
