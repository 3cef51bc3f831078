"""Seasonality status per group and calendar month.

The reference crosses each group with a daily calendar and counts 13 distinct month labels with
``count(DISTINCT CASE ...)`` (13 Expand copies of groups x days). A calendar month is "seen" by a
group exactly when some day of it lies in ``[max(intro, global_min + 1), as_of]``, i.e. when
``least(month_end, as_of) >= greatest(month_start, intro, global_min + 1)``. The ~25 months of the
window are one small array (a scalar subquery); each group row evaluates them with array
functions, so after the two aggregations there is no join and no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.session import cut_lineage

# Fixed values that must equal the reference: month names in calendar order and the days used
# to prorate the first month (February is always 28, Q10).
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
MONTH_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
STATUS_OUT, STATUS_IN, STATUS_NORMAL = "Out of Season", "In Season", "Normal"


def _equals(i: int):
    return lambda x: x == F.lit(i)


def seasonality_status(
    sales: DataFrame,
    keys: Sequence[str],
    date_col: str,
    amount_col: str,
    as_of: Column,
    days_back: int = 730,
    threshold: float = 0.5,
    keep_measures: bool = False,
) -> DataFrame:
    """Per group the 12 month statuses In Season / Normal / Out of Season / null.

    Sales of ``[as_of - days_back, as_of]`` are summed per calendar month; the first month is
    prorated as in the reference (``+ (day(intro) - 1) * sales / days_of_month * months_seen``);
    a month's average over the months seen, divided by the overall monthly average, is compared
    with ``1 - threshold`` and ``1 + threshold``. Months never seen give null (Q11).
    """
    keys = list(keys)
    d = F.to_date(F.col(date_col))
    s = sales.filter(d.between(F.date_sub(as_of, days_back), as_of))
    per_month = s.groupBy(*keys, F.month(d).alias("m")).agg(
        F.sum(F.col(amount_col).cast("decimal(38,2)")).alias("_sum"),
        F.min(d).alias("_first"),
    )
    grp = per_month.groupBy(*keys).agg(
        F.sum("_sum").cast("double").alias("total_sales"),
        F.min("_first").alias("introduction_date"),
        F.map_from_entries(F.collect_list(F.struct("m", F.col("_sum").cast("double")))).alias("_by_month"),
    )
    # one row per group: written once, so the sales are read once for the groups and their first day
    grp = cut_lineage(grp)
    gmin = grp.agg(F.min("introduction_date")).scalar()
    # the scalar subquery is bound to plain columns first: lambdas cannot hold subqueries
    grp = grp.withColumn("_first_day", F.date_add(gmin, 1)).withColumn("_as_of", as_of)
    grp = grp.withColumn(
        "_months", F.sequence(F.trunc("_first_day", "MM"), F.trunc("_as_of", "MM"), F.expr("interval 1 month"))
    )
    intro = F.col("introduction_date")
    seen_months = F.filter(
        "_months",
        lambda ms: F.least(F.last_day(ms), F.col("_as_of")) >= F.greatest(ms, intro, F.col("_first_day")),
    )
    out = grp.withColumn("_seen", F.transform(seen_months, lambda ms: F.month(ms))).withColumn(
        "months_seen", F.size("_seen")
    )
    cols: dict[str, Column] = {}
    monthly_avg = F.when(F.col("months_seen") == 0, F.lit(0.0)).otherwise(F.col("total_sales") / F.col("months_seen"))
    for i, name in enumerate(MONTHS, start=1):
        sales_m = F.coalesce(F.col("_by_month")[i], F.lit(0.0))
        seen_m = F.size(F.filter("_seen", _equals(i)))
        adjusted = F.when(
            F.month(intro) == i,
            sales_m + (F.dayofmonth(intro) - 1) * sales_m / F.lit(MONTH_DAYS[i - 1]) * seen_m,
        ).otherwise(sales_m)
        average = F.when(seen_m == 0, F.lit(0.0)).otherwise(adjusted / seen_m)
        ratio = F.when(monthly_avg == 0, F.lit(0.0)).otherwise(average / monthly_avg)
        status = (
            F.when(seen_m == 0, F.lit(None).cast("string"))
            .when(ratio < 1 - threshold, STATUS_OUT)
            .when(ratio > 1 + threshold, STATUS_IN)
            .otherwise(STATUS_NORMAL)
        )
        cols[f"{name}_seasonality_status"] = status
        if keep_measures:
            cols[f"{name}_seen"] = seen_m
            cols[f"{name}_seasonality_ratio"] = ratio
    out = out.withColumns(cols)
    extra = ["total_sales", "introduction_date", "months_seen"] if keep_measures else []
    return out.select(*keys, *extra, *cols.keys())


#: up to so many values a column's codes are looked up in a map, beyond it they are joined
MAP_VALUES = 64


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_cat", materialize: bool = True) -> DataFrame:
    """Code of each value in the sorted distinct values of its column (0-based); null gets
    the code after the last value (as ``StringIndexer(alphabetAsc, keep)`` would).

    The vocabulary (distinct values of the encoded columns) is ranked in a long ``(column, value)``
    table, which is written once. Columns of few values get their codes from a map of their own (one
    scalar subquery for all of them, no join); each other column joins its codes, broadcast or
    shuffled by the written table's size. The input is materialised first so the vocabulary job
    and the coding pass read it once.
    """
    cols = list(columns)
    if materialize:
        df = cut_lineage(df)
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {parts}) as (_col, _val)").filter(F.col("_val").isNotNull()).distinct()
    w = Window.partitionBy("_col").orderBy("_val")
    codes = cut_lineage(long.withColumn("_code", (F.row_number().over(w) - 1).cast("int")))
    sizes = {r["_col"]: r["n"] for r in codes.groupBy("_col").agg(F.count(F.lit(1)).cast("int").alias("n")).collect()}  # one row per column
    few = [c for c in cols if 0 < sizes.get(c, 0) <= MAP_VALUES]
    maps = None
    if few:
        own = codes.filter(F.col("_col").isin(few)).groupBy("_col").agg(F.map_from_entries(F.collect_list(F.struct("_val", "_code"))).alias("_m"))
        maps = own.agg(F.struct(*[F.max_by(F.col("_m"), F.col("_col") == c).alias(f"m{i}") for i, c in enumerate(few)])).scalar()
    out, coded = df, {}
    for c in cols:
        if c in few:
            code = F.element_at(maps[f"m{few.index(c)}"], F.col(c).cast("string"))
        elif sizes.get(c):
            joined = codes.filter(F.col("_col") == c).select(F.col("_val").alias(f"_v_{c}"), F.col("_code").alias(f"_k_{c}"))
            out = out.join(joined, F.col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
            code = F.col(f"_k_{c}")
        else:
            code = F.lit(None).cast("int")
        coded[f"{c}{suffix}"] = F.coalesce(code, F.lit(sizes.get(c, 0)))
    return out.withColumns(coded).drop(*(f"_k_{c}" for c in cols))
