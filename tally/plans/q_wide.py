"""Queries on many columns (A23), stored profiles (A26) and the elbow from a coreset (M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import correlation, coreset, ml, profile_store as store
from tally.plans.q_ml import _RFM_SQL, RFM, _rfm_scaled, _SCALED
from tally.plans.q_profile import _LI_NULLS_SQL, _lineitem_with_nulls
from tally.plans.registry import query
from tally.session import cut_lineage

PRIMES = (7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83, 89, 97, 101, 103, 107, 109, 113, 127, 131, 137, 139, 149, 151, 157, 163)
WIDE = [f"v{i}" for i in range(len(PRIMES))]


def wide_lines(t):
    """35 numeric columns from a line's keys and figures; each has nulls in places of its own."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    def col(i: int, p: int):
        v = (F.floor(F.col("l_quantity")) * (i + 1) + F.floor(F.col("l_extendedprice")) + k) % p
        return F.when(k % p != 3, v.cast("double")).alias(WIDE[i])

    return t.lineitem.select(*[col(i, p) for i, p in enumerate(PRIMES)])


def _wide_sql() -> str:
    cols = ", ".join(
        f"case when (l_orderkey * 7 + l_linenumber) % {p} <> 3 then cast((cast(floor(l_quantity) as bigint) * {i + 1} + cast(floor(l_extendedprice) as bigint) + l_orderkey * 7 + l_linenumber) % {p} as double) end as {WIDE[i]}"
        for i, p in enumerate(PRIMES)
    )
    cells = ", ".join(
        f"{{'a': '{a}', 'b': '{b}', 'c': " + ("1.0::double" if a == b else f"round(corr({a}, {b}), 6)") + f", 'n': regr_count({a}, {b})}}" for a in WIDE for b in WIDE
    )
    return f"with w as (select {cols} from lineitem), m as (select unnest([{cells}]) as x from w) select x.a as col_a, x.b as col_b, x.c as corr, cast(x.n as bigint) as n from m"


@query("corr_wide", _wide_sql())
def corr_wide(t):
    """Correlations of 35 columns, each pair over the rows in which both are known, with their number."""
    return correlation.correlations(wide_lines(t), WIDE, block=16)


_PROFILE_SQL = f"""with {_LI_NULLS_SQL},
long as (
  select 'l_extendedprice' as column_name, cast(l_extendedprice as double) as num, cast(null as varchar) as txt from li
  union all select 'l_discount', cast(l_discount as double), null from li
  union all select 'l_returnflag', null, l_returnflag from li),
p as (select count(distinct date_trunc('month', l_shipdate)) as n_parts from li)
select column_name, (select n_parts from p) as n_parts, count(*) as n_rows, count(*) - count(num) - count(txt) as n_null, round(avg(num), 6) as mean, round(stddev_samp(num), 6) as std,
       min(num) as least_number, max(num) as largest_number, min(txt) as least_text, max(txt) as largest_text, true as distinct_near, true as quantiles_near
from long group by column_name"""

PROFILED = ["l_extendedprice", "l_discount", "l_returnflag"]


@query("profile_report", _PROFILE_SQL)
def profile_report(t):
    """A profile stored by month of shipping, continued twice (a month stored before is replaced), then merged. The
    exact parts equal a full scan; distinct values are within 5 % and quantiles within 2 % of the wanted rank."""
    li = _lineitem_with_nulls(t).select(*PROFILED, F.trunc("l_shipdate", "MM").alias("month"))
    early = F.year("month") < 1997
    stored = cut_lineage(store.profile_parts(li.where(early), "month", PROFILED))
    for more in (li.where(~early), li.where(F.year("month") == 1996)):
        stored = cut_lineage(store.replace_parts(stored, store.profile_parts(more, "month", PROFILED)))
    found = cut_lineage(store.profile_report(stored))
    text = F.col("column_name") == "l_returnflag"
    # what is claimed of the sketches, measured on the rows
    rows = store._as_rows(li, "month", PROFILED)
    near = rows.join(found.select("column_name", *[f"approx_{q}" for q in store.QUANTILES]), "column_name")
    value = F.coalesce(F.col("num").cast("string"), F.col("txt"))
    def rank(op, q: str):
        return F.avg(F.when(F.col("num").isNotNull(), op(F.col("num"), F.col(f"approx_{q}")).cast("double")))

    measured = near.groupBy("column_name").agg(
        F.count_distinct(value).alias("n_distinct"),
        *[rank(lambda a, b: a < b, q).alias(f"below_{q}") for q in store.QUANTILES],
        *[rank(lambda a, b: a <= b, q).alias(f"upto_{q}") for q in store.QUANTILES],
    )
    good = F.lit(True)
    for q, p in store.QUANTILES.items():
        good = good & (F.col(f"below_{q}") <= p + 0.02) & (F.col(f"upto_{q}") >= p - 0.02)
    j = found.join(measured, "column_name")
    return j.select(
        "column_name", "n_parts", "n_rows", "n_null", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
        F.when(~text, F.col("least").try_cast("double")).alias("least_number"), F.when(~text, F.col("largest").try_cast("double")).alias("largest_number"),
        F.when(text, F.col("least")).alias("least_text"), F.when(text, F.col("largest")).alias("largest_text"),
        (F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct") + 0.5).alias("distinct_near"), (text | good).alias("quantiles_near"),
    )


@query("elbow_coreset", None)
def elbow_coreset(t):
    """M5: cost of k = 1 to 14 clusters of the customers by scaled RFM, all fitted on one coreset."""
    return coreset.elbow(_rfm_scaled(t), _SCALED, range(1, 15))


@query(
    "elbow_coreset_facts",
    f"""with {_RFM_SQL}, z as (select """
    + ", ".join(f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}" for c in RFM)
    + " from rfm) select cast(14 as bigint) as n_k, round("
    + " + ".join(f"var_pop({c}) * count(*)" for c in RFM)
    + ", 4) as total_squares, cast(0 as bigint) as rises, true as within_five_percent from z",
)
def elbow_coreset_facts(t):
    """M5: with all customers in the coreset one cluster costs the total sum of squares, more clusters never cost more, and
    four cost at most 5 % more than a fit of Spark's own estimator on all rows."""
    scaled = cut_lineage(_rfm_scaled(t))
    e = cut_lineage(coreset.elbow(scaled, _SCALED, range(1, 15)))
    before = e.select((F.col("k") + 1).alias("k"), F.col("wcss").alias("before"))
    own = ml.kmeans_elbow(scaled, _SCALED, ks=[4]).select(F.col("wcss").alias("own"))
    j = e.join(before, "k", "left").withColumn("own", own.scalar())
    return j.agg(
        F.count(F.lit(1)).alias("n_k"),
        F.round(F.max(F.when(F.col("k") == 1, F.col("wcss"))), 4).alias("total_squares"),
        F.count(F.when(F.col("wcss") > F.col("before") * (1 + 1e-9), 1)).alias("rises"),
        F.max(F.when(F.col("k") == 4, F.col("wcss") <= F.col("own") * 1.05)).alias("within_five_percent"),
    )
