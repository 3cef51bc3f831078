"""Step 3 queries: profiles of lineitem (nulls made in the query), histograms, fences, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import profile as prof
from tally.plans.registry import query

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]


def _lineitem_with_nulls(t):
    """lineitem with missing values made in the query: discount 0, tax 0 and flag 'N' become null."""
    li = t.lineitem
    return li.select(
        "l_orderkey",
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        "l_linestatus",
        "l_shipdate",
    )


_LI_NULLS_SQL = """
li as (
  select l_orderkey, l_quantity, l_extendedprice, nullif(l_discount, 0.0) as l_discount, nullif(l_tax, 0.0) as l_tax,
         nullif(l_returnflag, 'N') as l_returnflag, l_linestatus, l_shipdate
  from lineitem
)"""

_PROFILE_COLS = ["l_orderkey", *NUMERIC, *CATEGORICAL, "l_shipdate"]


def _nulls_sql():
    parts = [
        f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null, "
        f"count(distinct {c}) as n_distinct, (count(*) - count({c})) * 100.0::double / nullif(count(*), 0) as pct_null from li"
        for c in _PROFILE_COLS
    ]
    return f"with {_LI_NULLS_SQL} " + " union all ".join(parts)


@query("profile_nulls", _nulls_sql())
def profile_nulls(t):
    """A17 + A18 + P16: nulls, percent null and distinct values per column in one pass."""
    return prof.profile_nulls(_lineitem_with_nulls(t), _PROFILE_COLS)


def _numeric_sql():
    parts = [
        f"select '{c}' as column_name, count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, "
        f"min({c}) as min, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, "
        f"quantile_cont({c}, 0.75) as q75, max({c}) as max from li"
        for c in NUMERIC
    ]
    return f"with {_LI_NULLS_SQL} " + " union all ".join(parts)


@query("profile_numeric", _numeric_sql())
def profile_numeric(t):
    """A15 + A26: describe() of the numeric columns with exact quartiles."""
    return prof.profile_numeric(_lineitem_with_nulls(t), NUMERIC)


def _categorical_sql():
    parts = [f"select '{c}' as column_name, {c} as value from li where {c} is not null" for c in CATEGORICAL]
    return f"""
with {_LI_NULLS_SQL}, long as ({" union all ".join(parts)}),
freq as (select column_name, value, count(*) as n from long group by all),
ranked as (select *, row_number() over (partition by column_name order by n desc, value) as rn from freq)
select column_name, cast(sum(n) as bigint) as count, count(*) as unique,
       max(case when rn = 1 then value end) as top, max(n) as freq
from ranked group by column_name
"""


@query("profile_categorical", _categorical_sql())
def profile_categorical(t):
    """Count / unique / top / freq of the text columns."""
    return prof.profile_categorical(_lineitem_with_nulls(t), CATEGORICAL).withColumn(
        "count", F.col("count").cast("bigint")
    )


@query(
    "crosstab_counts",
    """
with c as (select l_returnflag, l_linestatus, count(*) as n from lineitem group by all),
grid as (select a.l_returnflag, b.l_linestatus from (select distinct l_returnflag from lineitem) a,
                                                     (select distinct l_linestatus from lineitem) b)
select g.l_returnflag, g.l_linestatus, coalesce(c.n, 0) as n
from grid g left join c using (l_returnflag, l_linestatus)
""",
)
def crosstab_counts(t):
    """Return flag x line status counts, completed with zeros."""
    return prof.crosstab_counts(t.lineitem, "l_returnflag", "l_linestatus", complete=True)


@query(
    "histogram_by_class",
    """
with mm as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
b as (
  select l_returnflag, cast(coalesce(least(floor((l_extendedprice - lo) / nullif(hi - lo, 0) * 10) + 1, 10), 1) as integer) as bin, lo, hi
  from lineitem, mm
)
select l_returnflag, bin, count(*) as n, lo + (bin - 1) * ((hi - lo) / 10) as bin_lo, lo + bin * ((hi - lo) / 10) as bin_hi
from b group by l_returnflag, bin, lo, hi
""",
)
def histogram_by_class(t):
    """10-bin histogram of extended price per return flag."""
    return prof.histogram_by_class(t.lineitem, "l_extendedprice", "l_returnflag", bins=10)


def _fences_sql():
    parts = [f"select '{c}' as column_name, {c} as value from li" for c in NUMERIC]
    return f"""
with {_LI_NULLS_SQL}, long as ({" union all ".join(parts)}),
q as (select column_name, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from long group by 1),
f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from q)
select f.*, (select count(*) from long l where l.column_name = f.column_name and l.value < f.lower) as n_below,
            (select count(*) from long l where l.column_name = f.column_name and l.value > f.upper) as n_above
from f
"""


@query("outlier_fences", _fences_sql())
def outlier_fences(t):
    """1.5 IQR fences per numeric column and counts outside them."""
    return prof.outlier_fences(_lineitem_with_nulls(t), NUMERIC)


def _corr_sql():
    parts = []
    for i, a in enumerate(NUMERIC):
        for j, b in enumerate(NUMERIC):
            v = "max(1.0::double)" if a == b else f"round(corr({a}, {b}), 6)"
            parts.append(f"select '{a}' as col_a, '{b}' as col_b, {v} as corr from li")
    return f"with {_LI_NULLS_SQL} " + " union all ".join(parts)


@query("corr_matrix", _corr_sql())
def corr_matrix(t):
    """Correlation matrix of the numeric columns (pairwise null handling)."""
    return prof.corr_matrix(_lineitem_with_nulls(t), NUMERIC)
