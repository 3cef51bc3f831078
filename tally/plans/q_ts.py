"""Step 6 queries: time-series statistics on monthly order revenue per priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import profile as prof, timeseries as tsx
from tally.plans.registry import query


def monthly_revenue(t):
    """Series = order priority, ts = month, value = revenue (exact decimal sum as double)."""
    return t.orders.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.trunc("o_orderdate", "MM").alias("ts")
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))


_SERIES_SQL = """
s as (
  select o_orderpriority as series_id, cast(date_trunc('month', o_orderdate) as date) as ts,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
  from orders group by all
)"""


@query(
    "ts_difference",
    f"""
with {_SERIES_SQL},
d as (
  select series_id, ts, value,
         value - lag(value, 1) over w as diff_1,
         value - lag(value, 12) over w as seasonal_diff,
         case when value > 0 then ln(value) end as log_value
  from s window w as (partition by series_id order by ts))
select series_id, ts, value, diff_1, seasonal_diff, round(log_value, 9) as log_value,
       diff_1 - lag(diff_1, 1) over w as diff_2,
       round(log_value - lag(log_value, 1) over w, 9) as log_diff
from d window w as (partition by series_id order by ts)
""",
)
def ts_difference(t):
    """W3 + X26: differences of order 1 and 2, seasonal (12) and log differences."""
    out = tsx.ts_difference(monthly_revenue(t), "series_id", "ts", "value", seasonal=12)
    return out.withColumns({"log_value": F.round("log_value", 9), "log_diff": F.round("log_diff", 9)})


@query(
    "ts_rolling",
    f"""
with {_SERIES_SQL},
r as (
  select series_id, ts, value,
         case when count(value) over w = 12 then avg(value) over w end as rolling_mean,
         case when count(value) over w = 12 then stddev_samp(value) over w end as rolling_std
  from s window w as (partition by series_id order by ts rows between 11 preceding and current row))
select series_id, ts, value, round(rolling_mean, 6) as rolling_mean, round(rolling_std, 6) as rolling_std,
       round(value - rolling_mean, 6) as detrended
from r where value - rolling_mean is not null
""",
)
def ts_rolling(t):
    """W4 + W5 + T7: 12-month rolling mean / std and the detrended series."""
    out = tsx.ts_rolling(monthly_revenue(t), "series_id", "ts", "value", window=12)
    return out.withColumns({c: F.round(c, 6) for c in ("rolling_mean", "rolling_std", "detrended")})


_DECOMPOSE_SQL = f"""
with {_SERIES_SQL},
b as (
  select series_id, ts, value, row_number() over w as pos,
         case when count(value) over (w rows between 6 preceding and 6 following) = 13
              then (sum(value) over (w rows between 6 preceding and 6 following)
                    - 0.5 * lag(value, 6) over w - 0.5 * lead(value, 6) over w) / 12 end as trend
  from s window w as (partition by series_id order by ts)),
p as (select series_id, (pos - 1) % 12 as phase, avg(value - trend) as pm from b group by all),
q as (select series_id, phase, pm - avg(pm) over (partition by series_id) as seasonal from p)
select b.series_id, b.ts, b.value, round(b.trend, 6) as trend, round(q.seasonal, 6) as seasonal,
       round(b.value - b.trend - q.seasonal, 6) as resid
from b join q on b.series_id = q.series_id and (b.pos - 1) % 12 = q.phase
"""


@query("ts_decompose", _DECOMPOSE_SQL)
def ts_decompose(t):
    """T1 + W6: additive decomposition with period 12."""
    out = tsx.ts_decompose(monthly_revenue(t), "series_id", "ts", "value", period=12)
    return out.withColumns({c: F.round(c, 6) for c in ("trend", "seasonal", "resid")})


@query(
    "ts_durbin_watson",
    f"""
with {_SERIES_SQL},
d as (select series_id, value, value - lag(value) over (partition by series_id order by ts) as d from s)
select series_id, round(sum(d * d) / nullif(sum(value * value), 0), 9) as durbin_watson from d group by series_id
""",
)
def ts_durbin_watson(t):
    """Durbin-Watson statistic of each series."""
    out = tsx.ts_durbin_watson(monthly_revenue(t), "series_id", "ts", "value")
    return out.withColumn("durbin_watson", F.round("durbin_watson", 9))


NLAGS = 24


def _acf_sql():
    leads = ",\n         ".join(f"lead(c, {k}) over w as l{k}" for k in range(1, NLAGS + 1))
    sums = ",\n         ".join(f"sum(c * l{k}) as s{k}" for k in range(1, NLAGS + 1))
    rows = " union all ".join(
        f"select series_id, {k} as lag, round({'s0' if k == 0 else f's{k}'} / nullif(s0, 0), 9) as acf from sums" for k in range(0, NLAGS + 1)
    )
    return f"""
with {_SERIES_SQL},
c as (select s.series_id, s.ts, s.value - m.m as c from s join (select series_id, avg(value) as m from s group by 1) m using (series_id)),
l as (select series_id, c,
         {leads}
      from c window w as (partition by series_id order by ts)),
sums as (select series_id, sum(c * c) as s0,
         {sums}
      from l group by series_id)
{rows}
"""


@query("ts_acf", _acf_sql())
def ts_acf(t):
    """T4: autocorrelation to lag 24."""
    out = tsx.ts_acf(monthly_revenue(t), "series_id", "ts", "value", nlags=NLAGS)
    return out.withColumns({"acf": F.round("acf", 9), "lag": F.col("lag").cast("int")})


def _pacf_sql():
    body = _acf_sql().strip()
    # the ACF rows (unrounded) as one list per series, then the Durbin-Levinson recursion
    unrounded = body.replace("round(", "(").replace(", 9) as acf", ") as acf")
    return f"""
with recursive acf_rows as ({unrounded}),
r as (select series_id, list(acf order by lag) as r from acf_rows group by series_id),
dl as (
  select series_id, r, 1 as k, [r[2]] as phi, r[2] as pkk from r
  union all
  select series_id, r, k + 1 as k,
         list_append(list_transform(phi, lambda x, j: x - nk.pkk * phi[k + 1 - j]), nk.pkk) as phi,
         nk.pkk
  from dl, lateral (
    select (r[k + 2] - list_sum(list_transform(phi, lambda x, j: x * r[k + 2 - j])))
           / (1 - list_sum(list_transform(phi, lambda x, j: x * r[j + 1]))) as pkk) nk
  where k < {NLAGS})
select series_id, 0 as lag, 1.0::double as pacf from r
union all
select series_id, k as lag, round(pkk, 9) as pacf from dl
"""


@query("ts_pacf", _pacf_sql())
def ts_pacf(t):
    """T5: partial autocorrelation to lag 24 (Durbin-Levinson on the aggregated ACF)."""
    out = tsx.ts_pacf(tsx.ts_acf(monthly_revenue(t), "series_id", "ts", "value", nlags=NLAGS), "series_id")
    return out.withColumn("pacf", F.round("pacf", 9))


@query("ts_adf", None)
def ts_adf(t):
    """Augmented Dickey-Fuller test per series (AIC lag choice)."""
    return tsx.ts_adf(monthly_revenue(t), "series_id", "ts", "value")


@query(
    "ts_adf_lag0",
    f"""with {_SERIES_SQL},
d as (select series_id, value - lag(value) over w as dy, lag(value) over w as x from s window w as (partition by series_id order by ts)),
g as (select series_id, count(dy) as n, regr_slope(dy, x) as b, regr_sxx(dy, x) as sxx, regr_syy(dy, x) as syy, regr_sxy(dy, x) as sxy
      from d where dy is not null group by 1)
select series_id, round(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 6) as adf_stat, cast(0 as integer) as used_lag, cast(n as integer) as nobs from g""",
)
def ts_adf_lag0(t):
    """T6 without lags: the Dickey-Fuller statistic, a simple regression that SQL can state."""
    out = tsx.ts_adf(monthly_revenue(t), "series_id", "ts", "value", maxlag=0)
    return out.select("series_id", F.round("adf_stat", 6).alias("adf_stat"), "used_lag", "nobs")


@query(
    "residual_profile",
    f"""with d as ({_DECOMPOSE_SQL})
select 'resid' as column_name, count(resid) as count, round(avg(resid), 3) as mean, round(stddev_samp(resid), 3) as std,
       min(resid) as min, quantile_cont(resid, 0.25) as q25, quantile_cont(resid, 0.5) as q50, quantile_cont(resid, 0.75) as q75,
       max(resid) as max from d""",
)
def residual_profile(t):
    """Description of the residuals of the decomposition."""
    return prof.profile_numeric(ts_decompose(t), ["resid"], decimals=3)
