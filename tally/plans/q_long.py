"""Queries on long series (W3-W6, T1-T6 by buckets with a halo) and on ARIMA residuals."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from tally.operators import arima, halo, timeseries as tsx
from tally.plans.q_ts import _SERIES_SQL, monthly_revenue
from tally.plans.registry import query

BUCKET_ROWS = 500  # many buckets on the test tables; 262,144 by default


def order_values(t):
    """Series = order status (two of them hold nearly all rows), ts = order key, value = price of the order."""
    return t.orders.select(F.col("o_orderstatus").alias("series_id"), F.col("o_orderkey").alias("ts"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("value"))


_LONG_SQL = """
s as (
  select o_orderstatus as series_id, o_orderkey as ts, cast(cast(o_totalprice as decimal(18,2)) as double) as value from orders
)"""


@query(
    "ts_difference_long",
    f"""
with {_LONG_SQL},
d as (
  select series_id, ts, value, value - lag(value, 1) over w as diff_1, value - lag(value, 12) over w as seasonal_diff,
         case when value > 0 then ln(value) end as log_value
  from s window w as (partition by series_id order by ts))
select series_id, ts, value, round(diff_1, 4) as diff_1, round(seasonal_diff, 4) as seasonal_diff, round(log_value, 9) as log_value,
       round(diff_1 - lag(diff_1, 1) over w, 4) as diff_2,
       round(log_value - lag(log_value, 1) over w, 9) as log_diff
from d window w as (partition by series_id order by ts)
""",
)
def ts_difference_long(t):
    """W3 + X26 over every order of a status in the order of its key, in buckets of rows."""
    out = tsx.ts_difference(order_values(t), "series_id", "ts", "value", seasonal=12, bucket_rows=BUCKET_ROWS)
    digits = {"diff_1": 4, "seasonal_diff": 4, "diff_2": 4, "log_value": 9, "log_diff": 9}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "ts_rolling_long",
    f"""
with {_LONG_SQL},
r as (
  select series_id, ts, value,
         case when count(value) over w = 12 then avg(value) over w end as rolling_mean,
         case when count(value) over w = 12 then stddev_samp(value) over w end as rolling_std
  from s window w as (partition by series_id order by ts rows between 11 preceding and current row))
select series_id, ts, value, round(rolling_mean, 5) as rolling_mean, round(rolling_std, 5) as rolling_std,
       round(value - rolling_mean, 5) as detrended
from r where value - rolling_mean is not null
""",
)
def ts_rolling_long(t):
    """W4 + W5 + T7 over long series."""
    out = tsx.ts_rolling(order_values(t), "series_id", "ts", "value", window=12, bucket_rows=BUCKET_ROWS)
    return out.withColumns({c: F.round(c, 5) for c in ("rolling_mean", "rolling_std", "detrended")})


@query(
    "ts_decompose_long",
    f"""
with {_LONG_SQL},
b as (
  select series_id, ts, value, row_number() over w as pos,
         case when count(value) over (w rows between 6 preceding and 6 following) = 13
              then (sum(value) over (w rows between 6 preceding and 6 following)
                    - 0.5 * lag(value, 6) over w - 0.5 * lead(value, 6) over w) / 12 end as trend
  from s window w as (partition by series_id order by ts)),
p as (select series_id, (pos - 1) % 12 as phase, avg(value - trend) as pm from b group by all),
q as (select series_id, phase, pm - avg(pm) over (partition by series_id) as seasonal from p)
select b.series_id, b.ts, b.value, round(b.trend, 6) as trend, round(q.seasonal, 6) as seasonal, round(b.value - b.trend - q.seasonal, 6) as resid
from b join q on b.series_id = q.series_id and (b.pos - 1) % 12 = q.phase
""",
)
def ts_decompose_long(t):
    """T1 + W6 over long series: the centred average looks into both neighbouring buckets."""
    out = tsx.ts_decompose(order_values(t), "series_id", "ts", "value", period=12, bucket_rows=BUCKET_ROWS)
    return out.withColumns({c: F.round(c, 6) for c in ("trend", "seasonal", "resid")})


@query(
    "ts_acf_long",
    f"""
with {_LONG_SQL},
n as (select series_id, row_number() over (partition by series_id order by ts) as pos, value - avg(value) over (partition by series_id) as c from s),
k as (select unnest(range(0, 25)) as lag)
select a.series_id, cast(k.lag as integer) as lag, round(sum(a.c * b.c) / any_value(z.s0), 9) as acf
from n a cross join k join n b on a.series_id = b.series_id and b.pos = a.pos + k.lag
join (select series_id, sum(c * c) as s0 from n group by 1) z on z.series_id = a.series_id
group by 1, 2
""",
)
def ts_acf_long(t):
    """T4 over long series."""
    out = tsx.ts_acf(order_values(t), "series_id", "ts", "value", nlags=24, bucket_rows=BUCKET_ROWS)
    return out.withColumns({"acf": F.round("acf", 9), "lag": F.col("lag").cast("int")})


@query(
    "ts_durbin_watson_long",
    f"""
with {_LONG_SQL},
d as (select series_id, value, value - lag(value) over (partition by series_id order by ts) as d from s)
select series_id, round(sum(d * d) / nullif(sum(value * value), 0), 9) as durbin_watson from d group by series_id
""",
)
def ts_durbin_watson_long(t):
    """T2 over long series."""
    out = tsx.ts_durbin_watson(order_values(t), "series_id", "ts", "value", bucket_rows=BUCKET_ROWS)
    return out.withColumn("durbin_watson", F.round("durbin_watson", 9))


@query(
    "running_totals_long",
    """
select o_orderstatus as series_id, o_orderkey as ts, cast(o_totalprice as decimal(18,2)) as value,
       cast(sum(cast(o_totalprice as decimal(18,2))) over (partition by o_orderstatus order by o_orderkey) as decimal(38,2)) as cum_value
from orders
""",
)
def running_totals_long(t):
    """Running totals of long series: sums inside a bucket and the earlier buckets' sums carried on (exact decimals)."""
    src = t.orders.select(F.col("o_orderstatus").alias("series_id"), F.col("o_orderkey").alias("ts"), F.col("o_totalprice").cast("decimal(18,2)").alias("value"))
    out = halo.running_sum(src, ["series_id"], ["ts"], ["value"], bucket_rows=BUCKET_ROWS)
    return out.withColumn("cum_value", F.col("cum_value").cast("decimal(38,2)"))


# centred sums of two regressors and y; the t of the first coefficient with one lag and without
_ADF1_SQL = """
d as (select series_id, ts, value - lag(value) over w as y, lag(value) over w as x from s window w as (partition by series_id order by ts)),
e as (select *, lag(y) over (partition by series_id order by ts) as z from d),
common as (
  select series_id, count(*) as n, covar_pop(x, x) * count(*) as xx, covar_pop(z, z) * count(*) as zz, covar_pop(x, z) * count(*) as xz,
         covar_pop(x, y) * count(*) as xy, covar_pop(z, y) * count(*) as zy, covar_pop(y, y) * count(*) as yy
  from e where z is not null group by 1),
one as (
  select *, (xy * zz - zy * xz) / (xx * zz - xz * xz) as b, (zy * xx - xy * xz) / (xx * zz - xz * xz) as c, yy - xy * xy / xx as ssr0 from common),
both_ as (select *, yy - b * xy - c * zy as ssr1 from one),
chosen as (select *, n * ln(ssr1 / n) + 6 < n * ln(ssr0 / n) + 4 as lagged from both_),
none as (
  select series_id, count(*) as n, covar_pop(x, x) * count(*) as xx, covar_pop(x, y) * count(*) as xy, covar_pop(y, y) * count(*) as yy
  from d where y is not null group by 1)
select c.series_id, cast(case when c.lagged then 1 else 0 end as integer) as used_lag, cast(case when c.lagged then c.n else o.n end as integer) as nobs,
       round(case when c.lagged then c.b / sqrt(c.ssr1 / (c.n - 3) * c.zz / (c.xx * c.zz - c.xz * c.xz))
             else o.xy / o.xx / sqrt((o.yy - o.xy * o.xy / o.xx) / (o.n - 2) / o.xx) end, 6) as adf_stat
from chosen c join none o using (series_id)"""


@query("ts_adf_lag1", f"with {_SERIES_SQL},{_ADF1_SQL}")
def ts_adf_lag1(t):
    """T6 with up to one lag: choice by AIC on the common sample, then the refit, both as SQL can state them."""
    out = tsx.ts_adf(monthly_revenue(t), "series_id", "ts", "value", maxlag=1)
    return out.select("series_id", "used_lag", "nobs", F.round("adf_stat", 6).alias("adf_stat"))


@query("ts_adf_long", f"with {_LONG_SQL},{_ADF1_SQL}")
def ts_adf_long(t):
    """T6 with up to one lag over long series."""
    out = tsx.ts_adf(order_values(t), "series_id", "ts", "value", maxlag=1, bucket_rows=BUCKET_ROWS)
    return out.select("series_id", "used_lag", "nobs", F.round("adf_stat", 6).alias("adf_stat"))


# ---- T11: residuals of ARIMA(1, 1, 2) -------------------------------------------------------------


def _determinant(m: list[list[str]]) -> str:
    terms = []
    for p in permutations(range(len(m))):
        sign = 1
        for i in range(len(p)):
            for j in range(i):
                sign = -sign if p[j] > p[i] else sign
        terms.append(("+" if sign > 0 else "-") + "*".join(m[i][j] for i, j in enumerate(p)))
    return "(" + "".join(terms) + ")"


def _normal_equations(x: list[str], y: str) -> tuple[str, list[str]]:
    """The sums that a least-squares fit needs, and its coefficients by Cramer's rule."""
    k = len(x)
    name = lambda a, b: f"g{min(a, b)}{max(a, b)}"
    sums = [f"sum({x[a]} * {x[b]}) as {name(a, b)}" for a in range(k) for b in range(a, k)] + [f"sum({x[a]} * {y}) as h{a}" for a in range(k)]
    whole = [[name(a, b) for b in range(k)] for a in range(k)]
    coefs = [f"{_determinant([[f'h{a}' if b == c else whole[a][b] for b in range(k)] for a in range(k)])} / {_determinant(whole)}" for c in range(k)]
    return ", ".join(sums), coefs


def _arima_sql() -> str:
    long_sums, a = _normal_equations(["y1", "y2", "y3", "y4"], "y")
    sums, b = _normal_equations(["y1", "e1", "e2"], "y")
    return f"""{_SERIES_SQL},
diffs as (select series_id, ts, value - lag(value) over (partition by series_id order by ts) as y from s),
lags as (
  select series_id, ts, y, lag(y, 1) over w as y1, lag(y, 2) over w as y2, lag(y, 3) over w as y3, lag(y, 4) over w as y4
  from diffs where y is not null window w as (partition by series_id order by ts)),
auto as (select series_id, {long_sums} from lags where y4 is not null group by 1),
auto_fit as (select series_id, {', '.join(f'{c} as a{i + 1}' for i, c in enumerate(a))} from auto),
rest as (select l.*, y - a1 * y1 - a2 * y2 - a3 * y3 - a4 * y4 as e from lags l join auto_fit using (series_id)),
rest_lags as (select *, lag(e, 1) over w as e1, lag(e, 2) over w as e2 from rest window w as (partition by series_id order by ts)),
sums as (select series_id, count(*) as n, sum(y * y) as yy, {sums} from rest_lags where e2 is not null group by 1),
coefs as (select *, {b[0]} as phi1, {b[1]} as theta1, {b[2]} as theta2 from sums),
roots as (
  select *, sqrt((yy - phi1 * h0 - theta1 * h1 - theta2 * h2) / (n - 3)) as sigma, theta1 * theta1 - 4 * theta2 as disc,
         (-theta1 + sqrt(greatest(theta1 * theta1 - 4 * theta2, 0))) / 2 as r1, (-theta1 - sqrt(greatest(theta1 * theta1 - 4 * theta2, 0))) / 2 as r2
  from coefs),
moved as (
  select *, case when abs(r1) > 1 then 1 / r1 else r1 end as m1, case when abs(r2) > 1 then 1 / r2 else r2 end as m2,
         case when disc < 0 then theta2 > 1 else abs(r1) > 1 or abs(r2) > 1 end as flipped
  from roots),
fit as (
  select series_id, n, phi1, sigma, flipped,
         case when not flipped then theta1 when disc < 0 then theta1 / theta2 else -(m1 + m2) end as theta1,
         case when not flipped then theta2 when disc < 0 then 1 / theta2 else m1 * m2 end as theta2
  from moved)"""


@query("ts_arima_fit", f"with {_arima_sql()}\nselect series_id, n, round(phi1, 6) as phi1, round(theta1, 6) as theta1, round(theta2, 6) as theta2, round(sigma, 2) as sigma, flipped from fit")
def ts_arima_fit(t):
    """ARIMA(1, 1, 2) of each series by two least-squares fits; both systems of normal equations are in the SQL."""
    fit = arima.Arima(monthly_revenue(t), "series_id", "ts", "value", 1, 1, 2, bucket_rows=BUCKET_ROWS).coefficients
    digits = {"phi1": 6, "theta1": 6, "theta2": 6, "sigma": 2}
    return fit.withColumns({c: F.round(c, d) for c, d in digits.items()})


_RESID_SQL = f"""with recursive {_arima_sql()},
steps as (select series_id, ts, y, y1, row_number() over (partition by series_id order by ts) as k from lags),
run as (
  select series_id, ts, k, y as e, 0.0::double as before from steps where k = 1
  union all
  select x.series_id, x.ts, x.k, x.y - f.phi1 * x.y1 - f.theta1 * r.e - f.theta2 * r.before as e, r.e as before
  from run r join steps x on x.series_id = r.series_id and x.k = r.k + 1 join fit f on f.series_id = x.series_id)"""


@query("ts_arima_residuals", f"{_RESID_SQL}\nselect series_id, ts, round(e, 2) as resid from run")
def ts_arima_residuals(t):
    """Innovations of the fitted ARIMA(1, 1, 2), run from zeros."""
    out = arima.Arima(monthly_revenue(t), "series_id", "ts", "value", 1, 1, 2, bucket_rows=30).residuals()
    return out.withColumn("resid", F.round("resid", 2))


@query(
    "ts_arima_residual_profile",
    f"""{_RESID_SQL}
select series_id, count(e) as count, round(avg(e), 2) as mean, round(stddev_samp(e), 2) as std, round(min(e), 2) as min, round(quantile_cont(e, 0.25), 2) as q25,
       round(quantile_cont(e, 0.5), 2) as q50, round(quantile_cont(e, 0.75), 2) as q75, round(max(e), 2) as max from run group by series_id""",
)
def ts_arima_residual_profile(t):
    """Description of the residuals of each series."""
    resid = arima.Arima(monthly_revenue(t), "series_id", "ts", "value", 1, 1, 2, bucket_rows=BUCKET_ROWS).residuals()
    out = arima.residual_description(resid, "series_id")
    return out.withColumns({c: F.round(c, 2) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})
