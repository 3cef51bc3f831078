"""Step 9 queries: trend + seasonality regression forecast and its rolling-origin backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import regression as reg
from tally.plans.registry import query
from tally.session import cut_lineage


def daily_revenue(t):
    """Daily order revenue per order status (exact decimal sums as double): three series."""
    return t.orders.groupBy(F.col("o_orderstatus").alias("series_id"), F.to_date("o_orderdate").alias("ds")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("y")
    )


@query("ts_regress_forecast", None)
def ts_regress_forecast(t):
    """T8 + S9: trend + weekly/yearly Fourier regression, history and 100 future days with 80 % band."""
    return reg.regress_forecast(daily_revenue(t), "series_id", "ds", "y", periods=100)


@query("ts_backtest", None)
def ts_backtest(t):
    """Rolling-origin backtest (initial 90 days, period 15, horizon 30)."""
    return reg.backtest(daily_revenue(t), "series_id", "ds", "y", initial=90, period=15, horizon=30)


@query("ts_backtest_metrics", None)
def ts_backtest_metrics(t):
    """Mse, rmse, mae, mape, mdape, smape, coverage by horizon day."""
    return reg.backtest_metrics(cut_lineage(reg.backtest(daily_revenue(t), "series_id", "ds", "y")))


# ---- what SQL can say about the same operators ---------------------------------------------------

_DAILY_SQL = """
days as (select o_orderstatus as series_id, cast(o_orderdate as date) as ds, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as y
         from orders group by all),
ends as (select series_id, min(ds) as t0, max(ds) as t1 from days group by 1),
cuts as (select series_id, cast(t1 - 30 - cast(15 * j as integer) as date) as cutoff
         from (select *, unnest(range(0, (date_diff('day', t0, t1) - 30 - 90) // 15 + 1)) as j from ends where date_diff('day', t0, t1) >= 120)),
tested as (select series_id, cutoff, ds, y, cast(date_diff('day', cutoff, ds) as integer) as horizon_days
           from cuts join days using (series_id) where ds > cutoff and ds <= cutoff + 30)"""


@query(
    "regress_facts",
    f"""with {_DAILY_SQL}
select series_id, count(*) as n_days, cast(100 as bigint) as n_future, true as residuals_average_zero from days group by series_id""",
)
def regress_facts(t):
    """T8 + S9: every day of the history once, 100 days more, and residuals that average zero (the model has a constant)."""
    f = reg.regress_forecast(daily_revenue(t), "series_id", "ds", "y", periods=100)
    known = F.col("y").isNotNull()
    last = daily_revenue(t).groupBy("series_id").agg(F.max("ds").alias("last"))
    return f.join(last, "series_id").groupBy("series_id").agg(
        F.count(F.when(known, 1)).alias("n_days"),
        F.count(F.when(F.col("ds") > F.col("last"), 1)).alias("n_future"),
        (F.abs(F.avg(F.col("y") - F.when(known, F.col("yhat")))) < F.avg(F.abs("y")) * 1e-4).alias("residuals_average_zero"),
    )


@query("backtest_rows", f"with {_DAILY_SQL} select *, true as has_band from tested")
def backtest_rows(t):
    """Cutoffs, days and horizons of the rolling-origin backtest, each with a forecast inside its band."""
    b = reg.backtest(daily_revenue(t), "series_id", "ds", "y", initial=90, period=15, horizon=30)
    ok = F.col("yhat_lower").isNotNull() & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return b.select("series_id", "cutoff", "ds", "y", "horizon_days", F.coalesce(ok, F.lit(False)).alias("has_band"))


@query(
    "horizon_metrics",
    f"""with {_DAILY_SQL},
e as (select x.horizon_days, x.y, p.y as yhat, 0.8 * p.y as lo, 1.2 * p.y as hi
      from tested x join days p on p.series_id = x.series_id and p.ds = x.ds - 364)
select horizon_days, round(avg((yhat - y) * (yhat - y)), 2) as mse, round(sqrt(avg((yhat - y) * (yhat - y))), 6) as rmse,
       round(avg(abs(yhat - y)), 6) as mae, round(avg(abs((yhat - y) / nullif(y, 0))), 9) as mape,
       round(avg(abs(yhat - y) / nullif((abs(y) + abs(yhat)) / 2, 0)), 9) as smape,
       round(avg(cast(y between lo and hi as integer)), 9) as coverage, count(*) as n,
       round(quantile_cont(abs((yhat - y) / nullif(y, 0)), 0.5), 9) as mdape
from e group by horizon_days""",
)
def horizon_metrics(t):
    """Metrics by horizon of a forecast SQL can state (the value 364 days before, band of 20 %)."""
    days = cut_lineage(daily_revenue(t))
    rows = reg.backtest(days, "series_id", "ds", "y", initial=90, period=15, horizon=30).select("series_id", "ds", "y", "horizon_days")
    before = days.select("series_id", F.date_add("ds", 364).alias("ds"), F.col("y").alias("yhat"))
    bt = rows.join(before, ["series_id", "ds"]).withColumns({"yhat_lower": F.col("yhat") * 0.8, "yhat_upper": F.col("yhat") * 1.2})
    m = reg.backtest_metrics(cut_lineage(bt))
    digits = {"mse": 2, "rmse": 6, "mae": 6, "mape": 9, "smape": 9, "coverage": 9, "mdape": 9}
    return m.withColumns({c: F.round(c, d) for c, d in digits.items()})
