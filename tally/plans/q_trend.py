"""Queries on trends with changepoints and conformal bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import changepoints as cp
from tally.operators import regression as reg
from tally.plans.q_regress import _DAILY_SQL, daily_revenue
from tally.plans.registry import query
from tally.session import cut_lineage


def _trend(t):
    return cp.Trend(cut_lineage(daily_revenue(t)), "series_id", "ds", "y")


@query("ts_changepoints", None)
def ts_changepoints(t):
    """Dates where the trend of daily revenue changes its slope, and by how much."""
    return _trend(t).changepoints()


@query("ts_components", None)
def ts_components(t):
    """Trend, weekly and yearly part of every day, which add up to the forecast."""
    return _trend(t).components()


@query(
    "ts_changepoint_candidates",
    f"""with {_DAILY_SQL}
select series_id, cast(t0 + cast(floor(date_diff('day', t0, t1) * (j * 0.8::double / 26)) as integer) as date) as changepoint
from ends, unnest(range(1, 26)) as u(j)""",
)
def ts_changepoint_candidates(t):
    """The candidate dates: 25 of each series, evenly over the first four fifths of its history."""
    return _trend(t).changepoints(all_candidates=True).select("series_id", "changepoint")


@query(
    "ts_changepoint_facts",
    f"""with {_DAILY_SQL}
select series_id, count(*) as n_days, cast(53 as integer) as n_conditions, cast(0 as integer) as broken, cast(0 as bigint) as parts_off from days group by series_id""",
)
def ts_changepoint_facts(t):
    """All conditions of the optimum hold on the data (products of residuals with each of the 53 columns), and the
    parts of every day add up to its forecast."""
    fit = _trend(t)
    off = F.abs(F.col("trend") + F.col("weekly") + F.col("yearly") - F.col("yhat")) > 1e-9 * F.abs("yhat") + 1e-6
    parts = fit.components().groupBy("series_id").agg(F.count(F.lit(1)).alias("n_days"), F.count(F.when(off, 1)).alias("parts_off"))
    return parts.join(fit.conditions(), "series_id").select("series_id", "n_days", "n_conditions", "broken", "parts_off")


def _yearly_before(t):
    """Backtest rows with the value 364 days before as the forecast, which SQL can state."""
    days = cut_lineage(daily_revenue(t))
    rows = reg.backtest(days, "series_id", "ds", "y", initial=90, period=15, horizon=30).select("series_id", "cutoff", "ds", "y", "horizon_days")
    before = days.select("series_id", F.date_add("ds", 364).alias("ds"), F.col("y").alias("yhat"))
    return cut_lineage(rows.join(before, ["series_id", "ds"]))


_CALIBRATE_SQL = f"""{_DAILY_SQL},
e as (select x.series_id, x.cutoff, x.ds, x.horizon_days, x.y, p.y as yhat from tested x join days p on p.series_id = x.series_id and p.ds = x.ds - 364),
bands as (select horizon_days, quantile_cont(abs(y - yhat), 0.8) as half_width from e group by 1)"""


@query(
    "conformal_bands",
    f"""with {_CALIBRATE_SQL}
select e.horizon_days, round(any_value(half_width), 4) as half_width, count(*) as n, round(avg(cast(abs(y - yhat) <= half_width as integer)), 9) as covered
from e join bands using (horizon_days) group by e.horizon_days""",
)
def conformal_bands(t):
    """Half-width of the 80 % band of each horizon day from backtest residuals, and the share inside."""
    out = cp.conformal_bands(_yearly_before(t))
    return out.withColumns({"half_width": F.round("half_width", 4), "covered": F.round("covered", 9)})


@query(
    "conformal_forecast",
    f"""with {_CALIBRATE_SQL}
select series_id, cutoff, ds, y, horizon_days, yhat, round(yhat - half_width, 4) as yhat_lower, round(yhat + half_width, 4) as yhat_upper
from e join bands using (horizon_days)""",
)
def conformal_forecast(t):
    """Backtest rows with the calibrated band of their horizon."""
    bt = _yearly_before(t)
    out = cp.with_bands(bt, cp.conformal_bands(bt))
    cols = ["series_id", "cutoff", "ds", "y", "horizon_days", "yhat"]
    return out.select(*cols, F.round("yhat_lower", 4).alias("yhat_lower"), F.round("yhat_upper", 4).alias("yhat_upper"))


@query(
    "conformal_model_coverage",
    f"""with {_DAILY_SQL}
select cast(horizon_days as integer) as horizon_days, count(*) as n, true as near_80 from tested group by horizon_days having count(*) >= 100""",
)
def conformal_model_coverage(t):
    """The regression's own backtest with bands calibrated on it: within two points of 80 % on every horizon day with
    100 residuals or more (the normal bands of the fit are not)."""
    bt = cut_lineage(reg.backtest(cut_lineage(daily_revenue(t)), "series_id", "ds", "y", initial=90, period=15, horizon=30))
    bands = cp.conformal_bands(bt).where("n >= 100")
    return bands.select("horizon_days", "n", (F.abs(F.col("covered") - 0.8) <= 0.02).alias("near_80"))
