import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tally.operators import regression as reg


def _design(days, t0):
    cols = [np.ones_like(days, dtype=float), (days - t0) / reg.YEAR_DAYS]
    for k in range(1, reg.WEEKLY_ORDER + 1):
        cols += [np.sin(2 * math.pi * k * days / 7.0), np.cos(2 * math.pi * k * days / 7.0)]
    for k in range(1, reg.YEARLY_ORDER + 1):
        cols += [np.sin(2 * math.pi * k * days / reg.YEAR_DAYS), np.cos(2 * math.pi * k * days / reg.YEAR_DAYS)]
    return np.column_stack(cols)


def _frame(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    ds = pd.date_range("2020-01-01", periods=n, freq="D")
    days = (ds - pd.Timestamp("1970-01-01")).days.to_numpy().astype(float)
    y = 50 + 8 * (days - days[0]) / 365.25 + 5 * np.sin(2 * math.pi * days / 7.0) + rng.normal(scale=0.5, size=n)
    pdf = pd.DataFrame({"sid": "a", "ds": ds.date, "y": y})
    return spark.createDataFrame(pdf), days, y


def test_fit_recovers_trend_and_weekly_cycle(spark):
    df, days, y = _frame(spark)
    out = reg.regress_forecast(df, "sid", "ds", "y", periods=30).toPandas().sort_values("ds")
    hist = out[~out.is_future]
    assert np.sqrt(np.mean((hist.yhat - hist.y) ** 2)) < 0.7
    fut = out[out.is_future]
    assert len(fut) == 30
    assert (fut.yhat_lower < fut.yhat).all() and (fut.yhat < fut.yhat_upper).all()


def test_backtest_cutoff_models_match_direct_fits(spark):
    df, days, y = _frame(spark, n=200, seed=1)
    bt = reg.backtest(df, "sid", "ds", "y", initial=90, period=15, horizon=30).toPandas()
    cutoffs = sorted(bt.cutoff.unique())
    last = pd.Timestamp("2020-01-01") + pd.Timedelta(days=199)
    assert pd.Timestamp(cutoffs[-1]) == last - pd.Timedelta(days=30)
    assert all((pd.Timestamp(b) - pd.Timestamp(a)).days == 15 for a, b in zip(cutoffs, cutoffs[1:]))
    assert pd.Timestamp(cutoffs[0]) >= pd.Timestamp("2020-01-01") + pd.Timedelta(days=90)
    ds_all = pd.date_range("2020-01-01", periods=200, freq="D")
    for c in (cutoffs[0], cutoffs[-1]):
        c = pd.Timestamp(c)
        mask = ds_all <= c
        X = _design(days[mask], days[0])
        reg_m = 1e-6 * mask.sum() * np.eye(X.shape[1])
        reg_m[0, 0] = 0
        b = np.linalg.lstsq(X.T @ X + reg_m, X.T @ y[mask], rcond=None)[0]
        rows = bt[pd.to_datetime(bt.cutoff) == c].sort_values("ds")
        fut = (ds_all > c) & (ds_all <= c + pd.Timedelta(days=30))
        exp = _design(days[fut], days[0]) @ b
        assert len(rows) == fut.sum()
        assert np.allclose(rows.yhat.to_numpy(), exp, atol=1e-6)
    m = reg.backtest_metrics(spark.createDataFrame(bt)).toPandas()
    assert set(m.horizon_days) == set(range(1, 31))
    assert (m.coverage.between(0, 1)).all() and (m.rmse >= 0).all()
