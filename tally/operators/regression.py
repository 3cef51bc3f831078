"""Trend + seasonality regression forecast with rolling-origin backtests.

Re-aimed from a Bayesian curve-fitting library: ``y = a + b t + weekly Fourier(3) + yearly
Fourier(10)``, fitted per series by ridge least squares. The fit needs only the Gram sums
``X'X, X'y, y'y`` - computed by Spark over all rows - and a solve of a 28 x 28 system per series
in ``applyInPandas`` (one row per series). Prediction is a dot product in Spark.

For the backtest every cutoff needs the Gram sums of the rows up to it. Rows are not copied per
cutoff: each row adds to one block (between consecutive cutoffs) and a cutoff's sums are the
running total of its blocks, taken in the per-series solve.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEKLY_ORDER = 3
YEARLY_ORDER = 10
YEAR_DAYS = 365.25
Z_80 = 1.2815515655446004  # two-sided 80 % normal interval


def _day(ds: Column) -> Column:
    return F.datediff(F.to_date(ds), F.lit("1970-01-01").cast("date")).cast("double")


def design_columns(ds: Column, t0: Column) -> list[Column]:
    """Intercept, trend in years since ``t0``, weekly and yearly Fourier terms."""
    d = _day(ds)
    cols = [F.lit(1.0), (d - _day(t0)) / YEAR_DAYS]
    for k in range(1, WEEKLY_ORDER + 1):
        cols += [F.sin(2 * math.pi * k * d / 7.0), F.cos(2 * math.pi * k * d / 7.0)]
    for k in range(1, YEARLY_ORDER + 1):
        cols += [F.sin(2 * math.pi * k * d / YEAR_DAYS), F.cos(2 * math.pi * k * d / YEAR_DAYS)]
    return cols


N_FEATURES = 2 + 2 * WEEKLY_ORDER + 2 * YEARLY_ORDER


def gram_by_key(df: DataFrame, keys: Sequence[str], x: str = "_x", y: str = "_y", p: int = N_FEATURES) -> DataFrame:
    """Per key: ``_n, _yy, _xy (p), _xx (upper triangle)`` of the rows' design arrays of ``p`` columns.

    Each task multiplies its rows with numpy (one partial Gram per key and batch, never a whole
    group), then the partial arrays are summed element-wise by key in Spark, in one pass."""
    keys = list(keys)
    iu = np.triu_indices(p)
    schema_keys = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def partial(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            for kv, g in pdf.groupby(keys, sort=False, dropna=False):
                X = np.stack(g[x].to_numpy()).astype(float)
                yv = g[y].to_numpy(dtype=float)
                row = dict(zip(keys, kv if isinstance(kv, tuple) else (kv,)))
                row["_v"] = np.concatenate([[float(len(g)), yv @ yv], X.T @ yv, (X.T @ X)[iu]]).tolist()
                yield pd.DataFrame([row])

    parts = df.select(*keys, x, y).mapInPandas(partial, f"{schema_keys}, _v array<double>")
    summed = parts.select(*keys, F.posexplode("_v").alias("_i", "_e")).groupBy(*keys, "_i").agg(F.sum("_e").alias("_e"))
    arr = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_e"))).alias("_s"))
    v = F.transform("_s", lambda e: e["_e"])
    return arr.select(*keys, v.alias("_v")).select(
        *keys, F.col("_v")[0].alias("_n"), F.col("_v")[1].alias("_yy"), F.slice("_v", 3, p).alias("_xy"), F.slice("_v", p + 3, p * (p + 1) // 2).alias("_xx")
    )


def _full(xx: np.ndarray) -> np.ndarray:
    p = N_FEATURES
    g = np.zeros((p, p))
    i = 0
    for a in range(p):
        for b in range(a, p):
            g[a, b] = g[b, a] = xx[i]
            i += 1
    return g


def _solve(n: float, yy: float, xy: np.ndarray, xx: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    g = _full(xx)
    reg = ridge * max(n, 1.0) * np.eye(N_FEATURES)
    reg[0, 0] = 0.0  # no penalty on the intercept
    b = np.linalg.lstsq(g + reg, xy, rcond=None)[0]
    ssr = float(yy - 2 * b @ xy + b @ g @ b)
    dof = max(n - N_FEATURES, 1.0)
    return b, math.sqrt(max(ssr, 0.0) / dof)


def _with_design(df: DataFrame, series: str, ds: str, value: str | None, t0: Column, keep: Sequence[str] = ()) -> DataFrame:
    cols = [series, *keep, F.to_date(ds).alias("ds"), F.array(*design_columns(F.col(ds), t0)).alias("_x")]
    if value is not None:
        cols.append(F.col(value).cast("double").alias("_y"))
    return df.select(*cols)


def fit(df: DataFrame, series: str, ds: str, value: str, ridge: float = 1e-6) -> DataFrame:
    """Per series: ``coef`` (array of N_FEATURES), residual ``sigma`` and the time origin ``t0``."""
    t0s = df.groupBy(series).agg(F.min(F.to_date(ds)).alias("t0"))
    x = _with_design(df.join(t0s, series), series, ds, value, F.col("t0"), ["t0"])
    g = gram_by_key(x, [series, "t0"])
    key_type = df.schema[series].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            b, s = _solve(float(r["_n"]), float(r["_yy"]), np.asarray(r["_xy"], float), np.asarray(r["_xx"], float), ridge)
            out.append((r[series], r["t0"], b.tolist(), s))
        return pd.DataFrame(out, columns=[series, "t0", "coef", "sigma"])

    return g.groupBy(series).applyInPandas(solve, f"{series} {key_type}, t0 date, coef array<double>, sigma double")


def _dot(x: str, coef: str) -> Column:
    return F.aggregate(F.zip_with(F.col(x), F.col(coef), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def predict(spine: DataFrame, model: DataFrame, series: str, ds: str = "ds", z: float = Z_80) -> DataFrame:
    """``yhat`` and its interval ``yhat +- z sigma`` for every row of ``spine``."""
    j = spine.join(model, series)
    j = j.withColumn("_x", F.array(*design_columns(F.col(ds), F.col("t0"))))
    yhat = _dot("_x", "coef")
    return j.select(
        *[c for c in spine.columns],
        yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"),
        (yhat + z * F.col("sigma")).alias("yhat_upper"),
    )


def conditions(df: DataFrame, model: DataFrame, series: str, ds: str, value: str, ridge: float = 1e-6, tol: float = 1e-6) -> DataFrame:
    """Per series, how many of the normal equations ``X'(y - X b) = ridge n b`` (the constant: 0) do not hold on the rows,
    ``tol`` being relative to the column's and the values' size."""
    x = _with_design(df.join(model, series), series, ds, value, F.col("t0"), ["coef"]).dropna(subset=["_y"])
    rows = x.withColumn("_r", F.col("_y") - _dot("_x", "coef"))
    at = range(N_FEATURES)
    got = rows.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("coef").alias("coef"),
        F.array(*[F.sum(F.col("_x")[i] * F.col("_r")) for i in at]).alias("_g"),
        F.array(*[F.sqrt(F.sum(F.col("_x")[i] * F.col("_x")[i]) * F.sum(F.col("_y") * F.col("_y"))) for i in at]).alias("_size"),
    )
    broken = F.lit(0)
    for i in at:
        off = F.abs(F.col("_g")[i] - (F.lit(ridge if i else 0.0) * F.col("n") * F.col("coef")[i]))
        broken = broken + F.when(off > tol * F.col("_size")[i], 1).otherwise(0)
    return got.select(series, "n", F.lit(N_FEATURES).alias("n_equations"), broken.alias("broken"))


def regress_forecast(df: DataFrame, series: str, ds: str, value: str, periods: int = 100, ridge: float = 1e-6) -> DataFrame:
    """T8 + S9: fit per series and predict over history plus ``periods`` future days."""
    from tally.sources.calendar import future_spine

    model = fit(df, series, ds, value, ridge)
    spine = future_spine(df, [series], ds, periods)
    obs = df.select(series, F.to_date(ds).alias("ds"), F.col(value).cast("double").alias("y"))
    return predict(spine, model, series, "ds").join(obs, [series, "ds"], "left")


def backtest(
    df: DataFrame,
    series: str,
    ds: str,
    value: str,
    initial: int = 90,
    period: int = 15,
    horizon: int = 30,
    ridge: float = 1e-6,
    z: float = Z_80,
) -> DataFrame:
    """Rolling-origin cross-validation. Cutoffs run back from ``max - horizon`` in steps of
    ``period`` while ``>= min + initial`` (series too short get none); each cutoff's model is fit
    on days <= cutoff and predicts ``(cutoff, cutoff + horizon]``.

    Output: series, cutoff, ds, y, yhat, yhat_lower, yhat_upper, horizon_days."""
    d = F.to_date(F.col(ds))
    b = df.groupBy(series).agg(F.min(d).alias("t0"), F.max(d).alias("_max"))
    b = b.withColumn("_last_cut", F.date_sub("_max", horizon)).withColumn("_first_ok", F.date_add("t0", initial))
    # index of the earliest cutoff: the last cutoff minus k * period, k as large as allowed
    b = b.withColumn("_k", F.floor(F.datediff("_last_cut", "_first_ok") / period)).filter(F.col("_k") >= 0)
    b = b.withColumn("_c0", F.date_sub("_last_cut", (F.col("_k") * period).cast("int")))
    rows = df.join(b, series).select(
        series, d.alias("ds"), F.col(value).cast("double").alias("_y"), "t0", "_c0", "_k", "_last_cut"
    )
    rows = rows.withColumn("_x", F.array(*design_columns(F.col("ds"), F.col("t0"))))
    # block j holds days in (c_{j-1}, c_j]; days after the last cutoff train nothing
    rel = F.datediff("ds", "_c0")
    blk = F.when(rel <= 0, F.lit(0)).otherwise(F.ceil(rel / period)).cast("int")
    train = rows.withColumn("_blk", blk).filter(F.col("_blk") <= F.col("_k"))
    blocks = gram_by_key(train, [series, "t0", "_c0", "_k", "_blk"])
    key_type = df.schema[series].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        k = int(pdf["_k"].iloc[0])
        c0 = pd.Timestamp(pdf["_c0"].iloc[0])
        by_blk = {int(r["_blk"]): r for _, r in pdf.iterrows()}
        n = yy = 0.0
        xy = np.zeros(N_FEATURES)
        xx = np.zeros(N_FEATURES * (N_FEATURES + 1) // 2)
        out = []
        for j in range(0, k + 1):
            r = by_blk.get(j)
            if r is not None:
                n += float(r["_n"])
                yy += float(r["_yy"])
                xy = xy + np.asarray(r["_xy"], float)
                xx = xx + np.asarray(r["_xx"], float)
            if n == 0:
                continue
            coef, sigma = _solve(n, yy, xy, xx, ridge)
            out.append((pdf[series].iloc[0], (c0 + pd.Timedelta(days=period * j)).date(), coef.tolist(), sigma))
        return pd.DataFrame(out, columns=[series, "cutoff", "coef", "sigma"])

    models = blocks.groupBy(series).applyInPandas(
        solve, f"{series} {key_type}, cutoff date, coef array<double>, sigma double"
    )
    # each day is predicted by the (at most ceil(horizon / period)) cutoffs just before it
    n_cut = int(math.ceil(horizon / period))
    cand = rows.select(
        series, "ds", "_y", "t0", "_x",
        F.explode(
            F.array(*[F.date_sub(F.date_add("_c0", (F.floor((F.datediff("ds", "_c0") - 1) / period) * period).cast("int")), i * period) for i in range(n_cut + 1)])
        ).alias("cutoff"),
    )
    cand = cand.filter((F.col("cutoff") < F.col("ds")) & (F.datediff("ds", "cutoff") <= horizon))
    j = cand.join(models, [series, "cutoff"])
    yhat = _dot("_x", "coef")
    return j.select(
        series,
        "cutoff",
        "ds",
        F.col("_y").alias("y"),
        yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"),
        (yhat + z * F.col("sigma")).alias("yhat_upper"),
        F.datediff("ds", "cutoff").alias("horizon_days"),
    )


def backtest_metrics(bt: DataFrame, by: Sequence[str] = ("horizon_days",)) -> DataFrame:
    """Mse, rmse, mae, mape, mdape (exact median), smape, coverage per horizon."""
    from tally.functions.quantile import quantiles

    keys = list(by)
    e = bt.withColumns(
        {
            "_err": F.col("yhat") - F.col("y"),
            "_ape": F.abs((F.col("yhat") - F.col("y")) / F.when(F.col("y") != 0, F.col("y"))),
            "_sape": F.try_divide(F.abs(F.col("yhat") - F.col("y")), (F.abs("y") + F.abs("yhat")) / 2),
            "_cov": ((F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))).cast("double"),
        }
    )
    m = e.groupBy(*keys).agg(
        F.avg(F.col("_err") * F.col("_err")).alias("mse"),
        F.avg(F.abs("_err")).alias("mae"),
        F.avg("_ape").alias("mape"),
        F.avg("_sape").alias("smape"),
        F.avg("_cov").alias("coverage"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("rmse", F.sqrt("mse"))
    med = quantiles(e, "_ape", [0.5], by=keys).select(*keys, F.col("q").alias("mdape"))
    return m.join(med, keys, "left")
