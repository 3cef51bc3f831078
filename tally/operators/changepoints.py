"""Trend with changepoints, weekly and yearly season, as separate columns.

The trend is piecewise linear: beside a line it has one hinge ``max(0, t - c)`` for each of ``candidates`` dates ``c``,
spread evenly over the first ``share`` of a series' history, whose coefficient is the change of slope there. An L1
penalty on these keeps most of them at zero; the season is the Fourier terms of ``regression``. Of the data a fit needs
the sums of products of the columns alone, which Spark adds up over all rows (``gram_by_key``); the rest is solved per
series from one row of sums:

1. the columns that are not penalised are eliminated, which leaves a problem in the hinges alone;
2. coordinate descent on it; now and then the coefficients that are not zero are solved for exactly, given their signs,
   and the descent ends once that solution meets the conditions of the optimum (``conditions`` states them on the
   data again).

``penalty`` is a share of the smallest weight at which no hinge would be used, so it does not depend on the units.

Null values and dates are dropped; a series with a single date has no hinges; a null series is left out; an empty
table gives empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.regression import N_FEATURES, WEEKLY_ORDER, YEAR_DAYS, _day, design_columns, gram_by_key
from tally.session import cut_lineage

_WEEKLY = slice(2, 2 + 2 * WEEKLY_ORDER)


def _hinges(ds: Column, t0: Column, t1: Column, candidates: int, share: float) -> list[Column]:
    """One column per candidate date; whole days, so a candidate is a date of the calendar."""
    day = _day(ds)
    return [F.greatest(F.lit(0.0), (day - _day(candidate(t0, t1, j, candidates, share))) / YEAR_DAYS) for j in range(1, candidates + 1)]


def candidate(t0: Column, t1: Column, j: int, candidates: int, share: float) -> Column:
    """The ``j``-th candidate date, from 1."""
    return F.date_add(t0, F.floor(F.datediff(t1, t0) * (j * share / (candidates + 1))).cast("int"))


def solve_lasso(g: np.ndarray, c: np.ndarray, free: int, penalty: float, ridge: float, sweeps: int = 20_000) -> tuple[np.ndarray, float]:
    """Minimum of b'gb / 2 - c'b + ridge |b_free|^2 / 2 + weight |b_rest|_1 and the weight; the first ``free``
    coefficients are not penalised by it, and the very first one (the constant) not at all."""
    a = g.copy()
    a[np.arange(1, free), np.arange(1, free)] += ridge
    solve = np.linalg.pinv(a[:free, :free], hermitian=True)
    cross = a[:free, free:]
    h, d = a[free:, free:] - cross.T @ solve @ cross, c[free:] - cross.T @ solve @ c[:free]
    weight = penalty * float(np.abs(d).max(initial=0.0))
    scale = np.diag(h).copy()
    usable = scale > 1e-10 * max(float(np.diag(a[free:, free:]).max(initial=0.0)), 1e-300)
    b, rest = np.zeros(len(d)), d.copy()  # rest = d - h b
    for sweep in range(sweeps):
        moved = False
        for j in np.flatnonzero(usable):
            z = rest[j] + scale[j] * b[j]
            new = np.sign(z) * max(abs(z) - weight, 0.0) / scale[j]
            if new != b[j]:
                rest -= h[:, j] * (new - b[j])
                moved, b[j] = True, new
        if not moved:
            break
        if sweep % 20 == 19:
            # the exact solution for these signs, if it meets all conditions
            active = np.flatnonzero(b)
            exact = np.zeros(len(d))
            exact[active] = np.linalg.lstsq(h[np.ix_(active, active)], d[active] - weight * np.sign(b[active]), rcond=None)[0]
            off = d - h @ exact
            if (np.sign(exact[active]) == np.sign(b[active])).all() and (np.abs(off[usable]) <= weight * (1 + 1e-9)).all():
                b = exact
                break
    return np.concatenate((solve @ (c[:free] - cross @ b), b)), weight


class Trend:
    """A fit of every series; all methods return DataFrames over all series."""

    def __init__(self, df: DataFrame, series: str, ds: str, value: str, candidates: int = 25, share: float = 0.8, penalty: float = 0.05, ridge: float = 1e-6):
        self.series, self.candidates, self.share = series, candidates, share
        known = df.select(F.col(series), F.to_date(ds).alias("ds"), F.col(value).cast("double").alias("y")).dropna()
        ends = known.groupBy(series).agg(F.min("ds").alias("t0"), F.max("ds").alias("t1"))
        self.rows = cut_lineage(known.join(ends, series))
        p = N_FEATURES + candidates
        x = F.array(*design_columns(F.col("ds"), F.col("t0")), *_hinges(F.col("ds"), F.col("t0"), F.col("t1"), candidates, share))
        sums = gram_by_key(self.rows.select(series, "t0", "t1", x.alias("_x"), F.col("y").alias("_y")), [series, "t0", "t1"], p=p)
        kind = df.schema[series].dataType.simpleString()
        upper = np.triu_indices(p)

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            r = pdf.iloc[0]
            g = np.zeros((p, p))
            g[upper] = r["_xx"]
            g = g + np.triu(g, 1).T
            b, weight = solve_lasso(g, np.asarray(r["_xy"], float), N_FEATURES, penalty, ridge * max(float(r["_n"]), 1.0))
            return pd.DataFrame([[r[series], r["t0"], r["t1"], int(r["_n"]), b.tolist(), weight]], columns=[series, "t0", "t1", "n", "coef", "weight"])

        self.ridge = ridge
        self.model = cut_lineage(sums.groupBy(series).applyInPandas(solve, f"`{series}` {kind}, t0 date, t1 date, n long, coef array<double>, weight double"))

    def changepoints(self, all_candidates: bool = False) -> DataFrame:
        """(series, changepoint, delta): dates where the slope changes, and by how much a year."""
        each = F.array(
            *[
                F.struct(candidate(F.col("t0"), F.col("t1"), j, self.candidates, self.share).alias("changepoint"), F.col("coef")[N_FEATURES + j - 1].alias("delta"))
                for j in range(1, self.candidates + 1)
            ]
        )
        found = self.model.select(self.series, F.inline(each))
        return found if all_candidates else found.where("delta <> 0")

    def components(self, spine: DataFrame | None = None) -> DataFrame:
        """(series, ds, trend, weekly, yearly, yhat) for the rows of ``spine`` (series, ds), or the history with ``y``."""
        rows = self.rows.drop("t0", "t1") if spine is None else spine.select(self.series, F.to_date("ds").alias("ds"))
        j = rows.join(self.model, self.series)
        x = design_columns(F.col("ds"), F.col("t0")) + _hinges(F.col("ds"), F.col("t0"), F.col("t1"), self.candidates, self.share)
        part = [F.col("coef")[i] * c for i, c in enumerate(x)]
        weekly = list(range(*_WEEKLY.indices(N_FEATURES)))
        yearly = list(range(_WEEKLY.stop, N_FEATURES))
        trend = [i for i in range(len(part)) if i not in weekly and i not in yearly]

        def total(at: list[int]) -> Column:
            out = part[at[0]]
            for i in at[1:]:
                out = out + part[i]
            return out

        j = j.withColumns({"trend": total(trend), "weekly": total(weekly), "yearly": total(yearly)})
        return j.select(*rows.columns, "trend", "weekly", "yearly", (F.col("trend") + F.col("weekly") + F.col("yearly")).alias("yhat"))

    def conditions(self, tol: float = 1e-4) -> DataFrame:
        """Per series, how many conditions of the optimum do not hold on the rows, of ``n_conditions``: a free column's
        product with the residuals is its ridge term; a hinge's is at most the weight in size, and equal to it, with the
        coefficient's sign, where that is not zero. ``tol`` is relative to the column's product with the values."""
        x = design_columns(F.col("ds"), F.col("t0")) + _hinges(F.col("ds"), F.col("t0"), F.col("t1"), self.candidates, self.share)
        fit = self.components().select(self.series, "ds", "yhat")
        rows = self.rows.join(fit, [self.series, "ds"])
        r = F.col("y") - F.col("yhat")
        got = rows.groupBy(self.series).agg(
            F.array(*[F.sum(c * r) for c in x]).alias("_g"), F.array(*[F.sqrt(F.sum(c * c) * F.sum(F.col("y") * F.col("y"))) for c in x]).alias("_size")
        )
        j = got.join(self.model, self.series)
        broken = F.lit(0)
        for i in range(len(x)):
            g, b, size = F.col("_g")[i], F.col("coef")[i], F.col("_size")[i] * tol
            if i < N_FEATURES:
                off = F.abs(g - (F.lit(self.ridge if i else 0.0) * F.col("n") * b))
            else:
                off = F.when(b != 0, F.abs(g - F.signum(b) * F.col("weight"))).otherwise(F.abs(g) - F.col("weight"))
            broken = broken + F.when(off > size, 1).otherwise(0)
        return j.select(self.series, F.lit(len(x)).alias("n_conditions"), broken.alias("broken"))


def conformal_bands(bt: DataFrame, by: str = "horizon_days", coverage: float = 0.8) -> DataFrame:
    """Half-widths of bands from backtest residuals (split conformal): per ``by`` the exact quantile of
    ``|y - yhat|``, with the number of residuals and the share of them inside. A group without a residual has no row."""
    from tally.functions.quantile import quantiles

    e = bt.select(by, F.abs(F.col("y") - F.col("yhat")).alias("_r")).where("_r is not null")
    q = quantiles(e, "_r", [coverage], by=[by]).select(F.col(by).alias("_k"), F.col("q").alias("half_width"))
    j = e.join(q, F.col(by).eqNullSafe(F.col("_k")))
    return j.groupBy(by).agg(
        F.first("half_width").alias("half_width"), F.count(F.lit(1)).alias("n"), F.avg((F.col("_r") <= F.col("half_width")).cast("double")).alias("covered")
    )


def with_bands(forecast: DataFrame, bands: DataFrame, by: str = "horizon_days") -> DataFrame:
    """``yhat_lower`` and ``yhat_upper`` of forecast rows from their horizon's half-width (null where it has none)."""
    b = bands.select(F.col(by).alias("_k"), "half_width")
    j = forecast.join(b, F.col(by).eqNullSafe(F.col("_k")), "left")
    cols = [c for c in forecast.columns if c not in ("yhat_lower", "yhat_upper")]
    return j.select(*cols, (F.col("yhat") - F.col("half_width")).alias("yhat_lower"), (F.col("yhat") + F.col("half_width")).alias("yhat_upper"))
