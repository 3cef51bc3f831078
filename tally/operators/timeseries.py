"""Time-series statistics for any number of series.

Input is long: ``(series, ts, value)``; order is always the ``ts`` column, never row position.
Lags and frames are per-series windows (a window streams its partition with a bounded buffer); with ``bucket_rows``
they run over buckets of that many rows with a halo instead (``operators/halo.py``), for series that outgrow a task.
Everything that needs a per-series solve (PACF, ADF) first reduces the series to a handful of
sums in Spark; only those sums reach Python, in ``applyInPandas`` over one row per series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.operators import halo


def ts_difference(df: DataFrame, series: str, ts: str, value: str, seasonal: int = 12, bucket_rows: int | None = None) -> DataFrame:
    """W3 + X26: first and second differences, seasonal difference, log and log difference.

    ``ln`` is null for values <= 0 (numpy gives -inf / nan)."""
    rows, w = halo.frames(df.select(series, ts, value), series, ts, max(2, seasonal), 0, bucket_rows)
    x = F.col(value)
    d1 = x - F.lag(x, 1).over(w)
    out = rows.withColumns(
        {
            "diff_1": d1,
            "seasonal_diff": x - F.lag(x, seasonal).over(w),
            "log_value": F.ln(x),
        }
    )
    out = out.withColumns(
        {
            "diff_2": F.col("diff_1") - F.lag("diff_1", 1).over(w),
            "log_diff": F.col("log_value") - F.lag("log_value", 1).over(w),
        }
    )
    return halo.owned(out).drop(halo.G)


def ts_rolling(df: DataFrame, series: str, ts: str, value: str, window: int = 12, bucket_rows: int | None = None) -> DataFrame:
    """W4 + W5: rolling mean and sample std over the last ``window`` rows, null until the
    window is full; ``detrended`` = value - rolling mean (rows without it are dropped)."""
    rows, w = halo.frames(df.select(series, ts, value), series, ts, window - 1, 0, bucket_rows)
    frame = w.rowsBetween(1 - window, 0)
    full = F.count(F.col(value)).over(frame) == window
    out = rows.withColumns(
        {
            "rolling_mean": F.when(full, F.avg(value).over(frame)),
            "rolling_std": F.when(full, F.stddev_samp(value).over(frame)),
        }
    )
    return halo.owned(out).drop(halo.G).withColumn("detrended", F.col(value) - F.col("rolling_mean")).dropna(subset=["detrended"])


def ts_decompose(df: DataFrame, series: str, ts: str, value: str, period: int = 12, bucket_rows: int | None = None) -> DataFrame:
    """Additive decomposition (moving-average trend, phase means, residual).

    Trend is the centred 2 x ``period`` moving average for even periods (plain centred mean for
    odd), null where the window is incomplete. Seasonal = mean of the detrended values of the
    row's phase ``(pos - 1) % period`` minus the mean of the phase means; resid = x - trend - seasonal.
    """
    half = period // 2
    rows, w = halo.frames(df.select(series, ts, value), series, ts, half, half, bucket_rows)
    frame = w.rowsBetween(-half, half)
    x = F.col(value)
    if period % 2 == 0:
        trend = (F.sum(x).over(frame) - 0.5 * F.lag(x, half).over(w) - 0.5 * F.lead(x, half).over(w)) / period
    else:
        trend = F.avg(x).over(frame)
    full = F.count(x).over(frame) == 2 * half + 1
    base = halo.owned(rows.withColumn("trend", F.when(full, trend)))
    base = halo.position(base, series, ts).withColumn("_phase", (F.col("_pos") - 1) % period)
    phase = base.groupBy(series, "_phase").agg(F.avg(F.col(value) - F.col("trend")).alias("_pm"))
    phase = phase.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(series))).drop("_pm")
    out = base.join(phase, [series, "_phase"], "left")
    return out.select(
        series, ts, value, "trend", "seasonal", (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid")
    )


def ts_durbin_watson(df: DataFrame, series: str, ts: str, value: str, bucket_rows: int | None = None) -> DataFrame:
    """``sum((x_t - x_{t-1})^2) / sum(x_t^2)`` per series."""
    rows, w = halo.frames(df.select(series, ts, value), series, ts, 1, 0, bucket_rows)
    d = F.col(value) - F.lag(value, 1).over(w)
    return (
        halo.owned(rows.withColumn("_d", d))
        .groupBy(series)
        .agg(F.try_divide(F.sum(F.col("_d") * F.col("_d")), F.sum(F.col(value) * F.col(value))).alias("durbin_watson"))
    )


def ts_acf(df: DataFrame, series: str, ts: str, value: str, nlags: int = 24, bucket_rows: int | None = None) -> DataFrame:
    """T4: biased autocorrelation ``sum (x_t - m)(x_{t+k} - m) / sum (x_t - m)^2`` for k = 0..nlags,
    long form ``(series, lag, acf)``. One window pass generates all leads; one aggregation sums."""
    means = df.groupBy(series).agg(F.avg(value).alias("_m"))
    rows, w = halo.frames(df.select(series, ts, value), series, ts, 0, nlags, bucket_rows)
    c = rows.join(means, series).withColumn("_c", F.col(value) - F.col("_m"))
    leads = {f"_l{k}": F.lead("_c", k).over(w) for k in range(1, nlags + 1)}
    c = halo.owned(c.withColumns(leads))
    sums = c.groupBy(series).agg(
        F.sum(F.col("_c") * F.col("_c")).alias("_s0"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, nlags + 1)],
    )
    arr = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_s{k}"), F.col("_s0")).alias("acf")) for k in range(0, nlags + 1)])
    return sums.select(series, F.inline(arr))


def durbin_levinson(r: np.ndarray) -> np.ndarray:
    """PACF from autocorrelations r[0..K] (r[0] = 1) by the Durbin-Levinson recursion."""
    k_max = len(r) - 1
    out = np.zeros(k_max + 1)
    out[0] = 1.0
    if k_max == 0:
        return out
    phi = np.zeros(k_max + 1)
    phi[1] = r[1]
    out[1] = r[1]
    for k in range(2, k_max + 1):
        num = r[k] - np.dot(phi[1:k], r[k - 1 : 0 : -1])
        den = 1.0 - np.dot(phi[1:k], r[1:k])
        pkk = num / den if den != 0 else np.nan
        new = phi.copy()
        new[1:k] = phi[1:k] - pkk * phi[k - 1 : 0 : -1]
        new[k] = pkk
        phi = new
        out[k] = pkk
    return out


def ts_pacf(acf: DataFrame, series: str) -> DataFrame:
    """T5: partial autocorrelation (Yule-Walker with the biased autocovariance, i.e. the
    Durbin-Levinson recursion) from T4's output. Each series group holds nlags + 1 numbers."""
    key_type = acf.schema[series].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        p = durbin_levinson(pdf["acf"].to_numpy(dtype=float))
        return pd.DataFrame({series: pdf[series].to_numpy(), "lag": pdf["lag"].to_numpy(), "pacf": p})

    return acf.groupBy(series).applyInPandas(solve, f"{series} {key_type}, lag int, pacf double")


# ---- Augmented Dickey-Fuller ---------------------------------------------------------------

# Fixed values that must equal the published tables: MacKinnon (2010) response surface
# coefficients for the critical values (constant, one variable) at 1 %, 5 %, 10 %, and
# MacKinnon (1994) p-value surface for the same case (tau bounds, small-p and large-p
# polynomial coefficients, already scaled).
ADF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
ADF_TAU_MAX_C, ADF_TAU_MIN_C, ADF_TAU_STAR_C = 2.74, -18.83, -1.61
ADF_SMALLP_C = (2.1659, 1.4412, 0.038269)
ADF_LARGEP_C = (1.7339, 0.93202, -0.12745, -0.010368)


def _norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def adf_pvalue(stat: float) -> float:
    """MacKinnon (1994) approximate p-value, constant-only regression."""
    if stat > ADF_TAU_MAX_C:
        return 1.0
    if stat < ADF_TAU_MIN_C:
        return 0.0
    coef = ADF_SMALLP_C if stat <= ADF_TAU_STAR_C else ADF_LARGEP_C
    return _norm_cdf(sum(c * stat**i for i, c in enumerate(coef)))


def adf_critical_values(nobs: int) -> dict[str, float]:
    return {k: b[0] + b[1] / nobs + b[2] / nobs**2 + b[3] / nobs**3 for k, b in ADF_CRIT_C.items()}


def default_maxlag(n: int) -> int:
    return max(0, min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25))))


def _gram(frame: DataFrame, series: str, ncols: int, extra: Sequence[str] = ()) -> DataFrame:
    """Per series: X'X (upper triangle), X'y, y'y, n over rows of ``_x0.._x{ncols-1}`` and ``_y``."""
    aggs = [F.count(F.lit(1)).alias("_nobs"), F.sum(F.col("_y") * F.col("_y")).alias("_yy")]
    aggs.append(F.array(*[F.sum(F.col(f"_x{a}") * F.col("_y")) for a in range(ncols)]).alias("_xy"))
    aggs.append(
        F.array(*[F.sum(F.col(f"_x{a}") * F.col(f"_x{b}")) for a in range(ncols) for b in range(a, ncols)]).alias("_xx")
    )
    aggs += [F.first(c).alias(c) for c in extra]
    return frame.groupBy(series).agg(*aggs)


def _unpack(xx: np.ndarray, k: int, ncols: int) -> np.ndarray:
    g = np.zeros((ncols, ncols))
    i = 0
    for a in range(ncols):
        for b in range(a, ncols):
            g[a, b] = g[b, a] = xx[i]
            i += 1
    return g[:k, :k]


def adf_statistic(n: float, yy: float, xy: np.ndarray, xx: np.ndarray, noise: float = 1e-12) -> float | None:
    """t of the second coefficient; None where the sums leave no residual or do not determine the coefficient.

    ``noise`` is the share of ``yy`` (and of a column's own square sum) below which a rest is rounding."""
    k = len(xy)
    scale = np.sqrt(np.diag(xx))
    if n <= k or not yy > 0 or (scale <= 0).any():
        return None
    unit = xx / np.outer(scale, scale)
    if np.linalg.eigvalsh(unit)[0] < noise:
        return None
    inv = np.linalg.inv(unit)
    b = inv @ (xy / scale)
    ssr = float(yy - b @ (xy / scale))
    if ssr <= noise * yy:
        return None
    return float(b[1] / math.sqrt(ssr / (n - k) * inv[1, 1]))


def ts_adf(df: DataFrame, series: str, ts: str, value: str, maxlag: int | None = None, bucket_rows: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant and lag order chosen by AIC.

    Per series: ``dy_t = a + b y_{t-1} + sum_i g_i dy_{t-i}``, lags 0..maxlag compared on the common
    sample (as the usual implementation), the chosen order re-fitted on its own longer sample;
    statistic = t of ``b``. Values are standardised per series first (t and the AIC ranking do not
    change) so the Gram sums stay well conditioned. The data is read once: rows with every lag
    available are summed, the few earlier rows of each series travel as vectors, and both the AIC
    search and the refit are solved from those in one small Python step per series.
    Output: statistic, p-value, lags used, observations, critical values, and the verdict at
    p <= 0.05.

    ``maxlag`` bounds the lag columns generated; by default it is the largest per-series
    ``ceil(12 (n/100)^(1/4))`` (one small aggregate read back to size the plan).

    Null values are dropped first. Statistic, p-value, critical values and verdict are null where the test is not
    defined: fewer rows than the regression has columns and one more, or nothing that varies about the fitted line (a
    constant, a straight line, a periodic series that its lags foretell exactly). A series without any value keeps a
    row with 0 observations.
    """
    every = df.select(series).distinct()
    df = df.select(series, ts, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull() & ~F.isnan(value))
    stats = df.groupBy(series).agg(
        F.count(value).alias("_n"), F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd")
    )
    stats = stats.withColumn(
        "_m",
        F.least(
            F.floor(F.col("_n") / 2) - 2,
            F.ceil(F.lit(12.0) * F.pow(F.col("_n") / 100.0, 0.25)),
        ).cast("int"),
    )
    if maxlag is None:
        maxlag = int(stats.agg(F.max("_m")).first()[0] or 0)
    K = max(0, maxlag)
    stats = stats.withColumn("_m", F.greatest(F.lit(0), F.least(F.col("_m"), F.lit(K))))
    rows, w = halo.frames(df, series, ts, K + 1, 0, bucket_rows)
    z = (F.col(value) - F.col("_mu")) / F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0))
    base = rows.join(stats, series).withColumn("_z", z)
    base = base.withColumn("_dz", F.col("_z") - F.lag("_z", 1).over(w)).withColumn("_zl", F.lag("_z", 1).over(w))
    base = halo.owned(base.withColumns({f"_d{i}": F.lag("_dz", i).over(w) for i in range(1, K + 1)}))
    base = halo.position(base, series, ts, "_idx")
    ncols = K + 2
    x_cols = [F.lit(1.0), F.col("_zl")] + [F.col(f"_d{i}") for i in range(1, K + 1)]
    # One pass. Rows with every lag available (idx >= K + 2) are summed into a Gram matrix; the
    # at most K earlier rows of each series are kept as vectors. Any suffix sample idx >= L + 2
    # is then "common sums + the early rows with idx >= L + 2", so the AIC search (sample
    # idx >= m + 2) and the refit (idx >= used + 2) need no second scan.
    common = base.filter(F.col("_idx") >= K + 2).select(
        series, F.col("_dz").alias("_y"), *[c.alias(f"_x{a}") for a, c in enumerate(x_cols)]
    )
    g = _gram(common, series, ncols)
    early = (
        base.filter((F.col("_idx") >= 2) & (F.col("_idx") <= K + 1))
        .groupBy(series)
        .agg(F.collect_list(F.struct("_idx", F.col("_dz").alias("_y"), F.array(*x_cols).alias("_x"))).alias("_early"))
    )
    per = every.join(stats.select(series, "_m"), series, "left").join(g, series, "left").join(early, series, "left")
    key_type = df.schema[series].dataType.simpleString()

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            have = r["_nobs"] is not None and not (isinstance(r["_nobs"], float) and math.isnan(r["_nobs"]))
            m = 0 if r["_m"] is None or pd.isna(r["_m"]) else int(r["_m"])
            g_n = float(r["_nobs"]) if have else 0.0
            g_yy = float(r["_yy"]) if have else 0.0
            g_xy = np.asarray(r["_xy"], dtype=float) if have else np.zeros(ncols)
            g_xx = _unpack(np.asarray(r["_xx"], dtype=float), ncols, ncols) if have else np.zeros((ncols, ncols))
            early_rows = list(r["_early"]) if r["_early"] is not None else []

            def sums(start: int, k: int):
                n, yy, xy, xx = g_n, g_yy, g_xy[:k].copy(), g_xx[:k, :k].copy()
                for e in early_rows:
                    if e["_idx"] >= start:
                        x = np.asarray(e["_x"][:k], dtype=float)
                        y = float(e["_y"])
                        n += 1
                        yy += y * y
                        xy += x * y
                        xx += np.outer(x, x)
                return n, yy, xy, xx

            best = None
            for lag in range(0, m + 1):
                k = lag + 2
                n, yy, xy, xx = sums(m + 2, k)
                if n <= k:
                    break
                b = np.linalg.lstsq(xx, xy, rcond=None)[0]
                ssr = max(float(yy - b @ xy), 1e-300)
                llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1.0)
                aic = -2.0 * llf + 2.0 * k
                if best is None or aic < best[0] - 1e-12 * abs(best[0]):
                    best = (aic, lag)
            used = best[1] if best else 0
            k = used + 2
            n, yy, xy, xx = sums(used + 2, k)
            found = adf_statistic(n, yy, xy, xx)
            if found is None:
                rows.append((r[series], None, None, used, int(n), None, None, None, None))
                continue
            cv, p = adf_critical_values(int(n)), adf_pvalue(found)
            rows.append(
                (r[series], found, p, used, int(n), cv["1%"], cv["5%"], cv["10%"],
                 "stationary" if p <= 0.05 else "non-stationary")
            )
        return pd.DataFrame(
            rows,
            columns=[series, "adf_stat", "p_value", "used_lag", "nobs", "crit_1pct", "crit_5pct", "crit_10pct", "verdict"],
        )

    schema = (
        f"{series} {key_type}, adf_stat double, p_value double, used_lag int, nobs int, "
        "crit_1pct double, crit_5pct double, crit_10pct double, verdict string"
    )
    return per.groupBy(series).applyInPandas(test, schema)
