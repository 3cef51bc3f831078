import math

import numpy as np
import pandas as pd

from tally.operators import timeseries as tsx


def _series_frame(spark, values_by_series):
    rows = []
    for sid, vals in values_by_series.items():
        for i, v in enumerate(vals):
            rows.append((sid, i, float(v)))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["sid", "t", "x"]))


def _acf_np(x, k):
    x = np.asarray(x, float)
    c = x - x.mean()
    den = (c * c).sum()
    return np.array([(c[: len(c) - j] * c[j:]).sum() / den for j in range(k + 1)])


def test_acf_and_pacf_match_numpy(spark):
    rng = np.random.default_rng(3)
    a = np.cumsum(rng.normal(size=60)) + 5
    b = np.sin(np.arange(50) / 3.0) * 10 + rng.normal(size=50)
    df = _series_frame(spark, {"a": a, "b": b})
    acf = tsx.ts_acf(df, "sid", "t", "x", nlags=10)
    got = acf.toPandas()
    pacf = tsx.ts_pacf(acf, "sid").toPandas()
    for sid, x in (("a", a), ("b", b)):
        r = _acf_np(x, 10)
        g = got[got.sid == sid].sort_values("lag")["acf"].to_numpy()
        assert np.allclose(g, r, atol=1e-12)
        # Yule-Walker: solve the Toeplitz system of each order, last coefficient is the PACF
        p = pacf[pacf.sid == sid].sort_values("lag")["pacf"].to_numpy()
        assert p[0] == 1.0
        for k in range(1, 11):
            toe = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            phi = np.linalg.solve(toe, r[1 : k + 1])
            assert abs(phi[-1] - p[k]) < 1e-9


def _ols(y, X):
    b, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ b
    return b, resid


def _adf_np(x):
    """The usual ADF procedure on raw values: common sample for the AIC search, refit."""
    x = np.asarray(x, float)
    n = len(x)
    maxlag = min(n // 2 - 2, int(math.ceil(12 * (n / 100) ** 0.25)))
    dx = np.diff(x)

    def design(lag):
        nobs = n - 1 - lag
        rows = []
        for t in range(lag, n - 1):
            rows.append([1.0, x[t]] + [dx[t - i] for i in range(1, lag + 1)])
        return np.array(rows), dx[lag:], nobs

    best = None
    Xfull, y, nobs = design(maxlag)
    for lag in range(0, maxlag + 1):
        X = Xfull[:, : lag + 2]
        b, res = _ols(y, X)
        ssr = (res**2).sum()
        llf = -nobs / 2 * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1)
        aic = -2 * llf + 2 * (lag + 2)
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = best[1]
    X, y, nobs = design(lag)
    b, res = _ols(y, X)
    s2 = (res**2).sum() / (nobs - X.shape[1])
    cov = s2 * np.linalg.inv(X.T @ X)
    return b[1] / math.sqrt(cov[1, 1]), lag, nobs


def test_adf_matches_direct_regression(spark):
    rng = np.random.default_rng(7)
    walk = np.cumsum(rng.normal(size=120)) * 1e6 + 5e7  # large level: checks the scaling
    ar = np.zeros(90)
    for i in range(1, 90):
        ar[i] = 0.3 * ar[i - 1] + rng.normal()
    df = _series_frame(spark, {"walk": walk, "ar": ar})
    got = tsx.ts_adf(df, "sid", "t", "x").toPandas().set_index("sid")
    for sid, x in (("walk", walk), ("ar", ar)):
        stat, lag, nobs = _adf_np(x)
        assert got.loc[sid, "used_lag"] == lag
        assert got.loc[sid, "nobs"] == nobs
        assert abs(got.loc[sid, "adf_stat"] - stat) < 1e-6 * max(1, abs(stat))
    assert got.loc["ar", "verdict"] == "stationary"
    assert got.loc["walk", "p_value"] > 0.05


def test_adf_pvalue_surface_is_monotone():
    ps = [tsx.adf_pvalue(s) for s in np.linspace(-6, 2, 50)]
    assert all(a <= b + 1e-12 for a, b in zip(ps, ps[1:]))
    assert tsx.adf_pvalue(-20) == 0.0 and tsx.adf_pvalue(3) == 1.0
    cv = tsx.adf_critical_values(100)
    assert cv["1%"] < cv["5%"] < cv["10%"] < 0


def test_decompose_adds_up_and_durbin_watson(spark):
    rng = np.random.default_rng(1)
    n = 48
    x = 100 + np.arange(n) + 10 * np.sin(np.arange(n) * 2 * np.pi / 12) + rng.normal(size=n)
    df = _series_frame(spark, {"s": x})
    d = tsx.ts_decompose(df, "sid", "t", "x", period=12).toPandas().sort_values("t")
    full = d.dropna()
    assert np.allclose(full.trend + full.seasonal + full.resid, full.x)
    # trend = 2x12 centred moving average
    w = np.r_[0.5, np.ones(11), 0.5] / 12
    assert np.allclose(full.trend.to_numpy(), np.convolve(x, w, mode="valid"))
    dw = tsx.ts_durbin_watson(df, "sid", "t", "x").first()["durbin_watson"]
    assert abs(dw - (np.diff(x) ** 2).sum() / (x**2).sum()) < 1e-12
