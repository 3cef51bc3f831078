"""Windows over buckets with a halo against plain windows; ARIMA by least squares against numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tally.operators import arima, halo, timeseries as tsx


def _hot(spark, n=4000):
    """One series of most rows, some short ones, one of a single row, a null series, null values."""
    rng = np.random.default_rng(5)
    rows = [("hot", i, float(round(v, 3))) for i, v in enumerate(rng.normal(100, 10, n))]
    rows += [(f"s{k}", i, float(k * i % 7 + 1)) for k in range(30) for i in range(k)]
    rows += [("one", 5, 1.5)] + [(None, i, float(i * i % 5)) for i in range(20)]
    rows = [(s, t, None if s == "hot" and t % 501 == 500 else v) for s, t, v in rows]
    rng.shuffle(rows)
    return spark.createDataFrame([(s, int(t), None if v is None else float(v)) for s, t, v in rows], "sid string, t long, x double").repartition(7)


def _same(plain, bucketed, digits=9):
    def norm(df):
        return sorted(str(tuple(round(v, digits) + 0.0 if isinstance(v, float) else v for v in r)) for r in df.collect())

    got, want = norm(bucketed), norm(plain)
    assert len(got) == len(want) and got == want


@pytest.mark.parametrize("bucket_rows", [20, 137, 10**6])
def test_buckets_with_a_halo_equal_plain_windows(spark, bucket_rows):
    df = _hot(spark)
    _same(tsx.ts_rolling(df, "sid", "t", "x", 12), tsx.ts_rolling(df, "sid", "t", "x", 12, bucket_rows=bucket_rows))
    _same(tsx.ts_difference(df, "sid", "t", "x"), tsx.ts_difference(df, "sid", "t", "x", bucket_rows=bucket_rows))
    known = df.where("sid is not null and x is not null")
    _same(tsx.ts_decompose(known, "sid", "t", "x", 12), tsx.ts_decompose(known, "sid", "t", "x", 12, bucket_rows=bucket_rows), 7)
    _same(tsx.ts_acf(known, "sid", "t", "x", 9), tsx.ts_acf(known, "sid", "t", "x", 9, bucket_rows=bucket_rows))
    _same(tsx.ts_durbin_watson(known, "sid", "t", "x"), tsx.ts_durbin_watson(known, "sid", "t", "x", bucket_rows=bucket_rows))
    _same(tsx.ts_adf(known, "sid", "t", "x", 3), tsx.ts_adf(known, "sid", "t", "x", 3, bucket_rows=bucket_rows), 6)


@pytest.mark.parametrize("bucket_rows", [1, 3])
def test_a_halo_may_reach_over_several_buckets(spark, bucket_rows):
    df = _hot(spark, 150)
    _same(tsx.ts_rolling(df, "sid", "t", "x", 12), tsx.ts_rolling(df, "sid", "t", "x", 12, bucket_rows=bucket_rows))


def test_no_bucket_holds_more_than_its_rows_and_halo(spark):
    df = _hot(spark, 12000)
    rows = halo.with_halo(halo.numbered(df, ["sid"], ["t"]), 11, 4, 60)
    sizes = [r["count"] for r in rows.groupBy("_bucket").count().collect()]
    assert len(sizes) > 200 and max(sizes) <= 60 + 11 + 4
    assert rows.where("_own").count() == df.count()
    g = sorted(r["_g"] for r in rows.where("_own").select("_g").collect())
    assert g == list(range(df.count()))


def test_running_sums_and_empty_tables(spark):
    df = _hot(spark, 700).where("x is not null")
    want, total = {}, {}
    for s, t, v in sorted((r["sid"] or "", r["t"], r["x"]) for r in df.collect()):
        total[s] = total.get(s, 0.0) + v
        want[s, t] = total[s]
    got = {(r["sid"] or "", r["t"]): r["cum_x"] for r in halo.running_sum(df, ["sid"], ["t"], ["x"], bucket_rows=50).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    none = df.limit(0)
    assert halo.running_sum(none, ["sid"], ["t"], ["x"]).count() == 0
    assert tsx.ts_rolling(none, "sid", "t", "x", 3, bucket_rows=5).count() == 0
    assert arima.Arima(none, "sid", "t", "x").residuals().count() == 0


def test_adf_of_awkward_series(spark):
    n = 60
    rng = np.random.default_rng(2)
    series = {
        "one": [3.0],
        "two": [1.0, 2.0],
        "three": [1.0, 5.0, 2.0],
        "nulls": [None] * 9,
        "constant": [4.0] * n,
        "line": [2.0 * i + 1 for i in range(n)],
        "periodic": [float(i % 2) for i in range(n)],
        "gaps": [None if i % 10 == 3 else float(v) for i, v in enumerate(rng.normal(size=n))],
        "sound": np.cumsum(rng.normal(size=n)).tolist(),
    }
    rows = [(s, i, v) for s, vs in series.items() for i, v in enumerate(vs)]
    got = {r["sid"]: r for r in tsx.ts_adf(spark.createDataFrame(rows, "sid string, t int, x double"), "sid", "t", "x").collect()}
    assert got.keys() == series.keys()
    for s in ("one", "two", "three", "nulls", "constant", "line", "periodic"):
        assert got[s]["adf_stat"] is None and got[s]["p_value"] is None and got[s]["verdict"] is None, s
    alone = [(i, v) for i, v in enumerate(series["gaps"]) if v is not None]
    sound = tsx.ts_adf(spark.createDataFrame([("gaps", i, v) for i, v in alone], "sid string, t int, x double"), "sid", "t", "x").first()
    assert got["gaps"]["adf_stat"] == pytest.approx(sound["adf_stat"]) and got["gaps"]["verdict"] == "stationary"
    assert got["sound"]["adf_stat"] is not None


def _arima_np(x, p, d, q, m):
    y = np.diff(x, d)
    at = np.arange(m, len(y))
    long = np.stack([y[at - i] for i in range(1, m + 1)], axis=1)
    a = np.linalg.lstsq(long, y[at], rcond=None)[0]
    e = np.full(len(y), np.nan)
    e[at] = y[at] - long @ a
    at = np.arange(m + q, len(y))
    cols = np.stack([y[at - i] for i in range(1, p + 1)] + [e[at - i] for i in range(1, q + 1)], axis=1)
    b = np.linalg.lstsq(cols, y[at], rcond=None)[0]
    return y, b, math.sqrt(((y[at] - cols @ b) ** 2).sum() / (len(at) - p - q))


def test_arima_by_numpy_and_its_planted_orders(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=6002)
    y = np.zeros(6000)
    for t in range(6000):
        y[t] = (0.6 * y[t - 1] if t else 0.0) + e[t + 2] + 0.5 * e[t + 1] + 0.2 * e[t]
    series = {"planted": np.cumsum(y), "short": np.cumsum(rng.normal(size=40))}
    rows = [(s, i, float(v), "k") for s, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["sid", "t", "x", "_y"]))
    fit = arima.Arima(df, "sid", "t", "x", 1, 1, 2, long_order=12, bucket_rows=97)
    got = {r["sid"]: r for r in fit.coefficients.collect()}
    resid = {}
    for r in fit.residuals().collect():
        resid.setdefault(r["sid"], {})[r["t"]] = r["resid"]
    for s, x in series.items():
        y, b, sigma = _arima_np(x, 1, 1, 2, 12)
        r = got[s]
        assert not r["flipped"] and np.allclose([r["phi1"], r["theta1"], r["theta2"]], b, atol=1e-8) and r["sigma"] == pytest.approx(sigma)
        u = y - b[0] * np.concatenate(([0.0], y[:-1]))
        want = arima.recursion(u, b[1:], np.zeros(2))
        assert sorted(resid[s]) == list(range(1, len(x))) and np.allclose([resid[s][t] for t in range(1, len(x))], want, atol=1e-6)
    r = got["planted"]
    assert np.allclose([r["phi1"], r["theta1"], r["theta2"], r["sigma"]], [0.6, 0.5, 0.2, 1.0], atol=0.08)
    d = arima.residual_description(fit.residuals().where("sid = 'planted'"), "sid").first()
    x = np.array(list(resid["planted"].values()))
    assert d["count"] == len(x) and np.allclose([d["mean"], d["std"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]], [x.mean(), x.std(ddof=1), x.min(), *np.quantile(x, [0.25, 0.5, 0.75]), x.max()])


def test_arima_of_awkward_series(spark):
    series = {"one": [1.0], "few": [1.0, 4.0, 2.0, 8.0], "constant": [5.0] * 50, "line": [3.0 * i for i in range(50)], "nulls": [None] * 20}
    rows = [(s, i, v) for s, vs in series.items() for i, v in enumerate(vs)]
    fit = arima.Arima(spark.createDataFrame(rows, "sid string, t int, x double"), "sid", "t", "x")
    got = {r["sid"]: r for r in fit.coefficients.collect()}
    assert got.keys() == series.keys() and all(r["phi1"] is None and r["sigma"] is None for r in got.values())
    assert fit.residuals().count() == 0


def test_roots_inside_the_unit_circle_are_inverted():
    for theta in ([2.0], [0.5], [1.5, 4.0], [0.3, 0.1], [-2.5, 1.0], [0.0, 3.0]):
        turned, moved = arima.invertible(theta)
        assert (np.abs(np.roots([*turned[::-1], 1.0])) >= 1 - 1e-9).all() and moved == (np.abs(np.roots([*theta[::-1], 1.0])) < 1).any()

        def correlations(c):
            c = np.array([1.0, *c])
            return np.correlate(c, c, "full") / (c @ c)

        assert np.allclose(correlations(theta), correlations(turned))
