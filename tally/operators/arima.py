"""ARIMA(p, d, q) per series by two-stage least squares (Hannan and Rissanen), and its residuals.

The differenced series y follows ``y_t = phi_1 y_{t-1} + .. + e_t + theta_1 e_{t-1} + ..`` without a constant.

1. A long autoregression of order ``long_order`` is fitted to y; its residuals stand in for the unseen e. Of the data
   the fit needs the sums of products of y and its lags alone.
2. y is regressed on its own ``p`` lags and on ``q`` lags of these residuals, again from sums of products.
   Where the moving-average part is not invertible, its roots inside the unit circle are replaced by their inverses
   (``flipped``): the autocorrelations stay the same and the recursion below does not grow.
3. The innovations of the fitted model follow by the recursion ``e_t = y_t - phi.. - theta..`` from zeros. The recursion
   is linear, so a bucket of a series can run from zeros in its own task: what is missing is the effect of the ``q``
   innovations before the bucket, which a small table of one row per bucket hands on.

Both regressions are solved per series from one row of sums. Lags are windows over buckets with a halo, so a series
of any length spreads over tasks (``bucket_rows``).

Defined results: null values are dropped before anything else; a series with too few rows for the second regression, or
one whose sums are singular (constant, straight line), has null coefficients and no residual rows; a null series is a
series; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.quantile import quantiles_wide
from tally.operators import halo
from tally.session import cut_lineage


def _upper(k: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(k) for b in range(a, k)]


def _sums(rows: DataFrame, key: str, x: list[str], y: str) -> DataFrame:
    """Per key: number of rows, y'y, X'y and the upper triangle of X'X, over rows where all are known."""
    known = rows.dropna(subset=[*x, y])
    return known.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(y) * F.col(y)).alias("yy"),
        F.array(*[F.sum(F.col(a) * F.col(y)) for a in x]).alias("xy"),
        F.array(*[F.sum(F.col(x[a]) * F.col(x[b])) for a, b in _upper(len(x))]).alias("xx"),
    )


def _solve(n: float, yy: float, xy, xx, singular: float = 1e-12) -> tuple[np.ndarray, float] | None:
    """Coefficients and residual sum of squares; None where the columns do not determine them."""
    k = len(xy)
    g = np.zeros((k, k))
    for v, (a, b) in zip(xx, _upper(k), strict=True):
        g[a, b] = g[b, a] = v
    scale = np.sqrt(np.diag(g))
    if n <= k or not np.isfinite(g).all() or (scale <= 0).any():
        return None
    unit = g / np.outer(scale, scale)
    if np.linalg.eigvalsh(unit)[0] < singular:
        return None
    beta = np.linalg.solve(unit, np.asarray(xy, float) / scale) / scale
    return beta, max(float(yy - beta @ np.asarray(xy, float)), 0.0)


def _with_lags(rows: DataFrame, w: Window, value: str, n: int, stem: str) -> DataFrame:
    return rows.withColumns({f"{stem}{i}": F.lag(value, i).over(w) for i in range(1, n + 1)})


def invertible(theta: list[float]) -> tuple[list[float], bool]:
    """Coefficients of 1 + theta_1 z + .. with no root inside the unit circle, and whether any was moved out."""
    roots = np.roots([*theta[::-1], 1.0])
    inside = np.abs(roots) < 1
    if not inside.any():
        return list(theta), False
    poly = np.real(np.poly(np.where(inside, 1 / np.conj(roots), roots)))[::-1]  # by rising power
    poly = poly / poly[0]
    return [*poly[1:].tolist(), *([0.0] * (len(theta) - len(roots)))], True


def _fitted(sums: DataFrame, key: str, names: list[str], kind: str) -> DataFrame:
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        got = _solve(float(r["n"]), float(r["yy"]), r["xy"], r["xx"])
        beta, ssr = got if got else ([None] * len(names), None)
        return pd.DataFrame([[r[key], int(r["n"]), *beta, ssr]], columns=[key, "n", *names, "ssr"])

    cols = ", ".join(f"{c} double" for c in names)
    return sums.groupBy(key).applyInPandas(solve, f"`{key}` {kind}, n long, {cols}, ssr double")


def _differenced(df: DataFrame, series: str, ts: str, value: str, d: int, reach: int, bucket_rows: int):
    """Known values as their d-th difference ``_y``, with their halo; also the window."""
    src = df.select(F.col(series).alias("_s"), F.col(ts).alias("_t"), F.col(value).cast("double").alias("_y"))
    src = src.where(F.col("_y").isNotNull() & ~F.isnan("_y"))
    rows, w = halo.frames(src, "_s", "_t", d + reach, 0, bucket_rows)
    for _ in range(d):
        rows = rows.withColumn("_y", F.col("_y") - F.lag("_y", 1).over(w))
    return rows, w


class Arima:
    """A fit of every series: ``coefficients`` (series, n, phi1.., theta1.., sigma) and ``residuals``."""

    def __init__(self, df: DataFrame, series: str, ts: str, value: str, p: int = 1, d: int = 1, q: int = 2, long_order: int | None = None, bucket_rows: int | None = None):
        self.series, self.ts, self.p, self.q = series, ts, p, q
        self.bucket_rows = bucket_rows or halo.BUCKET_ROWS
        m = long_order or 2 * max(p, q, 1)
        if min(p, d, q) < 0 or p + q < 1 or m < p:
            raise ValueError("orders are not negative, p + q is at least 1 and long_order at least p")
        kind = df.schema[series].dataType.simpleString()
        lags = max(m, p)
        rows, w = _differenced(df, series, ts, value, d, lags + q, self.bucket_rows)
        rows = _with_lags(rows, w, "_y", lags, "_y")
        y_lags = [f"_y{i}" for i in range(1, m + 1)]
        # written with its halo, so both regressions and the innovations read one table
        rows = cut_lineage(rows)
        first = _fitted(_sums(halo.owned(rows), "_s", y_lags, "_y"), "_s", [f"a{i}" for i in range(1, m + 1)], kind)
        first = cut_lineage(first.drop("n", "ssr").withColumnRenamed("_s", "_k"))
        e = F.col("_y")
        for i in range(1, m + 1):
            e = e - F.col(f"a{i}") * F.col(f"_y{i}")
        self._rows = rows
        second = rows.join(first, F.col("_s").eqNullSafe(F.col("_k"))).withColumn("_e", e)
        second = _with_lags(second, w, "_e", q, "_e")
        x = [*(f"_y{i}" for i in range(1, p + 1)), *(f"_e{i}" for i in range(1, q + 1))]
        names = [*(f"phi{i}" for i in range(1, p + 1)), *(f"theta{i}" for i in range(1, q + 1))]
        fit = _fitted(_sums(halo.owned(second), "_s", x, "_y"), "_s", names, kind)
        all_series = df.select(F.col(series).alias("_of")).distinct()
        sigma = F.sqrt(F.col("ssr") / (F.col("n") - F.lit(len(x))))
        found = all_series.join(fit, F.col("_of").eqNullSafe(F.col("_s")), "left")
        self.names = names
        raw = found.select(F.col("_of").alias(series), F.coalesce("n", F.lit(0)).cast("long").alias("n"), *names, F.when(F.col("ssr").isNotNull(), sigma).alias("sigma"))

        def turned(batches):
            for pdf in batches:
                flipped = []
                for i in range(len(pdf)):
                    theta = pdf.loc[i, names[p:]].astype(float).tolist()
                    known = not np.isnan(pdf.loc[i, "sigma"])
                    theta, moved = invertible(theta) if known and q else (theta, False)
                    flipped.append(moved if known else None)
                    pdf.loc[i, names[p:]] = theta
                pdf["flipped"] = pd.Series(flipped, dtype="object")
                yield pdf

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields)
        self.coefficients = cut_lineage(raw.mapInPandas(turned, f"{schema}, flipped boolean"))

    def residuals(self) -> DataFrame:
        """(series, ts, resid): the innovations of every differenced row."""
        p, q, names = self.p, self.q, self.names
        known = halo.owned(self._rows).where(F.col("_y").isNotNull())
        coef = self.coefficients.where(F.col("sigma").isNotNull()).select(F.col(self.series).alias("_k"), F.array(*names).alias("_c"))
        rows = known.withColumn("_bucket", F.floor(F.col(halo.G) / self.bucket_rows))
        drive = F.col("_y")
        for i in range(1, p + 1):
            drive = drive - F.get("_c", F.lit(i - 1)) * F.coalesce(F.col(f"_y{i}"), F.lit(0.0))
        theta = F.slice("_c", p + 1, q) if q else F.array().cast("array<double>")
        u = rows.join(coef, F.col("_s").eqNullSafe(F.col("_k"))).select("_s", "_t", "_g", "_bucket", drive.alias("_u"), theta.alias("_theta"))
        if not q:
            return u.select(F.col("_s").alias(self.series), F.col("_t").alias(self.ts), F.col("_u").alias("resid"))
        u = cut_lineage(u)
        kinds = {f.name: f.dataType.simpleString() for f in u.schema.fields}

        def ends(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            """The last innovations of a bucket run from zeros, and what each innovation before it would add to them."""
            u_t = pdf.sort_values("_g")["_u"].to_numpy()
            th = np.asarray(pdf["_theta"].iloc[0], float)
            runs = [recursion(u_t, th, np.zeros(q))] + [recursion(np.zeros(len(u_t)), th, np.eye(q)[i]) for i in range(q)]
            last = [np.concatenate((np.zeros(q) if i == 0 else np.eye(q)[i - 1], r))[-q:] for i, r in enumerate(runs)]
            return pd.DataFrame([[key[0], key[1], last[0].tolist(), np.concatenate(last[1:]).tolist()]], columns=["_s", "_bucket", "_end", "_carry"])

        def states(pdf: pd.DataFrame) -> pd.DataFrame:
            """The innovations before each bucket of one series, in order of the buckets."""
            state, out = np.zeros(q), []
            for r in pdf.sort_values("_bucket").itertuples(index=False):
                out.append([r[0], r[1], state.tolist()])
                state = np.asarray(r[2]) + np.asarray(r[3]).reshape(q, q).T @ state
            return pd.DataFrame(out, columns=["_s", "_bucket", "_state"])

        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_g")
            e = recursion(pdf["_u"].to_numpy(), np.asarray(pdf["_theta"].iloc[0], float), np.asarray(pdf["_state"].iloc[0], float))
            return pd.DataFrame({"_s": pdf["_s"], "_t": pdf["_t"], "resid": e})

        ended = u.groupBy("_s", "_bucket").applyInPandas(ends, f"_s {kinds['_s']}, _bucket long, _end array<double>, _carry array<double>")
        begun = ended.groupBy("_s").applyInPandas(states, f"_s {kinds['_s']}, _bucket long, _state array<double>").select(F.col("_s").alias("_bs"), F.col("_bucket").alias("_bb"), "_state")
        joined = u.join(begun, F.col("_s").eqNullSafe(F.col("_bs")) & (F.col("_bucket") == F.col("_bb"))).drop("_bs", "_bb")
        found = joined.groupBy("_s", "_bucket").applyInPandas(run, f"_s {kinds['_s']}, _t {kinds['_t']}, resid double")
        return found.select(F.col("_s").alias(self.series), F.col("_t").alias(self.ts), "resid")


def recursion(u: np.ndarray, theta: np.ndarray, state: np.ndarray) -> np.ndarray:
    """e_t = u_t - sum_i theta_i e_{t-i}; ``state`` holds the innovations before, the latest last."""
    q = len(theta)
    e = [*state.tolist(), *([0.0] * len(u))]
    th = theta.tolist()
    for t, v in enumerate(u.tolist()):
        for i in range(q):
            v -= th[i] * e[t + q - 1 - i]
        e[t + q] = v if math.isfinite(v) else math.nan
    return np.array(e[q:])


def residual_description(resid: DataFrame, series: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of the residuals of each series (exact quantiles)."""
    base = resid.groupBy(series).agg(
        F.count("resid").alias("count"), F.avg("resid").alias("mean"), F.stddev_samp("resid").alias("std"), F.min("resid").alias("min"), F.max("resid").alias("max")
    )
    wide = quantiles_wide(resid, "resid", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=[series])
    return base.join(wide, series).select(series, "count", "mean", "std", "min", "q25", "q50", "q75", "max")
