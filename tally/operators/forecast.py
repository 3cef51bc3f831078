"""Moving-average forecasting over a monthly panel.

The reference's ``ma``/``metrics``/``data_preprocessing`` modules are not in its tree; only their
call sites are. The definitions here are ours (see SURVEY section 2.12): a dense month spine per
series with missing sales = 0; an MA(w) forecast is the mean of the w complete months before
the target month; wmape = sum|a - f| / sum a * 100 and bias_pct = sum(f - a) / sum a * 100.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MA_WINDOWS = (2, 3, 4, 5, 6)


def panel_spine(df: DataFrame, series: str, month: str, value: str) -> DataFrame:
    """Every month between each series' first and last month; missing value = 0.

    The spine is generated per series from its bounds (``sequence`` + ``explode``) and joined to
    the observed months on (series, month): no calendar cross join."""
    obs = df.groupBy(series, F.trunc(month, "MM").alias("month")).agg(F.sum(value).alias("_v"))
    bounds = obs.groupBy(series).agg(F.min("month").alias("_first"), F.max("month").alias("_last"))
    spine = bounds.select(series, F.explode(F.sequence("_first", "_last", F.expr("interval 1 month"))).alias("month"))
    return spine.join(obs, [series, "month"], "left").select(series, "month", F.coalesce("_v", F.lit(0)).alias(value))


def panel_metadata(spine: DataFrame, series: str, value: str) -> DataFrame:
    """R1 metadata: first / last month, months, share of zero months per series."""
    return spine.groupBy(series).agg(
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.count(F.lit(1)).alias("months"),
        (F.count(F.when(F.col(value) == 0, 1)) / F.count(F.lit(1))).alias("zero_share"),
    )


def ma_backtest(
    spine: DataFrame, series: str, value: str, start: Column, end: Column, windows: Sequence[int] = MA_WINDOWS
) -> DataFrame:
    """R2: for every window w and month m in ``[start, end]`` the MA(w) forecast of m made from
    the w months before it (null when fewer exist) next to the actual. One window pass computes
    all w; the long form comes from ``stack``."""
    w = Window.partitionBy(series).orderBy("month")
    cols = {}
    for k in windows:
        frame = w.rowsBetween(-k, -1)
        cols[f"_f{k}"] = F.when(F.count(F.col(value)).over(frame) == k, F.avg(F.col(value).cast("double")).over(frame))
    wide = spine.withColumns(cols).filter(F.col("month").between(start, end))
    parts = ", ".join(f"{k}, _f{k}" for k in windows)
    return wide.selectExpr(
        series, "month", f"cast({value} as double) as actual", f"stack({len(windows)}, {parts}) as (ma_window, forecast)"
    ).filter(F.col("forecast").isNotNull())


def accuracy(df: DataFrame, keys: Sequence[str], actual: str = "actual", forecast: str = "forecast") -> DataFrame:
    """Wmape and bias (percent of the actual total) per key."""
    a, f = F.col(actual), F.col(forecast)
    return df.groupBy(*keys).agg(
        (F.try_divide(F.sum(F.abs(a - f)), F.sum(a)) * 100).alias("wmape"),
        (F.try_divide(F.sum(f - a), F.sum(a)) * 100).alias("bias_pct"),
    )


def best_window(metrics: DataFrame) -> DataFrame:
    """B13 + F9: the window with the smallest wmape + |bias_pct| (smallest window on ties)."""
    score = F.col("wmape") + F.abs(F.col("bias_pct"))
    return metrics.agg(F.min_by("ma_window", F.struct(score, F.col("ma_window"))).alias("ma_window"))


def ma_forecast(
    spine: DataFrame, series: str, value: str, window: Column, create: Column, horizon: int = 3
) -> DataFrame:
    """Mean of the ``window`` months before ``create`` (a Column, e.g. a scalar subquery),
    repeated for each of the ``horizon`` target months from ``create`` on."""
    hist = spine.filter((F.col("month") < create) & (F.col("month") >= F.add_months(create, -window)))
    fc = hist.groupBy(series).agg((F.sum(F.col(value).cast("double")) / window).alias("forecast"))
    return fc.select(
        series,
        create.alias("forecast_create_period"),
        F.explode(F.sequence(create, F.add_months(create, horizon - 1), F.expr("interval 1 month"))).alias(
            "forecast_target_period"
        ),
        "forecast",
    )


def seasonal_naive(spine: DataFrame, series: str, value: str, create: Column, horizon: int = 3, season: int = 12) -> DataFrame:
    """Forecast of each target month = the value ``season`` months before it (0 when absent).
    Stands in for the reference's unnamed ML model, whose output frame is only an input here."""
    targets = spine.select(series).distinct().select(
        series,
        F.explode(F.sequence(create, F.add_months(create, horizon - 1), F.expr("interval 1 month"))).alias(
            "forecast_target_period"
        ),
    )
    past = spine.select(
        series, F.add_months("month", season).alias("forecast_target_period"), F.col(value).cast("double").alias("_v")
    )
    return targets.join(past, [series, "forecast_target_period"], "left").select(
        series,
        create.alias("forecast_create_period"),
        "forecast_target_period",
        F.coalesce("_v", F.lit(0.0)).alias("forecast"),
    )
