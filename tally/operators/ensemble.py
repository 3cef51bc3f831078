"""Ensemble weights, blending, publishing and run bookkeeping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's published layout: the 13 forecast columns in
# order, and the stamped constants.
PUBLISH_COLUMNS = (
    "frequency", "forecast", "model_version", "product", "application", "location", "model_type",
    "forecast_create_period", "forecast_target_period", "create_timestamp", "level", "modified", "active",
)
LEVEL = "Warehouse Item Linkage"
FREQUENCY = "Monthly"
LOCAL_ZONE = "Asia/Kolkata"
KEYS = ["location", "product", "forecast_create_period", "forecast_target_period"]


def split_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """``location|product`` split on the first ``|`` only."""
    parts = F.split(F.col(id_col), r"\|", 2)
    return df.withColumns({"location": parts[0], "product": F.element_at(parts, 2)})


def ensemble_weights(backtest: DataFrame, id_col: str, models: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """Per id, weight of each model proportional to 1 / (backtest wmape + eps); weights sum
    to 1. ``backtest`` has ``actual`` and ``<model>_prediction`` columns."""
    # an id whose actuals sum to 0 has no wmape: its weights stay null (filled at blend time)
    inv = {
        m: F.try_divide(
            F.lit(1.0),
            F.try_divide(F.sum(F.abs(F.col("actual") - F.col(f"{m}_prediction"))), F.sum(F.col("actual"))) + F.lit(eps),
        )
        for m in models
    }
    total = None
    for m in models:
        total = inv[m] if total is None else total + inv[m]
    return backtest.groupBy(id_col).agg(*[F.try_divide(inv[m], total).alias(f"weight_{m}_prediction") for m in models])


def ensemble_blend(
    forecasts: Mapping[str, DataFrame],
    weights: DataFrame,
    id_col: str = "id",
    normalize: bool = False,
) -> DataFrame:
    """Inner join of the model forecasts on the four keys, left join of the weights by id;
    a missing weight takes the column mean over the joined rows (P10, a scalar subquery), then
    1 for the first model and 0 otherwise; forecast = sum prediction x weight, not divided by the
    weight sum (Q12) unless ``normalize``. Only ``<m>_prediction`` columns with a matching
    ``weight_<m>_prediction`` count (P17)."""
    joined = None
    for m, f in forecasts.items():
        f = split_id(f, id_col).select(*KEYS, F.col("forecast").alias(f"{m}_prediction"))
        joined = f if joined is None else joined.join(f, KEYS, "inner")
    joined = joined.withColumn(id_col, F.concat_ws("|", "location", "product"))
    merged = joined.join(weights, id_col, "left")
    preds = [c for c in merged.columns if c.endswith("_prediction") and not c.startswith("weight_")]
    wcols = [c for c in merged.columns if c.startswith("weight_")]
    means = merged.agg(F.struct(*[F.avg(c).alias(c) for c in wcols]).alias("m")).scalar()
    first_model = f"weight_{next(iter(forecasts))}_prediction"
    fills = {}
    for c in wcols:
        v = F.coalesce(F.col(c), means[c])
        fills[c] = F.coalesce(v, F.lit(1.0 if c == first_model else 0.0))
    merged = merged.withColumns(fills).fillna(0.0, subset=preds)
    fc, sw = F.lit(0.0), F.lit(0.0)
    for p in preds:
        wc = f"weight_{p}"
        if wc in merged.columns:
            fc = fc + F.col(p) * F.col(wc)
            sw = sw + F.col(wc)
    out = merged.withColumn("forecast", F.try_divide(fc, sw) if normalize else fc).withColumn("sum_weight", sw)
    return out


def run_id(model_type: str, version: str, stamp: Column) -> Column:
    """``type_version_timestamp``."""
    return F.concat_ws("_", F.lit(model_type), F.lit(version), F.date_format(stamp, "yyyy-MM-dd-HH_mm_ss"))


def publish_rows(
    frames: Mapping[str, DataFrame],
    application: str,
    versions: Mapping[str, str],
    run_utc: Column,
) -> DataFrame:
    """B15 + O6 + P7 + X31: stamp each model's rows and union them into the 13-column layout.

    ``run_utc`` is the run's UTC time (an argument, never ``now()``); stamps are local time.
    The forecast is cast to DECIMAL(18,6) as in the published table.
    """
    local = F.from_utc_timestamp(run_utc, LOCAL_ZONE).cast("timestamp_ntz")
    out = None
    for model, f in frames.items():
        stamped = f.select(
            F.lit(FREQUENCY).alias("frequency"),
            F.col("forecast").cast("decimal(18,6)").alias("forecast"),
            run_id(model, versions[model], local).alias("model_version"),
            "product",
            F.lit(application).alias("application"),
            "location",
            F.lit(model).alias("model_type"),
            F.to_date("forecast_create_period").alias("forecast_create_period"),
            F.to_date("forecast_target_period").alias("forecast_target_period"),
            local.alias("create_timestamp"),
            F.lit(LEVEL).alias("level"),
            local.alias("modified"),
            F.lit(1).cast("int").alias("active"),
        )
        out = stamped if out is None else out.unionByName(stamped)
    return out


def active_run(published: DataFrame) -> DataFrame:
    """B16 + K5: ``active`` derived on read: 1 for rows of the newest ``create_timestamp`` per
    (create period, application), else 0. The per-period maxima are a small aggregate joined
    back (a window partitioned by period would put a whole period in one task)."""
    newest = published.groupBy("forecast_create_period", "application").agg(
        F.max("create_timestamp").alias("_newest")
    )
    j = published.drop("active").join(newest, ["forecast_create_period", "application"], "left")
    return j.withColumn("active", (F.col("create_timestamp") == F.col("_newest")).cast("int")).drop("_newest")


def forecast_totals(published: DataFrame) -> DataFrame:
    """Control totals per target period and model."""
    return published.groupBy("forecast_target_period", "model_type").agg(
        F.sum("forecast").alias("forecast_sum"), F.count(F.lit(1)).alias("record_count")
    )


def plan_vs_forecast(
    published: DataFrame,
    linkage: DataFrame,
    targets: DataFrame,
    application: str,
    period: Column,
) -> DataFrame:
    """B18 + J12 + J13 + A9: active ensemble forecast per planning link for one period next to
    the plan target (text, ``''`` counts as 0), plus a grand-total row (``planning_linkage`` null).

    ``linkage``: item_linkage, planning_linkage, active. ``targets``: planning_linkage, final_target.
    """
    link = linkage.filter(F.col("active") == 1).select("item_linkage", "planning_linkage")
    fc = (
        published.filter(
            (F.col("active") == 1)
            & (F.col("application") == application)
            & (F.col("model_type") == "ensemble")
            & (F.col("forecast_create_period") == period)
            & (F.col("forecast_target_period") == period)
        )
        .join(link, F.col("product") == F.col("item_linkage"))
        .groupBy(F.coalesce("planning_linkage", "item_linkage").alias("planning_linkage"))
        .agg(F.sum(F.col("forecast").cast("double")).alias("forecast_sum"))
    )
    tg = targets.groupBy("planning_linkage").agg(
        F.sum(F.when(F.col("final_target") == "", F.lit(0.0)).otherwise(F.col("final_target").try_cast("double"))).alias(
            "target_sum"
        )
    )
    cmp_ = tg.join(fc, "planning_linkage", "inner")
    total = cmp_.agg(F.sum("target_sum").alias("target_sum"), F.sum("forecast_sum").alias("forecast_sum")).select(
        F.lit(None).cast("string").alias("planning_linkage"), "target_sum", "forecast_sum"
    )
    return cmp_.select("planning_linkage", "target_sum", "forecast_sum").unionByName(total)
