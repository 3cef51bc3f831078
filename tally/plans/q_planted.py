"""Queries that a constant or a wrong model cannot meet (M5-M10, T8, T9): labels with a planted signal, restated by SQL row
by row, and the conditions that a fitted model's figures meet on the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import ml, regression as reg
from tally.plans.q_ml import _TRAIN_SQL, FEATURES, PRIORITIES, _rfm_scaled, _SCALED, order_features
from tally.plans.q_regress import _DAILY_SQL, daily_revenue
from tally.plans.registry import query
from tally.session import cut_lineage


def planted_orders(t):
    """Order features whose label says: four lines or more and one of the two first priorities."""
    label = ((F.col("n_lines") >= 4) & (F.col("priority_code") <= 1)).cast("int")
    return cut_lineage(order_features(t).withColumn("label", label))


_PLANTED_SQL = f"""
lines as (select l_orderkey, count(*) as n_lines from lineitem group by 1),
held as (
  select o_orderkey, cast(n_lines >= 4 and o_orderpriority in ('{PRIORITIES[0]}', '{PRIORITIES[1]}') as integer) as label
  from orders join lines on l_orderkey = o_orderkey join customer on c_custkey = o_custkey
  where not ({_TRAIN_SQL.format("o_orderkey")}))"""


def _parts(rows):
    return rows.filter("is_train"), rows.filter(~F.col("is_train"))


@query("tree_planted", f"with {_PLANTED_SQL} select o_orderkey, label as prediction from held")
def tree_planted(t):
    """M7: a tree learns the planted rule and predicts every held-out order by it."""
    train, test = _parts(planted_orders(t))
    return ml.clf_tree(train, test, FEATURES, "label").select("o_orderkey", F.col("prediction").cast("int").alias("prediction"))


@query("grid_planted", f"with {_PLANTED_SQL} select o_orderkey, label as prediction from held")
def grid_planted(t):
    """The grid search picks a depth that can express the rule (one cut cannot) and predicts every held-out order."""
    train, test = _parts(planted_orders(t))
    found = ml.clf_grid(train, test, FEATURES, "label", "o_orderkey", depths=(1, 3), min_leaf=(1,), folds=10)
    return found.select("o_orderkey", F.col("prediction").cast("int").alias("prediction"))


@query("forest_planted", f"with {_PLANTED_SQL} select label, count(*) as n, true as nearly_all_right from held group by label")
def forest_planted(t):
    """M8: at least 97 % of either label are predicted right (a constant gets one label wrong altogether)."""
    train, test = _parts(planted_orders(t))
    p = ml.clf_forest(train, test, FEATURES, "label", num_trees=100)
    right = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    return p.groupBy("label").agg(F.count(F.lit(1)).alias("n"), (right >= 0.97).alias("nearly_all_right"))


_LOGISTIC = ["o_totalprice", "priority_code", "c_acctbal", "n_lines", "avg_discount"]


@query(
    "logistic_gradient",
    "select feature, feature = 'o_totalprice' as is_largest, true as gradient_is_zero, feature in ('o_totalprice', 'c_acctbal', 'intercept') as is_strong from (values ('intercept'), "
    + ", ".join(f"('{c}')" for c in _LOGISTIC)
    + ") v(feature)",
)
def logistic_gradient(t):
    """M9: at the fitted coefficients the gradient of the penalised loss vanishes on the training rows, and of a label that
    follows price, less the balance, with a tenth of all labels turned over, the coefficients tell so."""
    f = cut_lineage(ml.standard_scale(order_features(t).filter("is_train"), _LOGISTIC))
    turned = F.substring(F.md5(F.col("o_orderkey").cast("string")), 8, 1) < "2"
    follows = F.col("o_totalprice_scaled") - 0.5 * F.col("c_acctbal_scaled") > 0.3
    rows = cut_lineage(f.withColumn("label", F.when(turned, ~follows).otherwise(follows).cast("int")))
    g = cut_lineage(ml.logistic_gradient(rows, [f"{c}_scaled" for c in _LOGISTIC], "label"))
    size, name = F.abs("coefficient"), F.regexp_replace("feature", "_scaled$", "")
    slopes = g.where("feature <> 'intercept'").agg(F.max(F.struct(F.abs("coefficient"), "feature"))["feature"].alias("top"))
    return g.withColumn("top", slopes.scalar()).select(
        name.alias("feature"), (F.col("feature") == F.col("top")).alias("is_largest"), (F.abs("gradient") < 1e-5).alias("gradient_is_zero"), (size > 0.25).alias("is_strong")
    )


@query("kmeans_fixed_point", "select count(distinct o_custkey) as n_rows, cast(4 as bigint) as n_clusters, cast(0 as bigint) as nearer_elsewhere, cast(0 as bigint) as off_centre from orders")
def kmeans_fixed_point(t):
    """M5: at the end of Lloyd's steps no customer is nearer to another centre, and every centre is its cluster's mean."""
    data = cut_lineage(_rfm_scaled(t))
    found, centres = ml.kmeans_segments(data, _SCALED, k=4, with_centres=True, max_iter=500, tol=0.0)
    found = cut_lineage(found)
    per = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in _SCALED])
    at = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    off = F.lit(False)
    for j, c in enumerate(_SCALED):
        off = off | (F.abs(F.col(c) - F.get(F.get(at, F.col("cluster")), F.lit(j))) > 1e-6)
    means = per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_clusters"), F.count(F.when(off, 1)).alias("off_centre"))
    wrong = found.agg(ml.nearest_centre_violations(found, _SCALED, centres).alias("nearer_elsewhere"))
    return means.select("n_rows", "n_clusters", wrong.scalar().alias("nearer_elsewhere"), "off_centre")


@query(
    "regress_conditions",
    f"with {_DAILY_SQL} select series_id, count(*) as n, cast({reg.N_FEATURES} as integer) as n_equations, cast(0 as integer) as broken from days group by series_id",
)
def regress_conditions(t):
    """The fitted coefficients of every series solve all 28 normal equations on its days."""
    days = cut_lineage(daily_revenue(t))
    return reg.conditions(days, reg.fit(days, "series_id", "ds", "y"), "series_id", "ds", "y")


@query(
    "backtest_last_cutoff",
    f"""with {_DAILY_SQL}, last as (select series_id, max(cutoff) as cutoff from cuts group by 1)
select series_id, cutoff, count(*) as n, true as equals_direct_fit from tested join last using (series_id, cutoff) group by all""",
)
def backtest_last_cutoff(t):
    """The forecasts of each series' last cutoff equal those of a model fitted directly on the days up to it."""
    days = cut_lineage(daily_revenue(t))
    bt = cut_lineage(reg.backtest(days, "series_id", "ds", "y", initial=90, period=15, horizon=30))
    last = bt.groupBy("series_id").agg(F.max("cutoff").alias("cutoff"))
    rows = bt.join(last, ["series_id", "cutoff"]).select("series_id", "cutoff", "ds", "y", "yhat")
    known = days.join(last, "series_id").where("ds <= cutoff").select("series_id", "ds", "y")
    direct = reg.predict(rows.select("series_id", "ds"), reg.fit(known, "series_id", "ds", "y"), "series_id").select("series_id", "ds", F.col("yhat").alias("own"))
    off = F.abs(F.col("yhat") - F.col("own")) > 1e-6 * F.abs("own") + 1e-6 * F.abs("y")
    return rows.join(direct, ["series_id", "ds"]).groupBy("series_id", "cutoff").agg(F.count(F.lit(1)).alias("n"), (F.count(F.when(off, 1)) == 0).alias("equals_direct_fit"))
