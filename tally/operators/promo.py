"""Promotion features.

The reference crosses every promotion with every calendar month (a cross join on a constant
key, i.e. one hot key) and then keeps month groups with promo days. Here each promotion is
exploded only into the months it is active in - ``sequence`` from its quirky month start to its
end, clipped to the calendar - so the work is proportional to promotion-months, not
promotions x calendar. Groups without any active promotion are exactly the ones the reference
drops (their promo days are 0), so the results are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions import scalar as X

# Fixed values that must equal the reference: the scope label written for brand promotions
# restricted to a category (spelling as in the reference), and the lead feature names.
SUB_CATEGORY_SCOPE = "sub_cateogry"
PROMO_MEASURES = ("schemes", "avg_discount_amount", "avg_discount_percentage", "max_days_of_promo", "avg_days_of_promo")
LEADS = (0, 1, 2)

GROUP = [
    "promo_warehouse",
    "apply_on",
    "apply_on_custom",
    "er_category_to_apply_on",
    "promo_brand",
    "promo_item_sub_category",
    "promo_item_code",
]


def promo_scope(promos: DataFrame) -> DataFrame:
    """Scope columns of each promotion row.

    ``apply_on_custom`` is the category scope when a brand promotion names a category.
    ``promo_brand`` is the brand for every brand-scope promotion (the reference left it empty for
    a brand promotion without category, so its brand join found nothing: Q6, fixed here).
    Rows are dealt out by scope and name, so that they stay where they are for all that is counted per name.
    """
    cat_set = F.coalesce(F.col("er_category_to_apply_on"), F.lit("")) != ""
    brand_scope = F.col("apply_on") == "Brand"
    return promos.select(
        F.col("warehouse").alias("promo_warehouse"),
        "apply_on",
        F.when(brand_scope & cat_set, F.lit(SUB_CATEGORY_SCOPE)).otherwise(F.col("apply_on")).alias("apply_on_custom"),
        "er_category_to_apply_on",
        F.when(brand_scope, F.col("brand")).otherwise(F.lit("")).alias("promo_brand"),
        F.when(brand_scope & cat_set, F.col("er_category_to_apply_on")).otherwise(F.lit("")).alias("promo_item_sub_category"),
        F.when(F.col("apply_on") != "Brand", F.col("item_code")).otherwise(F.lit("")).alias("promo_item_code"),
        "name",
        "valid_from",
        "valid_upto",
        "discount_percentage",
        "discount_amount",
    ).repartition(*GROUP, "name").distinct()


def promo_months(
    promos: DataFrame,
    items: DataFrame,
    calendar_start: Column,
    calendar_end: Column,
) -> DataFrame:
    """Promotion measures per month and scope, then regrouped by item linkage.

    ``promos``: warehouse, apply_on, er_category_to_apply_on, brand, item_code, name, valid_from,
    valid_upto, discount_percentage, discount_amount. ``items``: item_code, item_linkage
    (active items). The calendar covers the months of ``[calendar_start, calendar_end]``.

    A promotion is active in month M when ``M`` lies between its quirky month start (X21, Q4) and
    its end; open-ended promotions pass the filter but are never active (Q5).
    """
    scoped = promo_scope(promos).filter(F.col("valid_upto").isNull() | (F.col("valid_upto") >= calendar_start))
    cal_lo, cal_hi = F.trunc(calendar_start, "MM"), F.trunc(calendar_end, "MM")
    lo = F.greatest(X.month_start_quirk("valid_from"), cal_lo)
    hi = F.least(F.trunc("valid_upto", "MM"), cal_hi)
    # a condition inside the sequence, not a filter: a filter would move below the exchange of ``promo_scope`` and make another
    # exchange of it, where now all readers of ``scoped`` share one
    runs = F.when(F.col("valid_upto").isNotNull() & (lo <= hi), F.sequence(lo, hi, F.expr("interval 1 month")))
    active = scoped.withColumn("month", F.explode_outer(runs)).filter(F.col("month").isNotNull())
    days = X.overlap_days("month", F.last_day("month"), "valid_from", "valid_upto")
    # one row per month, scope and name, made where the promotions lie; a month's names are then counted without ``distinct``,
    # so only sums per month and scope are shuffled
    names = active.groupBy("month", *GROUP, "name").agg(
        F.sum("discount_amount").alias("_amount"),
        F.count("discount_amount").alias("_amounts"),
        F.max(days).alias("_max_days"),
        F.count(F.lit(1)).alias("_active"),
    )
    per = names.groupBy("month", *GROUP).agg(
        F.count("name").alias("schemes"),
        F.try_divide(F.sum("_amount"), F.sum("_amounts")).alias("avg_discount_amount"),
        F.max("_max_days").alias("_max_days"),
        F.sum("_active").alias("_active"),
    )
    percent = active.groupBy("month", *GROUP).agg(F.expr("avg(distinct discount_percentage)").alias("avg_discount_percentage"))
    percent = percent.select(F.col("month").alias("_g_month"), *[F.col(c).alias(f"_g_{c}") for c in GROUP], "avg_discount_percentage")
    same = [per[c].eqNullSafe(percent[f"_g_{c}"]) for c in ["month", *GROUP]]
    per = per.join(percent, same).drop("_g_month", *[f"_g_{c}" for c in GROUP])
    # The reference's max also sees a 0 from every inactive promotion row of the group; that matters only when all
    # active rows have negative days, which takes a reversed range. So only groups with such a row are counted and
    # joined (null-safe: GROUP BY groups nulls together).
    odd = F.coalesce(F.col("valid_upto") < F.col("valid_from"), F.lit(False))
    rows = (
        scoped.groupBy(*GROUP)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max(odd).alias("_odd"))
        .filter("_odd")
        .select(*[F.col(c).alias(f"_h_{c}") for c in GROUP], "_rows")
    )
    per = per.join(rows, [per[c].eqNullSafe(rows[f"_h_{c}"]) for c in GROUP], "left").drop(*[f"_h_{c}" for c in GROUP])
    per = per.withColumn(
        "days_of_promo",
        F.when(F.col("_active") < F.col("_rows"), F.greatest("_max_days", F.lit(0))).otherwise(F.col("_max_days")),
    )
    kept = per.filter(F.col("days_of_promo") != 0)
    it = items.select(F.col("item_code").alias("promo_item_code"), "item_linkage")
    j = kept.join(it, "promo_item_code", "left")
    out_keys = ["promo_warehouse", "apply_on", "apply_on_custom", "er_category_to_apply_on", "promo_brand", "promo_item_sub_category", "item_linkage", "month"]
    return j.groupBy(*out_keys).agg(
        F.avg("schemes").alias("schemes"),
        F.avg("avg_discount_amount").alias("avg_discount_amount"),
        F.avg("avg_discount_percentage").alias("avg_discount_percentage"),
        F.max("days_of_promo").alias("max_days_of_promo"),
        F.avg("days_of_promo").alias("avg_days_of_promo"),
    ).select(
        "month",
        "promo_warehouse",
        F.col("apply_on_custom").alias("apply_on"),
        "promo_brand",
        "promo_item_sub_category",
        "item_linkage",
        "schemes",
        "avg_discount_amount",
        "avg_discount_percentage",
        "max_days_of_promo",
        "avg_days_of_promo",
    )


def location_key(city: str = "city", global_id: str = "global_id", centre: str = "replenishment_center") -> Column:
    """``city~global_id~centre``, null when any part is null (``concat``, not ``concat_ws``)."""
    return F.concat(F.col(city), F.lit("~"), F.col(global_id), F.lit("~"), F.col(centre))


def level_key() -> Column:
    """What a feature row is joined by at the level of its scope: brand, sub-category or item linkage."""
    scope = F.col("apply_on")
    return F.when(scope == "Brand", F.col("promo_brand")).when(scope == SUB_CATEGORY_SCOPE, F.col("promo_item_sub_category")).otherwise(F.col("item_linkage"))


def promo_features(
    months: DataFrame,
    hierarchy: DataFrame,
    strict_keys: bool = False,
    level: str | None = None,
) -> DataFrame:
    """B9 + W2: promotions moved to locations, regrouped, with leads 0-2 of five measures.

    Leads follow rows in month order within a key (not calendar months: a gap shifts, Q8) and a
    missing lead is 0. The key ``location|sub-category|linkage|brand|scope`` is null when a part is
    null (most brand promotions have no linkage, Q3): by default the window groups by the
    columns (nulls form a group); ``strict_keys=True`` reproduces the reference, where null-key
    rows keep their own value at lead 0 and get 0 at leads 1 and 2.

    Rows are dealt out once, by (location, scope, ``level_key``): every key lies in one of these, so the groups, the leads
    and a join by the three need no further shuffle. ``level`` names a column for that key, to join by.
    """
    own = level or "_level"
    loc = months.join(hierarchy, months.promo_warehouse == hierarchy.higher_hier_warehouse, "left").withColumn(
        "location", location_key()
    ).filter(F.col("location").isNotNull())
    loc = loc.withColumn(own, level_key()).repartition("location", "apply_on", own)
    keys = ["location", "promo_item_sub_category", "item_linkage", "promo_brand", "apply_on"]
    g = loc.groupBy("location", "month", "promo_item_sub_category", "item_linkage", "promo_brand", "apply_on", own).agg(
        F.sum("schemes").alias("schemes"),
        F.avg("avg_discount_amount").alias("avg_discount_amount"),
        F.avg("avg_discount_percentage").alias("avg_discount_percentage"),
        F.max("max_days_of_promo").alias("max_days_of_promo"),
        F.avg("avg_days_of_promo").alias("avg_days_of_promo"),
    )
    key = F.concat_ws("|", *[F.col(k) for k in keys])
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    g = g.withColumn("key", F.when(~null_key, key))
    w = Window.partitionBy(*keys, own).orderBy("month")
    cols = {}
    for m in PROMO_MEASURES:
        for n in LEADS:
            v = F.col(m) if n == 0 else F.lead(m, n).over(w)
            if strict_keys and n > 0:
                v = F.when(null_key, F.lit(None)).otherwise(v)
            cols[f"{m}_lead_{n}"] = F.coalesce(v.cast("double"), F.lit(0.0))
    out = g.withColumns(cols)
    return out if level else out.drop(own)
