"""The training table - monthly panel with promotion leads, item variant and seasonality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import clean, dims, promo, seasonality as season
from tally.plans import q_dims, q_promo
from tally.plans.registry import query
from tally.session import cut_lineage

LEAD_COLS = [f"{m}_lead_{n}" for m in promo.PROMO_MEASURES for n in promo.LEADS]
STATUS_COLS = [f"{m}_seasonality_status" for m in season.MONTHS]


def _located_sales(t):
    wh, prof, _ = q_dims._warehouse_inputs(t)
    loc = dims.warehouses_with_profile(wh, prof, q_dims.NAME_FILTERS["exclude"]).select(
        F.col("name").alias("s_name"), "state", "replenishment_center", promo.location_key().alias("location")
    )
    li = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_linestatus")
    s = t.supplier.select("s_suppkey", "s_name")
    items = q_dims._items(t)
    j = (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .join(loc, "s_name")
        .join(items, F.col("l_partkey").cast("string") == F.col("item_code"))
    )
    return j


def training_frame(t):
    # five tables joined once: the panel and the seasonality both read the written rows
    sales = cut_lineage(
        _located_sales(t).select(
            "location", "state", "replenishment_center", "item_linkage", "brand", "item_sub_category", "item_classification", "l_shipdate", "l_quantity", "l_extendedprice", "l_linestatus"
        )
    )
    panel = sales.groupBy(
        "location", "state", "replenishment_center", "item_linkage", "brand", "item_sub_category",
        F.trunc("l_shipdate", "MM").alias("month_start_date"),
    ).agg(F.sum("l_quantity").alias("order_sales"))
    panel = panel.withColumn("id", F.concat_ws("|", "location", "item_linkage"))
    panel = cut_lineage(clean.drop_ambiguous_keys(panel, ["id", "month_start_date"]))

    wh, prof, closure = q_dims._warehouse_inputs(t)
    # written, so its size is known: the few warehouses of many promotions are broadcast where that is small, not shuffled to
    # the few names they hang under
    hierarchy = cut_lineage(dims.warehouse_hierarchy(wh, prof, closure, **q_dims.NAME_FILTERS))
    feats = promo.promo_features(q_promo.promo_months_frame(t), hierarchy, level="_key")

    # the features are planned once: each row belongs to one level and is averaged under that level's key
    leads = feats.select("location", F.col("month").alias("month_start_date"), F.col("apply_on").alias("_scope"), "_key", *LEAD_COLS)
    # only features that some row of the panel can take go on. A level's key has its months in an array, as many as the
    # calendar has, so that the features are joined and averaged where ``promo_features`` has put them
    levels = {"Brand": "brand", promo.SUB_CATEGORY_SCOPE: "item_sub_category", "Item Code": "item_linkage"}
    wanted = None
    for name, key in levels.items():
        own = panel.groupBy(F.lit(name).alias("_scope"), "location", F.col(key).alias("_key")).agg(F.collect_set("month_start_date").alias("_months"))
        wanted = own if wanted is None else wanted.unionByName(own)
    leads = leads.join(cut_lineage(wanted), ["_scope", "location", "_key"]).filter(F.array_contains("_months", F.col("month_start_date")))
    means = cut_lineage(leads.groupBy("_scope", "location", "_key", "month_start_date").agg(*[F.avg(c).alias(c) for c in LEAD_COLS]))

    def level(name, key, suffix):
        return means.filter(F.col("_scope") == name).select("location", F.col("_key").alias(key), "month_start_date", *[F.col(c).alias(f"{c}_{suffix}") for c in LEAD_COLS])

    brand, category, code = (level(name, key, suffix) for (name, key), suffix in zip(levels.items(), ("brand", "category", "code")))
    out = (
        panel.join(brand, ["location", "brand", "month_start_date"], "left")
        .join(category, ["location", "item_sub_category", "month_start_date"], "left")
        .join(code, ["location", "item_linkage", "month_start_date"], "left")
    )
    # rounded where they are used: rounding is dear, and few of the features meet a row of the panel
    lead_out = [f"{c}_{s}" for s in ("brand", "category", "code") for c in LEAD_COLS]
    out = out.withColumns({c: F.coalesce(F.round(c, 9), F.lit(0.0)) for c in lead_out})
    variants = dims.item_variants(q_dims._items(t), q_dims._brands(t))
    out = dims.attach_variant(out, variants)
    seas_sales = sales.filter(F.col("l_linestatus") == "F").select(
        "state", F.col("replenishment_center").alias("crc"), "item_sub_category",
        F.coalesce("item_classification", "item_sub_category").alias("er_variant"),
        F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("amount"),
    )
    seas = season.seasonality_status(
        seas_sales, ["state", "crc", "item_sub_category", "er_variant"], "date", "amount", F.lit(q_promo.AS_OF).cast("date")
    ).withColumnRenamed("crc", "replenishment_center")
    out = out.join(seas, ["state", "replenishment_center", "item_sub_category", "er_variant"], "left")
    return season.label_encode(out, STATUS_COLS)


def _training_sql():
    def level(scope, key_sql, suffix):
        cols = ",\n    ".join(f"round(avg({c}), 9) as {c}_{suffix}" for c in LEAD_COLS)
        return f"""select location, {key_sql}, month as month_start_date,
    {cols}
  from feats where apply_on = '{scope}' group by all"""

    fill = ",\n  ".join(
        f"coalesce({a}.{c}_{s}, 0.0) as {c}_{s}"
        for a, s in (("b", "brand"), ("c", "category"), ("d", "code"))
        for c in LEAD_COLS
    )
    statuses = ", ".join(f"z.{c}" for c in STATUS_COLS)
    code_ctes = ",\n".join(
        f"k{i} as (select v, cast(row_number() over (order by v) - 1 as integer) as code "
        f"from (select distinct {c} as v from tt where {c} is not null))"
        for i, c in enumerate(STATUS_COLS)
    )
    code_joins = "\n".join(f"left join k{i} on tt.{c} = k{i}.v" for i, c in enumerate(STATUS_COLS))
    code_cols = ",\n  ".join(
        f"coalesce(k{i}.code, (select cast(count(*) as integer) from k{i})) as {c}_cat" for i, c in enumerate(STATUS_COLS)
    )
    season_sales = """select state, replenishment_center as crc, item_sub_category,
         coalesce(item_classification, item_sub_category) as er_variant, cast(l_shipdate as date) as date,
         l_extendedprice as amount
  from sales where l_linestatus = 'F'"""
    return f"""with {q_promo._PROMO_SQL}, {q_dims._WAREHOUSE_SQL.strip()}, {q_promo._FEATS_SQL}, {q_dims._ITEMS_SQL.strip()},
loc_wh as (
  select name as s_name, state, replenishment_center, city || '~' || global_id || '~' || replenishment_center as location
  from served),
sales as (
  select l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_shipdate, l.l_linestatus, w.state, w.replenishment_center,
         w.location, i.item_linkage, i.brand, i.item_sub_category, i.item_classification
  from lineitem l join supplier s on l.l_suppkey = s.s_suppkey join loc_wh w on w.s_name = s.s_name
  join items i on cast(l.l_partkey as varchar) = i.item_code),
panel0 as (
  select location, state, replenishment_center, item_linkage, brand, item_sub_category,
         cast(date_trunc('month', l_shipdate) as date) as month_start_date, sum(l_quantity) as order_sales
  from sales group by all),
panel as (
  select *, location || '|' || item_linkage as id from panel0
  where (location || '|' || item_linkage, month_start_date) not in (
    select (location || '|' || item_linkage, month_start_date) from panel0
    group by location || '|' || item_linkage, month_start_date having count(*) > 1)),
lvl_brand as ({level('Brand', 'promo_brand as brand', 'brand')}),
lvl_cat as ({level('sub_cateogry', 'promo_item_sub_category as item_sub_category', 'category')}),
lvl_code as ({level('Item Code', 'item_linkage', 'code')}),
j as (
  select p.*,
  {fill}
  from panel p
  left join lvl_brand b on b.location = p.location and b.brand = p.brand and b.month_start_date = p.month_start_date
  left join lvl_cat c on c.location = p.location and c.item_sub_category = p.item_sub_category and c.month_start_date = p.month_start_date
  left join lvl_code d on d.location = p.location and d.item_linkage = p.item_linkage and d.month_start_date = p.month_start_date),
jv as (
  select j.*, coalesce(v.er_variant, j.item_sub_category) as er_variant
  from j left join variants v on v.item_linkage = j.item_linkage where j.item_sub_category is not null),
{q_promo._seasonality_sql(season_sales).strip()},
tt as (
  select jv.*, {statuses}
  from jv left join seasonality z on jv.state = z.state and jv.replenishment_center = z.crc
   and jv.item_sub_category = z.item_sub_category and jv.er_variant = z.er_variant),
{code_ctes}
select tt.*,
  {code_cols}
from tt
{code_joins}
"""


@query("training_table", _training_sql())
def training_table(t):
    """B12 + B8 + B9 + B10 + B11 + X28: one row per (id, month) with promotion leads at brand,
    category and item level, the item variant, 12 seasonality statuses and their codes."""
    return training_frame(t)
