"""Step 5 queries: promotion months and features, seasonality, label codes, training table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import dims, promo, seasonality as season
from tally.plans import q_dims
from tally.plans.registry import query

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")


def promos(t):
    """Every order as a promotion scheme (the whole table); its attributes follow from the order
    key k: scope, category, brand, item, length (k % 60 days, open-ended when k % 17 = 0),
    discount percentage and amount."""
    o = t.orders
    k = F.col("o_orderkey")
    cat = F.when(k % 3 == 1, F.element_at(F.array(*[F.lit(x) for x in TYPES]), (k % 5 + 1).cast("int"))).when(
        k % 3 == 2, F.lit("")
    )
    start = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("name"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("warehouse"),
        F.when(k % 3 == 2, "Item Code").otherwise("Brand").alias("apply_on"),
        cat.alias("er_category_to_apply_on"),
        F.when(k % 3 != 2, F.concat(F.lit("Brand#"), (k % 25 + 1).cast("string"))).alias("brand"),
        F.when(k % 3 == 2, ((k * 37) % 1000).cast("string")).alias("item_code"),
        start.alias("valid_from"),
        F.when(k % 17 == 0, F.lit(None).cast("date")).otherwise(F.date_add(start, (k % 60).cast("int"))).alias("valid_upto"),
        (k % 20).cast("double").alias("discount_percentage"),
        (k % 11).cast("double").alias("discount_amount"),
    )


def items(t):
    return t.part.select(F.col("p_partkey").cast("string").alias("item_code"), F.col("p_name").alias("item_linkage"))


def calendar_bounds(t):
    b = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("s"), F.date_add(F.max(F.to_date("o_orderdate")), 90).alias("e"))
    s = b.select(F.struct("s", "e")).scalar()
    return s["s"], s["e"]


_PROMO_SQL = """
bounds as (select min(cast(o_orderdate as date)) as s, cast(max(cast(o_orderdate as date)) + 90 as date) as e from orders),
promo_raw as (
  select cast(o_orderkey as varchar) as name, 'NATION_' || cast(o_custkey % 25 as varchar) as warehouse,
         case when o_orderkey % 3 = 2 then 'Item Code' else 'Brand' end as apply_on,
         case when o_orderkey % 3 = 1 then ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL'][(o_orderkey % 5 + 1)::integer]
              when o_orderkey % 3 = 2 then '' end as er_category_to_apply_on,
         case when o_orderkey % 3 <> 2 then 'Brand#' || cast(o_orderkey % 25 + 1 as varchar) end as brand,
         case when o_orderkey % 3 = 2 then cast((o_orderkey * 37) % 1000 as varchar) end as item_code,
         cast(o_orderdate as date) as valid_from,
         case when o_orderkey % 17 = 0 then null
              else cast(cast(o_orderdate as date) + cast(o_orderkey % 60 as integer) as date) end as valid_upto,
         cast(o_orderkey % 20 as double) as discount_percentage,
         cast(o_orderkey % 11 as double) as discount_amount
  from orders),
scoped as (
  -- one row per promotion and scope; n_scope: how many share the scope
  select *, count(*) over (partition by promo_warehouse, apply_on, kind, category, promo_brand, promo_item_sub_category, promo_item_code) as n_scope
  from (
    select distinct warehouse as promo_warehouse, apply_on, er_category_to_apply_on as category, name, valid_from, valid_upto,
      discount_percentage, discount_amount,
      if(apply_on = 'Brand' and category <> '', 'sub_cateogry', apply_on) as kind,
      if(apply_on = 'Brand', brand, '') as promo_brand,
      if(apply_on = 'Brand' and category <> '', category, '') as promo_item_sub_category,
      if(apply_on = 'Brand', '', item_code) as promo_item_code
    from promo_raw, bounds where valid_upto is null or valid_upto >= s)),
running as (
  -- the months of the calendar in which a promotion is active: from the month of the day before it starts
  -- (one month is taken off and put on again, which shortens the last days of long months)
  select *, cast(unnest(generate_series(
      greatest(date_trunc('month', valid_from - interval 1 day - interval 1 month) + interval 1 month, date_trunc('month', s)),
      least(cast(valid_upto as timestamp), date_trunc('month', e)), interval 1 month)) as date) as month
  from scoped, bounds where valid_upto is not null),
monthly as (
  select month, promo_warehouse, apply_on, kind, category, promo_brand, promo_item_sub_category, promo_item_code,
    count(distinct name) as schemes, avg(discount_amount) as amount, avg(distinct discount_percentage) as percentage,
    max(date_diff('day', greatest(month, valid_from), least(last_day(month), valid_upto)) + 1) as longest,
    -- a promotion of the scope that is not active this month counts as zero days
    if(count(*) < any_value(n_scope), greatest(longest, 0), longest) as days
  from running group by all),
promo_months as (
  select month, promo_warehouse, kind as apply_on, promo_brand, promo_item_sub_category, p_name as item_linkage,
    avg(schemes) as schemes, avg(amount) as avg_discount_amount, avg(percentage) as avg_discount_percentage,
    cast(max(days) as integer) as max_days_of_promo, avg(days) as avg_days_of_promo
  from monthly left join part on cast(p_partkey as varchar) = promo_item_code
  where days <> 0
  group by month, promo_warehouse, apply_on, kind, category, promo_brand, promo_item_sub_category, p_name)"""


def promo_months_frame(t):
    s, e = calendar_bounds(t)
    return promo.promo_months(promos(t), items(t), s, e)


@query("promo_months", f"with {_PROMO_SQL} select * from promo_months")
def promo_months(t):
    """B4 + B5 + J9 + A3-A5 + X21-X22: promotion measures per month and scope."""
    return promo_months_frame(t)


_LEADS_SQL = ",\n".join(
    f"coalesce({'' if n == 0 else 'lead('}{m}{'' if n == 0 else f', {n}) over w'}, 0)::double as {m}_lead_{n}"
    for m in promo.PROMO_MEASURES
    for n in promo.LEADS
)


_FEATS_SQL = f"""
loc as (
  select pm.*, h.city || '~' || h.global_id || '~' || h.replenishment_center as location
  from promo_months pm left join hierarchy h on pm.promo_warehouse = h.higher_hier_warehouse),
g as (
  select location, month, promo_item_sub_category, item_linkage, promo_brand, apply_on,
         sum(schemes) as schemes, avg(avg_discount_amount) as avg_discount_amount,
         avg(avg_discount_percentage) as avg_discount_percentage, cast(max(max_days_of_promo) as integer) as max_days_of_promo,
         avg(avg_days_of_promo) as avg_days_of_promo
  from loc where location is not null group by all),
feats as (
  select *, location || '|' || promo_item_sub_category || '|' || item_linkage || '|' || promo_brand || '|' || apply_on as key,
  {_LEADS_SQL}
  from g
  window w as (partition by location, promo_item_sub_category, item_linkage, promo_brand, apply_on order by month))"""


@query("promo_features", f"with {_PROMO_SQL}, {q_dims._WAREHOUSE_SQL.strip()}, {_FEATS_SQL} select * from feats")
def promo_features(t):
    """B9 + W2 + P15: promotions at locations, regrouped, leads 0-2 of five measures."""
    wh, prof, closure = q_dims._warehouse_inputs(t)
    return promo.promo_features(promo_months_frame(t), dims.warehouse_hierarchy(wh, prof, closure, **q_dims.NAME_FILTERS))


AS_OF = "2001-10-15"


def seasonal_sales(t):
    """lineitem x part x supplier as delivered sales: state = region key of the supplier's
    nation, centre = supplier nation, sub-category = part type, variant = part brand."""
    li = t.lineitem.filter(F.col("l_linestatus") == "F").select("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    p = t.part.select("p_partkey", "p_type", "p_brand")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    j = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("n_regionkey").alias("state"),
        F.col("s_nationkey").alias("crc"),
        F.col("p_type").alias("item_sub_category"),
        F.col("p_brand").alias("er_variant"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("amount"),
    )


def seasonality_frame(t):
    return season.seasonality_status(
        seasonal_sales(t), ["state", "crc", "item_sub_category", "er_variant"], "date", "amount", F.lit(AS_OF).cast("date")
    )


def _seasonality_sql(sales_sql: str | None = None):
    """Statuses from lists of twelve months; ``sales_sql`` (columns state, crc, item_sub_category,
    er_variant, date, amount) replaces the default lineitem sales."""
    keys = "state, crc, item_sub_category, er_variant"
    sold = ", ".join(f"coalesce(sum(amount) filter (where month(date) = {i}), 0)::double" for i in range(1, 13))
    days = ", ".join(map(str, season.MONTH_DAYS))
    out = ", ".join(f"status[{i}] as {m}_seasonality_status" for i, m in enumerate(season.MONTHS, start=1))
    default_sales = """
  select n_regionkey as state, s_nationkey as crc, p_type as item_sub_category, p_brand as er_variant,
         cast(l_shipdate as date) as date, l_extendedprice as amount
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  where l_linestatus = 'F'"""
    return f"""
sold as (
  select {keys}, sum(amount)::double as total, [{sold}] as by_month, min(date) as introduced
  from (select {keys}, date, amount::decimal(38, 2) as amount from ({sales_sql or default_sales}) x)
  where date between date '{AS_OF}' - interval 730 day and date '{AS_OF}' group by all),
opened as (select *, greatest(introduced, (select min(introduced) from sold) + 1) as first_day from sold),
spans as (
  select *, if(first_day > date '{AS_OF}', [], generate_series(date_trunc('month', first_day), date '{AS_OF}', interval 1 month)) as months
  from opened),
usual as (
  select *, if(len(months) = 0, 0, total / len(months)) as monthly,
    list_transform(range(1, 13), lambda m: len(list_filter(months, lambda d: month(d) = m))) as seen,
    list_transform(range(1, 13), lambda m: by_month[m] + if(month(introduced) = m, (day(introduced) - 1) * by_month[m] / [{days}][m] * seen[m], 0)) as scaled
  from spans),
rated as (
  select {keys}, seen, list_transform(range(1, 13), lambda m: if(monthly = 0 or seen[m] = 0, 0, scaled[m] / seen[m] / monthly)) as ratio from usual),
seasonality as (
  select {keys}, {out} from (
    select {keys}, list_transform(range(1, 13), lambda m: case when seen[m] = 0 then null when ratio[m] < 0.5 then 'Out of Season'
      when ratio[m] > 1.5 then 'In Season' else 'Normal' end) as status from rated))"""


@query("seasonality_status", f"with {_seasonality_sql()} select * from seasonality")
def seasonality_status(t):
    """B11 + J10 + A5 + X23 + Q9-Q11: month statuses per (state, centre, sub-category, variant)."""
    return seasonality_frame(t)


_STATUS_COLS = [f"{m}_seasonality_status" for m in season.MONTHS]


def _label_sql():
    ranks = []
    for c in _STATUS_COLS:
        ranks.append(
            f"(case when s.{c} is null then (select count(distinct x.{c}) from seasonality x) "
            f"else (select count(distinct x.{c}) from seasonality x where x.{c} < s.{c}) end)::integer as {c}_cat"
        )
    return f"with {_seasonality_sql()} select s.*, {', '.join(ranks)} from seasonality s"


@query("label_encode", _label_sql())
def label_encode(t):
    """X28 + B12: codes of the 12 seasonality statuses in sorted order; null gets the last code."""
    out = season.label_encode(seasonality_frame(t), _STATUS_COLS)
    return out.withColumns({f"{c}_cat": F.col(f"{c}_cat").cast("int") for c in _STATUS_COLS})
