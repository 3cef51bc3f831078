"""Step 4 queries: latest rows, warehouse hierarchy, item variants, sales star, latest snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.functions import scalar as X
from tally.operators import dims
from tally.plans.registry import query


@query(
    "latest_per_key",
    """
select o_custkey, o_orderkey, cast(o_orderdate as date) as last_order_date, o_totalprice, o_orderstatus from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
where rn = 1
""",
)
def latest_per_key(t):
    """W1 + B7: the latest order of each customer (order key breaks date ties)."""
    o = t.orders
    return dims.latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("last_order_date"), "o_totalprice", "o_orderstatus"
    )


#: neutral stand-ins for the name patterns a company leaves out of its hierarchy
NAME_FILTERS = {"exclude": ("%7",), "main_exclude": ("%0003%",)}


def _supplier_name(expr):
    return F.concat(F.lit("Supplier#"), F.lpad(expr.cast("string"), 9, "0"))


def _warehouse_inputs(t):
    s, n, r = t.supplier, t.nation, t.region
    wtype = (
        F.when(F.col("s_suppkey") % 3 == 0, "Main").when(F.col("s_suppkey") % 3 == 1, "Sector").otherwise("Transit")
    )
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    wh = s.join(geo, s.s_nationkey == geo.n_nationkey).select(
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.lit("G"), (F.col("s_suppkey") % 7).cast("string")).alias("global_id"),
        wtype.alias("warehouse_type"),
        _supplier_name(F.col("s_suppkey") - 1).alias("physical_warehouse"),
        F.lit(1).alias("active"),
        F.when(F.col("s_suppkey") % 11 == 0, 1).otherwise(0).alias("disabled"),
        F.lit(0).alias("inactive"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("s_suppkey") % 100).cast("int")).alias("modified"),
    )
    li = t.lineitem.select("l_suppkey", "l_partkey", "l_shipdate")
    prof = li.join(s.select("s_suppkey", "s_name"), li.l_suppkey == s.s_suppkey).select(
        F.col("s_name").alias("warehouse"),
        _supplier_name(F.col("l_partkey") % 10).alias("replenishment_center"),
        F.lit(1).alias("active"),
        F.to_date("l_shipdate").alias("modified"),
    )
    sg = s.join(geo, s.s_nationkey == geo.n_nationkey)
    closure = sg.select(
        F.col("r_name").alias("ref_parent"), F.col("s_name").alias("ref_docname"), F.lit("Warehouse").alias("ref_doctype")
    ).unionByName(
        sg.select(
            F.col("n_name").alias("ref_parent"), F.col("s_name").alias("ref_docname"), F.lit("Warehouse").alias("ref_doctype")
        )
    )
    return wh, prof, closure


_WAREHOUSE_SQL = """
geo as (select n.n_nationkey, n.n_name, r.r_name from nation n join region r on n.n_regionkey = r.r_regionkey),
wh as (
  select s.s_name as name, g.n_name as city, g.r_name as state, 'G' || cast(s.s_suppkey % 7 as varchar) as global_id,
         case s.s_suppkey % 3 when 0 then 'Main' when 1 then 'Sector' else 'Transit' end as warehouse_type,
         'Supplier#' || lpad(cast(s.s_suppkey - 1 as varchar), 9, '0') as physical_warehouse,
         1 as active, case when s.s_suppkey % 11 = 0 then 1 else 0 end as disabled, 0 as inactive,
         cast(date '2000-01-01' + cast(s.s_suppkey % 100 as integer) as date) as modified
  from supplier s join geo g on s.s_nationkey = g.n_nationkey
),
prof_raw as (
  select s.s_name as warehouse, 'Supplier#' || lpad(cast(l.l_partkey % 10 as varchar), 9, '0') as replenishment_center,
         1 as active, cast(l.l_shipdate as date) as modified
  from lineitem l join supplier s on l.l_suppkey = s.s_suppkey
),
closure as (
  select g.r_name as ref_parent, s.s_name as ref_docname, 'Warehouse' as ref_doctype from supplier s join geo g on s.s_nationkey = g.n_nationkey
  union all
  select g.n_name, s.s_name, 'Warehouse' from supplier s join geo g on s.s_nationkey = g.n_nationkey
),
centre_of as (
  select warehouse, first(replenishment_center order by modified desc, replenishment_center) as centre
  from prof_raw where active = 1 group by warehouse
),
served as (
  select w.*, coalesce(c.centre, 'No-RC') as replenishment_center,
         case when w.name in (select centre from centre_of where centre <> '') then 1 else 0 end as is_crc
  from wh w left join centre_of c
    on c.warehouse = case w.warehouse_type when 'Sector' then w.physical_warehouse else w.name end
  where w.active = 1 and w.global_id not in ('', 'NULL') and w.warehouse_type in ('Main', 'Sector', 'Transit')
    and not regexp_matches(lower(w.name), '7$')
),
newest as (
  select global_id, replenishment_center, city, state, name as warehouse, modified from served
  where disabled = 0 and inactive = 0 and lower(warehouse_type) = 'main' and not contains(lower(name), '0003')
  qualify row_number() over (partition by city, global_id, replenishment_center order by modified desc, name) = 1
),
hierarchy as (
  select up.ref_parent as higher_hier_warehouse, newest.*
  from newest join closure up on up.ref_docname = newest.warehouse and up.ref_doctype = 'Warehouse'
)"""


@query("warehouse_hierarchy", f"with {_WAREHOUSE_SQL} select * from hierarchy")
def warehouse_hierarchy(t):
    """B6 + J7 + J8 + F5: warehouse -> centre (sector via physical warehouse), latest per
    (city, global id, centre), under every ancestor of the closure table."""
    wh, prof, closure = _warehouse_inputs(t)
    return dims.warehouse_hierarchy(wh, prof, closure, **NAME_FILTERS)


@query(
    "planning_links",
    """
with it as (
  select cast(p_partkey as varchar) as code, case when p_size % 4 <> 0 then p_brand || p_type else '' end as linkage,
         p_type, p_brand, cast(date '1994-01-01' + cast((p_partkey % 1500) as integer) as date) as modified,
         case when p_partkey % 3 <> 0 then cast(date '1995-01-01' + cast((p_size * 60) as integer) as date) end as expiry
  from part),
live as (select *, coalesce(nullif(linkage, ''), code) as planning_key from it where expiry is null or expiry >= date '1998-01-01'),
newest as (select * from live qualify row_number() over (partition by planning_key order by modified desc, code) = 1)
select planning_key, code as item_code, p_type as item_type,
       case when p_type = (select min(p_type) from part) then p_brand end as brand
from newest
""",
)
def planning_links(t):
    """Unexpired items under their linkage (or own code), the newest each; brand of one item type only."""
    p = t.part
    items = p.select(
        F.col("p_partkey").cast("string").alias("code"),
        F.when(F.col("p_size") % 4 != 0, F.concat("p_brand", "p_type")).otherwise("").alias("linkage"),
        "p_type",
        "p_brand",
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("p_partkey") % 1500).cast("int")).alias("modified"),
        F.when(F.col("p_partkey") % 3 != 0, F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_size") * 60).cast("int"))).alias("expiry"),
    )
    branded = p.agg(F.min("p_type")).scalar()
    return dims.planning_links(
        items, "linkage", "code", "expiry", F.lit("1998-01-01").cast("date"), "p_type", branded, "p_brand", "modified"
    )


def _items(t):
    p = t.part
    cls = F.when(F.col("p_size") % 4 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.col("p_type"), F.lit("-"), (F.col("p_size") % 3).cast("string"))
    )
    return p.select(
        F.col("p_partkey").cast("string").alias("item_code"),
        F.col("p_name").alias("item_linkage"),
        cls.alias("item_classification"),
        F.col("p_type").alias("item_sub_category"),
        (F.col("p_size") * 10).alias("shelf_life_in_days"),
        F.col("p_brand").alias("brand"),
    )


def _brands(t):
    b = t.part.select(F.col("p_brand").alias("brand")).distinct()
    num = F.regexp_extract("brand", r"(\d+)", 1).cast("int")
    return b.filter(num % 3 != 0).withColumn("brand_type", F.when(num % 2 == 0, "National").otherwise("Regional"))


_ITEMS_SQL = """
items as (
  select cast(p_partkey as varchar) as item_code, p_name as item_linkage,
         case when p_size % 4 = 0 then null else p_type || '-' || cast(p_size % 3 as varchar) end as item_classification,
         p_type as item_sub_category, p_size * 10 as shelf_life_in_days, p_brand as brand
  from part
),
brands as (
  select brand, case when cast(regexp_extract(brand, '(\\d+)', 1) as integer) % 2 = 0 then 'National' else 'Regional' end as brand_type
  from (select distinct p_brand as brand from part) where cast(regexp_extract(brand, '(\\d+)', 1) as integer) % 3 <> 0
),
variants as (
  select item_linkage, max(coalesce(item_classification, item_sub_category)) as er_variant,
         avg(shelf_life_in_days) as shelf_life_in_days, max(i.brand) as brand, max(coalesce(brand_type, 'NA')) as brand_type,
         max(item_sub_category) as item_sub_category
  from items i left join brands b on i.brand = b.brand
  where lower(item_code) not like '%\\_discount%' escape '\\' and lower(item_code) not like '%\\_supersaver%' escape '\\'
  group by item_linkage
)"""


@query(
    "item_variant",
    f"""
with {_ITEMS_SQL}
select p.p_partkey, p.p_name as item_linkage, p.p_type as item_sub_category,
       coalesce(v.er_variant, p.p_type) as er_variant, v.shelf_life_in_days, v.brand_type
from part p left join variants v on v.item_linkage = p.p_name
where p.p_type is not null
""",
)
def item_variant(t):
    """B10 + A6 + P11: representative variant per item linkage attached to every part."""
    v = dims.item_variants(_items(t), _brands(t))
    panel = t.part.select("p_partkey", F.col("p_name").alias("item_linkage"), F.col("p_type").alias("item_sub_category"))
    out = dims.attach_variant(panel, v)
    return out.join(v.select("item_linkage", "shelf_life_in_days", "brand_type"), "item_linkage", "left").select(
        "p_partkey", "item_linkage", "item_sub_category", "er_variant", "shelf_life_in_days", "brand_type"
    )


AS_OF = "2001-10-15"
#: warehouses whose stock is valued with a divisor
PARTNER_NAMES = "%1"


@query(
    "sales_star",
    f"""
select l.l_orderkey, l.l_linenumber, l.l_partkey, cast(l.l_shipdate as date) as ship_date,
       n.n_regionkey as state, s.s_name as warehouse, p.p_type as item_sub_category, p.p_brand as er_variant,
       c.c_name as customer,
       l.l_extendedprice * (1 - l.l_discount) as amount,
       l.l_extendedprice * (1 - l.l_discount)
         - case when s.s_name like '{PARTNER_NAMES}' then l.l_quantity * p.p_retailprice * 0.9 / 1.01
                else l.l_quantity * p.p_retailprice * 0.9 end as margin,
       cast(cast(p.p_retailprice as decimal(18,2)) * 1.1 as double) as target
from lineitem l
join orders o on l.l_orderkey = o.o_orderkey
join part p on l.l_partkey = p.p_partkey
join supplier s on l.l_suppkey = s.s_suppkey
join nation n on s.s_nationkey = n.n_nationkey
join customer c on o.o_custkey = c.c_custkey
where l.l_linestatus = 'F' and c.c_name <> 'Customer#000000000'
  and lower(s.s_name) not like '{NAME_FILTERS["exclude"][0]}' and lower(s.s_name) not like '{NAME_FILTERS["main_exclude"][0]}'
  and cast(l.l_shipdate as date) between date '{AS_OF}' - interval 730 day and date '{AS_OF}'
""",
)
def sales_star(t):
    """B25 + J1: delivered sales of the last 730 days joined to their four dimensions; margin
    with the 1.01 valuation divisor for one warehouse-name pattern; target x 1.1."""
    return sales_star_frame(t)


def sales_star_frame(t, as_of: str = AS_OF):
    li = t.lineitem.filter(
        (F.col("l_linestatus") == "F")
        & F.to_date("l_shipdate").between(F.date_sub(F.lit(as_of).cast("date"), 730), F.lit(as_of).cast("date"))
    )
    left_out = (*NAME_FILTERS["exclude"], *NAME_FILTERS["main_exclude"])
    j = dims.star_join(
        li,
        [
            (t.orders.select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey"),
            (t.part.select("p_partkey", "p_type", "p_brand", "p_retailprice"), "l_partkey", "p_partkey"),
            (t.supplier.filter(X.exclude_names("s_name", left_out)).select("s_suppkey", "s_name", "s_nationkey"), "l_suppkey", "s_suppkey"),
            (t.nation.select("n_nationkey", "n_regionkey"), "s_nationkey", "n_nationkey"),
            (t.customer.filter(F.col("c_name") != "Customer#000000000").select("c_custkey", "c_name"), "o_custkey", "c_custkey"),
        ],
    )
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    valuation = F.col("l_quantity") * F.col("p_retailprice") * 0.9
    margin = dims.sales_margin(amount, valuation, F.col("s_name").like(PARTNER_NAMES), 1.01)
    return j.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("n_regionkey").alias("state"),
        F.col("s_name").alias("warehouse"),
        F.col("p_type").alias("item_sub_category"),
        F.col("p_brand").alias("er_variant"),
        F.col("c_name").alias("customer"),
        amount.alias("amount"),
        margin.alias("margin"),
        (F.col("p_retailprice").cast("decimal(18,2)") * F.lit(1.1).cast("decimal(2,1)")).cast("double").alias("target"),
    )


@query(
    "latest_snapshot_join",
    """
with snap as (
  select o_custkey, cast(date_trunc('month', o_orderdate) as date) as snapshot_month,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as target
  from orders group by all
)
select c.c_custkey, c.c_name, s.snapshot_month, s.target
from customer c left join snap s
  on s.o_custkey = c.c_custkey and s.snapshot_month = (select max(snapshot_month) from snap)
""",
)
def latest_snapshot_join(t):
    """Customers with their value in the newest monthly snapshot (null when absent)."""
    snap = t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("snapshot_month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("target")
    )
    latest = dims.latest_snapshot(snap, "snapshot_month")
    c = t.customer.select("c_custkey", "c_name")
    return c.join(latest, c.c_custkey == latest.o_custkey, "left").select("c_custkey", "c_name", "snapshot_month", "target")
