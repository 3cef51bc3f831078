"""Queries on range joins (J9, J10, J22) and closures of hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators.closure import cycles, hierarchy_closure, roots
from tally.operators.ranges import range_join
from tally.plans.registry import query
from tally.session import cut_lineage


def open_orders(t):
    """Each order as an interval: ordered to last parcel, with an open end while its status is O."""
    received = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("received"))
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("ordered"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    j = o.join(received, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", "ordered", F.when(F.col("o_orderstatus") != "O", F.to_date("received")).alias("closed"), "price")


@query(
    "range_join_months",
    """
with months as (select distinct cast(date_trunc('month', o_orderdate) as date) as month from orders),
received as (select l_orderkey, max(l_shipdate) as received from lineitem group by 1),
spans as (
  select o_orderkey, cast(o_orderdate as date) as ordered, case when o_orderstatus <> 'O' then cast(received as date) end as closed, cast(o_totalprice as decimal(18,2)) as price
  from orders left join received on l_orderkey = o_orderkey)
select month, count(*) as n_open, cast(sum(price) as double) as open_value
from months join spans on month >= ordered and (closed is null or month <= closed) group by month
""",
)
def range_join_months(t):
    """Orders under way on the first day of each month; open orders have an open end."""
    months = t.orders.select(F.to_date(F.trunc("o_orderdate", "MM")).alias("month")).distinct()
    j = range_join(cut_lineage(months), cut_lineage(open_orders(t)), "month", "ordered", "closed")
    return j.groupBy("month").agg(F.count(F.lit(1)).alias("n_open"), F.sum("price").cast("double").alias("open_value"))


@query(
    "range_join_keyed",
    """
select a.o_orderkey, l.l_orderkey, l.l_linenumber
from orders a join orders b on a.o_custkey = b.o_custkey join lineitem l on l.l_orderkey = b.o_orderkey
where cast(a.o_orderdate as date) >= cast(l.l_shipdate as date) and cast(a.o_orderdate as date) <= cast(l.l_shipdate as date) + cast(l.l_quantity as integer)
""",
)
def range_join_keyed(t):
    """For each order the same customer's parcels that were on their way that day (as many days as pieces)."""
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    line = t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("sent"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("received"))
    parcels = line.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return range_join(orders, parcels, "day", "sent", "received", on=["o_custkey"]).select("o_orderkey", "l_orderkey", "l_linenumber")


def part_edges(t):
    """Parts as a tree: the parent of part k is part k / 2."""
    return t.part.where("p_partkey > 1").select(F.col("p_partkey").cast("long").alias("child"), F.floor(F.col("p_partkey") / 2).cast("long").alias("parent"))


_CLOSURE_SQL = """
edges as (select cast(p_partkey as bigint) as child, cast(p_partkey // 2 as bigint) as parent from part where p_partkey > 1),
up as (
  select child as node, parent as ancestor, 1 as depth from edges
  union all
  select up.node, e.parent, up.depth + 1 from up join edges e on e.child = up.ancestor)"""


@query("hierarchy_closure", f"with recursive {_CLOSURE_SQL} select node, ancestor, cast(depth as integer) as depth from up")
def hierarchy_closure_query(t):
    """Every part with all its ancestors and their distance."""
    return hierarchy_closure(part_edges(t), "child", "parent")


@query(
    "hierarchy_roots",
    f"""with recursive {_CLOSURE_SQL}
select node, ancestor as root, cast(depth as integer) as depth from up where ancestor not in (select child from edges)""",
)
def hierarchy_roots(t):
    """The topmost ancestor of every part."""
    return roots(hierarchy_closure(part_edges(t), "child", "parent"))


@query(
    "hierarchy_cycles",
    """
with recursive edges as (
  select distinct cast(s_suppkey as bigint) as child, cast((s_suppkey * 7 + 3) % (select count(*) from supplier) as bigint) as parent from supplier),
up as (
  select child as node, parent as ancestor, 1 as depth from edges
  union
  select up.node, e.parent, up.depth + 1 from up join edges e on e.child = up.ancestor where up.node <> up.ancestor)
select node, cast(min(depth) as integer) as length from up where node = ancestor group by node
""",
)
def hierarchy_cycles(t):
    """Suppliers that hand on to supplier (7 k + 3) mod n: the nodes on a cycle, and how long it is."""
    n = t.supplier.count()
    edges = t.supplier.select(F.col("s_suppkey").cast("long").alias("child"), F.pmod(F.col("s_suppkey") * 7 + 3, F.lit(n)).cast("long").alias("parent"))
    return cycles(hierarchy_closure(edges, "child", "parent"))
