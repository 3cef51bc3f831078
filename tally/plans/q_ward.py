"""Queries on Ward's hierarchical clustering (M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import ml, ward
from tally.plans.q_ml import _RFM_SQL, RFM, _rfm_scaled, _SCALED
from tally.plans.registry import query
from tally.session import cut_lineage

NATION_FEATURES = ["n_orders", "mean_price", "mean_acctbal"]


def nation_features(t):
    """Per nation: orders, mean price of an order, mean balance of its customers' orders."""
    o = t.orders.select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    c = t.customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").cast("decimal(18,2)").alias("b"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    n = F.count(F.lit(1))
    return j.groupBy("c_nationkey").agg(
        n.cast("double").alias("n_orders"), (F.sum("p").cast("double") / n).alias("mean_price"), (F.sum("b").cast("double") / n).alias("mean_acctbal")
    )


_NATION_SQL = """
base as (
  select c.c_nationkey, cast(count(*) as double) as n_orders, cast(sum(cast(o.o_totalprice as decimal(18,2))) as double) / count(*) as mean_price,
         cast(sum(cast(c.c_acctbal as decimal(18,2))) as double) / count(*) as mean_acctbal
  from orders o join customer c on o.o_custkey = c.c_custkey group by 1),
leaves as (
  select cast(row_number() over (order by x, y, z) - 1 as integer) as id, 1.0::double as n, x, y, z
  from (select (n_orders - (select avg(n_orders) from base)) / (select stddev_pop(n_orders) from base) as x,
               (mean_price - (select avg(mean_price) from base)) / (select stddev_pop(mean_price) from base) as y,
               (mean_acctbal - (select avg(mean_acctbal) from base)) / (select stddev_pop(mean_acctbal) from base) as z from base))"""


@query(
    "ward_merges",
    f"""with recursive {_NATION_SQL},
run as (
  select 0 as step, id, n, x, y, z, -1 as l, -1 as r, 0.0::double as inc from leaves
  union all
  select * from (
    with pairs as (
      select a.step, a.id as l, b.id as r, a.n * b.n / (a.n + b.n) * ((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) as inc,
             a.n + b.n as n, (a.n * a.x + b.n * b.x) / (a.n + b.n) as x, (a.n * a.y + b.n * b.y) / (a.n + b.n) as y, (a.n * a.z + b.n * b.z) / (a.n + b.n) as z
      from run a join run b on a.id < b.id),
    best as (select * from pairs order by inc, l, r limit 1)
    select run.step + 1 as step, run.id, run.n, run.x, run.y, run.z, -1 as l, -1 as r, 0.0::double as inc from run, best where run.id <> best.l and run.id <> best.r
    union all
    select step + 1, cast((select count(*) from leaves) + step as integer) as id, n, x, y, z, l, r, inc from best))
select step, l as left, r as right, round(inc, 9) as increase, round(sqrt(2 * inc), 9) as height, cast(n as bigint) as n_rows from run where l >= 0""",
)
def ward_merges(t):
    """M6: the dendrogram of the nations by their scaled order figures; the SQL joins the best pair step by step."""
    scaled = cut_lineage(ml.standard_scale(nation_features(t), NATION_FEATURES))
    out = ward.Ward(scaled, [f"{c}_scaled" for c in NATION_FEATURES]).merges()
    return out.withColumns({"increase": F.round("increase", 9), "height": F.round("height", 9)})


def _rfm_ward(t, most: int = 300):
    return ward.Ward(cut_lineage(_rfm_scaled(t)), _SCALED, most)


@query("ward_segments", None)
def ward_segments(t):
    """M6: four clusters of the customers by scaled RFM, through at most 300 micro-clusters."""
    return _rfm_ward(t).segments(4).select("o_custkey", *RFM, "cluster")


@query(
    "ward_facts",
    f"""with {_RFM_SQL},
z as (select """
    + ", ".join(f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}" for c in RFM)
    + """ from rfm)
select count(*) as n_rows, round("""
    + " + ".join(f"var_pop({c}) * count(*)" for c in RFM)
    + """, 6) as total_squares, cast(0 as bigint) as lower_than_before, cast(4 as bigint) as n_clusters, true as split_explains from z""",
)
def ward_facts(t):
    """M6: every customer is in a leaf; what the leaves hold inside and all merges' increases add up to the total sum of
    squares; increases never fall (Ward's are monotone); four clusters, which leave less than half of the total inside."""
    w = _rfm_ward(t)
    leaves, steps = w.leaves(), w.merges()
    inside = leaves.agg(F.sum("n_rows").alias("n_rows"), F.sum("within").alias("within"))
    before = steps.select((F.col("step") + 1).alias("step"), F.col("increase").alias("before"))
    m = steps.join(before, "step", "left")
    last = steps.agg(F.max("step")).first()[0] or 0
    found = m.agg(
        F.sum("increase").alias("raised"),
        F.count(F.when(F.col("increase") < F.col("before") * (1 - 1e-9), 1)).alias("lower_than_before"),
        F.sum(F.when(F.col("step") > last - 3, F.col("increase"))).alias("between_four"),
    )
    clusters = w.segments(4).agg(F.count_distinct("cluster").alias("n_clusters"))
    total = F.col("within") + F.col("raised")
    both = inside.select("*", found.select(F.struct("*").alias("s")).scalar().alias("s"), clusters.scalar().alias("n_clusters")).select("*", "s.*")
    return both.select("n_rows", F.round(total, 6).alias("total_squares"), "lower_than_before", "n_clusters", (F.col("between_four") > total / 2).alias("split_explains"))
