"""How the shared test tables stand in for the reference's inputs (FIXTURES.md section 3).

Each function derives an operator's input from the tables; the same derivation is written in
SQL in the oracle strings. Nulls are made here (``nullif``/``when``) since the tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.sources.io import Tables


def influencers(t: Tables) -> DataFrame:
    """customer as influencer: followers text = |acctbal| with K (custkey%3=0), M (=1), none (=2);
    category = market segment; country = nation name; engagement from the customer's orders."""
    c = t.customer
    suffix = F.when(F.col("c_custkey") % 3 == 0, "K").when(F.col("c_custkey") % 3 == 1, "M").otherwise("")
    text = F.concat(F.abs("c_acctbal").cast("decimal(12,2)").cast("string"), suffix)
    stats = t.orders.groupBy("o_custkey").agg(
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("engagement_avg"),
        F.count(F.lit(1)).cast("double").alias("likes"),
        F.count_distinct("o_orderpriority").cast("double").alias("comments"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("views"),
    )
    return (
        c.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("category"), text.alias("followers_text"))
        .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")), "c_nationkey")
        .join(stats.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
        .drop("c_nationkey")
    )


INFLUENCERS_SQL = """
influencers as (
  select c.c_custkey, c.c_mktsegment as category,
         cast(cast(abs(c.c_acctbal) as decimal(12,2)) as varchar)
           || case when c.c_custkey % 3 = 0 then 'K' when c.c_custkey % 3 = 1 then 'M' else '' end as followers_text,
         n.n_name as country, s.engagement_avg, s.likes, s.comments, s.views
  from customer c
  join nation n on n.n_nationkey = c.c_nationkey
  left join (
    select o_custkey,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as engagement_avg,
           cast(count(*) as double) as likes,
           cast(count(distinct o_orderpriority) as double) as comments,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) as views
    from orders group by o_custkey) s on s.o_custkey = c.c_custkey
),
parsed as (
  select *, try_cast(nullif(array_to_string(regexp_extract_all(upper(trim(followers_text)), '\\d+\\.?\\d*'), ''), '') as double)
            * case when upper(trim(followers_text)) like '%M' then 1e6
                   when upper(trim(followers_text)) like '%K' then 1e3 else 1.0 end as followers
  from influencers
)"""


def cpi_by_nation(t: Tables) -> DataFrame:
    """Inline CPI lookup: nations 0..23 get 100 + 1.5 * key; NATION_24 has none (Q21)."""
    spark = t.spark
    rows = [(f"NATION_{k}", 100.0 + 1.5 * k) for k in range(24)]
    return spark.createDataFrame(rows, "country string, cpi double")


def daily_rates(t: Tables) -> DataFrame:
    """Exchange-rate stand-in: per customer nation and order day, mean order value / 100,000.
    Nations 20-24 have rows without a rate (the reference converts only listed countries)."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy(F.col("n_name").alias("country"), F.col("o_orderdate").alias("rate_ts")).agg(
        (F.sum(F.when(F.col("n_nationkey") < 20, F.col("o_totalprice").cast("decimal(18,2)"))).cast("double") / F.count(F.lit(1)) / 100000.0).alias("rate")
    )


RATES_SQL = """
rates as (
  select n.n_name as country, o.o_orderdate as rate_ts,
         cast(sum(case when n.n_nationkey < 20 then cast(o.o_totalprice as decimal(18,2)) end) as double) / count(*) / 100000.0 as rate
  from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
  group by all
)"""


CPI_SQL = "cpi as (select 'NATION_' || k as country, 100.0::double + 1.5 * k as cpi from range(24) r(k))"


def earnings(t: Tables) -> DataFrame:
    """lineitem as earnings: country = supplier's nation, gender F/M from l_linestatus F/O,
    year of ship date, amount = mean extended price (exact decimal sum / count)."""
    li = t.lineitem.select("l_suppkey", "l_linestatus", "l_extendedprice", "l_shipdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    gender = F.when(F.col("l_linestatus") == "F", "F").when(F.col("l_linestatus") == "O", "M")
    return (
        j.select(
            F.col("n_name").alias("country"),
            F.year("l_shipdate").alias("year"),
            gender.alias("gender"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("_p"),
        )
        .filter(F.col("gender").isin("F", "M"))
        .groupBy("country", "year", "gender")
        .agg((F.sum("_p").cast("double") / F.count(F.lit(1))).alias("amount"))
    )


EARNINGS_SQL = """
earnings as (
  select n.n_name as country, cast(year(l.l_shipdate) as integer) as year,
         case l.l_linestatus when 'F' then 'F' when 'O' then 'M' end as gender,
         cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) / count(*) as amount
  from lineitem l join supplier s on l.l_suppkey = s.s_suppkey join nation n on s.s_nationkey = n.n_nationkey
  where l.l_linestatus in ('F', 'O')
  group by all
)"""
