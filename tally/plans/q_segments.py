"""Step 2 queries: RFM, loyalty levels, segments, influencers, top-n, earnings gap, as-of rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.operators import joins, segments as seg
from tally.plans import fixtures as fx
from tally.plans.registry import query
from tally.session import cut_lineage

_RFM_SQL = """
rfm as (
  select o_custkey,
         cast(floor((epoch_us((select max(o_orderdate) + interval 1 day from orders)) - epoch_us(max(o_orderdate))) / 86400e6) as bigint) as recency,
         cast(count(distinct o_orderdate) as bigint) as frequency,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as monetary
  from orders group by o_custkey
),
q as (
  select quantile_cont(recency, [0.25, 0.5, 0.75]) as qr,
         quantile_cont(frequency, [0.25, 0.5, 0.75]) as qf,
         quantile_cont(monetary, [0.25, 0.5, 0.75]) as qm
  from rfm
),
scored as (
  select rfm.*,
    case when recency <= qr[1] then 1 when recency <= qr[2] then 2 when recency <= qr[3] then 3 else 4 end as r,
    case when frequency <= qf[1] then 4 when frequency <= qf[2] then 3 when frequency <= qf[3] then 2 else 1 end as f,
    case when monetary <= qm[1] then 4 when monetary <= qm[2] then 3 when monetary <= qm[3] then 2 else 1 end as m
  from rfm, q
),
scores as (
  select *, cast(r as varchar) || cast(f as varchar) || cast(m as varchar) as rfm_group, r + f + m as rfm_score
  from scored
),
ql as (select quantile_cont(rfm_score, [0.25, 0.5, 0.75]) as qs from scores),
levels as (
  select scores.*,
    case when rfm_score <= qs[1] then 'Diamond' when rfm_score <= qs[2] then 'Gold'
         when rfm_score <= qs[3] then 'Platinum' else 'Silver' end as loyalty_level
  from scores, ql
)"""


def _rfm(t):
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    return seg.rfm_scores(seg.rfm_table(o, "o_custkey", "o_orderdate", "o_totalprice"))


@query("rfm_scores", f"with {_RFM_SQL} select * from scores")
def rfm_scores(t):
    """B1 (flagship): recency / frequency / monetary per customer and quartile scores."""
    return _rfm(t)


@query("rfm_levels", f"with {_RFM_SQL} select * from levels")
def rfm_levels(t):
    """B2: loyalty level by quartile bins of the RFM score."""
    return seg.rfm_levels(_rfm(t))


@query(
    "segment_summary",
    f"""
with {_RFM_SQL},
per as (
  select loyalty_level, cast(sum(recency) as bigint) as recency_sum, cast(sum(frequency) as bigint) as frequency_sum,
         cast(sum(cast(monetary as decimal(18,2))) as double) as monetary_sum, count(distinct o_custkey) as num_buyers
  from levels group by loyalty_level
)
select *, round(num_buyers * 100.0::double / (select sum(num_buyers) from per), 2) as percent from per
""",
)
def segment_summary(t):
    """B3 + A8 + A10: per loyalty level sums, buyers and percent of buyers."""
    return seg.segment_summary(seg.rfm_levels(_rfm(t)), "o_custkey")


_ENGAGE_SELECT = """
select c_custkey, country, category, followers_text, followers,
       round(case when followers = 0 then 0.0 else engagement_avg / followers end * 100, 3) as engagement_rate,
       round(case when followers = 0 then 0.0 else (comments + likes + views) / followers end * 100, 3) as youtube_rate,
       followers / 1e6 as followers_m
from parsed"""


def _engagement(t):
    inf = fx.influencers(t)
    out = seg.engagement_rate(inf, "followers_text", "engagement_avg", ["comments", "likes", "views"])
    return out.select(
        "c_custkey", "country", "category", "followers_text", "followers", "engagement_rate", "youtube_rate", "followers_m"
    )


@query("engagement_rate", f"with {fx.INFLUENCERS_SQL} {_ENGAGE_SELECT}")
def engagement_rate(t):
    """Follower parsing and engagement rates (Instagram and YouTube formulas)."""
    return _engagement(t)


@query(
    "influencer_shortlist",
    f"""
with {fx.INFLUENCERS_SQL}, e as ({_ENGAGE_SELECT}),
tiered as (
  select 'instagram' as platform, *, engagement_rate as rate,
         case when followers_m < 60 then 'mini' when followers_m > 60 then 'mega' end as tier from e
  union all
  select 'youtube' as platform, *, youtube_rate as rate,
         case when followers_m <= 30 then 'mini' else 'mega' end as tier from e
),
ranked as (
  select *, row_number() over (partition by platform, country, category, tier
                               order by rate desc nulls last, c_custkey) as rank
  from tiered where tier is not null
)
select platform, country, category, tier, cast(rank as integer) as rank, c_custkey, followers_m, rate from ranked
""",
)
def influencer_shortlist(t):
    """B21 + O2: every influencer per (country, category, tier), ranked, on both platforms: Instagram by engagement
    rate with mini/mega at 60 M (exactly 60 M is neither), YouTube by its rate with <= 30 M mini."""
    e = cut_lineage(_engagement(t))  # one row per influencer, ranked twice
    insta = seg.influencer_shortlist(
        e.withColumn("rate", F.col("engagement_rate")), "country", "category", "rate", "c_custkey",
        threshold=seg.INSTAGRAM_THRESHOLD_M, boundary="neither",
    ).withColumn("platform", F.lit("instagram"))
    yt = seg.influencer_shortlist(
        e.withColumn("rate", F.col("youtube_rate")), "country", "category", "rate", "c_custkey",
        threshold=seg.YOUTUBE_THRESHOLD_M, boundary="mini",
    ).withColumn("platform", F.lit("youtube"))
    cols = ["platform", "country", "category", "tier", "rank", "c_custkey", "followers_m", "rate"]
    return insta.select(*cols).unionByName(yt.select(*cols))


@query(
    "top_n",
    f"""
with {fx.INFLUENCERS_SQL}
select c_custkey, followers_text, followers from parsed order by followers desc, c_custkey limit 10
""",
)
def top_n(t):
    """O1: the 10 most followed (a top-k report, so the limit is the feature)."""
    e = _engagement(t).select("c_custkey", "followers_text", "followers")
    return seg.top_n(e, F.col("followers").desc(), "c_custkey", 10)


@query(
    "value_counts",
    """
select n.n_name as country, count(*) as n
from customer c join nation n on n.n_nationkey = c.c_nationkey
where c.c_mktsegment = 'BUILDING' group by n.n_name
""",
)
def value_counts(t):
    """B22 + A11: audience countries of one category, counted."""
    c = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("country"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "country")
    )


@query(
    "first_per_group",
    """
select o_custkey, first_priority from (
  select o_custkey, nullif(o_orderpriority, '5-LOW') as first_priority,
         row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn
  from orders where nullif(o_orderpriority, '5-LOW') is not null)
where rn = 1
""",
)
def first_per_group(t):
    """First non-null priority per customer in order-date order."""
    o = t.orders.select(
        "o_custkey", "o_orderdate", "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    return seg.first_non_null(o, ["o_custkey"], "priority", ["o_orderdate", "o_orderkey"])


@query(
    "earnings_gap",
    f"""
with {fx.EARNINGS_SQL}, {fx.CPI_SQL}, {fx.RATES_SQL},
ye as (select distinct country, year, cast(make_date(year, 12, 31) as timestamp) as ts from earnings),
fxr as (select ye.country, ye.year, r.rate from ye asof left join rates r on ye.country = r.country and ye.ts >= r.rate_ts),
adj as (select e.*, round(round(e.amount * c.cpi / 100, 3) * fxr.rate, 3) as adjusted
        from earnings e left join cpi c using (country) left join fxr using (country, year)),
per as (
  select country, year, max(case when gender = 'F' then adjusted end) as female,
         max(case when gender = 'M' then adjusted end) as male
  from adj group by country, year
),
latest as (select *, max(year) over (partition by country) as ly from per)
select country, year as latest_year, female, male, round(male - female, 3) as gap,
       case when round(male - female, 3) > 0 then 'men earn more' when round(male - female, 3) < 0 then 'women earn more'
            when round(male - female, 3) = 0 then 'equal' end as verdict
from latest where year = ly
""",
)
def earnings_gap(t):
    """B19 + J14 + J15 + X29: CPI-adjusted amounts converted at the year-end rate (as-of join),
    then the male - female gap in each country's own latest year."""
    e = cut_lineage(fx.earnings(t))  # country x year x gender rows, used for the amounts and for the year ends
    return seg.earnings_gap(e, fx.cpi_by_nation(t), seg.year_end_rates(e, fx.daily_rates(t)))


_LISTED = ("NATION_1", "NATION_3", "NATION_4", "NATION_21", "NATION_24")


@query(
    "earnings_gap_listed",
    f"""
with {fx.EARNINGS_SQL}, {fx.CPI_SQL},
adj as (select e.*, round(e.amount * c.cpi / 100, 3) as adjusted from earnings e left join cpi c using (country) where country in {_LISTED}),
per as (select country, year, max(adjusted) filter (where gender = 'F') as female, max(adjusted) filter (where gender = 'M') as male
        from adj group by all),
latest as (select * from per qualify year = max(year) over (partition by country))
select country, year as latest_year, female, male, round(male - female, 3) as gap,
       case sign(round(male - female, 3)) when 1 then 'men earn more' when -1 then 'women earn more' when 0 then 'equal' end as verdict
from latest
""",
)
def earnings_gap_listed(t):
    """B19 + F2: the gap in a list of countries, without conversion."""
    return seg.earnings_gap(fx.earnings(t), fx.cpi_by_nation(t), countries=_LISTED)


@query(
    "cluster_means",
    f"""
with {_RFM_SQL}
select loyalty_level, avg(recency) as recency_mean, avg(frequency) as frequency_mean,
       cast(sum(cast(monetary as decimal(18,2))) as double) / count(*) as monetary_mean, count(*) as num_buyers
from levels group by loyalty_level
""",
)
def cluster_means(t):
    """B3, second half: means of the RFM figures and buyers per cluster (here the loyalty level stands for the cluster)."""
    return seg.cluster_means(seg.rfm_levels(_rfm(t)), "o_custkey", "loyalty_level")


@query(
    "asof_rate",
    """
select f.event_id, f.event_type, f.ts, f.value, r.value as rate
from (select * from events where user_id % 2 = 0) f
asof left join (select event_type, ts, value from events where user_id % 2 = 1) r
  on f.event_type = r.event_type and f.ts >= r.ts
""",
)
def asof_rate(t):
    """Each even-user event takes the latest odd-user value of its type at or before it."""
    e = t.events
    facts = e.filter(F.col("user_id") % 2 == 0).select("event_id", "event_type", "ts", "value")
    rates = e.filter(F.col("user_id") % 2 == 1).select("event_type", F.col("ts").alias("rate_ts"), F.col("value").alias("rate"))
    return joins.asof_join(facts, rates, ["event_type"], "ts", "rate_ts", "rate", bucket="day")
