"""Step 1 queries: scans, calendars, mixed text, cleaning, keys, tagged union and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.functions import scalar as X
from tally.operators import clean
from tally.plans.registry import query
from tally.sources import calendar as cal

LINEITEM_COLS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "scan_project",
    """
select event_id, user_id, cast(ts as date) as event_date, value
from events where event_type = 'purchase' and value > 10
""",
)
def scan_project(t):
    """S1 + P1 + F1: projection and filter pushed into the parquet scan."""
    return t.events.filter((F.col("event_type") == "purchase") & (F.col("value") > 10)).select(
        "event_id", "user_id", F.to_date("ts").alias("event_date"), "value"
    )


@query(
    "daily_totals",
    """
select cast(ts as date) as event_date,
       count(*) as n_events,
       cast(sum(cast(value as decimal(18,2))) as double) as total_value,
       count(case when event_type = 'purchase' then 1 end) as n_purchases,
       cast(coalesce(sum(case when event_type = 'purchase' then cast(value as decimal(18,2)) end), 0) as double) as purchase_value
from events group by 1
""",
)
def daily_totals(t):
    """Four measures summed per day; money summed as exact decimals (the same
    expressions as the streaming version in ``tally.streaming.daily``)."""
    from tally.streaming.daily import daily_measures

    return t.events.groupBy(F.to_date("ts").alias("event_date")).agg(*daily_measures())


@query(
    "calendar_months",
    """
with b as (select min(cast(o_orderdate as date)) as s, max(cast(o_orderdate as date)) as e from orders),
m as (select cast(unnest(generate_series(date_trunc('month', s), date_trunc('month', e), interval 1 month)) as date) as month_start from b)
select month_start, last_day(month_start) as month_end,
       cast(year(month_start) as integer) as year, cast(month(month_start) as integer) as month,
       monthname(month_start) as month_name, cast(day(last_day(month_start)) as integer) as days_in_month,
       cast(date_trunc('month', month_start - interval 3 month) as date) as metrics_start,
       cast(month_start + interval 1 month as date) as next_month_start
from m
""",
)
def calendar_months(t):
    """S8 + X32: month calendar spanning the order dates."""
    return cal.calendar_months(cal.date_range(t.orders, "o_orderdate"))


@query(
    "date_parts",
    """
select d as order_date, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
       cast(day(d) as integer) as day, cast(quarter(d) as integer) as quarter,
       monthname(d) as month_name, dayname(d) as day_name, cast(isodow(d) - 1 as integer) as weekday,
       cast(week(d) as integer) as iso_week, isodow(d) >= 6 as is_weekend,
       case when quarter(d) <= 2 then 1 else 2 end as semester
from (select distinct cast(o_orderdate as date) as d from orders)
""",
)
def date_parts(t):
    """X16-X20 on the distinct order dates."""
    d = t.orders.select(F.to_date("o_orderdate").alias("order_date")).distinct()
    return cal.date_parts(d, "order_date")


@query(
    "future_spine",
    """
select event_type, cast(ts as date) as ds, false as is_future from events group by all
union all
select event_type, cast(mx + cast(r.i as integer) as date) as ds, true as is_future
from (select event_type, max(cast(ts as date)) as mx from events group by 1) s, range(1, 101) r(i)
""",
)
def future_spine(t):
    """History dates per event type plus 100 future days."""
    return cal.future_spine(t.events, ["event_type"], "ts", periods=100)


@query(
    "mixed_columns",
    """
with p as (
  select p_partkey, case when p_partkey % 2 = 0 then cast(p_size as varchar) else p_name end as mixed,
         p_brand as cabin, p_type || ' ' || p_name || ' ' || cast(p_size as varchar) as ticket
  from part)
select p_partkey, mixed,
       try_cast(mixed as double) as mixed_number,
       case when try_cast(mixed as double) is null then mixed end as mixed_text,
       nullif(left(cabin, 1), '') as deck,
       nullif(regexp_extract(cabin, '(\\d+)', 1), '') as cabin_number,
       nullif(right(mixed, 1), '') as last_char,
       string_split_regex(trim(ticket), '\\s+')[1] as ticket_first,
       string_split_regex(trim(ticket), '\\s+')[-1] as ticket_last,
       try_cast(string_split_regex(trim(ticket), '\\s+')[-1] as double) as ticket_number,
       regexp_matches(string_split_regex(trim(ticket), '\\s+')[-1], '^[0-9]+$') as ticket_all_digits
from p
""",
)
def mixed_columns(t):
    """A mixed numeric/text column, a cabin-like code and a ticket-like text from part."""
    p = t.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_name")).alias("mixed"),
        F.col("p_brand").alias("cabin"),
        F.concat_ws(" ", "p_type", "p_name", F.col("p_size").cast("string")).alias("ticket"),
    )
    last = X.last_token("ticket")
    return p.select(
        "p_partkey",
        "mixed",
        X.number_or_null("mixed").alias("mixed_number"),
        X.non_numeric_part("mixed").alias("mixed_text"),
        X.first_char("cabin").alias("deck"),
        X.first_digits("cabin").alias("cabin_number"),
        X.last_char("mixed").alias("last_char"),
        X.first_token("ticket").alias("ticket_first"),
        last.alias("ticket_last"),
        X.number_or_null(last).alias("ticket_number"),
        X.all_digits(last).alias("ticket_all_digits"),
    )


@query(
    "human_number",
    """
select c_custkey, followers_text,
       try_cast(nullif(array_to_string(regexp_extract_all(upper(trim(followers_text)), '\\d+\\.?\\d*'), ''), '') as double)
         * case when upper(trim(followers_text)) like '%M' then 1e6
                when upper(trim(followers_text)) like '%K' then 1e3 else 1.0 end as followers
from (select c_custkey,
             cast(cast(abs(c_acctbal) as decimal(12,2)) as varchar)
               || case when c_custkey % 3 = 0 then 'K' when c_custkey % 3 = 1 then 'M' else '' end as followers_text
      from customer)
""",
)
def human_number(t):
    """X4 + X12: '1863.84M' -> 1.86384e9 with the suffix anchored at the end."""
    c = t.customer
    suffix = F.when(F.col("c_custkey") % 3 == 0, "K").when(F.col("c_custkey") % 3 == 1, "M").otherwise("")
    txt = F.concat(F.abs("c_acctbal").cast("decimal(12,2)").cast("string"), suffix)
    return c.select("c_custkey", txt.alias("followers_text")).withColumn(
        "followers", X.human_number("followers_text")
    )


_LI_ORDER = ", ".join(c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber"))


@query(
    "clean_dedupe",
    f"""
select {", ".join(LINEITEM_COLS)} from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LI_ORDER}) as rn
  from lineitem where l_orderkey is not null and l_linenumber is not null)
where rn = 1
""",
)
def clean_dedupe(t):
    """P12 + A20 + A21: drop null keys and duplicates, first row per (order, line) by all columns."""
    order = [F.col(c) for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]
    return clean.clean_dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], order, required=["l_orderkey", "l_linenumber"])


@query(
    "duplicate_rows",
    """
select md5(text) as text_md5, n_chars, count(*) as copies, min(doc_id) as first_id
from documents group by 1, 2 having count(*) > 1
""",
)
def duplicate_rows(t):
    """Exact copies of document texts (grouped by digest and length, not the long text)."""
    d = t.documents.select("doc_id", F.md5("text").alias("text_md5"), "n_chars")
    return clean.duplicate_groups(d, ["text_md5", "n_chars"], id_col="doc_id")


@query(
    "key_uniqueness",
    f"""
select {", ".join(LINEITEM_COLS)} from lineitem
where (l_orderkey, l_linenumber) not in (
  select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
""",
)
def key_uniqueness(t):
    """B8 + J6 + F8: drop every row whose (order, line) key is ambiguous."""
    return clean.drop_ambiguous_keys(t.lineitem.select(*LINEITEM_COLS), ["l_orderkey", "l_linenumber"])


@query(
    "clean_fill_mean_by_key",
    """
select user_id, count(*) as n_events,
       count(*) - count(v) as n_missing,
       cast(sum(cast(v as decimal(18,2))) as double) / count(v) as value_mean,
       cast(sum(cast(coalesce(v, 0) as decimal(18,2))) as double) / count(*) as value_filled_mean
from (select user_id, case when value > 400 then null else value end as v from events)
group by user_id
""",
)
def clean_fill_mean_by_key(t):
    """P9 + A2: values over 400 become missing; mean per user with and without filling 0."""
    e = t.events.select("user_id", F.when(F.col("value") > 400, None).otherwise(F.col("value")).alias("v"))
    filled = e.withColumn("v_filled", F.coalesce("v", F.lit(0.0)))
    return filled.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        (F.count(F.lit(1)) - F.count("v")).alias("n_missing"),
        clean.exact_mean("v").alias("value_mean"),
        clean.exact_mean("v_filled").alias("value_filled_mean"),
    )


def _train_test(t):
    o = t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("order_date"), "o_orderstatus"
    )
    train = o.filter(F.col("o_orderkey") % 5 != 0).withColumn(
        "target", (F.col("o_orderstatus") == "F").cast("int")
    ).drop("o_orderstatus")
    test = o.filter(F.col("o_orderkey") % 5 == 0).drop("o_orderstatus")
    return clean.union_tagged({"train": train, "test": test})


_TRAIN_TEST_SQL = """
u as (
  select o_orderkey, o_custkey, o_totalprice, cast(o_orderdate as date) as order_date,
         cast(o_orderstatus = 'F' as integer) as target, 'train' as tag
  from orders where o_orderkey % 5 <> 0
  union all
  select o_orderkey, o_custkey, o_totalprice, cast(o_orderdate as date) as order_date,
         cast(null as integer) as target, 'test' as tag
  from orders where o_orderkey % 5 = 0
)"""


@query("union_tag_split", f"with {_TRAIN_TEST_SQL} select * from u")
def union_tag_split(t):
    """Train (with target) and test (without) unioned by name and tagged."""
    return _train_test(t)


@query(
    "multi_left_join",
    f"""
with {_TRAIN_TEST_SQL},
m as (select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(o_totalprice) as o_totalprice_mean
      from u group by o_custkey)
select u.o_orderkey, u.o_totalprice, u.order_date, u.target,
       c.c_acctbal, c.c_mktsegment, n.n_name, m.o_totalprice_mean, u.tag as half
from u
left join customer c on c.c_custkey = u.o_custkey
left join nation n on n.n_nationkey = c.c_nationkey
left join m on m.o_custkey = u.o_custkey
""",
)
def multi_left_join(t):
    """B23 + J2 + O5: tagged union, four-way left join, split back into both halves, id columns dropped."""
    u = _train_test(t)
    means = clean.mean_by_key(u, "o_custkey", ["o_totalprice"], exact_scale=2)
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment")
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = clean.multi_left_join(u, [(cust, "o_custkey"), (nat, "c_nationkey"), (means, "o_custkey")])
    cols = ["o_orderkey", "o_totalprice", "order_date", "target", "c_acctbal", "c_mktsegment", "n_name", "o_totalprice_mean"]
    halves = [
        clean.split_tag(j, half, drop=["o_custkey", "c_nationkey"]).select(*cols, F.lit(half).alias("half")) for half in ("train", "test")
    ]
    return halves[0].unionByName(halves[1])
