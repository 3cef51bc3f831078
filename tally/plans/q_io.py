"""Queries that send a given table through each reader and sink and give it back (S2-S6, K1-K9), column helpers
(P2, P4, P6, P13), head, tail and samples (O3), text by position (X9, X10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions import scalar as sc
from tally.operators import clean, segments as seg
from tally.plans.q_forecast import _ACTIVE_SQL, _ENS_SQL, RUN_A, RUN_B, _frames, published
from tally.plans.registry import query
from tally.session import scratch_path
from tally.sources import io
from tally.sources.activation import activate_run

CUSTOMER = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
_CUSTOMER_SQL = f"select {', '.join(CUSTOMER)} from customer"


def _customer(t):
    return t.customer.select(*CUSTOMER)


def _text_types(df) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


@query("csv_header", _CUSTOMER_SQL)
def csv_header(t):
    """S2 + K7: customers written as CSV with a header line and read with a schema."""
    path, src = scratch_path(t.spark), _customer(t)
    io.write_csv(src, path)
    return io.read_csv(t.spark, path, _text_types(src))


@query("tsv_scan", _CUSTOMER_SQL)
def tsv_scan(t):
    """The same through tab-separated text."""
    path, src = scratch_path(t.spark), _customer(t)
    src.write.option("header", True).option("sep", "\t").csv(path)
    return io.read_csv(t.spark, path, _text_types(src), sep="\t")


@query("csv_caller_names", "select c_custkey as id, c_name as title, c_mktsegment as segment, c_acctbal as balance from customer")
def csv_caller_names(t):
    """The caller's names, whatever the header line says."""
    path, src = scratch_path(t.spark), _customer(t)
    io.write_csv(src.withColumnsRenamed({"c_custkey": "c1\r", "c_name": "c 2"}), path)
    kinds = [f.dataType.simpleString() for f in src.schema.fields]
    return io.read_csv(t.spark, path, ", ".join(f"{n} {k}" for n, k in zip(("id", "title", "segment", "balance"), kinds)))


@query(
    "csv_bad_rows",
    """
select o_orderkey as k, case when o_orderkey % 11 = 0 then null else o_custkey end as c, case when o_orderkey % 5 = 0 then null else o_orderstatus end as s
from orders where o_orderkey % 7 <> 0
""",
)
def csv_bad_rows(t):
    """S3: lines with a field too many go, short ones are filled with null, what is no number is null."""
    k = F.col("o_orderkey")
    number = F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", k.cast("string"), number, F.when((k % 5 != 0) | (k % 7 == 0), F.col("o_orderstatus")), F.when(k % 7 == 0, F.lit("one,too,many")))
    path = scratch_path(t.spark)
    t.orders.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("k", t.orders.schema["o_orderkey"].dataType), T.StructField("c", t.orders.schema["o_custkey"].dataType), T.StructField("s", T.StringType())])
    return io.read_csv_tolerant(t.spark, path, schema, header=False)


@query(
    "country_lookup",
    """
select cast(n_nationkey as integer) as idx, n_name as name, case when n_nationkey = 7 then 'NA' else upper(substr(n_name, 1, 1)) || chr(cast(65 + n_nationkey as integer)) end as alpha2,
       upper(substr(n_name, 1, 3)) as alpha3, cast(100 + n_nationkey as integer) as country_code, r_name as region
from nation join region on r_regionkey = n_regionkey
""",
)
def country_lookup(t):
    """Nations as a lookup file of country codes, in which NA is a code."""
    n = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    two = F.when(F.col("n_nationkey") == 7, "NA").otherwise(F.concat(F.upper(F.substring("n_name", 1, 1)), F.char(F.col("n_nationkey") + 65)))
    rows = n.select(F.col("n_nationkey").alias("idx"), F.col("n_name").alias("name"), two.alias("alpha2"), F.upper(F.substring("n_name", 1, 3)).alias("alpha3"), (F.col("n_nationkey") + 100).alias("country_code"), F.col("r_name").alias("region"))
    path = scratch_path(t.spark)
    io.write_csv(rows, path)
    return io.country_codes(t.spark, path)


_STATUS = "o_orderkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as day"


def _orders(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"))


@query("append_rows", f"select {_STATUS} from orders")
def append_rows(t):
    """K1: finished orders, then the others, appended to one table partitioned by status."""
    path, src = scratch_path(t.spark), _orders(t)
    for part in (src.where("o_orderstatus = 'F'"), src.where("o_orderstatus <> 'F'")):
        io.append_table(part, path, partition_by=["o_orderstatus"])
    return t.spark.read.parquet(path).select(*src.columns)


@query("overwrite_rows", f"select {_STATUS} from orders where o_orderstatus = 'O'")
def overwrite_rows(t):
    """K2: a table of all orders, overwritten with the open ones."""
    path, src = scratch_path(t.spark), _orders(t)
    io.overwrite_table(src, path)
    io.overwrite_table(src.where("o_orderstatus = 'O'"), path)
    return t.spark.read.parquet(path)


@query("create_if_missing", "select false as there_before, true as there_after, count(*) as n_rows from region")
def create_if_missing(t):
    """K3 + K9: a table is created once, a second call leaves its rows alone, and the check sees it."""
    path, src = scratch_path(t.spark), t.region
    name = f"tally_{path[-12:]}"
    before = io.table_exists(t.spark, name)
    io.create_table_if_not_exists(t.spark, name, src.schema, path)
    io.append_table(src, path)
    io.create_table_if_not_exists(t.spark, name, src.schema, path)
    t.spark.catalog.refreshTable(name)
    n, after = t.spark.table(name).count(), io.table_exists(t.spark, name)
    t.spark.sql(f"drop table {name}")
    return t.spark.createDataFrame([(before, after, n)], "there_before boolean, there_after boolean, n_rows long")


@query("truncate_table", "select (select count(*) from nation) as n_before, cast(0 as bigint) as n_after")
def truncate_table(t):
    """K4: rows before and after a table is emptied."""
    path = scratch_path(t.spark)
    io.overwrite_table(t.nation, path)
    before = t.spark.read.parquet(path).count()
    return t.spark.createDataFrame([(before, io.truncate_path(t.spark, path, t.nation.schema))], "n_before long, n_after long")


@query(
    "run_log",
    """select 'status_' || o_orderstatus as experiment_name, 'count' as experiment_type, strftime(min(o_orderdate), '%Y-%m-%d') as start_time,
       strftime(max(o_orderdate), '%Y-%m-%d') as end_time from orders group by o_orderstatus""",
)
def run_log(t):
    """K6: one line per order status appended to a run log, with the first and last day of its orders."""
    path = scratch_path(t.spark)
    days = t.orders.groupBy("o_orderstatus").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("a"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("b"))
    for r in days.collect():  # one row per status
        io.append_run_log(t.spark, path, experiment_name=f"status_{r['o_orderstatus']}", experiment_type="count", start_time=r["a"], end_time=r["b"])
    return t.spark.read.parquet(path)


@query("distinct_periods", "select distinct cast(date_trunc('month', o_orderdate) as date) as period from orders")
def distinct_periods(t):
    """K8: the months that have orders, as a table."""
    return io.distinct_values(t.orders.select(F.to_date(F.trunc("o_orderdate", "MM")).alias("period")), "period")


@query("activate_run", f"with {_ENS_SQL}, {_ACTIVE_SQL} select * from act")
def activate_run_query(t):
    """K5: two runs appended as active; the flags are then written in place, period by period; a second call changes nothing."""
    path, frames = scratch_path(t.spark), _frames(t)
    for stamp, version in ((RUN_A, "v1"), (RUN_B, "v2")):
        io.append_table(published(t, stamp, version, frames), path, partition_by=["forecast_create_period"])
    layout = t.spark.read.parquet(path).columns
    changed = activate_run(t.spark, path)
    if changed and activate_run(t.spark, path):
        raise AssertionError("a second activation found stale flags")
    return t.spark.read.parquet(path).select(*layout).withColumn("forecast", F.col("forecast").cast("double"))


# ---- column helpers ------------------------------------------------------------------------------


@query("columns_by_position", "select o_orderkey, o_custkey, o_orderstatus from orders")
def columns_by_position(t):
    """The first three columns."""
    return clean.select_by_position(t.orders, 0, 3)


@query("drop_columns", "select o_orderkey, o_totalprice from (select o_orderkey, o_orderstatus, o_totalprice from orders)")
def drop_columns(t):
    """P3 + P4: a column that is there and one that is not are dropped."""
    return clean.drop_if_exists(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderstatus", "no_such_column"])


@query("bulk_cast", "select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber, l_quantity from lineitem")
def bulk_cast(t):
    """Several columns to text in one projection."""
    return clean.cast_columns(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey", "l_linenumber"], "string")


@query("columns_by_type", "select s_suppkey, s_nationkey, s_acctbal, 'text' as kept from supplier")
def columns_by_type(t):
    """The numeric columns of suppliers."""
    return t.supplier.select(*clean.numeric_columns(t.supplier), F.lit("text").alias("kept"))


# ---- head, tail, samples ---------------------------------------------------------------------------


@query("head_rows", "select o_orderkey, o_totalprice from orders order by o_orderkey limit 7")
def head_rows(t):
    """O3: the first seven orders by key."""
    return seg.head(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_orderkey")], 7)


@query("tail_rows", "select o_orderkey, o_totalprice from orders order by o_orderkey desc limit 7")
def tail_rows(t):
    """O3: the last seven orders by key."""
    return seg.tail(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_orderkey")], 7)


@query("sample_rows", "select o_orderkey, o_custkey from orders order by md5('3:' || cast(o_orderkey as varchar)), o_orderkey limit 500")
def sample_rows(t):
    """O3: 500 orders by the hash of their key."""
    return seg.sample_rows(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 500, seed=3)


@query("sample_share", "select o_orderkey, o_custkey from orders where substr(md5('3:' || cast(o_orderkey as varchar)), 1, 4) < '1000'")
def sample_share(t):
    """O3: a sixteenth of the orders by the hash of their key."""
    return seg.sample_share(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 1 / 16, seed=3)


# ---- text by position ------------------------------------------------------------------------------

_URL = "regexp_replace(url, '^[a-z]+://', '')"


@query(
    "text_parts",
    f"""
select page_id, split_part({_URL}, '/', 1) as host, case when len(string_split(url, '.')) > 1 then array_to_string(string_split(url, '.')[-2:], '.') else url end as last_two,
       trim(url, 'htps:') as bare, cast(page_id as varchar) || '#' || url as named
from pages""",
)
def text_parts(t):
    """SUBSTRING_INDEX from either end, TRIM and CONCAT on page addresses."""
    address = F.regexp_replace("url", "^[a-z]+://", "")
    return t.pages.select(
        "page_id", sc.before_nth(address, "/", 1).alias("host"), sc.before_nth("url", ".", -2).alias("last_two"), sc.trimmed("url", "htps:").alias("bare"), sc.joined("page_id", F.lit("#"), "url").alias("named")
    )


@query(
    "text_slices",
    """
select c_custkey, substr(c_name, 1, 5) as first_five, right(c_name, least(4, length(c_name))) as last_four,
       substr(c_name, 3, greatest(length(c_name) - 4, 0)) as inner_part, string_split(c_name, '#')[1:1] as first_field
from customer""",
)
def text_slices(t):
    """Slices of text by position from both ends, and of an array."""
    n = "c_name"
    return t.customer.select(
        "c_custkey", sc.slice_text(n, None, 5).alias("first_five"), sc.slice_text(n, -4).alias("last_four"), sc.slice_text(n, 2, -2).alias("inner_part"), sc.slice_array(F.split(n, "#"), 0, 1).alias("first_field")
    )
