"""Promotion rows are dealt out once for all that is counted per name, features once for groups, leads and joins."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tally.operators import promo

DAY = dt.date(2023, 1, 10)
PROMOS = "warehouse string, apply_on string, er_category_to_apply_on string, brand string, item_code string, name string, valid_from date, valid_upto date, discount_percentage double, discount_amount double"
MONTHS = "promo_warehouse string, apply_on string, promo_brand string, promo_item_sub_category string, item_linkage string, month date, schemes long, avg_discount_amount double, avg_discount_percentage double, max_days_of_promo int, avg_days_of_promo double"
PLACES = "higher_hier_warehouse string, city string, global_id string, replenishment_center string"


def _exchanges(df):
    return re.findall(r"Exchange (hashpartitioning\(.*)", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def months(spark):
    end = dt.date(2023, 2, 20)
    rows = [
        ("W", "Brand", None, "B", None, "n1", DAY, end, 10.0, 1.0),
        ("W", "Brand", None, "B", None, "n1", DAY, end, 10.0, 1.0),  # the same row again
        ("W", "Brand", None, "B", None, "n1", DAY, DAY, 20.0, 4.0),  # the same name at another percentage
        ("W", "Brand", None, "B", None, None, DAY, DAY, 30.0, None),  # no name: no scheme, but days and a percentage
        ("W", "Brand", None, "B", None, "n2", DAY, None, 90.0, 9.0),  # open: never active
    ]
    items = spark.createDataFrame([("7", "L7")], "item_code string, item_linkage string")
    first, last = F.lit("2023-01-01").cast("date"), F.lit("2023-06-30").cast("date")
    return promo.promo_months(spark.createDataFrame(rows, PROMOS), items, first, last)


def test_names_are_counted_where_the_promotions_lie(months):
    by_name = [e for e in _exchanges(months) if re.search(r"\bname#", e)]
    assert by_name and all("REPARTITION_BY_COL" in e for e in by_name)


def test_month_measures_of_repeated_and_null_names(months):
    got = {r["month"].month: r for r in months.collect()}
    assert sorted(got) == [1, 2]
    assert (got[1]["schemes"], got[1]["avg_discount_amount"], got[1]["avg_discount_percentage"], got[1]["max_days_of_promo"]) == (1.0, 2.5, 20.0, 22)
    assert (got[2]["schemes"], got[2]["avg_discount_amount"], got[2]["avg_discount_percentage"], got[2]["max_days_of_promo"]) == (1.0, 1.0, 10.0, 20)


def test_features_are_shuffled_once_and_join_where_they_lie(spark):
    rows = [("W", s, "B", c, k, dt.date(2023, m, 1), m, 1.0, 2.0, 3, 4.0) for s, c, k in (("Brand", "", None), ("sub_cateogry", "C", None), ("Item Code", "", "L")) for m in (1, 2, 4)]
    places = spark.createDataFrame([("W", "X", "G", "R"), ("W", "Y", "G", "R")], PLACES)
    feats = promo.promo_features(spark.createDataFrame(rows, MONTHS), F.broadcast(places), level="own")
    assert len(_exchanges(feats)) == 1
    means = feats.groupBy("apply_on", "location", "own", "month").agg(F.avg("schemes_lead_1").alias("next"))
    assert len(_exchanges(means)) == 1
    got = {(r["apply_on"], r["location"][0], r["own"], r["month"].month): r["next"] for r in means.collect()}
    assert got == {(s, c, k, m): n for s, k in (("Brand", "B"), ("sub_cateogry", "C"), ("Item Code", "L")) for c in "XY" for m, n in ((1, 2.0), (2, 4.0), (4, 0.0))}
    assert "_level" not in promo.promo_features(spark.createDataFrame(rows, MONTHS), places).columns
