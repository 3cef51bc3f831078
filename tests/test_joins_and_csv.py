"""As-of join value types and null keys; CSV lines with too many or too few fields."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.joins import asof_join
from tally.sources.io import read_csv_tolerant


@pytest.mark.parametrize(("kind", "a", "b"), [("string", "EUR", "USD"), ("decimal(20,4)", decimal.Decimal("1.2345"), decimal.Decimal("2.0000")), ("long", 2**53 + 1, 7)])
def test_asof_keeps_the_rate_type_and_matches_null_keys(spark, kind, a, b):
    t = lambda d, h: dt.datetime(2024, 1, d, h)
    facts = spark.createDataFrame([(1, "k", t(1, 5)), (2, "k", t(3, 5)), (3, None, t(1, 9)), (4, None, t(2, 9)), (5, "k", t(1, 1)), (6, "x", t(3, 1))], "id int, k string, at timestamp_ntz")
    rates = spark.createDataFrame([("k", t(1, 3), a), (None, t(1, 8), b)], f"k string, since timestamp_ntz, rate {kind}")
    out = asof_join(facts, rates, ["k"], "at", "since", "rate")
    assert out.schema["rate"].dataType == rates.schema["rate"].dataType
    assert {r["id"]: r["rate"] for r in out.collect()} == {1: a, 2: a, 3: b, 4: b, 5: None, 6: None}


def test_csv_lines_with_other_numbers_of_fields(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('a,b\n1,x\n2,y,\n3,z,,\n4\n5,v,,q\n6,"u,w"\nbad,t\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = [(r["a"], r["b"]) for r in read_csv_tolerant(spark, str(p), schema).orderBy(F.col("a").asc_nulls_last()).collect()]
    assert got == [(1, "x"), (4, None), (6, "u,w"), (None, "t")]
