"""Preparation fitted on training rows, profiles with awkward values, running sums, readers, plans without Expand."""

import datetime as dt
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.functions import text as tx
from tally.operators import clean, dims, forecast, joins, metrics, ml, profile
from tally.sources import io


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scaler_uses_training_rows_only(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    fitted = ml.fit_scaler(train, ["x", "y"])
    rows = ml.apply_scaler(spark.createDataFrame([(5.0, 9.0), (None, None)], "x double, y double"), fitted).collect()
    assert (rows[0].x_scaled, rows[0].y_scaled) == (3.0, 0.0) and rows[1].x_scaled is None and rows[1].y_scaled is None
    assert ml.apply_scaler(train, ml.fit_scaler(train.limit(0), ["x"])).first().x_scaled is None


def test_one_hot_learns_values_and_checks_their_number(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "v string")
    assert ml.fit_one_hot(df, "v") == ["a", "b", "c"]
    assert [c for c in ml.one_hot(df, "v", ml.fit_one_hot(df, "v")).columns] == ["v", "v_b", "v_c"]
    with pytest.raises(ValueError):
        ml.fit_one_hot(df, "v", most=2)


def test_ambiguous_keys_go_with_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0), (None, "d", 4.0), (None, "e", 5.0), (3, None, None)], "k int, v string, w double")
    out = clean.drop_ambiguous_keys(df, ["k"])
    plan = _plan(out)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert out.columns == df.columns and sorted(r.k for r in out.collect()) == [2, 3]
    assert clean.drop_ambiguous_keys(df.select("k"), ["k"]).count() == 2


def test_null_profile_of_awkward_values(spark):
    df = spark.createDataFrame(
        [(0.0, "a", [1], dt.datetime(2024, 1, 1), bytearray(b"\xff")), (-0.0, "a", [1], dt.datetime(2024, 1, 2), bytearray(b"\xfe")), (None, None, None, None, None), (float("nan"), "", [2], dt.datetime(2024, 1, 1), bytearray(b"\xff"))],
        "x double, s string, l array<int>, t timestamp, b binary",
    )
    out = profile.profile_nulls(df)
    got = {r.column_name: (r.n_rows, r.n_null, r.n_distinct) for r in out.collect()}
    assert got == {"x": (4, 1, 2), "s": (4, 1, 2), "l": (4, 1, 2), "t": (4, 1, 2), "b": (4, 1, 2)}
    assert [r.n_distinct for r in profile.profile_nulls(df.limit(0), ["x", "l"]).collect()] == [0, 0]
    assert "Expand" not in _plan(profile.profile_nulls(df, ["x", "s"]))


def test_crosstab_counts_nulls_as_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, 1)], "a string, b int")
    got = {(r.a, r.b): r.n for r in profile.crosstab_counts(df, "a", "b", complete=True).collect()}
    assert got == {("a", 1): 1, ("a", None): 1, (None, 1): 2, (None, None): 0}
    assert profile.crosstab_counts(df, "a", "b").count() == 3


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_over_many_buckets(spark, descending):
    rng = random.Random(3)
    base = 2**60  # keys a double cannot tell apart
    keys = rng.sample(range(base, base + 3000), 1000)
    df = spark.createDataFrame([(k, rng.randint(0, 9)) for k in keys], "k long, v long").repartition(5)
    got = {r.k: r.cum_v for r in metrics.global_running_sum(df, "k", ["v"], descending, buckets=16).collect()}
    total, want = 0, {}
    for r in sorted(df.collect(), key=lambda r: -r.k if descending else r.k):
        total += r.v
        want[r.k] = total
    assert got == want


def test_roc_with_ties_and_null_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 2)), float(rng.integers(0, 300)) / 7) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(6)
    y, s = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    pos, neg = s[y == 1], s[y == 0]
    area = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert metrics.auc(df, "label", "score").first().auc == pytest.approx(area)
    got = {r.threshold: (r.tp, r.fp) for r in metrics.roc_points(df, "label", "score").collect()}
    assert got == {v: (int((pos >= v).sum()), int((neg >= v).sum())) for v in set(s.tolist())}
    with pytest.raises(ValueError):
        metrics.roc_points(df.unionByName(spark.createDataFrame([(1, None)], "label int, score double")), "label", "score")


def test_vectors_of_documents_without_terms(spark):
    counts = spark.createDataFrame([(1, 0, 2), (1, 4, 1)], "doc_id int, term_index int, tf long")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id int")
    got = {r.doc_id: r.features.toArray().tolist() for r in tx.bow_vectors(docs, counts, ["a", "b", "c", "d", "e"], "doc_id").collect()}
    assert got == {1: [2.0, 0, 0, 0, 1.0], 2: [0.0] * 5}


def test_vectors_shuffle_numbers_and_counts_not_terms(spark):
    rng = random.Random(8)
    want = {d: [rng.choice([0, 0, 1, 3]) for _ in range(6)] for d in range(40)}
    rows = [(d, i, n) for d, each in want.items() for i, n in enumerate(each) if n]
    counts = spark.createDataFrame(rows, "doc_id int, term_index int, tf long").repartition(5)
    out = tx.bow_vectors(spark.range(40).selectExpr("cast(id as int) as doc_id"), counts, list("abcdef"), "doc_id")
    assert {r.doc_id: r.features.toArray().tolist() for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "partial_collect_list" in line]
    assert shuffled and not any("array_repeat" in line for line in shuffled)


def test_words_of_odd_texts_by_one_pattern(spark):
    import re

    texts = ["", " ", "a", "  Two  words ", "it's a-b_c\td\r\ne", "\u212aelvin \u0130stanbul STRASSE \u00dfx", "caf\u00e9 na\u00efve", "\U0001f600x\U0001f600\U0001f600y",
             "1234 !?", "\u00a0non\u2003breaking\u0085next", "ABC" * 2000 + " z", None]
    df = spark.createDataFrame(list(enumerate(texts)) + [(3, "again")], "k int, t string")
    out = tx.tokens_long(df, "k", "t", ("two", "again"))
    got = sorted((r.k, r.token) for r in out.collect())
    words = [(k, w.lower()) for k, t in enumerate(texts) for w in re.findall("[a-zA-Z]+", t or "")]
    assert got == sorted((k, w) for k, w in words if w != "two")
    assert "\\s+" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_centre_violations(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (0.9, 0)], "x double, cluster int")
    assert df.agg(ml.nearest_centre_violations(df, ["x"], [[0.0], [1.0]])).first().violations == 1


def test_planning_links(spark):
    day = dt.date
    rows = [
        ("i1", "L", None, "fmcg", "B1", day(2024, 1, 1)), ("i2", "L", day(2030, 1, 1), "other", "B2", day(2024, 2, 1)),
        ("i3", "", day(2020, 1, 1), "fmcg", "B3", day(2024, 1, 1)), ("i4", None, None, "fmcg", "B4", None),
    ]
    df = spark.createDataFrame(rows, "code string, linkage string, expiry date, kind string, brand string, modified date")
    got = dims.planning_links(df, "linkage", "code", "expiry", F.lit(day(2024, 6, 1)), "kind", "fmcg", "brand", "modified").collect()
    assert {tuple(r) for r in got} == {("L", "i2", "other", None), ("i4", "i4", "fmcg", "B4")}


def test_readers_and_lookups(spark):
    base = tempfile.mkdtemp(prefix="tally-read-")
    with open(os.path.join(base, "a.csv"), "w") as f:
        f.write("x,y\n1,a\n2,\n")
    with open(os.path.join(base, "b.tsv"), "w") as f:
        f.write("skipped\theader\n3\tc\n")
    rows = io.read_csv(spark, os.path.join(base, "a.csv"), "x int, y string").orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None)]
    assert [tuple(r) for r in io.read_csv(spark, os.path.join(base, "b.tsv"), "n int, s string", sep="\t").collect()] == [(3, "c")]
    p = os.path.join(base, "t")
    io.overwrite_table(spark.createDataFrame([(1, "a", 2.0)], "k int, v string, w double"), p)
    assert io.read_table(spark, p, ["v"]).columns == ["v"]
    look = joins.lookup_table(spark, {"a": 1.5}, "v", "rate", "string", "double")
    assert joins.lookup_join(io.read_table(spark, p), look, "v").first().rate == 1.5


def test_small_profiles(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 2),), (None,), (dt.date(2023, 5, 1),)], "d date")
    r = profile.profile_dates(d, "d").first()
    assert (r["count"], r["first"], r["last"]) == (2, dt.date(2023, 5, 1), dt.date(2024, 1, 2))
    s = spark.createDataFrame([("a", dt.date(2024, 1, 1), 0.0), ("a", dt.date(2024, 2, 1), 4.0)], "id string, month date, q double")
    m = forecast.panel_metadata(s, "id", "q").first()
    assert (m.months, m.zero_share, m.first_month, m.last_month) == (2, 0.5, dt.date(2024, 1, 1), dt.date(2024, 2, 1))


def test_promotions_are_aggregated_without_expand(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["promo_months"](spark, "/root/testdata/sf0.001"))
    assert "Expand" not in plan
