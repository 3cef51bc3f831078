"""Correlations of many columns, stored profiles, coresets, activation in place, text by position."""

import glob
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tally.functions import scalar as sc
from tally.operators import coreset, correlation, ml, profile_store as store, segments as seg
from tally.sources import io
from tally.sources.activation import activate_run, stale_periods


def test_two_hundred_columns_against_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 200)) + 1e6
    x[:, 1] = 5.0
    x[:, 2] = np.nan
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(200)]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x.tolist()], ", ".join(f"{n} double" for n in names)).repartition(5)
    out = correlation.correlations(df, names, block=64, decimals=9)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    got = {(r["col_a"], r["col_b"]): r for r in out.collect()}
    want = pdf.corr()
    known = pdf.notna().to_numpy()
    assert len(got) == 200 * 200
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            r, w = got[a, b], want.loc[a, b]
            assert r["n"] == (known[:, i] & known[:, j]).sum()
            assert (r["corr"] is None and np.isnan(w)) or r["corr"] == pytest.approx(w, abs=1e-8), (a, b)
    none = correlation.correlations(df.limit(0), names[:3]).collect()
    assert len(none) == 9 and all(r["corr"] is None and r["n"] == 0 for r in none)


def _days(spark):
    rng = np.random.default_rng(2)
    rows = [(f"d{i % 9}" if i % 50 else None, float(v), None if i % 7 == 0 else int(v * 10) % 40, f"t{i % 23}" if i % 5 else None) for i, v in enumerate(rng.normal(50, 9, 3000))]
    return spark.createDataFrame(rows, "day string, x double, k int, s string")


def test_merged_profile_equals_a_full_scan(spark):
    df = _days(spark)
    cols = ["x", "k", "s"]
    stored = store.profile_parts(df.where("day is null or day < 'd5'"), "day", cols)
    stored = store.replace_parts(stored, store.profile_parts(df.where("day >= 'd5'"), "day", cols))
    again = store.replace_parts(stored, store.profile_parts(df.where("day = 'd2' or day is null"), "day", cols))
    pdf = df.toPandas()
    for parts in (stored, again):
        got = {r["column_name"]: r for r in store.profile_report(parts).collect()}
        assert got.keys() == set(cols) and all(r["n_rows"] == 3000 and r["n_parts"] == 10 for r in got.values())
        for c in cols:
            v = pdf[c].dropna()
            assert got[c]["n_null"] == 3000 - len(v) and abs(got[c]["approx_distinct"] - v.nunique()) <= 0.05 * v.nunique()
        for c in ("x", "k"):
            v = pdf[c].dropna().astype(float)
            assert got[c]["mean"] == pytest.approx(v.mean()) and got[c]["std"] == pytest.approx(v.std())
            assert float(got[c]["least"]) == v.min() and float(got[c]["largest"]) == v.max()
            for q, p in store.QUANTILES.items():
                assert (v < got[c][f"approx_{q}"]).mean() <= p + 0.02 and (v <= got[c][f"approx_{q}"]).mean() >= p - 0.02
        assert got["s"]["mean"] is None and got["s"]["least"] == "t0" and got["s"]["largest"] == "t9" and got["s"]["approx_q50"] is None
    assert store.profile_report(store.profile_parts(df.limit(0), "day", cols)).count() == 0


def _blobs(spark, n=30_000):
    rng = np.random.default_rng(7)
    centres = rng.uniform(-20, 20, (6, 3))
    x = centres[rng.integers(0, 6, n)] + rng.normal(0, 1.0, (n, 3))
    x[:50] *= 8  # far rows, which a uniform sample may miss
    return spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]))


def test_costs_from_a_coreset_are_near_full_fits(spark):
    df = _blobs(spark)
    got = {r["k"]: r["wcss"] for r in coreset.elbow(df, ["a", "b", "c"], range(1, 9), size=2000).collect()}
    x = df.toPandas().to_numpy()
    assert got[1] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum(), rel=0.05)
    for k in (2, 4, 6, 8):
        own = coreset.weighted_kmeans(x, np.ones(len(x)), k, starts=4)
        best = min((np.square(x[:, None] - own[None]).sum(axis=2).min(axis=1)).sum(), ml.kmeans_elbow(df, ["a", "b", "c"], ks=[k]).first()["wcss"])
        assert got[k] <= 1.05 * best
    points = coreset._points(df, ["a", "b", "c"])
    y, w = coreset.coreset(points, 8, size=2000)
    assert len(y) < 2600 and w.sum() == pytest.approx(len(x), rel=0.1)


def test_coresets_of_few_and_awkward_rows(spark):
    few = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    got = {r["k"]: r["wcss"] for r in coreset.elbow(few, ["a", "b"], [1, 2, 5]).collect()}
    assert got[1] == pytest.approx(2 * (2 / 3) ** 2 * 2 + (4 / 3) ** 2 * 2) and got[2] == got[5] == 0
    assert {r["wcss"] for r in coreset.elbow(few.limit(0), ["a", "b"], [1, 2]).collect()} == {0.0}


def _state(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/*/*.parquet")}


def test_activation_touches_stale_periods_only(spark, tmp_path):
    path = str(tmp_path / "published")
    layout = "forecast_create_period string, application string, create_timestamp timestamp, product string, active int"

    def rows(*of):
        return spark.createDataFrame([(p, a, pd.Timestamp(s).to_pydatetime(), x, 1) for p, a, s, x in of], layout)

    first = rows(("p1", "app", "2024-01-01", "x"), ("p1", "app", "2024-01-01", "y"), ("p2", "app", "2024-02-01", "x"), ("p1", "other", "2023-01-01", "z"))
    io.append_table(first, path, ["forecast_create_period"])
    assert activate_run(spark, path) == 0
    before = _state(path)
    io.append_table(rows(("p1", "app", "2024-01-05", "x")), path, ["forecast_create_period"])
    assert [r[0] for r in stale_periods(spark.read.parquet(path)).collect()] == ["p1"]
    assert activate_run(spark, path) == 1
    after = _state(path)
    kept = [f for f in before if "period=p2" in f]
    assert kept and all(after[f] == before[f] for f in kept)
    got = sorted((r["forecast_create_period"], r["application"], r["product"], str(r["create_timestamp"])[:10], r["active"]) for r in spark.read.parquet(path).collect())
    assert got == [("p1", "app", "x", "2024-01-01", 0), ("p1", "app", "x", "2024-01-05", 1), ("p1", "app", "y", "2024-01-01", 0), ("p1", "other", "z", "2023-01-01", 1), ("p2", "app", "x", "2024-02-01", 1)]
    assert activate_run(spark, path) == 0 and _state(path) == after


def test_text_and_arrays_by_position(spark):
    texts = ["abcdef", "ab", "", None, "é日本x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for start, stop in ((None, 3), (-2, None), (1, -1), (2, 2), (0, 99), (-99, 1), (4, 1), (None, None)):
        got = [r[0] for r in df.select(sc.slice_text("t", start, stop)).collect()]
        assert got == [None if t is None else t[start:stop] for t in texts], (start, stop)
    arrays = spark.createDataFrame([([1, 2, 3],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in arrays.select(sc.slice_array("a", 1, 3)).collect()] == [[2, 3], [], None]
    row = spark.range(1).select(sc.before_nth(F.lit("a.b.c"), ".", 2), sc.before_nth(F.lit("a.b.c"), ".", -1), sc.before_nth(F.lit("abc"), ".", 1), sc.trimmed(F.lit("  x ")), sc.joined(F.lit("a"), F.lit(None)), sc.joined(F.lit(1), F.lit("b"))).first()
    assert tuple(row) == ("a.b", "c", "abc", "x", None, "1b")


def test_head_tail_and_samples(spark):
    df = spark.createDataFrame([(i, i % 3 or None) for i in range(100)], "k int, g int").repartition(7)
    assert [r["k"] for r in seg.head(df, [F.col("k")], 4).collect()] == [0, 1, 2, 3]
    assert [r["k"] for r in seg.tail(df, [F.col("k")], 4).collect()] == [96, 97, 98, 99]
    assert [r["g"] for r in seg.tail(df, [F.col("g"), F.col("k")], 1).collect()] == [2]
    a, b = ({r["k"] for r in seg.sample_rows(d, "k", 10, seed=5).collect()} for d in (df, df.repartition(2)))
    assert a == b and len(a) == 10
    assert seg.sample_share(df, "k", 1.0).count() == 100 and seg.sample_share(df, "k", 0.0).count() == 0
    assert seg.head(df.limit(0), [F.col("k")]).count() == seg.tail(df.limit(0), [F.col("k")]).count() == 0


def test_correlations_go_through_the_rows_once_and_leave_the_session_as_it_was(spark):
    from tally.operators import correlation

    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    rows = spark.range(50).select(*[F.when(F.col("id") % (i + 5) != 0, F.col("id") * (i + 1) % 11).alias(f"v{i}") for i in range(4)])
    j = correlation.correlations(rows.withColumn("v0", F.when(F.col("v0") == 3, float("nan")).otherwise(F.col("v0"))), [f"v{i}" for i in range(4)], block=2)
    assert "MapInPandas" not in j._jdf.queryExecution().toString()
    assert j.count() == 16 and {r["n"] for r in j.collect() if r["col_a"] == r["col_b"] == "v3"} == {rows.where("v3 is not null").count()}
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
