"""Range joins and closures against plain loops; changepoints and conformal bands on planted data."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tally.operators import changepoints as cp
from tally.operators.closure import cycles, hierarchy_closure, roots
from tally.operators.ranges import range_join


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("seed, spread, longest", [(1, 50, 5), (2, 10_000, 3000), (3, 10**9, 10**7), (4, 1, 1), (5, 4000, 2)])
def test_range_join_by_brute_force(spark, seed, spread, longest):
    rng = random.Random(seed)
    points = [(i, rng.randint(-spread, spread) if rng.random() > 0.05 else None, rng.choice(["a", "b", None])) for i in range(300)]
    spans = []
    for i in range(200):
        lo = rng.randint(-spread - 10, spread + 10)
        hi = lo + rng.choice([0, 1, -1, rng.randint(0, longest), 2 * spread])
        spans.append((i, lo if rng.random() > 0.05 else None, hi if rng.random() > 0.1 else None, rng.choice(["a", "b", None])))
    p = spark.createDataFrame(points, "i long, at long, k string")
    s = spark.createDataFrame(spans, "j long, lo long, hi long, k string")
    for on in ([], ["k"]):
        q = p if on else p.drop("k")
        j = range_join(q, s if on else s.drop("k"), "at", "lo", "hi", on=on, top_buckets=rng.choice([1, 4, 64]))
        assert "CartesianProduct" not in _plan(j) and "BroadcastNestedLoopJoin" not in _plan(j)
        got = sorted((r["i"], r["j"]) for r in j.collect())
        want = sorted((i, x) for i, at, k in points for x, lo, hi, m in spans if at is not None and (lo is None or lo <= at) and (hi is None or at <= hi) and (not on or (k == m and k is not None)))
        assert got == want


def test_keyed_range_join_cuts_intervals_of_crowded_keys_only(spark, monkeypatch):
    from tally.operators import ranges

    rng = random.Random(9)
    # key: points, intervals; one has many of both, two have many of one, the others few
    sizes = {"both": (120, 90), "points": (150, 3), "spans": (4, 160), "few": (5, 6), None: (40, 40)}
    points = [(n, rng.randint(0, 500), k) for k, (m, _) in sizes.items() for n in range(m)]
    spans = [(n, lo if rng.random() > 0.1 else None, lo + rng.randint(-2, 60) if rng.random() > 0.1 else None, k) for k, (_, m) in sizes.items() for n in range(m) for lo in [rng.randint(0, 500)]]
    p, s = spark.createDataFrame(points, "i long, at long, k string"), spark.createDataFrame(spans, "j long, lo long, hi long, k string")
    want = sorted((k, i, j) for i, at, k in points for j, lo, hi, m in spans if k is not None and k == m and (lo is None or lo <= at) and (hi is None or at <= hi))
    assert "Generate" not in _plan(range_join(p, s, "at", "lo", "hi", on=["k"]))
    monkeypatch.setattr(ranges, "FEW", 20)
    j = range_join(p, s, "at", "lo", "hi", on=["k"])
    assert "Generate" in _plan(j) and j.columns == ["i", "at", "k", "j", "lo", "hi"]
    assert sorted((r["k"], r["i"], r["j"]) for r in j.collect()) == want


def test_range_join_of_dates_and_times(spark):
    day = dt.date(2024, 1, 1)
    p = spark.createDataFrame([(day + dt.timedelta(i),) for i in range(400)], "d date")
    s = spark.createDataFrame([("year", day, None), ("week", day + dt.timedelta(3), day + dt.timedelta(9)), ("none", day, day - dt.timedelta(1))], "name string, a date, b date")
    got = {r["name"]: r["count"] for r in range_join(p, s, "d", "a", "b").groupBy("name").count().collect()}
    assert got == {"year": 400, "week": 7}
    t = p.select(F.col("d").cast("timestamp").alias("t"))
    u = s.select("name", F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert {r["name"]: r["count"] for r in range_join(t, u, "t", "a", "b").groupBy("name").count().collect()} == got
    assert range_join(p.limit(0), s, "d", "a", "b").count() == range_join(p, s.limit(0), "d", "a", "b").count() == 0
    with pytest.raises(ValueError):
        range_join(p, s.withColumnRenamed("a", "d"), "d", "d", "b")


def test_a_long_interval_is_a_few_rows(spark):
    from tally.operators.ranges import cover

    s = spark.range(1000).select((F.col("id") * 37).alias("lo"), F.lit(10**9 + 7).cast("long").alias("hi"))
    rows = s.select(F.size(cover(F.col("lo"), F.col("hi"), 0, 22)).alias("n")).agg(F.max("n")).first()[0]
    assert rows < 300


def _closure_naive(edges):
    up = {}
    for c, p in edges:
        if c is not None and p is not None:
            up.setdefault(c, set()).add(p)
    out = {}
    for node in up:
        level, depth, seen = {node}, 0, {}
        while level:
            depth += 1
            level = {p for x in level for p in up.get(x, ())} - set(seen)
            seen.update(dict.fromkeys(level, depth))
        out.update({(node, a): d for a, d in seen.items()})
    return out


def test_closure_by_brute_force(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 137)]
    tree = [(i, rng.randint(0, i - 1)) for i in range(1, 60)]
    several = [(200 + i, 200 + rng.randint(0, i - 1)) for i in range(1, 30) for _ in range(3)]
    loops = [(300, 301), (301, 302), (302, 300), (303, 300), (310, 310)]
    edges = chain + tree + several + loops + [(None, 5), (400, None), (100, 101)]
    got = hierarchy_closure(spark.createDataFrame(edges, "c long, p long"), "c", "p")
    want = _closure_naive(edges)
    assert {(r["node"], r["ancestor"]): r["depth"] for r in got.collect()} == want and got.count() == len(want)
    assert {r["node"]: r["length"] for r in cycles(got).collect()} == {300: 3, 301: 3, 302: 3, 310: 1}
    assert {r["node"]: r["root"] for r in roots(got).where("node between 100 and 136").collect()} == {i: 137 for i in range(100, 137)}
    assert hierarchy_closure(spark.createDataFrame([], "c string, p string"), "c", "p").count() == 0


def _planted(n=1500, at=(300, 560), slopes=(2.0, -1.5, 1.0), noise=0.02, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(n) / 365.25
    y = 10 + slopes[0] * t
    for c, before, after in zip(at, slopes, slopes[1:]):
        y = y + (after - before) * np.maximum(0, t - c / 365.25)
    y = y + 0.3 * np.sin(2 * np.pi * np.arange(n) / 7) + rng.normal(0, noise, n)
    return pd.date_range("2020-01-01", periods=n).date, y


def test_planted_breaks_are_found_and_parts_add_up(spark):
    days, y = _planted()
    flat = 5 + 0.2 * np.arange(1500) / 365.25
    rows = [("broken", d, float(v)) for d, v in zip(days, y)] + [("straight", d, float(v)) for d, v in zip(days, flat)]
    rows += [("one", days[0], 3.0), ("two", days[0], 3.0), ("two", days[40], None)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["s", "d", "v"]))
    fit = cp.Trend(df, "s", "d", "v", penalty=0.01)
    found = fit.changepoints().toPandas()
    for at, change in ((300, -3.5), (560, 2.5)):
        near = found[(found.s == "broken") & np.array([abs((c - days[at]).days) <= 60 for c in found.changepoint], dtype=bool)]
        assert near.delta.sum() == pytest.approx(change, abs=0.8)
    far = found[(found.s == "broken") & np.array([min(abs((c - days[a]).days) for a in (300, 560)) > 60 for c in found.changepoint], dtype=bool)]
    assert far.delta.abs().max() < 0.3 or not len(far)
    straight = found[found.s == "straight"]
    assert straight.delta.abs().max() < 0.05 or not len(straight)
    c = fit.components().toPandas()
    assert len(c) == 3002 and np.allclose(c.trend + c.weekly + c.yearly, c.yhat)
    b = c[c.s == "broken"]
    assert np.abs(b.yhat - b.y).mean() < 0.15 and b.weekly.abs().max() == pytest.approx(0.3, abs=0.05)
    assert all(r["broken"] == 0 for r in fit.conditions().where("s in ('broken', 'straight')").collect())
    ahead = spark.createDataFrame([("broken", days[-1] + dt.timedelta(30))], "s string, ds date")
    assert fit.components(ahead).count() == 1
    assert cp.Trend(df.limit(0), "s", "d", "v").components().count() == 0


def test_lasso_conditions():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 9))
    x[:, 8] = 0.0
    y = x[:, 3] * 2 - x[:, 6] + rng.normal(size=200)
    g, c = x.T @ x, x.T @ y
    b, weight = cp.solve_lasso(g, c, 3, 0.2, 1e-9)
    grad = c - g @ b
    assert np.abs(grad[:3]).max() < 1e-6 and b[8] == 0
    on = np.flatnonzero(b[3:]) + 3
    assert 0 < len(on) < 6 and np.allclose(grad[on], weight * np.sign(b[on])) and (np.abs(grad[3:]) <= weight * (1 + 1e-9)).all()


def test_conformal_bands_cover(spark):
    rng = np.random.default_rng(0)
    rows = [(h, float(rng.normal(0, h)), 0.0) for h in range(1, 6) for _ in range(400)] + [(9, None, 1.0), (8, 2.0, 1.0)]
    bt = spark.createDataFrame(rows, "horizon_days int, y double, yhat double")
    got = {r["horizon_days"]: r for r in cp.conformal_bands(bt).collect()}
    assert got.keys() == {1, 2, 3, 4, 5, 8} and got[8]["half_width"] == 1.0
    for h in range(1, 6):
        r = np.abs([y for k, y, _ in rows if k == h])
        assert got[h]["half_width"] == pytest.approx(np.quantile(r, 0.8)) and abs(got[h]["covered"] - 0.8) <= 0.01 and got[h]["n"] == 400
    banded = cp.with_bands(bt, cp.conformal_bands(bt)).where("horizon_days = 9").first()
    assert banded["yhat_lower"] is None and banded["yhat"] == 1.0
