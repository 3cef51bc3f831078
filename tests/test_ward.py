"""Ward's clustering against a search over all pairs, and its summary."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.operators import ward


def _naive(points, weights):
    live = {i: (float(w), np.array(p, float)) for i, (p, w) in enumerate(zip(points, weights))}
    out = []
    for k in range(len(points) - 1):
        best = min((na * nb / (na + nb) * float(np.square(a - b).sum()), i, j) for i, (na, a) in live.items() for j, (nb, b) in live.items() if i < j)
        inc, i, j = best
        (na, a), (nb, b) = live.pop(i), live.pop(j)
        live[len(points) + k] = (na + nb, (na * a + nb * b) / (na + nb))
        out.append((i, j, inc, na + nb))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_merges_by_brute_force(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rng.integers(2, 60), 3)) if seed % 2 else rng.integers(0, 6, (40, 2)).astype(float)
    x, n = np.unique(x, axis=0, return_counts=True)
    n = n * rng.integers(1, 4, len(n))
    got, want = ward.merges(n, x), _naive(x, n)
    assert np.allclose([g[2] for g in got], [w[2] for w in want])
    if seed % 2:  # no ties
        assert [(g[:2], g[3]) for g in got] == [(w[:2], w[3]) for w in want]


def _points(spark, n=4000):
    rng = np.random.default_rng(3)
    centres = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [12.0, 12.0]])
    at = rng.integers(0, 4, n)
    x = centres[at] + rng.normal(0, 0.7, (n, 2))
    rows = [(i, int(c), float(a), float(b), 0) for i, (c, (a, b)) in enumerate(zip(at, x))]
    rows += [(n + i, -1, None, 1.0, 0) for i in range(3)] + [(n + 5, -1, float("nan"), 1.0, 0)]
    return spark.createDataFrame(rows, "id long, planted int, a double, b double, n int").repartition(6)


def test_below_the_bound_it_is_ward_on_all_rows(spark):
    df = _points(spark, 90).unionByName(_points(spark, 20))  # some points twice
    w = ward.Ward(df, ["a", "b"], most=200)
    x = np.array([(r["a"], r["b"]) for r in df.where("a is not null and not isnan(a)").collect()])
    u, n = np.unique(x, axis=0, return_counts=True)
    want = _naive(u, n)
    rows = w.merges().orderBy("step").collect()
    assert [(r["left"], r["right"], r["n_rows"]) for r in rows] == [(a, b, int(c)) for a, b, _, c in want]
    assert np.allclose([r["increase"] for r in rows], [c for _, _, c, _ in want])
    assert np.allclose([r["height"] ** 2 / 2 for r in rows], [c for _, _, c, _ in want])


def test_the_summary_is_bounded_and_keeps_planted_clusters(spark):
    df = _points(spark)
    w = ward.Ward(df, ["a", "b"], most=60)
    assert len(w.n) <= 60 and w.n.sum() == 4000
    x = np.array([(r["a"], r["b"]) for r in df.where("planted >= 0").collect()])
    total = ((x - x.mean(axis=0)) ** 2).sum()
    assert w.within.sum() + sum(s[2] for s in w.steps) == pytest.approx(total)
    got = w.segments(4).collect()
    assert all(r["cluster"] is None for r in got if r["planted"] < 0) and len(got) == 4004
    pairs = {(r["planted"], r["cluster"]) for r in got if r["planted"] >= 0}
    assert len(pairs) == 4 and len({c for _, c in pairs}) == 4


def test_summaries_of_many_tasks_are_summed_up_in_rounds(spark):
    df = spark.range(0, 30000, 1, 12).select((F.col("id") % 9973).cast("double").alias("a"), (F.col("id") * 7 % 9973).cast("double").alias("b"))
    table = ward.micro_clusters(df, ["a", "b"], most=25, fan_in=2).collect()
    assert len(table) <= 25 and sum(r["n"] for r in table) == 30000
    assert sum(r["s"][0] for r in table) == pytest.approx(sum(i % 9973 for i in range(30000)))


def test_nothing_and_one_point(spark):
    df = _points(spark, 5)
    none = ward.Ward(df.limit(0), ["a", "b"])
    assert none.merges().count() == 0 and none.segments(3).count() == 0
    same = ward.Ward(df.select(F.lit(1.0).alias("a"), F.lit(2.0).alias("b")), ["a", "b"])
    assert same.merges().count() == 0 and {r["cluster"] for r in same.segments(3).collect()} == {0}
