"""Trees grown on binned rows (operators.trees) against Spark's own fits, which ``ml`` keeps for fewer rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.operators import ml, trees

FEATURES = ["a", "b", "c"]


def _rows(spark, n=1200, seed=4):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), np.round(rng.normal(size=n), 1), rng.integers(0, 3, n)], axis=1)
    y = np.where(rng.random(n) < 0.2, rng.integers(0, 3, n), (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5) * (x[:, 2] > 0))
    df = spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))], "k long, a double, b double, c double, y int")
    return df.where("k < 900").repartition(3), df.where("k >= 900"), dict(enumerate(y.tolist()))


def _said(df):
    return sorted((r["k"], r["prediction"], *np.round(r["probability"], 12)) for r in df.select("k", "prediction", "probability").collect())


def _no_fit(monkeypatch, estimator):
    monkeypatch.setattr(estimator, "fit", lambda *a, **k: pytest.fail("Spark's own fit was called"))


def test_trees_and_grid_on_many_rows_equal_sparks(spark, monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier

    train, test, _ = _rows(spark)
    ways = [
        lambda: ml.clf_tree(train, test, FEATURES, "y", max_depth=7),
        lambda: ml.clf_grid(train, test, FEATURES, "y", "k", depths=(2, 4, 6), min_leaf=(1, 5, 40), folds=4),
    ]
    want = [f() for f in ways]
    want_said = [_said(w) for w in want]
    monkeypatch.setattr(ml, "_SPARK_ROWS", 0)
    _no_fit(monkeypatch, DecisionTreeClassifier)
    passes, count = [], trees._pass
    monkeypatch.setattr(trees, "_pass", lambda *a: (passes.append(len(a[2])), count(*a))[1])
    got = [f() for f in ways]
    assert [_said(g) for g in got] == want_said
    assert [g.dtypes for g in got] == [w.dtypes for w in want]
    # a pass over the rows per level, for all folds and parameters at once; trees that differ in the least leaf share their first
    assert len(passes) == 7 + 6 and passes[7] == 5


def test_small_blocks_passes_and_rows_led_one_by_one_grow_the_same_trees(spark, monkeypatch):
    train, _, _ = _rows(spark)

    def grown():
        data = trees.bin_rows(train, FEATURES, "y", F.pmod("k", F.lit(3)), 3)
        each = [trees.Tree(without=k, min_leaf=m) for k in (0, 1, 2, -1) for m in (1, 9)]
        trees.grow(data, each, 6, "entropy")
        n = data.blocks.count()
        scores = trees.accuracies(data, [(t, d) for t in each[:6] for d in (1, 6)])
        data.blocks.unpersist()
        return [(t.feature, t.cut, t.child, [c.tolist() for c in t.counts]) for t in each], scores, n

    few = grown()
    for name, to in (("_BLOCK_LEAST", 10), ("_BLOCK_ROWS", 40), ("_PASS_BYTES", 20_000), ("_TASK_BYTES", 300_000)):
        monkeypatch.setattr(trees, name, to)
    monkeypatch.setattr(trees, "_slots", _by_look_up)
    many = grown()
    assert many[:2] == few[:2] and many[2] > 2 * few[2]


def _by_look_up(x, item):
    slots = np.zeros(len(item.feature), np.intp)
    slots[item.nodes] = np.arange(len(item.nodes)) + 1
    return slots[trees._descend(x.ravel(), x.shape[1], np.arange(x.shape[1]), item.feature, item.cut, item.child, item.depth)]


def test_rows_are_led_to_the_same_nodes_either_way(monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 30, (4, 500)).astype(np.uint8)
    feature, cut, child = [0, 1, 2, 0, 0, 3, 0, 0, 0], [14, 9, 20, 0, 0, 4, 0, 0, 0], [1, 2, 3, 4, 5, 6, 3, 3, 4, 4, 7, 8, 6, 6, 7, 7, 8, 8]
    item = trees._Item(-1, -1, np.array(feature), np.array(cut, np.uint8), np.array(child), 3, [7, 4, 8], None, [1])
    lines = trees._slots(x, item)
    monkeypatch.setattr(trees, "_SMALL", -1)
    assert (lines == trees._slots(x, item)).all() and (lines == _by_look_up(x, item)).all() and set(lines) == {0, 1, 2, 3}


def test_forest_on_many_rows_votes_like_sparks(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    train, test, y = _rows(spark)
    want = np.array(_said(ml.clf_forest(train, test, FEATURES, "y", num_trees=60)))
    monkeypatch.setattr(ml, "_SPARK_ROWS", 0)
    _no_fit(monkeypatch, RandomForestClassifier)
    model = ml.clf_forest(train, test, FEATURES, "y", num_trees=60)
    got, again = np.array(_said(model)), np.array(_said(ml.clf_forest(train, test, FEATURES, "y", num_trees=60)))
    assert (got == again).all()
    right = [np.mean([y[k] == p for k, p in a[:, :2].astype(int)]) for a in (want, got)]
    assert right[1] > right[0] - 0.03 and right[1] > 0.75
    # other draws, the same kind of trees: the shares of votes differ by little, and are not those of one tree 60 times
    assert np.abs(got[:, 2:] - want[:, 2:]).mean() < 0.03 and len(np.unique(got[:, 2])) > 50


def test_bootstrap_counts_are_poisson():
    n = 1 << 20
    drawn = trees.poisson(np.random.SFC64([1, 2]), n)
    share = np.exp(-1.0) / np.cumprod([1.0, *range(1, 9)])
    assert np.abs(np.bincount(drawn, minlength=9)[:9] / n - share).max() < 2e-3 and abs(drawn.var() - 1) < 0.01
    assert (drawn == trees.poisson(np.random.SFC64([1, 2]), n)).all() and (drawn[:1000] != trees.poisson(np.random.SFC64([1, 3]), 1000)).any()


def test_rows_that_sparks_fit_refuses_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ml, "_SPARK_ROWS", 0)
    rows = spark.range(40).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 2).alias("y"))
    for x in (F.when(F.col("id") != 3, F.col("x")), F.when(F.col("id") != 3, F.col("x")).otherwise(float("inf"))):
        with pytest.raises(Exception, match="NaN or Infinity"):
            ml.clf_tree(rows.withColumn("x", x), rows, ["x"], "y")
    for y in (F.when(F.col("id") != 3, F.col("y")), F.col("y") - 1, F.col("y") + 0.5):
        with pytest.raises(ValueError, match="Labels"):
            ml.clf_tree(rows.withColumn("y", y), rows, ["x"], "y")
    with pytest.raises(ValueError, match="validation data"):
        ml.clf_grid(rows.where("id < 2"), rows, ["x"], "y", "id", folds=4)


def test_nominal_features_stay_with_sparks_fit(spark, monkeypatch):
    from pyspark.ml.feature import StringIndexer

    monkeypatch.setattr(ml, "_SPARK_ROWS", 0)
    monkeypatch.setattr(trees, "grow", lambda *a, **k: pytest.fail("a nominal feature was taken for a number"))
    rows = spark.range(60).select("id", F.substring("id", -1, 1).alias("s"), (F.col("id") % 10 % 3 == 0).cast("int").alias("y"))
    rows = StringIndexer(inputCol="s", outputCol="x").fit(rows).transform(rows)
    assert ml.clf_tree(rows, rows, ["x"], "y").where("prediction = y").count() == 60
