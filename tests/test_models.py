"""Model keys are rows-only in the oracle; these tests bound their quality on a fixed seed."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tally.operators import ml

SF = "/root/testdata/sf0.001"


def test_clusterings_and_elbow(spark):
    import __spark_entry__ as E

    q = E.queries()
    km = q["kmeans_segments"](spark, SF).toPandas()
    assert km.cluster.nunique() == 4 and len(km) > 0
    bi = q["bisecting_segments"](spark, SF).toPandas()
    assert bi.cluster.nunique() == 4
    elbow = q["kmeans_elbow"](spark, SF).toPandas().sort_values("k")
    assert list(elbow.k) == list(range(1, 15))
    # k = 1 is the total sum of squares of the scaled columns: 3 columns x n rows (unit variance)
    n = len(km)
    assert abs(elbow.wcss.iloc[0] - 3 * n) < 1e-6 * n
    assert elbow.wcss.iloc[-1] < elbow.wcss.iloc[0]


def test_classifiers_beat_or_match_majority(spark):
    rng = np.random.default_rng(0)
    n = 600
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = ((x1 + 0.5 * x2 + rng.normal(scale=0.3, size=n)) > 0).astype(int)
    pdf = pd.DataFrame({"k": range(n), "x1": x1, "x2": x2, "y": y})
    df = spark.createDataFrame(pdf).withColumn("is_train", ml.split_hash("k"))
    tr, te = df.filter("is_train"), df.filter(~F.col("is_train"))
    majority = max(te.filter("y = 1").count(), te.filter("y = 0").count()) / te.count()
    for fit in (
        lambda: ml.clf_tree(tr, te, ["x1", "x2"], "y"),
        lambda: ml.clf_forest(tr, te, ["x1", "x2"], "y", num_trees=20),
        lambda: ml.clf_logistic(tr, te, ["x1", "x2"], "y"),
        lambda: ml.clf_grid(tr, te, ["x1", "x2"], "y", "k", depths=(2, 4), min_leaf=(1,), folds=3),
    ):
        p = fit().select("label", "prediction").toPandas()
        acc = (p.label == p.prediction).mean()
        assert acc >= max(majority, 0.8), acc


def test_split_hash_share_and_stability(spark):
    df = spark.range(20000).withColumn("train", ml.split_hash("id"))
    share = df.filter("train").count() / 20000
    assert 0.78 < share < 0.82
    again = spark.range(20000).repartition(7).withColumn("train", ml.split_hash("id"))
    assert df.filter("train").select("id").subtract(again.filter("train").select("id")).count() == 0


def test_scaling_is_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    got = [r.x_scaled for r in ml.standard_scale(df, ["x"]).orderBy("x").collect()]
    exp = (np.array([1, 2, 3, 4]) - 2.5) / np.std([1, 2, 3, 4])
    assert np.allclose(got, exp)


def _fitted_on(monkeypatch, estimator):
    """The rows that an estimator is fitted on, one entry per fit."""
    seen, fit = [], estimator.fit
    monkeypatch.setattr(estimator, "fit", lambda self, rows, *a: (seen.append(rows.rdd.getNumPartitions()), fit(self, rows, *a))[1])
    return seen


def test_elbow_runs_no_task_per_shuffle_partition(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans

    rows = spark.range(400).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    seen = _fitted_on(monkeypatch, KMeans)
    got = {r["k"]: r["wcss"] for r in ml.kmeans_elbow(rows.repartition(64), ["a", "b"], ks=[1, 2, 35]).collect()}
    assert len(seen) == 2 and max(seen) <= 8
    assert abs(got[1] - 400 * np.var(np.arange(400) % 7) - 400 * np.var(np.arange(400) % 5)) < 1e-6 and got[35] <= got[2] <= got[1]


def test_forest_spreads_rows_by_what_they_weigh_when_cached(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    rows = spark.range(0, 3000, 1, 2).select((F.col("id") % 10).alias("x"), (F.col("id") % 10 > 4).cast("int").alias("y"))
    seen = _fitted_on(monkeypatch, RandomForestClassifier)
    few = ml.clf_forest(rows, rows, ["x"], "y", num_trees=10)
    monkeypatch.setattr(ml, "_TASK_BYTES", 40_000)
    many = ml.clf_forest(rows, rows, ["x"], "y", num_trees=10)
    assert seen == [2, -(-3000 * 144 // 40_000)]
    for p in (few, many):
        assert p.where("prediction = y").count() == 3000


def test_forest_on_vectors_deals_rows_evenly_and_takes_small_passes_where_rows_fit(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    rows = spark.range(0, 4000, 1, 1).select("id", (F.col("id") % 10).alias("x"), (F.col("id") % 10 > 4).cast("double").alias("label"))
    rows = ml.assemble(rows, ["x"]).select("id", "features", "label")
    seen, passes, fit = [], [], RandomForestClassifier.fit

    def watched(self, data, *a):
        seen.append(data.rdd.getNumPartitions())
        passes.append(self.getMaxMemoryInMB())
        return fit(self, data, *a)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    fits = ml.forest_on_vectors(rows, rows, num_trees=5)
    few = ml.forest_on_vectors(rows.where("id < 300"), rows, num_trees=5)
    monkeypatch.setattr(ml, "_storage_bytes", lambda spark: 4000 * 124 - 1)
    monkeypatch.setattr(ml, "_TASK_BYTES", 20_000)
    heavy = ml.forest_on_vectors(rows, rows, num_trees=5)
    assert seen == [2 * spark.sparkContext.defaultParallelism, 1, -(-4000 * 124 // 20_000)]
    assert passes == [4, 4, 256]
    for p in (fits, few, heavy):
        assert p.where("prediction = label").count() == 4000


def test_grid_equals_the_cross_validator_without_python_rows(spark, monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0) ^ (rng.random(400) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "k long, a double, b double, y int").coalesce(1)
    tr, te = df.where("k < 300"), df.where("k >= 300")
    dt = DecisionTreeClassifier(impurity="gini", seed=42)
    grid = ParamGridBuilder().addGrid(dt.maxDepth, [1, 4]).addGrid(dt.minInstancesPerNode, [1, 5]).build()
    cv = CrossValidator(estimator=dt, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), numFolds=4, foldCol="_fold")
    folded = tr.withColumn("_fold", F.pmod(F.xxhash64(F.lit(42), F.col("k")), F.lit(4)).cast("int"))
    want = ml._fit_predict(cv, folded, te, ["a", "b"], "y").select("k", "prediction").collect()
    plans, fit = [], DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, rows, *a: (plans.append(rows._jdf.queryExecution().toString()), fit(self, rows, *a))[1])
    got = ml.clf_grid(tr, te, ["a", "b"], "y", "k", depths=(1, 4), min_leaf=(1, 5), folds=4).select("k", "prediction").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(plans) == 17 and not any("EvalPython" in p for p in plans)
    with pytest.raises(ValueError, match="validation data"):
        ml.clf_grid(tr.where("k < 2"), te, ["a", "b"], "y", "k", folds=4)
