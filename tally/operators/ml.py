"""ML preparation and models (M1-M10) on pyspark.ml: training is distributed by Spark's own
estimators; preparation steps are plain column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators import trees


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled", fit_on: DataFrame | None = None) -> DataFrame:
    """M1: ``(x - mean) / std_pop`` (scikit-learn's scaler; ``ml.StandardScaler`` uses the sample
    std). The per-column statistics are one aggregate row used as a scalar subquery; ``fit_on`` gives
    the rows they are taken from (the training rows), else all of ``df``."""
    cols = list(columns)
    st = (df if fit_on is None else fit_on).agg(
        F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    ).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": F.when(st[f"s{i}"] == 0, F.lit(0.0)).otherwise((F.col(c) - st[f"m{i}"]) / st[f"s{i}"])
            for i, c in enumerate(cols)
        }
    )


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M1, first half: ``column -> (mean, population std)`` of the training rows (one aggregate row is read)."""
    row = train.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def apply_scaler(df: DataFrame, fitted: dict[str, tuple[float, float]], suffix: str = "_scaled") -> DataFrame:
    """M1, second half: any rows, scaled by the training rows' figures; a constant column gives 0, no training rows null."""
    def scaled(c: str, mean: float | None, std: float | None) -> Column:
        if mean is None:
            return F.lit(None).cast("double")
        return F.when(F.col(c).isNotNull(), 0.0) if not std else (F.col(c) - F.lit(mean)) / F.lit(std)

    return df.withColumns({f"{c}{suffix}": scaled(c, *ms) for c, ms in fitted.items()})


def fit_one_hot(train: DataFrame, col: str, most: int = 1000) -> list[str]:
    """M3, first half: the sorted values of the training rows. More than ``most`` values are an error: each becomes
    a column, so the bound is one on columns, not on rows."""
    values = [r[0] for r in train.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{col} has more than {most} values: too many for one column each")
    return sorted(values)


def ordinal_encode(col: str | Column, order: Sequence[str]) -> Column:
    """M2: position in a given order (0-based), null when absent."""
    c = F.col(col) if isinstance(col, str) else col
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), c)
    return F.when(pos > 0, (pos - 1).cast("int"))


def one_hot(df: DataFrame, col: str, values: Sequence[str], drop_first: bool = True, prefix: str | None = None) -> DataFrame:
    """M3: 0/1 columns for the sorted values, the first dropped (``get_dummies(drop_first=True)``;
    ``ml.OneHotEncoder`` drops the *last*)."""
    vals = sorted(values)
    if drop_first:
        vals = vals[1:]
    p = prefix or col
    return df.withColumns({f"{p}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in vals})


def split_hash(key: str | Column, train_share: float = 0.8) -> Column:
    """M4: deterministic train/test split from the md5 of the key (reproducible, independent of
    partitioning, and the same rows in any engine with md5). True = train."""
    k = F.col(key) if isinstance(key, str) else key
    threshold = format(int(round(train_share * 65536)), "04x")
    return F.substring(F.md5(k.cast("string")), 1, 4) < F.lit(threshold)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def nearest_centre_violations(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]], cluster: str = "cluster", tol: float = 1e-9) -> Column:
    """How many rows of a clustering lie nearer to another centre than to their own (an aggregate column)."""
    def far(c):
        out = F.lit(0.0)
        for f, v in zip(features, c):
            out = out + F.pow(F.col(f) - F.lit(float(v)), F.lit(2.0))
        return out

    each = F.array(*[far(c) for c in centres])
    return F.count(F.when(F.get(each, F.col(cluster)) > F.array_min(each) * (1 + tol) + tol, 1)).alias("violations")


def kmeans_segments(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 42, with_centres: bool = False, max_iter: int = 20, tol: float = 1e-4):
    """M5: k-means cluster of each row (k-means|| init, fixed seed); with the centres if asked for."""
    from pyspark.ml.clustering import KMeans

    data = assemble(df, features)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features", predictionCol="cluster").fit(data)
    out = model.transform(data).drop("features")
    return (out, [list(c) for c in model.clusterCenters()]) if with_centres else out


def kmeans_elbow(df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(1, 15), seed: int = 42) -> DataFrame:
    """M5: within-cluster sum of squares per k. k = 1 is the total sum of squares (plain SQL);
    the others are ``trainingCost`` of fitted models. The data is cached once for all fits. Each of some hundred
    jobs sends the driver a result per task, so there are at most two tasks a core, or one for 200,000 rows, and not
    one per shuffle partition."""
    from pyspark.ml.clustering import KMeans

    spark = df.sparkSession
    cached = assemble(df, features).select("features").cache()
    most = max(2 * spark.sparkContext.defaultParallelism, cached.count() // 200_000)
    data = cached.coalesce(most) if cached.rdd.getNumPartitions() > most else cached
    rows = []
    for k in ks:
        if k == 1:
            continue
        model = KMeans(k=k, seed=seed, featuresCol="features").fit(data)
        rows.append((int(k), float(model.summary.trainingCost)))
    cached.unpersist()
    out = spark.createDataFrame(rows, "k int, wcss double")
    if 1 in ks:
        total = total_ss(df, features)
        out = total.select(F.lit(1).alias("k"), F.col("tss").alias("wcss")).unionByName(out)
    return out


def sum_of_squares(features: Sequence[str]) -> Column:
    """Sum of squares around the mean, over the features (an aggregate column)."""
    parts = [F.var_pop(c) * F.count(F.col(c)) for c in features]
    expr = parts[0]
    for p in parts[1:]:
        expr = expr + p
    return expr


def total_ss(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Total sum of squares around the mean, summed over the features."""
    return df.agg(sum_of_squares(features).alias("tss"))


def bisecting_segments(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 42) -> DataFrame:
    """M6 (re-aimed): divisive clustering instead of Ward linkage (quadratic memory).

    Starting from one cluster, the cluster with the largest within-cluster sum of squares is split
    in two by ``KMeans(k=2)`` until there are ``k`` clusters (or none can be split). Each step is
    a distributed fit on that cluster's rows; the driver reads only the per-cluster sums of
    squares (at most ``k`` rows), and the labelled rows are re-materialised in the shared
    checkpoint folder so lineage stays flat. (``ml.BisectingKMeans`` can return fewer clusters
    than asked on tightly scaled data, so the splitting is spelled out.)"""
    from pyspark.ml.clustering import KMeans

    from tally.session import cut_lineage

    cols = list(features)
    labeled = cut_lineage(df.withColumn("cluster", F.lit(0)))
    blocked: set[int] = set()
    new_id = 1
    while new_id < k:
        stats = labeled.groupBy("cluster").agg(sum_of_squares(cols).alias("sse"), F.count(F.lit(1)).alias("n")).collect()
        cand = sorted((r for r in stats if r["cluster"] not in blocked and r["n"] >= 2), key=lambda r: (-r["sse"], r["cluster"]))
        if not cand or cand[0]["sse"] <= 0:
            break
        pick = cand[0]["cluster"]
        part = assemble(labeled.filter(F.col("cluster") == pick), cols, "_f")
        model = KMeans(k=2, seed=seed, featuresCol="_f", predictionCol="_half").fit(part)
        halves = model.transform(part)
        if halves.select("_half").distinct().count() < 2:
            blocked.add(pick)
            continue
        split = halves.withColumn("cluster", F.when(F.col("_half") == 1, F.lit(new_id)).otherwise(F.lit(pick))).drop("_f", "_half")
        labeled = cut_lineage(labeled.filter(F.col("cluster") != pick).unionByName(split))
        new_id += 1
    return labeled


def _fit_predict(estimator, train: DataFrame, test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return _predict(estimator.fit(assemble(train, features).withColumn("label", F.col(label).cast("double"))), test, features, label)


def _predict(model, test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return model.transform(assemble(test, features).withColumn("label", F.col(label).cast("double")))


#: training rows above which trees are grown by ``operators.trees``: from some hundred thousand rows on, Spark's passes over
#: vectors and cached objects, one fit at a time, take several times as long
_SPARK_ROWS = 500_000


def _many(train: DataFrame, features: Sequence[str], n: int) -> bool:
    """More rows than Spark's own fit is used for, and features that are plain numbers to it, none of them nominal or a vector."""
    kinds = {f: train.schema[f] for f in features}
    plain = all(isinstance(k.dataType, (T.NumericType, T.BooleanType)) and "ml_attr" not in k.metadata for k in kinds.values())
    return n > _SPARK_ROWS and plain


#: bytes of cached training rows that one task should read at most
_TASK_BYTES = 128 << 20


def _spread(rows: DataFrame, row_bytes: int) -> DataFrame:
    """``rows`` in as many partitions as their cached form of ``row_bytes`` each asks for. A file split holds many more rows
    than that: they are a few bytes each in a file, but an array of ``numTrees`` counts when they are cached."""
    wanted = -(-rows.count() * row_bytes // _TASK_BYTES)
    return rows.repartition(wanted) if wanted > 1 and wanted > rows.rdd.getNumPartitions() else rows


def clf_tree(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, max_depth: int = 5, seed: int = 42) -> DataFrame:
    """M7: decision tree, gini impurity."""
    from pyspark.ml.classification import DecisionTreeClassifier

    if _many(train, features, train.count()):
        data, tree = trees.bin_rows(train, features, label, seed=seed), trees.Tree()
        try:
            trees.grow(data, [tree], max_depth, seed=seed)
        finally:
            data.blocks.unpersist()
        return _predict(trees.tree_model(train.sparkSession, tree, data, max_depth), test, features, label)
    est = DecisionTreeClassifier(maxDepth=max_depth, impurity="gini", seed=seed)
    return _fit_predict(est, train, test, features, label)


def clf_forest(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, num_trees: int = 100, impurity: str = "gini", seed: int = 42
) -> DataFrame:
    """M8: random forest (100 gini trees; the review model used 501 entropy trees)."""
    from pyspark.ml.classification import RandomForestClassifier

    est = RandomForestClassifier(numTrees=num_trees, impurity=impurity, seed=seed)
    if _many(train, features, train.count()):
        data, grown, depth = trees.bin_rows(train, features, label, seed=seed), [trees.Tree(draw=i) for i in range(num_trees)], est.getMaxDepth()
        try:
            trees.grow(data, grown, depth, impurity, math.ceil(math.sqrt(len(features))) if num_trees > 1 else None, seed)
        finally:
            data.blocks.unpersist()
        return _predict(trees.forest_model(train.sparkSession, grown, data, depth, impurity), test, features, label)
    # Spark caches a row as its binned features and its count in each tree
    train = _spread(train.select(*features, label), 4 * (num_trees + len(features)) + 100)
    return _fit_predict(est, train, test, features, label)


#: MB of node statistics that a forest on vectors gathers in one pass over its rows, and rows that one task should have at least
_PASS_MB = 4
_TASK_ROWS = 250


def _storage_bytes(spark) -> int:
    """Memory in which the session's executors (the driver too, in its own list of them) can keep cached rows."""
    return sum(e.totalOnHeapStorageMemory() for e in spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos())


def forest_on_vectors(train: DataFrame, test: DataFrame, num_trees: int = 501, impurity: str = "entropy", seed: int = 42) -> DataFrame:
    """M8 on ready vectors (``features``, ``label``): predictions of the test rows.

    A row changes the statistics of a node in every tree. With Spark's default of 256 MB a pass they lie in memory far beyond a
    core's cache; passes of a few MB go through the cached rows more often, but stay within it. Rows that the executors cannot
    cache would be read from disk in each pass, so they keep the default. Training rows are dealt evenly, two tasks a core or
    by their cached size."""
    from pyspark.ml.classification import RandomForestClassifier

    spark = train.sparkSession
    est = RandomForestClassifier(numTrees=num_trees, impurity=impurity, seed=seed)
    n, first = train.count(), train.select("features").first()
    # Spark caches a row as its binned features and its count in each tree
    cached = n * (4 * (num_trees + (first["features"].size if first else 0)) + 100)
    if cached <= _storage_bytes(spark):
        est.setMaxMemoryInMB(_PASS_MB)
    wanted = max(min(2 * spark.sparkContext.defaultParallelism, n // _TASK_ROWS), -(-cached // _TASK_BYTES))
    rows = train.select("features", "label")
    return est.fit(rows.repartition(wanted) if wanted > 1 else rows).transform(test)


def clf_logistic(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, c: float = 1.0) -> DataFrame:
    """M9: L2 logistic regression equal to scikit-learn's ``C``: Spark minimises the *mean* loss,
    so ``regParam = 1 / (n C)``; no internal standardisation."""
    from pyspark.ml.classification import LogisticRegression

    n = train.count()
    est = LogisticRegression(regParam=1.0 / (n * c), elasticNetParam=0.0, standardization=False, maxIter=200)
    return _fit_predict(est, train, test, features, label)


def logistic_gradient(train: DataFrame, features: Sequence[str], label: str, c: float = 1.0) -> DataFrame:
    """M9: (feature, coefficient, gradient) of the fitted logistic loss on its own training rows: the mean of
    ``(p - y) x`` plus ``coefficient / (n C)``, which is zero at the optimum (``intercept``: without the second term)."""
    from pyspark.ml.classification import LogisticRegression

    cols, n = list(features), train.count()
    data = assemble(train, cols).withColumn("label", F.col(label).cast("double"))
    model = LogisticRegression(regParam=1.0 / (n * c), elasticNetParam=0.0, standardization=False, maxIter=500, tol=1e-10).fit(data)
    beta, start = [float(b) for b in model.coefficients], float(model.intercept)
    z = F.lit(start)
    for name, b in zip(cols, beta):
        z = z + F.col(name) * b
    off = 1 / (1 + F.exp(-z)) - F.col(label)
    rows = train.agg(F.avg(off).alias("g_"), *[F.avg(off * F.col(x)).alias(f"g{i}") for i, x in enumerate(cols)])
    each = [F.struct(F.lit("intercept").alias("feature"), F.lit(start).alias("coefficient"), F.col("g_").alias("gradient"))]
    each += [F.struct(F.lit(x).alias("feature"), F.lit(b).alias("coefficient"), (F.col(f"g{i}") + b / (n * c)).alias("gradient")) for i, (x, b) in enumerate(zip(cols, beta))]
    return rows.select(F.inline(F.array(*each)))


def clf_grid(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    depths: Sequence[int] = (3, 5, 7),
    min_leaf: Sequence[int] = (1, 5),
    folds: int = 10,
    parallelism: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Grid search with k-fold cross-validation on a decision tree (``min_samples_leaf`` ->
    ``minInstancesPerNode``); predictions of the best model on the test rows. Folds come from the hash of ``key``, so they do not
    depend on partitioning."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder

    dt = DecisionTreeClassifier(impurity="gini", seed=seed)
    grid = ParamGridBuilder().addGrid(dt.maxDepth, list(depths)).addGrid(dt.minInstancesPerNode, list(min_leaf)).build()
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    fold = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)).cast("int")
    if _many(train, features, train.count()):
        return _predict(_grown_grid(train, features, label, fold, depths, min_leaf, folds, seed), test, features, label)
    # Spark's CrossValidator would send every row through a Python function and cache a copy of all rows for each fold;
    # here all rows are cached once, and a fold is a filter on them
    rows = _spread(train.select(*features, F.col(label).cast("double").alias("label"), fold.alias("_fold")), 8 * len(features) + 100)
    rows = assemble(rows, features).select("features", "label", "_fold").persist()
    try:
        have = {r["_fold"] for r in rows.select("_fold").distinct().collect()}
        missing = sorted(set(range(folds)) - have)
        if missing:
            raise ValueError(f"The validation data at fold {missing[0]} is empty.")

        def score(task: tuple[int, int]) -> float:
            k, at = task
            model = dt.fit(rows.where(F.col("_fold") != k), grid[at])
            return accuracy.evaluate(model.transform(rows.where(F.col("_fold") == k)))

        tasks = [(k, at) for k in range(folds) for at in range(len(grid))]
        pool = ThreadPool(processes=min(parallelism, len(tasks)))
        try:
            scores = pool.map(inheritable_thread_target(train.sparkSession)(score), tasks, chunksize=1)
        finally:
            pool.close()
        means = [sum(x for (_, i), x in zip(tasks, scores) if i == at) / folds for at in range(len(grid))]
        best = means.index(max(means))  # the first of equals
        model = dt.fit(rows.drop("_fold"), grid[best])
    finally:
        rows.unpersist()
    return _predict(model, test, features, label)


def _grown_grid(train: DataFrame, features: Sequence[str], label: str, fold: Column, depths: Sequence[int], min_leaf: Sequence[int], folds: int, seed: int):
    """M10 on many rows: the trees of all folds and of the last fit grow together, each once to the largest depth. A tree of less
    depth is the same tree cut off there, since its splits do not depend on how far it may grow."""
    data = trees.bin_rows(train, features, label, fold, folds, seed)
    try:
        grown = {(k, m): trees.Tree(without=k, min_leaf=m) for k in (*range(folds), -1) for m in min_leaf}
        trees.grow(data, [*grown.values()], max(depths), seed=seed)
        grid = [(d, m) for d in depths for m in min_leaf]
        scores = trees.accuracies(data, [(grown[k, m], d) for k in range(folds) for d, m in grid])
    finally:
        data.blocks.unpersist()
    means = [sum(scores[at :: len(grid)]) / folds for at in range(len(grid))]
    depth, least = grid[means.index(max(means))]  # the first of equals
    return trees.tree_model(train.sparkSession, grown[-1, least], data, depth)
