"""Correlations of many columns from blockwise sums of products.

One aggregate per pair of columns outgrows code generation at a few dozen columns. Here each task takes its rows as a
matrix, centres it by the column means (one aggregate per column), and multiplies it with its mask of known values:

    K = M'M   rows in which both are known      S = X'M   sums of x where y is known
    Q = (X*X)'M   their sums of squares          P = X'X   sums of products

Nulls are zero in X and in M, so every pair uses exactly the rows in which both columns are known, as a pairwise
correlation does. A task sends its four matrices cut into blocks of ``block`` columns, Spark adds up the blocks of all
tasks entry by entry, and the correlation of a pair comes from its five sums. The plan does not grow with the number
of columns, and no task holds more than the matrices of its own rows.

NaN counts as null; a pair with fewer than two common rows, or one of whose columns does not vary in these, is null; a
column's correlation with itself is 1 where it varies; an empty table gives a row of null per pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import cut_lineage


def _known(c: str):
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


@contextmanager
def _small_methods(spark: SparkSession) -> Iterator[None]:
    """Dozens of column expressions make one generated method that the JVM runs uncompiled, being over 8000 bytes; for the
    jobs in here Spark generates a small method for each expression instead."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pair_sums(df: DataFrame, columns: Sequence[str], block: int = 64) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for i <= j, about the columns' means."""
    cols = list(columns)
    k = len(cols)
    with _small_methods(df.sparkSession):
        means = df.agg(*[F.avg(_known(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([m or 0.0 for m in means])
    kinds = ("n", "s", "q", "p")

    def products(batches):
        total = {kind: np.zeros((k, k)) for kind in kinds}
        seen = False
        for pdf in batches:
            seen = seen or len(pdf) > 0
            x = pdf.to_numpy(dtype=float)
            m = ~np.isnan(x)
            x = np.where(m, x - centre, 0.0)
            m = m.astype(float)
            total["n"] += m.T @ m
            total["s"] += x.T @ m
            total["q"] += (x * x).T @ m
            total["p"] += x.T @ x
        if not seen:
            return
        for kind in kinds:
            for a in range(0, k, block):
                for b in range(0, k, block):
                    part = total[kind][a : a + block, b : b + block]
                    yield pd.DataFrame({"kind": [kind], "a": [a], "b": [b], "w": [part.shape[1]], "v": [part.ravel().tolist()]})

    # null comes as NaN, so the mask leaves out both
    parts = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInPandas(products, "kind string, a int, b int, w int, v array<double>")
    each = parts.select("kind", "a", "b", "w", F.posexplode("v").alias("at", "v"))
    i, j = F.col("a") + F.floor(F.col("at") / F.col("w")), F.col("b") + F.col("at") % F.col("w")
    summed = each.groupBy("kind", i.cast("int").alias("i"), j.cast("int").alias("j")).agg(F.sum("v").alias("v"))
    low, high = F.least("i", "j"), F.greatest("i", "j")

    def of(kind: str, order: bool | None = None):
        hit = F.col("kind") == kind
        if order is not None:
            hit = hit & ((F.col("i") <= F.col("j")) if order else (F.col("i") >= F.col("j")))
        return F.max(F.when(hit, F.col("v")))

    sums = summed.groupBy(low.alias("x"), high.alias("y")).agg(
        of("n").alias("n"), of("s", True).alias("sx"), of("s", False).alias("sy"), of("q", True).alias("sxx"), of("q", False).alias("syy"), of("p", True).alias("sxy")
    ).withColumnsRenamed({"x": "i", "y": "j"})
    # written, a row per pair: the rows of ``df`` are gone through once, however often the sums are read
    with _small_methods(df.sparkSession):
        return cut_lineage(sums)


def correlations(df: DataFrame, columns: Sequence[str], block: int = 64, decimals: int = 6) -> DataFrame:
    """(col_a, col_b, corr, n) of every ordered pair of columns."""
    cols = list(columns)
    sums = pair_sums(df, cols, block)
    n = F.col("n")
    xx, yy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    xy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    # what is left of a sum of squares after rounding is no variation
    varies = (n >= 2) & (xx > 1e-12 * F.col("sxx")) & (yy > 1e-12 * F.col("syy"))
    r = F.when(varies, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.round(xy / F.sqrt(xx * yy), decimals)))
    found = sums.select("i", "j", n.cast("long").alias("n"), r.alias("corr"))
    both = found.unionByName(found.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "n", "corr"))
    # a row per pair of columns, from their names
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, col_a string")
    pairs = names.select("*", F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("j", "col_b"))
    return pairs.join(both, ["i", "j"], "left").select("col_a", "col_b", "corr", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
