"""Classifier evaluation (M13-M16, T10): confusion matrix, class metrics, ROC and AUC.

ROC needs running sums over all scores in descending order. A window without partitioning would
put every row in one task, so the running sums are computed in two levels: scores fall into
contiguous ranges (bounds from a sketch of the scores), each range sums itself, the (few) range
totals become offsets, and each row adds its range's offset to its in-range running sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.session import cut_lineage


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts per (label, prediction) completed over seen labels x seen predictions, and
    the share of each cell in its label row (row-normalised matrix)."""
    from tally.operators.profile import crosstab_counts

    c = crosstab_counts(df, label, pred, complete=True)
    w = Window.partitionBy(label)
    return c.withColumn("share", F.col("n") / F.sum("n").over(w))


def class_metrics(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """M14 + M16: accuracy, precision, recall, F1 for the positive class; guarded divisions."""
    pos_l = F.col(label) == F.lit(positive)
    pos_p = F.col(pred) == F.lit(positive)
    agg = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(label) == F.col(pred), 1)).alias("correct"),
        F.count(F.when(pos_l & pos_p, 1)).alias("tp"),
        F.count(F.when(~pos_l & pos_p, 1)).alias("fp"),
        F.count(F.when(pos_l & ~pos_p, 1)).alias("fn"),
    )
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return agg.select(
        "n", "tp", "fp", "fn",
        F.try_divide(F.col("correct"), F.col("n")).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
    )


def global_running_sum(
    df: DataFrame, key: str, values: Sequence[str], descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Running sums of ``values`` over the whole frame in ``key`` order, without a single-task
    window. Adds ``cum_<v>`` columns; ``key`` must be numeric, unique (aggregate by it first) and not null.

    Rows go to ``buckets`` contiguous key ranges. The bounds come from a sketch and are read once as constants (one
    per bucket), so both uses and every recomputation share them; rows are compared and ordered by the key itself.
    Each bucket's total becomes an offset for the later buckets (one row per bucket), and each row adds its bucket
    offset to its in-bucket running sum. Pass a materialised frame: it is read three times."""
    n = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = df.agg(
        F.percentile_approx(key, [i / n for i in range(1, n)], 10_000).alias("b"), F.count(F.when(F.col(key).isNull(), 1)).alias("nulls")
    ).first()
    if found["nulls"]:
        raise ValueError(f"{found['nulls']} rows have no {key}: running sums need one")
    kind = df.schema[key].dataType
    bounds = F.array(*[F.lit(b).cast(kind) for b in sorted(set(found["b"] or []))]).cast(T.ArrayType(kind))
    below = F.size(F.filter(bounds, lambda b: b < F.col(key)))
    ranked = df.withColumn("_bkt", -below if descending else below)
    totals = ranked.groupBy("_bkt").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wt = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bkt", *[F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}") for v in values])
    order = F.col(key).desc() if descending else F.col(key).asc()
    wp = Window.partitionBy("_bkt").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranked.withColumns({f"_l_{v}": F.sum(v).over(wp) for v in values})
    out = local.join(F.broadcast(offsets), "_bkt")
    return out.withColumns({f"cum_{v}": F.col(f"_l_{v}") + F.col(f"_o_{v}") for v in values}).drop(
        "_bkt", *[f"_l_{v}" for v in values], *[f"_o_{v}" for v in values]
    )


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One ROC point per distinct score (descending): cumulative true / false positives and
    their rates. Exact (no binning). A null score is an error. The counts per score are materialised once."""
    per = cut_lineage(
        df.groupBy(F.col(score).alias("threshold")).agg(
            F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg")
        )
    )
    tot = per.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    cum = global_running_sum(per, "threshold", ["pos", "neg"], descending=True)
    return cum.select(
        "threshold",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.try_divide(F.col("cum_pos"), tot["p"]).alias("tpr"),
        F.try_divide(F.col("cum_neg"), tot["n"]).alias("fpr"),
        F.try_divide(F.col("cum_pos") - F.col("pos"), tot["p"]).alias("_tpr_prev"),
        F.try_divide(F.col("cum_neg") - F.col("neg"), tot["n"]).alias("_fpr_prev"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids between consecutive points (from (0, 0)).
    The previous point of each row is its running sum minus its own counts, so no lag is needed."""
    pts = roc_points(df, label, score)
    area = (F.col("fpr") - F.col("_fpr_prev")) * (F.col("tpr") + F.col("_tpr_prev")) / 2
    return pts.agg(F.sum(area).alias("auc"))
