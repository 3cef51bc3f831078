"""Join operators Spark lacks as one call: as-of lookup (J14) and constant lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def asof_join(
    facts: DataFrame,
    rates: DataFrame,
    by: Sequence[str],
    fact_time: str,
    rate_time: str,
    value: str,
    bucket: str = "day",
    out: str | None = None,
) -> DataFrame:
    """For each fact, the latest ``value`` of ``rates`` with ``rate_time <= fact_time`` on
    the same ``by`` keys (null when there is none).

    Scalable form, no pairs: facts and rates are unioned and each fact takes the last non-null
    rate of its window. Windows are per (keys, time bucket) so a hot key is spread over its
    buckets; the value carried into a bucket from earlier buckets comes from a small table of
    the last rate per (keys, bucket), itself carried forward by a window over buckets only.
    On ties in time a rate counts as earlier than the fact (``<=``); rates sharing one time
    resolve to the largest value, so the answer never depends on row order. The value keeps its own
    type; null keys are one key of their own.
    """
    keys = list(by)
    trunc = lambda c: F.date_trunc(bucket, F.col(c))
    r = rates.select(
        *keys,
        F.col(rate_time).alias("_t"),
        F.col(value).alias("_val"),
        F.lit(0).alias("_side"),
    )
    f_cols = [c for c in facts.columns]
    f = facts.withColumn("_t", F.col(fact_time)).withColumn("_val", F.lit(None).cast(rates.schema[value].dataType)).withColumn(
        "_side", F.lit(1)
    )
    u = f.unionByName(r, allowMissingColumns=True).withColumn("_b", trunc("_t"))
    w = (
        Window.partitionBy(*keys, "_b")
        .orderBy("_t", "_side", "_val")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = u.withColumn("_in", F.last("_val", ignorenulls=True).over(w)).filter(F.col("_side") == 1)
    # last rate per bucket, carried to later buckets
    last_per_bucket = rates.groupBy(*keys, trunc(rate_time).alias("_rb")).agg(
        F.max_by(F.col(value), F.struct(F.col(rate_time), F.col(value))).alias("_lv")
    )
    fact_buckets = facts.select(*keys, trunc(fact_time).alias("_rb")).distinct().withColumn("_lv", F.lit(None).cast(rates.schema[value].dataType))
    wb = Window.partitionBy(*keys).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        last_per_bucket.withColumn("_fact", F.lit(False))
        .unionByName(fact_buckets.withColumn("_fact", F.lit(True)))
        .groupBy(*keys, "_rb")
        .agg(F.max("_lv").alias("_lv"))
        .withColumn("_prev", F.last("_lv", ignorenulls=True).over(wb))
        .select(*keys, F.col("_rb").alias("_b"), "_prev")
    )
    carry = carry.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_cb"), "_prev")
    # null keys match each other here as they do inside a window
    same = within["_b"].eqNullSafe(carry["_cb"])
    for i, k in enumerate(keys):
        same = same & within[k].eqNullSafe(carry[f"_k{i}"])
    res = within.join(carry, same, "left")
    return res.select(*f_cols, F.coalesce(F.col("_in"), F.col("_prev")).alias(out or value))


def lookup_table(spark: SparkSession, mapping: Mapping, key: str, value: str, key_type: str, value_type: str) -> DataFrame:
    """A constant dictionary as a tiny DataFrame (broadcast when joined)."""
    rows = list(mapping.items())
    return spark.createDataFrame(rows, f"{key} {key_type}, {value} {value_type}")


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str] | Column, how: str = "left") -> DataFrame:
    """Join to a lookup; Spark broadcasts it where its known size is under the session's threshold."""
    return df.join(lookup, on=on, how=how)
