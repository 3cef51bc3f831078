"""A table profile that is stored in parts and continued.

``profile_parts`` reduces the rows of each part (a day, a month) to one row per column: exact counts, nulls, sum, sum of
squares about the part's mean, least and largest value, and two sketches, HyperLogLog for distinct values and KLL for
quantiles. These rows are kept; a new part adds its own rows, a part that changed replaces its rows, and
``profile_report`` merges whatever is stored without reading the table again.

Exact after any merge: rows, nulls, mean, standard deviation (by the parallel formula, to rounding), least and largest.
Approximate: distinct values (HyperLogLog with ``2^hll_bits`` buckets, about 1.04 / sqrt(2^hll_bits) relative standard error)
and quantiles (KLL, rank error about 1.3 % at its default size).

NaN counts as null in numeric columns; text columns have no moments and quantiles; a part without rows has no row; a
null part is a part; an empty table gives an empty profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _as_rows(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """(part, column_name, num, txt): a value per row and column; one of num and txt, or neither for a null."""
    entries = []
    for c in columns:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        v = F.col(c).cast("double")
        num = F.when(~F.isnan(v), v) if numeric else F.lit(None).cast("double")
        txt = F.lit(None).cast("string") if numeric else F.col(c).cast("string")
        entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(numeric).alias("numeric"), num.alias("num"), txt.alias("txt")))
    return df.select(F.col(part).alias("part"), F.inline(F.array(*entries)))


def profile_parts(df: DataFrame, part: str, columns: Sequence[str], hll_bits: int = 12) -> DataFrame:
    """One row per part and column: the state that merges."""
    rows = _as_rows(df, part, columns)
    text = F.coalesce(F.col("num").cast("string"), F.col("txt"))
    return rows.groupBy("part", "column_name", "numeric").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(text).alias("n_known"),
        F.sum("num").alias("total"),
        (F.var_pop("num") * F.count("num")).alias("squares"),
        F.min("num").alias("least"),
        F.max("num").alias("largest"),
        F.min("txt").alias("least_text"),
        F.max("txt").alias("largest_text"),
        F.hll_sketch_agg(text, hll_bits).alias("distinct_sketch"),
        F.kll_sketch_agg_double("num").alias("quantile_sketch"),
    )


def replace_parts(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The stored rows with those of ``fresh``'s parts replaced: safe to repeat, a part never counts twice."""
    same = stored["part"].eqNullSafe(F.col("_part")) & (stored["column_name"] == F.col("_column"))
    known = fresh.select(F.col("part").alias("_part"), F.col("column_name").alias("_column"))
    return stored.join(known, same, "left_anti").unionByName(fresh)


def profile_report(parts: DataFrame) -> DataFrame:
    """One row per column, merged from the parts' rows."""
    known = F.col("n_num") > 0
    # sum of squares about the whole mean: within the parts, and of the parts' means about it
    each = parts.withColumn("n_num", F.when(F.col("numeric"), F.col("n_known")).otherwise(0))
    merged = each.groupBy("column_name", "numeric").agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_known").alias("n_known"),
        F.sum("n_num").alias("n_num"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("inside"),
        F.sum(F.when(known, F.col("total") * F.col("total") / F.col("n_num"))).alias("between"),
        F.min("least").alias("least"),
        F.max("largest").alias("largest"),
        F.min("least_text").alias("least_text"),
        F.max("largest_text").alias("largest_text"),
        F.hll_union_agg("distinct_sketch", F.lit(True)).alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )
    n, mean = F.col("n_num"), F.try_divide(F.col("total"), F.col("n_num"))
    squares = F.greatest(F.lit(0.0), F.col("inside") + F.col("between") - F.try_divide(F.col("total") * F.col("total"), n))
    return merged.select(
        "column_name",
        "n_parts",
        "n_rows",
        (F.col("n_rows") - F.col("n_known")).alias("n_null"),
        mean.alias("mean"),
        F.when(n > 1, F.sqrt(squares / (n - 1))).alias("std"),
        F.coalesce(F.col("least").cast("string"), F.col("least_text")).alias("least"),
        F.coalesce(F.col("largest").cast("string"), F.col("largest_text")).alias("largest"),
        F.hll_sketch_estimate("distinct_sketch").alias("approx_distinct"),
        *[F.when(n > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))).alias(f"approx_{name}") for name, q in QUANTILES.items()],
    )
