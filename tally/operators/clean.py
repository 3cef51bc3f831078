"""Cleaning operators: duplicates, keys, null filling, tagged union/split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a numeric type (``select_dtypes(exclude='object')``), in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def select_by_position(df: DataFrame, start: int = 0, stop: int | None = None, positions: Sequence[int] | None = None) -> DataFrame:
    """Columns by position (``iloc[:, a:b]`` or ``iloc[:, [0, 3, -1]]``)."""
    cols = df.columns
    chosen = [cols[i] for i in positions] if positions is not None else cols[start:stop]
    return df.select(*chosen)


def cast_columns(df: DataFrame, columns: Sequence[str], data_type: str) -> DataFrame:
    """One cast for many columns (a single projection)."""
    return df.withColumns({c: F.col(c).cast(data_type) for c in columns})


def drop_if_exists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; missing names are ignored (``DataFrame.drop`` already is silent)."""
    return df.drop(*columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under an explicit total order.

    ``dropDuplicates(subset)`` keeps an arbitrary row; here the order decides. Spark plans the
    ``row_number() = 1`` filter as a ``WindowGroupLimit`` that trims each partition before the
    shuffle's sort finishes.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def clean_dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], required: Sequence[str] = ()
) -> DataFrame:
    """P12 + A20 + A21: drop rows with a null in ``required``, exact duplicates, then keep the
    first row per key. Exact duplicates are equal in every column, so the first-per-key step
    already removes them; ``distinct`` is not needed as a separate shuffle."""
    if required:
        df = df.dropna(how="any", subset=list(required))
    return first_per_key(df, keys, order)


def duplicate_groups(df: DataFrame, columns: Sequence[str], id_col: str | None = None) -> DataFrame:
    """Groups of rows equal on ``columns`` that occur more than once.

    Output ``*columns, copies[, first_id]``. Map-side partial aggregation collapses copies before
    the shuffle, so a value held by a third of all rows costs one row per map task.
    """
    aggs = [F.count(F.lit(1)).alias("copies")]
    if id_col:
        aggs.append(F.min(id_col).alias("first_id"))
    return df.groupBy(*columns).agg(*aggs).filter(F.col("copies") > 1)


def drop_ambiguous_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop *every* row whose key occurs more than once (not all but one, Q1).

    One aggregation by key: a key seen once gives its only row back, and copies of a frequent key collapse before
    the shuffle. Null keys are equal to each other."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    one = F.first(F.struct(*rest)).alias("_row") if rest else F.lit(0).alias("_row")
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"), one).filter(F.col("_k") == 1)
    return per.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant fill per column."""
    return df.fillna(dict(values))


def exact_mean(c: str, scale: int = 2) -> Column:
    """Mean of a column holding ``scale``-decimal values: exact decimal sum / count, so the result
    does not depend on the order in which partitions are summed."""
    return F.try_divide(F.sum(F.col(c).cast(f"decimal(18,{scale})")).cast("double"), F.count(c))


def mean_by_key(
    df: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None, exact_scale: int | None = None
) -> DataFrame:
    """A2: mean of every numeric column per key (``groupby(key).mean()``).

    ``exact_scale``: the columns hold values with that many decimals; sum them exactly."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = columns if columns is not None else numeric_columns(df, exclude=keys)
    mean = (lambda c: exact_mean(c, exact_scale)) if exact_scale is not None else F.avg
    return df.groupBy(*keys).agg(*[mean(c).alias(f"{c}_mean") for c in cols])


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """P10: nulls take the column's global mean; the mean is a scalar subquery, not a join."""
    m = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), m))


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "tag") -> DataFrame:
    """Union by name with missing columns as null, each part tagged."""
    out = None
    for name, f in frames.items():
        f = f.withColumn(tag, F.lit(name))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def split_tag(df: DataFrame, value: str, tag: str = "tag", drop: Sequence[str] = ()) -> DataFrame:
    """One part back out of a tagged union."""
    return df.filter(F.col(tag) == value).drop(tag, *drop)


def multi_left_join(base: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str] | Column]]) -> DataFrame:
    """A chain of left joins to lookups that are unique on their keys.

    Row count is unchanged when every lookup is unique on its key (a property test checks it).
    """
    out = base
    for lk, on in lookups:
        out = out.join(lk, on=on, how="left")
    return out
