"""Sources and sinks.

Readers are thin on purpose: ``spark.read`` already prunes columns and pushes filters into
Parquet. CSV readers always take an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """Lazy access to the parquet tables of one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def memo(self, key: str, build):
        """One derived frame per query build (e.g. a materialised panel used by several steps)."""
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def read_table(spark: SparkSession, name_or_path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table or a parquet path, optionally projected."""
    if "/" in name_or_path:
        df = spark.read.parquet(name_or_path)
    else:
        df = spark.table(name_or_path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """CSV or TSV with a caller-given schema; the header line, when present, is skipped
    and the caller's names are kept. Header names are never read from the file, so names with
    trailing ``\\r\\n`` (Q19) cannot leak in."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_csv_tolerant(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """S3: pandas ``on_bad_lines='skip'`` semantics (Q28).

    Lines with *more* fields than the schema are dropped; short lines are kept and padded with
    nulls; a value that does not parse becomes null (``try_cast``) instead of dropping the line.
    Every column is read as text first. Spark's reader marks a line as corrupt if its number of fields
    differs from the schema's; a marked line stays only if it has fewer, which a second parse of the
    line with room for one field more tells (quoted separators do not count as fields).
    """
    names = [f.name for f in schema.fields]
    text_schema = T.StructType(
        [T.StructField(n, T.StringType(), True) for n in names]
        + [T.StructField("_line", T.StringType(), True)]
    )
    raw = (
        spark.read.schema(text_schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        .csv(path)
    )
    # a line with as many fields as names, once a mark is put behind it, is short
    wider = T.StructType([T.StructField(f"_f{i}", T.StringType(), True) for i in range(len(names) + 1)])
    mark = "\x01"
    fields = F.from_csv(F.concat("_line", F.lit(sep + mark)), wider.simpleString()[7:-1].replace(":", " "), {"sep": sep, "mode": "PERMISSIVE"})
    marked = F.exists(F.array(*(fields[f"_f{i}"] for i in range(len(names) + 1))), lambda v: F.coalesce(v == mark, F.lit(False)))
    kept = raw.filter(F.col("_line").isNull() | marked)
    return kept.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def country_codes(spark: SparkSession, path: str) -> DataFrame:
    """Country code lookup. ``NA`` (Namibia) is a code, not a null marker."""
    schema = "idx int, name string, alpha2 string, alpha3 string, country_code int, region string"
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
    )


# ---- sinks ---------------------------------------------------------------------------------

def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1: append, partitioned so readers can prune by period."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K2: overwrite (the reference's drop-then-create is the same thing)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_table_if_not_exists(spark: SparkSession, name: str, schema: T.StructType | str, path: str) -> None:
    """K3: ``CREATE TABLE IF NOT EXISTS`` over a parquet location."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def truncate_path(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """K4: empty a parquet location (overwrite with an empty frame) and return the new count."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count()


def append_run_log(spark: SparkSession, path: str, **fields: str) -> None:
    """K6: one run-log row appended as data (never a string-built INSERT)."""
    schema = T.StructType([T.StructField(k, T.StringType(), True) for k in fields])
    spark.createDataFrame([tuple(fields.values())], schema).write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K7: CSV out, header included."""
    df.write.mode("overwrite").option("header", True).csv(path)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """K8: distinct periods stay a DataFrame (no driver loop)."""
    return df.select(column).distinct()


def table_exists(spark: SparkSession, name: str) -> bool:
    """K9: the check the reference meant to write."""
    return spark.catalog.tableExists(name)
