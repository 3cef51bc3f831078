"""K5: the ``active`` flag of published runs, written in place.

A published table is partitioned by create period. A new run appends rows; ``activate_run`` then sets ``active`` to 1 for
the rows of a period's newest run per application and to 0 for its others. Only the periods in which a flag is wrong are
written again (found from three columns), with Spark's dynamic partition overwrite: the new files are
written to a staging folder first, and when all of them are there each period's folder is replaced. Other periods' files
are not touched. A job that fails before that leaves the table as it was; repeating a finished call finds nothing to
do. While a period's folder is being replaced a reader that lists it at that moment can miss it, so readers are best
pointed at periods that are closed, or derive the flag on read (``ensemble.active_run``).

A null create_timestamp is older than any other; null periods and applications are values of their own; of runs with
equal newest time all rows are active.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import cut_lineage

PERIOD, APPLICATION, STAMP = "forecast_create_period", "application", "create_timestamp"


def _with_wanted(published: DataFrame) -> DataFrame:
    newest = published.groupBy(PERIOD, APPLICATION).agg(F.max(STAMP).alias("_newest"))
    named = newest.select(F.col(PERIOD).alias("_p"), F.col(APPLICATION).alias("_a"), "_newest")
    same = F.col(PERIOD).eqNullSafe(F.col("_p")) & F.col(APPLICATION).eqNullSafe(F.col("_a"))
    j = published.join(named, same, "left")
    return j.withColumn("_wanted", F.col(STAMP).eqNullSafe(F.col("_newest")).cast("int")).drop("_p", "_a", "_newest")


def stale_periods(published: DataFrame) -> DataFrame:
    """(period): periods in which some row's flag is not what it should be."""
    flags = published.select(PERIOD, APPLICATION, STAMP, "active")
    return _with_wanted(flags).where(~F.col("active").eqNullSafe(F.col("_wanted"))).select(PERIOD).distinct()


def activate_run(spark: SparkSession, path: str) -> int:
    """Write the flags of the table at ``path`` (Parquet, partitioned by period) and return how many periods changed."""
    table = spark.read.parquet(path)
    changed = cut_lineage(stale_periods(table).withColumnRenamed(PERIOD, "_p"))
    n = changed.count()
    if not n:
        return 0
    # the rows are written aside first: the files that are read are those that get replaced
    rows = table.join(changed, F.col(PERIOD).eqNullSafe(F.col("_p")), "left_semi")
    fixed = cut_lineage(_with_wanted(rows).withColumn("active", F.col("_wanted")).select(*table.columns))
    # a period's rows go to one file per task, not one per task and period
    spread = fixed.repartition(PERIOD, F.pmod(F.xxhash64(*[c for c in table.columns if c != PERIOD]), F.lit(8)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(path)
    return n
