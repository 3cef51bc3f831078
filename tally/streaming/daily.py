"""B24 on a stream: daily totals of an event source with Structured Streaming.

The aggregate expressions are the batch query's (``daily_measures``), so both paths give the same
numbers. Days are event-time windows with a watermark; state for a day is dropped once the
watermark passes it, so state stays bounded however long the stream runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def daily_measures(value: str = "value", kind: str = "event_type", purchase: str = "purchase") -> list[Column]:
    """Four measures per day: events, total value, purchases, purchase value (exact decimals)."""
    v = F.col(value).cast("decimal(18,2)")
    is_purchase = F.col(kind) == purchase
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.sum(v).cast("double").alias("total_value"),
        F.count(F.when(is_purchase, 1)).alias("n_purchases"),
        F.coalesce(F.sum(F.when(is_purchase, v)), F.lit(0)).cast("double").alias("purchase_value"),
    ]


def daily_totals_stream(events: DataFrame, ts: str = "ts", watermark: str = "1 day") -> DataFrame:
    """Streaming daily totals: a one-day tumbling event-time window behind a watermark."""
    e = events.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", watermark)
    agg = e.groupBy(F.window("_et", "1 day").alias("_w")).agg(*daily_measures())
    return agg.select(F.to_date(F.col("_w.start")).alias("event_date"), *[c for c in agg.columns if c != "_w"])


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = 1) -> DataFrame:
    """Parquet files arriving in a folder as a stream (``maxFilesPerTrigger`` bounds each batch)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def start_daily_totals(events: DataFrame, sink_path: str, checkpoint: str, watermark: str = "1 day"):
    """Append finished days to a Parquet sink; the checkpoint makes restarts exactly-once."""
    return (
        daily_totals_stream(events, watermark=watermark)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .start()
    )
