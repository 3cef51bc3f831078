import os
import shutil
import tempfile

from tally.streaming.daily import daily_totals_stream, read_event_stream


def test_stream_daily_totals_equal_batch(spark):
    import __spark_entry__ as E

    src = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(src).schema
    folder = tempfile.mkdtemp(prefix="tally-stream-src-")  # a file source watches a folder
    shutil.copy(src, os.path.join(folder, "part-0.parquet"))
    stream = read_event_stream(spark, folder, schema)
    q = (
        daily_totals_stream(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("tally_daily_test")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tally-stream-"))
        .start()
    )
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("select * from tally_daily_test").collect())
    exp = sorted(tuple(r) for r in E.queries()["daily_totals"](spark, "/root/testdata/sf0.001").collect())
    assert got == exp
