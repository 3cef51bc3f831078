import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tally.operators import ensemble as ens
from tally.sources import io


def _forecasts(spark):
    rows = [("L1|P1", dt.date(2023, 8, 1), dt.date(2023, 8, 1), 10.0), ("L1|P2", dt.date(2023, 8, 1), dt.date(2023, 9, 1), 5.5)]
    df = spark.createDataFrame(rows, "id string, forecast_create_period date, forecast_target_period date, forecast double")
    return ens.split_id(df)


def test_append_twice_newer_run_is_active(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="tally-sink-"), "forecast")
    f = _forecasts(spark)
    for stamp, ver in (("2023-08-02 06:30:00", "v1"), ("2023-08-03 06:30:00", "v2")):
        pub = ens.publish_rows({"ensemble": f}, "demand_app", {"ensemble": ver}, F.lit(stamp).cast("timestamp"))
        io.append_table(pub, out, partition_by=["forecast_create_period"])
    table = spark.read.parquet(out)
    assert table.count() == 4
    act = ens.active_run(table).filter("active = 1").select("model_version").distinct().collect()
    assert [r.model_version for r in act] == ["ensemble_v2_2023-08-03-12_00_00"]
    # published layout and types
    assert [c for c in pub.columns] == list(ens.PUBLISH_COLUMNS)
    assert dict(pub.dtypes)["forecast"] == "decimal(18,6)"


def test_truncate_run_log_and_csv(spark):
    base = tempfile.mkdtemp(prefix="tally-sink-")
    f = _forecasts(spark)
    p = os.path.join(base, "staging")
    io.overwrite_table(f, p)
    assert io.truncate_path(spark, p, f.schema) == 0
    log = os.path.join(base, "runlog")
    io.append_run_log(spark, log, experiment_name="ma_v1", experiment_type="ma", start_time="a", end_time="b")
    io.append_run_log(spark, log, experiment_name="ma_v2", experiment_type="ma", start_time="c", end_time="d")
    assert spark.read.parquet(log).count() == 2
    c = os.path.join(base, "csv")
    io.write_csv(f, c)
    back = spark.read.option("header", True).csv(c)
    assert back.count() == 2 and "forecast" in back.columns
    assert io.distinct_values(f, "forecast_create_period").count() == 1


def test_training_table_keeps_one_row_per_id_and_month(spark):
    import __spark_entry__ as E

    tt = E.queries()["training_table"](spark, "/root/testdata/sf0.001")
    n = tt.count()
    assert n > 0
    assert tt.select("id", "month_start_date").distinct().count() == n
    cats = [c for c in tt.columns if c.endswith("_seasonality_status_cat")]
    assert len(cats) == 12
