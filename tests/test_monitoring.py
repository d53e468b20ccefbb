"""Metrics from tables (M4, M5, W4 brute force), contracts (S20, S21) and the DQ report."""

import datetime as dt
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlake.operators import monitoring, quality, serving
from orderlake.plans.chain import Lake
from orderlake.schemas import FACT_HOURLY_ORDERS, SILVER_ORDERS
from tests.conftest import SF_SMALL
from tests.helpers import T0, event, silver_rows


def run_log(spark):
    rows = [("silver_job", "silver", d) for d in (10.0, 45.0, 100.0, 250.0, 700.0, 2000.0)]
    return spark.createDataFrame(rows, "job_name string, layer string, duration_s double")


def test_duration_histogram_is_cumulative(spark):
    h = monitoring.duration_histogram(run_log(spark)).first()
    assert [h.le_30, h.le_60, h.le_120, h.le_300, h.le_600, h.le_1800, h.le_inf] == [1, 2, 3, 4, 4, 5, 6]


def test_duration_percentiles(spark):
    p = monitoring.duration_percentiles(run_log(spark)).first()
    assert p.p50_s == 175.0 and p.p95_s > 700.0


def test_running_totals_match_a_single_global_window(spark):
    batches = monitoring.batch_metrics(Lake(spark, SF_SMALL).raw)
    got = monitoring.running_totals(batches).select("batch_id", "total_records", "total_dlq", "dup_rate")
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    exp = batches.select("batch_id", F.sum("written").over(w).alias("total_records"),
                         F.sum("dlq").over(w).alias("total_dlq"),
                         (F.sum("duplicates").over(w) / F.greatest(F.sum("written").over(w), F.lit(1))).alias("dup_rate"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_schema_drift_against_contract(spark):
    df = silver_rows(spark, [event()]).drop("pincode").withColumn("item_count", F.col("item_count").cast("string")) \
        .withColumn("extra", F.lit(1))
    got = {(r.column, r.issue) for r in serving.schema_drift(df.schema, SILVER_ORDERS, spark).collect()}
    assert {("pincode", "missing"), ("item_count", "type_changed"), ("extra", "extra")} <= got
    assert ("silver_loaded_at", "missing") in got  # load-time column is added by the job layer


def test_enum_violations(spark):
    df = spark.createDataFrame([("ORDER_PLACED",), ("PAYMENT_PENDING",), (None,)], "event_type string")
    from orderlake import config as C
    got = [(r.event_type, r.rows) for r in serving.enum_violations(df, "event_type", C.VALID_EVENT_TYPES).collect()]
    assert got == [("PAYMENT_PENDING", 1)]


def test_contract_duplicate_keys_detected(spark):
    rows = [(dt.date(2024, 1, 1), 1, "X", "Y", 1, 1.0, 1.0, 1, 1, 0.0, None, None)] * 2
    df = spark.createDataFrame(rows, FACT_HOURLY_ORDERS.schema)
    v = serving.contract_violations(df, FACT_HOURLY_ORDERS).first()
    assert v.row_count == 2 and v.duplicate_keys == 1 and v.duplicate_rows == 2 and v.null_city == 0


def test_dq_json_report_shape(spark, tmp_path):
    from orderlake.sources import tables
    res = quality.run_suite(silver_rows(spark, [event()]), quality.silver_suite(T0 + 1))
    tables.write_json_report(quality.suite_report(res), str(tmp_path / "report"))
    rep = [json.loads(line) for p in (tmp_path / "report").glob("part-*.json") for line in p.read_text().splitlines()]
    assert len(rep) == 1 and len(rep[0]["critical"]) == 5 and len(rep[0]["warning"]) == 3
    assert rep[0]["overall_status"] == "FAIL"  # one row is below the 100-row minimum


def test_conform_casts_and_orders_to_contract(spark):
    hourly = gold_hourly(spark)
    out = serving.conform(hourly.withColumn("processing_date", F.col("event_date"))
                          .withColumn("gold_loaded_at", F.current_timestamp()), FACT_HOURLY_ORDERS)
    assert out.columns == FACT_HOURLY_ORDERS.schema.fieldNames()
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in FACT_HOURLY_ORDERS.schema.fields]


def test_serving_layout_clusters_by_contract_keys(spark):
    laid = serving.serving_layout(gold_hourly(spark), FACT_HOURLY_ORDERS, num_partitions=4)
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_date" in plan and "Sort [event_date" in plan
    assert laid.rdd.getNumPartitions() == 4


def gold_hourly(spark):
    from orderlake.operators import gold
    from orderlake.plans.chain import Lake
    return gold.hourly_orders(Lake(spark, SF_SMALL).silver)
