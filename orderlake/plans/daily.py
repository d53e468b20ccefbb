"""The daily batch as one rerunnable function (K14) plus a full backfill.

Order: unconsumed Bronze batches → Silver (their dates, however old) →
customer dimension → Gold (touched dates) → reconciliation → DQ suite → gate.  Every write is a
keyed upsert or a partition replace, so running a date twice leaves the
same tables; only the run log (one row per step and run) grows.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.operators import gold, ingest, quality, scd2, silver
from orderlake.schemas import DIM_CUSTOMERS, SILVER_ORDERS
from orderlake.sources import tables

RUN_LOG_SCHEMA = "job_name string, layer string, processing_date date, started_at timestamp, duration_s double"


@dataclass(frozen=True)
class LakePaths:
    root: str

    def __getattr__(self, name):  # bronze, dlq, silver, dim_customers, gold_hourly, ...
        if name.startswith("__"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


class _Timer:
    def __init__(self, spark, paths, job, layer, day):
        self.spark, self.paths, self.job, self.layer, self.day = spark, paths, job, layer, day

    def __enter__(self):
        self.t0 = time.time()
        return self

    def __exit__(self, *exc):
        row = [(self.job, self.layer, self.day, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                float(time.time() - self.t0))]
        tables.append_rows(self.spark, row, RUN_LOG_SCHEMA, self.paths.run_log)
        return False


def _day(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


CONSUMED_SCHEMA = "processing_date date, stream_id string, after_batch long, through_batch long"


@dataclass(frozen=True)
class Intake:
    """What a run has to process: for each stream its batches (after, through), and the event dates they hold."""

    streams: dict
    dates: list


def intake(spark: SparkSession, paths: LakePaths, day) -> Intake:
    """The Bronze batches that no earlier run has consumed, and the dates of their rows.

    A rerun of a day starts where that day's first run started.  However late
    an event arrives, its date is among the dates of the batch it arrived in.
    Batches are counted for each stream: one with a new checkpoint starts at 0
    again and is taken in from there.
    """
    day = _day(day)
    done = tables.read_table(spark, paths.consumed, StructType.fromDDL(CONSUMED_SCHEMA)).collect()  # a row per day and stream
    after: dict = {}
    for r in done:
        after[r["stream_id"]] = max(after.get(r["stream_id"], -1), r["through_batch"])
    after |= {r["stream_id"]: r["after_batch"] for r in done if r["processing_date"] == day}
    bronze = spark.read.parquet(paths.bronze)
    for stream, batch in after.items():
        bronze = bronze.where((F.col("stream_id").cast("string") != stream) | (F.col("batch_id") > batch))
    # All three are partition columns, one value for each folder.
    found = bronze.select(F.to_date("ingestion_date").alias("d"), F.col("stream_id").cast("string").alias("s"), F.col("batch_id").cast("long").alias("b")).distinct().collect()
    streams = {s: (b, b) for s, b in after.items()}
    for r in found:
        first, last = streams.get(r["s"], (-1, -1))
        streams[r["s"]] = (first, max(last, r["b"]))
    return Intake(streams, sorted({r["d"] for r in found if r["d"] is not None}))


def bronze_to_silver(spark: SparkSession, paths: LakePaths, day, new: Intake) -> None:
    """S4 → P12 → K10 → S10 → dimension, for the dates that new batches hold (late arrivals, SURVEY Q21).

    The dates are restated from all their Bronze rows, so the first copy of an
    event stays whatever batch a later copy came in.  The customer dimension
    is rebuilt (D7) for the customers of those dates from their daily states,
    so late events open their versions on their own day.
    """
    day = _day(day)
    bronze = silver.read_bronze(spark.read.parquet(paths.bronze), dates=new.dates)
    typed = silver.cast_and_extract(ingest.first_copies(bronze), processing_date=day, stamp_load_time=True)
    typed = typed.withColumn("ingestion_date", F.col("ingestion_date").cast("string"))
    stored = _stored(typed, paths)
    dq = quality.inline_dq(stored).withColumn("processing_date", F.lit(day))
    tables.replace_partition(dq, paths.dq_results, "processing_date", day, log=False)
    tables.upsert(stored, paths.silver, ["event_id"], "event_date", order_cols=["ingested_at", "occurred_at"])
    tables.delete_path(spark, paths._typed)
    if not new.dates:
        return
    s = _silver(spark, paths).where(F.col("event_date").isin(new.dates))
    tables.replace_partitions(scd2.daily_customer_state(s), paths.customer_days, "event_date", new.dates, log=False)
    days = spark.read.parquet(paths.customer_days)
    touched = days.where(F.col("event_date").isin(new.dates)).select("customer_id").distinct()
    rebuilt = scd2.history_from_days(days.join(touched, "customer_id", "left_semi"))
    dim = tables.read_table(spark, paths.dim_customers, DIM_CUSTOMERS)
    tables.replace_table(dim.join(touched, "customer_id", "left_anti").unionByName(rebuilt), paths.dim_customers)


def _stored(df: DataFrame, paths: LakePaths) -> DataFrame:
    """The rows written once and read back: several steps use them."""
    df.write.mode("overwrite").parquet(paths._typed)
    return df.sparkSession.read.schema(df.schema).parquet(paths._typed)


def _silver(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return tables.read_table(spark, paths.silver, SILVER_ORDERS)


def silver_to_gold(spark: SparkSession, paths: LakePaths, day, new: Intake) -> None:
    """A1-A3 for the touched dates; the SLA also for the placement dates of orders delivered in them (Q9)."""
    day = _day(day)
    if not new.dates:
        return
    every = _silver(spark, paths)
    s = every.where(F.col("event_date").isin(new.dates))
    tables.replace_partitions(gold.stamp(gold.hourly_orders(s), day), paths.gold_hourly, "event_date", new.dates)
    tables.replace_partitions(gold.stamp(gold.payment_health(s), day), paths.gold_payments, "event_date", new.dates)
    placed = every.where(F.col("event_type") == "ORDER_PLACED")
    arrived = s.where(F.col("event_type") == "ORDER_DELIVERED").select("order_id").distinct()
    placed_on = [r[0] for r in placed.join(arrived, "order_id", "left_semi").select("event_date").distinct().collect()]
    dates = sorted({*new.dates, *placed_on})  # one value for each date
    delivered = every.where((F.col("event_type") == "ORDER_DELIVERED") & (F.col("event_date") >= F.lit(dates[0])))
    both = placed.where(F.col("event_date").isin(dates)).unionByName(delivered)
    tables.replace_partitions(gold.stamp(gold.daily_sla(both), day), paths.gold_sla, "event_date", dates)


def reconcile_day(spark: SparkSession, paths: LakePaths, day) -> DataFrame | None:
    """K11 for ``day``: Bronze first copies of the date vs Silver rows of the date."""
    day = _day(day)
    bronze = spark.read.parquet(paths.bronze).where(F.col("ingestion_date") == F.lit(day))
    silver_df = _silver(spark, paths).where(F.col("event_date") == F.lit(day))
    res = quality.reconcile(bronze.withColumn("ingestion_date", F.col("ingestion_date").cast("string")), silver_df)
    tables.replace_partition(res, paths.reconciliation, "processing_date", day, log=False)
    if not tables.table_exists(spark, paths.reconciliation):
        return None  # no day has rows yet: the gate says ERROR
    return spark.read.parquet(paths.reconciliation).where(F.col("processing_date") == F.lit(day))


def dq_suite_day(spark: SparkSession, paths: LakePaths, day, as_of_ms: int | None = None) -> DataFrame | None:
    """K9 for ``day`` (global aggregate: an empty day still yields a FAIL report)."""
    day = _day(day)
    if not tables.path_exists(spark, paths.silver):
        return None  # ERROR: the gate halts on it (SURVEY Q20)
    as_of_ms = as_of_ms or quality.as_of_millis(dt.datetime.combine(day + dt.timedelta(days=1), dt.time()))
    s = _silver(spark, paths).where(F.col("event_date") == F.lit(day))
    res = quality.run_suite(s, quality.silver_suite(as_of_ms)).withColumn("processing_date", F.lit(day))
    tables.replace_partition(res, paths.dq_suite, "processing_date", day, log=False)
    return spark.read.parquet(paths.dq_suite).where(F.col("processing_date") == F.lit(day))


def run_daily(spark: SparkSession, paths: LakePaths, day, as_of_ms: int | None = None) -> dict:
    """The whole day, in order, rerunnable; returns the gate decision."""
    day = _day(day)
    with _Timer(spark, paths, "bronze_to_silver", "silver", day):
        new = intake(spark, paths, day)
        bronze_to_silver(spark, paths, day, new)
    with _Timer(spark, paths, "silver_to_gold", "gold", day):
        silver_to_gold(spark, paths, day, new)
    with _Timer(spark, paths, "reconciliation", "monitoring", day):
        recon = reconcile_day(spark, paths, day)
    with _Timer(spark, paths, "dq_suite", "quality", day):
        suite = dq_suite_day(spark, paths, day, as_of_ms)
    # The batches count as consumed only now: a run that fails before is simply run again.
    mark = spark.createDataFrame([(day, stream, *batches) for stream, batches in sorted(new.streams.items())], CONSUMED_SCHEMA)
    marks = tables.read_table(spark, paths.consumed, StructType.fromDDL(CONSUMED_SCHEMA)).where(F.col("processing_date") != F.lit(day))
    tables.replace_table(marks.unionByName(mark), paths.consumed, log=False)
    ok, reasons = quality.gate(suite, recon)  # K13
    return {"date": day.isoformat(), "continue": ok, "reasons": reasons}


def backfill(spark: SparkSession, paths: LakePaths) -> None:
    """All dates at once: Silver from all of Bronze, the dimension from full history (D7),
    and every Gold partition — one job per table instead of one run per day."""
    bronze = silver.read_bronze(spark.read.parquet(paths.bronze))
    typed = silver.cast_and_extract(ingest.first_copies(bronze), stamp_load_time=True)
    typed = typed.withColumn("ingestion_date", F.col("ingestion_date").cast("string"))
    tables.upsert(typed, paths.silver, ["event_id"], "event_date", order_cols=["ingested_at", "occurred_at"])
    s = spark.read.parquet(paths.silver)
    tables.replace_all_partitions(scd2.daily_customer_state(s), paths.customer_days, "event_date", log=False)
    tables.replace_table(scd2.history_from_days(spark.read.parquet(paths.customer_days)), paths.dim_customers)
    for fn, path in ((gold.hourly_orders, paths.gold_hourly), (gold.payment_health, paths.gold_payments),
                     (gold.daily_sla, paths.gold_sla)):
        out = fn(s).withColumn("processing_date", F.col("event_date")).withColumn("gold_loaded_at", F.current_timestamp())
        tables.replace_all_partitions(out, path, "event_date")
