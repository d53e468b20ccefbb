"""Operational metrics computed from tables.

The platform's counters, gauges and histograms become aggregates over the
tables the pipeline already writes (messages, Bronze, dead letters, Silver,
a run log), so they can be recomputed, backfilled and tested like any query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake import config as C
from orderlake.functions.columns import lateness_seconds
from orderlake.operators import ingest
from orderlake.operators.quantiles import exact_quantiles

TRIGGER_MS = 30_000
BATCHES_PER_DAY = 86_400_000 // TRIGGER_MS


def with_batch_id(df: DataFrame, ts_ms: str = "kafka_timestamp", trigger_ms: int = TRIGGER_MS) -> DataFrame:
    """Micro-batch a message fell into under a fixed processing-time trigger."""
    return df.withColumn("batch_id", F.floor(F.col(ts_ms) / F.lit(trigger_ms)).cast("long"))


def batch_metrics(raw: DataFrame, trigger_ms: int = TRIGGER_MS) -> DataFrame:
    """M1: per micro-batch — rows written to Bronze, batch-local duplicates, dead letters.

    Duplicates are counted within each batch, as the streaming writer tags
    them: every copy of an id beyond the first in the same batch.  That is
    rows minus distinct (batch, id) pairs, so one partial aggregate per
    (batch, id) gives both counts without a join, and a hot id collapses
    map-side.
    """
    msgs = with_batch_id(raw, trigger_ms=trigger_ms)
    checked = ingest.with_validation(ingest.parse_messages(msgs, carry=["batch_id"]))
    # Invalid rows are counted under no id, so one parse and two small aggregates give all three numbers.
    per_id = checked.groupBy("batch_id", "is_valid", F.when(F.col("is_valid"), F.col("event_id")).alias("event_id")).agg(F.count(F.lit(1)).alias("n"))
    count = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")
    return per_id.groupBy("batch_id").agg(
        count(F.col("is_valid"), F.col("n")).alias("written"),
        count(F.col("is_valid"), F.col("n") - 1).alias("duplicates"),
        count(~F.col("is_valid"), F.col("n")).alias("dlq"),
    )


def running_totals(batches: DataFrame, trigger_ms: int = TRIGGER_MS) -> DataFrame:
    """Cumulative records, duplicates and dead letters over batches, with rates.

    A running sum over one global order would pull every batch into one
    task.  Instead batches are summed inside day buckets (parallel windows)
    and each bucket adds the total of the buckets before it; that second
    window runs over one row per day, a size bounded by the calendar.
    """
    per_day = BATCHES_PER_DAY if trigger_ms == TRIGGER_MS else max(1, 86_400_000 // trigger_ms)
    b = batches.withColumn("_bucket", F.floor(F.col("batch_id") / F.lit(per_day)))
    inside = Window.partitionBy("_bucket").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    metrics = ["written", "duplicates", "dlq"]
    for m in metrics:
        b = b.withColumn(f"_in_{m}", F.sum(m).over(inside))
    buckets = b.groupBy("_bucket").agg(F.min("batch_id").alias("_first"), *[F.sum(m).alias(f"_tot_{m}") for m in metrics])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = buckets.select(
        "_bucket",
        F.min("_first").over(everything).alias("_start"),
        *[F.coalesce(F.sum(f"_tot_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in metrics],
    )
    out = b.join(offsets, "_bucket")
    cum = {m: (F.col(f"_in_{m}") + F.col(f"_off_{m}")) for m in metrics}
    elapsed_s = (F.col("batch_id") - F.col("_start") + 1) * F.lit(trigger_ms / 1000.0)
    return out.select(
        "batch_id", *metrics,
        cum["written"].alias("total_records"),
        cum["duplicates"].alias("total_duplicates"),
        cum["dlq"].alias("total_dlq"),
        (cum["written"] / elapsed_s).alias("avg_throughput"),
        (cum["duplicates"] / F.greatest(cum["written"], F.lit(1))).alias("dup_rate"),
        (cum["dlq"] / F.greatest(cum["written"], F.lit(1))).alias("dlq_rate"),
    )


def records_by_layer(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """M2: records per layer, source system and event type (each layer aggregated before the union)."""
    def layer(df, name):
        return df.groupBy("source_system", "event_type").agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("layer"), "source_system", "event_type", "records")
    return layer(bronze, "bronze").unionByName(layer(silver, "silver"))


def dlq_by_reason(dlq: DataFrame, topic: str = C.ORDERS_TOPIC) -> DataFrame:
    """M3: dead letters per source topic and failure reason."""
    return dlq.groupBy(F.lit(topic).alias("source_topic"), F.col("validation_failure").alias("failure_reason")).agg(
        F.count(F.lit(1)).alias("dlq_events"))


def duration_histogram(run_log: DataFrame, buckets=C.DURATION_BUCKETS_SECONDS) -> DataFrame:
    """M4: cumulative duration buckets (le=30..1800, +Inf) per job and layer from a run log."""
    return run_log.groupBy("job_name", "layer").agg(
        *[F.count_if(F.col("duration_s") <= F.lit(le)).alias(f"le_{le}") for le in buckets],
        F.count(F.lit(1)).alias("le_inf"),
        F.sum("duration_s").alias("duration_sum"),
    )


def duration_percentiles(run_log: DataFrame) -> DataFrame:
    """M5: exact p50 / p95 job duration per job and layer, by selection: no group's values are held in one buffer."""
    return exact_quantiles(run_log, ["job_name", "layer"], "duration_s", {"p50_s": 0.5, "p95_s": 0.95})


def step_durations(silver: DataFrame) -> DataFrame:
    """Run-log rows of the order process: seconds from placement to each later event of the order, by event type."""
    placed = silver.where(F.col("event_type") == "ORDER_PLACED").groupBy("order_id", F.hash("order_id").alias("_g")).agg(F.min("occurred_at").alias("placed_ms")).drop("_g")
    later = silver.where(F.col("event_type") != "ORDER_PLACED").select("order_id", "event_type", "occurred_at")
    # The join sorts; with a hash first, identifiers that begin alike are not compared in full.
    h = F.xxhash64("order_id").alias("_h")
    return later.select("*", h).join(placed.select("*", h), ["_h", "order_id"]).where(F.col("occurred_at") >= F.col("placed_ms")).select(
        F.lit("order").alias("job_name"), F.col("event_type").alias("layer"), ((F.col("occurred_at") - F.col("placed_ms")) / F.lit(1000.0)).alias("duration_s"))


def pipeline_lag(bronze: DataFrame, topic: str = C.ORDERS_TOPIC) -> DataFrame:
    """M7: max event-to-ingest lag per topic and day, with the dashboard's bands."""
    lag = F.max(lateness_seconds())
    return bronze.groupBy(F.lit(topic).alias("source_topic"), "ingestion_date").agg(lag.alias("max_lag_seconds")).withColumn(
        "lag_band",
        F.when(F.col("max_lag_seconds") >= C.LAG_RED_SECONDS, "red")
        .when(F.col("max_lag_seconds") >= C.LAG_YELLOW_SECONDS, "yellow")
        .otherwise("green"),
    )


def records_per_minute(df: DataFrame, layer: str, ts_ms: str = "ingested_at") -> DataFrame:
    """M8: records per minute over a 5-minute window sliding by 1 minute."""
    # Counted per minute first: the sliding window then expands one row per minute, not every record.
    minute = F.window(F.timestamp_millis(F.col(ts_ms)), C.RATE_SLIDE)
    per_minute = df.groupBy(minute.alias("m")).agg(F.count(F.lit(1)).alias("n")).select(F.col("m.start").alias("ts"), "n")
    minutes = 5.0
    return (
        per_minute.groupBy(F.window("ts", C.RATE_WINDOW, C.RATE_SLIDE).alias("w"))
        .agg(F.sum("n").alias("n"))
        .select(
            F.lit(layer).alias("layer"),
            F.unix_millis(F.col("w.start")).alias("window_start"),
            F.unix_millis(F.col("w.end")).alias("window_end"),
            (F.col("n") / F.lit(minutes)).alias("records_per_minute"),
        )
    )


def duplicate_rate(bronze: DataFrame, topic: str = C.ORDERS_TOPIC) -> DataFrame:
    """M9: share of Bronze rows tagged duplicate, per topic and day."""
    return bronze.groupBy(F.lit(topic).alias("source_topic"), "ingestion_date").agg(
        F.avg((F.col("is_duplicate") == "true").cast("double")).alias("duplicate_rate"))


def silver_count_by_processing_date(silver: DataFrame) -> DataFrame:
    """M10."""
    return silver.groupBy("processing_date").agg(F.count(F.lit(1)).alias("silver_records"))


def consumer_lag(raw: DataFrame, committed: DataFrame, topic: str = C.ORDERS_TOPIC) -> DataFrame:
    """Per topic partition — log-end offset, committed offset, and records not yet consumed.

    ``committed`` holds (partition, committed_offset); partitions absent from
    it have consumed nothing.
    """
    msgs = raw.select(F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"))
    c = committed.select(F.col("partition").cast("int").alias("partition"), F.col("committed_offset").cast("long"))
    j = msgs.join(c, "partition", "left")
    return j.groupBy(F.lit(topic).alias("topic"), "partition").agg(
        F.max("offset").alias("log_end_offset"),
        F.max("committed_offset").alias("committed_offset"),
        F.count_if(F.col("committed_offset").isNull() | (F.col("offset") > F.col("committed_offset"))).alias("lag_records"),
    )


def committed_offsets(raw: DataFrame, processed_before_ms: int) -> DataFrame:
    """Committed offset per partition of a consumer that has processed every message
    published before ``processed_before_ms``."""
    return raw.where(F.col("kafka_timestamp") < F.lit(processed_before_ms)).groupBy(
        F.col("partition").cast("int").alias("partition")).agg(F.max(F.col("offset").cast("long")).alias("committed_offset"))
