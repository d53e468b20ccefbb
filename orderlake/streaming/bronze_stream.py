"""Streaming ingest of order events.

Bronze path: source → ``foreachBatch`` writer.  The writer persists the
micro-batch once, splits it into Bronze and dead-letter rows, tags
duplicates (within the batch and against recent Bronze ids), and appends
both outputs under a ``batch_id`` partition so that a replayed batch
overwrites exactly what it wrote before (exactly-once output on a plain
file sink).  Counts are observed during the writes; no extra jobs.

The Bronze path has no stateful operator, so late events are kept there
(G10); watermarks apply to the stateful paths: dedup within the
watermark, the windowed hourly aggregate and the stream-stream join.
"""

from __future__ import annotations

import datetime as dt
import time
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from orderlake import config as C
from orderlake.functions.columns import millis_to_date, money
from orderlake.operators import ingest, silver
from orderlake.schemas import KAFKA_METADATA
from orderlake.sources import tables

# ---------------------------------------------------------------------------
# Sources (S1, S2, P1)
# ---------------------------------------------------------------------------


def kafka_source(spark: SparkSession, bootstrap: str, topic: str = C.ORDERS_TOPIC,
                 max_offsets: int = C.MAX_RECORDS_PER_TRIGGER, starting: str = "latest") -> DataFrame:
    """Subscribe to one topic, start at the latest offsets (the checkpoint wins on restart),
    cap each trigger at ``max_offsets`` records and tolerate compacted offsets.

    Needs the Kafka connector on the classpath; the file source below has the same shape.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("failOnDataLoss", "false")
        .load()
    )
    return ingest.kafka_to_strings(raw).withColumn("kafka_timestamp", F.unix_millis("timestamp")).drop("timestamp")


def file_source(spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = 1,
                max_bytes_per_trigger: str | None = None) -> DataFrame:
    """S1/S2 for tests and replays: Kafka-shaped rows from files, with back-pressure per trigger."""
    reader = spark.readStream.format(fmt).schema(KAFKA_METADATA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


# ---------------------------------------------------------------------------
# Event time and watermark
# ---------------------------------------------------------------------------


def with_event_time(parsed: DataFrame) -> DataFrame:
    """G1: event time from the parsed ``occurred_at`` (not the Kafka timestamp, SURVEY Q1)."""
    return parsed.withColumn("event_time", F.timestamp_millis(F.col("occurred_at")))


def apply_watermark(df: DataFrame, delay: str = C.WATERMARK) -> DataFrame:
    """Tolerate events up to ``delay`` late in stateful operators."""
    return df.withWatermark("event_time", delay)


# ---------------------------------------------------------------------------
# Bronze foreachBatch writer (G4, G6, G7, G8, G9 tag form, M1)
# ---------------------------------------------------------------------------

BATCH_METRICS_SCHEMA = "batch_id long, written long, duplicates long, dlq long, processed_at timestamp"


def tag_seen_before(bronze: DataFrame, bronze_path: str, batch_id: int, horizon_days: int, stream_id: str = "batch") -> DataFrame:
    """G9 (tag form): mark ids already present in Bronze from earlier batches.

    The tag means "seen within the horizon": the Bronze partitions read are
    those from ``horizon_days`` before each of the batch's dates up to that
    date (an event's copies carry its own date), so one very old event adds
    its own dates and not all in between; only ``event_id`` is read.  Older
    copies stay untagged here, and Silver keeps the first copy of all.  The
    planner chooses the semi-join by the batch's measured size.
    """
    spark = bronze.sparkSession
    if not tables.table_exists(spark, bronze_path):
        return bronze
    dates = [dt.date.fromisoformat(str(r[0])) for r in bronze.select("ingestion_date").distinct().collect() if r[0] is not None]
    if not dates:  # one value for each date
        return bronze
    window = sorted({d - dt.timedelta(days=k) for d in dates for k in range(horizon_days + 1)})
    ids = bronze.select("event_id").distinct()
    seen = (
        spark.read.parquet(bronze_path)
        .where(F.col("ingestion_date").isin(window) & ((F.col("batch_id") != F.lit(batch_id)) | (F.col("stream_id").cast("string") != stream_id)))
        .select("event_id")
        .join(ids, "event_id", "left_semi")
        .distinct()
        .withColumn("_seen", F.lit(True))
    )
    return (
        bronze.join(seen, "event_id", "left")
        .withColumn("is_duplicate", F.when(F.col("_seen"), F.lit("true")).otherwise(F.col("is_duplicate")))
        .drop("_seen")
        .select(*bronze.columns)
    )


def bronze_writer(bronze_path: str, dlq_path: str, metrics_path: str | None = None,
                  horizon_days: int = 2, stream_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of the Bronze stream.

    Rows carry ``stream_id``, by default the identity that the running stream
    has from its checkpoint, so that a stream started anew with an empty
    checkpoint overwrites nothing.
    """

    def write(batch_df: DataFrame, batch_id: int) -> None:
        stream = stream_id or batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        batch = batch_df.persist()
        try:
            if batch.isEmpty():  # G7
                return
            bronze, dlq = ingest.bronze_split(batch, loaded_at_ms=int(time.time() * 1000))
            if horizon_days:
                bronze = tag_seen_before(bronze, bronze_path, batch_id, horizon_days, stream)
            mb = tables.append_batch(bronze, bronze_path, batch_id, stream_id=stream, metrics=[  # S8, G6
                F.count(F.lit(1)).alias("written"),
                F.count_if(F.col("is_duplicate") == "true").alias("duplicates")])
            md = tables.append_batch(dlq, dlq_path, batch_id, stream_id=stream,  # S9: an empty DLQ batch writes no partition
                                     metrics=[F.count(F.lit(1)).alias("dlq")])
            if metrics_path:  # M1, replay-safe like the data
                m = {**mb, **md}
                row = [(int(batch_id), int(m.get("written", 0)), int(m.get("duplicates", 0)), int(m.get("dlq", 0)),
                        dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))]
                metrics = batch.sparkSession.createDataFrame(row, BATCH_METRICS_SCHEMA).drop("batch_id")
                tables.append_batch(metrics.coalesce(1), metrics_path, batch_id, partition_cols=(), stream_id=stream)
        finally:
            batch.unpersist()

    return write


def start_bronze_stream(source: DataFrame, bronze_path: str, dlq_path: str, checkpoint: str,
                        metrics_path: str | None = None, processing_time: str | None = C.TRIGGER_INTERVAL,
                        available_now: bool = False, query_name: str = "bronze-orders-stream",
                        horizon_days: int = 2):
    """Start the Bronze stream (named, checkpointed, fixed trigger or available-now)."""
    writer = (
        source.writeStream.foreachBatch(bronze_writer(bronze_path, dlq_path, metrics_path, horizon_days))
        .option("checkpointLocation", checkpoint)
        .queryName(query_name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def stop_gracefully(query, timeout_s: float = 60.0) -> None:
    """Let the running micro-batch finish, then stop."""
    deadline = time.time() + timeout_s
    while query.isActive and query.status.get("isTriggerActive") and time.time() < deadline:
        time.sleep(0.2)
    query.stop()


# ---------------------------------------------------------------------------
# Stateful paths (G9 drop form, G11, J6)
# ---------------------------------------------------------------------------


def typed_stream(raw_stream: DataFrame) -> DataFrame:
    """Raw messages → valid, typed events with event time (stateless)."""
    valid, _ = ingest.validate(ingest.enrich(ingest.parse_messages(raw_stream), loaded_at_ms=0))
    return with_event_time(silver.cast_and_extract(valid))


def dedup_within_watermark(events: DataFrame, delay: str = C.WATERMARK) -> DataFrame:
    """G9 (drop form): the first copy of each event_id within the watermark; state expires with it."""
    return apply_watermark(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly_orders_stream(events: DataFrame, delay: str = C.WATERMARK, dedup: bool = True) -> DataFrame:
    """Hourly orders per city and category as a tumbling event-time window.

    In append mode a window is emitted once the watermark passes its end;
    events later than the watermark are dropped here but kept in Bronze
    (G10).  Copies of an event are dropped within the same watermark first
    (as Silver keeps first copies).  Distinct customers are exact in two
    chained aggregates: a state row per customer of an hour, city and category,
    then one per hour, city and category over the customers' rows.  So no
    state holds a set, and a hot group is spread by its customers.
    """
    placed = apply_watermark(events.where(F.col("event_type") == "ORDER_PLACED"), delay)
    if dedup:
        placed = placed.dropDuplicatesWithinWatermark(["event_id"])
    by_customer = placed.groupBy(F.window("event_time", "1 hour").alias("w"), "city", "category", "customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(money("amount")).alias("revenue"),
        F.count("amount").alias("amounts"),
        F.sum("item_count").alias("items"),
        F.sum("discount_pct").alias("discount"),
        F.count("discount_pct").alias("discounts"),
    )
    hourly = by_customer.groupBy(F.window(F.window_time("w"), "1 hour").alias("w"), "city", "category").agg(
        F.sum("orders").alias("order_count"),
        F.sum("revenue").cast("double").alias("gross_revenue"),
        (F.sum("revenue").cast("double") / F.nullif(F.sum("amounts"), F.lit(0))).alias("avg_order_value"),
        F.sum("items").alias("total_items"),
        F.count("customer_id").alias("unique_customers"),
        (F.sum("discount") / F.nullif(F.sum("discounts"), F.lit(0))).alias("avg_discount_pct"),
    )
    return hourly.select(
        millis_to_date(F.unix_millis(F.col("w.start"))).alias("event_date"),
        (F.floor(F.pmod(F.unix_millis(F.col("w.start")), F.lit(C.MS_PER_DAY)) / F.lit(C.MS_PER_HOUR))).cast("int").alias("event_hour"),
        "city", "category", "order_count", "gross_revenue", "avg_order_value", "total_items",
        "unique_customers", "avg_discount_pct",
    )


#: What J6 keeps of an order: the placement, the first delivery at or after it, earlier-seen deliveries, the status last emitted.
_ORDER_STATE = "city string, placed_ms long, delivered_ms long, early_ms array<long>, said string"
_STATUS_ROWS = "order_id string, city string, placed_ms long, delivered_ms long, delivery_hours double, delivery_status string"


def _settle(horizon_ms: int):
    """The state function of :func:`delivery_status_stream`; one call per order and batch, or at its timer."""

    def status(placed, delivered):
        if delivered is None:
            return "PENDING"
        return "ON_TIME" if (delivered - placed) / float(C.MS_PER_HOUR) <= C.SLA_HOURS else "LATE"

    def step(key, batches, state):
        city, placed, delivered, waiting, said = state.get if state.exists else (None, None, None, [], None)
        waiting = set(waiting or []) | ({delivered} if delivered is not None else set())
        for pdf in batches:  # a state function of a timer gets none
            is_placed = pdf["event_type"] == "ORDER_PLACED"
            for at, where in zip(pdf.loc[is_placed, "occurred_at"], pdf.loc[is_placed, "city"], strict=True):
                if placed is None or at < placed:
                    placed, city = int(at), where
            waiting.update(int(t) for t in pdf.loc[~is_placed, "occurred_at"])
        if placed is None:
            kept = sorted(waiting)
        else:
            delivered = min((t for t in waiting if t >= placed), default=None)
            # Deliveries before the placement wait for an earlier placement; later ones than the first can't count any more.
            kept = sorted(t for t in waiting if t < placed)
        rows = []
        due = state.hasTimedOut
        now = None
        if placed is not None and (delivered is not None or due or said is not None):
            now = f"{placed}|{delivered}"
            if now != said:
                hours = None if delivered is None else (delivered - placed) / float(C.MS_PER_HOUR)
                rows.append((key[0], city, placed, delivered, hours, status(placed, delivered)))
        state.update((city, placed, delivered, kept, now or said))
        if placed is not None and delivered is None and said is None and not due:
            state.setTimeoutTimestamp(max(placed + horizon_ms, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _STATUS_ROWS.split(", ")]).astype({"placed_ms": "Int64", "delivered_ms": "Int64"})

    return step


def delivery_status_stream(events: DataFrame, horizon_hours: int = 96, delay: str = C.WATERMARK) -> DataFrame:
    """J6 with corrections: the last row of an order is its row in ``gold.fulfillment``, however late its delivery comes.

    One state row per order.  A delivery gives ON_TIME or LATE at once; an
    order without one gives PENDING when the watermark passes
    ``horizon_hours`` after its placement, and a correction when the delivery
    comes after all.  A repeated delivery changes nothing and gives no row; a
    placement or delivery that arrives out of order corrects the row given.

    The state of an order stays, as any later event may concern it: it is a few
    numbers per order in the state store, on disk with the RocksDB provider.
    Placements of an order count as one, the earliest.  Rows later than the
    watermark are dropped, as in all stateful paths (Bronze keeps them, G10).
    """
    rows = apply_watermark(events.where(F.col("event_type").isin("ORDER_PLACED", "ORDER_DELIVERED") & F.col("order_id").isNotNull()), delay)
    rows = rows.select("order_id", "event_type", "city", "occurred_at", "event_time")
    return rows.groupBy("order_id").applyInPandasWithState(
        _settle(horizon_hours * C.MS_PER_HOUR), _STATUS_ROWS, _ORDER_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def fulfillment_stream(events: DataFrame, horizon_hours: int = 96, delay: str = C.WATERMARK) -> DataFrame:
    """Placed ⋈ delivered as a stream-stream left outer join on order_id.

    Both sides carry watermarks and the join is bounded in event time
    (delivery within ``horizon_hours`` of placement), so state is released
    once the watermark passes; unmatched orders are emitted as PENDING then.
    Copies of events and repeated deliveries are dropped within the watermark
    on both sides; a delivery repeated later than that gives a second row, and
    one later than the horizon none.  :func:`delivery_status_stream` has
    neither limit.
    """
    placed = (
        events.where(F.col("event_type") == "ORDER_PLACED")
        .select("event_id", F.col("order_id").alias("p_order_id"), "city", F.col("occurred_at").alias("placed_ms"),
                F.col("event_time").alias("placed_time"))
        .withWatermark("placed_time", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("event_id")
    )
    delivered = (
        events.where(F.col("event_type") == "ORDER_DELIVERED")
        .select(F.col("order_id").alias("d_order_id"), F.col("occurred_at").alias("delivered_ms"),
                F.col("event_time").alias("delivered_time"))
        .withWatermark("delivered_time", delay)
        .dropDuplicatesWithinWatermark(["d_order_id"])
    )
    cond = (
        (F.col("p_order_id") == F.col("d_order_id"))
        & (F.col("delivered_time") >= F.col("placed_time"))
        & (F.col("delivered_time") <= F.col("placed_time") + F.expr(f"INTERVAL {int(horizon_hours)} HOURS"))
    )
    joined = placed.join(delivered, cond, "leftOuter")
    hours = (F.col("delivered_ms") - F.col("placed_ms")) / F.lit(float(C.MS_PER_HOUR))
    return joined.select(
        F.col("p_order_id").alias("order_id"), "city", "placed_ms", "delivered_ms",
        hours.alias("delivery_hours"),
        F.when(F.col("delivered_ms").isNull(), F.lit("PENDING"))
        .when(hours <= F.lit(C.SLA_HOURS), F.lit("ON_TIME")).otherwise(F.lit("LATE")).alias("delivery_status"),
    )
