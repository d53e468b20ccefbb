"""Registered queries: one per inventory ID of SURVEY §2 (ID in the comment).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built
from the driver's tables; ``oracle.py`` holds the SQL twin under the same key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.plans.chain import Lake, present

QUERIES = {}


def query(name, fuzzy: tuple[str, ...] = ()):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: present(fn(Lake(spark, sf_dir)), fuzzy)
        return fn
    return deco


# --- ingest ------------------------------------------------------------------

PAYLOAD_KEYS = ["city", "category", "amount", "item_count", "discount_pct", "device", "pincode", "gateway", "loyalty_points"]

@query("p2_parse_messages")  # P1, P2
def _p2(lake):
    p = lake.parsed
    return p.select(
        "event_id", "event_type", "order_id", "customer_id", "occurred_at", "ingested_at",
        "schema_version", "source_system", "kafka_partition", "kafka_offset", "malformed",
        *[p.payload.getItem(k).alias(f"p_{k}") for k in PAYLOAD_KEYS],
    )


@query("v1_valid_events")  # V1 (valid side), P4
def _v1(lake):
    from orderlake.operators import ingest
    valid, _ = ingest.validate(ingest.enrich(lake.parsed, 0))
    return valid.select("event_id", "event_type", "kafka_partition", "kafka_offset", "ingestion_date")


@query("v2_dead_letter")  # V1 (invalid side), V2
def _v2(lake):
    return lake.dlq.select("event_id", "event_type", "order_id", "kafka_partition", "kafka_offset",
                           "validation_failure")


@query("w1_bronze_duplicates")  # W1, P3, P4
def _w1(lake):
    from orderlake.operators import ingest
    keys = [f"p_{k}" for k in PAYLOAD_KEYS]
    # Tagging reads the rows twice, so they are stored.
    rows = lake.stored(lake.bronze_rows.select("event_id", "ingested_at", "kafka_partition", "kafka_offset", "ingestion_date", "pipeline_version",
                                               *[F.col("payload").getItem(k).alias(f"p_{k}") for k in PAYLOAD_KEYS]))
    return ingest.tag_duplicates(rows).select("event_id", "kafka_partition", "kafka_offset", "ingestion_date", "pipeline_version", "is_duplicate", *keys)


@query("p12_silver_orders")  # P5-P12, P11
def _p12(lake):
    return lake.silver


@query("a1_hourly_orders")  # A1
def _a1(lake):
    return lake.hourly


# --- gold ----------------------------------------------------------------------

@query("j1_fulfillment")  # J1, P13, P14
def _j1(lake):
    from orderlake.operators import gold
    return gold.fulfillment(lake.lifecycle).select(
        "order_id", "customer_id", "city", "placed_ms", "placed_date", "delivered_ms",
        "delivery_hours", "sla_met", "delivery_status")


@query("a2_daily_sla", fuzzy=("avg_delivery_hours",))  # A2
def _a2(lake):
    return lake.sla


@query("a3_payment_health")  # A3, P11
def _a3(lake):
    return lake.payments


@query("a4_payment_health_by_gateway")  # A4
def _a4(lake):
    from orderlake.operators import gold
    from orderlake.operators import ingest
    return gold.payment_health_by_gateway(gold.payment_events(ingest.first_copies(lake.bronze_rows)))


@query("p15_late_events")  # P15
def _p15(lake):
    from orderlake.operators import silver
    return silver.late_events(lake.silver_of("event_id", "event_type", "event_date", "ingested_at", "occurred_at")).select("event_id", "event_type", "event_date", "lateness_seconds")


# --- serving views and reports ----------------------------------------------------

AS_OF_DAY = "1998-06-15"  # the "today" of X5
AS_OF_TS = "2001-08-03T00:00:00"  # the "now" of the future-event check


@query("x1_daily_revenue", fuzzy=("avg_order_value",))  # X1, T5
def _x1(lake):
    from orderlake.operators import serving
    return serving.daily_revenue(lake.hourly)


@query("x2_city_leaderboard")  # X2, W2
def _x2(lake):
    from orderlake.operators import serving
    return serving.city_leaderboard(lake.hourly)


@query("x3_sla_compliance")  # X3, T5
def _x3(lake):
    from orderlake.operators import serving
    return serving.sla_compliance(lake.sla)


@query("x4_payment_failure_rate")  # X4, T5
def _x4(lake):
    from orderlake.operators import serving
    return serving.payment_failure_rate(lake.payments)


@query("x5_today_hourly")  # X5, T5
def _x5(lake):
    from orderlake.operators import serving
    return serving.today_hourly(lake.hourly, AS_OF_DAY)


@query("x6_exact_daily_revenue")  # X6
def _x6(lake):
    from orderlake.operators import serving
    return serving.exact_daily_revenue(lake.silver_of("event_type", "event_date", "amount", "customer_id"))


@query("t1_top_hours_by_revenue")  # T1
def _t1(lake):
    from orderlake.operators import serving
    return serving.top_hours_by_revenue(lake.hourly)


@query("t2_sla_report", fuzzy=("avg_delivery_hours",))  # T2
def _t2(lake):
    from orderlake.operators import serving
    return serving.sla_report(lake.sla)


@query("t3_payment_report")  # T3
def _t3(lake):
    from orderlake.operators import serving
    return serving.payment_report(lake.payments)


@query("s20_contract_hourly")  # S20
def _s20(lake):
    from orderlake.operators import serving
    from orderlake.schemas import FACT_HOURLY_ORDERS
    conformed = serving.conform(lake.hourly.withColumn("processing_date", F.col("event_date"))
                                .withColumn("gold_loaded_at", F.lit(None).cast("timestamp")), FACT_HOURLY_ORDERS)
    return serving.contract_violations(conformed, FACT_HOURLY_ORDERS)


# --- quality ----------------------------------------------------------------------

@query("a6_event_type_distribution")  # A6, T4
def _a6(lake):
    from orderlake.operators import quality
    return quality.event_type_distribution(lake.bronze_rows)


@query("a7_bronze_profile")  # A7, T4
def _a7(lake):
    from orderlake.operators import quality
    return quality.bronze_profile(lake.keep("ingestion_date").tagged)


CHECKED = ["event_id", "event_type", "order_id", "customer_id", "occurred_at", "schema_version", "event_date", "event_timestamp", "city", "amount"]


def _suite(lake):
    from orderlake.operators import quality
    return quality.run_suite(lake.silver_of(*CHECKED), quality.silver_suite(quality.as_of_millis(AS_OF_TS)), by=["event_date"])


@query("k9_dq_suite")  # K1-K9
def _k9(lake):
    return _suite(lake)


@query("m6_dq_check_flags")  # M6
def _m6(lake):
    from orderlake.operators import quality
    return quality.check_flags(_suite(lake))


@query("k10_inline_dq")  # K10, A8
def _k10(lake):
    from orderlake.operators import quality
    return quality.inline_dq(lake.silver_of("event_date", "event_type", "amount", "city", "customer_id"), by=["event_date"])


@query("a8_global_dq")  # A8
def _a8(lake):
    from orderlake.operators import quality
    return quality.inline_dq(lake.silver_of("event_type", "amount", "city", "customer_id"))


@query("k11_reconciliation")  # K11
def _k11(lake):
    from orderlake.operators import quality
    kept = lake.keep("ingestion_date", "event_date")
    return quality.reconcile(kept.tagged, kept.silver_of("event_date"))


@query("j1_negative_hours")  # J1: deliveries recorded before the placement
def _j1n(lake):
    from orderlake.operators import gold
    return gold.sla_violations(lake.lifecycle).select("order_id", "placed_ms", "delivered_ms", "delivery_hours")


@query("m4_duration_histogram", fuzzy=("duration_sum",))  # M4
def _m4(lake):
    from orderlake.operators import monitoring
    return monitoring.duration_histogram(monitoring.step_durations(lake.stored(lake.silver_of("order_id", "event_type", "occurred_at"))))


@query("m5_duration_percentiles", fuzzy=("p50_s", "p95_s"))  # M5
def _m5(lake):
    from orderlake.operators import monitoring
    return monitoring.duration_percentiles(monitoring.step_durations(lake.stored(lake.silver_of("order_id", "event_type", "occurred_at"))))


def _source(lake):
    """The messages with an identifier and a usable time, and Silver of the valid ones: parsed once, stored."""
    from orderlake.operators import ingest, silver
    rows = ingest.with_validation(ingest.enrich(lake.parsed, 0)).where(F.col("event_id").isNotNull() & ingest._time_ok())
    rows = lake.stored(rows.select("event_id", "occurred_at", "ingested_at", "kafka_partition", "kafka_offset", "is_valid"))
    valid = rows.where("is_valid").withColumn("event_date", silver.millis_to_date("occurred_at"))
    return rows, ingest.first_copies(valid, columns=["event_id", "event_date"])


@query("k12_backfill_dates")  # K11 (source form), K12
def _k12(lake):
    from orderlake.operators import quality
    return quality.backfill_dates(quality.source_reconcile(*_source(lake)), "source_count")


@query("k12_missing_ids")  # K12
def _k12b(lake):
    from orderlake.operators import quality
    return quality.missing_ids(*_source(lake))


@query("w3_type_share_drift", fuzzy=("trailing_avg_share", "share_change"))  # W3
def _w3(lake):
    from orderlake.operators import quality
    return quality.type_share_drift(lake.silver_of("event_date", "event_type"))


# --- type-2 customer dimension ------------------------------------------------------

SCD_CUTOFF = "2000-01-01"  # the dimension is built from events before it, then a catch-up snapshot is applied


def _seen(lake, *more):
    return lake.silver_of("event_id", "customer_id", "event_date", "occurred_at", "city", "device", *more)


def _applied(lake):
    from orderlake.operators import scd2
    # History and snapshot both follow from the daily states; these are stored, a row for a customer's day instead of one for each event.
    days, cut = lake.stored(scd2.daily_customer_state(_seen(lake))), F.lit(SCD_CUTOFF).cast("date")
    before, after = days.where(F.col("event_date") < cut), days.where(F.col("event_date") >= cut)
    return scd2.scd2_apply(scd2.history_from_days(before), scd2.snapshot_from_days(after), SCD_CUTOFF)


@query("a5_customer_snapshot")  # A5
def _a5(lake):
    from orderlake.operators import scd2
    return scd2.customer_snapshot(_seen(lake))


@query("d7_full_history")  # D7
def _d7(lake):
    from orderlake.operators import scd2
    return scd2.scd2_history(_seen(lake))


@query("d8_dimension_violations")  # D8
def _d8(lake):
    from orderlake.operators import scd2
    return scd2.dimension_violations(_applied(lake))


@query("d1_scd2_apply")  # D1-D5, J2, J4
def _d1(lake):
    return _applied(lake)


@query("d6_initial_load")  # D6
def _d6(lake):
    from orderlake.operators import scd2
    return scd2.scd2_apply(scd2.empty_dimension(lake.spark), scd2.customer_snapshot(_seen(lake)), SCD_CUTOFF)


@query("j5_city_as_of")  # J5
def _j5(lake):
    from orderlake.operators import scd2
    seen = lake.stored(_seen(lake, "event_type"))
    placed = seen.where(F.col("event_type") == "ORDER_PLACED").select("event_id", "customer_id", "event_date", "city")
    return scd2.city_as_of(placed, scd2.scd2_history(seen))


# --- ingest extras: sampling, keyed publish, producer checks -------------------------

@query("s3_sample_messages")  # S3
def _s3(lake):
    from orderlake.operators import ingest
    return ingest.sample_messages(ingest.parse_messages(lake.raw, carry=["key"]))


@query("s19_keyed_publish")  # S19
def _s19(lake):
    from orderlake.operators import ingest
    fields = ["event_id", "event_type", "order_id", "customer_id", "occurred_at", "ingested_at", "schema_version", "source_system"]
    pub = ingest.keyed_publish(ingest.first_copies(lake.bronze_rows, columns=[*fields, "payload"]))
    # The whole value, field by field (an absent key is null); a generator, so that each value is parsed once.
    schema = ", ".join(f"{c} string" for c in fields) + ", payload struct<" + ", ".join(f"{k}: string" for k in PAYLOAD_KEYS) + ">"
    read = pub.select("key", F.col("occurred_at").alias("at"), F.inline(F.array(F.from_json("value", schema))))
    return read.select("key", F.col("at").alias("occurred_at"), *[F.col(c).alias(f"json_{c}") for c in fields], *[F.col(f"payload.{k}").alias(f"json_p_{k}") for k in PAYLOAD_KEYS])


@query("v3_producer_check")  # V3
def _v3(lake):
    from orderlake.operators import ingest
    return ingest.producer_check(lake.parsed).select("kafka_offset", "event_id", "producer_valid", "producer_reason")


AS_OF_FAILED_MS = 996796800000  # 2001-08-03T00:00:00Z, the failed_at stamp of V4


@query("v4_dlq_envelope")  # V4
def _v4(lake):
    from orderlake.operators import ingest
    return ingest.dlq_envelope(lake.parsed, AS_OF_FAILED_MS).withColumn(
        "original_event", F.when(F.col("original_event") == "not json", F.col("original_event"))
        .otherwise(F.get_json_object("original_event", "$.customer_id")))


@query("v5_route")  # V5
def _v5(lake):
    from orderlake.operators import ingest
    return ingest.route(lake.parsed).select("kafka_offset", "event_id", "target_topic")


# --- operational metrics ------------------------------------------------------------

@query("m1_batch_metrics")  # M1
def _m1(lake):
    from orderlake.operators import monitoring
    return monitoring.batch_metrics(lake.raw)


@query("w4_running_totals")  # W4
def _w4(lake):
    from orderlake.operators import monitoring
    return monitoring.running_totals(monitoring.batch_metrics(lake.raw))


@query("m2_records_by_layer")  # M2
def _m2(lake):
    from orderlake.operators import monitoring
    kept = lake.keep("source_system", "event_type")
    return monitoring.records_by_layer(kept.typed, kept.silver_of("source_system", "event_type"))


@query("m3_dlq_by_reason")  # M3
def _m3(lake):
    from orderlake.operators import monitoring
    return monitoring.dlq_by_reason(lake.dlq)


@query("m7_pipeline_lag")  # M7
def _m7(lake):
    from orderlake.operators import monitoring
    return monitoring.pipeline_lag(lake.bronze_rows)


@query("m8_records_per_minute")  # M8
def _m8(lake):
    from orderlake.operators import monitoring
    return monitoring.records_per_minute(lake.bronze_rows, "bronze")


@query("m9_duplicate_rate")  # M9
def _m9(lake):
    from orderlake.operators import monitoring
    return monitoring.duplicate_rate(lake.keep("ingestion_date").tagged)


@query("m10_silver_count")  # M10
def _m10(lake):
    from orderlake.operators import monitoring
    return monitoring.silver_count_by_processing_date(lake.silver_of("processing_date"))


CONSUMED_BEFORE_MS = 946684800000  # 2000-01-01T00:00:00Z: the consumer of M11 has processed up to here


@query("m11_consumer_lag")  # M11
def _m11(lake):
    from orderlake.operators import monitoring
    return monitoring.consumer_lag(lake.raw, monitoring.committed_offsets(lake.raw, CONSUMED_BEFORE_MS))


# --- scans, merge and gate -------------------------------------------------------------

SCAN_DAY = "1998-06-15"


@query("s4_bronze_date_scan")  # S4 (partition pruning when Bronze is stored)
def _s4(lake):
    import datetime as dt
    from orderlake.operators import ingest, silver
    day = dt.date.fromisoformat(SCAN_DAY)
    days = [day - dt.timedelta(days=i) for i in range(3)]
    tagged = ingest.tag_duplicates_where(lake.keep("event_type", "ingestion_date").typed, F.col("ingestion_date").isin([str(d) for d in days]))
    return silver.read_bronze(tagged, dates=days).select("event_id", "event_type", "ingestion_date", "is_duplicate")


@query("s5_silver_date_scan")  # S5
def _s5(lake):
    from orderlake.operators import silver
    return silver.read_silver(lake.silver_of("event_id", "event_type", "event_date"), SCAN_DAY, through="1998-06-17").select("event_id", "event_type", "event_date")


@query("s6_processing_date_scan")  # S6
def _s6(lake):
    from orderlake.operators import silver
    return silver.by_processing_date(lake.silver_of("event_id", "processing_date", "event_date"), SCAN_DAY).select("event_id", "processing_date", "event_date")


RESTAMP_DAY = "2001-08-03"


@query("s10_merge")  # S10 (pure form), J3
def _s10(lake):
    from orderlake.sources import tables
    # A restatement: every event from 2000 on is re-delivered with a later processing date.
    stored = lake.stored(lake.silver_of("event_id", "event_date", "processing_date", "amount", "ingested_at"))
    source = stored.where(F.col("event_date") >= F.lit("2000-01-01").cast("date")) \
        .withColumn("processing_date", F.lit(RESTAMP_DAY).cast("date"))
    return tables.merge(stored, source, ["event_id"], order_cols=["ingested_at"]).select(
        "event_id", "event_date", "processing_date", "amount")


@query("k13_gate_by_date")  # K13
def _k13(lake):
    from orderlake.operators import quality
    kept = lake.keep(*CHECKED, "ingestion_date")
    return quality.gate_by_date(_suite(kept), quality.reconcile(kept.tagged, kept.silver_of("event_date")))


@query("j6_fulfillment_within_horizon")  # J6 (batch twin)
def _j6(lake):
    from orderlake.operators import gold
    return gold.fulfillment_within(lake.lifecycle, 72)


@query("g11_hourly_activity")  # G11 (batch twin, over the events table)
def _g11(lake):
    from orderlake.operators import gold
    out = gold.hourly_activity(lake.table("events"))
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm"))


@query("s10_upsert_roundtrip")  # S8, S10, S11, J3: written, merged with moved keys and an added column, read back
def _s10_roundtrip(lake):
    from orderlake.sources import tables
    path = lake.scratch("upsert")
    cols = ["event_id", "event_type", "event_date", "amount", "ingested_at"]
    payments = lake.silver_of(*cols).where(F.col("event_type").startswith("PAYMENT_"))
    tables.upsert(payments, path, ["event_id"], "event_type", order_cols=["ingested_at"])
    base = tables.read_table(lake.spark, path)
    source = base.where(F.col("event_date") >= F.lit("2000-01-01").cast("date")) \
        .withColumns({"event_type": F.lit("PAYMENT_RESTATED"), "note": F.lit("restated"), "ingested_at": F.col("ingested_at") + 1})
    tables.upsert(source.select(*cols, "note"), path, ["event_id"], "event_type", order_cols=["ingested_at"])
    return lake.spark.read.schema(tables.stored_schema(lake.spark, path)).parquet(path).select(*cols, "note")


@query("s10_upsert_indexed")  # S10, J3: all of Silver stored by the month of processing, every restated key found by the key index and moved
def _s10_indexed(lake):
    from orderlake.sources import tables
    path = lake.scratch("indexed")
    month = F.date_format("processing_date", "yyyy-MM").alias("month")
    rows = lake.silver_of("event_id", "event_date", "processing_date", "amount", "ingested_at").select("*", month)
    tables.upsert(rows, path, ["event_id"], "month", order_cols=["ingested_at"])
    stored = tables.read_table(lake.spark, path).where(F.col("event_date") >= F.lit("2000-01-01").cast("date"))
    source = stored.withColumns({"processing_date": F.lit(RESTAMP_DAY).cast("date"), "month": F.lit(RESTAMP_DAY[:7])})
    tables.upsert(source, path, ["event_id"], "month", order_cols=["ingested_at"])
    return tables.read_table(lake.spark, path).select("event_id", "event_date", "processing_date", "amount")


@query("k11_checksum_recon")  # K11, K12 by content: a Silver in which placed events were swapped for foreign ones of the same dates
def _k11c(lake):
    from orderlake.operators import reconciliation
    k = F.split_part("event_id", F.lit("-"), F.lit(2)).cast("long")
    swapped = F.when((F.col("event_type") == "ORDER_PLACED") & (k % 211 == 0), F.concat(F.lit("X-"), k.cast("string"))).otherwise(F.col("event_id"))
    stored = lake.stored(lake.silver_of("event_date", "event_id", "event_type"))
    silver = stored.select("event_date", swapped.alias("event_id"))
    return reconciliation.checksum_reconcile(stored.select("event_date", "event_id"), silver)


@query("x6_from_gold")  # X6, A1: written as Gold with customer bitmaps, read back and rolled up
def _x6g(lake):
    from orderlake.operators import rollup
    path = lake.scratch("gold")
    silver = lake.stored(lake.silver_of("event_type", *rollup.HOUR, "amount", "customer_id"))
    numbers = rollup.dense_numbers(silver, "customer_id")
    rollup.hourly_rollup(silver).write.parquet(f"{path}/hourly")
    rollup.hourly_customers(silver, numbers).write.parquet(f"{path}/customers")
    return rollup.roll_up(lake.spark.read.parquet(f"{path}/hourly"), lake.spark.read.parquet(f"{path}/customers"), ["event_date"])


@query("s21_payload_drift")  # S21: raw messages against the payload contract
def _s21(lake):
    from orderlake.operators import serving
    return serving.payload_drift(lake.raw)


@query("s18_commit_history")  # S18
def _s18(lake):
    from orderlake.sources import tables
    path = lake.scratch("commits")
    tables.replace_table(lake.payments, path)
    stored = tables.read_table(lake.spark, path)
    for types in (["PAYMENT_INITIATED", "PAYMENT_FAILED"], ["PAYMENT_FAILED"]):
        tables.replace_table(stored.where(F.col("event_type").isin(types)), path)
        stored = tables.read_table(lake.spark, path)
    return tables.history(lake.spark, path).select(
        "version", "operation", F.get_json_object("metrics", "$.rows").cast("long").alias("row_count"))
