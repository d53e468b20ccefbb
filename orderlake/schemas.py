"""Named schemas and serving contracts."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, L, D, I, B = StringType(), LongType(), DoubleType(), IntegerType(), BooleanType()


def _schema(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


KAFKA_METADATA = _schema(
    ("key", S, True),
    ("value", S, True),
    ("topic", S, True),
    ("partition", S, True),
    ("offset", S, True),
    ("kafka_timestamp", L, True),
)

ORDER_EVENT = _schema(
    ("event_id", S, False),
    ("event_type", S, False),
    ("order_id", S, True),
    ("customer_id", S, True),
    ("occurred_at", L, True),
    ("ingested_at", L, True),
    ("schema_version", S, True),
    ("source_system", S, True),
    ("payload", MapType(S, S), True),
)

# Parsing schema: ORDER_EVENT plus a slot that receives unparsable text.
ORDER_EVENT_PARSE = StructType(
    [StructField(f.name, f.dataType, True) for f in ORDER_EVENT.fields]
    + [StructField("_corrupt_record", S, True)]
)

BRONZE = StructType(
    list(ORDER_EVENT.fields)
    + [
        StructField("kafka_partition", S, True),
        StructField("kafka_offset", S, True),
        StructField("pipeline_version", S, True),
        StructField("bronze_loaded_at", L, True),
        StructField("is_duplicate", S, True),
        StructField("ingestion_date", S, True),
    ]
)

DLQ = StructType(
    [f for f in BRONZE.fields if f.name != "is_duplicate"]
    + [StructField("value", S, True), StructField("validation_failure", S, True)]
)

SILVER_ORDERS = _schema(
    ("event_id", S, True),
    ("event_type", S, True),
    ("order_id", S, True),
    ("customer_id", S, True),
    ("occurred_at", L, True),
    ("ingested_at", L, True),
    ("schema_version", S, True),
    ("source_system", S, True),
    ("pipeline_version", S, True),
    ("ingestion_date", S, True),
    ("event_timestamp", TimestampType(), True),
    ("event_date", DateType(), True),
    ("event_hour", I, True),
    ("city", S, True),
    ("category", S, True),
    ("amount", D, True),
    ("item_count", I, True),
    ("discount_pct", D, True),
    ("device", S, True),
    ("pincode", S, True),
    ("silver_loaded_at", TimestampType(), True),
    ("processing_date", DateType(), True),
)

DIM_CUSTOMERS = _schema(
    ("customer_id", S, False),
    ("city", S, True),
    ("device", S, True),
    ("last_seen_at", TimestampType(), True),
    ("effective_from", DateType(), False),
    ("effective_to", DateType(), True),
    ("is_current", B, False),
    ("dim_version", I, False),
)

DQ_RESULTS = _schema(
    ("processing_date", DateType(), True),
    ("total_records", L, True),
    ("neg_amount_count", L, True),
    ("neg_amount_pct", D, True),
    ("unknown_city_count", L, True),
    ("unknown_city_pct", D, True),
    ("event_type_distribution", S, True),
    ("null_customer_id_count", L, True),
    ("dq_passed", B, True),
)

PAYMENT_EVENT = _schema(
    ("event_id", S, False),
    ("event_type", S, False),
    ("order_id", S, True),
    ("customer_id", S, True),
    ("amount", D, True),
    ("currency", S, True),
    ("occurred_at", L, True),
    ("ingested_at", L, True),
    ("schema_version", S, True),
    ("gateway", S, True),
    ("status", S, True),
)

PRODUCER_DLQ = _schema(
    ("original_event", S, True),
    ("failure_reason", S, True),
    ("source_topic", S, True),
    ("failed_at", L, True),
)

# ---------------------------------------------------------------------------
# Serving contracts: (schema, primary key, clustering columns).
# ---------------------------------------------------------------------------


class Contract:
    def __init__(self, name: str, schema: StructType, pk: list[str], cluster_by: list[str]):
        self.name, self.schema, self.pk, self.cluster_by = name, schema, pk, cluster_by

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


FACT_HOURLY_ORDERS = Contract(
    "fact_hourly_orders",
    _schema(
        ("event_date", DateType(), False),
        ("event_hour", I, False),
        ("city", S, False),
        ("category", S, False),
        ("order_count", L, True),
        ("gross_revenue", D, True),
        ("avg_order_value", D, True),
        ("total_items", L, True),
        ("unique_customers", L, True),
        ("avg_discount_pct", D, True),
        ("processing_date", DateType(), True),
        ("gold_loaded_at", TimestampType(), True),
    ),
    ["event_date", "event_hour", "city", "category"],
    ["event_date", "city"],
)

FACT_DAILY_SLA = Contract(
    "fact_daily_sla",
    _schema(
        ("event_date", DateType(), False),
        ("city", S, False),
        ("delivery_status", S, False),
        ("order_count", L, True),
        ("avg_delivery_hours", D, True),
        ("processing_date", DateType(), True),
        ("gold_loaded_at", TimestampType(), True),
    ),
    ["event_date", "city", "delivery_status"],
    ["event_date"],
)

FACT_PAYMENT_HEALTH = Contract(
    "fact_payment_health",
    _schema(
        ("event_date", DateType(), False),
        ("event_type", S, False),
        ("event_count", L, True),
        ("total_amount", D, True),
        ("avg_amount", D, True),
        ("processing_date", DateType(), True),
        ("gold_loaded_at", TimestampType(), True),
    ),
    ["event_date", "event_type"],
    ["event_date"],
)

RECONCILIATION_RESULTS = Contract(
    "reconciliation_results",
    _schema(
        ("processing_date", DateType(), False),
        ("bronze_count", L, True),
        ("silver_count", L, True),
        ("variance_pct", D, True),
        ("tolerance_pct", D, True),
        ("status", S, True),
        ("checked_at", TimestampType(), True),
    ),
    ["processing_date"],
    [],
)

CONTRACTS = {c.name: c for c in (FACT_HOURLY_ORDERS, FACT_DAILY_SLA, FACT_PAYMENT_HEALTH, RECONCILIATION_RESULTS)}

NAMED_SCHEMAS = {
    "kafka_metadata": KAFKA_METADATA,
    "order_event": ORDER_EVENT,
    "bronze": BRONZE,
    "dlq": DLQ,
    "silver_orders": SILVER_ORDERS,
    "dim_customers": DIM_CUSTOMERS,
    "dq_results": DQ_RESULTS,
    "payment_event": PAYMENT_EVENT,
    "producer_dlq": PRODUCER_DLQ,
}
