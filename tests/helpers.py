"""Builders of small typed inputs for golden tests (mirroring the platform's own fixtures)."""

from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from orderlake.schemas import ORDER_EVENT

T0 = 1704067200000  # 2024-01-01T00:00:00Z


def event(event_id="evt-001", event_type="ORDER_PLACED", order_id="ORD-001", customer_id="CUST-001",
          occurred_at=T0, ingested_at=T0, schema_version="1.0", payload=None, partition="0", offset="0"):
    return dict(event_id=event_id, event_type=event_type, order_id=order_id, customer_id=customer_id,
                occurred_at=occurred_at, ingested_at=ingested_at, schema_version=schema_version,
                source_system="order-service", payload=payload or {}, kafka_partition=partition,
                kafka_offset=offset)


def parsed_frame(spark, rows):
    schema = StructType(list(ORDER_EVENT.fields) + [StructField("kafka_partition", StringType()),
                                                   StructField("kafka_offset", StringType())])
    return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in rows], schema)


def bronze_frame(spark, rows):
    from orderlake.operators import ingest
    return ingest.tag_duplicates(ingest.enrich(parsed_frame(spark, rows), 0))


def silver_rows(spark, rows):
    """Typed Silver rows from dict events via the real typing projection."""
    from orderlake.operators import silver
    return silver.cast_and_extract(bronze_frame(spark, rows).where(F.col("is_duplicate") == "false"))
