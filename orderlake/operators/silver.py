"""Bronze → Silver typing (P5-P12) and date-pruned scans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake import config as C
from orderlake.functions.columns import (
    lateness_seconds,
    millis_to_date,
    millis_to_hour,
    millis_to_timestamp,
    payload_double,
    payload_int,
    payload_str,
)

_DROPPED = ("payload", "is_duplicate", "bronze_loaded_at", "kafka_partition", "kafka_offset")

# Silver column order (SILVER_ORDERS without the two load-time columns).
SILVER_COLUMNS = [
    "event_id", "event_type", "order_id", "customer_id", "occurred_at", "ingested_at",
    "schema_version", "source_system", "pipeline_version", "ingestion_date",
    "event_timestamp", "event_date", "event_hour", "city", "category", "amount",
    "item_count", "discount_pct", "device", "pincode",
]


def _as_date(d: str | dt.date | None):
    if d is None:
        return None
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def cast_and_extract(bronze: DataFrame, processing_date: str | dt.date | None = None,
                     stamp_load_time: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """The whole typing projection as one ``select``.

    Millis become timestamp/date/hour (P5); payload keys become typed columns
    with defaults (P6-P8) using lenient casts, so bad text gives the default
    instead of failing the job under ANSI mode (SURVEY Q7); consumed raw
    columns are dropped (P9).  ``processing_date`` is lineage (P10); the
    wall-clock ``silver_loaded_at`` is added only when ``stamp_load_time``.
    ``carry`` names dropped columns that stay.
    """
    keep = [c for c in bronze.columns if c not in _DROPPED and c in SILVER_COLUMNS]
    cols = [F.col(c) for c in keep] + [
        millis_to_timestamp("occurred_at").alias("event_timestamp"),
        millis_to_date("occurred_at").alias("event_date"),
        millis_to_hour("occurred_at").alias("event_hour"),
        payload_str("city").alias("city"),
        payload_str("category").alias("category"),
        payload_double("amount").alias("amount"),
        payload_int("item_count").alias("item_count"),
        payload_double("discount_pct").alias("discount_pct"),
        payload_str("device").alias("device"),
        payload_str("pincode", default=None).alias("pincode"),
    ]
    out = bronze.select(*cols, *carry).select(*SILVER_COLUMNS, *carry)
    if stamp_load_time:
        out = out.withColumn("silver_loaded_at", F.current_timestamp())
    pd_ = _as_date(processing_date)
    out = out.withColumn("processing_date", F.lit(pd_).cast("date") if pd_ else F.col("event_date"))
    return out


def read_bronze(bronze: DataFrame, processing_date=None, dates=None) -> DataFrame:
    """Bronze for one or more partition dates, first copies only.

    The equality on ``ingestion_date`` (the partition column) becomes a
    partition filter, so only those directories are listed and read.
    """
    df = bronze
    if processing_date is not None:
        df = df.where(F.col("ingestion_date") == str(_as_date(processing_date)))
    elif dates is not None:
        df = df.where(F.col("ingestion_date").isin([str(_as_date(d)) for d in dates]))
    return df.where(F.col("is_duplicate") == "false")


def read_silver(silver: DataFrame, processing_date=None, through=None) -> DataFrame:
    """Silver by ``event_date`` (partition column); ``through`` widens to a date range."""
    if processing_date is None:
        return silver
    d = _as_date(processing_date)
    if through is None:
        return silver.where(F.col("event_date") == F.lit(d))
    return silver.where(F.col("event_date").between(F.lit(d), F.lit(_as_date(through))))


def by_processing_date(df: DataFrame, processing_date) -> DataFrame:
    """Filter on ``processing_date`` (a data column; pushed to Parquet row groups)."""
    return df.where(F.col("processing_date") == F.lit(_as_date(processing_date)))


def late_events(df: DataFrame, tolerance_seconds: int = C.LATE_TOLERANCE_SECONDS) -> DataFrame:
    """Events that arrived later than the watermark tolerance, with their lateness."""
    return df.select("*", lateness_seconds().alias("lateness_seconds")).where(
        F.col("lateness_seconds") > F.lit(tolerance_seconds)
    )
