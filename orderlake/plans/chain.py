"""The lakehouse layers as lazy DataFrames derived from the driver's tables.

``Lake(spark, sf_dir)`` rebuilds Raw → Bronze/DLQ → Silver → Gold as one
Spark plan per request; nothing is collected and nothing is cached across
queries, so each registered query scales with the tables it reads.  Rows that
a query reads more than once are stored first (``stored``): each branch of a
plan would encode and parse every message again.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, TimestampType

from orderlake.operators import gold, ingest, silver
from orderlake.session import checkpoint_dir, ensure_checkpoint_dir
from orderlake.sources import fixtures


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.read_table(self.spark, self.sf_dir, name)

    def scratch(self, kind: str) -> str:
        """A fresh name in the shared folder."""
        root = checkpoint_dir(self.spark) or ensure_checkpoint_dir(self.spark)  # the shared folder; set only if unset
        return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"

    def stored(self, rows: DataFrame) -> DataFrame:
        """``rows`` written to the shared folder and read back, for queries that read them more than once."""
        path = self.scratch("rows")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.raw_messages(self.table("orders"), self.table("customer"), self.table("nation"))

    @cached_property
    def parsed(self) -> DataFrame:
        return ingest.parse_messages(ingest.kafka_to_strings(self.raw))

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return ingest.bronze_split(self.raw, loaded_at_ms=0)

    @property
    def bronze(self) -> DataFrame:
        return self.split[0]

    @cached_property
    def bronze_rows(self) -> DataFrame:
        """Bronze rows without the duplicate tag, for metrics that never look at it
        (same rows as ``bronze``; skips the tagging join)."""
        valid, _ = ingest.validate(ingest.enrich(self.parsed, loaded_at_ms=0))
        return valid.drop("value", "malformed")

    @property
    def dlq(self) -> DataFrame:
        return self.split[1]

    @cached_property
    def typed(self) -> DataFrame:
        """Valid rows as Silver types them, every copy, with what orders the copies."""
        return silver.cast_and_extract(self.bronze_rows, carry=("kafka_partition", "kafka_offset"))

    def keep(self, *columns: str) -> Lake:
        """A lake whose typed rows have these columns and what orders the copies; each message is parsed once, the rows are stored."""
        kept = Lake(self.spark, self.sf_dir)
        names = dict.fromkeys([*columns, "event_id", "ingested_at", "kafka_partition", "kafka_offset"])
        kept.typed = kept.stored(self.typed.select(*names))
        return kept

    @property
    def tagged(self) -> DataFrame:
        """The typed rows with Bronze's duplicate tag."""
        return ingest.tag_duplicates(self.typed)

    def silver_of(self, *columns: str) -> DataFrame:
        """Silver with these columns: first copies straight from the typed rows, by one aggregate that holds no other column."""
        return ingest.first_copies(self.typed, columns=list(columns))

    @cached_property
    def silver(self) -> DataFrame:
        return self.silver_of(*silver.SILVER_COLUMNS, "processing_date")

    @cached_property
    def lifecycle(self) -> DataFrame:
        """Silver with the columns that fulfillment reads; stored, as placements and deliveries are read apart."""
        return self.stored(self.silver_of("event_type", "order_id", "customer_id", "city", "occurred_at", "event_date"))

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.hourly_orders(self.silver_of(
            "event_type", "event_date", "event_hour", "city", "category", "amount", "item_count", "customer_id", "discount_pct"))

    @cached_property
    def sla(self) -> DataFrame:
        return gold.daily_sla(self.lifecycle)

    @cached_property
    def payments(self) -> DataFrame:
        return gold.payment_health(self.silver_of("event_type", "event_date", "amount"))


def present(df: DataFrame, fuzzy: tuple[str, ...] = ()) -> DataFrame:
    """Comparison-friendly rendering: dates as text, timestamps as epoch millis.

    Doubles are left as computed (the operators make them order-independent);
    only ``fuzzy`` columns — averages of inexact doubles — are rounded to 6 places.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, TimestampType):
            cols.append(F.unix_millis(c).alias(f.name))
        elif isinstance(f.dataType, (DoubleType, FloatType)) and f.name in fuzzy:
            cols.append(F.round(c, 6).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
