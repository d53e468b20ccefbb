"""Serving layer: views X1-X6, top-k reports T1-T5, contracts S20 and drift S21."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake import config as C
from orderlake.functions.columns import money_avg, money_sum
from orderlake.schemas import Contract


def _pct(num, den) -> F.Column:
    return F.round(F.lit(100.0) * num / F.nullif(den, F.lit(0)), 2)


def daily_revenue(hourly: DataFrame) -> DataFrame:
    """Daily revenue view, kept as published: average of hourly averages and
    sum of hourly distinct counts (SURVEY Q13; ``exact_daily_revenue`` is the fix)."""
    return (
        hourly.groupBy("event_date")
        .agg(
            F.sum("order_count").alias("total_orders"),
            money_sum("gross_revenue").alias("total_revenue"),
            F.avg("avg_order_value").alias("avg_order_value"),
            F.sum("unique_customers").alias("unique_customers"),
        )
        .orderBy(F.col("event_date").desc())
    )


def city_leaderboard(hourly: DataFrame) -> DataFrame:
    """Per-date city totals with RANK by revenue (window over an aggregate)."""
    w = Window.partitionBy("event_date").orderBy(F.col("total_revenue").desc())
    return (
        hourly.groupBy("event_date", "city")
        .agg(F.sum("order_count").alias("total_orders"), money_sum("gross_revenue").alias("total_revenue"))
        .withColumn("revenue_rank", F.rank().over(w))
    )


def sla_compliance(sla: DataFrame) -> DataFrame:
    """On-time share of all orders (PENDING stays in the denominator)."""
    on_time = F.sum(F.when(F.col("delivery_status") == "ON_TIME", F.col("order_count")).otherwise(F.lit(0)))
    total = F.sum("order_count")
    return (
        sla.groupBy("event_date", "city")
        .agg(on_time.alias("on_time_orders"), total.alias("total_orders"), _pct(on_time, total).alias("sla_compliance_pct"))
        .orderBy(F.col("event_date").desc(), F.col("sla_compliance_pct").asc())
    )


def payment_failure_rate(payments: DataFrame) -> DataFrame:
    """Failed share of all payment events (INITIATED stays in the denominator)."""
    def of(t):
        return F.sum(F.when(F.col("event_type") == t, F.col("event_count")).otherwise(F.lit(0)))
    total = F.sum("event_count")
    return (
        payments.groupBy("event_date")
        .agg(
            of("PAYMENT_SUCCESS").alias("successful_payments"),
            of("PAYMENT_FAILED").alias("failed_payments"),
            _pct(of("PAYMENT_FAILED"), total).alias("failure_rate_pct"),
        )
        .orderBy(F.col("event_date").desc())
    )


def today_hourly(hourly: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The hours of one day (``as_of`` replaces CURRENT_DATE for testability)."""
    day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return (
        hourly.where(F.col("event_date") == F.lit(day))
        .select("event_hour", "city", "category", "order_count", "gross_revenue", "avg_order_value")
        .orderBy(F.col("event_hour").desc(), F.col("gross_revenue").desc())
    )


def exact_daily_revenue(silver: DataFrame) -> DataFrame:
    """X1 computed from Silver: true weighted average and true distinct customers."""
    return (
        silver.where(F.col("event_type") == "ORDER_PLACED")
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money_sum("amount").alias("total_revenue"),
            money_avg("amount").alias("avg_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


# --- top-k reports (TakeOrderedAndProject; full-key tie-break for determinism) ---

def top_hours_by_revenue(hourly: DataFrame, n: int = C.TOP_HOURS) -> DataFrame:
    """T1."""
    return (
        hourly.orderBy(F.col("gross_revenue").desc(), "event_date", "event_hour", "city", "category")
        .select("event_date", "event_hour", "city", "category", "order_count", "gross_revenue", "avg_order_value")
        .limit(n)
    )


def sla_report(sla: DataFrame, n: int = C.SLA_REPORT_ROWS) -> DataFrame:
    """T2."""
    return sla.orderBy("city", "delivery_status", "event_date").limit(n)


def payment_report(payments: DataFrame, n: int = C.PAYMENT_REPORT_ROWS) -> DataFrame:
    """T3."""
    return payments.orderBy("event_type", "event_date").limit(n)


# --- contracts ----------------------------------------------------------------

def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Project and cast to the contract's column order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields])


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row of counts — rows, NOT NULL violations per column, duplicate primary keys.

    Null counts come from one aggregate; duplicate keys from a second
    aggregate on the key (partial aggregation keeps its shuffle small).
    """
    nulls = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in contract.not_null],
    )
    dups = (
        df.groupBy(*contract.pk).count().where(F.col("count") > 1)
        .agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("count"), F.lit(0)).alias("duplicate_rows"))
    )
    return _one_row_concat(nulls, dups)


def _one_row_concat(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side-by-side concatenation of two one-row aggregates via a constant key."""
    return a.withColumn("_k", F.lit(0)).join(b.withColumn("_k", F.lit(0)), "_k").drop("_k")


def serving_layout(df: DataFrame, contract: Contract, num_partitions: int | None = None) -> DataFrame:
    """S20 clustering: co-locate by the clustering keys and sort within files."""
    keys = contract.cluster_by or contract.pk
    out = df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)
    return out.sortWithinPartitions(*contract.pk)


def schema_drift(actual: StructType, expected: StructType, spark) -> DataFrame:
    """Columns missing, extra or with a changed type versus a named contract.

    The inputs are schemas (metadata), so the result is at most one row per column.
    """
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for name in expected.fieldNames():
        if name not in act:
            rows.append((name, "missing", exp[name], None))
        elif act[name] != exp[name]:
            rows.append((name, "type_changed", exp[name], act[name]))
    for name in actual.fieldNames():
        if name not in exp:
            rows.append((name, "extra", None, act[name]))
    return spark.createDataFrame(rows, "column string, issue string, expected string, actual string")


def enum_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values of ``column`` outside an enum, with their counts (NULL is not flagged)."""
    return df.where(~F.col(column).isin(allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


#: Payload keys of the contract and the type that each value's text must have.
PAYLOAD_CONTRACT = {
    "city": "string", "category": "string", "amount": "double", "item_count": "int", "discount_pct": "double",
    "device": "string", "pincode": "string", "gateway": "string",
}


def payload_drift(messages: DataFrame, contract: dict[str, str] | None = None) -> DataFrame:
    """S21 over the data: how far the payloads of each event type depart from the contract.

    One row per event type and key that the contract names or any payload has:
    in_contract, messages of the type, those with the key, those without,
    those whose value doesn't read as the contract's type, and the JSON types
    met.  Messages are read as VARIANT, so keys need not be known.  What is
    not JSON or has no payload object takes no part; a null or missing event
    type is a type of its own.
    """
    contract = PAYLOAD_CONTRACT if contract is None else contract
    # Generators keep filters above them, so each message is parsed once.
    parsed = messages.select(F.explode(F.array(F.try_parse_json(F.col("value").cast("string")))).alias("v"))
    parsed = parsed.select(F.inline(F.array(F.struct(
        F.try_variant_get("v", "$.event_type", "string").alias("event_type"), F.try_variant_get("v", "$.payload", "map<string,variant>").alias("payload"),
    )))).where("payload IS NOT NULL")
    # Beside its keys, each message has an entry without a key; these count the messages.
    message = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))
    keys = parsed.select("event_type", F.inline(F.concat(F.array(message), F.map_entries("payload"))))
    text = F.try_variant_get("value", "$", "string")
    failed = F.lit(False)
    for key, kind in contract.items():
        if kind != "string":
            failed = F.when(F.col("key") == key, text.try_cast(kind).isNull()).otherwise(failed)
    met = keys.groupBy("event_type", "key").agg(
        F.count(F.lit(1)).alias("present"), F.count_if(failed).alias("failed_casts"), F.expr("schema_of_variant_agg(value)").alias("json_type")
    )
    # From here on there is a row per event type and key.
    met = met.withColumn("messages", F.max(F.when(F.col("key").isNull(), F.col("present"))).over(Window.partitionBy("event_type")))
    names = F.array(*[F.lit(k) for k in contract]) if contract else F.array().cast("array<string>")
    expected = F.transform(names, lambda k: F.struct(k.alias("key"), F.lit(0).cast("long").alias("present"), F.lit(0).cast("long").alias("failed_casts"), F.lit("").alias("json_type")))
    own = F.array(F.struct("key", "present", "failed_casts", F.coalesce("json_type", F.lit("")).alias("json_type")))
    rows = met.select("event_type", "messages", F.inline(F.when(F.col("key").isNull(), expected).otherwise(own)))
    found = rows.groupBy("event_type", F.col("key").alias("payload_key")).agg(
        F.max("messages").alias("messages"), F.max("present").alias("present"), F.max("failed_casts").alias("failed_casts"), F.max("json_type").alias("json_type")
    )
    return found.select(
        "event_type", "payload_key", F.col("payload_key").isin(list(contract)).alias("in_contract"), "messages",
        "present", (F.col("messages") - F.col("present")).alias("missing"), "failed_casts", "json_type",
    )
