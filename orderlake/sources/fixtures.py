"""Adapter from the driver's TPC-H-like tables to order events.

Every order becomes a deterministic event lifecycle (placed, payment
initiated, payment outcome, delivered) with faults chosen by arithmetic on
the order key, so that the same rows can be rebuilt in plain SQL.  The
result is an ordinary Spark plan over ``orders ⋈ customer ⋈ nation``: it
grows with the tables and is partitioned like them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.config import GATEWAYS, MS_PER_HOUR, ORDERS_TOPIC, SOURCE_SYSTEM
from orderlake.functions.columns import ntz_to_millis

# --- fixed fault rules of the fixture (FIXTURES.md, B1) -------------------
DUPLICATE_MOD = 50  # step 0 sent twice, second copy ingested 10 s later
MISSING_ORDER_MOD = 67  # step 0 without order_id
BAD_TYPE_MOD = 53  # step 1 is PAYMENT_PENDING, a type the validator rejects
SCHEMA_V2_MOD = 71  # schema_version 2.0 and an extra payload key
BAD_AMOUNT_MOD = 97  # payload amount "abc"
NO_CITY_MOD = 31  # payload without city
LATE_MOD = 59  # ingested three hours after occurring
MALFORMED_MOD = 101  # step 1 message is not JSON
FRACTIONAL_ITEMS_MOD = 43  # item_count text with ".7" appended
EARLY_DELIVERY_MOD = 89  # delivered two hours before it was placed
MICROS_MOD = 103  # step 1 with an event time in microseconds
NANOS_MOD = 107  # step 1 with an event time in nanoseconds
ODD_AMOUNTS = {109: "NaN", 113: "Infinity", 127: "1e300"}  # amount text by key modulus
MILLS_MOD = 61  # amount with a third decimal, 5
KAFKA_PARTITIONS = 8
NATIONS = 25
DUPLICATE_DELAY_MS = 10_000
LATE_DELAY_MS = 3 * MS_PER_HOUR
# --- end of fixed fault rules ---------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# (step, copy) pairs; copy 1 exists only for duplicated orders, step 3 only for delivered ones.
_STEPS = [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lifecycles(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per order with the attributes its events carry.

    The customer's city moves with the order year, so the customer
    dimension has real history: city = nation ``(c_nationkey + year) % 25``.
    """
    # Each order fans out into events with JSON encoding and parsing, so the narrow order rows are dealt by key just before.
    # The number is given: by their few bytes, adaptive execution would put them together into tasks that grow to gigabytes.
    # The joins come first: with customers too many to broadcast, the join's own shuffle would undo the dealing.
    spark = orders.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    o = orders.select(
        F.col("o_orderkey").alias("k"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        ntz_to_millis("o_orderdate").alias("base_ms"),
        F.year("o_orderdate").alias("order_year"),
    )
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", F.col("n_name").alias("city_name"))
    joined = o.join(c, o.o_custkey == c.c_custkey).withColumn(
        "city_key", F.pmod(F.col("c_nationkey") + F.col("order_year"), F.lit(NATIONS)).cast("int")
    )
    return joined.join(n, joined.city_key == n.n_nationkey).drop("c_custkey", "n_nationkey", "city_key").repartition(tasks, "k")


def _amount_text(price: Column) -> Column:
    cents = F.round(price * F.lit(100)).cast("long")
    return F.concat(
        F.floor(cents / 100).cast("long").cast("string"),
        F.lit("."),
        F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"),
    )


def order_events(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Typed order events (ORDER_EVENT columns) with Kafka partition and offset.

    Columns: ORDER_EVENT fields, ``kafka_partition``, ``kafka_offset`` and
    ``malformed`` (the message for this event is not valid JSON).  The payload
    is a struct; its null fields are keys that the event doesn't have.
    """
    life = order_lifecycles(orders, customer, nation)
    steps = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(c).alias("copy")) for s, c in _STEPS])
    k = F.col("k")
    ev = life.select("*", F.inline(steps)).where(
        ((F.col("copy") == 0) | (k % DUPLICATE_MOD == 0))
        & ((F.col("step") < 3) | (F.col("o_orderstatus") == "F"))
    )
    step = F.col("step")
    placed_ms = F.col("base_ms") + (k % 24) * F.lit(MS_PER_HOUR)
    occurred = placed_ms + (
        F.when(step == 0, F.lit(0))
        .when(step == 1, F.lit(60_000))
        .when(step == 2, F.lit(120_000))
        .when(k % EARLY_DELIVERY_MOD == 0, F.lit(-2 * MS_PER_HOUR))
        .otherwise(((k * 7) % 96) * F.lit(MS_PER_HOUR))
    ).cast("long")
    ingested = (
        occurred
        + F.col("copy") * F.lit(DUPLICATE_DELAY_MS)
        + F.when(k % LATE_MOD == 0, F.lit(LATE_DELAY_MS)).otherwise(F.lit(0))
    ).cast("long")
    unit = F.when((step == 1) & (k % MICROS_MOD == 0), 1000).when((step == 1) & (k % NANOS_MOD == 0), 1_000_000).otherwise(1)
    amount = F.when(k % BAD_AMOUNT_MOD == 0, F.lit("abc"))
    for mod, text in ODD_AMOUNTS.items():
        amount = amount.when(k % mod == 0, F.lit(text))
    amount = amount.when(k % MILLS_MOD == 0, F.concat(_amount_text(F.col("o_totalprice")), F.lit("5"))).otherwise(_amount_text(F.col("o_totalprice")))
    event_type = (
        F.when(step == 0, F.lit("ORDER_PLACED"))
        .when(step == 1, F.when(k % BAD_TYPE_MOD == 0, "PAYMENT_PENDING").otherwise("PAYMENT_INITIATED"))
        .when(step == 2, F.when(F.col("o_orderstatus") == "P", "PAYMENT_FAILED").otherwise("PAYMENT_SUCCESS"))
        .otherwise(F.lit("ORDER_DELIVERED"))
    )
    is_v2 = k % SCHEMA_V2_MOD == 0
    gateways = F.array(*[F.lit(g) for g in GATEWAYS])
    item_text = F.concat(
        ((k % 5) + 1).cast("string"), F.when(k % FRACTIONAL_ITEMS_MOD == 0, F.lit(".7")).otherwise(F.lit(""))
    )
    payload = F.struct(
        F.when(k % NO_CITY_MOD != 0, F.col("city_name")).alias("city"),
        F.col("o_orderpriority").alias("category"),
        amount.alias("amount"),
        item_text.alias("item_count"),
        ((k % 5) * 5).cast("string").alias("discount_pct"),
        F.col("c_mktsegment").alias("device"),
        (F.lit(400000) + k % 100000).cast("string").alias("pincode"),
        F.when(step.isin(1, 2), F.element_at(gateways, (k % 4 + 1).cast("int"))).alias("gateway"),
        F.when(is_v2, (k % 1000).cast("string")).alias("loyalty_points"),
    )
    return ev.select(
        F.concat(F.lit("E-"), k.cast("string"), F.lit("-"), step.cast("string")).alias("event_id"),
        event_type.alias("event_type"),
        F.when(~((step == 0) & (k % MISSING_ORDER_MOD == 0)), F.concat(F.lit("ORD-"), k.cast("string"))).alias("order_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        (occurred * unit).alias("occurred_at"),
        ingested.alias("ingested_at"),
        F.when(is_v2, F.lit("2.0")).otherwise(F.lit("1.0")).alias("schema_version"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        payload.alias("payload"),
        (k % KAFKA_PARTITIONS).cast("string").alias("kafka_partition"),
        (k * 8 + step * 2 + F.col("copy")).cast("string").alias("kafka_offset"),
        ((step == 1) & (k % MALFORMED_MOD == 0)).alias("malformed"),
    )


def raw_messages(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Kafka-shaped rows (KAFKA_METADATA): key, JSON value, topic, partition, offset, timestamp."""
    ev = order_events(orders, customer, nation)
    body = F.to_json(
        F.struct(
            "event_id", "event_type", "order_id", "customer_id", "occurred_at",
            "ingested_at", "schema_version", "source_system", "payload",
        )
    )
    return ev.select(
        F.coalesce("order_id", "event_id").alias("key"),
        F.when(F.col("malformed"), F.lit("not json")).otherwise(body).alias("value"),
        F.lit(ORDERS_TOPIC).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingested_at").alias("kafka_timestamp"),
    )


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, sf_dir, n) for n in names]
