"""Distinct customers that roll up (X1, X6, A1): sets of dense customer numbers, stored with Gold.

Distinct counts don't add up, sets do: a day is the union of its hours.  Each
customer gets a dense number once; a Gold row's customers are the positions
they have in buckets of 32,768 numbers, so a group is a few short lists however
many events it has.  A rolled-up bucket is a bitmap.  Hours are no bitmaps:
each would take 4 KB, and with many customers most have one bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.session import ensure_checkpoint_dir

HOUR = ["event_date", "event_hour", "city", "category"]


def dense_numbers(ids: DataFrame, id_col: str, known: DataFrame | None = None) -> DataFrame:
    """(id, number): numbers 0, 1, 2, ... without gaps, in no particular order; null ids have none.

    With ``known`` (an earlier result) its numbers stay and only new ids get
    further ones.  Sorting and counting are per partition; only one count per
    partition meets in one place.
    """
    ensure_checkpoint_dir(ids.sparkSession)
    new = ids.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    start = 0
    if known is not None:
        new = new.join(known.select("id"), "id", "left_anti")
        start = known.count()
    # The checkpoint fixes which partition and row an id has.
    placed = new.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("row", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    offset = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("part", part).join(sizes.select("part", offset.alias("offset")), "part")
    numbered = numbered.select("id", (F.col("offset") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) + start).cast("long").alias("number"))
    return numbered if known is None else known.select("id", "number").unionByName(numbered)


def hourly_rollup(silver: DataFrame) -> DataFrame:
    """Placed orders and exact revenue by hour, city and category, as they add up (money stays decimal)."""
    placed = silver.where(F.col("event_type") == "ORDER_PLACED")
    return placed.groupBy(*HOUR).agg(F.count(F.lit(1)).alias("order_count"), F.sum(F.col("amount").cast("decimal(38,6)")).alias("revenue"))


def hourly_customers(silver: DataFrame, numbers: DataFrame) -> DataFrame:
    """The customers of each hour, city and category: their positions in each bucket of customer numbers."""
    placed = silver.where(F.col("event_type") == "ORDER_PLACED").select(*HOUR, F.col("customer_id").alias("id"))
    # One row per customer and hour first, so a customer with many events is combined before the join.
    rows = placed.distinct().join(numbers, "id")
    return rows.groupBy(*HOUR, F.bitmap_bucket_number("number").alias("bucket")).agg(F.collect_list(F.bitmap_bit_position("number").cast("int")).alias("customers"))


def roll_up(hourly: DataFrame, customers: DataFrame, by: list[str]) -> DataFrame:
    """Orders, exact revenue, average and distinct customers by any of the hourly keys, from the two Gold tables alone."""
    money = hourly.groupBy(*by).agg(F.sum("order_count").alias("total_orders"), F.sum("revenue").alias("revenue"))
    # Dealt by bucket first, so that each bitmap is made once and no partial ones are shuffled.
    bits = customers.select(*by, "bucket", F.explode("customers").alias("bit")).repartition(*by, "bucket")
    merged = bits.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("customers"))
    people = merged.groupBy(*by).agg(F.sum(F.bitmap_count("customers")).alias("unique_customers")).toDF(*[f"_{b}" for b in by], "unique_customers")
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
    return money.join(people, same, "left").select(
        *by, "total_orders", F.col("revenue").cast("double").alias("total_revenue"), (F.col("revenue").cast("double") / F.col("total_orders")).alias("avg_order_value"),
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
    )
