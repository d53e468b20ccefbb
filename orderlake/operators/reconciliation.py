"""Reconciliation by content (K11, K12): order-free checksums of ids, and the ids behind those that differ.

Equal counts don't show one lost row beside one foreign one.  Each side is
summed up per (date, bucket of the id's hash) in one aggregate that combines
map-side; only ids in buckets whose sums differ are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256


def _bucket(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def id_checksums(rows: DataFrame, id_col: str, date_col: str, buckets: int = BUCKETS) -> DataFrame:
    """(date, bucket): number of ids, xor of their hashes and sum of the hashes' lower halves.  Null ids count in a bucket of their own."""
    h = F.xxhash64(id_col, F.lit(1))
    return rows.groupBy(F.col(date_col).cast("date").alias("date"), F.when(F.col(id_col).isNull(), -1).otherwise(_bucket(id_col, buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("s")
    )


def differing_buckets(source: DataFrame, target: DataFrame, id_col: str, source_date: str, target_date: str, buckets: int = BUCKETS) -> DataFrame:
    """(date, bucket) whose checksums differ, or that only one side has."""
    a, b = id_checksums(source, id_col, source_date, buckets), id_checksums(target, id_col, target_date, buckets).toDF("d", "b", "n2", "x2", "s2")
    both = a.join(b, F.col("date").eqNullSafe(F.col("d")) & (F.col("bucket") == F.col("b")), "full_outer")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("x").eqNullSafe(F.col("x2")) & F.col("s").eqNullSafe(F.col("s2"))
    return both.where(~same).select(F.coalesce("date", "d").alias("date"), F.coalesce("bucket", "b").alias("bucket"))


def checksum_reconcile(source: DataFrame, target: DataFrame, id_col: str = "event_id", source_date: str = "event_date", target_date: str = "event_date", buckets: int = BUCKETS) -> DataFrame:
    """(processing_date, event_id, status, copies): ids that ``target`` lacks (missing) or has beyond ``source`` (foreign), by date.

    An id that moved to another date is missing on one and foreign on the
    other.  Repeated ids count: ``copies`` is by how many the sides differ.
    Dates and ids may be null.  Only ids of differing buckets are shuffled.
    """
    differ = differing_buckets(source, target, id_col, source_date, target_date, buckets).toDF("_d", "_b")

    def suspects(rows: DataFrame, date_col: str, sign: int) -> DataFrame:
        bucket = F.when(F.col(id_col).isNull(), -1).otherwise(_bucket(id_col, buckets))
        narrow = rows.select(F.col(date_col).cast("date").alias("processing_date"), F.col(id_col).alias("event_id"), bucket.alias("bucket"))
        hit = F.col("processing_date").eqNullSafe(F.col("_d")) & (F.col("bucket") == F.col("_b"))
        return narrow.join(differ, hit, "left_semi").select("processing_date", "event_id", F.lit(sign).alias("side"))

    balance = suspects(source, source_date, 1).unionByName(suspects(target, target_date, -1)).groupBy("processing_date", "event_id").agg(F.sum("side").alias("left"))
    return balance.where("left <> 0").select(
        "processing_date", "event_id", F.when(F.col("left") > 0, "missing").otherwise("foreign").alias("status"), F.abs("left").alias("copies")
    )
