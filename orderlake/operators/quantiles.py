"""Exact quantiles of groups of any size by selection (M5).

``percentile`` keeps all values of a group in one buffer.  Here a histogram
pass counts values per bin, the bin that holds the wanted rank becomes the
next range, and only when a range has few distinct values left are these
counted one by one.  No step holds more than ``bins`` rows of a group, or
``small`` values of a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.session import ensure_checkpoint_dir

BINS, SMALL, ROUNDS = 4096, 100_000, 40


def _same(keys: list[str], left: str, right: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def weighted(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each distinct value of a group once (``v``) with its number of rows (``c``); nulls are left out."""
    return rows.select(*keys, F.col(value).cast("double").alias("v")).where("v IS NOT NULL").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], bins: int = BINS, small: int = SMALL) -> DataFrame:
    """One row per group with a column per quantile, interpolated between neighbours; null values don't count, NaN ranks above all numbers.

    A group without values has no row.  The distinct values with their numbers of rows
    and, after each round, the handful of ranges are checkpointed.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    # Stored once: the rows may come from a long plan, and each round reads them again.
    v = weighted(rows, keys, value).checkpoint()
    ranks = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(end).alias("end"), (F.floor if end == "low" else F.ceil)(F.lit(q) * (F.col("n") - 1)).alias("rank"), F.lit(q).alias("q"))
        for name, q in quantiles.items() for end in ("low", "high")
    ])
    first = v.groupBy(*keys).agg(F.sum("c").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = first.select(*keys, F.col("n").alias("size"), "lo", "hi", "n", F.inline(ranks)).checkpoint()
    spans = [*keys, "lo", "hi"]
    for _ in range(ROUNDS):
        if wanted.where(F.col("lo").eqNullSafe(F.col("hi")) | (F.col("n") <= small)).count() == wanted.count():
            break
        ranges = wanted.where(~F.col("lo").eqNullSafe(F.col("hi"))).select(*spans).distinct()
        inside = v.alias("v").join(ranges.alias("r"), _same(keys, "v", "r") & (F.col("v.v") >= F.col("r.lo")) & (F.col("v.v") <= F.col("r.hi"))).select("r.*", "v.v", "v.c")
        # Halves first: the difference of two large numbers may not be finite.
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        place = F.when(F.isnan(share) | F.isnan("v"), bins).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1))).cast("int")
        histogram = inside.groupBy(*spans, place.alias("bin")).agg(F.sum("c").alias("count"), F.min("v").alias("blo"), F.max("v").alias("bhi"))
        before = F.coalesce(F.sum("count").over(Window.partitionBy(*spans).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        histogram = histogram.withColumn("before", before)
        hit = _same(spans, "w", "h") & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("count"))
        finer = wanted.alias("w").where(~F.col("lo").eqNullSafe(F.col("hi"))).join(histogram.alias("h"), hit).select(
            *[F.col(f"w.{k}").alias(k) for k in keys], "size", F.col("blo").alias("lo"), F.col("bhi").alias("hi"), F.col("count").alias("n"), "name", "end",
            (F.col("rank") - F.col("before")).alias("rank"), "q",
        )
        wanted = finer.unionByName(wanted.where(F.col("lo").eqNullSafe(F.col("hi")))).checkpoint()
    # The values of the last ranges, counted one by one.
    open_ = wanted.where(~F.col("lo").eqNullSafe(F.col("hi")))
    ranges = open_.select(*spans).distinct()
    inside = v.alias("v").join(ranges.alias("r"), _same(keys, "v", "r") & (F.col("v.v") >= F.col("r.lo")) & (F.col("v.v") <= F.col("r.hi"))).select("r.*", "v.v", "v.c")
    counted = inside.groupBy(*spans, "v").agg(F.sum("c").alias("count"))
    before = F.coalesce(F.sum("count").over(Window.partitionBy(*spans).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.withColumn("before", before)
    hit = _same(spans, "w", "h") & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("count"))
    columns = [*[F.col(f"w.{k}").alias(k) for k in keys], "size", "name", "end", "q"]
    found = open_.alias("w").join(counted.alias("h"), hit).select(*columns, F.col("h.v").alias("at")).unionByName(
        wanted.alias("w").where(F.col("lo").eqNullSafe(F.col("hi"))).select(*columns, F.col("lo").alias("at"))
    )
    pick = lambda name, end: F.max(F.when((F.col("name") == name) & (F.col("end") == end), F.col("at")))
    out = []
    for name, q in quantiles.items():
        low, high = pick(name, "low"), pick(name, "high")
        exact = F.lit(q) * (F.max("size") - 1)
        out.append((low + (high - low) * (exact - F.floor(exact))).alias(name))
    return found.groupBy(*keys).agg(*out)
