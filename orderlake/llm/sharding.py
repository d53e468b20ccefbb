"""Sharding by vector bin packing over groups of equal texts.

Every group has a vector (bytes, tokens, rows).  The group is placed in the
shard where the dot product of its vector with the shard's residual capacity
is highest, largest groups first.

The placement itself runs over a bounded list: groups above 1/256 of a
shard's capacity in any dimension are listed one by one (at most 3 * 256 for
each shard), all other groups are hashed into 16,384 bundles whose vectors are
sums.  Only that list reaches the driver, whatever the input.  Equal texts
share a shard unless their group is larger than a whole shard's capacity; such
a group is cut by row into PARTS parts, which are placed like groups.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import checkpoint

BUNDLES = 16_384
HEAVY_SHARE = 256
SLOT_BUCKETS = 256
PARTS = 64
#: Weight of bytes, tokens and rows in the dot product: bytes first, the others decide between shards that are nearly even.
WEIGHTS = (1.0, 0.1, 0.1)


def place(vectors: np.ndarray, shards: int, capacity: np.ndarray) -> np.ndarray:
    """The shard of each vector: largest first, each where vector . residual is highest."""
    scale = np.where(capacity > 0, capacity, 1.0)
    v = vectors / scale
    residual = np.ones((shards, v.shape[1]))
    out = np.zeros(len(v), dtype=np.int64)
    for i in np.lexsort((np.arange(len(v)), -v.max(axis=1))) if len(v) else ():
        s = int(np.argmax(residual @ (v[i] * WEIGHTS)))
        out[i] = s
        residual[s] -= v[i]
    return out


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8
) -> DataFrame:
    """One row per input row: id, size, text_crc32, tokens, shard, slot (gapless from 0 in each shard).

    Size is the text's UTF-8 bytes plus ``overhead``.  Null texts count as
    empty, so they share the group of the empty text; null identifiers and
    repeated rows are rows like any other; an empty table gives no rows.  Only
    the two named columns are read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),  # fixed by the checkpoint
        F.col(id_col).alias("id"),
        (F.octet_length(text) + overhead).cast("long").alias("bytes"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.md5(F.encode(text, "UTF-8")).alias("grp"),
        F.octet_length(text).alias("len"),
    )
    rows = checkpoint(rows.withColumn("bundle", bundle_of(F.col("grp"))))
    dims = ["bytes", "tokens", "rows"]
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    capacity = np.array([float(total[d] or 0) / shards for d in dims])
    groups = rows.groupBy("grp", "len", "bundle").agg(*sums)
    above = lambda share: reduce(lambda a, b: a | b, [F.col(d) > F.lit(max(c, 1.0) * share) for d, c in zip(dims, capacity, strict=True)])
    light = ~above(1 / HEAVY_SHARE)
    # Bounded: fewer than 3 * HEAVY_SHARE * shards heavy groups, and BUNDLES sums.
    items = (
        groups.groupBy(F.when(~light, F.col("grp")).alias("grp"), F.when(~light, F.col("len")).alias("len"), F.when(light, F.col("bundle")).alias("bundle"))
        .agg(*[F.sum(d).alias(d) for d in dims])
        .withColumn("large", F.col("grp").isNotNull() & above(1.0))
        .collect()
    )
    # Fewer than 3 * shards groups are larger than a shard.
    large = F.broadcast(spark.createDataFrame([(r["grp"], r["len"], True) for r in items if r["large"]], "grp string, len int, large boolean"))
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int")
    rows = rows.join(large, ["grp", "len"], "left").withColumn("part", F.when(F.col("large"), part).otherwise(F.lit(0)))
    parts = rows.where("large").groupBy("grp", "len", "part").agg(*sums).collect() if any(r["large"] for r in items) else []
    keys = [(r["grp"], r["len"], r["bundle"], 0) for r in items if not r["large"]] + [(r["grp"], r["len"], None, r["part"]) for r in parts]
    vectors = [[float(r[d]) for d in dims] for r in [*(r for r in items if not r["large"]), *parts]]
    order = sorted(range(len(keys)), key=lambda i: (keys[i][0] or "", keys[i][1] or 0, -1 if keys[i][2] is None else keys[i][2], keys[i][3]))
    shard = place(np.array([vectors[i] for i in order]).reshape(-1, 3), shards, capacity)
    placed = [(*keys[i], int(s)) for i, s in zip(order, shard, strict=True)]
    whole = spark.createDataFrame([(b, s) for g, n, b, p, s in placed if g is None], "bundle int, light_shard int")
    where = spark.createDataFrame([(g, n, p, s) for g, n, b, p, s in placed if g is not None], "grp string, len int, part int, heavy_shard int")
    rows = rows.join(F.broadcast(where), ["grp", "len", "part"], "left").join(F.broadcast(whole), "bundle", "left")
    rows = rows.select("row", "id", "bytes", "tokens", "crc", F.coalesce("heavy_shard", "light_shard").alias("shard"))
    return with_slots(rows, shards).select(
        F.col("id").alias(id_col), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), "tokens", "shard", "slot"
    )


def bundle_of(group: Column) -> Column:
    return F.pmod(F.xxhash64(group), F.lit(BUNDLES)).cast("int")


def with_slots(rows: DataFrame, shards: int) -> DataFrame:
    """Gapless numbers in each shard: numbers within (shard, bucket) plus the bucket's offset.

    A shard's rows are spread over buckets by a hash of their number; the
    offsets are a table of shards * SLOT_BUCKETS rows at most.
    """
    rows = checkpoint(rows.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit("slot")), F.lit(SLOT_BUCKETS)).cast("int")))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("shard").orderBy("bucket")
    offsets = counts.select("shard", "bucket", (F.sum("n").over(order) - F.col("n")).alias("offset"))
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "row")) - 1
    return rows.withColumn("number", number).join(F.broadcast(offsets), ["shard", "bucket"]).withColumn("slot", (F.col("number") + F.col("offset")).cast("long"))
