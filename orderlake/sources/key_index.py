"""Key index of an upserted table (S10): which partition values may hold a key.

Beside the table's partitions, ``<table>/_keys/run=N/bucket=B`` holds one row
(hash of the key, partition value) per key written.  An upsert looks its own
keys up there and opens the partitions it finds; neither the other partitions'
data nor their footers are read.

The index may name too many partitions but never too few, so it needs no
transaction with the table:

* entries are added *before* the rows they belong to are published, and a run
  that stops in between leaves entries of rows that aren't there;
* an entry of a key that has since moved, and a key that shares another's
  64-bit hash, only name a partition that is rewritten without need;
* writers that replace partitions without keys remove the index
  (:func:`drop_index`); the next upsert builds it from the table.

``REBUILD_RUNS`` additions after it was built, the index is built anew, which
drops the entries of moved keys and the small files.  ``_keys/_READY`` names
the run from which entries count, and the columns that they are hashes of; a
build that stops leaves the old ones.  Keys are hashed as the table's types.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 32
REBUILD_RUNS = 32

SCHEMA = "h long, value string, run long, bucket int"


def _root(path: str) -> str:
    return f"{path.rstrip('/')}/_keys"


def _as(rows: DataFrame, key: str, stored: StructType) -> Column:
    same = rows.schema[key].dataType == stored[key].dataType
    return F.col(key) if same else F.col(key).try_cast(stored[key].dataType)


def same_types(rows: DataFrame, stored: StructType, keys: list[str]) -> bool:
    return all(rows.schema[k].dataType == stored[k].dataType for k in keys)


def entries(rows: DataFrame, stored: StructType, keys: list[str], partition_col: str) -> DataFrame:
    """(h, value, bucket) of each row; the bucket is decided by the hash alone."""
    h = F.xxhash64(*[_as(rows, k, stored) for k in keys])
    return rows.select(h.alias("h"), F.col(partition_col).cast("string").alias("value"), F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"))


def drop_index(spark: SparkSession, path: str) -> None:
    """Forget the index: rows were written that it doesn't know."""
    from orderlake.sources import tables

    tables.delete_path(spark, f"{_root(path)}/_READY")


def _runs(spark: SparkSession, path: str) -> list[int]:
    from orderlake.sources import tables

    return sorted(int(d.removeprefix("run=")) for d in tables.list_dirs(spark, _root(path)) if d.startswith("run="))


def _append(rows: DataFrame, path: str, run: int) -> None:
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "h").write.partitionBy("bucket").parquet(f"{_root(path)}/run={run}")


def build(target: DataFrame, path: str, keys: list[str], partition_col: str) -> None:
    """Index every row of ``target``, the table at ``path``; earlier runs go when the new one counts."""
    from orderlake.sources import tables

    spark = target.sparkSession
    before = _runs(spark, path)
    run = before[-1] + 1 if before else 1
    _append(entries(target, target.schema, keys, partition_col), path, run)
    tables.touch(spark, f"{_root(path)}/_READY", json.dumps({"run": run, "keys": keys}))
    for old in before:
        tables.delete_path(spark, f"{_root(path)}/run={old}")


def _mark(spark: SparkSession, path: str) -> dict | None:
    from orderlake.sources import tables

    mark = f"{_root(path)}/_READY"
    return json.loads(tables.read_text(spark, mark)) if tables.path_exists(spark, mark) else None


def needs_build(spark: SparkSession, path: str, keys: list[str]) -> bool:
    mark = _mark(spark, path)
    return mark is None or mark["keys"] != keys or len([r for r in _runs(spark, path) if r > mark["run"]]) >= REBUILD_RUNS


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(h, value) of the index for the hashes in ``wanted`` (:func:`entries`), from the buckets that it needs."""
    first = _mark(spark, path)["run"]
    buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]  # at most BUCKETS
    stored = spark.read.schema(SCHEMA).parquet(_root(path)).where((F.col("run") >= first) & F.col("bucket").isin(buckets))
    return stored.select("h", "value").join(wanted.select("h").distinct(), "h", "left_semi")


def add(spark: SparkSession, path: str, wanted: DataFrame, found: DataFrame) -> None:
    """Add the entries of ``wanted`` that ``found`` lacks."""
    new = wanted.join(found.distinct(), ["h", "value"], "left_anti")
    _append(new, path, _runs(spark, path)[-1] + 1)
