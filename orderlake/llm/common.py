"""Helpers shared by the operators: tables, the shared scratch folder, checkpoints, grouped streams."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import ensure_checkpoint_dir

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only a local session (tests) may go without the setting; it then gets a
    scratch folder.  On a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(path)
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return ensure_checkpoint_dir(spark).rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh name below the shared folder, for files that tasks write themselves."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def filesystem(path: str):
    """A pyarrow file system and the path in it (file, HDFS or an object store)."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        path = "file://" + os.path.abspath(path)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def per_key(df: DataFrame, keys: list[str], *aggs) -> DataFrame:
    """``groupBy(keys)``, shaped to be joined back to ``df`` so that adaptive execution can split hot keys.

    Grouping by a hash of the keys as well keeps the groups but not the
    partitioning, so both sides of the join are ordinary shuffles.
    """
    return df.groupBy(*keys, F.hash(*keys).alias("_g")).agg(*aggs).drop("_g")


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from a stream of Arrow batches that is sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        now = list(zip(*cols, strict=True))
        start = 0
        for i, key in enumerate(now):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once, for sessions whose executors don't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_orderlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    place = os.path.join(tempfile.mkdtemp(prefix="orderlake-"), "orderlake.zip")
    with zipfile.ZipFile(place, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("orderlake", os.path.relpath(full, root)))
    context.addPyFile(place)
    context._orderlake_shipped = True


#: Rows of an Arrow batch that a task holds as Python objects at once.
SLICE = 512


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers; the function gets batches of SLICE rows at most."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(b.slice(at, SLICE) for b in batches for at in range(0, max(b.num_rows, 1), SLICE))

    return df.mapInArrow(run, schema)


def sum_vectors(rows: DataFrame) -> DataFrame:
    """Element-wise sums of ``values`` (array<double>, one length per key) for each ``key``, added in the order of ``part``.

    Every task sends one row per key, so a reducer streams as many short rows
    as there were tasks and holds one sum.
    """
    dealt = rows.select("key", "part", "values").repartition("key").sortWithinPartitions("key", "part")

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([total], pa.list_(pa.float64()))], ["key", "values"])
        for batch in batches:
            values = batch.column(2)
            for i, key in enumerate(batch.column(0).to_pylist()):
                now = values[i].values.to_numpy(zero_copy_only=False)
                if key == held:
                    total = total + now
                    continue
                if held is not None:
                    yield done()
                held, total = key, now
        if held is not None:
            yield done()

    return map_arrow(dealt, add, "key long, values array<double>")


def forget(known: dict, most: int) -> None:
    """Cut a full memory down to the half that was learned first: frequent words are met early."""
    if len(known) > most:
        for k in list(known)[most // 2 :]:
            del known[k]
