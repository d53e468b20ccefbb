"""FIXTURES.md B3: the driver's `events` table as a time-sliced stream.

One parquet file per day in time order; ids divisible by 40 are re-sent in
the next slice, ids divisible by 90 arrive three slices late.  Checks the
watermark semantics: a watermark without a stateful operator drops nothing
(G10), and dedup within the watermark keeps more copies apart the shorter
the watermark is (G9).
"""

import glob
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from orderlake.streaming import bronze_stream as bs
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def event_slices(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("b3")
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), "user_id", "event_type", "value")
    day = F.datediff(F.to_date("event_time"), F.lit("2024-01-01").cast("date"))
    # late rows move three slices on, staying inside the 30 day slices
    base = ev.withColumn("slice", F.when((F.col("event_id") % 90 == 0) & (day + 3 <= 29), day + 3).otherwise(day))
    # re-sent copies stay inside the 30 day slices; late rows are not re-sent
    copies = ev.where((F.col("event_id") % 40 == 0) & (F.col("event_id") % 90 != 0)) \
        .withColumn("slice", day + 1).where(F.col("slice") <= 29)
    allrows = base.unionByName(copies)
    src = root / "src"
    src.mkdir()
    slices = [r[0] for r in allrows.select("slice").distinct().orderBy("slice").collect()]
    for i, s in enumerate(slices):
        out = root / f"s{i}"
        allrows.where(F.col("slice") == s).drop("slice").coalesce(1).write.parquet(str(out))
        dst = src / f"{i:03d}.parquet"
        shutil.copy(glob.glob(str(out / "part-*.parquet"))[0], dst)
        os.utime(dst, (1_000_000 + i, 1_000_000 + i))
    return str(src), ev.schema, allrows.count(), ev.count()


def _run(spark, src, schema, transform, name):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = transform(stream).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(600)
    return spark.table(name)


def test_watermark_without_stateful_operator_drops_nothing(spark, event_slices):
    src, schema, total, _ = event_slices
    out = _run(spark, src, schema, lambda s: bs.apply_watermark(s), "b3_pass")
    assert out.count() == total


def test_dedup_within_watermark_depends_on_watermark(spark, event_slices):
    src, schema, total, distinct = event_slices
    long = _run(spark, src, schema, lambda s: bs.dedup_within_watermark(s, "2 days"), "b3_long")
    short = _run(spark, src, schema, lambda s: bs.dedup_within_watermark(s, "10 minutes"), "b3_short")
    assert long.count() == distinct  # every re-sent copy is within two days of its original
    assert long.count() == long.select("event_id").distinct().count()
    # with a 10-minute watermark the 101 three-day-late rows are dropped as late
    assert (total, distinct, long.count(), short.count()) == (10_215, 10_000, 10_000, 9_899)  # SURVEY §7.4


def test_processing_time_trigger_and_graceful_stop(spark, event_slices):
    src, schema, total, _ = event_slices
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 5).parquet(src)
    q = stream.writeStream.format("memory").queryName("b3_timer").trigger(processingTime="1 second").start()
    deadline = time.time() + 120
    while time.time() < deadline and spark.table("b3_timer").count() == 0:
        time.sleep(0.5)
    bs.stop_gracefully(q)
    assert not q.isActive and spark.table("b3_timer").count() > 0
