"""Structured Streaming: file source in time order, availableNow triggers, restart, replay,
cross-batch duplicates, watermark dedup, windowed aggregate and stream-stream join."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from orderlake.operators import gold, ingest, silver
from orderlake.plans.chain import Lake
from orderlake.streaming import bronze_stream as bs
from tests.conftest import SF_SMALL


def write_slices(spark, raw, src_dir, scratch, slice_col):
    """One JSON file per time slice, modification times in slice order (the file source's order)."""
    os.makedirs(src_dir, exist_ok=True)
    keys = [r[0] for r in raw.select(slice_col).distinct().orderBy(slice_col).collect()]
    for i, k in enumerate(keys):
        out = os.path.join(scratch, f"slice{i}")
        raw.where(F.col(slice_col) == k).drop(slice_col).coalesce(1).write.mode("overwrite").json(out)
        part = glob.glob(os.path.join(out, "part-*.json"))[0]
        dst = os.path.join(src_dir, f"{i:04d}.json")
        shutil.copy(part, dst)
        os.utime(dst, (1_000_000 + i * 10, 1_000_000 + i * 10))
    return len(keys)


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF_SMALL)


@pytest.fixture(scope="module")
def by_year(lake):
    return lake.raw.withColumn("_slice", F.year(F.timestamp_millis("kafka_timestamp")))


def run_bronze(spark, src, root, max_files=1, horizon=2):
    q = bs.start_bronze_stream(bs.file_source(spark, src, max_files_per_trigger=max_files),
                               f"{root}/bronze", f"{root}/dlq", f"{root}/ckpt", f"{root}/metrics",
                               available_now=True, horizon_days=horizon)
    q.awaitTermination(300)
    return q


def test_bronze_stream_matches_batch(spark, lake, by_year, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    n = write_slices(spark, by_year, src, str(tmp_path / "scratch"), "_slice")
    run_bronze(spark, src, root, horizon=0)
    bronze = spark.read.parquet(f"{root}/bronze")
    batch_bronze, batch_dlq = lake.split
    assert bronze.count() == batch_bronze.count()
    assert spark.read.parquet(f"{root}/dlq").count() == batch_dlq.count()
    # duplicate copies arrive 10 s apart, inside one slice: batch-local tagging equals the batch job
    got = bronze.select("event_id", "kafka_offset", "is_duplicate")
    exp = batch_bronze.select("event_id", "kafka_offset", "is_duplicate")
    assert got.exceptAll(exp).count() == 0
    metrics = spark.read.parquet(f"{root}/metrics")
    assert metrics.count() == n
    assert metrics.agg(F.sum("written")).first()[0] == bronze.count()


def test_restart_resumes_and_replay_is_idempotent(spark, by_year, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    staged = str(tmp_path / "staged")
    n = write_slices(spark, by_year, staged, str(tmp_path / "scratch"), "_slice")
    files = sorted(os.listdir(staged))
    os.makedirs(src)
    for f in files[:3]:
        shutil.copy2(os.path.join(staged, f), os.path.join(src, f))
    run_bronze(spark, src, root)
    first = spark.read.parquet(f"{root}/bronze").count()
    for f in files[3:]:
        shutil.copy2(os.path.join(staged, f), os.path.join(src, f))
    run_bronze(spark, src, root)  # same checkpoint: only the new files are read
    total = spark.read.parquet(f"{root}/bronze")
    assert total.select("batch_id").distinct().count() == n and total.count() > first
    # replay batch 0 through the writer: the table is unchanged
    before = sorted(map(tuple, total.select("event_id", "kafka_offset", "batch_id").collect()))
    batch0 = spark.read.schema(bs.KAFKA_METADATA).json(os.path.join(src, files[0]))
    stream = [r[0] for r in total.select("stream_id").distinct().collect()]
    assert len(stream) == 1 and stream[0] != "batch"  # a restart keeps the identity that the checkpoint holds
    bs.bronze_writer(f"{root}/bronze", f"{root}/dlq", None, horizon_days=2, stream_id=stream[0])(batch0, 0)
    after = sorted(map(tuple, spark.read.parquet(f"{root}/bronze").select("event_id", "kafka_offset", "batch_id").collect()))
    assert before == after


def test_cross_batch_duplicates_are_tagged(spark, lake, tmp_path):
    # copies of every 40th order's placement re-sent one slice later (next day)
    raw = lake.raw.withColumn("_slice", F.floor(F.col("kafka_timestamp") / F.lit(86_400_000 * 400)))
    k = F.regexp_extract("key", r"(\d+)$", 1).cast("long")
    copies = raw.where(F.col("key").startswith("ORD-") & (k % 40 == 0) & F.col("value").contains('"ORDER_PLACED"')) \
        .withColumn("offset", (F.col("offset").cast("long") + 1_000_000).cast("string")) \
        .withColumn("_slice", F.col("_slice") + 1)
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    write_slices(spark, raw.unionByName(copies), src, str(tmp_path / "scratch"), "_slice")
    run_bronze(spark, src, root, horizon=800)
    bronze = spark.read.parquet(f"{root}/bronze")
    resent = copies.select(F.col("offset").alias("kafka_offset"))
    tagged = bronze.join(resent, "kafka_offset").groupBy("is_duplicate").count().collect()
    assert {r.is_duplicate: r["count"] for r in tagged}.get("true", 0) == copies.count()


def test_dedup_within_watermark_keeps_first_copy(spark, lake, by_year, tmp_path):
    src = str(tmp_path / "src")
    write_slices(spark, by_year, src, str(tmp_path / "scratch"), "_slice")
    events = bs.dedup_within_watermark(bs.typed_stream(bs.file_source(spark, src)), "2 days")
    q = events.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination(300)
    out = spark.table("dedup_out")
    assert out.count() == out.select("event_id").distinct().count()
    batch_ids = silver.cast_and_extract(ingest.non_duplicates(lake.bronze)).select("event_id").distinct().count()
    assert out.count() == batch_ids


def test_hourly_window_stream_equals_batch_for_closed_windows(spark, lake, by_year, tmp_path):
    src = str(tmp_path / "src")
    # drop the three-hour-late copies so that event order follows file order, then compare exactly
    lag = F.get_json_object("value", "$.ingested_at").cast("long") - F.get_json_object("value", "$.occurred_at").cast("long")
    on_time = by_year.where(F.coalesce(lag, F.lit(0)) <= 600_000)
    write_slices(spark, on_time, src, str(tmp_path / "scratch"), "_slice")
    stream = bs.hourly_orders_stream(bs.typed_stream(bs.file_source(spark, src)))
    q = stream.writeStream.format("memory").queryName("hourly_out").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table("hourly_out")
    assert got.count() > 0
    late_orders = lake.silver.where((F.col("ingested_at") - F.col("occurred_at")) > 600_000).select("order_id").distinct()
    exp = gold.hourly_orders(lake.silver.join(late_orders, "order_id", "left_anti"))
    cols = ["event_date", "event_hour", "city", "category", "order_count", "gross_revenue", "total_items",
            "unique_customers", "avg_order_value"]
    # every emitted window is final and equal to the batch result over the same (on-time) events
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0
    assert got.count() >= exp.count() * 0.95
    # two chained aggregates after the dedup, and no set in either: distinct customers are rows of state
    assert [o["operatorName"] for o in q.lastProgress["stateOperators"]].count("stateStoreSave") == 2
    assert "collect_set" not in stream._jdf.queryExecution().logical().toString()


def test_late_event_kept_in_bronze_dropped_from_window(spark, tmp_path):
    from tests.helpers import T0
    H = 3_600_000
    def msg(i, occurred, ingested):
        v = ('{"event_id":"e%d","event_type":"ORDER_PLACED","order_id":"o%d","customer_id":"c","occurred_at":%d,'
             '"ingested_at":%d,"payload":{"city":"X","category":"Y","amount":"10.00"}}') % (i, i, occurred, ingested)
        return (f"o{i}", v, "orders-raw", "0", str(i), ingested)
    # late rows are judged against the previous batch's watermark, so the late row comes two batches later
    slices = [[msg(1, T0, T0)], [msg(2, T0 + 5 * H, T0 + 5 * H)], [msg(4, T0 + 6 * H, T0 + 6 * H)],
              [msg(3, T0 + 10 * 60_000, T0 + 6 * H)]]
    src = str(tmp_path / "src")
    os.makedirs(src)
    for i, rows in enumerate(slices):
        spark.createDataFrame(rows, bs.KAFKA_METADATA).coalesce(1).write.json(str(tmp_path / f"s{i}"))
        part = glob.glob(str(tmp_path / f"s{i}" / "part-*.json"))[0]
        shutil.copy(part, os.path.join(src, f"{i}.json"))
        os.utime(os.path.join(src, f"{i}.json"), (2_000_000 + i, 2_000_000 + i))
    root = str(tmp_path / "lake")
    run_bronze(spark, src, root)
    assert spark.read.parquet(f"{root}/bronze").count() == 4  # G10: Bronze keeps the late row
    q = bs.hourly_orders_stream(bs.typed_stream(bs.file_source(spark, src))).writeStream.format("memory") \
        .queryName("late_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    first_hour = spark.table("late_out").where("event_hour = 0").collect()
    assert len(first_hour) == 1 and first_hour[0].order_count == 1  # the late row missed the closed window


def test_stream_stream_join_matches_batch(spark, lake, by_year, tmp_path):
    src = str(tmp_path / "src")
    write_slices(spark, by_year, src, str(tmp_path / "scratch"), "_slice")
    joined = bs.fulfillment_stream(bs.typed_stream(bs.file_source(spark, src)), horizon_hours=96)
    q = joined.writeStream.format("memory").queryName("sla_out").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table("sla_out").where("delivered_ms IS NOT NULL")
    exp = gold.fulfillment(lake.silver).where("delivered_ms IS NOT NULL")
    cols = ["order_id", "placed_ms", "delivered_ms", "delivery_status"]
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0
    assert got.count() >= exp.count() * 0.95


def messages(spark, tmp_path, slices):
    """A file per slice of (event_id, event_type, order_id, hours after T0), in slice order."""
    from tests.helpers import T0
    src = str(tmp_path / "src")
    os.makedirs(src)
    for i, events in enumerate(slices):
        rows = []
        for n, (eid, kind, oid, hours) in enumerate(events):
            at = T0 + int(hours * 3_600_000)
            v = ('{"event_id":"%s","event_type":"%s","order_id":"%s","customer_id":"c","occurred_at":%d,"ingested_at":%d,'
                 '"payload":{"city":"X","category":"Y","amount":"10.00"}}') % (eid, kind, oid, at, at)
            rows.append((oid, v, "orders-raw", "0", str(i * 1000 + n), at))
        spark.createDataFrame(rows, bs.KAFKA_METADATA).coalesce(1).write.json(str(tmp_path / f"m{i}"))
        shutil.copy(glob.glob(str(tmp_path / f"m{i}" / "part-*.json"))[0], os.path.join(src, f"{i}.json"))
        os.utime(os.path.join(src, f"{i}.json"), (3_000_000 + i, 3_000_000 + i))
    return src


def test_delivery_status_stream_corrects_and_repeats_nothing(spark, tmp_path):
    P, D = "ORDER_PLACED", "ORDER_DELIVERED"
    src = messages(spark, tmp_path, [
        [("e1", P, "a", 0), ("e2", P, "b", 0), ("e3", P, "c", 1), ("e4", D, "d", 1)],  # d: delivered before it was placed
        [("e5", D, "a", 5), ("e6", P, "d", 4)],
        [("e7", D, "a", 30), ("e8", D, "d", 31)],  # a: repeated a day later
        [("e9", P, "z", 200)], [("e10", P, "z", 200)],  # the horizon of b and c passes
        [("e11", D, "b", 220)], [("e12", P, "y", 400)], [("e13", P, "y", 400)],
    ])
    out = bs.delivery_status_stream(bs.typed_stream(bs.file_source(spark, src)), horizon_hours=96)
    batches = []
    q = out.writeStream.foreachBatch(lambda df, i: batches.extend((i, *r) for r in df.collect())).trigger(availableNow=True).start()
    q.awaitTermination(300)
    said = {}
    for r in sorted(batches, key=lambda r: r[0]):
        said.setdefault(r[1], []).append(r[6])
    assert said == {"a": ["ON_TIME"], "b": ["PENDING", "LATE"], "c": ["PENDING"], "d": ["ON_TIME"], "z": ["PENDING"]}


def test_delivery_status_stream_ends_as_the_batch_table(spark, lake, by_year, tmp_path):
    src = str(tmp_path / "src")
    lag = F.get_json_object("value", "$.ingested_at").cast("long") - F.get_json_object("value", "$.occurred_at").cast("long")
    on_time = by_year.where(F.coalesce(lag, F.lit(0)) <= 600_000)
    write_slices(spark, on_time, src, str(tmp_path / "scratch"), "_slice")
    out = bs.delivery_status_stream(bs.typed_stream(bs.file_source(spark, src)))
    path = str(tmp_path / "out")
    q = out.writeStream.foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(path)).trigger(availableNow=True).start()
    q.awaitTermination(300)
    rows = spark.read.parquet(path)
    last = rows.groupBy("order_id").agg(F.max_by(F.struct("placed_ms", "delivered_ms", "delivery_status"), "batch").alias("r")).select("order_id", "r.*")
    parsed = silver.cast_and_extract(ingest.first_copies(ingest.validate(ingest.enrich(ingest.parse_messages(ingest.kafka_to_strings(on_time.drop("_slice"))), loaded_at_ms=0))[0]))
    exp = gold.fulfillment(parsed).select("order_id", "placed_ms", "delivered_ms", "delivery_status")
    assert last.exceptAll(exp).count() == 0
    open_still = exp.join(last, "order_id", "left_anti")  # placed within the horizon before the end
    assert open_still.where("delivered_ms IS NOT NULL").count() == 0 and last.count() >= exp.count() * 0.95
