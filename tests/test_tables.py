"""Writers on plain Parquet: rerun safety, emptied partitions, crash recovery."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from orderlake.sources import tables

SCHEMA = "event_id string, event_date date, amount double, ingested_at long"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def snapshot(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("event_id", "event_date", "amount").collect())


def test_read_or_default_when_absent(spark, tmp_path):
    df = tables.read_table(spark, str(tmp_path / "nope"), spark.createDataFrame([], SCHEMA).schema)
    assert df.count() == 0 and not tables.table_exists(spark, str(tmp_path / "nope"))


def test_upsert_create_then_rerun_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "silver")
    src = frame(spark, [("a", D1, 1.0, 1), ("b", D1, 2.0, 1), ("c", D2, 3.0, 1)])
    tables.upsert(src, path, ["event_id"], "event_date", order_cols=["ingested_at"])
    first = snapshot(spark, path)
    tables.upsert(src, path, ["event_id"], "event_date", order_cols=["ingested_at"])
    assert snapshot(spark, path) == first == [("a", D1, 1.0), ("b", D1, 2.0), ("c", D2, 3.0)]


def test_upsert_updates_inserts_and_dedupes_source(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.upsert(frame(spark, [("a", D1, 1.0, 1), ("b", D2, 2.0, 1)]), path, ["event_id"], "event_date",
                  order_cols=["ingested_at"])
    src = frame(spark, [("a", D1, 10.0, 2), ("a", D1, 99.0, 1), ("d", D3, 4.0, 1)])
    m = tables.upsert(src, path, ["event_id"], "event_date", order_cols=["ingested_at"])
    assert snapshot(spark, path) == [("a", D1, 10.0), ("b", D2, 2.0), ("d", D3, 4.0)]
    assert m["touched"] == 2  # D2 is not read or rewritten


def test_upsert_moving_every_row_out_removes_partition(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.upsert(frame(spark, [("a", D1, 1.0, 1), ("b", D2, 2.0, 1)]), path, ["event_id"], "event_date",
                  order_cols=["ingested_at"])
    tables.upsert(frame(spark, [("a", D2, 1.5, 2)]), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    assert snapshot(spark, path) == [("a", D2, 1.5), ("b", D2, 2.0)]
    assert not tables.path_exists(spark, f"{path}/event_date=2024-01-01")


def test_crash_between_stage_and_publish_rolls_forward(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.upsert(frame(spark, [("a", D1, 1.0, 1)]), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    # Simulate a crash after staging was marked ready: the target partition is already gone.
    stage = f"{path}/_staging/crashed"
    frame(spark, [("a", D1, 7.0, 2)]).write.partitionBy("event_date").parquet(stage)
    tables.touch(spark, f"{stage}/_READY", json.dumps({"touched": ["2024-01-01"]}))
    tables.delete_path(spark, f"{path}/event_date=2024-01-01")
    assert tables.recover(spark, path, "event_date") == 1
    assert snapshot(spark, path) == [("a", D1, 7.0)]
    assert not tables.path_exists(spark, stage)


def test_unfinished_staging_is_discarded(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.upsert(frame(spark, [("a", D1, 1.0, 1)]), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    stage = f"{path}/_staging/partial"
    frame(spark, [("z", D1, 9.0, 2)]).write.partitionBy("event_date").parquet(stage)  # no _READY
    assert tables.recover(spark, path, "event_date") == 0
    assert snapshot(spark, path) == [("a", D1, 1.0)]


def test_replace_partition_and_empty_input_removes_it(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.replace_partition(frame(spark, [("a", D1, 1.0, 1)]), path, "event_date", D1)
    tables.replace_partition(frame(spark, [("b", D2, 2.0, 1)]), path, "event_date", D2)
    tables.replace_partition(frame(spark, [("c", D1, 3.0, 1)]), path, "event_date", D1)
    assert snapshot(spark, path) == [("b", D2, 2.0), ("c", D1, 3.0)]
    rows = tables.replace_partition(frame(spark, []), path, "event_date", D1)
    assert rows == 0 and snapshot(spark, path) == [("b", D2, 2.0)]
    hist = tables.history(spark, path).collect()
    assert len(hist) == 4 and hist[0].version == 4 and hist[0].operation == "REPLACE PARTITION"


def test_replace_partition_rejects_rows_outside(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.replace_partition(frame(spark, [("a", D1, 1.0, 1)]), path, "event_date", D1)
    with pytest.raises(Exception):
        tables.replace_partition(frame(spark, [("x", D2, 1.0, 1)]), path, "event_date", D1)
    assert snapshot(spark, path) == [("a", D1, 1.0)]


def test_append_batch_replay_overwrites_only_its_batch(spark, tmp_path):
    path = str(tmp_path / "bronze")
    b = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "event_id string, ingestion_date string")
    tables.append_batch(b, path, 0)
    tables.append_batch(spark.createDataFrame([("c", "2024-01-01")], "event_id string, ingestion_date string"), path, 1)
    tables.append_batch(b, path, 0)  # replay of batch 0
    got = sorted((r.event_id, r.batch_id) for r in spark.read.parquet(path).collect())
    assert got == [("a", 0), ("b", 0), ("c", 1)]


def test_export_csv_skips_empty(spark, tmp_path):
    out = str(tmp_path / "export")
    assert tables.export_csv(frame(spark, [("a", D1, 1.0, 1)]), out) == 1
    assert spark.read.option("header", True).csv(out).count() == 1
    assert tables.export_csv(frame(spark, []), str(tmp_path / "empty")) == 0
    assert not tables.path_exists(spark, str(tmp_path / "empty"))


def test_export_tables_per_date(spark, tmp_path):
    src = str(tmp_path / "gold")
    frame(spark, [("a", D1, 1.0, 1), ("b", D2, 2.0, 1)]).withColumn("processing_date", F.col("event_date")) \
        .write.parquet(src)
    counts = tables.export_tables(spark, {"fact": src}, str(tmp_path / "out"), D1)
    assert counts == {"fact": 1}


def test_upsert_moves_a_key_from_any_partition(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.upsert(frame(spark, [("a", D1, 1.0, 1), ("b", D2, 2.0, 1), ("c", D3, 3.0, 1)]), path, ["event_id"],
                  "event_date", order_cols=["ingested_at"])
    m = tables.upsert(frame(spark, [("a", D3, 30.0, 2)]), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    assert m["touched"] == 2 and snapshot(spark, path) == [("a", D3, 30.0), ("b", D2, 2.0), ("c", D3, 3.0)]


def test_upsert_keeps_columns_that_only_one_side_has(spark, tmp_path):
    path = str(tmp_path / "silver")
    up = lambda df: tables.upsert(df, path, ["event_id"], "event_date", order_cols=["ingested_at"])
    up(frame(spark, [("a", D1, 1.0, 1), ("b", D2, 2.0, 1)]))
    up(frame(spark, [("c", D1, 3.0, 1)]).withColumn("extra", F.lit("x")))
    up(frame(spark, [("d", D1, 4.0, 1)]))
    got = {r.event_id: r.extra for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
    assert got == {"a": None, "b": None, "c": "x", "d": None}


def test_upsert_refuses_rows_without_partition_and_goes_on(spark, tmp_path):
    path = str(tmp_path / "silver")
    up = lambda rows: tables.upsert(frame(spark, rows), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    up([("a", D1, 1.0, 1)])
    with pytest.raises(ValueError, match="without event_date"):
        up([("b", None, 2.0, 1), ("c", D1, 3.0, 1)])
    up([("c", D1, 3.0, 1)])
    assert snapshot(spark, path) == [("a", D1, 1.0), ("c", D1, 3.0)]
    # An older table may hold such rows; a key found there moves out and the others stay.
    old = str(tmp_path / "old")
    frame(spark, [("a", None, 1.0, 1), ("b", None, 2.0, 1), ("c", D1, 3.0, 1)]).write.partitionBy("event_date").parquet(old)
    tables.upsert(frame(spark, [("a", D2, 9.0, 2)]), old, ["event_id"], "event_date", order_cols=["ingested_at"])
    got = {(r.event_id, str(r.event_date), r.amount) for r in spark.read.parquet(old).collect()}
    assert got == {("a", str(D2), 9.0), ("b", "None", 2.0), ("c", str(D1), 3.0)}


def test_replace_all_partitions_keeps_the_log(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.replace_all_partitions(frame(spark, [("a", D1, 1.0, 1), ("b", D2, 2.0, 1)]), path, "event_date")
    tables.replace_all_partitions(frame(spark, [("b", D2, 3.0, 1)]), path, "event_date")
    assert snapshot(spark, path) == [("b", D2, 3.0)]
    assert tables.history(spark, path).count() == 2


def test_a_rewrite_stopped_anywhere_leaves_the_old_rows_or_the_new_ones(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    rows = lambda: sorted(r.event_id for r in tables.read_table(spark, path).collect())
    tables.replace_table(frame(spark, [("a", D1, 1.0, 1), ("b", D1, 2.0, 1)]), path)
    opened = tables.read_table(spark, path)
    for name, seen in (("touch", ["a", "b"]), ("log_commit", ["a", "b", "c"])):
        def stop(*_, **__):
            raise OSError("stopped")
        monkeypatch.setattr(tables, name, stop)
        with pytest.raises(OSError):
            tables.replace_table(tables.read_table(spark, path).unionByName(frame(spark, [("c", D1, 3.0, 1)])), path)
        monkeypatch.undo()
        assert rows() == seen
    assert sorted(r.event_id for r in opened.collect()) == ["a", "b"]  # a reader of the version before goes on
    tables.replace_table(frame(spark, []), path)
    assert rows() == [] and tables.table_exists(spark, path)
    assert len(tables.list_dirs(spark, f"{path}/_versions")) == 2


def test_readers_never_see_a_half_published_upsert(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    up = lambda rows: tables.upsert(frame(spark, rows), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    up([("a", D1, 1.0, 1), ("b", D2, 2.0, 1), ("c", D3, 3.0, 1)])

    def stop(*_):
        raise OSError("stopped")

    monkeypatch.setattr(tables, "_publish", stop)
    with pytest.raises(OSError):
        up([("a", D2, 9.0, 2)])
    monkeypatch.undo()
    new = [("a", D2, 9.0), ("b", D2, 2.0), ("c", D3, 3.0)]
    seen = lambda: sorted(tuple(r) for r in tables.read_table(spark, path).select("event_id", "event_date", "amount").collect())
    assert seen() == new
    tables.delete_path(spark, f"{path}/event_date={D2}")  # half of the publish: one partition gone, the other still old
    assert seen() == new
    tables.recover(spark, path, "event_date")
    assert seen() == new == snapshot(spark, path)


def _spoil(path):
    """Files that any reader of data or footers stumbles over."""
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            with open(os.path.join(path, f), "wb") as out:
                out.write(b"no parquet")
            crc = os.path.join(path, f".{f}.crc")
            if os.path.exists(crc):
                os.remove(crc)


def test_upsert_opens_only_partitions_that_the_key_index_names(spark, tmp_path):
    path = str(tmp_path / "t")
    up = lambda rows: tables.upsert(frame(spark, rows), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    up([(f"k{d.day}-{i}", d, float(i), 1) for d in days for i in range(5)])
    for d in days[3:]:
        _spoil(f"{path}/event_date={d}")
    m = up([("k1-0", days[1], 100.0, 2), ("new", days[2], 7.0, 2)])  # one key moves, one is new
    assert m["touched"] == 3
    rows = spark.read.parquet(*[f"{path}/event_date={d}" for d in days[:3]]).collect()
    assert len(rows) == 16 and [r.amount for r in rows if r.event_id == "k1-0"] == [100.0]
    assert up([("new", days[2], 8.0, 3)])["touched"] == 1
    assert up([("k1-0", days[1], 101.0, 3)])["touched"] == 2  # the entry of its former day is still there ...
    with pytest.raises(Exception):  # noqa: B017  (a spoilt day is read when a key of it comes)
        up([("k9-0", days[0], 1.0, 4)])


def test_key_index_is_rebuilt_and_survives_other_writers(spark, tmp_path, monkeypatch):
    from orderlake.sources import key_index
    monkeypatch.setattr(key_index, "REBUILD_RUNS", 2)
    path = str(tmp_path / "t")
    up = lambda rows: tables.upsert(frame(spark, rows), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    stored = lambda: {(r.event_id, r.event_date, r.amount) for r in tables.read_table(spark, path).collect()}
    up([("a", D1, 1.0, 1), ("b", D2, 2.0, 1)])
    up([("a", D2, 1.0, 2)])
    up([("a", D3, 1.0, 3)])
    assert up([("a", D3, 4.0, 4)])["touched"] == 1  # ... until the index is built anew
    assert len(key_index._runs(spark, path)) == 2
    tables.replace_partition(frame(spark, [("z", D1, 9.0, 1)]), path, "event_date", D1)  # the index doesn't know z
    up([("z", D2, 10.0, 2)])
    assert stored() == {("a", D3, 4.0), ("b", D2, 2.0), ("z", D2, 10.0)}


def test_upsert_that_stops_after_its_index_entries_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    up = lambda rows: tables.upsert(frame(spark, rows), path, ["event_id"], "event_date", order_cols=["ingested_at"])
    up([("a", D1, 1.0, 1), ("b", D2, 2.0, 1)])
    with monkeypatch.context() as m:
        m.setattr(tables, "merge", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("executor lost")))
        with pytest.raises(RuntimeError):
            up([("a", D3, 5.0, 2)])
    up([("a", D2, 6.0, 3)])
    assert {(r.event_id, r.event_date, r.amount) for r in tables.read_table(spark, path).collect()} == {("a", D2, 6.0), ("b", D2, 2.0)}


def test_upsert_finds_keys_of_another_type_or_key_set(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda t, *r: spark.createDataFrame(r, f"k {t}, event_date date, v double")
    tables.upsert(rows("long", (1, D1, 1.0), (2, D2, 2.0)), path, ["k"], "event_date")
    tables.upsert(rows("int", (1, D3, 5.0)), path, ["k"], "event_date")  # the same key, hashed as another type
    got = lambda: {(r.k, r.event_date, r.v) for r in tables.read_table(spark, path).collect()}
    assert got() == {(1, D3, 5.0), (2, D2, 2.0)}
    tables.upsert(rows("long", (7, D1, 2.0)), path, ["v"], "event_date")  # another key: the index is built for it
    assert got() == {(1, D3, 5.0), (7, D1, 2.0)}
