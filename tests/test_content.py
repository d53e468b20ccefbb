"""Reconciliation by content (K11, K12), exact quantiles (M5), rolled-up distinct customers (X6) and payload drift."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.operators import quantiles, quality, reconciliation, rollup, serving
from orderlake.plans.chain import Lake
from tests.conftest import SF_SMALL

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
IDS = "event_date date, event_id string"


def test_equal_counts_with_swapped_ids(spark):
    rows = [(D1 if i % 2 else D2, f"e{i}") for i in range(500)]
    other = [(d, "x7" if e == "e7" else e) for d, e in rows if e != "e8"] + [(D2, "x8")]
    source, target = spark.createDataFrame(rows, IDS), spark.createDataFrame(other, IDS)
    got = {tuple(r) for r in reconciliation.checksum_reconcile(source, target, buckets=16).collect()}
    assert got == {(D1, "e7", "missing", 1), (D1, "x7", "foreign", 1), (D2, "e8", "missing", 1), (D2, "x8", "foreign", 1)}
    counts = quality.daily_counts(source, "event_date", "n").exceptAll(quality.daily_counts(target, "event_date", "n"))
    assert counts.count() == 0  # counts alone see nothing
    assert reconciliation.checksum_reconcile(source, source).count() == 0


def test_moved_repeated_and_null_ids(spark):
    source = spark.createDataFrame([(D1, "a"), (D1, "b"), (None, "c"), (D1, None), (D1, None)], IDS)
    target = spark.createDataFrame([(D2, "a"), (D1, "b"), (D1, "b"), (None, "c"), (D1, None)], IDS)
    got = {tuple(r) for r in reconciliation.checksum_reconcile(source, target).collect()}
    assert got == {(D1, "a", "missing", 1), (D2, "a", "foreign", 1), (D1, "b", "foreign", 1), (D1, None, "missing", 1)}
    empty = spark.createDataFrame([], IDS)
    assert reconciliation.checksum_reconcile(empty, empty).count() == 0
    assert {r["status"] for r in reconciliation.checksum_reconcile(empty, source).collect()} == {"foreign"}


def test_only_differing_buckets_are_compared(spark):
    source = spark.range(4000).select(F.lit(D1).alias("event_date"), F.concat(F.lit("e"), "id").alias("event_id"))
    target = source.where("event_id <> 'e17'")
    differ = reconciliation.differing_buckets(source, target, "event_id", "event_date", "event_date", 64)
    assert differ.count() == 1
    # The ids meet the buckets in a semi join before they are grouped one by one.
    plan = reconciliation.checksum_reconcile(source, target, buckets=64)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2


@pytest.mark.parametrize("small", [150, 100_000])
def test_quantiles_against_numpy(spark, small):
    rng = random.Random(small)
    groups = {
        "even": [float(i) for i in range(1000)], "ties": [5.0] * 300 + [7.0] * 2, "one": [2.5], "skewed": [10.0 ** rng.uniform(-2, 2) for _ in range(400)],
        "signs": [rng.uniform(-1, 1) for _ in range(301)], None: [1.0, 2.0], "huge": [-1.7e308, 1.7e308, 0.0, 1.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("even", None), ("gone", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    qs = {"p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "x", qs, bins=256, small=small).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for name, q in qs.items():
            v, at = sorted(vs), q * (len(vs) - 1)
            low, high = v[math.floor(at)], v[math.ceil(at)]
            assert math.isclose(got[g][name], low + (high - low) * (at - math.floor(at)), rel_tol=1e-12, abs_tol=1e-300), (g, name)
    assert np.isclose(got["skewed"]["p50"], np.quantile(groups["skewed"], 0.5))


def test_quantiles_keep_no_group_in_a_buffer(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("x"))
    plan = quantiles.exact_quantiles(df, ["k"], "x", {"p": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan.lower()
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "x", {"p": 0.5}).count() == 0


def test_dense_numbers_have_no_gaps_and_stay(spark):
    ids = spark.range(0, 3000, 1, 7).select(F.when(F.col("id") % 100 == 0, None).otherwise(F.concat(F.lit("c"), F.col("id") % 1700)).alias("c"))
    first = rollup.dense_numbers(ids, "c")
    n = first.count()
    assert n == ids.where("c IS NOT NULL").distinct().count()
    assert [r["number"] for r in first.orderBy("number").collect()] == list(range(n))
    more = rollup.dense_numbers(ids.unionByName(spark.createDataFrame([("new",), ("c1",)], "c string")), "c", known=first)
    assert more.count() == n + 1 and first.exceptAll(more).count() == 0
    assert more.where("id = 'new'").first()["number"] == n


def test_roll_up_equals_counting_all_events(spark):
    lake = Lake(spark, SF_SMALL)
    numbers = rollup.dense_numbers(lake.silver, "customer_id")
    hourly, customers = rollup.hourly_rollup(lake.silver), rollup.hourly_customers(lake.silver, numbers)
    for by in (["event_date"], ["city"], ["event_date", "category"]):
        want = lake.silver.where("event_type = 'ORDER_PLACED'").groupBy(*by).agg(F.count(F.lit(1)).alias("total_orders"), F.countDistinct("customer_id").alias("unique_customers"))
        got = rollup.roll_up(hourly, customers, by).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_payload_drift_of_odd_messages(spark):
    payloads = [{"city": "A", "amount": "1.5", "item_count": "2"}, {"city": None, "amount": "x", "item_count": "2.5", "new": 1}, {"amount": 3, "new": "s"}]
    rows = [json.dumps({"event_type": "P", "payload": p}) for p in payloads]
    rows += ["not json", None, "7", json.dumps({"event_type": "P"}), json.dumps({"event_type": "P", "payload": [1]}), json.dumps({"payload": {"city": "B"}})]
    got = {(r["event_type"], r["payload_key"]): r for r in serving.payload_drift(spark.createDataFrame([(r,) for r in rows], "value string"), {"city": "string", "amount": "double", "item_count": "int"}).collect()}
    assert set(got) == {("P", k) for k in ("city", "amount", "item_count", "new")} | {(None, k) for k in ("city", "amount", "item_count")}
    p = lambda k: tuple(got["P", k][c] for c in ("in_contract", "messages", "present", "missing", "failed_casts"))
    assert p("city") == (True, 3, 2, 1, 0) and p("amount") == (True, 3, 3, 0, 1) and p("item_count") == (True, 3, 2, 1, 1) and p("new") == (False, 3, 2, 1, 0)
    assert got["P", "new"]["json_type"] == "VARIANT" and got[None, "amount"]["missing"] == 1


def test_messages_are_parsed_once(spark):
    plan = serving.payload_drift(Lake(spark, SF_SMALL).raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1 and plan.count("parseJson(") + plan.count("parse_json(") <= 1


def test_sparse_hours_store_positions_only(spark):
    lake = Lake(spark, SF_SMALL)
    stored = rollup.hourly_customers(lake.silver, rollup.dense_numbers(lake.silver, "customer_id"))
    people = lake.silver.where("event_type = 'ORDER_PLACED' AND customer_id IS NOT NULL").select(*rollup.HOUR, "customer_id").distinct().count()
    # A number for each customer of an hour, not 4 KB for each hour.
    assert stored.agg(F.sum(F.size("customers"))).first()[0] == people


def test_quantiles_count_repeated_values_by_weight(spark):
    df = spark.createDataFrame([("a", 2.0)] * 7 + [("a", 4.0), ("a", None), ("b", None)], "k string, x double")
    assert {tuple(r) for r in quantiles.weighted(df, ["k"], "x").collect()} == {("a", 2.0, 7), ("a", 4.0, 1)}
    got = quantiles.exact_quantiles(df, ["k"], "x", {"p": 0.95}, bins=2, small=1).collect()
    assert [r["k"] for r in got] == ["a"] and abs(got[0]["p"] - np.quantile([2.0] * 7 + [4.0], 0.95)) < 1e-12
