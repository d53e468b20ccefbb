"""Golden cases of the original platform (FIXTURES.md §C) against our operators."""

import datetime as dt


from orderlake import config as C
from orderlake.operators import gold, ingest, quality
from orderlake.schemas import DIM_CUSTOMERS
from tests.helpers import T0, bronze_frame, event, parsed_frame, silver_rows

P = {"city": "Mumbai", "category": "electronics", "amount": "1500.0", "item_count": "2",
     "discount_pct": "10", "device": "android", "pincode": "400001"}


def test_valid_event_passes(spark):
    valid, invalid = ingest.validate(parsed_frame(spark, [event()]))
    assert valid.count() == 1 and invalid.count() == 0


def test_null_order_id_is_invalid_with_reason(spark):
    valid, invalid = ingest.validate(parsed_frame(spark, [event(order_id=None)]))
    assert valid.count() == 0
    assert [r.validation_failure for r in invalid.collect()] == ["missing_required_fields"]


def test_empty_string_counts_as_missing(spark):
    _, invalid = ingest.validate(parsed_frame(spark, [event(customer_id="")]))
    assert invalid.first().validation_failure == "missing_required_fields"


def test_unknown_type_is_invalid(spark):
    _, invalid = ingest.validate(parsed_frame(spark, [event(event_type="UNKNOWN_TYPE")]))
    assert invalid.first().validation_failure == "invalid_event_type"


def test_malformed_json_keeps_raw_text(spark):
    raw = spark.createDataFrame([("k", "not json", "orders-raw", "0", "5", T0)],
                                "key string, value string, topic string, partition string, offset string, kafka_timestamp long")
    bronze, dlq = ingest.bronze_split(raw, loaded_at_ms=0)
    assert bronze.count() == 0
    row = dlq.first()
    assert row.validation_failure == "malformed_json" and row.value == "not json"


def test_same_id_twice_exactly_one_tagged(spark):
    rows = [event(ingested_at=T0, offset="1"), event(ingested_at=T0 + 10_000, offset="2")]
    tagged = {r.kafka_offset: r.is_duplicate for r in bronze_frame(spark, rows).collect()}
    assert tagged == {"1": "false", "2": "true"}


def test_hourly_two_orders_one_group(spark):
    rows = [event(event_id="e1", order_id="o1", payload={**P, "amount": "1000.0"}),
            event(event_id="e2", order_id="o2", customer_id="CUST-002", payload={**P, "amount": "2000.0"})]
    out = gold.hourly_orders(silver_rows(spark, rows)).collect()
    assert len(out) == 1
    assert out[0].order_count == 2 and out[0].gross_revenue == 3000.0 and out[0].unique_customers == 2


def test_payment_health_counts(spark):
    rows = [event(event_id="p1", event_type="PAYMENT_SUCCESS", payload=P),
            event(event_id="p2", event_type="PAYMENT_FAILED", payload=P),
            event(event_id="p3", event_type="PAYMENT_FAILED", payload=P)]
    got = {r.event_type: r.event_count for r in gold.payment_health(silver_rows(spark, rows)).collect()}
    assert got == {"PAYMENT_SUCCESS": 1, "PAYMENT_FAILED": 2}


def _recon(spark, b, s):
    bronze = spark.createDataFrame([("2024-01-01", f"e{i}", "false") for i in range(b)],
                                   "ingestion_date string, event_id string, is_duplicate string")
    silver = spark.createDataFrame([(dt.date(2024, 1, 1),)] * s, "event_date date")
    return quality.reconcile(bronze, silver).first()


def test_reconciliation_tolerance(spark):
    ok, bad = _recon(spark, 1000, 998), _recon(spark, 1000, 900)
    assert ok.status == "PASS" and ok.variance_pct == 0.2
    assert bad.status == "FAIL" and bad.variance_pct == 10.0


def test_typing_e001(spark):
    row = silver_rows(spark, [event(event_id="e001", payload=P)]).first()
    assert (row.city, row.amount, row.device, row.item_count) == ("Mumbai", 1500.0, "android", 2)
    assert row.event_date == dt.date(2024, 1, 1) and row.event_hour == 0


def test_lenient_numeric_typing(spark):
    row = silver_rows(spark, [event(payload={"amount": "abc", "item_count": "2.7"})]).first()
    assert row.amount == 0.0 and row.item_count == 2 and row.city == C.UNKNOWN and row.pincode is None


def test_clean_bronze_inline_dq_passes(spark):
    row = quality.inline_dq(silver_rows(spark, [event(payload=P)])).first()
    assert row.dq_passed and row.null_customer_id_count == 0


def test_inline_dq_empty_input_passes(spark):
    empty = silver_rows(spark, [event(payload=P)]).limit(0)
    row = quality.inline_dq(empty).first()
    assert row.total_records == 0 and row.dq_passed


def test_suite_empty_day_matches_stored_report(spark):
    empty = silver_rows(spark, [event(payload=P)]).limit(0)
    res = {r.name: r for r in quality.run_suite(empty, quality.silver_suite(T0)).collect()}
    assert res["minimum_record_count"].passed is False
    assert res["amount_positive_rate"].passed is False and res["amount_positive_rate"].metric_value == 0.0
    assert res["city_known_rate"].passed is False and res["city_known_rate"].metric_value == 0.0
    assert res["schema_version_distribution"].passed is True
    assert {r.overall_status for r in res.values()} == {"FAIL"}


def test_suite_shape():
    suite = quality.silver_suite(0)
    sev = [e.severity for e in suite]
    assert sev.count("CRITICAL") == 5 and sev.count("WARNING") == 3
    assert len({e.name for e in suite}) == len(suite)


def test_suite_is_one_aggregate(spark):
    typed = silver_rows(spark, [event(payload=P)])
    df = spark.createDataFrame(typed.collect(), typed.schema)  # an input without upstream aggregates
    plan = quality.run_suite(df, quality.silver_suite(T0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # one partial + one final aggregate for all eight checks


def test_gate(spark):
    df = silver_rows(spark, [event(payload=P)])
    res = quality.run_suite(df, quality.silver_suite(T0 + 1))
    ok, reasons = quality.gate(res, None)
    assert not ok and "recon: ERROR" in reasons
    ok2, reasons2 = quality.gate(None, None)
    assert not ok2 and any("ERROR" in r for r in reasons2)


def test_producer_check_lists_missing_sorted(spark):
    df = parsed_frame(spark, [event(order_id=None, customer_id=None)])
    row = ingest.producer_check(df).first()
    assert row.producer_reason == "Missing fields: customer_id, order_id" and not row.producer_valid


def test_keyed_publish_falls_back_to_event_id(spark):
    df = parsed_frame(spark, [event(order_id=None), event(event_id="e2")])
    keys = sorted(r.key for r in ingest.keyed_publish(df, 2).collect())
    assert keys == ["ORD-001", "evt-001"]


def test_sla_status_and_first_delivery(spark):
    rows = [event(event_id="pl", order_id="o1", payload=P),
            event(event_id="d1", event_type="ORDER_DELIVERED", order_id="o1", occurred_at=T0 + 50 * 3_600_000, payload=P),
            event(event_id="d2", event_type="ORDER_DELIVERED", order_id="o1", occurred_at=T0 + 10 * 3_600_000, payload=P),
            event(event_id="pl2", order_id="o2", payload=P)]
    out = {r.order_id: (r.delivery_status, r.delivery_hours) for r in gold.fulfillment(silver_rows(spark, rows)).collect()}
    assert out == {"o1": ("ON_TIME", 10.0), "o2": ("PENDING", None)}
    sla = gold.daily_sla(silver_rows(spark, rows)).collect()
    assert sum(r.order_count for r in sla) == 2  # repeated deliveries do not fan out


def test_row_without_event_time_goes_to_dead_letters(spark):
    value = ('{"event_id":"e1","event_type":"ORDER_PLACED","order_id":"o1","customer_id":"c1",'
             '"payload":{"city":"X"}}')
    raw = spark.createDataFrame([("o1", value, "orders-raw", "0", "1", T0)],
                                "key string, value string, topic string, partition string, offset string, kafka_timestamp long")
    bronze, dlq = ingest.bronze_split(raw, loaded_at_ms=0)
    assert bronze.count() == 0 and dlq.first().validation_failure == "missing_event_time"


def test_event_times_out_of_range_are_dead_letters(spark):
    import json

    from orderlake.operators import ingest
    base = dict(event_id="e", event_type="ORDER_PLACED", order_id="o", customer_id="c", ingested_at=T0, payload={})
    times = [T0, T0 * 1000, T0 * 1_000_000, -1, 4_102_444_800_000]
    raw = spark.createDataFrame(
        [(f"{k}", json.dumps(base | {"event_id": f"e{k}", "occurred_at": t}), "orders-raw", "0", str(k), T0) for k, t in enumerate(times)],
        "key string, value string, topic string, partition string, offset string, kafka_timestamp long")
    bronze, dlq = ingest.bronze_split(raw, 0)
    assert [r.event_id for r in bronze.collect()] == ["e0"]
    assert {r.event_id: r.validation_failure for r in dlq.collect()} == {f"e{k}": "invalid_event_time" for k in range(1, 5)}


def test_odd_amounts_and_exact_sums(spark):
    rows = [event(f"e{k}", payload={"city": "X", "category": "y", "amount": a}, order_id=f"o{k}") for k, a in
            enumerate(["10.00", "10.005", "0.004", "NaN", "Infinity", "-Infinity", "1e300", "abc"])]
    r = gold.hourly_orders(silver_rows(spark, rows)).first()
    assert r.gross_revenue == 20.009 and r.order_count == 8


def test_older_snapshot_does_not_touch_the_current_city(spark):
    import datetime as dt

    from orderlake.operators import scd2
    ts = lambda d: dt.datetime(2024, 1, d)
    dim = spark.createDataFrame([("c", "A", "m", ts(10), dt.date(2024, 1, 1), None, True, 1)], DIM_CUSTOMERS)
    snap = spark.createDataFrame([("c", "B", "m", ts(3))], "customer_id string, city string, device string, last_seen_at timestamp")
    got = scd2.scd2_apply(dim, snap, "2024-01-03").collect()
    assert [(r.city, r.is_current, r.last_seen_at) for r in got] == [("A", True, ts(10))]


def test_broken_dimension_is_reported(spark):
    import datetime as dt

    from orderlake.operators import scd2
    d = lambda n: dt.date(2024, 1, n)
    rows = [("ok", "A", None, None, d(1), d(3), False, 1), ("ok", "B", None, None, d(3), None, True, 2),
            ("gap", "A", None, None, d(1), d(2), False, 1), ("gap", "B", None, None, d(3), None, True, 2),
            ("two", "A", None, None, d(1), None, True, 1), ("zero", "A", None, None, d(1), d(1), False, 1)]
    got = {r.customer_id for r in scd2.dimension_violations(spark.createDataFrame(rows, DIM_CUSTOMERS)).collect()}
    assert got == {"gap", "zero"}


def test_gate_stops_on_an_empty_reconciliation(spark):
    from orderlake.operators import quality
    suite = spark.createDataFrame([("PASS",)], "overall_status string")
    recon = spark.createDataFrame([], "processing_date date, status string")
    assert quality.gate(suite, recon) == (False, ["recon: ERROR"])


def test_delivery_before_placement_is_pending_and_reported(spark):
    rows = [event("p", "ORDER_PLACED"), event("d", "ORDER_DELIVERED", occurred_at=T0 - 7_200_000)]
    s = silver_rows(spark, rows)
    assert [(r.delivery_status, r.delivery_hours, r.sla_met) for r in gold.fulfillment(s).collect()] == [("PENDING", None, False)]
    assert gold.sla_violations(s).first().delivery_hours == -2.0
