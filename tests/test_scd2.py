"""Type-2 dimension: properties (hypothesis) and a brute-force check of the full history."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.operators import scd2
from orderlake.schemas import DIM_CUSTOMERS

DAY0 = dt.date(2024, 1, 1)
SNAP = "customer_id string, city string, device string, last_seen_at timestamp"


def snap(spark, rows):
    return spark.createDataFrame(
        [(c, city, dev, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for c, city, dev, h in rows], SNAP)


def as_set(df):
    return sorted(tuple(r) for r in df.select(*DIM_CUSTOMERS.fieldNames()).collect())


cities = st.sampled_from(["A", "B", "C", None])
snap_rows = st.lists(st.tuples(st.sampled_from(["c1", "c2", "c3"]), cities, st.sampled_from(["ios", "web"]),
                               st.integers(0, 1000)), min_size=1, max_size=6, unique_by=lambda r: r[0])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=snap_rows, second=snap_rows, gap=st.integers(1, 30))
def test_apply_is_idempotent_and_valid(spark, first, second, gap):
    dim = scd2.scd2_apply(scd2.empty_dimension(spark), snap(spark, first), DAY0)
    day = DAY0 + dt.timedelta(days=gap)
    once = scd2.scd2_apply(dim, snap(spark, second), day).cache()
    twice = scd2.scd2_apply(once, snap(spark, second), day)
    assert as_set(once) == as_set(twice)
    assert scd2.dimension_violations(once).count() == 0
    # an older snapshot never opens a version
    older = scd2.scd2_apply(once, snap(spark, second), DAY0 - dt.timedelta(days=1))
    assert older.count() == once.count()
    once.unpersist()


def test_change_closes_and_opens(spark):
    dim = scd2.scd2_apply(scd2.empty_dimension(spark), snap(spark, [("c1", "A", "ios", 1), ("c2", None, "web", 1)]), DAY0)
    rows = {r.customer_id: r for r in dim.collect()}
    assert rows["c1"].city == "A" and rows["c2"].city == "UNKNOWN" and rows["c1"].dim_version == 1
    day = DAY0 + dt.timedelta(days=3)
    nxt = scd2.scd2_apply(dim, snap(spark, [("c1", "B", "web", 80), ("c2", None, "ios", 90)]), day)
    c1 = sorted((r.dim_version, r.city, r.is_current, r.effective_to) for r in nxt.where("customer_id='c1'").collect())
    assert c1 == [(1, "A", False, day), (2, "B", True, None)]
    c2 = nxt.where("customer_id='c2'").collect()
    assert len(c2) == 1 and c2[0].device == "ios"  # type-1 attribute updated in place, no new version


def brute_force_history(rows):
    """Plain-Python twin of D7 over (customer, date, occurred, event_id, city) tuples."""
    by_cust = {}
    for c, d, occ, eid, city in rows:
        by_cust.setdefault(c, {}).setdefault(d, []).append((occ, eid, city))
    out = []
    for c, days in by_cust.items():
        prev, versions = None, []
        for d in sorted(days):
            known = [e for e in days[d] if e[2] not in (None, "UNKNOWN")]
            city = max(known)[2] if known else prev
            city = city or "UNKNOWN"
            if city != prev:
                versions.append([d, city])
            prev = city
        for i, (d, city) in enumerate(versions):
            to = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((c, city, d, to, i + 1))
    return sorted(out, key=str)


def test_full_history_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        c = f"c{rnd.randint(1, 12)}"
        d = DAY0 + dt.timedelta(days=rnd.randint(0, 40))
        occ = int(dt.datetime.combine(d, dt.time()).replace(tzinfo=dt.timezone.utc).timestamp() * 1000) + rnd.randint(0, 86_399_999)
        rows.append((c, d, occ, f"e{i}", rnd.choice(["A", "B", "UNKNOWN", None])))
    df = spark.createDataFrame(rows, "customer_id string, event_date date, occurred_at long, event_id string, city string") \
        .withColumn("device", F.lit("web"))
    got = sorted(((r.customer_id, r.city, r.effective_from, r.effective_to, r.dim_version)
                  for r in scd2.scd2_history(df).collect()), key=str)
    assert got == brute_force_history(rows)


def test_as_of_lookup_matches_range_join(spark):
    dim = spark.createDataFrame(
        [("c1", "A", None, None, DAY0, DAY0 + dt.timedelta(days=5), False, 1),
         ("c1", "B", None, None, DAY0 + dt.timedelta(days=5), None, True, 2)], DIM_CUSTOMERS)
    ev = spark.createDataFrame([("e1", "c1", DAY0 - dt.timedelta(days=1)), ("e2", "c1", DAY0),
                                ("e3", "c1", DAY0 + dt.timedelta(days=5)), ("e4", "c2", DAY0)],
                               "event_id string, customer_id string, event_date date")
    got = {r.event_id: (r.city_at_event, r.dim_version_at_event) for r in scd2.city_as_of(ev, dim).collect()}
    assert got == {"e1": (None, None), "e2": ("A", 1), "e3": ("B", 2), "e4": (None, None)}


def test_snapshot_from_days_equals_the_snapshot_of_the_events(spark):
    day = 86_400_000
    rows = [(f"E-{i:03}", f"CUST-{i % 4}" if i % 9 else None, (i * 7 % 5) * day + i % 3, ["A", "B", None, "UNKNOWN"][i * i % 4], ["m", None, "UNKNOWN"][i % 3])
            for i in range(120)] + [("X-1", "CUST-dark", day, None, None)]
    events = spark.createDataFrame(rows, "event_id string, customer_id string, occurred_at long, city string, device string")
    events = events.withColumn("event_date", F.date_from_unix_date((F.col("occurred_at") / day).cast("int")))
    want, got = scd2.customer_snapshot(events), scd2.snapshot_from_days(scd2.daily_customer_state(events))
    assert got.columns == want.columns and want.count() == 5
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_apply_keeps_closed_versions_and_drops_rows_of_unknown_state(spark):
    d = dt.date
    seen = dt.datetime(2024, 1, 1)
    dim = spark.createDataFrame(
        [("c1", "A", "m", seen, d(2024, 1, 1), d(2024, 1, 3), False, 1), ("c1", "B", "m", seen, d(2024, 1, 3), None, True, 2),
         ("c2", "A", "m", seen, d(2024, 1, 1), d(2024, 1, 2), False, 1), (None, "Z", "m", seen, d(2024, 1, 1), None, True, 1),
         ("c3", "A", "m", seen, d(2024, 1, 1), None, None, 1)],
        "customer_id string, city string, device string, last_seen_at timestamp, effective_from date, effective_to date, is_current boolean, dim_version int")
    snapshot = spark.createDataFrame([("c1", "C", "w", dt.datetime(2024, 1, 5)), ("c2", "D", "w", dt.datetime(2024, 1, 5))],
                                     "customer_id string, city string, device string, last_seen_at timestamp")
    got = scd2.scd2_apply(dim, snapshot, "2024-01-05").collect()
    assert sorted((r.customer_id or "", r.city, r.effective_to, r.is_current, r.dim_version) for r in got) == [
        ("", "Z", None, True, 1), ("c1", "A", d(2024, 1, 3), False, 1), ("c1", "B", d(2024, 1, 5), False, 2),
        ("c1", "C", None, True, 3), ("c2", "A", d(2024, 1, 2), False, 1), ("c2", "D", None, True, 1)]
