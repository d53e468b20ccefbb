"""Type-2 customer dimension: snapshot, apply, full history, as-of lookup, invariants.

Covers A5, D1-D8, J2, J4 and J5.  The tracked attribute is ``city``;
``device`` is type 1 (overwritten on the current row).  A snapshot city of
NULL means "no known city in the input" and never opens a version.

Scale notes: the snapshot and the daily history are partial aggregates, so
a customer with a huge share of events collapses to one row per day before
any window; windows are partitioned by customer over at most one row per
day, a bound set by the calendar, not by the event volume.  The as-of
lookup resolves distinct (customer, date) probes with a window instead of a
range join, so no (event × version) pairs are ever produced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake import config as C
from orderlake.schemas import DIM_CUSTOMERS

DIM_COLUMNS = DIM_CUSTOMERS.fieldNames()


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def _known(col: str) -> F.Column:
    return F.when(F.col(col).isNotNull() & (F.col(col) != C.UNKNOWN), F.col(col))


def _latest_known(col: str) -> F.Column:
    """Value of ``col`` on the latest event that has a known value (ties broken by event_id)."""
    order = F.when(_known(col).isNotNull(), F.struct(F.col("occurred_at"), F.col("event_id")))
    return F.max_by(_known(col), order)


def _latest_state(silver: DataFrame, *keys: str) -> DataFrame:
    # The aggregate sorts its rows; with a hash first, keys that begin alike ("CUST-1…") are not compared in full.
    return (
        silver.where(F.col("customer_id").isNotNull())
        .groupBy(F.xxhash64(*keys).alias("_h"), *keys)
        .agg(
            _latest_known("city").alias("city"),
            _latest_known("device").alias("device"),
            F.max(F.timestamp_millis(F.col("occurred_at"))).alias("last_seen_at"),
        )
        .drop("_h")
    )


def customer_snapshot(silver: DataFrame, effective_date=None) -> DataFrame:
    """A5: latest known city/device and last-seen time per customer.

    ``max_by`` over (occurred_at, event_id) replaces the unordered ``first``
    and skips UNKNOWN, so the snapshot is deterministic (SURVEY Q8).
    """
    snap = _latest_state(silver, "customer_id")
    if effective_date is not None:
        snap = snap.withColumn("effective_from", F.lit(_date(effective_date)))
    return snap


def empty_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_CUSTOMERS)


def scd2_apply(dim: DataFrame, snapshot: DataFrame, effective_date) -> DataFrame:
    """Apply one snapshot to the dimension as of ``effective_date``.

    One full outer join of the rows with the snapshot, current ones by key, decides, per
    key, between: keep (not in snapshot), refresh ``last_seen_at`` and the
    type-1 device (same city, D2), close and open a version (changed city,
    D3/D4), correct in place (changed city on the version's own first day),
    or insert (new key, D5; an empty ``dim`` is the initial load, D6).
    Only a snapshot that saw the customer after the current row's
    ``last_seen_at`` may change the city, so applying a snapshot twice equals
    applying it once and an older snapshot changes no city; what it knows
    belongs into the history, which ``scd2_history`` rebuilds (D7).
    """
    eff = F.lit(_date(effective_date))
    # Closed versions go through the same join without a partner, so that the dimension is computed or read once.
    versions = dim.where(F.col("is_current").isNotNull()).select(*[F.col(c).alias(f"d_{c}") for c in DIM_COLUMNS])
    snap = snapshot.select(
        F.col("customer_id").alias("s_customer_id"),
        F.col("city").alias("s_city"),
        F.col("device").alias("s_device"),
        F.col("last_seen_at").alias("s_last_seen_at"),
    )
    j = versions.join(snap, (F.col("d_customer_id") == F.col("s_customer_id")) & F.col("d_is_current"), "full_outer")

    in_dim, in_snap = F.col("d_customer_id").isNotNull(), F.col("s_customer_id").isNotNull()
    changed = (
        in_dim & in_snap & F.col("s_city").isNotNull()
        & ~F.col("s_city").eqNullSafe(F.col("d_city"))
        & (eff >= F.col("d_effective_from"))
        # A snapshot that saw the customer no later than the dimension did tells nothing about the current city.
        & F.coalesce(F.col("s_last_seen_at") > F.col("d_last_seen_at"), F.col("d_last_seen_at").isNull())
    )
    opens = changed & (eff > F.col("d_effective_from"))  # a new version; otherwise corrected in place
    seen = F.greatest(F.col("d_last_seen_at"), F.col("s_last_seen_at"))
    device = F.coalesce(F.col("s_device"), F.col("d_device"))

    def row(customer, city, dev, last_seen, frm, to, current, version):
        return F.struct(
            customer.alias("customer_id"), city.alias("city"), dev.alias("device"),
            last_seen.alias("last_seen_at"), frm.alias("effective_from"), to.cast("date").alias("effective_to"),
            current.alias("is_current"), version.cast("int").alias("dim_version"),
        )

    kept = row(F.col("d_customer_id"), F.col("d_city"), F.col("d_device"), F.col("d_last_seen_at"),
               F.col("d_effective_from"), F.col("d_effective_to"), F.col("d_is_current"), F.col("d_dim_version"))
    refreshed = row(F.col("d_customer_id"),
                    F.when(changed, F.col("s_city")).otherwise(F.col("d_city")),
                    device, seen, F.col("d_effective_from"), F.col("d_effective_to"), F.lit(True),
                    F.col("d_dim_version"))
    closed = row(F.col("d_customer_id"), F.col("d_city"), F.col("d_device"), F.col("d_last_seen_at"),
                 F.col("d_effective_from"), eff, F.lit(False), F.col("d_dim_version"))
    opened = row(F.col("d_customer_id"), F.col("s_city"), device, seen, eff, F.lit(None), F.lit(True),
                 F.col("d_dim_version") + 1)
    inserted = row(F.col("s_customer_id"), F.coalesce(F.col("s_city"), F.lit(C.UNKNOWN)), F.col("s_device"),
                   F.col("s_last_seen_at"), eff, F.lit(None), F.lit(True), F.lit(1))

    actions = (
        F.when(~in_snap, F.array(kept))
        .when(~in_dim, F.array(inserted))
        .when(opens, F.array(closed, opened))
        .otherwise(F.array(refreshed))
    )
    return j.select(F.inline(actions))


def daily_customer_state(silver: DataFrame) -> DataFrame:
    """Latest known city/device per (customer, day) — a partial aggregate."""
    return _latest_state(silver, "customer_id", "event_date")


def snapshot_from_days(days: DataFrame) -> DataFrame:
    """A5 from the daily customer states (:func:`daily_customer_state`): days follow the event times, so the
    latest day with a known value holds the latest known one."""
    at = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("event_date"))).alias(c)
    return days.groupBy("customer_id").agg(at("city"), at("device"), F.max("last_seen_at").alias("last_seen_at"))


def scd2_history(silver: DataFrame) -> DataFrame:
    """The full dimension rebuilt from all events (backfill).

    Versions start on the first day a customer's known city differs from
    the previous known city; days without a known city carry the previous
    one (or UNKNOWN before any is known).
    """
    return history_from_days(daily_customer_state(silver))


def history_from_days(days: DataFrame) -> DataFrame:
    """D7 from the daily customer states (:func:`daily_customer_state`), however they are stored."""
    by_day = Window.partitionBy("customer_id").orderBy("event_date")
    carried = days.withColumn(
        "city",
        F.coalesce(F.last("city", ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, 0)),
                   F.lit(C.UNKNOWN)),
    )
    flagged = carried.withColumn(
        "_chg", F.when(F.lag("city").over(by_day).eqNullSafe(F.col("city")), F.lit(0)).otherwise(F.lit(1))
    ).withColumn("dim_version", F.sum("_chg").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    versions = flagged.groupBy("customer_id", "dim_version").agg(
        F.first("city").alias("city"),
        F.max_by(F.col("device"), F.when(F.col("device").isNotNull(), F.col("event_date"))).alias("device"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.min("event_date").alias("effective_from"),
    )
    by_version = Window.partitionBy("customer_id").orderBy("dim_version")
    nxt = F.lead("effective_from").over(by_version)
    return versions.select(
        "customer_id", "city", "device", "last_seen_at", "effective_from",
        nxt.alias("effective_to"), nxt.isNull().alias("is_current"), "dim_version",
    )


def city_as_of(events: DataFrame, dim: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Each event with the customer's city and dimension version as of its date.

    Distinct (customer, date) probes are merged with the versions in one
    ordered stream per customer; the last version at or before each probe
    is carried forward with ``last(..., ignorenulls)``.  The resolved probes
    join back on (customer, date), an equi-join that adaptive execution can
    split when one customer dominates.
    """
    probes = events.where(F.col("customer_id").isNotNull()).select(
        "customer_id", F.col(date_col).alias("_d")).distinct()
    stream = probes.select("customer_id", "_d", F.lit(1).alias("_kind"), F.lit(None).cast("struct<city:string,v:int>").alias("_ver")).unionByName(
        dim.select("customer_id", F.col("effective_from").alias("_d"), F.lit(0).alias("_kind"),
                   F.struct(F.col("city").alias("city"), F.col("dim_version").alias("v")).alias("_ver"))
    )
    w = Window.partitionBy("customer_id").orderBy("_d", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    resolved = (
        stream.withColumn("_at", F.last("_ver", ignorenulls=True).over(w))
        .where(F.col("_kind") == 1)
        .select("customer_id", F.col("_d").alias(date_col),
                F.col("_at.city").alias("city_at_event"), F.col("_at.v").alias("dim_version_at_event"))
    )
    return events.join(resolved, ["customer_id", date_col], "left")


def dimension_violations(dim: DataFrame) -> DataFrame:
    """Customers breaking the invariants — not exactly one current row,
    zero-length or overlapping versions, or gaps between consecutive versions."""
    w = Window.partitionBy("customer_id").orderBy("effective_from", "dim_version")
    nxt = F.lead("effective_from").over(w)
    per_row = dim.select(
        "customer_id", "is_current",
        F.when(F.col("effective_to").isNotNull() & (F.col("effective_to") <= F.col("effective_from")), 1)
        .otherwise(0).alias("zero_length"),
        F.when(nxt.isNotNull() & (F.col("effective_to").isNull() | (F.col("effective_to") != nxt)), 1)
        .otherwise(0).alias("bad_link"),
    )
    return (
        per_row.groupBy("customer_id")
        .agg(
            F.count_if(F.col("is_current")).alias("current_rows"),
            F.sum("zero_length").alias("zero_length_versions"),
            F.sum("bad_link").alias("overlaps_or_gaps"),
        )
        .where((F.col("current_rows") != 1) | (F.col("zero_length_versions") > 0) | (F.col("overlaps_or_gaps") > 0))
    )
