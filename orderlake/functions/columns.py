"""Scalar column helpers.

Dates and hours are derived from epoch milliseconds arithmetically, so
results do not depend on the session time zone (the platform's epoch
values are UTC).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.config import MAX_NUMBER, MS_PER_DAY, MS_PER_HOUR, UNKNOWN

__all__ = [
    "millis_to_timestamp",
    "millis_to_date",
    "millis_to_hour",
    "millis_to_date_string",
    "ntz_to_millis",
    "payload_str",
    "payload_double",
    "payload_int",
    "lateness_seconds",
    "is_late",
    "nonblank",
    "pct",
    "safe_div",
    "money",
    "money_sum",
    "money_avg",
]


def millis_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


def millis_to_date(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_from_unix_date(((c - F.pmod(c, F.lit(MS_PER_DAY))) / F.lit(MS_PER_DAY)).cast("int"))


def millis_to_hour(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(F.pmod(c, F.lit(MS_PER_DAY)) / F.lit(MS_PER_HOUR)).cast("int")


def millis_to_date_string(c: Column | str) -> Column:
    """``yyyy-MM-dd`` of an epoch-millis column (Bronze partition value)."""
    return millis_to_date(c).cast("string")


def ntz_to_millis(c: Column | str) -> Column:
    """Epoch millis of a ``timestamp_ntz`` read as UTC wall time, zone-free."""
    c = F.col(c) if isinstance(c, str) else c
    return (
        F.unix_date(F.to_date(c)).cast("long") * F.lit(MS_PER_DAY)
        + F.hour(c).cast("long") * F.lit(MS_PER_HOUR)
        + F.minute(c).cast("long") * F.lit(60_000)
        + F.floor(F.second(c) * F.lit(1000)).cast("long")
    )


def payload_str(key: str, default: str | None = UNKNOWN, payload: str = "payload") -> Column:
    """Map lookup with a default (a missing key gives NULL, also under ANSI)."""
    v = F.col(payload).getItem(key)
    return v if default is None else F.coalesce(v, F.lit(default))


def payload_double(key: str, default: float = 0.0, payload: str = "payload") -> Column:
    """Lenient numeric: text that is no number, not finite or out of range becomes the default."""
    value = F.col(payload).getItem(key).try_cast("double")
    # NaN sorts above every number, so it fails the range test too.
    return F.when(F.abs(value) < F.lit(MAX_NUMBER), value).otherwise(F.lit(float(default)))


def payload_int(key: str, default: int = 0, payload: str = "payload") -> Column:
    """Integer through double so that ``"2.7"`` truncates to 2 like a legacy cast."""
    return F.coalesce(payload_double(key, default, payload).try_cast("int"), F.lit(int(default)))


def lateness_seconds(ingested: str = "ingested_at", occurred: str = "occurred_at") -> Column:
    return (F.col(ingested) - F.col(occurred)) / F.lit(1000.0)


def is_late(tolerance_seconds: int, ingested: str = "ingested_at", occurred: str = "occurred_at") -> Column:
    return lateness_seconds(ingested, occurred) > F.lit(tolerance_seconds)


def nonblank(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != F.lit(""))


def safe_div(num: Column, den: Column) -> Column:
    """num / max(den, 1) — the platform's guard against empty inputs."""
    return num / F.greatest(den, F.lit(1))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return F.round(safe_div(num, den) * F.lit(100.0), digits)


def money(c: Column | str) -> Column:
    """The amount as a decimal with six places, the unit of all money sums."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,6)")


def money_sum(c: Column | str) -> Column:
    """Sum of a money column, exact to six places: the result does not depend on the
    order in which partial sums meet after a shuffle, so reruns are bit-identical."""
    return F.sum(money(c)).cast("double")


def money_avg(c: Column | str) -> Column:
    """Average of a money column from the exact sum (NULLs ignored like ``avg``)."""
    return money_sum(c) / F.count(F.col(c) if isinstance(c, str) else c)
