"""Bronze ingest: parse, enrich, validate, route and duplicate tagging.

Covers P1-P4, V1-V5, W1, S3 and S19.  All functions are lazy and
side-effect free; ``bronze_split`` returns the two outputs of one
micro-batch (or one daily batch) without forcing an action.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import config as C
from orderlake.functions.columns import millis_to_date_string, nonblank
from orderlake.functions.joins import join_back, per_key_for_join
from orderlake.schemas import ORDER_EVENT, ORDER_EVENT_PARSE

_EVENT_COLS = [f.name for f in ORDER_EVENT.fields]


def kafka_to_strings(raw: DataFrame) -> DataFrame:
    """Binary Kafka columns to strings (no-op on string columns)."""
    return raw.select(
        *[
            F.col(c).cast("string").alias(c) if c in ("key", "value", "partition", "offset") else F.col(c)
            for c in raw.columns
        ]
    )


def parse_messages(raw: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Parse the JSON value against ORDER_EVENT and flatten it.

    Carries Kafka partition/offset and the raw text (kept for the dead-letter
    table); ``malformed`` marks values that are not parsable JSON objects.

    The parsed struct is flattened through a generator (``inline`` of a
    one-element array).  Filters on the parsed fields cannot be pushed below
    a generator, so each message is parsed exactly once; flattening with a
    projection lets predicate pushdown copy ``from_json`` into every
    predicate that references a field (about ten parses per row).

    The value comes out of a generator too.  ``from_json`` generates no code
    for what stands inside it: a value that is computed (the fixture's JSON)
    would be merged into it and evaluated expression by expression.
    """
    carry = list(carry or [])
    raw = raw.select(F.explode(F.array(F.col("value").cast("string"))).alias("value"), "partition", "offset", *carry)
    parsed = F.from_json(
        F.col("value"),
        ORDER_EVENT_PARSE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    fields = [F.col(f"_m.{c}").alias(c) for c in _EVENT_COLS]
    one = F.struct(
        *fields,
        (F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull()).alias("malformed"),
    )
    return raw.select(
        parsed.alias("_m"),
        F.col("partition").cast("string").alias("kafka_partition"),
        F.col("offset").cast("string").alias("kafka_offset"),
        "value",
        *carry,
    ).select(
        F.inline(F.array(one)),
        "kafka_partition",
        "kafka_offset",
        "value",
        *carry,
    ).select(*_EVENT_COLS, "kafka_partition", "kafka_offset", "value", *carry, "malformed")


def enrich(df: DataFrame, loaded_at_ms: int | None = None) -> DataFrame:
    """Pipeline version, load millis (job layer) and the partition date."""
    loaded = F.lit(loaded_at_ms).cast("long") if loaded_at_ms is not None else F.unix_millis(F.current_timestamp())
    return df.select(
        "*",
        F.lit(C.PIPELINE_VERSION).alias("pipeline_version"),
        loaded.alias("bronze_loaded_at"),
        F.when(_time_ok(), millis_to_date_string("occurred_at")).alias("ingestion_date"),
    )


def _time_ok() -> Column:
    """The event time is there and lies in the range that dates and partitions can hold."""
    t = F.col("occurred_at")
    return F.coalesce((t >= F.lit(C.MIN_EVENT_MS)) & (t < F.lit(C.MAX_EVENT_MS)), F.lit(False))


def _required_ok() -> Column:
    return reduce(lambda a, b: a & b, [nonblank(f) for f in C.REQUIRED_FIELDS])


def _type_ok() -> Column:
    return F.coalesce(F.col("event_type").isin(C.VALID_EVENT_TYPES), F.lit(False))


def failure_reason(malformed: Column | None = None) -> Column:
    """V2: first matching reason; unparsable text gets its own reason, as do event times
    that are missing or out of range (Bronze is partitioned by the event date)."""
    chain = F.when(malformed, F.lit("malformed_json")) if malformed is not None else None
    req, typ = _required_ok(), _type_ok()
    chain = (chain.when(~req, F.lit("missing_required_fields")) if chain is not None
             else F.when(~req, F.lit("missing_required_fields")))
    return (
        chain.when(~typ, F.lit("invalid_event_type"))
        .when(F.col("occurred_at").isNull(), F.lit("missing_event_time"))
        .when(~_time_ok(), F.lit("invalid_event_time"))
        .otherwise(F.lit("unknown"))
    )


def with_validation(df: DataFrame) -> DataFrame:
    """V1/V2 in one projection: ``is_valid`` plus ``validation_failure`` (NULL when valid)."""
    malformed = F.coalesce(F.col("malformed"), F.lit(False)) if "malformed" in df.columns else None
    ok = _required_ok() & _type_ok() & _time_ok()
    if malformed is not None:
        ok = ok & ~malformed
    return df.select("*", ok.alias("is_valid")).withColumn(
        "validation_failure", F.when(~F.col("is_valid"), failure_reason(malformed))
    )


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V1: split into (valid, invalid); invalid rows carry ``validation_failure``."""
    tagged = with_validation(df)
    valid = tagged.where("is_valid").drop("is_valid", "validation_failure")
    invalid = tagged.where(~F.col("is_valid")).drop("is_valid")
    return valid, invalid


def _arrival_order() -> Column:
    # Total order of copies: arrival time, then Kafka partition and offset as numbers.
    return F.struct(
        F.col("ingested_at").alias("a"),
        F.col("kafka_partition").cast("long").alias("p"),
        F.col("kafka_offset").cast("long").alias("o"),
    )


def tag_duplicates(df: DataFrame, key: str | list[str] = "event_id") -> DataFrame:
    """``is_duplicate`` = "true" for every copy of a key but the first to arrive.

    Written as a partial aggregate (first arrival per key, combined
    map-side) joined back on the key instead of a row_number window, whose
    partitions cannot be split: a replay storm can make one group of copies
    a large share of all rows.  The aggregate is shaped so that the join
    back is eligible for adaptive skew handling (see ``per_key_for_join``).
    Copies with the same (partition, offset) are the same Kafka record and
    are all first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    firsts = per_key_for_join(df, keys, F.min(_arrival_order()).alias("_first"))
    return (
        join_back(df, firsts, keys)
        .withColumn(
            "is_duplicate",
            F.when(_arrival_order().eqNullSafe(F.col("_first")), F.lit("false")).otherwise(F.lit("true")),
        )
        .drop("_first")
        .select(*df.columns, "is_duplicate")
    )


def tag_duplicates_where(df: DataFrame, wanted: Column, key: str | list[str] = "event_id") -> DataFrame:
    """The rows of ``tag_duplicates(df)`` that meet ``wanted``, for scans of a small part.

    A copy elsewhere may be the first, so every copy of the wanted rows' keys
    is looked at; all other rows leave by a semi join (broadcast if the keys
    are few) before anything is aggregated or sorted.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ids = df.where(wanted).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return tag_duplicates(df.join(ids, same, "left_semi"), key).where(wanted)


def first_copies(df: DataFrame, key: str | list[str] = "event_id", columns: list[str] | None = None) -> DataFrame:
    """One row per key: the copy that arrived first (the rows ``tag_duplicates`` marks "false").

    A single aggregate — ``min_by`` of the whole row by arrival order —
    with no join back, so the input is read once and copies of a hot key
    are combined map-side before the shuffle.  This is the Silver-side form
    of duplicate handling; Bronze keeps every copy with its tag.

    With ``columns`` the rows have these only.  The optimizer can't see into
    the struct, so what is not named here is sorted and shuffled; the keys
    stay outside it.  A hash of the keys comes first: the aggregate sorts its
    rows, and keys that begin alike ("E-1…") would be compared in full.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = columns or df.columns
    rest = [c for c in columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(True)
    firsts = df.groupBy(F.xxhash64(*keys).alias("_h"), *keys).agg(F.min_by(row, _arrival_order()).alias("_r"))
    return firsts.select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in columns])


def bronze_split(raw: DataFrame, loaded_at_ms: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse → enrich → validate → tag: (Bronze rows, dead-letter rows) of one batch."""
    enriched = enrich(parse_messages(raw), loaded_at_ms)
    valid, invalid = validate(enriched)
    bronze = tag_duplicates(valid.drop("value", "malformed"))
    dlq = invalid.drop("malformed")
    return bronze, dlq


def non_duplicates(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("is_duplicate") == "false")


# ---------------------------------------------------------------------------
# Producer-side checks and routing
# ---------------------------------------------------------------------------


def producer_check(df: DataFrame) -> DataFrame:
    """V3: producer validation as columns ``producer_valid`` and ``producer_reason``.

    Missing keys are listed sorted (the original printed an unordered set).
    """
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in C.PRODUCER_REQUIRED_KEYS])
    reason = (
        F.when(missing != "", F.concat(F.lit("Missing fields: "), missing))
        .when(F.col("event_id") == "", F.lit("event_id is empty"))
        .otherwise(F.lit(""))
    )
    return df.select("*", (reason == "").alias("producer_valid"), reason.alias("producer_reason"))


def route(df: DataFrame, topic: str = C.ORDERS_TOPIC) -> DataFrame:
    """V5: target topic per event (valid → topic, invalid → dead-letter topic)."""
    checked = producer_check(df) if "producer_valid" not in df.columns else df
    return checked.withColumn(
        "target_topic", F.when(F.col("producer_valid"), F.lit(topic)).otherwise(F.lit(C.DLQ_TOPIC))
    )


def dlq_envelope(df: DataFrame, failed_at_ms: int, topic: str = C.ORDERS_TOPIC) -> DataFrame:
    """V4: producer dead-letter envelope for rejected events, keyed by event_id or ``unknown``."""
    rejected = route(df, topic).where(~F.col("producer_valid"))
    # The text as it came, where it is carried: a message that isn't JSON has no fields to encode again.
    encoded = F.to_json(F.struct(*[F.col(c) for c in _EVENT_COLS]))
    original = F.coalesce(F.col("value"), encoded) if "value" in df.columns else encoded
    return rejected.select(
        F.coalesce(F.col("event_id"), F.lit("unknown")).alias("key"),
        original.alias("original_event"),
        F.col("producer_reason").alias("failure_reason"),
        F.lit(topic).alias("source_topic"),
        F.lit(int(failed_at_ms)).cast("long").alias("failed_at"),
    )


def keyed_publish(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Publishable rows keyed by order_id (fallback event_id), JSON value.

    With ``num_partitions`` the batch is laid out like the topic: hash
    partitioned by key and ordered by occurrence inside each partition, which
    keeps every order's events together and in order.
    """
    out = df.select(
        F.coalesce("order_id", "event_id").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in _EVENT_COLS])).alias("value"),
        "occurred_at",
    )
    if num_partitions:
        out = out.repartition(num_partitions, "key").sortWithinPartitions("key", "occurred_at")
    return out


def sample_messages(parsed: DataFrame, n: int = C.SAMPLE_MESSAGES) -> DataFrame:
    """S3: the first ``n`` messages from the earliest offsets, projected for inspection.

    A top-k (``TakeOrderedAndProject``): each task keeps its best ``n``.
    Pass messages parsed with ``carry=["key"]`` to report the Kafka key.
    """
    key = F.col("key") if "key" in parsed.columns else F.coalesce("order_id", "event_id")
    return (
        parsed.select(
            F.col("kafka_partition").cast("int").alias("partition"),
            F.col("kafka_offset").cast("long").alias("offset"),
            key.alias("key"),
            "event_type",
            "order_id",
        )
        .orderBy("offset", "partition")
        .limit(n)
    )
