"""SQL twins of the fixture and of the Bronze/Silver chain, for the DuckDB oracle.

These CTEs restate, in ANSI SQL over the driver's tables, what the Spark
operators compute; queries in ``oracle.py`` select from them.  Dates are
rendered ``yyyy-MM-dd`` and doubles rounded to 4 places on both sides.
"""

from orderlake import config as C

_TYPES = ", ".join(f"'{t}'" for t in C.VALID_EVENT_TYPES)
_GATEWAYS = ", ".join(f"'{g}'" for g in C.GATEWAYS)

LIFECYCLE = """
lc AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         epoch_ms(o.o_orderdate) AS base_ms, c.c_mktsegment, n.n_name AS city_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON n.n_nationkey = (c.c_nationkey + year(o.o_orderdate)) % 25
),
st AS (
  SELECT lc.*, s.step, s.copy
  FROM lc, (VALUES (0, 0), (0, 1), (1, 0), (2, 0), (3, 0)) s(step, copy)
  WHERE (s.copy = 0 OR lc.k % 50 = 0) AND (s.step < 3 OR lc.o_orderstatus = 'F')
),
st2 AS (
  SELECT *, base_ms + (k % 24) * 3600000
            + CASE step WHEN 0 THEN 0 WHEN 1 THEN 60000 WHEN 2 THEN 120000
                        ELSE CASE WHEN k % 89 = 0 THEN -7200000 ELSE ((k * 7) % 96) * 3600000 END END AS occ,
         CASE WHEN step = 1 AND k % 103 = 0 THEN 1000 WHEN step = 1 AND k % 107 = 0 THEN 1000000 ELSE 1 END AS unit,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM st
),
events AS (
  SELECT
    'E-' || k || '-' || step AS event_id,
    CASE step WHEN 0 THEN 'ORDER_PLACED'
              WHEN 1 THEN CASE WHEN k % 53 = 0 THEN 'PAYMENT_PENDING' ELSE 'PAYMENT_INITIATED' END
              WHEN 2 THEN CASE WHEN o_orderstatus = 'P' THEN 'PAYMENT_FAILED' ELSE 'PAYMENT_SUCCESS' END
              ELSE 'ORDER_DELIVERED' END AS event_type,
    CASE WHEN step = 0 AND k % 67 = 0 THEN NULL ELSE 'ORD-' || k END AS order_id,
    'CUST-' || o_custkey AS customer_id,
    occ * unit AS occurred_at,
    occ + copy * 10000 + CASE WHEN k % 59 = 0 THEN 10800000 ELSE 0 END AS ingested_at,
    CASE WHEN k % 71 = 0 THEN '2.0' ELSE '1.0' END AS schema_version,
    'order-service' AS source_system,
    CASE WHEN k % 31 <> 0 THEN city_name END AS p_city,
    o_orderpriority AS p_category,
    CASE WHEN k % 97 = 0 THEN 'abc' WHEN k % 109 = 0 THEN 'NaN' WHEN k % 113 = 0 THEN 'Infinity' WHEN k % 127 = 0 THEN '1e300'
         ELSE CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
              || CASE WHEN k % 61 = 0 THEN '5' ELSE '' END END AS p_amount,
    CAST((k % 5) + 1 AS VARCHAR) || CASE WHEN k % 43 = 0 THEN '.7' ELSE '' END AS p_item_count,
    CAST((k % 5) * 5 AS VARCHAR) AS p_discount_pct,
    c_mktsegment AS p_device,
    CAST(400000 + k % 100000 AS VARCHAR) AS p_pincode,
    CASE WHEN step IN (1, 2) THEN [GATEWAYS][k % 4 + 1] END AS p_gateway,
    CASE WHEN k % 71 = 0 THEN CAST(k % 1000 AS VARCHAR) END AS p_loyalty_points,
    CAST(k % 8 AS VARCHAR) AS kafka_partition,
    CAST(k * 8 + step * 2 + copy AS VARCHAR) AS kafka_offset,
    (step = 1 AND k % 101 = 0) AS malformed
  FROM st2
)""".replace("GATEWAYS", _GATEWAYS)

_FIELDS = ["event_id", "event_type", "order_id", "customer_id", "occurred_at", "ingested_at",
           "schema_version", "source_system", "p_city", "p_category", "p_amount", "p_item_count",
           "p_discount_pct", "p_device", "p_pincode", "p_gateway", "p_loyalty_points"]

_REQ = " AND ".join(f"({c} IS NOT NULL AND {c} <> '')" for c in C.REQUIRED_FIELDS)

_TIMED = f"coalesce(occurred_at >= {C.MIN_EVENT_MS} AND occurred_at < {C.MAX_EVENT_MS}, false)"
# A payload number that is finite and in range.
NUMBER = f"CASE WHEN abs(try_cast({{0}} AS DOUBLE)) < {C.MAX_NUMBER:.0f} THEN try_cast({{0}} AS DOUBLE) ELSE 0.0 END"

PARSED = (
    "parsed AS (\n  SELECT "
    + ",\n    ".join(f"CASE WHEN malformed THEN NULL ELSE {c} END AS {c}" for c in _FIELDS)
    + ",\n    kafka_partition, kafka_offset, malformed, ingested_at AS kafka_ts\n  FROM events\n),\n"
    + "validated AS (\n  SELECT *,\n"
    + f"    (NOT malformed AND {_REQ} AND event_type IN ({_TYPES}) AND {_TIMED}) AS is_valid,\n"
    + f"    CASE WHEN malformed THEN 'malformed_json' WHEN NOT ({_REQ}) THEN 'missing_required_fields'\n"
    + f"         WHEN NOT coalesce(event_type IN ({_TYPES}), false) THEN 'invalid_event_type'\n"
    + "         WHEN occurred_at IS NULL THEN 'missing_event_time'\n"
    + f"         WHEN NOT ({_TIMED}) THEN 'invalid_event_time' ELSE 'unknown' END AS reason,\n"
    + f"    CASE WHEN {_TIMED} THEN strftime(CAST(epoch_ms(occurred_at) AS DATE), '%Y-%m-%d') END AS ingestion_date\n"
    + "  FROM parsed\n)"
)

BRONZE = """
bronze AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY event_id ORDER BY ingested_at,
                 CAST(kafka_partition AS BIGINT), CAST(kafka_offset AS BIGINT)) > 1
            THEN 'true' ELSE 'false' END AS is_duplicate
  FROM validated WHERE is_valid
),
dlq AS (SELECT * FROM validated WHERE NOT is_valid)"""

SILVER = f"""
silver AS (
  SELECT event_id, event_type, order_id, customer_id, occurred_at, ingested_at, schema_version,
         source_system, '1.0.0' AS pipeline_version, ingestion_date,
         CAST(epoch_ms(occurred_at) AS DATE) AS event_date,
         CAST(hour(epoch_ms(occurred_at)) AS INTEGER) AS event_hour,
         coalesce(p_city, 'UNKNOWN') AS city,
         coalesce(p_category, 'UNKNOWN') AS category,
         CAST({NUMBER.format('p_amount')} AS DOUBLE) AS amount,
         coalesce(CAST(trunc(try_cast(p_item_count AS DOUBLE)) AS INTEGER), 0) AS item_count,
         coalesce(try_cast(p_discount_pct AS DOUBLE), 0.0) AS discount_pct,
         coalesce(p_device, 'UNKNOWN') AS device,
         p_pincode AS pincode,
         CAST(epoch_ms(occurred_at) AS DATE) AS processing_date,
         p_gateway AS gateway,
         CAST(CAST({NUMBER.format('p_amount')} AS DOUBLE) AS DECIMAL(38,6)) AS money
  FROM bronze WHERE is_duplicate = 'false'
)"""

GOLD = """
hourly AS (
  SELECT event_date, event_hour, city, category, count(*) AS order_count,
         CAST(sum(money) AS DOUBLE) AS gross_revenue,
         CAST(sum(money) AS DOUBLE) / count(*) AS avg_order_value,
         CAST(sum(item_count) AS BIGINT) AS total_items,
         count(DISTINCT customer_id) AS unique_customers, avg(discount_pct) AS avg_discount_pct
  FROM silver WHERE event_type = 'ORDER_PLACED'
  GROUP BY event_date, event_hour, city, category
),
placed AS (
  SELECT order_id, customer_id, city, occurred_at AS placed_ms, event_date AS placed_date
  FROM silver WHERE event_type = 'ORDER_PLACED'
),
started AS (SELECT order_id, min(placed_ms) AS started_ms FROM placed GROUP BY order_id),
delivered AS (
  SELECT s.order_id, min(occurred_at) AS delivered_ms FROM silver s JOIN started t ON t.order_id = s.order_id
  WHERE event_type = 'ORDER_DELIVERED' AND occurred_at >= started_ms GROUP BY s.order_id
),
fulfil AS (
  SELECT p.*, d.delivered_ms, (d.delivered_ms - p.placed_ms) / 3600000.0 AS delivery_hours,
         CASE WHEN d.delivered_ms IS NULL THEN 'PENDING'
              WHEN (d.delivered_ms - p.placed_ms) / 3600000.0 <= 48 THEN 'ON_TIME' ELSE 'LATE' END AS delivery_status
  FROM placed p LEFT JOIN delivered d ON p.order_id = d.order_id AND d.delivered_ms >= p.placed_ms
),
sla AS (
  SELECT placed_date AS event_date, city, delivery_status, count(*) AS order_count,
         avg(delivery_hours) AS avg_delivery_hours
  FROM fulfil GROUP BY placed_date, city, delivery_status
),
payments AS (
  SELECT event_date, event_type, count(*) AS event_count, CAST(sum(money) AS DOUBLE) AS total_amount,
         CAST(sum(money) AS DOUBLE) / count(*) AS avg_amount
  FROM silver WHERE event_type IN ('PAYMENT_INITIATED', 'PAYMENT_SUCCESS', 'PAYMENT_FAILED')
  GROUP BY event_date, event_type
)"""


def with_ctes(*parts: str) -> str:
    """``WITH`` clause from the named building blocks (in dependency order)."""
    blocks = {"lifecycle": LIFECYCLE, "parsed": PARSED, "bronze": BRONZE, "silver": SILVER, "gold": GOLD}
    order = ["lifecycle", "parsed", "bronze", "silver", "gold"]
    need = max(order.index(p) for p in parts)
    return "WITH " + ",\n".join(blocks[p].strip() for p in order[: need + 1])


def d(col: str, alias: str | None = None) -> str:
    """Render a DATE column as text."""
    return f"strftime({col}, '%Y-%m-%d') AS {alias or col.split('.')[-1]}"


def r(expr: str, alias: str) -> str:
    """A double expression, as computed."""
    return f"{expr} AS {alias}"


def f6(expr: str, alias: str) -> str:
    """A double expression rounded to 6 places (averages of inexact doubles)."""
    return f"round({expr}, 6) AS {alias}"
