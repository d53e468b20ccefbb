"""DuckDB SQL twins of the registered queries (same keys, same column names)."""

from __future__ import annotations

from orderlake.plans.oracle_base import NUMBER, d, f6, r, with_ctes

ORACLE: dict[str, str] = {}

ORACLE["p2_parse_messages"] = with_ctes("parsed") + """
SELECT event_id, event_type, order_id, customer_id, occurred_at, ingested_at, schema_version,
       source_system, kafka_partition, kafka_offset, malformed, p_city, p_category, p_amount, p_item_count,
       p_discount_pct, p_device, p_pincode, p_gateway, p_loyalty_points
FROM parsed"""

ORACLE["v1_valid_events"] = with_ctes("parsed") + """
SELECT event_id, event_type, kafka_partition, kafka_offset, ingestion_date FROM validated WHERE is_valid"""

ORACLE["v2_dead_letter"] = with_ctes("bronze") + """
SELECT event_id, event_type, order_id, kafka_partition, kafka_offset, reason AS validation_failure FROM dlq"""

ORACLE["w1_bronze_duplicates"] = with_ctes("bronze") + """
SELECT event_id, kafka_partition, kafka_offset, ingestion_date, '1.0.0' AS pipeline_version, is_duplicate,
       p_city, p_category, p_amount, p_item_count, p_discount_pct, p_device, p_pincode, p_gateway, p_loyalty_points
FROM bronze"""

ORACLE["p12_silver_orders"] = with_ctes("silver") + f"""
SELECT event_id, event_type, order_id, customer_id, occurred_at, ingested_at, schema_version,
       source_system, pipeline_version, ingestion_date, occurred_at AS event_timestamp,
       {d('event_date')}, event_hour, city, category, {r('amount', 'amount')}, item_count,
       {r('discount_pct', 'discount_pct')}, device, pincode, {d('processing_date')}
FROM silver"""

ORACLE["a1_hourly_orders"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, event_hour, city, category, order_count, {r('gross_revenue', 'gross_revenue')},
       {r('avg_order_value', 'avg_order_value')}, total_items, unique_customers,
       {r('avg_discount_pct', 'avg_discount_pct')}
FROM hourly"""

# --- gold ----------------------------------------------------------------------

ORACLE["j1_fulfillment"] = with_ctes("gold") + f"""
SELECT order_id, customer_id, city, placed_ms, {d('placed_date')}, delivered_ms,
       {r('delivery_hours', 'delivery_hours')},
       (delivered_ms IS NOT NULL AND delivery_hours <= 48) AS sla_met, delivery_status
FROM fulfil"""

ORACLE["a2_daily_sla"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, city, delivery_status, order_count, {f6('avg_delivery_hours', 'avg_delivery_hours')}
FROM sla"""

ORACLE["a3_payment_health"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, event_type, event_count, {r('total_amount', 'total_amount')},
       {r('avg_amount', 'avg_amount')}
FROM payments"""

ORACLE["a4_payment_health_by_gateway"] = with_ctes("silver") + f"""
SELECT {d('event_date')}, gateway, status, count(*) AS event_count,
       CAST(sum(money) AS DOUBLE) AS total_amount, CAST(sum(money) AS DOUBLE) / count(*) AS avg_amount
FROM (SELECT CAST(epoch_ms(occurred_at) AS DATE) AS event_date, p_gateway AS gateway,
             substr(event_type, 9) AS status,
             CAST(CAST({NUMBER.format('p_amount')} AS DOUBLE) AS DECIMAL(38,6)) AS money
      FROM bronze WHERE event_type LIKE 'PAYMENT\\_%' ESCAPE '\\' AND is_duplicate = 'false')
GROUP BY event_date, gateway, status"""

ORACLE["p15_late_events"] = with_ctes("silver") + f"""
SELECT event_id, event_type, {d('event_date')}, {r('(ingested_at - occurred_at) / 1000.0', 'lateness_seconds')}
FROM silver WHERE (ingested_at - occurred_at) / 1000.0 > 600"""

# --- serving ---------------------------------------------------------------------

ORACLE["x1_daily_revenue"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, CAST(sum(order_count) AS BIGINT) AS total_orders,
       CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue,
       {f6('avg(avg_order_value)', 'avg_order_value')},
       CAST(sum(unique_customers) AS BIGINT) AS unique_customers
FROM hourly GROUP BY event_date"""

ORACLE["x2_city_leaderboard"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, city, CAST(sum(order_count) AS BIGINT) AS total_orders,
       CAST(sum(CAST(gross_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue,
       CAST(rank() OVER (PARTITION BY event_date ORDER BY sum(gross_revenue) DESC) AS INTEGER) AS revenue_rank
FROM hourly GROUP BY event_date, city"""

ORACLE["x3_sla_compliance"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, city,
       CAST(sum(CASE WHEN delivery_status = 'ON_TIME' THEN order_count ELSE 0 END) AS BIGINT) AS on_time_orders,
       CAST(sum(order_count) AS BIGINT) AS total_orders,
       round(100.0 * sum(CASE WHEN delivery_status = 'ON_TIME' THEN order_count ELSE 0 END)
             / nullif(sum(order_count), 0), 2) AS sla_compliance_pct
FROM sla GROUP BY event_date, city"""

ORACLE["x4_payment_failure_rate"] = with_ctes("gold") + f"""
SELECT {d('event_date')},
       CAST(sum(CASE WHEN event_type = 'PAYMENT_SUCCESS' THEN event_count ELSE 0 END) AS BIGINT) AS successful_payments,
       CAST(sum(CASE WHEN event_type = 'PAYMENT_FAILED' THEN event_count ELSE 0 END) AS BIGINT) AS failed_payments,
       round(100.0 * sum(CASE WHEN event_type = 'PAYMENT_FAILED' THEN event_count ELSE 0 END)
             / nullif(sum(event_count), 0), 2) AS failure_rate_pct
FROM payments GROUP BY event_date"""

ORACLE["x5_today_hourly"] = with_ctes("gold") + f"""
SELECT event_hour, city, category, order_count, {r('gross_revenue', 'gross_revenue')},
       {r('avg_order_value', 'avg_order_value')}
FROM hourly WHERE event_date = DATE '1998-06-15'"""

ORACLE["x6_exact_daily_revenue"] = with_ctes("silver") + f"""
SELECT {d('event_date')}, count(*) AS total_orders, CAST(sum(money) AS DOUBLE) AS total_revenue,
       CAST(sum(money) AS DOUBLE) / count(*) AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
FROM silver WHERE event_type = 'ORDER_PLACED' GROUP BY event_date"""

ORACLE["t1_top_hours_by_revenue"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, event_hour, city, category, order_count, {r('gross_revenue', 'gross_revenue')},
       {r('avg_order_value', 'avg_order_value')}
FROM hourly ORDER BY gross_revenue DESC, event_date, event_hour, city, category LIMIT 10"""

ORACLE["t2_sla_report"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, city, delivery_status, order_count, {f6('avg_delivery_hours', 'avg_delivery_hours')}
FROM sla ORDER BY city, delivery_status, event_date LIMIT 20"""

ORACLE["t3_payment_report"] = with_ctes("gold") + f"""
SELECT {d('event_date')}, event_type, event_count, {r('total_amount', 'total_amount')},
       {r('avg_amount', 'avg_amount')}
FROM payments ORDER BY event_type, event_date LIMIT 10"""

ORACLE["s20_contract_hourly"] = with_ctes("gold") + """
SELECT (SELECT count(*) FROM hourly) AS row_count,
       (SELECT CAST(count_if(event_date IS NULL) AS BIGINT) FROM hourly) AS null_event_date,
       (SELECT CAST(count_if(event_hour IS NULL) AS BIGINT) FROM hourly) AS null_event_hour,
       (SELECT CAST(count_if(city IS NULL) AS BIGINT) FROM hourly) AS null_city,
       (SELECT CAST(count_if(category IS NULL) AS BIGINT) FROM hourly) AS null_category,
       (SELECT count(*) FROM (SELECT 1 FROM hourly GROUP BY event_date, event_hour, city, category
                              HAVING count(*) > 1)) AS duplicate_keys,
       (SELECT coalesce(CAST(sum(c) AS BIGINT), 0) FROM (SELECT count(*) AS c FROM hourly
                              GROUP BY event_date, event_hour, city, category HAVING count(*) > 1)) AS duplicate_rows"""

# --- quality ---------------------------------------------------------------------

ORACLE["a6_event_type_distribution"] = with_ctes("bronze") + """
SELECT event_type, count(*) AS count FROM bronze GROUP BY event_type"""

ORACLE["a7_bronze_profile"] = with_ctes("bronze") + """
SELECT ingestion_date, count(*) AS total_events, count(DISTINCT event_id) AS unique_events,
       CAST(sum(CASE WHEN is_duplicate = 'true' THEN 1 ELSE 0 END) AS BIGINT) AS duplicates
FROM bronze GROUP BY ingestion_date"""

_AS_OF_MS = 996796800000  # 2001-08-03T00:00:00Z
_TYPES = "'ORDER_PLACED', 'ORDER_CONFIRMED', 'ORDER_CANCELLED', 'PAYMENT_INITIATED', 'PAYMENT_SUCCESS', 'PAYMENT_FAILED', 'ORDER_SHIPPED', 'ORDER_DELIVERED'"

_SUITE_AGG = f"""
suite_agg AS (
  SELECT event_date,
    CAST(count_if(event_id IS NULL) AS DOUBLE) AS m0,
    CAST(count_if(order_id IS NULL) AS DOUBLE) AS m1,
    CAST(count(*) AS DOUBLE) AS m2,
    CAST(count_if(NOT event_type IN ({_TYPES})) AS DOUBLE) AS m3,
    CAST(count_if(occurred_at > {_AS_OF_MS}) AS DOUBLE) AS m4,
    round(count_if(amount <= 0) / greatest(count(*), 1) * 100.0, 2) AS m5,
    count_if(amount > 0) / greatest(count(*), 1) >= 0.95 AS p5,
    round(count_if(city = 'UNKNOWN') / greatest(count(*), 1) * 100.0, 2) AS m6,
    count_if(city <> 'UNKNOWN') / greatest(count(*), 1) >= 0.90 AS p6,
    round(count_if(schema_version = '2.0') / greatest(count(*), 1) * 100.0, 2) AS m7
  FROM silver GROUP BY event_date
),
suite AS (
  SELECT event_date, CASE WHEN m0 <> 0 OR m1 <> 0 OR m2 < 100 OR m3 <> 0 OR m4 <> 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status,
         c.name, c.description, c.passed, c.metric_name, c.metric_value, c.severity
  FROM suite_agg,
  LATERAL (VALUES
    ('no_null_event_ids', 'event_id must never be null', m0 = 0, 'null_event_id_count', m0, 'CRITICAL'),
    ('no_null_order_ids', 'order_id must never be null', m1 = 0, 'null_order_id_count', m1, 'CRITICAL'),
    ('minimum_record_count', 'Silver must have at least 100 records per day', m2 >= 100, 'total_record_count', m2, 'CRITICAL'),
    ('valid_event_types_only', 'All event_type values must be in allowed set', m3 = 0, 'invalid_event_type_count', m3, 'CRITICAL'),
    ('no_future_events', 'event_timestamp must not be in the future', m4 = 0, 'future_event_count', m4, 'CRITICAL'),
    ('amount_positive_rate', '>=95% of amounts must be positive', p5, 'negative_amount_pct', m5, 'WARNING'),
    ('city_known_rate', '>=90% of city values must not be UNKNOWN', p6, 'unknown_city_pct', m6, 'WARNING'),
    ('schema_version_distribution', 'Track schema version spread (for evolution detection)', true, 'schema_v2_pct', m7, 'WARNING')
  ) c(name, description, passed, metric_name, metric_value, severity)
)"""

ORACLE["k9_dq_suite"] = with_ctes("silver") + "," + _SUITE_AGG + f"""
SELECT {d('event_date')}, overall_status, name, description, passed, metric_name,
       metric_value, severity FROM suite"""

ORACLE["m6_dq_check_flags"] = with_ctes("silver") + "," + _SUITE_AGG + f"""
SELECT {d('event_date')}, name, severity, CAST(passed AS INTEGER) AS check_result FROM suite"""

_INLINE = """
per_type AS (
  SELECT {by} event_type, count(*) AS n, count_if(amount <= 0) AS neg,
         count_if(city = 'UNKNOWN') AS unk, count_if(customer_id IS NULL) AS nullc
  FROM silver GROUP BY {by} event_type
),
rolled AS (
  SELECT {by} CAST(coalesce(sum(n), 0) AS BIGINT) AS total_records,
         CAST(coalesce(sum(neg), 0) AS BIGINT) AS neg_amount_count,
         CAST(coalesce(sum(unk), 0) AS BIGINT) AS unknown_city_count,
         CAST(coalesce(sum(nullc), 0) AS BIGINT) AS null_customer_id_count,
         coalesce(string_agg(coalesce(event_type, 'NULL') || '=' || n, ', '
                             ORDER BY coalesce(event_type, 'NULL'), n), '') AS event_type_distribution
  FROM per_type {group}
),
dq AS (
  SELECT *, round(neg_amount_count / greatest(total_records, 1) * 100.0, 2) AS neg_amount_pct,
            round(unknown_city_count / greatest(total_records, 1) * 100.0, 2) AS unknown_city_pct
  FROM rolled
)"""

_DQ_COLS = """total_records, neg_amount_count, neg_amount_pct, unknown_city_count,
       unknown_city_pct, event_type_distribution, null_customer_id_count,
       (neg_amount_pct < 5.0 AND unknown_city_pct < 10.0 AND null_customer_id_count = 0) AS dq_passed"""

ORACLE["k10_inline_dq"] = with_ctes("silver") + "," + _INLINE.format(by="event_date,", group="GROUP BY event_date") + f"""
SELECT {d('event_date')}, {_DQ_COLS} FROM dq"""

ORACLE["a8_global_dq"] = with_ctes("silver") + "," + _INLINE.format(by="", group="") + f"""
SELECT {_DQ_COLS} FROM dq"""

ORACLE["k11_reconciliation"] = with_ctes("silver") + f""",
b AS (SELECT CAST(ingestion_date AS DATE) AS pd, CAST(count_if(is_duplicate = 'false') AS BIGINT) AS bronze_count,
             count(DISTINCT event_id) AS bronze_distinct_ids FROM bronze GROUP BY 1),
s AS (SELECT event_date AS pd, count(*) AS silver_count FROM silver GROUP BY 1),
j AS (SELECT coalesce(b.pd, s.pd) AS processing_date, coalesce(bronze_count, 0) AS bronze_count,
             coalesce(bronze_distinct_ids, 0) AS bronze_distinct_ids, coalesce(silver_count, 0) AS silver_count
      FROM b FULL OUTER JOIN s ON b.pd = s.pd)
SELECT {d('processing_date')}, bronze_count, bronze_distinct_ids, silver_count,
       round(abs(bronze_count - silver_count) / greatest(bronze_count, 1) * 100.0, 4) AS variance_pct,
       round(abs(bronze_distinct_ids - silver_count) / greatest(bronze_distinct_ids, 1) * 100.0, 4) AS distinct_variance_pct,
       CAST(1.0 AS DOUBLE) AS tolerance_pct,
       CASE WHEN abs(bronze_count - silver_count) / greatest(bronze_count, 1) * 100.0 <= 1.0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM j"""

_SRC = """
src AS (SELECT CAST(epoch_ms(occurred_at) AS DATE) AS pd, count(DISTINCT event_id) AS source_count
        FROM parsed WHERE event_id IS NOT NULL AND occurred_at BETWEEN 0 AND 4102444799999 GROUP BY 1),
s AS (SELECT event_date AS pd, count(*) AS silver_count FROM silver GROUP BY 1),
j AS (SELECT coalesce(src.pd, s.pd) AS processing_date, coalesce(source_count, 0) AS source_count,
             coalesce(silver_count, 0) AS silver_count FROM src FULL OUTER JOIN s ON src.pd = s.pd)"""

ORACLE["k12_backfill_dates"] = with_ctes("silver") + "," + _SRC + f"""
SELECT {d('processing_date')}, source_count - silver_count AS missing_records FROM j
WHERE abs(source_count - silver_count) / greatest(source_count, 1) * 100.0 > 1.0"""

ORACLE["k12_missing_ids"] = with_ctes("silver") + f"""
SELECT DISTINCT p.event_id, {d('CAST(epoch_ms(p.occurred_at) AS DATE)', 'event_date')}
FROM parsed p WHERE p.event_id IS NOT NULL AND p.occurred_at BETWEEN 0 AND 4102444799999 AND p.event_id NOT IN (SELECT event_id FROM silver)"""

ORACLE["w3_type_share_drift"] = with_ctes("silver") + f""",
per_day AS (SELECT event_date, event_type, count(*) AS n FROM silver GROUP BY event_date, event_type),
shares AS (SELECT *, n / sum(n) OVER (PARTITION BY event_date) AS share,
                  date_diff('day', DATE '1970-01-01', event_date) AS dnum FROM per_day),
tr AS (SELECT *, avg(share) OVER (PARTITION BY event_type ORDER BY dnum
                                  RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS trailing_avg_share FROM shares)
SELECT {d('event_date')}, event_type, n, share, round(trailing_avg_share, 6) AS trailing_avg_share,
       round(abs(share - trailing_avg_share) / trailing_avg_share, 6) AS share_change,
       coalesce(abs(share - trailing_avg_share) / trailing_avg_share > 0.5, false) AS drift_alert
FROM tr"""

# --- type-2 customer dimension ------------------------------------------------------

_KNOWN = "{c} IS NOT NULL AND {c} <> 'UNKNOWN'"


def _latest(c: str) -> str:
    return (f"arg_max({c}, struct_pack(o := occurred_at, e := event_id)) "
            f"FILTER (WHERE {_KNOWN.format(c=c)})")


def _snapshot(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT customer_id, {_latest('city')} AS city, {_latest('device')} AS device, max(occurred_at) AS last_seen_ms
  FROM {source} WHERE customer_id IS NOT NULL GROUP BY customer_id
)"""


def _history(name: str, source: str) -> str:
    p = name
    return f"""
{p}_days AS (
  SELECT customer_id, event_date, {_latest('city')} AS city, {_latest('device')} AS device,
         max(occurred_at) AS last_seen_ms
  FROM {source} WHERE customer_id IS NOT NULL GROUP BY customer_id, event_date
),
{p}_carried AS (
  SELECT *, coalesce(last_value(city IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY event_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'UNKNOWN') AS city_c
  FROM {p}_days
),
{p}_flagged AS (
  SELECT *, CASE WHEN lag(city_c) OVER (PARTITION BY customer_id ORDER BY event_date) IS NOT DISTINCT FROM city_c
                 THEN 0 ELSE 1 END AS chg
  FROM {p}_carried
),
{p}_vers AS (
  SELECT *, sum(chg) OVER (PARTITION BY customer_id ORDER BY event_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
  FROM {p}_flagged
),
{p}_v AS (
  SELECT customer_id, CAST(v AS INTEGER) AS dim_version, min(city_c) AS city,
         arg_max(device, event_date) FILTER (WHERE device IS NOT NULL) AS device,
         max(last_seen_ms) AS last_seen_ms, min(event_date) AS effective_from
  FROM {p}_vers GROUP BY customer_id, v
),
{p} AS (
  SELECT customer_id, city, device, last_seen_ms, effective_from,
         lead(effective_from) OVER (PARTITION BY customer_id ORDER BY dim_version) AS effective_to,
         lead(effective_from) OVER (PARTITION BY customer_id ORDER BY dim_version) IS NULL AS is_current,
         dim_version
  FROM {p}_v
)"""


def _apply(name: str, dim: str, snap: str, eff: str) -> str:
    e = f"DATE '{eff}'"
    return f"""
{name}_j AS (
  SELECT c.*, s.customer_id AS s_id, s.city AS s_city, s.device AS s_device, s.last_seen_ms AS s_seen,
         (c.customer_id IS NOT NULL AND s.customer_id IS NOT NULL AND s.city IS NOT NULL
          AND s.city IS DISTINCT FROM c.city AND {e} >= c.effective_from
          AND (c.last_seen_ms IS NULL OR s.last_seen_ms > c.last_seen_ms)) AS changed
  FROM (SELECT * FROM {dim} WHERE is_current) c FULL OUTER JOIN {snap} s ON c.customer_id = s.customer_id
),
{name} AS (
  SELECT customer_id, city, device, last_seen_ms, effective_from, effective_to, true AS is_current, dim_version
  FROM {name}_j WHERE s_id IS NULL
  UNION ALL
  SELECT s_id, coalesce(s_city, 'UNKNOWN'), s_device, s_seen, {e}, NULL, true, 1
  FROM {name}_j WHERE customer_id IS NULL
  UNION ALL
  SELECT customer_id, city, device, last_seen_ms, effective_from, {e}, false, dim_version
  FROM {name}_j WHERE customer_id IS NOT NULL AND s_id IS NOT NULL AND changed AND {e} > effective_from
  UNION ALL
  SELECT customer_id, s_city, coalesce(s_device, device), greatest(last_seen_ms, s_seen), {e}, NULL, true,
         dim_version + 1
  FROM {name}_j WHERE customer_id IS NOT NULL AND s_id IS NOT NULL AND changed AND {e} > effective_from
  UNION ALL
  SELECT customer_id, CASE WHEN changed THEN s_city ELSE city END, coalesce(s_device, device),
         greatest(last_seen_ms, s_seen), effective_from, effective_to, true, dim_version
  FROM {name}_j WHERE customer_id IS NOT NULL AND s_id IS NOT NULL AND NOT (changed AND {e} > effective_from)
  UNION ALL
  SELECT customer_id, city, device, last_seen_ms, effective_from, effective_to, is_current, dim_version
  FROM {dim} WHERE NOT is_current
)"""


_CUT = "2000-01-01"
_SPLIT = f""",
before AS (SELECT * FROM silver WHERE event_date < DATE '{_CUT}'),
after AS (SELECT * FROM silver WHERE event_date >= DATE '{_CUT}')"""

_DIM_COLS = f"""customer_id, city, device, last_seen_ms AS last_seen_at, {d('effective_from')},
       {d('effective_to')}, is_current, dim_version"""

ORACLE["a5_customer_snapshot"] = with_ctes("silver") + "," + _snapshot("snap", "silver") + """
SELECT customer_id, city, device, last_seen_ms AS last_seen_at FROM snap"""

ORACLE["d7_full_history"] = with_ctes("silver") + "," + _history("hist", "silver") + f"""
SELECT {_DIM_COLS} FROM hist"""

_APPLIED = (with_ctes("silver") + _SPLIT + "," + _history("dim0", "before") + ","
            + _snapshot("snap", "after") + "," + _apply("dim1", "dim0", "snap", _CUT))

ORACLE["d1_scd2_apply"] = _APPLIED + f"""
SELECT {_DIM_COLS} FROM dim1"""

ORACLE["d8_dimension_violations"] = _APPLIED + """,
per_row AS (
  SELECT customer_id, is_current,
         CASE WHEN effective_to IS NOT NULL AND effective_to <= effective_from THEN 1 ELSE 0 END AS zero_length,
         CASE WHEN lead(effective_from) OVER w IS NOT NULL
                   AND (effective_to IS NULL OR effective_to <> lead(effective_from) OVER w) THEN 1 ELSE 0 END AS bad_link
  FROM dim1 WINDOW w AS (PARTITION BY customer_id ORDER BY effective_from, dim_version)
)
SELECT customer_id, CAST(count_if(is_current) AS BIGINT) AS current_rows, CAST(sum(zero_length) AS BIGINT) AS zero_length_versions,
       CAST(sum(bad_link) AS BIGINT) AS overlaps_or_gaps
FROM per_row GROUP BY customer_id
HAVING count_if(is_current) <> 1 OR sum(zero_length) > 0 OR sum(bad_link) > 0"""

ORACLE["d6_initial_load"] = (with_ctes("silver") + "," + _snapshot("snap", "silver") + f"""
SELECT customer_id, coalesce(city, 'UNKNOWN') AS city, device, last_seen_ms AS last_seen_at,
       '{_CUT}' AS effective_from, CAST(NULL AS VARCHAR) AS effective_to, true AS is_current, 1 AS dim_version
FROM snap""")

ORACLE["j5_city_as_of"] = with_ctes("silver") + "," + _history("hist", "silver") + f"""
SELECT s.customer_id, {d('s.event_date', 'event_date')}, s.event_id, s.city, h.city AS city_at_event,
       h.dim_version AS dim_version_at_event
FROM silver s LEFT JOIN hist h ON s.customer_id = h.customer_id AND s.event_date >= h.effective_from
     AND (h.effective_to IS NULL OR s.event_date < h.effective_to)
WHERE s.event_type = 'ORDER_PLACED'"""

# --- ingest extras ------------------------------------------------------------------

ORACLE["s3_sample_messages"] = with_ctes("lifecycle") + """
SELECT CAST(kafka_partition AS INTEGER) AS partition, CAST(kafka_offset AS BIGINT) AS offset,
       coalesce(order_id, event_id) AS key, CASE WHEN malformed THEN NULL ELSE event_type END AS event_type,
       CASE WHEN malformed THEN NULL ELSE order_id END AS order_id
FROM events ORDER BY CAST(kafka_offset AS BIGINT), CAST(kafka_partition AS INTEGER) LIMIT 20"""

ORACLE["s19_keyed_publish"] = with_ctes("bronze") + """
SELECT coalesce(order_id, event_id) AS key, occurred_at, event_id AS json_event_id, event_type AS json_event_type,
       order_id AS json_order_id, customer_id AS json_customer_id, CAST(occurred_at AS VARCHAR) AS json_occurred_at,
       CAST(ingested_at AS VARCHAR) AS json_ingested_at, schema_version AS json_schema_version, source_system AS json_source_system,
       p_city AS json_p_city, p_category AS json_p_category, p_amount AS json_p_amount, p_item_count AS json_p_item_count,
       p_discount_pct AS json_p_discount_pct, p_device AS json_p_device, p_pincode AS json_p_pincode, p_gateway AS json_p_gateway,
       p_loyalty_points AS json_p_loyalty_points
FROM bronze WHERE is_duplicate = 'false'"""

_PRODUCER = """
prod AS (
  SELECT *, concat_ws(', ', CASE WHEN customer_id IS NULL THEN 'customer_id' END,
                            CASE WHEN event_id IS NULL THEN 'event_id' END,
                            CASE WHEN event_type IS NULL THEN 'event_type' END,
                            CASE WHEN occurred_at IS NULL THEN 'occurred_at' END,
                            CASE WHEN order_id IS NULL THEN 'order_id' END) AS missing
  FROM parsed
),
prod2 AS (
  SELECT *, CASE WHEN missing <> '' THEN 'Missing fields: ' || missing
                 WHEN event_id = '' THEN 'event_id is empty' ELSE '' END AS producer_reason
  FROM prod
)"""

ORACLE["v3_producer_check"] = with_ctes("parsed") + "," + _PRODUCER + """
SELECT kafka_offset, event_id, producer_reason = '' AS producer_valid, producer_reason FROM prod2"""

ORACLE["v4_dlq_envelope"] = with_ctes("parsed") + "," + _PRODUCER + """
SELECT coalesce(event_id, 'unknown') AS key, CASE WHEN malformed THEN 'not json' ELSE customer_id END AS original_event,
       producer_reason AS failure_reason, 'orders-raw' AS source_topic,
       CAST(996796800000 AS BIGINT) AS failed_at
FROM prod2 WHERE producer_reason <> ''"""

ORACLE["v5_route"] = with_ctes("parsed") + "," + _PRODUCER + """
SELECT kafka_offset, event_id, CASE WHEN producer_reason = '' THEN 'orders-raw' ELSE 'dlq-events' END AS target_topic
FROM prod2"""

# --- operational metrics --------------------------------------------------------------

_BATCHES = """,
vb AS (SELECT *, kafka_ts // 30000 AS batch_id FROM validated),
tagged AS (
  SELECT batch_id, row_number() OVER (PARTITION BY batch_id, event_id ORDER BY ingested_at,
         CAST(kafka_partition AS BIGINT), CAST(kafka_offset AS BIGINT)) > 1 AS dup
  FROM vb WHERE is_valid
),
pv AS (SELECT batch_id, count(*) AS written, CAST(count_if(dup) AS BIGINT) AS duplicates FROM tagged GROUP BY batch_id),
pd AS (SELECT batch_id, count(*) AS dlq FROM vb WHERE NOT is_valid GROUP BY batch_id),
batches AS (
  SELECT coalesce(pv.batch_id, pd.batch_id) AS batch_id, coalesce(written, 0) AS written,
         coalesce(duplicates, 0) AS duplicates, coalesce(dlq, 0) AS dlq
  FROM pv FULL OUTER JOIN pd ON pv.batch_id = pd.batch_id
)"""

ORACLE["m1_batch_metrics"] = with_ctes("parsed") + _BATCHES + """
SELECT batch_id, written, duplicates, dlq FROM batches"""

ORACLE["w4_running_totals"] = with_ctes("parsed") + _BATCHES + """,
cum AS (
  SELECT *, sum(written) OVER w AS tw, sum(duplicates) OVER w AS td, sum(dlq) OVER w AS tq,
         min(batch_id) OVER () AS start
  FROM batches WINDOW w AS (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT batch_id, written, duplicates, dlq, CAST(tw AS BIGINT) AS total_records, CAST(td AS BIGINT) AS total_duplicates,
       CAST(tq AS BIGINT) AS total_dlq,
       tw / ((batch_id - start + 1) * CAST(30.0 AS DOUBLE)) AS avg_throughput,
       td / greatest(tw, 1) AS dup_rate, tq / greatest(tw, 1) AS dlq_rate
FROM cum"""

ORACLE["m2_records_by_layer"] = with_ctes("silver") + """
SELECT 'bronze' AS layer, source_system, event_type, count(*) AS records FROM bronze GROUP BY ALL
UNION ALL
SELECT 'silver' AS layer, source_system, event_type, count(*) AS records FROM silver GROUP BY ALL"""

ORACLE["m3_dlq_by_reason"] = with_ctes("bronze") + """
SELECT 'orders-raw' AS source_topic, reason AS failure_reason, count(*) AS dlq_events FROM dlq GROUP BY reason"""

ORACLE["m7_pipeline_lag"] = with_ctes("bronze") + """
SELECT 'orders-raw' AS source_topic, ingestion_date, max((ingested_at - occurred_at) / 1000.0) AS max_lag_seconds,
       CASE WHEN max((ingested_at - occurred_at) / 1000.0) >= 300 THEN 'red'
            WHEN max((ingested_at - occurred_at) / 1000.0) >= 60 THEN 'yellow' ELSE 'green' END AS lag_band
FROM bronze GROUP BY ingestion_date"""

ORACLE["m8_records_per_minute"] = with_ctes("bronze") + """
SELECT 'bronze' AS layer, ws AS window_start, ws + 300000 AS window_end,
       CAST(count(*) AS DOUBLE) / 5.0 AS records_per_minute
FROM (SELECT (ingested_at // 60000) * 60000 - t.i * 60000 AS ws
      FROM bronze, (VALUES (0), (1), (2), (3), (4)) t(i))
GROUP BY ws"""

ORACLE["m9_duplicate_rate"] = with_ctes("bronze") + """
SELECT 'orders-raw' AS source_topic, ingestion_date,
       avg(CASE WHEN is_duplicate = 'true' THEN 1.0 ELSE 0.0 END) AS duplicate_rate
FROM bronze GROUP BY ingestion_date"""

ORACLE["m10_silver_count"] = with_ctes("silver") + f"""
SELECT {d('processing_date')}, count(*) AS silver_records FROM silver GROUP BY processing_date"""

ORACLE["m11_consumer_lag"] = with_ctes("lifecycle") + """,
msgs AS (SELECT CAST(kafka_partition AS INTEGER) AS partition, CAST(kafka_offset AS BIGINT) AS "offset",
                ingested_at AS kafka_timestamp FROM events),
committed AS (SELECT partition, max("offset") AS committed_offset FROM msgs
              WHERE kafka_timestamp < 946684800000 GROUP BY partition)
SELECT 'orders-raw' AS topic, m.partition, max(m."offset") AS log_end_offset, max(c.committed_offset) AS committed_offset,
       CAST(count_if(c.committed_offset IS NULL OR m."offset" > c.committed_offset) AS BIGINT) AS lag_records
FROM msgs m LEFT JOIN committed c ON m.partition = c.partition GROUP BY m.partition"""

# --- scans, merge and gate -------------------------------------------------------------

ORACLE["s4_bronze_date_scan"] = with_ctes("bronze") + """
SELECT event_id, event_type, ingestion_date, is_duplicate FROM bronze
WHERE ingestion_date IN ('1998-06-15', '1998-06-14', '1998-06-13') AND is_duplicate = 'false'"""

ORACLE["s5_silver_date_scan"] = with_ctes("silver") + f"""
SELECT event_id, event_type, {d('event_date')} FROM silver
WHERE event_date BETWEEN DATE '1998-06-15' AND DATE '1998-06-17'"""

ORACLE["s6_processing_date_scan"] = with_ctes("silver") + f"""
SELECT event_id, {d('processing_date')}, {d('event_date')} FROM silver WHERE processing_date = DATE '1998-06-15'"""

ORACLE["s10_merge"] = with_ctes("silver") + f"""
SELECT event_id, {d('event_date')},
       CASE WHEN event_date >= DATE '2000-01-01' THEN '2001-08-03' ELSE strftime(processing_date, '%Y-%m-%d') END
         AS processing_date,
       amount
FROM silver"""

ORACLE["s10_upsert_indexed"] = ORACLE["s10_merge"]

ORACLE["k13_gate_by_date"] = with_ctes("silver") + "," + _SUITE_AGG + f""",
b AS (SELECT CAST(ingestion_date AS DATE) AS pd, count_if(is_duplicate = 'false') AS bc FROM bronze GROUP BY 1),
s AS (SELECT event_date AS pd, count(*) AS sc FROM silver GROUP BY 1),
rc AS (SELECT coalesce(b.pd, s.pd) AS pd,
              CASE WHEN abs(coalesce(bc, 0) - coalesce(sc, 0)) / greatest(coalesce(bc, 0), 1) * 100.0 <= 1.0
                   THEN 'PASS' ELSE 'FAIL' END AS recon_status
       FROM b FULL OUTER JOIN s ON b.pd = s.pd),
dq AS (SELECT event_date AS pd, max(CASE WHEN overall_status = 'FAIL' THEN 1 ELSE 0 END) AS dq_fail
       FROM suite GROUP BY event_date),
j AS (SELECT coalesce(dq.pd, rc.pd) AS pd, dq_fail, recon_status FROM dq FULL OUTER JOIN rc ON dq.pd = rc.pd)
SELECT {d('pd', 'processing_date')},
       (coalesce(dq_fail = 0, false) AND coalesce(recon_status = 'PASS', false)) AS continue,
       concat_ws('; ', CASE WHEN dq_fail IS NULL THEN 'dq: ERROR' END,
                       CASE WHEN dq_fail = 1 THEN 'dq: critical check failed' END,
                       CASE WHEN recon_status IS NULL THEN 'recon: ERROR' END,
                       CASE WHEN recon_status = 'FAIL' THEN 'recon: FAIL' END) AS reasons
FROM j"""

ORACLE["j1_negative_hours"] = with_ctes("gold") + """
SELECT p.order_id, placed_ms, d.delivered_ms, (d.delivered_ms - placed_ms) / 3600000.0 AS delivery_hours
FROM placed p JOIN (SELECT order_id, min(occurred_at) AS delivered_ms FROM silver WHERE event_type = 'ORDER_DELIVERED' GROUP BY order_id) d
  ON p.order_id = d.order_id WHERE d.delivered_ms < placed_ms"""

_STEPS = """,
steps AS (
  SELECT 'order' AS job_name, s.event_type AS layer, (s.occurred_at - p.placed_ms) / 1000.0 AS duration_s
  FROM silver s JOIN (SELECT order_id, min(placed_ms) AS placed_ms FROM placed GROUP BY order_id) p ON s.order_id = p.order_id
  WHERE s.event_type <> 'ORDER_PLACED' AND s.occurred_at >= p.placed_ms
)"""

ORACLE["m4_duration_histogram"] = with_ctes("gold") + _STEPS + f"""
SELECT job_name, layer, {", ".join(f"CAST(count_if(duration_s <= {le}) AS BIGINT) AS le_{le}" for le in (30, 60, 120, 300, 600, 1800))},
       count(*) AS le_inf, {f6('sum(duration_s)', 'duration_sum')}
FROM steps GROUP BY job_name, layer"""

ORACLE["m5_duration_percentiles"] = with_ctes("gold") + _STEPS + f"""
SELECT job_name, layer, {f6('quantile_cont(duration_s, 0.5)', 'p50_s')}, {f6('quantile_cont(duration_s, 0.95)', 'p95_s')}
FROM steps GROUP BY job_name, layer"""

ORACLE["j6_fulfillment_within_horizon"] = with_ctes("gold") + """
SELECT p.order_id, city, placed_ms, d.delivered_ms, (d.delivered_ms - placed_ms) / 3600000.0 AS delivery_hours,
       CASE WHEN d.delivered_ms IS NULL THEN 'PENDING'
            WHEN (d.delivered_ms - placed_ms) / 3600000.0 <= 48 THEN 'ON_TIME' ELSE 'LATE' END AS delivery_status
FROM placed p LEFT JOIN delivered d ON p.order_id = d.order_id AND d.delivered_ms BETWEEN placed_ms AND placed_ms + 72 * 3600000"""

ORACLE["g11_hourly_activity"] = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS events,
       count(DISTINCT user_id) AS unique_keys, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2"""

ORACLE["s10_upsert_roundtrip"] = with_ctes("silver") + f"""
SELECT event_id, CASE WHEN event_date >= DATE '2000-01-01' THEN 'PAYMENT_RESTATED' ELSE event_type END AS event_type,
       {d('event_date')}, amount, ingested_at + CASE WHEN event_date >= DATE '2000-01-01' THEN 1 ELSE 0 END AS ingested_at,
       CASE WHEN event_date >= DATE '2000-01-01' THEN 'restated' END AS note
FROM silver WHERE event_type LIKE 'PAYMENT%'"""

ORACLE["s18_commit_history"] = with_ctes("gold") + """
SELECT CAST(1 AS BIGINT) AS version, 'REWRITE' AS operation, count(*) AS row_count FROM payments
UNION ALL SELECT 2, 'REWRITE', count(*) FROM payments WHERE event_type IN ('PAYMENT_INITIATED', 'PAYMENT_FAILED')
UNION ALL SELECT 3, 'REWRITE', count(*) FROM payments WHERE event_type = 'PAYMENT_FAILED'"""

ORACLE["k11_checksum_recon"] = with_ctes("silver") + f""",
swapped AS (SELECT event_id, 'X-' || split_part(event_id, '-', 2) AS foreign_id, event_date FROM silver
            WHERE event_type = 'ORDER_PLACED' AND CAST(split_part(event_id, '-', 2) AS BIGINT) % 211 = 0)
SELECT {d('event_date', 'processing_date')}, event_id, 'missing' AS status, CAST(1 AS BIGINT) AS copies FROM swapped
UNION ALL SELECT {d('event_date', 'processing_date')}, foreign_id, 'foreign', 1 FROM swapped"""

ORACLE["x6_from_gold"] = ORACLE["x6_exact_daily_revenue"]

_DRIFT_KEYS = ("city", "category", "amount", "item_count", "discount_pct", "device", "pincode", "gateway", "loyalty_points")
_DRIFT_FAILS = {"amount": "try_cast(p_amount AS DOUBLE) IS NULL", "item_count": "NOT regexp_full_match(p_item_count, '-?[0-9]+')",
                "discount_pct": "try_cast(p_discount_pct AS DOUBLE) IS NULL"}

ORACLE["s21_payload_drift"] = with_ctes("parsed") + ", k AS (" + " UNION ALL ".join(
    f"SELECT event_type, '{k}' AS payload_key, {str(k != 'loyalty_points').lower()} AS in_contract, count(*) AS messages, count(p_{k}) AS present, "
    f"count(*) - count(p_{k}) AS missing, count(*) FILTER (p_{k} IS NOT NULL AND {_DRIFT_FAILS.get(k, 'false')}) AS failed_casts, "
    f"CASE WHEN count(p_{k}) > 0 THEN 'STRING' ELSE '' END AS json_type FROM parsed WHERE NOT malformed GROUP BY event_type"
    for k in _DRIFT_KEYS) + ") SELECT * FROM k WHERE in_contract OR present > 0"
