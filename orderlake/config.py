"""Fixed values of the order-event platform.

The values in the block below must equal the platform being re-built for
results to match; they are stated as plain data in their natural order.
"""

# --- fixed values -----------------------------------------------------------
REQUIRED_FIELDS = ["event_id", "event_type", "order_id", "customer_id"]
VALID_EVENT_TYPES = [
    "ORDER_PLACED",
    "ORDER_CONFIRMED",
    "ORDER_CANCELLED",
    "PAYMENT_INITIATED",
    "PAYMENT_SUCCESS",
    "PAYMENT_FAILED",
    "ORDER_SHIPPED",
    "ORDER_DELIVERED",
]
PAYMENT_TYPES = ["PAYMENT_INITIATED", "PAYMENT_SUCCESS", "PAYMENT_FAILED"]
PRODUCER_REQUIRED_KEYS = ["customer_id", "event_id", "event_type", "occurred_at", "order_id"]
GATEWAYS = ["razorpay", "paytm", "phonepe", "upi_direct"]
PIPELINE_VERSION = "1.0.0"
SOURCE_SYSTEM = "order-service"
ORDERS_TOPIC = "orders-raw"
PAYMENTS_TOPIC = "payments-raw"
DLQ_TOPIC = "dlq-events"
UNKNOWN = "UNKNOWN"
CURRENCY = "INR"
SLA_HOURS = 48
WATERMARK = "10 minutes"
LATE_TOLERANCE_SECONDS = 600
TRIGGER_INTERVAL = "30 seconds"
MAX_RECORDS_PER_TRIGGER = 50000
RECON_TOLERANCE_PCT = 1.0
DQ_MIN_ROWS = 100
DQ_POSITIVE_AMOUNT_RATE = 0.95
DQ_KNOWN_CITY_RATE = 0.90
INLINE_DQ_MAX_NEG_AMOUNT_PCT = 5.0
INLINE_DQ_MAX_UNKNOWN_CITY_PCT = 10.0
DRIFT_WINDOW_DAYS = 7
DRIFT_ALERT_RATIO = 0.5
DURATION_BUCKETS_SECONDS = [30, 60, 120, 300, 600, 1800]
LAG_YELLOW_SECONDS = 60
LAG_RED_SECONDS = 300
RATE_WINDOW = "5 minutes"
RATE_SLIDE = "1 minute"
TOP_HOURS = 10
SLA_REPORT_ROWS = 20
PAYMENT_REPORT_ROWS = 10
HISTORY_ROWS = 5
SAMPLE_MESSAGES = 20
# --- end of fixed values ----------------------------------------------------

# Event times outside this range (epoch millis, end excluded: 1970-01-01 to 2100-01-01) go to the dead letters.
MIN_EVENT_MS, MAX_EVENT_MS = 0, 4_102_444_800_000
# Payload numbers of this size or more are taken as unreadable.
MAX_NUMBER = 1e15
MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000
