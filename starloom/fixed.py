"""Fixed values of the warehouse's definitions.

These must stay equal to the definitions the warehouse was specified with
(accepted values, masks, calendar range, tolerances, stream timing); every
module takes them from here.
"""

# ---------------------------------------------------------------------------
# Fixed values (must equal the warehouse definitions for equal results)
CUSTOMER_SEGMENTS = ("new", "regular", "loyal", "vip")
ORDER_STATUSES = ("completed", "cancelled", "returned")
ORDER_CHANNELS = ("web", "ios", "android")
MONEY_PRECISION, MONEY_SCALE, MONEY_PLACES = 18, 3, 2
KEY_SEPARATOR = "|"
EMAIL_KEEP, EMAIL_MASK = 1, "***@"
PHONE_KEEP, PHONE_MASK = 7, "***-****"
EMAIL_MASK_PATTERN = "_***@%"
PHONE_MASK_PATTERN = "+1-___-***-****"
OPEN_VERSION_END = "9999-12-31 00:00:00"
EMPTY_HIGH_WATER = "1900-01-01 00:00:00"
CONFIG_DATE_START, CONFIG_DATE_END = "2024-01-01", "2026-12-31"
RECONCILE_TOLERANCE = "0.005"
RAW_FRESHNESS_HOURS = (24, 72)      # warn, error
STREAM_FRESHNESS_HOURS = (24, None)  # warn only
WINDOW = "1 minute"
WATERMARK = "2 seconds"
COMPLETED = "completed"
REVENUE_PLACES, BASKET_PLACES = 2, 4
# Type in which the stream sums money.
STREAM_MONEY = "decimal(28,8)"
MESSAGE_LIMIT = 500
INVOCATION_LABEL = "dbt_invocation_id"
QUERY_JOB = "QUERY"
# ---------------------------------------------------------------------------
