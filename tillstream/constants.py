"""Names, formats, bounds and intervals the results depend on."""

# --- Fixed values: field aliases, in lookup order --------------------------------
SALE_ID_ALIASES = ("saleId", "sale_id", "id")
SALESMAN_ALIASES = ("salesmanName", "salesman_name", "salesman")
CITY_ALIASES = ("city",)
COUNTRY_ALIASES = ("country",)
AMOUNT_ALIASES = ("amount",)
PRODUCT_ALIASES = ("product",)
EVENT_TIME_ALIASES = ("eventTime", "saleDate", "sale_date", "event_time", "created_at")
RECORD_KEY_ALIASES = ("id", "sale_id", "saleId")
UNKNOWN_RECORD_KEY = "unknown"

# --- Fixed values: epoch units (both bounds are exclusive) -----------------------
MICROS_ABOVE = 1_000_000_000_000_000
MILLIS_ABOVE = 1_000_000_000_000

# --- Fixed values: sources and topics --------------------------------------------
SOURCES = ("postgres", "files", "legacy")
RELATIONAL_PRODUCER = "relational"
LEGACY_PRODUCER = "legacy"
# A legacy producer without a mark starts this far back.
LEGACY_LOOKBACK_MS = 5 * 60 * 1000

# --- Fixed values: column order of the source and result tables ------------------
RELATIONAL_COLUMNS = (
    "id", "salesman_id", "salesman", "city", "country",
    "amount", "product", "sale_date", "created_at",
)
CSV_COLUMNS = (
    "sale_id", "salesman_name", "city", "country", "amount", "product", "sale_date",
)

# --- Fixed values: ranking, paging and serving defaults --------------------------
RANKED_COUNTRY = "BR"
TOP_N = 10
WINDOW_LENGTH = "1 hour"
OUT_OF_ORDERNESS = "5 seconds"
CHECKPOINT_INTERVAL = "30 seconds"
PAGE_SIZE = 10_000
DEFAULT_LIMIT = 10
MIN_LIMIT, MAX_LIMIT = 1, 100
LATEST = "latest"
NO_WINDOW = "N/A"

# --- Fixed values: text formats (UTC) --------------------------------------------
WINDOW_FORMAT = "yyyy-MM-dd HH:mm:ss"
RESPONSE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# --- Fixed values: alert rules (bound, minimum duration in seconds) ---------------
LAG_RULE = (10_000, 300)
CHECKPOINT_MS_RULE = (60_000, 180)
LATENCY_P95_RULE = (2, 300)
LATENCY_QUANTILE = 0.95
LATENCY_RATE_SECONDS = 300
ERROR_STATUS_PATTERN = "5.."
