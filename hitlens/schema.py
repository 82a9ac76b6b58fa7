"""Record types (explicit StructTypes, never inferred)."""

from pyspark.sql import types as T

LOG_LINE = T.StructType([T.StructField("value", T.StringType(), True)])

ACCESS_LOG_COLUMNS = [
    "ip_address", "client_id", "user", "date_time", "method", "request_uri",
    "protocol", "response_code", "content_size", "referrer", "user_agent",
]

ACCESS_LOG = T.StructType([
    T.StructField("ip_address", T.StringType(), True),
    T.StructField("client_id", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("date_time", T.TimestampType(), True),
    T.StructField("method", T.StringType(), True),
    T.StructField("request_uri", T.StringType(), True),
    T.StructField("protocol", T.StringType(), True),
    T.StructField("response_code", T.IntegerType(), True),
    T.StructField("content_size", T.LongType(), True),
    T.StructField("referrer", T.StringType(), True),
    T.StructField("user_agent", T.StringType(), True),
])

VIEWED_PRODUCTS_COLUMNS = ["user", "country_code", "date_time", "product", "response_code"]

# IPv4 class-B prefixes "a.b": 256 * 256 distinct values.  A lookup with one
# row per valid prefix is bounded by this, whatever the size of its input.
MAX_CLASS_B_PREFIXES = 256 * 256

COUNTRY_LOOKUP = T.StructType([
    T.StructField("prefix", T.StringType(), False),
    T.StructField("country_code", T.StringType(), True),
])

# Counter tables: (key, count).  The ledger adds the micro-batch id.
COUNTER_TABLES = {
    "page_views": ("page", T.StringType(), "views"),
    "log_volume_by_minute": ("timestamp", T.StringType(), "count"),
    "status_counter": ("status_code", T.IntegerType(), "count"),
    "visits_by_country": ("country", T.StringType(), "count"),
}
