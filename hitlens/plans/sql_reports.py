"""The SQL surface: temp views, the ``getHour`` SQL function, report texts.

The reference ran SQL strings over a temp table of refined records and
registered a Scala UDF ``getHour``.  Here ``getHour`` is an SQL function whose
body is the built-in ``hour``, so the SQL texts plan entirely JVM side (no
Python evaluation node).  The access-log view also exposes ``endpoint`` as the
name the reference's SQL used for the request URI (Q5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWED_PRODUCTS_VIEW = "viewed_products"
ACCESS_LOG_VIEW = "access_log"

GET_HOUR_DDL = ("CREATE OR REPLACE TEMPORARY FUNCTION getHour(t TIMESTAMP) "
                "RETURNS INT RETURN hour(t)")

# --- batch SQL reports over viewed_products (AGG-1..5, PRJ-7, SRT-3, LIM-3) ---
SQL_VIEWS_PER_USER = (
    "SELECT `user`, COUNT(*) AS views FROM viewed_products GROUP BY `user`")
SQL_VIEWS_PER_COUNTRY = (
    "SELECT country_code, COUNT(*) AS views FROM viewed_products GROUP BY country_code")
SQL_VIEWS_PER_HOUR = (
    "SELECT hr AS hour, count(product) AS views "
    "FROM (SELECT getHour(date_time) AS hr, product FROM viewed_products) t GROUP BY hr")
SQL_TOP_PRODUCTS_10 = (
    "SELECT product, COUNT(*) AS views FROM viewed_products GROUP BY product "
    "ORDER BY views DESC, product ASC NULLS LAST LIMIT 10")
SQL_PRODUCTS_PER_USER = (
    "SELECT `user`, product, COUNT(*) AS views FROM viewed_products "
    "GROUP BY `user`, product ORDER BY views DESC, `user`, product")

# --- the four per-window reports over access-log rows (STR-10) --------------
SQL_SIZE_STATS = (
    "SELECT SUM(content_size) AS total_size, COUNT(*) AS n, MIN(content_size) AS min_size, "
    "MAX(content_size) AS max_size, SUM(content_size) div COUNT(*) AS avg_size FROM {view}")
SQL_RESPONSE_CODES = (
    "SELECT response_code, COUNT(*) AS total FROM {view} GROUP BY response_code")
SQL_FREQUENT_IPS = (
    "SELECT ip_address, COUNT(*) AS total FROM {view} GROUP BY ip_address HAVING total > 10")
SQL_TOP_ENDPOINTS = (
    "SELECT endpoint, COUNT(*) AS total FROM {view} GROUP BY endpoint "
    "ORDER BY total DESC, endpoint ASC NULLS LAST LIMIT 10")

WINDOW_REPORTS = {
    "size_stats": SQL_SIZE_STATS,
    "response_codes": SQL_RESPONSE_CODES,
    "frequent_ips": SQL_FREQUENT_IPS,
    "top_endpoints": SQL_TOP_ENDPOINTS,
}


def register_functions(spark: SparkSession) -> None:
    spark.sql(GET_HOUR_DDL)


def register_views(spark: SparkSession, viewed: DataFrame | None = None,
                   logs: DataFrame | None = None, cache: bool = False) -> None:
    """MAT-2: temp views (optionally cached) for the SQL texts."""
    register_functions(spark)
    if viewed is not None:
        viewed.createOrReplaceTempView(VIEWED_PRODUCTS_VIEW)
        if cache:
            spark.catalog.cacheTable(VIEWED_PRODUCTS_VIEW)
    if logs is not None:
        with_endpoint(logs).createOrReplaceTempView(ACCESS_LOG_VIEW)
        if cache:
            spark.catalog.cacheTable(ACCESS_LOG_VIEW)


def with_endpoint(logs: DataFrame) -> DataFrame:
    return logs.withColumn("endpoint", F.col("request_uri"))


def run(spark: SparkSession, text: str, view: str = ACCESS_LOG_VIEW) -> DataFrame:
    return spark.sql(text.format(view=view))
