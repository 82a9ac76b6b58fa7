"""Report operators: ``DataFrame -> DataFrame``.

Every count is a partial + final hash aggregate (map-side combine), so a key
holding a third of the rows is reduced to one row per input partition before
the shuffle.  Top-k is ``orderBy(...).limit(k)``, which plans as
TakeOrderedAndProject (a bounded heap per partition, no global sort).  Ties
are broken by key ascending with NULL keys last (decision D5); NULL keys
(unmapped country, URI without product) are groups of their own (D2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hour_of, int_div, minute_key

FREQUENT_THRESHOLD = 10     # fixed value: "more than 10 times"


def _key(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_by(df: DataFrame, keys, name: str = "total", count_col: str | None = None) -> DataFrame:
    """Rows (or non-NULL ``count_col`` values) per key."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    counted = F.count(F.lit(1)) if count_col is None else F.count(count_col)
    return df.groupBy(*[_key(k) for k in keys]).agg(counted.alias(name))


def top_k(df: DataFrame, k: int, by: str, keys) -> DataFrame:
    """First ``k`` rows by ``by`` descending, ties by keys ascending (NULLs last)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc_nulls_last() for c in keys]).limit(k)


# --- viewed-product reports (AGG-1..5, AGG-10, AGG-11, TOP-1) ---------------

def views_per_user(vp: DataFrame) -> DataFrame:
    return count_by(vp, "user", "views")


def views_per_country(vp: DataFrame) -> DataFrame:
    return count_by(vp, "country_code", "views")


def views_per_hour(vp: DataFrame, non_null_products: bool = False,
                   as_written: bool = False) -> DataFrame:
    """AGG-3: rows per hour of day sorted by hour; or non-NULL products (Q6).

    Hours are UTC; ``as_written`` takes the hour in each line's own offset
    (needs ``utc_offset``, see ``parse_logs(keep_offset=True)``), decision D1.
    """
    hour = hour_of("date_time", "utc_offset" if as_written else None)
    counted = count_by(vp, hour.alias("hour"), "views",
                       "product" if non_null_products else None)
    return counted.orderBy("hour")


def views_per_product(vp: DataFrame) -> DataFrame:
    return count_by(vp, "product", "views")


def top_products(vp: DataFrame, k: int = 100) -> DataFrame:
    return top_k(views_per_product(vp), k, "views", "product")


def top10_products(vp: DataFrame) -> DataFrame:
    return top_products(vp, 10)


def top10_by_name_desc(vp: DataFrame, k: int = 10) -> DataFrame:
    """TOP-1 as written: ``top(10)`` on (product, count) pairs orders by the
    product name descending, then the count (Q1)."""
    return views_per_product(vp).orderBy(
        F.col("product").desc_nulls_last(), F.col("views").desc()).limit(k)


def top_products_per_user(vp: DataFrame, k: int = 100) -> DataFrame:
    return top_k(count_by(vp, ["user", "product"], "views"), k, "views", ["user", "product"])


def frequent_countries(vp: DataFrame, threshold: int = FREQUENT_THRESHOLD) -> DataFrame:
    return views_per_country(vp).where(F.col("views") > threshold)


# --- access-log reports (AGG-6..9, AGG-12) ----------------------------------

def content_size_stats(logs: DataFrame) -> DataFrame:
    """AGG-6: one row; ``avg_size`` is the reference's integer division (Q2),
    ``avg_exact`` the exact mean."""
    agg = logs.agg(
        F.sum("content_size").alias("total_size"),
        F.count(F.lit(1)).alias("n"),
        F.min("content_size").alias("min_size"),
        F.max("content_size").alias("max_size"),
        F.avg("content_size").alias("avg_exact"),
    )
    return agg.withColumn("avg_size", int_div("total_size", "n"))


def response_code_counts(logs: DataFrame) -> DataFrame:
    return count_by(logs, "response_code", "total")


def frequent_ips_from_counts(counts: DataFrame, threshold: int = FREQUENT_THRESHOLD) -> DataFrame:
    return counts.where(F.col("total") > threshold)


def frequent_ips(logs: DataFrame, threshold: int = FREQUENT_THRESHOLD) -> DataFrame:
    """AGG-8: IPs seen more than ``threshold`` times (HAVING total > 10)."""
    return frequent_ips_from_counts(count_by(logs, "ip_address", "total"), threshold)


def top_endpoints_from_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k(counts, k, "total", "request_uri")


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    """AGG-9 / TOP-2: top endpoints by count."""
    return top_endpoints_from_counts(count_by(logs, "request_uri", "total"), k)


def log_volume_per_minute(logs: DataFrame) -> DataFrame:
    """AGG-12: counts per minute; the text key is made once per minute, after the aggregation."""
    counts = count_by(logs, F.date_trunc("minute", "date_time").alias("_minute"), "total")
    return counts.select(minute_key("_minute").alias("minute"), "total")


# --- all counting reports in one pass (MAT-1) -------------------------------------

#: Report -> the columns it counts by.  Sizes are the group of all rows.
COUNT_KEYS = ("user", "country_code", "hour", "product", "response_code", "ip_address", "request_uri")
COUNT_SETS = {
    "views_per_user": ("user",), "views_per_country": ("country_code",), "views_per_hour": ("hour",),
    "views_per_product": ("product",), "views_per_user_product": ("user", "product"),
    "response_codes": ("response_code",), "ips": ("ip_address",), "endpoints": ("request_uri",), "sizes": (),
}


def all_counts(refined: DataFrame) -> DataFrame:
    """(report, *COUNT_KEYS, total, total_size, min_size, max_size): AGG-1, 2, 3, 5, 7, 8, 9 and 6 from one aggregate
    over GROUPING SETS, so the rows are read once.

    A row counts once per report within its own task; what crosses the exchange is one row per report, key and task.
    The grouping id tells a NULL key from a column that the report does not count by.
    """
    numbers = {name: sum(1 << (len(COUNT_KEYS) - 1 - i) for i, k in enumerate(COUNT_KEYS) if k not in keys)
               for name, keys in COUNT_SETS.items()}
    report = F.coalesce(*(F.when(F.col("_set") == n, F.lit(name)) for name, n in numbers.items()))
    counts = (refined.withColumn("hour", hour_of("date_time"))
              .groupingSets(list(COUNT_SETS.values()), *COUNT_KEYS)
              .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("total"),
                   F.sum("content_size").cast("bigint").alias("total_size"),
                   F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size")))
    return counts.select(report.alias("report"), *COUNT_KEYS, "total", "total_size", "min_size", "max_size")


def counts_of(counts: DataFrame, report: str, name: str = "total") -> DataFrame:
    """One report's counts out of ``all_counts``."""
    return counts.where(F.col("report") == report).select(*COUNT_SETS[report], F.col("total").alias(name))


def sizes_of(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("report") == "sizes").select(
        "total_size", F.col("total").alias("n"), "min_size", "max_size",
        (F.col("total_size").cast("double") / F.col("total")).alias("avg_exact"),
        int_div("total_size", "total").alias("avg_size"))


#: The batch job's reports, each from ``all_counts``; equal to the function of the same name over the rows.
FROM_COUNTS = {
    "views_per_user": lambda c: counts_of(c, "views_per_user", "views"),
    "views_per_country": lambda c: counts_of(c, "views_per_country", "views"),
    "views_per_hour": lambda c: counts_of(c, "views_per_hour", "views").orderBy("hour"),
    "top_products": lambda c: top_k(counts_of(c, "views_per_product", "views"), 100, "views", "product"),
    "top_products_per_user": lambda c: top_k(counts_of(c, "views_per_user_product", "views"), 100, "views",
                                             ["user", "product"]),
    "content_size_stats": sizes_of,
    "response_code_counts": lambda c: counts_of(c, "response_codes"),
    "frequent_ips": lambda c: frequent_ips_from_counts(counts_of(c, "ips")),
    "top_endpoints": lambda c: top_endpoints_from_counts(counts_of(c, "endpoints")),
}
