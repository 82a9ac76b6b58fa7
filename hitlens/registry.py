"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs the library end to end on data derived from the given tables
(``events`` -> log lines -> parser -> country join -> report), over the whole
tables.  Streaming and counter queries live in :mod:`hitlens.streaming.queries`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import parse_logs, parse_summary, rejects, valid
from .functions.scalar import ip_prefix, product_from_uri, reformat_date
from .operators import reports, windows
from .operators.refine import viewed_products
from .operators.sessions import sessions
from .plans import sql_reports as sq
from .session import shared_dir, tune
from .sources import fixtures
from .sources.logs import read_logs, write_lines
from .sources.lookup import (COUNTRY_CODES, countries_table, dictionary_cut, lookup_from_lines,
                             prefix_dictionary)

Query = Callable[[SparkSession, str], DataFrame]

LINE_TIME_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"
ISO_PATTERN = "yyyy-MM-dd HH:mm:ss"


# --- shared building blocks --------------------------------------------------

def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return parse_logs(fixtures.log_lines(spark, sf_dir))


def access_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(parsed(spark, sf_dir))


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return lookup_from_lines(fixtures.lookup_lines(spark, sf_dir))


def viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viewed_products(access_logs(spark, sf_dir), country_lookup(spark, sf_dir))


def _on_viewed(fn) -> Query:
    return lambda spark, sf_dir: fn(viewed(spark, sf_dir))


def _on_logs(fn) -> Query:
    return lambda spark, sf_dir: fn(access_logs(spark, sf_dir))


def _sql(text: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sq.register_views(spark, viewed=viewed(spark, sf_dir))
        return spark.sql(text)
    return run


# --- parse / source queries ------------------------------------------------

def q_parse_good(spark, sf_dir):
    return access_logs(spark, sf_dir)


def q_parse_rejects(spark, sf_dir):
    return rejects(parsed(spark, sf_dir))


def q_parse_summary(spark, sf_dir):
    return parse_summary(parsed(spark, sf_dir))


def q_parse_text(spark, sf_dir):
    """The lines written as text files and scanned back (SRC-1), then parsed."""
    tune(spark)
    path = shared_dir(spark, "lines")
    write_lines(fixtures.log_lines(spark, sf_dir), path, mode="overwrite")
    return valid(parse_logs(read_logs(spark, path)))


def _dictionary(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        lines = fixtures.dictionary_lines(fixtures.load(spark, sf_dir, "events"), COUNTRY_CODES)
        return fn(lines, countries_table(spark), fixtures.DICT_MAX_PER_COUNTRY)
    return run


# --- scalar function queries -------------------------------------------------

def q_reformat_date(spark, sf_dir):
    """Every line's time, reformatted; NULL where a line has none or it does not parse."""
    tune(spark)
    src = F.regexp_extract("value", r"\[([^\]]+)\]", 1)
    # the generator keeps the pattern from running again above it (see parse_logs)
    stamped = fixtures.log_lines(spark, sf_dir).select(F.explode(F.array(src)).alias("src"))
    return stamped.select(F.nullif("src", F.lit("")).alias("src"),
                          reformat_date("src", LINE_TIME_PATTERN, ISO_PATTERN).alias("formatted"))


def q_product_from_uri(spark, sf_dir):
    tune(spark)
    pages = fixtures.load(spark, sf_dir, "pages")
    return pages.select("page_id", "url", product_from_uri("url").alias("product"))


def q_ip_prefix(spark, sf_dir):
    return access_logs(spark, sf_dir).select("ip_address", ip_prefix("ip_address").alias("prefix"))


def q_format_log_line(spark, sf_dir):
    tune(spark)
    return fixtures.plain_lines(fixtures.load(spark, sf_dir, "events")).select("event_id", "value")


BATCH_QUERIES: dict[str, Query] = {
    # parse, sources
    "parse_good": q_parse_good,
    "parse_rejects": q_parse_rejects,
    "parse_text": q_parse_text,
    "parse_summary": q_parse_summary,
    "country_lookup": country_lookup,
    "prefix_dictionary": _dictionary(prefix_dictionary),
    "prefix_dictionary_cut": _dictionary(dictionary_cut),
    "viewed_products": viewed,
    # reports over viewed products
    "views_per_user": _on_viewed(reports.views_per_user),
    "views_per_country": _on_viewed(reports.views_per_country),
    "views_per_hour": _on_viewed(reports.views_per_hour),
    "views_per_product": _on_viewed(reports.views_per_product),
    "top_products_100": _on_viewed(reports.top_products),
    "top_products_per_user": _on_viewed(reports.top_products_per_user),
    "top10_products": _on_viewed(reports.top10_products),
    "top10_by_name_desc": _on_viewed(reports.top10_by_name_desc),
    "frequent_countries": _on_viewed(reports.frequent_countries),
    # reports over access-log records
    "content_size_stats": _on_logs(reports.content_size_stats),
    "response_code_counts": _on_logs(reports.response_code_counts),
    "frequent_ips": _on_logs(reports.frequent_ips),
    "top_endpoints": _on_logs(reports.top_endpoints),
    "log_volume_per_minute": _on_logs(reports.log_volume_per_minute),
    # SQL texts over temp views
    "sql_views_per_user": _sql(sq.SQL_VIEWS_PER_USER),
    "sql_views_per_country": _sql(sq.SQL_VIEWS_PER_COUNTRY),
    "sql_views_per_hour": _sql(sq.SQL_VIEWS_PER_HOUR),
    "sql_top_products_10": _sql(sq.SQL_TOP_PRODUCTS_10),
    "sql_products_per_user": _sql(sq.SQL_PRODUCTS_PER_USER),
    # sliding windows (batch form)
    "sliding_window_counts": _on_viewed(windows.sliding_window_counts),
    "sliding_top_products": _on_viewed(windows.sliding_top_products),
    # all counting reports in one pass
    "all_counts": lambda spark, sf_dir: reports.all_counts(viewed_products(
        access_logs(spark, sf_dir), country_lookup(spark, sf_dir),
        extra_columns=("ip_address", "request_uri", "content_size"))),
    # sessions (batch form)
    "sessions_per_ip": _on_logs(lambda logs: sessions(logs, "ip_address")),
    "sessions_per_user": _on_logs(lambda logs: sessions(logs, "user")),
    # scalar functions
    "reformat_date": q_reformat_date,
    "product_from_uri": q_product_from_uri,
    "ip_prefix": q_ip_prefix,
    "format_log_line": q_format_log_line,
}
