"""Adapters from the driver tables to the inputs this library reads.

The reference reads raw access-log text and a prefix -> country file; the
test data holds ``events`` and ``nation`` tables instead.  These functions turn
them into log lines and lookup lines with fixed rules (FIXTURES.md §3): every row
of a table gives its line, and some give further lines of odd or broken shape
next to it.  So the whole pipeline - text, parser, join, reports - runs over data that grows with
the tables, and an SQL oracle can compute the same answers straight from
``events`` without sharing the parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import format_ipv4, format_log_line
from ..session import table_path

# Fixed values of the fixture rules (FIXTURES.md §3).
REJECT_EVERY = 97          # event_id % 97 = 0 -> one more line, which the parser must reject
ODD_EVERY = 53             # event_id % 53 = 0 -> one more line of a shape that real logs have
SHORT_URI_EVERY = 89       # event_id % 89 = 0 -> request "/" without a protocol (no product)
SECOND_OCTETS = 7          # second octet is user_id % 7
REJECT_LINES = [
    "garbage line",
    "",
    '1.2.3.4 - u [99/Zzz/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 1 "-" "a"',
    '1.2.3.4 - u [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 20 1 "-" "a"',
]

# Dictionary fixture: country codes beyond the 20 listed ones are dropped by
# the loader; every 41st event gives one more line, with a third field.
EXTRA_CODES = ["AQ", "BV", "HM"]
DICT_BAD_EVERY = 41
DICT_MAX_PER_COUNTRY = 100


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _plain_line() -> Column:
    uid, eid = F.col("user_id"), F.col("event_id")
    ip = format_ipv4(F.lit(10) + uid % 25, uid % 7, uid % 250, eid % 8)
    request = F.when(eid % SHORT_URI_EVERY == 0, F.lit("GET /")).otherwise(
        F.concat(F.lit("GET /shop/catalog/p"), F.get_json_object("props", "$.k"),
                 F.lit("/"), F.col("event_type"), F.lit(" HTTP/1.1")))
    status = (F.when(F.col("event_type") == "error", 500)
               .when(F.col("event_type") == "signup", 404).otherwise(200))
    return format_log_line(ip, uid, F.col("ts").cast("timestamp"), request, status, eid * 37 % 4096)


def _odd_line() -> Column:
    """A timed-out request from a named host: no request line, no size, an offset, escaped quotes."""
    local = F.col("ts").cast("timestamp") + F.expr("INTERVAL 2 HOURS")
    return F.concat(
        F.lit("localhost - - ["), F.date_format(local, "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0200] "-" 408 - "http://ref.example/'), F.col("event_id").cast("string"),
        F.lit('" "Mozilla \\"quoted\\" '), (F.col("event_id") % 3).cast("string"), F.lit('"'))


def plain_lines(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, value): one combined-format line per event."""
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), _plain_line().alias("value"))


def event_log_lines(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, value): the line of every event, and the odd and broken ones next to it."""
    eid = F.col("event_id")
    broken = F.get(F.array(*map(F.lit, REJECT_LINES)),
                   (F.floor(eid / REJECT_EVERY) % len(REJECT_LINES)).cast("int"))
    lines = F.array(_plain_line(), F.when(eid % REJECT_EVERY == 0, broken), F.when(eid % ODD_EVERY == 0, _odd_line()))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.explode(lines).alias("value")).where(
        F.col("value").isNotNull())


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines (``value``) built from the ``events`` table."""
    return event_log_lines(load(spark, sf_dir, "events")).select("value")


def nation_lookup_lines(nation: DataFrame) -> DataFrame:
    """nation -> lookup lines ``(10+key).b NAME`` for b in 0..6, with what a real file has besides.

    The first prefix of each nation has an older line before it (the later one
    must win); a line with one field and one with an impossible prefix follow.
    """
    key = F.col("n_nationkey").cast("bigint")
    prefix = lambda b: F.concat_ws(".", (key + 10).cast("string"), b.cast("string"))
    octet = F.explode(F.sequence(F.lit(0), F.lit(SECOND_OCTETS - 1))).alias("b")
    rows = nation.select("n_nationkey", "n_name", octet).select(
        F.concat_ws(" ", prefix(F.col("b")), "n_name").alias("value"),
        (key * 10 + 1 + F.col("b")).alias("line_order"))
    extra = nation.select(F.explode(F.array(
        F.struct(F.concat_ws(" ", prefix(F.lit(0)), F.lit("OLD")).alias("value"), (key * 10).alias("line_order")),
        F.struct(prefix(F.lit(1)).alias("value"), (key * 10 + 8).alias("line_order")),
        F.struct(F.concat(F.lit("999."), key.cast("string"), F.lit(" XX")).alias("value"),
                 (key * 10 + 9).alias("line_order")))).alias("x")).select("x.value", "x.line_order")
    return rows.unionByName(extra)


def lookup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nation_lookup_lines(load(spark, sf_dir, "nation"))


def dictionary_lines(events: DataFrame, listed_codes: list[str]) -> DataFrame:
    """events -> class-B dictionary lines ``a.b CODE`` in event_id order."""
    codes = F.array(*[F.lit(c) for c in listed_codes + EXTRA_CODES])
    n_codes = len(listed_codes) + len(EXTRA_CODES)
    uid, eid = F.col("user_id"), F.col("event_id")
    prefix = F.concat_ws(".", (F.lit(10) + uid % 25).cast("string"), (eid % 256).cast("string"))
    code = F.get(codes, (uid % n_codes).cast("int"))
    base = F.concat_ws(" ", prefix, code)
    bad = F.when(eid % DICT_BAD_EVERY == 0, F.concat(base, F.lit(" x")))
    lines = F.posexplode(F.array(bad, base)).alias("i", "value")
    return events.select(eid.alias("eid"), lines).where(F.col("value").isNotNull()).select("value", (F.col("eid") * 2 + F.col("i")).alias("line_order"))
