"""Scalar functions: Java split semantics, prefixes, dates, line formatting."""

import datetime as dt

from hitlens.functions import (format_log_line, int_div, ip_prefix, minute_key, parse_logs,
                               product_from_uri, reformat_date)


def _one(spark, col_expr, value, schema="value string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_expr.alias("out")).collect()[0].out


def test_product_from_uri_java_split(spark):
    cases = {
        "/shop/catalog/p7/view": "p7",
        "/a/b/c/": "c",             # trailing empties dropped
        "/a/b/c//": "c",
        "/": None,                  # "/".split("/") is empty
        "/a/b": None,
        "a/b/c/d": "d",
        "": None,
        "http://h.example.com/fr/825?x=1": "fr",
        "/a//b/c": "b",             # inner empty kept
    }
    for uri, want in cases.items():
        assert _one(spark, product_from_uri("value"), uri) == want, uri


def test_ip_prefix(spark):
    cases = {"10.1.2.3": "10.1", "10.1": "10.1", "::1": None, "10": None,
             "10.": None, "a..b": "a.", "1.2.3.4.5": "1.2"}
    for ip, want in cases.items():
        assert _one(spark, ip_prefix("value"), ip) == want, ip


def test_reformat_date(spark):
    out = _one(spark, reformat_date("value", "dd/MMM/yyyy:HH:mm:ss Z", "yyyy-MM-dd HH:mm:ss"),
               "05/Jan/2024:03:04:05 -0100")
    assert out == "2024-01-05 04:04:05"
    assert _one(spark, reformat_date("value", "dd/MMM/yyyy", "yyyy"), "not a date") is None


def test_minute_key_and_int_div(spark):
    ts = dt.datetime(2024, 3, 4, 5, 6, 59)
    assert _one(spark, minute_key("value"), ts, "value timestamp") == "2024-03-04 05:06"
    df = spark.createDataFrame([(7, 2), (9, 0)], "a long, b long")
    assert [r.q for r in df.select(int_div("a", "b").alias("q")).collect()] == [3, None]


def test_format_then_parse_round_trip(spark):
    df = spark.createDataFrame(
        [("10.1.2.3", 42, dt.datetime(2024, 1, 2, 3, 4, 5), "GET /x/y/p1/z HTTP/1.1", 404, 77)],
        "ip string, u long, ts timestamp, req string, st int, sz long")
    line = df.select(format_log_line("ip", "u", "ts", "req", "st", "sz").alias("value"))
    text = line.collect()[0].value
    assert text == ('10.1.2.3 - 42 [02/Jan/2024:03:04:05 +0000] "GET /x/y/p1/z HTTP/1.1" '
                    '404 77 "-" "Mozilla/5.0"')
    r = parse_logs(line).collect()[0]
    assert r.is_valid and r.date_time == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert (r.user, r.response_code, r.content_size) == ("42", 404, 77)
