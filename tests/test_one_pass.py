"""Reports, rejects and counts of one pass equal those of passes of their own."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, lines_df
from hitlens import registry
from hitlens.functions import observed, parse_logs, parse_summary, rejects, split_once, valid
from hitlens.operators import reports
from hitlens.operators.refine import viewed_products
from hitlens.session import shared_dir
from hitlens.sources import fixtures
from hitlens.streaming import jobs, queries
from hitlens.streaming.metrics import BatchLog


@pytest.fixture(scope="module")
def refined(spark):
    return viewed_products(registry.access_logs(spark, SF001), registry.country_lookup(spark, SF001),
                           extra_columns=("ip_address", "request_uri", "content_size")).cache()


@pytest.mark.parametrize("name", sorted(reports.FROM_COUNTS))
def test_each_report_equals_its_own_aggregate(refined, name):
    got = reports.FROM_COUNTS[name](reports.all_counts(refined))
    expected = getattr(reports, name)(refined)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_all_reports_come_from_one_scan(spark, refined):
    path = shared_dir(spark, "t-refined")
    refined.write.parquet(path)
    plan = reports.all_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_a_null_key_is_not_a_column_left_out(spark):
    rows = spark.sql("SELECT CAST(NULL AS STRING) AS user, 'c' AS country_code, TIMESTAMP '2024-01-01 05:00:00' AS date_time, "
                     "CAST(NULL AS STRING) AS product, 200 AS response_code, 'i' AS ip_address, '/' AS request_uri, "
                     "7L AS content_size")
    counts = reports.all_counts(rows.union(rows))
    assert sorted(r.report for r in counts.collect()) == sorted(reports.COUNT_SETS)
    assert {r.total for r in counts.collect()} == {2}
    assert reports.all_counts(rows.limit(0)).where("report <> 'sizes'").collect() == []


@pytest.mark.parametrize("some", [["garbage", "", "x"], [], None])
def test_split_keeps_every_line_once(spark, some):
    lines = lines_df(spark, some) if some is not None else fixtures.log_lines(spark, SF001)
    parsed = parse_logs(lines)
    rows = split_once(parsed, shared_dir(spark, "t-split"))
    assert parse_summary(rows).collect() == parse_summary(parsed).collect()
    assert sorted(r.value for r in rejects(rows).collect()) == sorted(r.value for r in rejects(parsed).collect())
    assert sorted(map(tuple, valid(rows).collect()), key=repr) == sorted(map(tuple, valid(parsed).collect()), key=repr)
    assert rows.where("is_valid AND value IS NOT NULL").count() == 0


def test_the_pass_that_writes_parses_once(spark):
    plan = observed(parse_logs(fixtures.log_lines(spark, SF001)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "CollectMetrics" in plan


def test_the_listener_tells_lines_rejects_and_time(spark):
    told, feed = [], shared_dir(spark, "feed")
    log = BatchLog(told.append, interval_ms=10_000)
    good, bad, ckpt = (shared_dir(spark, n) for n in ("good", "bad", "ck"))
    lines = fixtures.event_log_lines(fixtures.load(spark, SF001, "events"))
    spark.streams.addListener(log)
    try:
        for part in range(2):
            lines.where(F.col("event_id") % 2 == part).select("value").coalesce(3).write.mode("append").text(feed)
            queries.await_end(jobs.start_split(spark.readStream.text(feed), good, bad, ckpt, {"availableNow": True}))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    told = [t for t in told if not t["empty"]]
    summary = registry.q_parse_summary(spark, SF001).first()
    assert [t["batch_id"] for t in told] == [0, 1] and len({t["query"] for t in told}) == 1
    for name in ("total_lines", "good_lines", "rejected_lines"):
        assert sum(t[name] for t in told) == summary[name]
    assert all(t["millis"] > 0 and t["in_time"] == (t["millis"] <= 10_000) for t in told)
    assert told[1]["in_time"]           # the first batch still compiles
    assert queries.read_batches(spark, good).count() == summary.good_lines
    assert queries.read_batches(spark, bad).count() == summary.rejected_lines
