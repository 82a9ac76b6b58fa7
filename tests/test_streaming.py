"""Streams against batch: all-time totals, per-batch results, replay, restart."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from hitlens import registry
from hitlens.functions import parse_logs, valid
from hitlens.operators import reports
from hitlens.operators.refine import viewed_products
from hitlens.session import shared_dir, use_rocksdb_state
from hitlens.sources import fixtures
from hitlens.sources.logs import read_log_stream
from hitlens.streaming import jobs
from hitlens.streaming.counters import CounterLedger, base_batch_id
from hitlens.streaming.runs import RunLedger
from feeds import append_feed_file

NOW = {"availableNow": True}
BOUNDS = [(0, 333), (333, 666), (666, 10**9)]


def _chunks(spark):
    lines = fixtures.event_log_lines(fixtures.load(spark, SF001, "events"))
    return [lines.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).orderBy("ts")
            for lo, hi in BOUNDS]


@pytest.fixture(scope="module")
def feed(spark):
    path = shared_dir(spark, "test-feed")
    chunks = _chunks(spark)
    for chunk in chunks:
        append_feed_file(chunk, path)
    return path, chunks


def _stream(spark, path):
    return read_log_stream(spark, "text", path, max_files_per_trigger=1)


def _run(query):
    query.awaitTermination(600)
    assert not query.isActive and query.exception() is None
    return query


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_all_time_totals_equal_batch(spark, feed):
    path, _ = feed
    use_rocksdb_state(spark)
    batch_logs = registry.access_logs(spark, SF001)
    cases = [
        (jobs.status_totals, None, reports.response_code_counts(batch_logs),
         ("response_code", "total")),
        (jobs.ip_totals, reports.frequent_ips_from_counts, reports.frequent_ips(batch_logs),
         ("ip_address", "total")),
        (jobs.endpoint_totals, reports.top_endpoints_from_counts,
         reports.top_endpoints(batch_logs), ("request_uri", "total")),
        (jobs.size_totals, jobs.with_int_avg, reports.content_size_stats(batch_logs),
         ("total_size", "n", "min_size", "max_size", "avg_size")),
    ]
    for state_fn, finish, expected, cols in cases:
        out = shared_dir(spark, "t-out")
        logs = jobs.access_log_stream(_stream(spark, path))
        q = _run(jobs.start_all_time(state_fn(logs), out, shared_dir(spark, "t-ck"), finish, NOW))
        assert len(q.recentProgress) >= 3      # one micro-batch per file
        assert _rows(jobs.read_published(spark, out), *cols) == _rows(expected, *cols)


def test_per_batch_top_products_equal_brute_force(spark, feed):
    path, chunks = feed
    out = shared_dir(spark, "t-out")
    lookup = registry.country_lookup(spark, SF001)
    _run(jobs.start_batch_top_products(_stream(spark, path), lookup, out,
                                       shared_dir(spark, "t-ck"), trigger=NOW))
    got = spark.read.parquet(out)
    assert sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == [0, 1, 2]
    for i, chunk in enumerate(chunks):
        expected = reports.top_products(viewed_products(valid(parse_logs(chunk)), lookup), 10)
        assert _rows(got.where(F.col("batch_id") == i), "product", "views") == \
            _rows(expected, "product", "views")


def test_size_stats_last_and_sql_reports(spark, feed):
    path, chunks = feed
    ledger = shared_dir(spark, "t-out")
    _run(jobs.start_size_stats_ledger(_stream(spark, path), ledger, shared_dir(spark, "t-ck"), NOW))
    last = jobs.size_stats_last(spark.read.parquet(ledger)).collect()[0]
    every = reports.content_size_stats(registry.access_logs(spark, SF001)).collect()[0]
    final = reports.content_size_stats(valid(parse_logs(chunks[-1]))).collect()[0]
    assert (last.total_size, last.n) == (every.total_size, every.n)
    assert (last.min_size, last.max_size, last.last_batch_id) == (final.min_size, final.max_size, 2)

    out = shared_dir(spark, "t-out")
    _run(jobs.start_sql_reports(_stream(spark, path), out, shared_dir(spark, "t-ck"), NOW))
    got = spark.read.parquet(out)
    for i, chunk in enumerate(chunks):
        stats = reports.content_size_stats(valid(parse_logs(chunk))).collect()[0]
        part = {r.key: r.value for r in got.where(
            (F.col("batch_id") == i) & (F.col("report") == "size_stats")).collect()}
        assert part == {"total_size": stats.total_size, "n": stats.n, "min_size": stats.min_size,
                        "max_size": stats.max_size, "avg_size": stats.avg_size}
        codes = got.where((F.col("batch_id") == i) & (F.col("report") == "response_codes"))
        expected = reports.response_code_counts(valid(parse_logs(chunk)))
        assert _rows(codes.select(F.col("key").cast("int").alias("k"), F.col("value").alias("v")),
                     "k", "v") == \
            _rows(expected.select(F.col("response_code").alias("k"), F.col("total").alias("v")),
                  "k", "v")


def _counter_totals(ledger):
    return {t: _rows(ledger.totals(t), *ledger.totals(t).columns)
            for t in ("page_views", "log_volume_by_minute", "status_counter", "visits_by_country")}


def _batch_counters(spark):
    vp = registry.viewed(spark, SF001)
    from hitlens.functions.scalar import minute_key
    return {
        "page_views": _rows(reports.count_by(vp, F.col("product").alias("page"), "views"),
                            "page", "views"),
        "log_volume_by_minute": _rows(reports.count_by(
            vp, minute_key("date_time").alias("timestamp"), "count"), "timestamp", "count"),
        "status_counter": _rows(reports.count_by(
            vp, F.col("response_code").alias("status_code"), "count"), "status_code", "count"),
        "visits_by_country": _rows(reports.count_by(
            vp, F.col("country_code").alias("country"), "count"), "country", "count"),
    }


def _ledger(spark):
    location = shared_dir(spark, "t-counters")
    ledger = CounterLedger(spark, "t_counters_" + uuid.uuid4().hex[:8], location)
    ledger.create_schema()
    return ledger


def _parts(ledger, table):
    return sorted((r.stream_id, r.batch_id) for r in
                  ledger.ledger(table).select("stream_id", "batch_id").distinct().collect())


def test_counters_of_two_streams_add_up_and_replays_do_not(spark, feed):
    path, _ = feed
    lookup = registry.country_lookup(spark, SF001)
    ledger = _ledger(spark)
    _run(jobs.start_counters(_stream(spark, path), lookup, ledger, shared_dir(spark, "t-ck"), NOW))
    once = _batch_counters(spark)
    assert _counter_totals(ledger) == once
    first = _parts(ledger, "page_views")[0][0]
    # the same stream's batch again: its partition is replaced
    chunk = viewed_products(valid(parse_logs(_chunks(spark)[0])), lookup)
    ledger.apply_batch(chunk, 0, first)
    assert _counter_totals(ledger) == once
    # another stream with a checkpoint of its own adds to the totals, also after a compaction
    ledger.compact("page_views", first, 1)
    _run(jobs.start_counters(_stream(spark, path), lookup, ledger, shared_dir(spark, "t-ck"), NOW))
    twice = {t: [(k, 2 * n) for k, n in rows] for t, rows in once.items()}
    assert _counter_totals(ledger) == twice
    parts = _parts(ledger, "page_views")
    second = next(s for s, _ in parts if s != first)
    assert [b for s, b in parts if s == first] == [base_batch_id(1), 2]
    assert [b for s, b in parts if s == second] == [0, 1, 2]
    views = ledger.read("SELECT sum(views) AS s FROM page_views").collect()[0].s
    assert views == 2 * registry.access_logs(spark, SF001).count()
    # a compaction stopped before its drops, and a replay of a folded batch, change nothing
    ledger._write("page_views", reports.count_by(chunk, F.col("product").alias("page"), "views"), first, 0)
    ledger._write("page_views", reports.count_by(chunk, F.col("product").alias("page"), "views"), first,
                  base_batch_id(0))
    assert _counter_totals(ledger) == twice
    ledger.drop_table("page_views")
    ledger.drop_schema()


def test_counter_restart_from_checkpoint(spark):
    path = shared_dir(spark, "t-feed2")
    chunks = _chunks(spark)
    lookup = registry.country_lookup(spark, SF001)
    ledger = _ledger(spark)
    ckpt = shared_dir(spark, "t-ck")
    for chunk in chunks[:2]:
        append_feed_file(chunk, path)
    _run(jobs.start_counters(_stream(spark, path), lookup, ledger, ckpt, NOW))
    append_feed_file(chunks[2], path)
    q = _run(jobs.start_counters(_stream(spark, path), lookup, ledger, ckpt, NOW))
    assert [p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0] == [2]
    assert _counter_totals(ledger) == _batch_counters(spark)
    ledger.drop_schema()


def test_state_free_totals_equal_batch(spark, feed):
    path, _ = feed
    batch_logs = registry.access_logs(spark, SF001)
    cases = [
        (jobs.ip_totals, "ip_address", {"total": "sum"}, reports.frequent_ips_from_counts,
         reports.frequent_ips(batch_logs), ("ip_address", "total")),
        (jobs.endpoint_totals, "request_uri", {"total": "sum"}, reports.top_endpoints_from_counts,
         reports.top_endpoints(batch_logs), ("request_uri", "total")),
        (jobs.size_totals, [], {"total_size": "sum", "n": "sum", "min_size": "min",
                                "max_size": "max"}, jobs.with_int_avg,
         reports.content_size_stats(batch_logs),
         ("total_size", "n", "min_size", "max_size", "avg_size")),
    ]
    for partial, keys, folds, finish, expected, cols in cases:
        ledger = RunLedger(spark, shared_dir(spark, "t-deltas"), keys, folds, fan=2)
        logs = jobs.access_log_stream(_stream(spark, path))
        _run(jobs.start_all_time_deltas(logs, partial, ledger, shared_dir(spark, "t-ck"), NOW))
        assert [(r["level"], r["first"], r["last"]) for r in ledger.manifest.entries()] == [(1, 0, 1), (0, 2, 2)]
        assert _rows(finish(ledger.totals()), *cols) == _rows(expected, *cols)


def test_published_versions(spark):
    path = shared_dir(spark, "t-out")
    for v in (0, 1, 1):
        jobs.publish(spark.range(v + 2), path, v)
    assert jobs.read_published(spark, path).count() == 3 and jobs.read_published(spark, path).columns == ["id"]


def test_all_time_state_survives_restart(spark):
    use_rocksdb_state(spark)
    path = shared_dir(spark, "t-feed3")
    chunks = _chunks(spark)
    out, ckpt = shared_dir(spark, "t-out"), shared_dir(spark, "t-ck")
    for chunk in chunks[:2]:
        append_feed_file(chunk, path)
    logs = jobs.access_log_stream(_stream(spark, path))
    _run(jobs.start_all_time(jobs.ip_totals(logs), out, ckpt, reports.frequent_ips_from_counts, NOW))
    append_feed_file(chunks[2], path)
    logs = jobs.access_log_stream(_stream(spark, path))
    q = _run(jobs.start_all_time(jobs.ip_totals(logs), out, ckpt, reports.frequent_ips_from_counts,
                                 NOW))
    # only the new file is read after the restart; the counts come from the state
    assert [p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0] == [2]
    expected = reports.frequent_ips(registry.access_logs(spark, SF001))
    assert _rows(jobs.read_published(spark, out), "ip_address", "total") == \
        _rows(expected, "ip_address", "total")


@pytest.mark.parametrize("files", [1, 40])
def test_micro_batch_is_the_next_slice_that_has_lines(spark, files):
    """Results do not depend on the number of files, and an empty or thin slice shifts nothing."""
    from hitlens.streaming.feed import time_slice
    from hitlens.streaming.queries import run_slices
    lines = fixtures.event_log_lines(fixtures.load(spark, SF001, "events"))
    us = F.unix_micros(F.col("ts"))
    lo, hi = lines.agg(F.min(us), F.max(us)).first()
    sliced = lines.withColumn("s", time_slice("ts", lo, hi, 4))
    # slice 1 goes, slice 2 keeps three lines
    some = sliced.where("s <> 1 AND (s <> 2 OR event_id % 100 = 7)").repartition(files)
    out = shared_dir(spark, "t-out")
    assert run_slices(spark, some, lambda stream, ck: jobs.start_size_stats_ledger(stream, out, ck, NOW)) == 3
    got = {r.batch_id: (r.n, r.min_size, r.max_size) for r in spark.read.parquet(out).collect()}
    for batch, s in enumerate((0, 2, 3)):
        r = reports.content_size_stats(valid(parse_logs(some.where(F.col("s") == s)))).first()
        assert got[batch] == (r.n, r.min_size, r.max_size)


def test_slices_grow_with_the_lines():
    from hitlens.streaming.feed import LINES_PER_SLICE, slice_count
    assert [slice_count(n) for n in (0, 5, 4 * LINES_PER_SLICE, 9 * LINES_PER_SLICE + 1)] == [4, 4, 4, 10]


def test_sliding_jobs_restart_from_their_checkpoint(spark):
    """Windows that are open when a run ends are closed by the next one, once."""
    from hitlens.operators import windows
    from hitlens.streaming.queries import run_slices
    lines = fixtures.event_log_lines(fixtures.load(spark, SF001, "events"))
    out = shared_dir(spark, "t-out")
    run_slices(spark, lines, lambda stream, ck: jobs.start_sliding_top_products(stream, out, ck, k=3, trigger=NOW),
               stateful=True, n_slices=3)
    logs = registry.access_logs(spark, SF001)
    last = logs.agg(F.max("date_time")).first()[0]
    vp = registry.viewed(spark, SF001)
    closed = windows.sliding_top_products(vp, 3).where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 1 MINUTE"))
    cols = ("window_start", "window_end", "product", "views", "rank")
    assert _rows(spark.read.parquet(out), *cols) == _rows(closed, *cols)


def test_counter_ledger_compacts_inside_the_stream(spark, feed):
    path, _ = feed
    location = shared_dir(spark, "t-counters")
    ledger = CounterLedger(spark, "t_counters_" + uuid.uuid4().hex[:8], location, compact_every=2)
    ledger.create_schema()
    _run(jobs.start_counters(_stream(spark, path), registry.country_lookup(spark, SF001), ledger,
                             shared_dir(spark, "t-ck"), NOW))
    # after writing its own rows, batch 2 folded batches 0..1 into a base
    assert [b for _, b in _parts(ledger, "status_counter")] == [base_batch_id(1), 2]
    assert _counter_totals(ledger) == _batch_counters(spark)
    ledger.drop_schema()


@pytest.mark.parametrize("job", ["sql_reports", "top_products", "without_repeats"])
def test_a_micro_batch_passes_its_state_once(spark, job):
    """However often its rows are read; the SQL reports keep an entry per row and window, not four."""
    from hitlens.streaming.queries import stream_settings
    line = '10.0.0.%d - u%d [01/Jan/2024:00:00:%02d +0000] "GET /shop/catalog/p%d/view HTTP/1.1" 200 %d "-" "a"'
    rows = [(line % (i, i, i, i, i),) for i in range(30)]
    rows.append(('9.9.9.9 - z [01/Jan/2024:01:00:00 +0000] "GET /shop/catalog/z/view HTTP/1.1" 404 1 "-" "a"',))
    path, out, ckpt = (shared_dir(spark, n) for n in ("t-feed", "t-out", "t-ck"))
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(path)
    lines = _stream(spark, path)
    with stream_settings(spark, 2):
        if job == "sql_reports":
            query = jobs.start_sliding_sql_reports(lines, out, ckpt, trigger=NOW)
        elif job == "top_products":
            query = jobs.start_sliding_top_products(lines, out, ckpt, trigger=NOW)
        else:
            ledger = RunLedger(spark, out, "response_code", jobs.SUM_TOTAL)
            query = jobs.start_all_time_deltas(
                jobs.without_repeats(lines, "1 minute"), jobs.status_totals, ledger, ckpt, NOW)
        _run(query)
    state = [s for p in query.recentProgress for s in p["stateOperators"]]
    windows_each = 1 if job == "without_repeats" else 3
    assert sum(s["numRowsUpdated"] for s in state) == 31 * windows_each
    assert sum(s["numRowsRemoved"] for s in state) == 30 * windows_each
    if job == "without_repeats":
        assert _rows(ledger.totals(), "response_code", "total") == [(200, 30), (404, 1)]
        return
    got = spark.read.parquet(out)
    assert got.groupBy("window_start").count().count() == 5
    if job == "sql_reports":
        sizes = got.where("report = 'size_stats' AND key IN ('n', 'total_size') AND hour(window_start) = 0 "
                          "AND minute(window_start) = 0 AND second(window_start) = 0")
        assert _rows(sizes, "key", "value") == [("n", 30), ("total_size", sum(range(30)))]
        tops = got.where("report = 'top_endpoints'").groupBy("window_start").count()
        assert max(r["count"] for r in tops.collect()) == 10
