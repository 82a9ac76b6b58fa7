"""Registered streaming and counter queries.

Each runs Structured Streaming queries over a text feed made from ``events``
and returns the result table read back with Spark.  The lines are staged once
by slice of the time span; a slice is appended, the query runs with
``availableNow`` to its end on the one checkpoint, then the next slice
follows.  So micro-batch b is the b-th slice that has lines, and every key has
SQL computing it from ``events``.  Feeds, checkpoints and ledgers are removed
after use; only the result stays.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports
from ..plans.oracle import ACCESS_COLS, ORACLE_SQL, _with, sessions_sql
from ..registry import country_lookup
from ..session import ROCKSDB_PROVIDER, remove_dir, shared_dir, tune
from ..sources import fixtures
from ..sources.logs import read_log_stream
from ..streaming import jobs
from ..streaming.counters import CounterLedger
from ..streaming.feed import append_slice, stage_slices
from ..streaming.runs import RunLedger

AVAILABLE_NOW = {"availableNow": True}
COMPACT_EVERY = 2           # ledgers are folded every 2 batches
COUNTER_SLICES = 3          # batches of each of the two counter streams; totals do not depend on it


def await_end(query) -> None:
    """Wait until the query has ended by itself; there is no time limit."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None):
    """RocksDB state and as many state partitions as the cluster has cores (fixed in a new
    checkpoint); the session's own settings are put back afterwards."""
    new = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
           "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_slices(spark: SparkSession, lines: DataFrame, start, stateful: bool = False,
               n_slices: int | None = None, times: int = 1) -> int:
    """Feed ``lines`` (ts, value) slice by slice, each ``times`` times, to ``start(stream, checkpoint)``; returns the
    number of slices."""
    staged, incoming, checkpoint = (shared_dir(spark, n) for n in ("slices", "feed", "ckpt"))
    slices = stage_slices(lines, staged, n_slices=n_slices)
    for s in [s for s in slices for _ in range(times)]:
        append_slice(spark, staged, s, incoming)
        stream = read_log_stream(spark, "text", incoming)
        if stateful:
            with stream_settings(spark):
                query = start(stream, checkpoint)
                await_end(query)
        else:
            await_end(start(stream, checkpoint))
    for path in (staged, incoming, checkpoint):
        remove_dir(spark, path)
    return len(slices)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return fixtures.event_log_lines(fixtures.load(spark, sf_dir, "events"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by ``batch_id``, with the id typed as written (BIGINT)."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _all_time(state_fn, finish=None):
    """STR-4, STR-7: few keys, complete mode."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = shared_dir(spark, "out")
        run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_all_time(
            state_fn(jobs.access_log_stream(stream)), out, ckpt, finish, AVAILABLE_NOW), stateful=True)
        return jobs.read_published(spark, out)
    return run


def _all_time_deltas(partial, key: str, finish):
    """STR-5, STR-6: unbounded keys, per-batch partials in levelled runs."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ledger = RunLedger(spark, shared_dir(spark, "out"), key, jobs.SUM_TOTAL, COMPACT_EVERY)
        run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_all_time_deltas(
            jobs.access_log_stream(stream), partial, ledger, ckpt, AVAILABLE_NOW))
        return finish(ledger.totals())
    return run


def q_stream_top_endpoints_total(spark, sf_dir):
    """STR-6, TOP-2: the largest counts of all time from summaries, then exactly."""
    ledger = RunLedger(spark, shared_dir(spark, "out"), "request_uri", jobs.SUM_TOTAL, COMPACT_EVERY, rank_by="total")
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_all_time_deltas(
        jobs.access_log_stream(stream), jobs.endpoint_totals, ledger, ckpt, AVAILABLE_NOW))
    return ledger.top(10)


def _sessions(key: str):
    """STR-14: closed sessions of each key."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = shared_dir(spark, "out")
        run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_sessions(
            stream, key, out, ckpt, trigger=AVAILABLE_NOW), stateful=True)
        return spark.read.parquet(out)
    return run


REPEAT_DELAY, LATE_BY, LATE_DELAY = "10 days", "8 days", "1 day"


def q_stream_without_repeats(spark, sf_dir):
    """STR-14: every slice of the lines comes twice; hits per response code as if it came once."""
    ledger = RunLedger(spark, shared_dir(spark, "out"), "response_code", jobs.SUM_TOTAL, COMPACT_EVERY)
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_all_time_deltas(
        jobs.without_repeats(stream, REPEAT_DELAY), jobs.status_totals, ledger, ckpt, AVAILABLE_NOW),
        stateful=True, times=2)
    return ledger.totals()


def q_stream_late_lines(spark, sf_dir):
    """STR-14: lines of every 10th event come 8 days late; rows on time and late of each micro-batch."""
    on_time, late = shared_dir(spark, "out"), shared_dir(spark, "late")
    held = F.when(F.col("event_id") % 10 == 0, F.expr(f"INTERVAL {LATE_BY}")).otherwise(F.expr("INTERVAL 0 days"))
    lines = event_lines(spark, sf_dir).withColumn("ts", F.col("ts") + held)
    run_slices(spark, lines, lambda stream, ckpt: jobs.start_late_split(
        stream, on_time, late, ckpt, LATE_DELAY, AVAILABLE_NOW))
    rows = read_batches(spark, on_time).withColumn("late", F.lit(False)).unionByName(
        read_batches(spark, late).withColumn("late", F.lit(True)))
    return rows.groupBy("batch_id", "late").agg(
        F.count("*").alias("hits"), F.sum("content_size").cast("bigint").alias("bytes"))


def q_stream_batch_top_products(spark, sf_dir):
    out, lookup = shared_dir(spark, "out"), country_lookup(spark, sf_dir)
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_batch_top_products(
        stream, lookup, out, ckpt, trigger=AVAILABLE_NOW))
    return read_batches(spark, out)


def q_stream_size_stats_last(spark, sf_dir):
    out = shared_dir(spark, "out")
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_size_stats_ledger(
        stream, out, ckpt, AVAILABLE_NOW))
    return jobs.size_stats_last(read_batches(spark, out))


def q_stream_sql_reports(spark, sf_dir):
    out = shared_dir(spark, "out")
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_sql_reports(
        stream, out, ckpt, AVAILABLE_NOW))
    return read_batches(spark, out)


def q_stream_sliding_top_products(spark, sf_dir):
    out = shared_dir(spark, "out")
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_sliding_top_products(
        stream, out, ckpt, trigger=AVAILABLE_NOW), stateful=True)
    return spark.read.parquet(out).drop("batch_id")


def q_stream_sliding_sql_reports(spark, sf_dir):
    out = shared_dir(spark, "out")
    run_slices(spark, event_lines(spark, sf_dir), lambda stream, ckpt: jobs.start_sliding_sql_reports(
        stream, out, ckpt, trigger=AVAILABLE_NOW), stateful=True)
    return spark.read.parquet(out).drop("batch_id")


def with_counters(spark: SparkSession, sf_dir: str, read) -> DataFrame:
    """STR-13: the counter stream over two halves of the lines, each a stream with a checkpoint of its own
    into one ledger; ``read(ledger)`` is kept, the ledger dropped."""
    lines, lookup = event_lines(spark, sf_dir), country_lookup(spark, sf_dir)
    location = shared_dir(spark, "counters")
    ledger = CounterLedger(spark, "hitlens_counters_" + location.rsplit("-", 1)[-1], location,
                           compact_every=COMPACT_EVERY)
    ledger.create_schema()
    for half in (0, 1):
        run_slices(spark, lines.where(F.col("event_id") % 2 == half), lambda stream, ckpt: jobs.start_counters(
            stream, lookup, ledger, ckpt, AVAILABLE_NOW), n_slices=COUNTER_SLICES)
    out = shared_dir(spark, "out")
    read(ledger).write.parquet(out)
    ledger.drop_schema()
    remove_dir(spark, location)
    return spark.read.parquet(out)


def _counter(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: with_counters(spark, sf_dir, lambda ledger: ledger.totals(table))


COUNTER_READ_SQL = "SELECT page, views FROM page_views WHERE views > 10"

STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_batch_top_products": q_stream_batch_top_products,
    "stream_status_total": _all_time(jobs.status_totals),
    "stream_frequent_ips_total": _all_time_deltas(jobs.ip_totals, "ip_address", reports.frequent_ips_from_counts),
    "stream_top_endpoints_total": q_stream_top_endpoints_total,
    "stream_size_stats_total": _all_time(jobs.size_totals, jobs.with_int_avg),
    "stream_size_stats_last": q_stream_size_stats_last,
    "stream_sql_reports": q_stream_sql_reports,
    "stream_sliding_top_products": q_stream_sliding_top_products,
    "stream_sliding_sql_reports": q_stream_sliding_sql_reports,
    "stream_sessions_per_ip": _sessions("ip_address"),
    "stream_sessions_per_user": _sessions("user"),
    "stream_without_repeats": q_stream_without_repeats,
    "stream_late_lines": q_stream_late_lines,
    "counter_page_views": _counter("page_views"),
    "counter_log_volume": _counter("log_volume_by_minute"),
    "counter_status": _counter("status_counter"),
    "counter_country": _counter("visits_by_country"),
    "counter_read": lambda spark, sf_dir: with_counters(spark, sf_dir, lambda ledger: ledger.read(COUNTER_READ_SQL)),
}

def _slices(late: str = "INTERVAL 0 DAYS") -> str:
    """Micro-batch b is the b-th slice of the lines' time span that has lines; as many slices as the lines need.
    ``late`` is what a line's arrival adds to its event's time."""
    arrival = f"(ts + {late})"
    return f"""lines AS (SELECT {arrival} AS ts FROM events UNION ALL SELECT {arrival} FROM events WHERE event_id % 97 = 0
  UNION ALL SELECT {arrival} FROM events WHERE event_id % 53 = 0),
bounds AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi,
           greatest(4, CAST(ceil(count(*) / 2000000.0) AS BIGINT)) AS parts FROM lines),
slices AS (SELECT slice, row_number() OVER (ORDER BY slice) - 1 AS batch_id FROM (
  SELECT DISTINCT ((epoch_us(ts) - lo) * parts) // (hi - lo + 1) AS slice FROM lines, bounds)),
gb AS (SELECT g.*, s.batch_id FROM (SELECT *, event_ts AS ts FROM good) g, bounds b, slices s
       WHERE s.slice = ((epoch_us({arrival}) - b.lo) * b.parts) // (b.hi - b.lo + 1))"""


SLICES = _slices()
# windows whose end the watermark has passed
CLOSED = """win AS (
  SELECT time_bucket(INTERVAL '10 seconds', date_time) - to_seconds(k * 10) AS window_start, good.*
  FROM good, (SELECT unnest(range(3)) AS k) ks),
closed AS (SELECT *, window_start + INTERVAL '30 seconds' AS window_end FROM win
  WHERE window_start + INTERVAL '30 seconds' <= (SELECT max(date_time) FROM good) - INTERVAL '1 minute')"""
BATCH_STATS = """stats AS (SELECT batch_id, CAST(sum(content_size) AS BIGINT) AS total_size,
  count(*) AS n, min(content_size) AS min_size, max(content_size) AS max_size,
  CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size FROM gb GROUP BY batch_id)"""

STREAM_ORACLE_SQL: dict[str, str] = {
    "stream_batch_top_products": _with(
        "SELECT batch_id, product, views FROM (SELECT batch_id, product, count(*) AS views, "
        "row_number() OVER (PARTITION BY batch_id ORDER BY count(*) DESC, "
        "product ASC NULLS LAST) AS rn FROM gb GROUP BY batch_id, product) t WHERE rn <= 10",
        SLICES),
    "stream_size_stats_last": _with(
        "SELECT CAST(sum(content_size) AS BIGINT) AS total_size, count(*) AS n, "
        "min(CASE WHEN batch_id = l.last_batch_id THEN content_size END) AS min_size, "
        "max(CASE WHEN batch_id = l.last_batch_id THEN content_size END) AS max_size, "
        "l.last_batch_id AS last_batch_id, "
        "CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size "
        "FROM gb, (SELECT max(batch_id) AS last_batch_id FROM gb) l GROUP BY l.last_batch_id",
        SLICES),
    "stream_sql_reports": _with(
        " UNION ALL ".join(
            f"SELECT 'size_stats' AS report, '{c}' AS key, {c} AS value, batch_id FROM stats"
            for c in ("total_size", "n", "min_size", "max_size", "avg_size"))
        + " UNION ALL SELECT 'response_codes', CAST(response_code AS VARCHAR), count(*), batch_id "
          "FROM gb GROUP BY batch_id, response_code"
        + " UNION ALL SELECT 'frequent_ips', ip_address, count(*), batch_id "
          "FROM gb GROUP BY batch_id, ip_address HAVING count(*) > 10"
        + " UNION ALL SELECT 'top_endpoints', request_uri, total, batch_id FROM ("
          "SELECT batch_id, request_uri, count(*) AS total, row_number() OVER (PARTITION BY batch_id "
          "ORDER BY count(*) DESC, request_uri ASC NULLS LAST) AS rn FROM gb "
          "GROUP BY batch_id, request_uri) t WHERE rn <= 10",
        SLICES, BATCH_STATS),
    "stream_sliding_top_products": _with(
        "SELECT window_start, window_end, product, views, CAST(rank AS INTEGER) AS rank FROM ("
        "SELECT window_start, window_end, product, count(*) AS views, row_number() OVER ("
        "PARTITION BY window_start ORDER BY count(*) DESC, product ASC NULLS LAST) AS rank "
        "FROM closed GROUP BY window_start, window_end, product) WHERE rank <= 10", CLOSED),
    "stream_sliding_sql_reports": _with(
        " UNION ALL ".join(
            f"SELECT window_start, window_end, 'size_stats' AS report, '{c}' AS key, CAST({v} AS BIGINT) AS value "
            "FROM closed GROUP BY window_start, window_end"
            for c, v in (("total_size", "sum(content_size)"), ("n", "count(*)"), ("min_size", "min(content_size)"),
                         ("max_size", "max(content_size)"), ("avg_size", "sum(content_size) // count(*)")))
        + " UNION ALL SELECT window_start, window_end, 'response_codes', CAST(response_code AS VARCHAR), count(*) "
          "FROM closed GROUP BY window_start, window_end, response_code"
        + " UNION ALL SELECT window_start, window_end, 'frequent_ips', ip_address, count(*) "
          "FROM closed GROUP BY window_start, window_end, ip_address HAVING count(*) > 10"
        + " UNION ALL SELECT window_start, window_end, 'top_endpoints', request_uri, total FROM ("
          "SELECT window_start, window_end, request_uri, count(*) AS total, row_number() OVER ("
          "PARTITION BY window_start ORDER BY count(*) DESC, request_uri ASC NULLS LAST) AS rn "
          "FROM closed GROUP BY window_start, window_end, request_uri) WHERE rn <= 10", CLOSED),
    "stream_sessions_per_ip": sessions_sql("ip_address", closed=True),
    "stream_sessions_per_user": sessions_sql("user", closed=True),
    "stream_without_repeats": _with(
        f"SELECT response_code, count(*) AS total FROM (SELECT DISTINCT {ACCESS_COLS} FROM good) GROUP BY 1"),
    "stream_late_lines": _with(
        "SELECT batch_id, late, count(*) AS hits, CAST(sum(content_size) AS BIGINT) AS bytes FROM ("
        "SELECT gb.*, coalesce(date_time < passed, false) AS late FROM gb JOIN ("
        "SELECT batch_id, max(max(date_time)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
        "- INTERVAL 1 DAY AS passed FROM gb GROUP BY batch_id) USING (batch_id)) GROUP BY 1, 2",
        _slices("CASE WHEN event_id % 10 = 0 THEN INTERVAL 8 DAYS ELSE INTERVAL 0 DAYS END")),
    "stream_status_total": ORACLE_SQL["response_code_counts"],
    "stream_frequent_ips_total": ORACLE_SQL["frequent_ips"],
    "stream_top_endpoints_total": ORACLE_SQL["top_endpoints"],
    "stream_size_stats_total": _with(
        "SELECT CAST(sum(content_size) AS BIGINT) AS total_size, count(*) AS n, "
        "min(content_size) AS min_size, max(content_size) AS max_size, "
        "CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size FROM good"),
    "counter_page_views": _with("SELECT product AS page, count(*) AS views FROM good GROUP BY product"),
    "counter_log_volume": _with(
        "SELECT strftime(date_time, '%Y-%m-%d %H:%M') AS \"timestamp\", count(*) AS \"count\" "
        "FROM good GROUP BY 1"),
    "counter_status": _with(
        "SELECT response_code AS status_code, count(*) AS \"count\" FROM good GROUP BY 1"),
    "counter_country": _with(
        "SELECT country_code AS country, count(*) AS \"count\" FROM good GROUP BY 1"),
    "counter_read": _with(
        "SELECT product AS page, count(*) AS views FROM good GROUP BY product HAVING count(*) > 10"),
}
