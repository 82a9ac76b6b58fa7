"""Structured Streaming jobs (STR-*): per batch, all-time totals, SQL per batch.

Every job reads a stream of lines (``value``), parses it with the batch parser
and reuses the batch report functions, so batch and stream share all code up
to the sink.  Sinks are replay-safe: complete-mode results overwrite their
table, per-batch results overwrite the partition of their ``batch_id``.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import observed, parse_logs, rejects, valid
from ..operators import reports, windows
from ..operators.sessions import SESSION_GAP, sessions
from ..operators.refine import bounded_broadcast, viewed_products
from ..plans import sql_reports as sq
from ..functions.scalar import product_from_uri
from ..schema import MAX_CLASS_B_PREFIXES
from ..session import shared_dir
from .manifest import Manifest
from .runs import RunLedger

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}   # fixed value: 10 s micro-batches

log = logging.getLogger(__name__)


def is_empty_batch(batch: DataFrame, batch_id: int) -> bool:
    """FIL-4: an empty micro-batch is skipped with a notice (``isEmpty`` reads
    at most one row, no full count)."""
    if batch.isEmpty():
        log.info("no access logs received in micro-batch %d", batch_id)
        return True
    return False


def start_query(writer, checkpoint: str, trigger: dict | None = None,
                name: str | None = None) -> StreamingQuery:
    """Start a stream writer with its checkpoint, trigger (default 10 s) and name."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def stream_id_of(batch: DataFrame) -> str:
    """Id of the streaming query that a micro-batch belongs to: it lives in the checkpoint, so a restart
    keeps it and a new checkpoint gets a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def fixed_side(lookup: DataFrame) -> DataFrame:
    """The lookup, written once at the start of a stream, so that micro-batches do not derive it again."""
    spark = lookup.sparkSession
    path = shared_dir(spark, "lookup")
    lookup.select("prefix", "country_code").write.parquet(path)
    return bounded_broadcast(spark.read.parquet(path), MAX_CLASS_B_PREFIXES)


def write_batch_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace only this batch's partition: a replayed batch leaves totals unchanged."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def access_log_stream(lines: DataFrame) -> DataFrame:
    """PRJ-1 + FIL-1 on a stream."""
    return valid(parse_logs(lines))


# --- SNK-2, AGG-13: good rows and rejects in one pass -----------------------------

def start_split(lines: DataFrame, good_path: str, rejects_path: str, checkpoint: str, trigger: dict | None = None,
                name: str | None = None) -> StreamingQuery:
    """Good rows and rejected lines of each micro-batch, in two tables by batch.  Each line is parsed once; a
    :class:`~hitlens.streaming.metrics.BatchLog` tells how many there were and how long the batch took."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            write_batch_partition(valid(rows), good_path, batch_id)
            write_batch_partition(rejects(rows), rejects_path, batch_id)
        finally:
            rows.unpersist()

    parsed = observed(parse_logs(lines.select("value")))
    return start_query(parsed.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)


# --- STR-2: per-batch analytics, no carry-over --------------------------------

def start_batch_top_products(lines: DataFrame, lookup: DataFrame, out_path: str,
                             checkpoint: str, k: int = 10, trigger: dict | None = None,
                             name: str | None = None) -> StreamingQuery:
    """Top ``k`` products of each micro-batch (ranked by views, ties by name)."""
    side = fixed_side(lookup)
    logs = access_log_stream(lines)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if is_empty_batch(batch, batch_id):
            return
        vp = viewed_products(batch, side, broadcast="none")
        top = reports.top_products(vp, k)
        write_batch_partition(top, out_path, batch_id)

    return start_query(logs.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)


# --- results that are replaced as a whole ---------------------------------------

KEEP_VERSIONS = 3


def publish(df: DataFrame, path: str, version: int, keep: int = KEEP_VERSIONS) -> None:
    """Write one version of a result; it replaces the one before once it is complete, and the last ``keep`` stay."""
    manifest = Manifest(df.sparkSession, path, keep=0)
    entry = {"version": int(version), **manifest.write(df, f"version-{int(version)}")}
    others = [e for e in manifest.entries() if e["version"] != entry["version"]]
    manifest.commit(others[len(others) - keep + 1 if len(others) >= keep else 0:] + [entry])


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version committed last, be it empty; a write that is under way or failed is never seen."""
    manifest = Manifest(spark, path)
    versions = manifest.entries()
    if not versions:
        raise ValueError(f"nothing published below {path}")
    return manifest.read(versions[-1])


# --- STR-4..7: all-time totals ---------------------------------------------------

def start_all_time(counts: DataFrame, out_path: str, checkpoint: str, finish=None,
                   trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Keep an aggregate of few keys for all time (state store, complete mode) and publish
    the whole result after every batch; ``finish`` is a batch report applied to it
    (threshold, top-k).  For unbounded keys use :func:`start_all_time_deltas`."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        publish(finish(batch) if finish else batch, out_path, batch_id)
    writer = counts.writeStream.outputMode("complete").foreachBatch(sink)
    return start_query(writer, checkpoint, trigger, name)


def start_all_time_deltas(logs: DataFrame, partial, ledger: RunLedger, checkpoint: str, trigger: dict | None = None,
                          name: str | None = None, after_batch=None) -> StreamingQuery:
    """All-time totals without keyed state: each micro-batch adds its own partial aggregate (``partial(batch)``) to
    the ledger of runs; ``ledger.totals()`` combines them.  ``partial`` gives no rows for an empty batch: it groups by a
    key.  ``after_batch(batch_id)`` runs once a batch is in."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # the test for rows and the write both read it: a stream with state passes its state once
        rows = partial(batch).persist()
        try:
            if not is_empty_batch(rows, batch_id):
                ledger.add(rows, batch_id, stream_id_of(batch))
        finally:
            rows.unpersist()
        if after_batch:
            after_batch(batch_id)
    return start_query(logs.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)


SUM_TOTAL = {"total": "sum"}
SIZE_FOLDS = {"total_size": "sum", "n": "sum", "min_size": "min", "max_size": "max"}


def status_totals(logs: DataFrame) -> DataFrame:
    """STR-4: all-time count per response code."""
    return reports.response_code_counts(logs)


def ip_totals(logs: DataFrame) -> DataFrame:
    """STR-5 state: all-time count per IP (threshold applied on output)."""
    return reports.count_by(logs, "ip_address", "total")


def endpoint_totals(logs: DataFrame) -> DataFrame:
    """STR-6 state: all-time count per endpoint (top-k applied on output)."""
    return reports.count_by(logs, "request_uri", "total")


def size_totals(logs: DataFrame) -> DataFrame:
    """STR-7: all-time sum, count, min, max of content size (keyless)."""
    return logs.agg(F.sum("content_size").alias("total_size"), F.count(F.lit(1)).alias("n"),
                    F.min("content_size").alias("min_size"),
                    F.max("content_size").alias("max_size"))


def with_int_avg(stats: DataFrame) -> DataFrame:
    return stats.withColumn("avg_size", F.expr("total_size div nullif(n, 0)"))


# --- STR-3 / STR-14: sliding windows on event time with a watermark -------------

def start_sliding_counts(lines: DataFrame, out_path: str, checkpoint: str,
                         watermark: str = "1 minute", length: str = windows.WINDOW_LENGTH,
                         slide: str = windows.SLIDE_INTERVAL, trigger: dict | None = None,
                         name: str | None = None, time_basis: str = "event") -> StreamingQuery:
    """Hits per sliding window, appended to a parquet table once a window
    closes (its end passes the watermark), so the state stays bounded.

    ``time_basis="event"`` windows the log time and drops rows later than
    the watermark.  ``"arrival"`` is the reference's behaviour: every line is
    stamped with its micro-batch time (``current_timestamp`` is fixed per
    batch) and windowed on that, with no lateness allowed.
    """
    logs, time_col = timed_logs(lines, watermark, time_basis)
    counts = windows.sliding_window_counts(logs, length, slide, time_col=time_col)
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", out_path)
    return start_query(writer, checkpoint, trigger, name)


def timed_logs(lines: DataFrame, watermark: str, time_basis: str) -> tuple[DataFrame, str]:
    """Access logs with a watermark, and the column it is on."""
    logs = access_log_stream(lines)
    if time_basis == "arrival":
        return logs.withColumn("arrival", F.current_timestamp()).withWatermark("arrival", "0 seconds"), "arrival"
    if time_basis == "event":
        return logs.withWatermark("date_time", watermark), "date_time"
    raise ValueError(f"unknown time basis {time_basis!r}")


def start_sliding_top_products(lines: DataFrame, out_path: str, checkpoint: str, k: int = 10,
                               watermark: str = "1 minute", length: str = windows.WINDOW_LENGTH,
                               slide: str = windows.SLIDE_INTERVAL, trigger: dict | None = None,
                               name: str | None = None, time_basis: str = "event") -> StreamingQuery:
    """Top ``k`` products of each sliding window, once the window closes.

    The state holds a count per open window and product.  A closed window
    leaves it as a whole, so its rows are ranked within the micro-batch.
    """
    logs, time_col = timed_logs(lines, watermark, time_basis)
    named = logs.withColumn("product", product_from_uri("request_uri"))
    counts = windows.windowed_counts(named, ("product",), length, slide, time_col)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()  # read twice; each read of an unpersisted batch would pass the state again
        try:
            if not is_empty_batch(rows, batch_id):
                write_batch_partition(windows.rank_in_window(rows, k), out_path, batch_id)
        finally:
            rows.unpersist()

    return start_query(counts.writeStream.outputMode("append").foreachBatch(per_batch), checkpoint, trigger, name)


# --- STR-14: sessions, repeated lines, late lines ------------------------------------

def start_sessions(lines: DataFrame, key: str, out_path: str, checkpoint: str, gap: str = SESSION_GAP,
                   watermark: str = "1 minute", trigger: dict | None = None, name: str | None = None,
                   time_basis: str = "event") -> StreamingQuery:
    """Sessions per ``key``, appended once they are closed; the state holds open sessions only."""
    logs, time_col = timed_logs(lines, watermark, time_basis)
    writer = (sessions(logs, key, gap, time_col).writeStream.outputMode("append")
              .format("parquet").option("path", out_path))
    return start_query(writer, checkpoint, trigger, name)


def without_repeats(lines: DataFrame, delay: str) -> DataFrame:
    """Access logs in which a line that comes again within ``delay`` of its own time counts once (shippers send files
    twice).  The state holds a digest of each line and forgets it as the watermark passes."""
    good = parse_logs(lines.select("value")).where("is_valid")
    named = good.withColumn("_line", F.unhex(F.md5("value"))).withWatermark("date_time", delay)
    return named.dropDuplicatesWithinWatermark(["_line"]).drop("_line", "value", "is_valid")


def start_late_split(lines: DataFrame, on_time_path: str, late_path: str, checkpoint: str, delay: str = "1 minute",
                     trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Every access-log row goes to one of two tables by batch: late rows, older than the newest time of all earlier
    batches less ``delay``, to a quarantine instead of vanishing from windowed jobs.

    The newest time is committed after a batch's rows, with the batch it belongs to, so a replayed batch is split as
    it was the first time.
    """
    logs = access_log_stream(lines)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark, marks = batch.sparkSession, Manifest(batch.sparkSession, f"{on_time_path.rstrip('/')}-watermark")
        stream = stream_id_of(batch)
        earlier = [e for e in marks.entries() if e["stream"] == stream and e["batch_id"] < batch_id]
        newest = earlier[-1]["micros"] if earlier else None
        rows = batch.persist()
        try:
            if is_empty_batch(rows, batch_id):
                return
            passed = F.timestamp_micros(F.lit(newest).cast("bigint")) - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(F.col("date_time") < passed, F.lit(False))
            write_batch_partition(rows.where(~late), on_time_path, batch_id)
            write_batch_partition(rows.where(late), late_path, batch_id)
            seen = rows.agg(F.max(F.unix_micros("date_time"))).first()[0]
            mark = {"stream": stream, "batch_id": batch_id, "micros": max(x for x in (newest, seen) if x is not None)}
            marks.commit(earlier[-2:] + [mark])
        finally:
            rows.unpersist()

    return start_query(logs.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)


# The four reports over the closed windows of a micro-batch: one row per window, report and key.
SQL_WINDOW_REPORTS = """
SELECT window_start, window_end, report, stat AS key, value FROM (
  SELECT *, explode(map('total_size', total_size, 'n', n, 'min_size', min_size, 'max_size', max_size,
                        'avg_size', total_size div n)) AS (stat, value)
  FROM {view} WHERE report = 'size_stats')
UNION ALL SELECT window_start, window_end, report, key, n FROM {view} WHERE report = 'response_codes'
UNION ALL SELECT window_start, window_end, report, key, n FROM {view} WHERE report = 'frequent_ips' AND n > {threshold}
UNION ALL SELECT window_start, window_end, report, key, n FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, key ASC NULLS LAST) AS place
  FROM {view} WHERE report = 'top_endpoints') WHERE place <= {k}
"""


def start_sliding_sql_reports(lines: DataFrame, out_path: str, checkpoint: str, k: int = 10,
                              threshold: int = reports.FREQUENT_THRESHOLD, watermark: str = "1 minute",
                              length: str = windows.WINDOW_LENGTH, slide: str = windows.SLIDE_INTERVAL,
                              trigger: dict | None = None, name: str | None = None,
                              time_basis: str = "event") -> StreamingQuery:
    """STR-10: the four SQL reports over each sliding window, once the window closes.

    One stateful aggregation serves all four: the state counts each window's
    rows by status, address and endpoint together, which is at most one entry
    per row and window, and holds the open windows only.  The keys of each
    report are totals over the closed windows' entries.  A micro-batch passes
    its state once: what the four reports read is persisted.
    """
    logs, time_col = timed_logs(lines, watermark, time_basis)
    merge = [F.sum("total_size").alias("total_size"), F.sum("n").alias("n"),
             F.min("min_size").alias("min_size"), F.max("max_size").alias("max_size")]
    counts = windows.windowed_aggregate(
        logs, ("response_code", "ip_address", "request_uri"),
        [F.sum("content_size").alias("total_size"), F.count(F.lit(1)).alias("n"),
         F.min("content_size").alias("min_size"), F.max("content_size").alias("max_size")], merge, length, slide, time_col)
    keys = F.explode(F.array(*(
        F.struct(F.lit(r).alias("report"), c.cast("string").alias("key")) for r, c in (
            ("size_stats", F.lit(None)), ("response_codes", F.col("response_code")),
            ("frequent_ips", F.col("ip_address")), ("top_endpoints", F.col("request_uri"))))))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark, view = batch.sparkSession, f"closed_windows_{batch_id}"
        closed = (batch.select("*", keys.alias("r")).groupBy("window_start", "window_end", "r.report", "r.key")
                  .agg(*merge).persist())
        try:
            if is_empty_batch(closed, batch_id):
                return
            closed.createOrReplaceTempView(view)
            try:
                rows = spark.sql(SQL_WINDOW_REPORTS.format(view=view, threshold=threshold, k=k))
                write_batch_partition(rows, out_path, batch_id)
            finally:
                spark.catalog.dropTempView(view)
        finally:
            closed.unpersist()

    return start_query(counts.writeStream.outputMode("append").foreachBatch(per_batch), checkpoint, trigger, name)


# --- STR-8: running sum/count, min/max of the latest non-empty batch -------------

def start_size_stats_ledger(lines: DataFrame, ledger_path: str, checkpoint: str,
                            trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    logs = access_log_stream(lines)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if is_empty_batch(batch, batch_id):
            return
        write_batch_partition(size_totals(batch), ledger_path, batch_id)

    return start_query(logs.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)


def size_stats_last(ledger: DataFrame) -> DataFrame:
    """All-time sum / count with min and max of the latest batch (Q3)."""
    return with_int_avg(ledger.agg(
        F.sum("total_size").cast("bigint").alias("total_size"),
        F.sum("n").cast("bigint").alias("n"),
        F.max_by("min_size", "batch_id").alias("min_size"),
        F.max_by("max_size", "batch_id").alias("max_size"),
        F.max("batch_id").alias("last_batch_id"),
    ))


# --- STR-10: temp view per batch + four SQL reports -----------------------------

def sql_reports_long(spark: SparkSession, view: str) -> DataFrame:
    """The four SQL reports over ``view`` as rows (report, key, value)."""
    stats = sq.run(spark, sq.SQL_SIZE_STATS, view)
    stats_rows = stats.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in ("total_size", "n", "min_size", "max_size", "avg_size")]),
        F.array(*[F.col(c).cast("bigint") for c in ("total_size", "n", "min_size", "max_size",
                                                    "avg_size")]))).alias("key", "value"))
    parts = [
        stats_rows.select(F.lit("size_stats").alias("report"), "key", "value"),
        sq.run(spark, sq.SQL_RESPONSE_CODES, view).select(
            F.lit("response_codes").alias("report"), F.col("response_code").cast("string").alias("key"),
            F.col("total").alias("value")),
        sq.run(spark, sq.SQL_FREQUENT_IPS, view).select(
            F.lit("frequent_ips").alias("report"), F.col("ip_address").alias("key"),
            F.col("total").alias("value")),
        sq.run(spark, sq.SQL_TOP_ENDPOINTS, view).select(
            F.lit("top_endpoints").alias("report"), F.col("endpoint").alias("key"),
            F.col("total").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def start_sql_reports(lines: DataFrame, out_path: str, checkpoint: str,
                      trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    logs = access_log_stream(lines)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # four reports read the batch: parse it once (MAT-1)
        rows = batch.persist()
        try:
            if is_empty_batch(rows, batch_id):
                return
            spark = rows.sparkSession
            view = f"access_log_batch_{batch_id}"
            sq.with_endpoint(rows).createOrReplaceTempView(view)
            try:
                write_batch_partition(sql_reports_long(spark, view), out_path, batch_id)
            finally:
                spark.catalog.dropTempView(view)
        finally:
            rows.unpersist()

    return start_query(logs.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)


# --- STR-13: four counters per micro-batch ------------------------------------

def start_counters(lines: DataFrame, lookup: DataFrame, ledger, checkpoint: str,
                   trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Refine each micro-batch once (persisted), then write the four counter
    deltas of :class:`~hitlens.streaming.counters.CounterLedger` for it."""
    side = fixed_side(lookup)
    logs = access_log_stream(lines)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        vp = viewed_products(batch, side, broadcast="none").persist()
        try:
            if is_empty_batch(vp, batch_id):
                return
            ledger.apply_batch(vp, batch_id, stream_id_of(batch))
        finally:
            vp.unpersist()

    return start_query(logs.writeStream.foreachBatch(per_batch), checkpoint, trigger, name)
