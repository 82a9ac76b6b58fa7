"""Command line: the batch, SQL and streaming jobs of the reference as one tool.

    python -m hitlens.cli batch   --logs LOGS --lookup LOOKUP [--out DIR] [--rejects DIR]
    python -m hitlens.cli sql     --logs LOGS --lookup LOOKUP [--out DIR]
    python -m hitlens.cli stream  --job JOB --lookup LOOKUP --checkpoint DIR --out DIR
                                  [--source text|socket|kafka] [--path P] [--port N]
                                  [--kafka-servers S --topics T1,T2] [--once]

Reports are written as parquet below ``--out`` when given; otherwise the
first ``--show`` rows of each are printed (display only).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from .functions import parse_logs, parse_summary, rejects, split_once, valid
from .operators import reports, windows
from .operators.refine import viewed_products
from .operators.sessions import SESSION_GAP
from .plans import sql_reports as sq
from .session import build_session, remove_dir, shared_dir, tune, use_rocksdb_state
from .sources.logs import kafka_options, read_log_stream, read_logs, write_lines
from .sources.lookup import read_country_lookup
from .streaming import jobs
from .streaming.counters import CounterLedger
from .streaming.metrics import BatchLog
from .streaming.runs import FAN, RunLedger

SQL_REPORTS = {
    "views_per_user": sq.SQL_VIEWS_PER_USER,
    "views_per_country": sq.SQL_VIEWS_PER_COUNTRY,
    "views_per_hour": sq.SQL_VIEWS_PER_HOUR,
    "top_products": sq.SQL_TOP_PRODUCTS_10,
    "products_per_user": sq.SQL_PRODUCTS_PER_USER,
}


def _emit(name: str, df: DataFrame, out: str | None, show: int) -> None:
    if out:
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
    else:
        print(f"== {name}")
        df.show(show, truncate=False)


def run_batch(spark, args) -> None:
    """Batch job: one pass reads, parses, counts and refines the lines and sets the rejects aside (below the shared
    folder); one aggregate over its narrow columns serves all reports."""
    path = shared_dir(spark, "refined")
    lookup = read_country_lookup(spark, args.lookup)

    def refine(rows: DataFrame) -> DataFrame:
        return viewed_products(rows, lookup, extra_columns=(
            "ip_address", "request_uri", "content_size", "is_valid", "value"))

    rows = split_once(parse_logs(read_logs(spark, args.logs)), f"{path}/lines", refine)
    _emit("parse_summary", parse_summary(rows), args.out, args.show)
    if args.rejects:
        write_lines(rejects(rows), args.rejects, mode="overwrite")
    reports.all_counts(rows.where("is_valid")).write.partitionBy("report").parquet(f"{path}/counts")
    every = spark.read.parquet(f"{path}/counts")
    for name, fn in reports.FROM_COUNTS.items():
        _emit(name, fn(every), args.out, args.show)
    remove_dir(spark, path)


def run_sql(spark, args) -> None:
    """SQL job: SQL texts over temp views of the refined rows, which are written once."""
    path = shared_dir(spark, "refined")
    logs = valid(parse_logs(read_logs(spark, args.logs)))
    viewed_products(logs, read_country_lookup(spark, args.lookup),
                    extra_columns=("ip_address", "request_uri", "content_size")).write.parquet(path)
    refined = spark.read.parquet(path)
    sq.register_views(spark, viewed=refined, logs=refined)
    for name, text in SQL_REPORTS.items():
        _emit(name, spark.sql(text), args.out, args.show)
    for name, text in sq.WINDOW_REPORTS.items():
        _emit(name, sq.run(spark, text), args.out, args.show)
    remove_dir(spark, path)


def run_stream(spark, args) -> None:
    if not args.out and not (args.console and args.job in ("status", "ips", "endpoints", "sizes")):
        raise SystemExit("stream: --out is required (--console only for all-time jobs)")
    if args.job in ("batch-top", "counters") and not args.lookup:
        raise SystemExit(f"stream --job {args.job}: --lookup is required")
    kafka = (kafka_options(args.kafka_servers, args.topics.split(","), args.group_id)
             if args.source == "kafka" else None)
    lines = read_log_stream(spark, args.source, args.path, args.max_files, port=args.port,
                            kafka=kafka)
    trigger = {"availableNow": True} if args.once else None
    lookup = read_country_lookup(spark, args.lookup) if args.lookup else None
    out, ckpt = args.out, args.checkpoint
    if args.job == "batch-top":
        query = jobs.start_batch_top_products(lines, lookup, out, ckpt, trigger=trigger)
    elif args.job in ("status", "ips", "endpoints", "sizes"):
        use_rocksdb_state(spark)
        logs = jobs.without_repeats(lines, args.unrepeat) if args.unrepeat else jobs.access_log_stream(lines)
        state, finish, keys, folds = {
            "status": (jobs.status_totals, None, "response_code", jobs.SUM_TOTAL),
            "ips": (jobs.ip_totals, reports.frequent_ips_from_counts, "ip_address", jobs.SUM_TOTAL),
            "endpoints": (jobs.endpoint_totals, reports.top_endpoints_from_counts, "request_uri", jobs.SUM_TOTAL),
            "sizes": (jobs.size_totals, jobs.with_int_avg, (), jobs.SIZE_FOLDS),
        }[args.job]
        if args.console:     # SNK-1: print the running result after every trigger
            def show(batch, batch_id):
                print(f"== {args.job} after batch {batch_id}")
                (finish(batch) if finish else batch).show(args.show, truncate=False)
            writer = state(logs).writeStream.outputMode("complete").foreachBatch(show)
            query = jobs.start_query(writer, ckpt, trigger, None)
        elif args.deltas:    # no keyed state: per-batch partials below OUT/deltas, the result in OUT/result
            ledger = RunLedger(spark, f"{out.rstrip('/')}/deltas", keys, folds, args.compact_every or FAN)

            def refresh(batch_id):
                if ledger.manifest.entries():
                    totals = ledger.totals()
                    jobs.publish(finish(totals) if finish else totals, f"{out.rstrip('/')}/result", batch_id)
            query = jobs.start_all_time_deltas(logs, state, ledger, ckpt, trigger, after_batch=refresh)
        else:
            query = jobs.start_all_time(state(logs), out, ckpt, finish, trigger)
    elif args.job == "sliding":
        query = jobs.start_sliding_counts(lines, out, ckpt, args.watermark,
                                          windows.WINDOW_LENGTH, windows.SLIDE_INTERVAL, trigger,
                                          time_basis=args.time_basis)
    elif args.job == "sliding-top":
        query = jobs.start_sliding_top_products(lines, out, ckpt, watermark=args.watermark, trigger=trigger,
                                                time_basis=args.time_basis)
    elif args.job == "sliding-sql":
        query = jobs.start_sliding_sql_reports(lines, out, ckpt, watermark=args.watermark, trigger=trigger,
                                               time_basis=args.time_basis)
    elif args.job in ("sessions-ip", "sessions-user"):
        key = {"sessions-ip": "ip_address", "sessions-user": "user"}[args.job]
        query = jobs.start_sessions(lines, key, out, ckpt, args.gap, args.watermark, trigger, time_basis=args.time_basis)
    elif args.job == "late":     # rows on time in OUT/on-time, the others in OUT/late
        query = jobs.start_late_split(lines, f"{out.rstrip('/')}/on-time", f"{out.rstrip('/')}/late", ckpt,
                                      args.watermark, trigger)
    elif args.job == "split":    # good rows in OUT/good, rejected lines in OUT/rejects; a line per batch is printed
        spark.streams.addListener(BatchLog(print))
        query = jobs.start_split(lines, f"{out.rstrip('/')}/good", f"{out.rstrip('/')}/rejects", ckpt, trigger)
    elif args.job == "sql":
        query = jobs.start_sql_reports(lines, out, ckpt, trigger)
    elif args.job == "counters":
        ledger = CounterLedger(spark, args.database, out, compact_every=args.compact_every)
        ledger.create_schema()
        query = jobs.start_counters(lines, lookup, ledger, ckpt, trigger)
    else:
        raise SystemExit(f"unknown stream job {args.job}")
    query.awaitTermination()


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="hitlens")
    sub = parser.add_subparsers(dest="cmd", required=True)
    for cmd in ("batch", "sql"):
        p = sub.add_parser(cmd)
        p.add_argument("--logs", required=True)
        p.add_argument("--lookup", required=True)
        p.add_argument("--out")
        p.add_argument("--rejects")
        p.add_argument("--show", type=int, default=100)
        p.add_argument("--min-partitions", type=int, default=10)
    p = sub.add_parser("stream")
    p.add_argument("--job", required=True,
                   choices=["batch-top", "status", "ips", "endpoints", "sizes", "sliding", "sliding-top",
                            "sliding-sql", "sessions-ip", "sessions-user", "late", "split", "sql", "counters"])
    p.add_argument("--source", default="text", choices=["text", "socket", "kafka"])
    p.add_argument("--path")
    p.add_argument("--port", type=int)
    p.add_argument("--kafka-servers")
    p.add_argument("--topics", default="")
    p.add_argument("--group-id")
    p.add_argument("--max-files", type=int)
    p.add_argument("--lookup")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--out")
    p.add_argument("--database", default="hitlens_counters")
    p.add_argument("--compact-every", type=int, help="counters: fold the ledger every n batches; --deltas: fold n runs into one")
    p.add_argument("--watermark", default="1 minute")
    p.add_argument("--gap", default=SESSION_GAP, help="session jobs: the pause that ends a session")
    p.add_argument("--unrepeat", metavar="DELAY",
                   help="all-time jobs with --deltas: a line that comes again within DELAY counts once")
    p.add_argument("--time-basis", default="event", choices=["event", "arrival"])
    p.add_argument("--deltas", action="store_true",
                   help="all-time jobs: per-batch partials instead of state; OUT/result has the folded report")
    p.add_argument("--once", action="store_true")
    p.add_argument("--console", action="store_true",
                   help="all-time jobs: print the result after every trigger instead of --out")
    p.add_argument("--show", type=int, default=20)
    args = parser.parse_args(argv)
    spark = tune(build_session(app=f"hitlens-{args.cmd}"))
    if getattr(args, "min_partitions", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(args.min_partitions))
    {"batch": run_batch, "sql": run_sql, "stream": run_stream}[args.cmd](spark, args)


if __name__ == "__main__":
    main()
