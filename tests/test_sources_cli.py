"""Text sources and sinks, stream options, the command line, watermarked windows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from hitlens import cli, registry
from hitlens.functions import parse_logs, valid
from hitlens.operators import reports, windows
from hitlens.session import shared_dir
from hitlens.sources import fixtures
from hitlens.sources.logs import kafka_options, read_log_stream, read_logs, write_lines
from hitlens.streaming import jobs
from feeds import append_feed_file


def _write_text_inputs(spark):
    logs_dir = shared_dir(spark, "t-logs")
    write_lines(fixtures.log_lines(spark, SF001), logs_dir, mode="overwrite")
    lookup_dir = shared_dir(spark, "t-lookup")
    write_lines(fixtures.lookup_lines(spark, SF001).orderBy("line_order").coalesce(1),
                lookup_dir, mode="overwrite")
    return logs_dir, lookup_dir


def test_text_round_trip_equals_derived_lines(spark):
    logs_dir, _ = _write_text_inputs(spark)
    from_text = valid(parse_logs(read_logs(spark, logs_dir)))
    assert sorted(from_text.collect()) == sorted(registry.access_logs(spark, SF001).collect())


def test_kafka_options_and_bad_sources(spark):
    opts = kafka_options("b1:9092,b2:9092", ["t1", "t2"], "g", 4, "earliest")
    assert opts == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "t1,t2",
                    "kafka.group.id": "g", "minPartitions": "4", "startingOffsets": "earliest"}
    with pytest.raises(ValueError):
        read_log_stream(spark, "socket")
    with pytest.raises(ValueError):
        read_log_stream(spark, "carrier-pigeon")


def test_cli_batch_writes_reports_and_rejects(spark):
    logs_dir, lookup_dir = _write_text_inputs(spark)
    out, rej = shared_dir(spark, "t-cli"), shared_dir(spark, "t-rej")
    cli.run_batch(spark, cli.argparse.Namespace(
        logs=logs_dir, lookup=lookup_dir, out=out, rejects=rej, show=10, min_partitions=4))
    got = {r.country_code: r.views for r in spark.read.parquet(f"{out}/views_per_country").collect()}
    want = {r.country_code: r.views
            for r in reports.views_per_country(registry.viewed(spark, SF001)).collect()}
    assert got == want
    assert spark.read.text(rej).count() == registry.q_parse_rejects(spark, SF001).count()
    assert spark.read.parquet(f"{out}/parse_summary").collect() == registry.q_parse_summary(spark, SF001).collect()
    cli.run_sql(spark, cli.argparse.Namespace(
        logs=logs_dir, lookup=lookup_dir, out=out, rejects=None, show=10, min_partitions=4))
    assert spark.read.parquet(f"{out}/top_endpoints").count() == 10


def test_watermarked_sliding_stream_equals_batch_for_closed_windows(spark):
    path = shared_dir(spark, "t-feed-w")
    lines = fixtures.event_log_lines(fixtures.load(spark, SF001, "events"))
    for lo, hi in [(0, 400), (400, 800), (800, 10**9)]:
        append_feed_file(lines.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)), path)
    out = shared_dir(spark, "t-out")
    stream = read_log_stream(spark, "text", path, max_files_per_trigger=1)
    q = jobs.start_sliding_counts(stream, out, shared_dir(spark, "t-ck"), "1 minute",
                                  trigger={"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    got = spark.read.parquet(out)
    logs = registry.access_logs(spark, SF001)
    max_ts = logs.agg(F.max("date_time")).collect()[0][0]
    batch = windows.sliding_window_counts(logs)
    closed = batch.where(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 1 MINUTE"))
    rows = lambda df: sorted((r.window_start, r.window_end, r.views) for r in df.collect())
    assert rows(got) == rows(closed)
    assert got.count() > 0


def test_arrival_time_windows_run(spark):
    path = shared_dir(spark, "t-feed-a")
    append_feed_file(fixtures.log_lines(spark, SF001), path, pause_s=0)
    out = shared_dir(spark, "t-out")
    stream = read_log_stream(spark, "text", path)
    q = jobs.start_sliding_counts(stream, out, shared_dir(spark, "t-ck"),
                                  trigger={"availableNow": True}, time_basis="arrival")
    q.awaitTermination(600)
    assert q.exception() is None
    got = spark.read.parquet(out)
    assert got.columns == ["window_start", "window_end", "views"]
    # every line falls in at most 3 windows of its batch time; open windows are not out yet
    n = registry.access_logs(spark, SF001).count()
    assert got.agg(F.coalesce(F.sum("views"), F.lit(0))).collect()[0][0] <= 3 * n
    with pytest.raises(ValueError):
        jobs.start_sliding_counts(stream, out, shared_dir(spark, "t-ck"), time_basis="wall")


def test_output_schemas_match_the_record_types(spark):
    from hitlens.schema import ACCESS_LOG, COUNTRY_LOOKUP
    logs = registry.access_logs(spark, SF001)
    assert [(f.name, f.dataType) for f in logs.schema] == \
        [(f.name, f.dataType) for f in ACCESS_LOG]
    lookup = registry.country_lookup(spark, SF001)
    assert [(f.name, f.dataType) for f in lookup.schema] == \
        [(f.name, f.dataType) for f in COUNTRY_LOOKUP]


def test_kafka_sink_needs_the_connector(spark):
    from hitlens.sources.logs import write_lines_kafka
    with pytest.raises(Exception, match="(?i)kafka"):
        write_lines_kafka(fixtures.log_lines(spark, SF001), "localhost:1", "logs")


def test_cli_stream_job_once(spark):
    path = shared_dir(spark, "t-feed-cli")
    append_feed_file(fixtures.log_lines(spark, SF001), path, pause_s=0)
    _, lookup_dir = _write_text_inputs(spark)
    out = shared_dir(spark, "t-out")
    cli.main(["stream", "--job", "status", "--path", path, "--lookup", lookup_dir,
              "--checkpoint", shared_dir(spark, "t-ck"), "--out", out, "--once"])
    got = {r.response_code: r.total for r in jobs.read_published(spark, out).collect()}
    want = {r.response_code: r.total
            for r in reports.response_code_counts(registry.access_logs(spark, SF001)).collect()}
    assert got == want
    deltas = shared_dir(spark, "t-out")
    cli.main(["stream", "--job", "ips", "--deltas", "--path", path,
              "--checkpoint", shared_dir(spark, "t-ck"), "--out", deltas, "--once"])
    got = {(r.ip_address, r.total) for r in jobs.read_published(spark, f"{deltas}/result").collect()}
    assert got == {(r.ip_address, r.total) for r in reports.frequent_ips(registry.access_logs(spark, SF001)).collect()}
    for job in ("counters", "batch-top"):
        with pytest.raises(SystemExit, match="--lookup"):
            cli.main(["stream", "--job", job, "--path", path, "--checkpoint", shared_dir(spark, "t-ck"),
                      "--out", out, "--once"])


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from hitlens.session import checkpoint_root
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)


def test_cli_stream_console(spark, capsys):
    path = shared_dir(spark, "t-feed-con")
    append_feed_file(fixtures.log_lines(spark, SF001), path, pause_s=0)
    cli.main(["stream", "--job", "status", "--path", path, "--console",
              "--checkpoint", shared_dir(spark, "t-ck"), "--once"])
    out = capsys.readouterr().out
    assert "== status after batch 0" in out and "response_code" in out
