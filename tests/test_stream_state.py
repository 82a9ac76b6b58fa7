"""What streams keep and publish: manifests, levelled runs, the four counters' commit record; sessions, repeats, late rows."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from hitlens import registry
from hitlens.functions import parse_logs, valid
from hitlens.operators.sessions import sessions
from hitlens.session import shared_dir
from hitlens.sources import fixtures
from hitlens.streaming import counters, jobs, queries
from hitlens.streaming.manifest import Manifest
from hitlens.streaming.runs import RunLedger, fold


def local(path):
    return path.removeprefix("file:")


# --- published results ---------------------------------------------------------------

def test_an_empty_result_reads_as_empty(spark):
    path = shared_dir(spark, "t-out")
    with pytest.raises(ValueError):
        jobs.read_published(spark, path)
    jobs.publish(spark.range(1), path, 0)
    jobs.publish(spark.range(0), path, 1)
    got = jobs.read_published(spark, path)
    assert got.collect() == [] and got.columns == ["id"]


def test_only_the_last_versions_stay(spark):
    path = shared_dir(spark, "t-out")
    for v in range(8):
        jobs.publish(spark.range(v + 1), path, v, keep=3)
        assert len(os.listdir(f"{local(path)}/data")) <= 3
    held = jobs.read_published(spark, path)
    jobs.publish(spark.range(50), path, 8, keep=3)
    assert held.count() == 8                    # a reader that began before still has its files
    jobs.publish(spark.range(9), path, 8, keep=1)
    assert jobs.read_published(spark, path).count() == 9 and len(os.listdir(f"{local(path)}/data")) == 1


def test_a_write_that_is_not_committed_is_never_read(spark):
    path = shared_dir(spark, "t-out")
    jobs.publish(spark.range(2), path, 0)
    Manifest(spark, path).write(spark.range(99), "version-1")                 # stopped before the commit
    assert jobs.read_published(spark, path).count() == 2
    jobs.publish(spark.range(3), path, 1)
    assert jobs.read_published(spark, path).count() == 3 and len(os.listdir(f"{local(path)}/data")) == 2


# --- levelled runs ------------------------------------------------------------------------

def test_fifty_batches_leave_few_runs_and_rewrite_little(spark, monkeypatch):
    ledger = RunLedger(spark, shared_dir(spark, "t-runs"), "k", {"n": "sum", "top": "max"}, fan=4, keep=1)
    written, write = [], Manifest.write

    def counted(self, df, name):
        entry = write(self, df, name)
        written.append(self.read(entry).count())
        return entry

    monkeypatch.setattr(Manifest, "write", counted)
    expected = {}
    for b in range(50):
        rows = [(k, b + k, b * k) for k in (b % 5, 7, 100 + b)]
        for k, n, top in rows:
            old = expected.get(k, (0, -1))
            expected[k] = old[0] + n, max(old[1], top)
        ledger.add(spark.createDataFrame(rows, "k long, n long, top long").coalesce(1), b)
        # three runs on each of three levels at most, and what the last commits replaced
        assert len(ledger.manifest.entries()) <= 9
        assert len(os.listdir(f"{local(ledger.manifest.path)}/data")) <= 9 + 2 * 4
    assert {r.k: (r.n, r.top) for r in ledger.totals().collect()} == expected
    assert sum(written) <= 3 * 50 * 4           # each row once per level: log4(50) < 3, and once when it came


def test_a_batch_that_comes_again_counts_once(spark):
    ledger = RunLedger(spark, shared_dir(spark, "t-runs"), (), {"n": "sum"}, fan=2)
    one = spark.createDataFrame([(1,)], "n long").coalesce(1)
    for b, stream in [(0, "a"), (0, "a"), (1, "a"), (1, "a"), (0, "a"), (0, "b"), (2, "a")]:
        ledger.add(one, b, stream)
    assert ledger.totals().first().n == 4
    with pytest.raises(ValueError):
        RunLedger(spark, shared_dir(spark, "t-runs"), (), {"n": "sum"}).totals()


def test_a_fold_that_stops_half_way_changes_nothing(spark, monkeypatch):
    ledger = RunLedger(spark, shared_dir(spark, "t-runs"), "k", {"n": "sum"}, fan=2, keep=1)
    one = spark.createDataFrame([(1, 1)], "k long, n long").coalesce(1)
    ledger.add(one, 0)
    commit = Manifest.commit

    def stops(self, entries):
        raise RuntimeError("stopped")       # the batch and its fold are written but not committed

    reader = ledger.totals()
    monkeypatch.setattr(Manifest, "commit", stops)
    with pytest.raises(RuntimeError):
        ledger.add(one, 1)
    monkeypatch.setattr(Manifest, "commit", commit)
    assert ledger.totals().first().n == 1 and len(ledger.manifest.entries()) == 1
    ledger.add(one, 1)                      # replayed
    assert ledger.totals().first().n == 2 and reader.first().n == 1
    assert len(os.listdir(f"{local(ledger.manifest.path)}/data")) == 2      # the fold, and what its readers may hold
    ledger.add(one, 2)
    assert ledger.totals().first().n == 3


def test_top_list_is_exact_after_every_batch(spark):
    """Few busy keys, many rare ones, a tie at the last place; then keys that are all alike."""
    r = random.Random(9)
    ledger = RunLedger(spark, shared_dir(spark, "t-runs"), "k", {"n": "sum"}, fan=2, rank_by="n", listed=6)
    expected = {}

    def batch(counts, b):
        for key, n in counts.items():
            expected[key] = expected.get(key, 0) + n
        ledger.add(spark.createDataFrame(list(counts.items()), "k string, n long").coalesce(1), b)
        order = sorted(expected.items(), key=lambda x: (-x[1], x[0] is None, x[0] or ""))
        assert [tuple(x) for x in ledger.top(3).collect()] == order[:3]

    for b in range(6):
        counts = {"a": 1000, "b": 700 + b, None: 700 - b, "c": 700 + (b - 3) * 2 + 1, "late": 300 * b}
        counts |= {f"rare{r.randrange(500)}": r.randrange(1, 9) for _ in range(40)}
        batch(counts, b)
    # two keys share the third place
    batch({"x": expected["b"] + 1, "y": expected["b"] + 1, "a": 1}, 6)
    batch({"y": 1, "x": 1}, 7)
    some = {x.k for x in ledger.candidates(3).collect()}
    assert {"a", "x", "y"} <= some and len(some) < 20 and len(expected) > 100
    assert ledger.manifest.entries()[0]["floor"] > 0
    batch({f"flat{k}": 5000 for k in range(30)}, 8)        # more keys alike than a summary lists
    assert ledger.candidates(3) is None


def test_a_top_list_of_few_keys(spark):
    ledger = RunLedger(spark, shared_dir(spark, "t-runs"), "k", {"n": "sum"}, rank_by="n")
    ledger.add(spark.createDataFrame([("a", 1), (None, 1)], "k string, n long"), 0)
    ledger.add(spark.createDataFrame([], "k string, n long"), 1)
    assert [tuple(x) for x in ledger.top(5).collect()] == [("a", 1), (None, 1)]
    with pytest.raises(ValueError):
        RunLedger(spark, "x", "k", {"n": "max"}, rank_by="n")


def test_folds(spark):
    rows = spark.createDataFrame([("a", 1, 5, 5), (None, 2, 3, 4), ("a", 3, 1, 9)], "k string, s int, lo int, hi int")
    got = fold(rows, "k", {"s": "sum", "lo": "min", "hi": "max"})
    assert {tuple(r) for r in got.collect()} == {("a", 4, 1, 9), (None, 2, 3, 4)}


# --- the four counters in one step -----------------------------------------------------------

def test_a_batch_shows_in_all_four_counters_or_in_none(spark, monkeypatch):
    location = shared_dir(spark, "counters")
    ledger = counters.CounterLedger(spark, "hitlens_commit_test", location, compact_every=2)
    ledger.create_schema()
    vp = registry.viewed(spark, SF001)
    sums = lambda: [ledger.totals(t).agg(F.sum(v)).first()[0] for t, (_, _, v) in counters.COUNTER_TABLES.items()]
    assert sums() == [None] * 4
    n = vp.count()
    try:
        ledger.apply_batch(vp, 0, "s")
        assert sums() == [n] * 4
        write = counters.CounterLedger._write
        for stop_at in range(1, 4):
            calls = []

            def stops(self, *args):
                calls.append(args)
                if len(calls) > stop_at:
                    raise RuntimeError("stopped")
                write(self, *args)

            monkeypatch.setattr(counters.CounterLedger, "_write", stops)
            with pytest.raises(RuntimeError):
                ledger.apply_batch(vp, 1, "s")
            assert sums() == [n] * 4
        monkeypatch.setattr(counters.CounterLedger, "_write", write)
        ledger.apply_batch(vp, 1, "s")
        ledger.apply_batch(vp, 1, "s")
        assert sums() == [2 * n] * 4
        ledger.apply_batch(vp, 2, "s")          # folds batches 0 and 1
        ledger.apply_batch(vp, 0, "other")
        assert sums() == [4 * n] * 4
    finally:
        ledger.drop_schema()


# --- sessions -------------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)


def plain_sessions(rows, gap=1800):
    """(key, seconds, size) -> {(key, first, last + gap, hits, bytes)}."""
    out = []
    for key, at, size in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        if out and out[-1][0] == key and at <= out[-1][2]:
            out[-1] = (key, out[-1][1], at + gap, out[-1][3] + 1, out[-1][4] + size)
        else:
            out.append((key, at, at + gap, 1, size))
    return set(out)


def hits(spark, rows):
    made = [(k, None if at is None else T0 + dt.timedelta(seconds=at), s) for k, at, s in rows]
    return spark.createDataFrame(made, "ip_address string, date_time timestamp_ntz, content_size long").withColumn(
        "date_time", F.col("date_time").cast("timestamp")).repartition(3)


def seconds(df):
    us = lambda c: ((F.unix_micros(c) - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))) / 1_000_000).cast("long")
    return {tuple(r) for r in df.select("ip_address", us("session_start"), us("session_end"), "hits", "bytes").collect()}


def test_sessions_against_a_loop(spark):
    r = random.Random(6)
    rows = [(r.choice(["a", "b", None]), r.randrange(0, 400_000), r.randrange(100)) for _ in range(400)]
    rows += [("hot", 20 * k, 1) for k in range(5000)]       # one visit over five stretches
    rows += [("edge", 0, 1), ("edge", 1800, 2), ("edge", 3601, 4), ("edge", 3601, 8), ("none", None, 1)]
    assert seconds(sessions(hits(spark, rows), "ip_address")) == plain_sessions(rows)
    assert sessions(hits(spark, rows).limit(0), "ip_address").collect() == []


def test_a_hot_key_meets_with_few_rows(spark):
    rows = hits(spark, [("hot", 20 * k, 1) for k in range(5000)])
    plan = sessions(rows, "ip_address")._jdf.queryExecution().executedPlan().toString()
    # hits meet by key and stretch, sessions by key
    assert re.findall(r"hashpartitioning\((\w+)#\d+(, [a-z_]\w+)?", plan) == [("ip_address", ""), ("ip_address", ", _groupingexpression")]


@pytest.fixture(scope="module")
def event_lines(spark):
    return fixtures.event_log_lines(fixtures.load(spark, SF001, "events"))


def test_stream_sessions_are_the_closed_ones_of_the_batch(spark, event_lines):
    got = queries.STREAM_QUERIES["stream_sessions_per_user"](spark, SF001)
    logs = registry.access_logs(spark, SF001)
    passed = logs.agg(F.max("date_time")).first()[0] - dt.timedelta(minutes=1)
    expected = sessions(logs, "user").where(F.col("session_end") <= F.lit(passed))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert got.columns == expected.columns


# --- repeated and late lines ---------------------------------------------------------------

def test_repeated_slices_count_once(spark, event_lines):
    got = {tuple(r) for r in queries.q_stream_without_repeats(spark, SF001).collect()}
    logs = registry.access_logs(spark, SF001).distinct()
    assert got == {tuple(r) for r in logs.groupBy("response_code").count().collect()}


def test_late_rows_go_to_quarantine(spark, event_lines):
    got = queries.q_stream_late_lines(spark, SF001).collect()
    assert sum(r.hits for r in got) == registry.access_logs(spark, SF001).count()
    assert any(r.late for r in got) and any(not r.late for r in got)


def test_a_replayed_batch_is_split_as_before(spark):
    lines = ['1.2.3.4 - u [01/Jan/2024:{:02d}:00:00 +0000] "GET / HTTP/1.1" 200 1 "-" "a"'.format(h) for h in (10, 5, 9, 12, 11)]
    feed, ckpt, on_time, late = (shared_dir(spark, n) for n in ("feed", "ck", "on-time", "late"))

    def run(some):
        spark.createDataFrame([(x,) for x in some], "value string").coalesce(1).write.mode("append").text(feed)
        query = jobs.start_late_split(spark.readStream.text(feed), on_time, late, ckpt, "2 hours", {"availableNow": True})
        queries.await_end(query)

    run(lines[:1])
    run(lines[1:4])
    hour = lambda path: sorted((r.batch_id, r.h) for r in queries.read_batches(spark, path).select(
        "batch_id", F.hour("date_time").alias("h")).collect())
    assert hour(on_time) == [(0, 10), (1, 9), (1, 12)] and hour(late) == [(1, 5)]
    # batch 1 was not logged as done: it comes again after its newest time had been noted
    commits = f"{local(ckpt)}/commits"
    for name in os.listdir(commits):
        if name.strip(".").startswith("1"):
            os.remove(f"{commits}/{name}")
    run(lines[4:])
    assert hour(on_time) == [(0, 10), (1, 9), (1, 12), (2, 11)] and hour(late) == [(1, 5)]
