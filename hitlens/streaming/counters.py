"""Counter tables (SNK-3..9) as a replay-safe ledger.

The reference incremented counters with ``x = x + n`` per micro-batch, so a
retried batch counted twice (Q7).  Here each table is a ledger of deltas
partitioned by (stream_id, batch_id).  The stream id is the streaming query's
own, which lives in its checkpoint: a batch that is replayed after a restart
replaces its partition and leaves totals unchanged, while another stream, or
the same job with a new checkpoint, adds to them.  The counter value is
``sum(delta)`` per key.  Tables are managed tables of one database located in
the shared folder, created with SQL DDL.

A batch is four writes, and it shows in all four tables at once: readers take a stream's batches up to the one that
its commit record names, and the record moves on after the last write.

``compact`` folds a stream's batches up to ``n`` into a base partition whose id
records ``n`` (``batch_id = -1 - n``).  Readers take each stream's newest base
plus the deltas after it, so a compaction that stops half way - new base
written, old partitions not yet dropped - never counts a batch twice, and a
batch replayed after being folded is ignored.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import minute_key
from ..operators.reports import count_by
from ..schema import COUNTER_TABLES
from ..session import remove_dir, shared_dir
from .manifest import Manifest


def _plain(stream_id: str) -> str:
    """A stream id as it may stand in SQL text."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", stream_id):
        raise ValueError(f"stream id {stream_id!r}")
    return stream_id


def base_batch_id(upto_batch_id: int) -> int:
    """Partition id of the base holding batches ``<= upto_batch_id``."""
    return -1 - upto_batch_id


class CounterLedger:
    """Four counter tables: page_views, log_volume_by_minute, status_counter,
    visits_by_country (key, count)."""

    def __init__(self, spark: SparkSession, database: str, location: str,
                 compact_every: int | None = None):
        """``compact_every=n`` folds the ledger every n batches (inside the
        stream), so the rows a read sums stay bounded by n batches plus a base."""
        self.spark = spark
        self.database = database
        self.location = location
        self.compact_every = compact_every
        self.commits = Manifest(spark, f"{location.rstrip('/')}/_commits")

    # --- DDL (SNK-7, SNK-8) -------------------------------------------------
    def create_schema(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
                       f"LOCATION '{self.location}'")
        for table, (key, key_type, value) in COUNTER_TABLES.items():
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{self.database}`.`{table}` "
                f"(`{key}` {key_type.simpleString().upper()}, `{value}` BIGINT, "
                "stream_id STRING, batch_id BIGINT) USING parquet PARTITIONED BY (stream_id, batch_id)")

    def drop_table(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{table}`")

    def drop_schema(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    def ledger(self, table: str) -> DataFrame:
        """The ledger rows; the file listing is refreshed first, since batches
        replace partitions from the streaming thread."""
        name = f"`{self.database}`.`{table}`"
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    # --- increments (SNK-3..6) ----------------------------------------------
    def _write(self, table: str, deltas: DataFrame, stream_id: str, batch_id: int) -> None:
        """Replace the partition of the stream's batch (static partition overwrite):
        a replayed batch rewrites its own rows and nothing else."""
        key, _, value = COUNTER_TABLES[table]
        view = f"_counter_delta_{table}_{uuid.uuid4().hex[:8]}"
        deltas.select(F.col(key), F.col(value).cast("bigint").alias(value)) \
            .createOrReplaceTempView(view)
        session = deltas.sparkSession          # the micro-batch's session holds the view
        try:
            session.sql(
                f"INSERT OVERWRITE TABLE `{self.database}`.`{table}` "
                f"PARTITION (stream_id = '{_plain(stream_id)}', batch_id = {int(batch_id)}) "
                f"SELECT `{key}`, `{value}` FROM {view}")
        finally:
            session.catalog.dropTempView(view)

    def apply_batch(self, viewed: DataFrame, batch_id: int, stream_id: str) -> None:
        """STR-13: one micro-batch of viewed products -> four counter deltas.

        Each delta is a partial+final aggregate of the batch; the caller
        persists the batch once so the four writes read it once.
        """
        minutes = count_by(viewed, F.date_trunc("minute", "date_time").alias("_minute"), "count")
        deltas = {
            "page_views": count_by(viewed, F.col("product").alias("page"), "views"),
            "log_volume_by_minute": minutes.select(minute_key("_minute").alias("timestamp"), "count"),
            "status_counter": count_by(viewed, F.col("response_code").alias("status_code"), "count"),
            "visits_by_country": count_by(viewed, F.col("country_code").alias("country"), "count"),
        }
        for table, rows in deltas.items():
            self._write(table, rows, stream_id, batch_id)
        self._commit(stream_id, batch_id)
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            for table in COUNTER_TABLES:
                self.compact(table, stream_id, batch_id - 1)

    def _commit(self, stream_id: str, batch_id: int) -> None:
        """The batch is in all four tables: let it be seen (one row per stream)."""
        done = {e["stream"]: e["batch"] for e in self.commits.entries()}
        done[stream_id] = max(batch_id, done.get(stream_id, batch_id))
        self.commits.commit([{"stream": s, "batch": b} for s, b in done.items()])

    # --- reads (SNK-9) ------------------------------------------------------
    def live(self, table: str) -> DataFrame:
        """Ledger rows that count: of each stream the newest base, and the committed deltas after it."""
        self.ledger(table)          # refresh the listing
        t = f"`{self.database}`.`{table}`"
        done = ", ".join(f"('{_plain(e['stream'])}', {int(e['batch'])})" for e in self.commits.entries()) or "('', -1)"
        return self.spark.sql(
            f"SELECT t.* FROM {t} t JOIN (VALUES {done}) d(stream_id, last) ON t.stream_id = d.stream_id "
            f"LEFT JOIN (SELECT stream_id, min(batch_id) AS base FROM {t} "
            "WHERE batch_id < 0 GROUP BY stream_id) b ON t.stream_id = b.stream_id "
            "WHERE t.batch_id = b.base OR t.batch_id > coalesce(-1 - b.base, -1) AND t.batch_id <= d.last")

    def totals(self, table: str) -> DataFrame:
        key, _, value = COUNTER_TABLES[table]
        return self.live(table).groupBy(key).agg(F.sum(value).cast("bigint").alias(value))

    def register_views(self) -> None:
        for table in COUNTER_TABLES:
            self.totals(table).createOrReplaceTempView(table)

    def read(self, query: str) -> DataFrame:
        """SNK-9: run a read query over the counter views."""
        self.register_views()
        return self.spark.sql(query)

    # --- compaction -----------------------------------------------------------
    def compact(self, table: str, stream_id: str, upto_batch_id: int) -> None:
        """Fold the stream's live rows of batches ``<= upto_batch_id`` (the previous base
        included) into a new base partition, then drop what it replaces.

        The folded totals go to a staging folder first, which cuts the lineage to
        the partitions that are dropped afterwards.
        """
        key, _, value = COUNTER_TABLES[table]
        name = f"`{self.database}`.`{table}`"
        new_base = base_batch_id(upto_batch_id)
        own = (F.col("stream_id") == stream_id) & (F.col("batch_id") <= upto_batch_id)
        folded = self.live(table).where(own).groupBy(key).agg(F.sum(value).cast("bigint").alias(value))
        staging = shared_dir(self.spark, f"staging-{table}")
        folded.write.parquet(staging)
        self._write(table, self.spark.read.parquet(staging), stream_id, new_base)
        remove_dir(self.spark, staging)
        # partition ids only: one small row per superseded batch or base since the last compaction
        stale = [r[0] for r in self.ledger(table).where(own & (F.col("batch_id") != new_base))
                 .select("batch_id").distinct().collect()]
        if stale:
            parts = ", ".join(f"PARTITION (stream_id='{_plain(stream_id)}', batch_id={b})" for b in stale)
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
        self.spark.catalog.refreshTable(name)
