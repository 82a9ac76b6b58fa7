"""Visits: the hits of one address or user with no pause longer than a gap (STR-14).

In a stream this is Spark's session window, whose state holds open sessions only and merges what belongs
together before the shuffle.  In batch form the hits of a key are first made into sessions within stretches of time, so that a
key with a third of all hits is spread over as many tasks as there are stretches; what meets per key afterwards is one row per
session and stretch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SESSION_GAP = "30 minutes"
STRETCH_SECONDS = 6 * 3600


def _measures(content: str | None) -> list:
    return [F.count(F.lit(1)).alias("hits"), F.sum(content or F.lit(0)).cast("bigint").alias("bytes")]


def sessions(logs: DataFrame, key: str, gap: str = SESSION_GAP, time_col: str = "date_time",
             size_col: str = "content_size", stretch: int = STRETCH_SECONDS) -> DataFrame:
    """(key, session_start, session_end, hits, bytes); a session ends ``gap`` after its last hit.

    Two hits exactly ``gap`` apart belong together.  Hits without a key are a key of their own; hits without a time
    belong to no session.
    """
    window = F.session_window(time_col, gap)
    out = [key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "hits", "bytes"]
    if logs.isStreaming:
        return logs.groupBy(window.alias("s"), key).agg(*_measures(size_col)).select(*out)
    parts = (logs.where(F.col(time_col).isNotNull())
             .groupBy(key, F.floor(F.unix_seconds(time_col) / stretch).alias("stretch"), window.alias("s")).agg(*_measures(size_col))
             .select(*out))
    mine = Window.partitionBy(key).orderBy("session_start")
    before = mine.rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("session_start") > F.max("session_end").over(before), F.lit(True))
    numbered = parts.withColumn("_begins", begins).withColumn("_n", F.sum(F.col("_begins").cast("long")).over(
        mine.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "_n").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes")).drop("_n")
