"""Sliding-window reports (STR-3 in batch form; the streaming jobs reuse them).

The reference windows 30 s of arrivals every 10 s.  Here windows are on event
time (``date_time``) and aligned to the epoch; a streaming caller adds a
watermark.  Top-k per window uses ``row_number() <= k``, which Spark plans
with a partial window-group limit before the shuffle, so a window holding a
third of all rows still ships at most ``k`` rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Window length and slide of the reference jobs.
WINDOW_LENGTH = "30 seconds"
SLIDE_INTERVAL = "10 seconds"


def _seconds(interval: str) -> int | None:
    """Whole seconds of a plain ``n seconds|minutes|hours`` interval, else None."""
    parts = interval.split()
    unit = {"second": 1, "minute": 60, "hour": 3600}.get(parts[-1].rstrip("s")) if len(parts) == 2 else None
    return int(parts[0]) * unit if unit and parts[0].isdigit() else None


def windowed_counts(df: DataFrame, keys: tuple[str, ...] = (), length: str = WINDOW_LENGTH,
                    slide: str = SLIDE_INTERVAL, time_col: str = "date_time", name: str = "views") -> DataFrame:
    """Rows per sliding window and key: (window_start, window_end, *keys, name).

    Rows are counted once per pane (one slide long) and key; a pane's count is then added to each window that
    holds it.  So the rows are aggregated before they are multiplied by length / slide.  A stream counts by window at
    once: a micro-batch is aggregated per window and key before it meets the state, so panes as a stateful step of
    their own only add to what the state writes (README has figures).
    """
    return windowed_aggregate(df, keys, [F.count(F.lit(1)).alias(name)], [F.sum(name).cast("bigint").alias(name)],
                              length, slide, time_col)


def windowed_aggregate(df: DataFrame, keys: tuple[str, ...], partial: list, merge: list, length: str = WINDOW_LENGTH,
                       slide: str = SLIDE_INTERVAL, time_col: str = "date_time") -> DataFrame:
    """(window_start, window_end, *keys, *measures): ``partial`` over the rows of a pane, ``merge`` (same names) over
    the panes of a window."""
    size, step = _seconds(length), _seconds(slide)
    out = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "m.*"]
    merged = F.struct(*merge).alias("m")
    if df.isStreaming or not size or not step or size % step:
        w = F.window(time_col, length, slide)
        return df.groupBy(w.alias("w"), *keys).agg(F.struct(*partial).alias("m")).select(*out)
    panes = df.where(F.col(time_col).isNotNull()).groupBy(F.window(time_col, slide).alias("p"), *keys).agg(*partial)
    starts = F.transform(F.sequence(F.lit(0), F.lit(size // step - 1)), lambda k: F.timestamp_micros(
        F.unix_micros("p.start") - k.cast("bigint") * (step * 1_000_000)))
    spread = panes.select("*", F.explode(starts).alias("window_start"))
    end = F.timestamp_micros(F.unix_micros("window_start") + F.lit(size * 1_000_000).cast("bigint"))
    return spread.groupBy("window_start", *keys).agg(merged).select("window_start", end.alias("window_end"), *keys, "m.*")


def sliding_window_counts(df: DataFrame, length: str = WINDOW_LENGTH,
                          slide: str = SLIDE_INTERVAL, time_col: str = "date_time",
                          name: str = "views") -> DataFrame:
    """Rows per sliding window: (window_start, window_end, views)."""
    return windowed_counts(df, (), length, slide, time_col, name)


def rank_in_window(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` products of each window with most views, ties by name."""
    order = Window.partitionBy("window_start", "window_end").orderBy(
        F.col("views").desc(), F.col("product").asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sliding_top_products(vp: DataFrame, k: int = 10, length: str = WINDOW_LENGTH,
                         slide: str = SLIDE_INTERVAL, time_col: str = "date_time") -> DataFrame:
    """Top ``k`` products per sliding window, ranked by views then product."""
    return rank_in_window(windowed_counts(vp, ("product",), length, slide, time_col), k)
