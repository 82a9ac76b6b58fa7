"""Line feed in time slices, for stream queries whose results depend on the batch.

``stage_slices`` writes all lines once, partitioned by slice of the time span.
``append_slice`` adds one staged slice to the folder a stream reads.  A caller
appends a slice and runs the stream with ``availableNow`` to its end before it
appends the next, so micro-batch b is the b-th slice that has lines, whatever
the number of files, cores or partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_SLICES, LINES_PER_SLICE = 4, 2_000_000


def slice_count(n_lines: int) -> int:
    """Slices of a feed: more for more lines, so that no micro-batch grows with the table."""
    return max(MIN_SLICES, -(-n_lines // LINES_PER_SLICE))


def time_slice(time_col: str, lo: int, hi: int, n_slices: int):
    """Slice of the time span ``[lo, hi]`` (epoch micros) holding each row:
    ``(micros - lo) * n div (hi - lo + 1)``, i.e. ``n`` equal, ordered slices."""
    return F.expr(f"((unix_micros(`{time_col}`) - {lo}) * {n_slices}) div {hi - lo + 1}")


def stage_slices(lines: DataFrame, path: str, time_col: str = "ts", value_col: str = "value",
                 n_slices: int | None = None) -> list[int]:
    """Write ``lines`` below ``path``, one partition per slice; the slices that have lines, in order.

    The driver gets the time bounds, the count and the slice numbers.
    """
    us = F.unix_micros(F.col(time_col))
    lo, hi, n = lines.agg(F.min(us), F.max(us), F.count(F.lit(1))).first()
    if not n:
        return []
    sliced = lines.select(time_slice(time_col, lo, hi, n_slices or slice_count(n)).alias("slice"), value_col)
    sliced.write.partitionBy("slice").text(path)
    staged = lines.sparkSession.read.text(path).select("slice").distinct()
    return sorted(int(r[0]) for r in staged.collect())


def append_slice(spark: SparkSession, staged: str, slice_id: int, path: str) -> None:
    spark.read.text(f"{staged}/slice={slice_id}").write.mode("append").text(path)
