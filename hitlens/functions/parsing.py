"""One-pass parser for combined-format access-log lines.

A single ``regexp_replace`` rewrites a matching line into its 11 fields joined
by U+0001 and ``split`` cuts it; lines that do not match stay whole and give
one part.  Typed columns come from ``try_*`` casts so a bad line never fails
the job under ANSI mode.  All of it is built-in expressions (whole-stage
codegen); no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ACCESS_LOG_COLUMNS

# Line layout  ip client user [time] "method uri protocol" status size "referrer" "agent"
# A request that never arrived is "-".  Quoted fields may hold escaped characters; the quantifiers are
# possessive, so long fields cost neither backtracking nor stack.
_QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(?:(\S+) (\S+)(?: (\S+))?|-)" (\d{3}) (\d+|-) '
    rf'{_QUOTED} {_QUOTED}$'
)
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
FIELD_SEP = "\u0001"
N_FIELDS = 11

_REPLACEMENT = FIELD_SEP.join(f"${i}" for i in range(1, N_FIELDS + 1))


def _parts(value: Column) -> Column:
    """The 11 fields, or one part when the pattern fails; NULL for a line
    that holds the separator itself (rejected)."""
    return F.when(F.instr(value, FIELD_SEP) == 0,
                  F.split(F.regexp_replace(value, LOG_PATTERN, _REPLACEMENT), FIELD_SEP, -1))


def parse_logs(lines: DataFrame, value_col: str = "value", keep_raw: bool = True,
               keep_offset: bool = False) -> DataFrame:
    """Lines -> typed access-log columns plus ``is_valid`` (never NULL).

    A line is valid when it matches the pattern, holds no U+0001, and its time
    and size cast; a ``-`` size counts as 0 (decision D6).  A ``"-"`` request
    has NULL method, URI and protocol, a request without protocol a NULL
    protocol.  Escaped quotes stay as written.  ``keep_offset``
    adds ``utc_offset``, the zone as written (``-0500``), for hours as written.

    The split fields leave a generator (``explode`` of a one-element array).
    Catalyst cannot push a filter on generated columns below the generator,
    so ``where(is_valid)`` reads the split array instead of inlining the
    regular expression once per field it checks: the pattern runs once per
    line (7 times without the generator).
    """
    value = F.col(value_col)
    keep = [F.col(c) for c in lines.columns] if keep_raw else []
    # every check reads the generated array only, so no part of the
    # validity test is pushed below the generator onto the raw line
    split = lines.select(*keep, F.explode(F.array(_parts(value))).alias("_p"))
    p = F.col("_p")
    size_txt = F.get(p, 8)
    date_time = F.try_to_timestamp(F.get(p, 3), F.lit(LOG_TIME_FORMAT))
    response_code = F.get(p, 7).try_cast("int")
    content_size = (F.when(size_txt == "-", F.lit(0).cast("bigint"))
                     .otherwise(size_txt.try_cast("bigint")))
    is_valid = F.coalesce(
        (F.size(p) == N_FIELDS)
        & date_time.isNotNull() & response_code.isNotNull() & content_size.isNotNull(),
        F.lit(False),
    )
    return split.select(
        *keep,
        F.get(p, 0).alias("ip_address"),
        F.get(p, 1).alias("client_id"),
        F.get(p, 2).alias("user"),
        date_time.alias("date_time"),
        F.nullif(F.get(p, 4), F.lit("")).alias("method"),
        F.nullif(F.get(p, 5), F.lit("")).alias("request_uri"),
        F.nullif(F.get(p, 6), F.lit("")).alias("protocol"),
        response_code.alias("response_code"),
        content_size.alias("content_size"),
        F.get(p, 9).alias("referrer"),
        F.get(p, 10).alias("user_agent"),
        is_valid.alias("is_valid"),
        *([F.substring_index(F.get(p, 3), " ", -1).alias("utc_offset")] if keep_offset else []),
    )


def valid(parsed: DataFrame) -> DataFrame:
    """FIL-1: good records, typed access-log columns only."""
    return parsed.where(F.col("is_valid")).select(*ACCESS_LOG_COLUMNS)


def rejects(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """FIL-2: raw text of rejected lines (write it out; never collect)."""
    return parsed.where(~F.col("is_valid")).select(value_col)


def line_counts() -> list[Column]:
    """Lines, good lines, rejected lines (good + rejected = lines)."""
    return [F.count(F.lit(1)).alias("total_lines"), F.count_if(F.col("is_valid")).alias("good_lines"),
            F.count_if(~F.col("is_valid")).alias("rejected_lines")]


def parse_summary(parsed: DataFrame) -> DataFrame:
    """One row: lines, good lines, rejected lines."""
    return parsed.agg(*line_counts())


def split_once(parsed: DataFrame, path: str, refine=lambda rows: rows) -> DataFrame:
    """Write good and rejected lines below ``path`` in one pass over ``parsed``; the table, with ``is_valid``.

    ``refine`` adds to the rows (it must keep their number, ``is_valid`` and ``value``); the raw line stays with
    rejects only.  A reader of one side reads that side's files.  At most two files are open per task, so nothing
    is sorted.  Counts come from the written table (``parse_summary``): they need no line and hold after a lost
    executor, which counts taken on the way (``observed``) need not.
    """
    spark = parsed.sparkSession
    rows = refine(parsed.withColumn("value", F.when(~F.col("is_valid"), F.col("value"))))
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(setting)
    spark.conf.set(setting, "2")
    try:
        rows.write.partitionBy("is_valid").parquet(path)
    finally:
        spark.conf.set(setting, old)
    return spark.read.schema(rows.schema).parquet(path)


def observed(parsed: DataFrame, name: str = "lines") -> DataFrame:
    """``parsed``, whose lines, good lines and rejects are counted while it runs; in a stream each micro-batch's
    progress holds them under ``name``."""
    return parsed.observe(name, *line_counts())
