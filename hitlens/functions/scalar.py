"""Scalar column functions (all built-in expressions, JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_FORMAT = "yyyy-MM-dd HH:mm"          # decision D3
LINE_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# single-character separators: trailing empty fields are trailing separators
_SINGLE_CHAR = {"/": "/", r"\.": ".", " ": " "}


def java_split(text, sep_regex: str) -> Column:
    """``String.split(regex)``: trailing empty fields are dropped.

    (An input made only of separators gives one empty field here, none in
    Java; every caller treats both as "too few fields".)
    """
    char = _SINGLE_CHAR.get(sep_regex)
    stripped = (F.rtrim(_col(text), F.lit(char)) if char is not None
                else F.regexp_replace(_col(text), f"(?:{sep_regex})+$", ""))
    return F.split(stripped, sep_regex, -1)


def product_from_uri(uri) -> Column:
    """SCA-2: the 4th '/'-separated part of a URI; NULL when there are fewer."""
    return F.get(java_split(uri, "/"), 3)


def ip_prefix(ip) -> Column:
    """SCA-3: class-B prefix ``a.b`` of a dotted address; NULL without a second part."""
    parts = java_split(ip, r"\.")
    return F.when(F.size(parts) >= 2, F.concat_ws(".", F.get(parts, 0), F.get(parts, 1)))


def hour_of(ts, offset=None) -> Column:
    """SCA-4: hour of day (INT) in the session time zone (UTC); with
    ``offset`` (``+hhmm`` / ``-hhmm`` text) the hour as written in the line."""
    if offset is None:
        return F.hour(_col(ts))
    off = _col(offset)
    seconds = (F.when(off.startswith("-"), -1).otherwise(1)
               * (F.substring(off, 2, 2).cast("int") * 3600 + F.substring(off, 4, 2).cast("int") * 60))
    return F.hour(F.timestamp_seconds(F.unix_seconds(_col(ts)) + seconds))


def minute_key(ts) -> Column:
    """SCA-5 getMinPattern: minute bucket as text."""
    return F.date_format(_col(ts), MINUTE_FORMAT)


def int_div(a: str, b: str) -> Column:
    """SCA-6: integral division as Long / Long does it (NULL on a zero count).

    Takes column names; ``div`` truncates toward zero like Java.
    """
    return F.expr(f"`{a}` div nullif(`{b}`, 0)")


def reformat_date(src, src_pattern: str, dest_pattern: str) -> Column:
    """SCA-1: parse with one pattern, print with another; NULL if it does not parse.

    Patterns are Spark datetime patterns, not ``SimpleDateFormat``: ``y``,
    ``M``/``MMM``, ``d``, ``D``, ``H``, ``m``, ``s``, ``S``, ``a``,
    ``Z``/``X``/``x`` and quoted text behave alike; ``E`` (day name) only
    formats; week-based ``Y``, ``w``, ``W`` and ``u`` are rejected by Spark.
    Month and day names are English.
    """
    return F.date_format(F.try_to_timestamp(_col(src), F.lit(src_pattern)), dest_pattern)


def format_ipv4(a, b, c, d) -> Column:
    """SCA-11: dotted address from four integer columns."""
    return F.format_string("%d.%d.%d.%d", _col(a), _col(b), _col(c), _col(d))


def format_log_line(ip, user, ts, request, status, size,
                    referrer="-", agent="Mozilla/5.0", offset: str = "+0000") -> Column:
    """SCA-10: one combined-format line.

    ``ts`` is printed with ``offset`` appended as written (the feeder printed
    its local clock with a fixed offset, Q11); pass the offset that matches the
    wall time of ``ts``.
    """
    ref = F.lit(referrer) if isinstance(referrer, str) else referrer
    agt = F.lit(agent) if isinstance(agent, str) else agent
    return F.format_string(
        '%s - %s [%s %s] "%s" %d %d "%s" "%s"',
        _col(ip), _col(user).cast("string"),
        F.date_format(_col(ts), LINE_TIME_FORMAT), F.lit(offset),
        _col(request), _col(status), _col(size), ref, agt,
    )
