"""PRJ-4 / JOI-1: refine access-log records into viewed products.

Country comes from a left join on the class-B prefix (no match -> NULL
country, decision D2); product from the URI.  The lookup side is broadcast
only behind a size check; beyond it both sides are dealt out by prefix and
share (``salted_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ip_prefix, product_from_uri
from ..schema import MAX_CLASS_B_PREFIXES, VIEWED_PRODUCTS_COLUMNS


MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(side: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a side is small in rows and in bytes of text; reads at most ``max_rows + 1`` of its rows."""
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in side.schema
             if f.dataType.simpleString() == "string"]
    size = sum(texts, F.lit(16)).cast("bigint")
    n, held = side.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and held <= max_bytes


def bounded_broadcast(side: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(side)`` when it is small, else ``side``."""
    return F.broadcast(side) if fits_broadcast(side, max_rows, max_bytes) else side


def with_refined_columns(logs: DataFrame) -> DataFrame:
    return logs.withColumn("prefix", ip_prefix("ip_address")) \
               .withColumn("product", product_from_uri("request_uri"))


SALTS = 16


def salted_join(logs: DataFrame, side: DataFrame, salts: int = SALTS) -> DataFrame:
    """Left join on ``prefix`` for a lookup that is too large to broadcast.

    A log row goes to one of ``salts`` shares of its prefix by a hash of the whole row, and every lookup row to all
    of them, so rows of one busy prefix, or without a prefix, meet in as many tasks as there are shares.  The hash is
    of the row alone: a task that runs again deals its rows out as before.
    """
    share = "_share"
    while share in logs.columns:
        share += "_"
    dealt = logs.withColumn(share, F.pmod(F.xxhash64(*logs.columns), F.lit(salts)).cast("int"))
    copies = side.withColumn(share, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, ["prefix", share], "left").drop(share)


def join_country(logs: DataFrame, lookup: DataFrame, broadcast: str = "check",
                 max_broadcast_rows: int = MAX_CLASS_B_PREFIXES, salts: int = SALTS) -> DataFrame:
    """Left join on ``prefix``.

    broadcast: ``check`` (broadcast behind a size check, a salted join beyond it; default), ``none`` (the caller
    already hinted the side).
    """
    side = lookup.select("prefix", "country_code")
    if broadcast == "none":
        return logs.join(side, "prefix", "left")
    if fits_broadcast(side, max_broadcast_rows):
        return logs.join(F.broadcast(side), "prefix", "left")
    return salted_join(logs, side, salts)


def viewed_products(logs: DataFrame, lookup: DataFrame, broadcast: str = "check",
                    extra_columns: tuple = ()) -> DataFrame:
    """(user, country_code, date_time, product, response_code), 1:1 with ``logs``."""
    joined = join_country(with_refined_columns(logs), lookup, broadcast)
    return joined.select(*VIEWED_PRODUCTS_COLUMNS, *extra_columns)
