"""Lookup sources: IP-prefix -> country file, and the class-B dictionary.

Both arrive as text lines ``a.b CODE``.  Line order matters (the last line for
a prefix wins in the lookup; the dictionary keeps the first lines per
country), so every reader carries an orderable ``line_order`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import java_split
from ..operators.refine import bounded_broadcast
from ..operators.topk import first_k_per_group
from ..schema import MAX_CLASS_B_PREFIXES  # noqa: F401  (re-exported)

# A valid class-B prefix: two octets 0..255.  After one row per prefix the
# lookup holds at most 256 * 256 rows, which is what makes broadcasting it safe.
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CLASS_B_PATTERN = rf"^{OCTET}\.{OCTET}$"

MAX_IPS_PER_COUNTRY = 1000   # fixed value: the reference's cap; callers pass it themselves
MAX_COUNTRIES = 1000         # rows of a country list that are broadcast

# Fixed values of the reference: the listed countries, in order (the index is `ctry`).
COUNTRY_CODES = ["CH", "US", "IN", "JP", "BR", "DE", "RU", "ID", "GB", "FR",
                 "NG", "MX", "KR", "IR", "TR", "IT", "PH", "VN", "ES", "PK"]


def countries_table(spark: SparkSession, codes: list[str] = COUNTRY_CODES) -> DataFrame:
    """(ctry INT, code STRING) of a country list, as an inline relation (no Python worker)."""
    rows = ", ".join(f"({i}, '{c}')" for i, c in enumerate(codes))
    return spark.sql(f"SELECT CAST(ctry AS INT) AS ctry, code FROM VALUES {rows} AS t(ctry, code)")


def file_line_order() -> Column:
    """Order of lines in text files: (file, split start, position in split)."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def read_lines_in_order(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select("value", file_line_order().alias("line_order"))


def split_lookup_lines(lines: DataFrame, value_col: str = "value",
                       order_col: str = "line_order") -> DataFrame:
    """Lines -> (prefix, country_code, line_order, is_valid).

    A line with fewer than two space-separated fields (the reference threw on
    it) or a prefix that is not a class-B prefix is not valid.
    """
    # the split leaves a generator, so a filter on is_valid reads the array
    # instead of splitting the line again
    split = lines.select(F.explode(F.array(java_split(value_col, " "))).alias("_f"),
                         F.col(order_col).alias(order_col))
    fields = F.col("_f")
    return split.select(
        F.get(fields, 0).alias("prefix"),
        F.get(fields, 1).alias("country_code"),
        F.col(order_col).alias("line_order"),
        F.coalesce((F.size(fields) >= 2) & F.get(fields, 0).rlike(CLASS_B_PATTERN),
                   F.lit(False)).alias("is_valid"),
    )


def lookup_from_lines(lines: DataFrame, value_col: str = "value",
                      order_col: str = "line_order") -> DataFrame:
    """SRC-4: one row per prefix; a later line for the same prefix wins.

    ``max_by`` over the line order is a partial+final aggregate, so a prefix
    repeated on a third of the lines is combined map-side.
    """
    rows = split_lookup_lines(lines, value_col, order_col).where("is_valid")
    return rows.groupBy("prefix").agg(
        F.max_by("country_code", "line_order").alias("country_code"))


def lookup_rejects(lines: DataFrame, value_col: str = "value",
                   order_col: str = "line_order") -> DataFrame:
    return split_lookup_lines(lines, value_col, order_col).where(~F.col("is_valid"))


def read_country_lookup(spark: SparkSession, path) -> DataFrame:
    """Country lookup file(s) -> (prefix, country_code)."""
    return lookup_from_lines(read_lines_in_order(spark, path))


def _dictionary_rows(lines: DataFrame, countries: DataFrame, value_col: str, order_col: str) -> DataFrame:
    """Lines of exactly two fields with a listed country and an integer prefix."""
    # both splits leave a generator, so the row filter below reads the arrays
    # instead of splitting every line again per checked field
    split = lines.select(F.explode(F.array(java_split(value_col, " "))).alias("_f"),
                         F.col(order_col).alias(order_col))
    split = split.select("*", F.explode(F.array(java_split(F.get("_f", 0), r"\."))).alias("_o"))
    fields, octets = F.col("_f"), F.col("_o")
    rows = split.select(
        F.get(fields, 1).alias("code"),
        F.get(octets, 0).try_cast("int").alias("ip_a"),
        F.get(octets, 1).try_cast("int").alias("ip_b"),
        F.col(order_col).alias("line_order"),
        F.size(fields).alias("_n"),
        F.size(octets).alias("_m"),
    ).where("_n = 2 AND _m >= 2 AND ip_a IS NOT NULL AND ip_b IS NOT NULL")
    listed = countries.select("code", "ctry")
    return rows.join(bounded_broadcast(listed, MAX_COUNTRIES), "code", "inner")


def prefix_dictionary(lines: DataFrame, countries: DataFrame, max_per_country: int,
                      value_col: str = "value", order_col: str = "line_order") -> DataFrame:
    """SRC-5: class-B dictionary for the listed countries.

    Keeps lines with exactly two fields whose country is in ``countries``
    (ctry INT, code STRING) and whose prefix splits into two integers, then the
    first ``max_per_country`` of them per country in line order.  The cap is
    the operator (the reference's is 1000), so the caller states it;
    :func:`dictionary_cut` counts what it leaves out.  The per-country cut is a
    two-level exact top-k, so a country holding a third of all lines never
    lands whole in one task.
    """
    listed = _dictionary_rows(lines, countries, value_col, order_col)
    ranked = first_k_per_group(listed, "code", "line_order", max_per_country)
    return ranked.select(F.col("code").alias("country"), "ctry", "ip_a", "ip_b",
                         (F.col("_rank") - 1).cast("int").alias("slot"))


def dictionary_cut(lines: DataFrame, countries: DataFrame, max_per_country: int,
                   value_col: str = "value", order_col: str = "line_order") -> DataFrame:
    """(country, lines, kept, cut) per country: how many lines the cap of the dictionary leaves out."""
    counts = _dictionary_rows(lines, countries, value_col, order_col).groupBy("code").agg(
        F.count(F.lit(1)).alias("lines"))
    kept = F.least("lines", F.lit(max_per_country).cast("bigint"))
    return counts.select(F.col("code").alias("country"), "lines", kept.alias("kept"),
                         (F.col("lines") - kept).alias("cut"))
