"""Independent DuckDB SQL for every oracle-comparable query.

These texts compute the expected answers straight from the driver tables
(``events``, ``nation``, ``pages``); they never see a log line, so a parser or
join bug cannot hide in both sides.  The constants of the fixture rules
(FIXTURES.md §3) are written out here again.  Column names and types match the Spark
queries (hour INT, counts BIGINT, sums cast to BIGINT).
"""

from __future__ import annotations

# the 20 listed countries and the three that the dictionary must drop
CODES = ("['CH', 'US', 'IN', 'JP', 'BR', 'DE', 'RU', 'ID', 'GB', 'FR', 'NG', 'MX', 'KR', 'IR', 'TR', 'IT', "
         "'PH', 'VN', 'ES', 'PK', 'AQ', 'BV', 'HM']")

URI = ("CASE WHEN e.event_id % 89 = 0 THEN '/' "
       "ELSE '/shop/catalog/p' || (e.props ->> '$.k') || '/' || e.event_type END")
STATUS = ("CAST(CASE e.event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 "
          "ELSE 200 END AS INTEGER)")
IP = "concat_ws('.', 10 + e.user_id % 25, e.user_id % 7, e.user_id % 250, e.event_id % 8)"

GOOD = f"""good AS (
  SELECT e.event_id, e.user_id, e.ts AS event_ts,
         {IP} AS ip_address,
         '-' AS client_id,
         CAST(e.user_id AS VARCHAR) AS "user",
         date_trunc('second', e.ts) AS date_time,
         'GET' AS method,
         {URI} AS request_uri,
         CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE 'HTTP/1.1' END AS protocol,
         {STATUS} AS response_code,
         CAST(e.event_id * 37 % 4096 AS BIGINT) AS content_size,
         '-' AS referrer,
         'Mozilla/5.0' AS user_agent,
         CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE 'p' || (e.props ->> '$.k') END AS product,
         n.n_name AS country_code
  FROM events e
  LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
  UNION ALL
  SELECT event_id, user_id, ts, 'localhost', '-', '-', date_trunc('second', ts), NULL, NULL, NULL,
         CAST(408 AS INTEGER), CAST(0 AS BIGINT), 'http://ref.example/' || event_id,
         'Mozilla \\"quoted\\" ' || (event_id % 3), NULL, NULL
  FROM events WHERE event_id % 53 = 0
)"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((GOOD,) + ctes) + "\n" + body


WINDOWS = """win AS (
  SELECT time_bucket(INTERVAL '10 seconds', date_time) - to_seconds(k * 10) AS window_start,
         product
  FROM good, (SELECT unnest(range(3)) AS k) ks)"""

def _counts_sql() -> str:
    """A plain GROUP BY per report, side by side."""
    columns = ['"user"', "country_code", "hour", "product", "response_code", "ip_address", "request_uri"]
    types = ["VARCHAR", "VARCHAR", "INTEGER", "VARCHAR", "INTEGER", "VARCHAR", "VARCHAR"]
    keys = {"views_per_user": ['"user"'], "views_per_country": ["country_code"], "views_per_hour": ["hour"],
            "views_per_product": ["product"], "views_per_user_product": ['"user"', "product"],
            "response_codes": ["response_code"], "ips": ["ip_address"], "endpoints": ["request_uri"], "sizes": []}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS report, " + ", ".join(
            c if c in by else f"CAST(NULL AS {t}) AS {c}" for c, t in zip(columns, types))
        + ", count(*) AS total, CAST(sum(content_size) AS BIGINT) AS total_size, min(content_size) AS min_size, "
          "max(content_size) AS max_size FROM hourly" + (f" GROUP BY {', '.join(by)}" if by else "")
        for name, by in keys.items())


def sessions_sql(key: str, closed: bool = False) -> str:
    """Gaps and islands: a pause of more than 30 minutes begins a session.  ``closed``: those that a watermark of one
    minute has passed."""
    return _with(
        f'SELECT "{key}", session_start, session_end, hits, bytes FROM ('
        f'SELECT "{key}", n, min(date_time) AS session_start, max(date_time) + INTERVAL 30 MINUTES AS session_end, '
        'count(*) AS hits, CAST(sum(content_size) AS BIGINT) AS bytes FROM ('
        f'SELECT *, sum(begins) OVER (PARTITION BY "{key}" ORDER BY date_time ROWS UNBOUNDED PRECEDING) AS n FROM ('
        'SELECT *, CASE WHEN date_time <= lag(date_time) OVER w + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS begins '
        f'FROM good WINDOW w AS (PARTITION BY "{key}" ORDER BY date_time))) GROUP BY 1, 2)'
        + (" WHERE session_end <= (SELECT max(date_time) FROM good) - INTERVAL 1 MINUTE" if closed else ""))


FORMAT_LINE = (
    f"{IP} || ' - ' || CAST(e.user_id AS VARCHAR) || ' [' || "
    "strftime(e.ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] \"GET ' || CASE WHEN e.event_id % 89 = 0 THEN '/' "
    f"ELSE {URI} || ' HTTP/1.1' END || '\" ' || CAST({STATUS} AS VARCHAR) || ' ' || "
    "CAST(e.event_id * 37 % 4096 AS VARCHAR) || ' \"-\" \"Mozilla/5.0\"'")

REJECTS = """SELECT CASE (event_id // 97) % 4 WHEN 0 THEN 'garbage line' WHEN 1 THEN ''
  WHEN 2 THEN '1.2.3.4 - u [99/Zzz/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 1 "-" "a"'
  ELSE '1.2.3.4 - u [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 20 1 "-" "a"' END AS value
FROM events WHERE event_id % 97 = 0"""
DICT_LINES = (
    f"lines AS (SELECT event_id AS line_order, list_extract({CODES}, CAST(user_id % 23 AS INTEGER) + 1) AS code, "
    "CAST(user_id % 23 AS INTEGER) AS ctry, CAST(10 + user_id % 25 AS INTEGER) AS ip_a, "
    "CAST(event_id % 256 AS INTEGER) AS ip_b FROM events WHERE user_id % 23 < 20)")

ACCESS_COLS = ('ip_address, client_id, "user", date_time, method, request_uri, protocol, '
               'response_code, content_size, referrer, user_agent')

TOP_PRODUCTS = ("SELECT product, count(*) AS views FROM good GROUP BY product "
                "ORDER BY views DESC, product ASC NULLS LAST LIMIT {k}")
VIEWS_PER_USER = 'SELECT "user", count(*) AS views FROM good GROUP BY "user"'
VIEWS_PER_COUNTRY = "SELECT country_code, count(*) AS views FROM good GROUP BY country_code"

ORACLE_SQL: dict[str, str] = {
    "parse_good": _with(f"SELECT {ACCESS_COLS} FROM good"),
    "parse_rejects": REJECTS,
    "parse_text": _with(f"SELECT {ACCESS_COLS} FROM good"),
    "parse_summary": (
        "SELECT good_lines + rejected_lines AS total_lines, good_lines, rejected_lines FROM ("
        "SELECT count(*) + count(*) FILTER (WHERE event_id % 53 = 0) AS good_lines, "
        "count(*) FILTER (WHERE event_id % 97 = 0) AS rejected_lines FROM events)"),
    "country_lookup": (
        "SELECT CAST(10 + n_nationkey AS VARCHAR) || '.' || CAST(b AS VARCHAR) AS prefix, "
        "n_name AS country_code FROM nation, (SELECT unnest(range(7)) AS b) bs"),
    "prefix_dictionary": (
        f"WITH {DICT_LINES}\n"
        "SELECT code AS country, ctry, ip_a, ip_b, CAST(slot AS INTEGER) AS slot FROM ("
        "SELECT *, row_number() OVER (PARTITION BY code ORDER BY line_order) - 1 AS slot FROM lines) WHERE slot < 100"),
    "prefix_dictionary_cut": (
        f"WITH {DICT_LINES}\n"
        "SELECT code AS country, count(*) AS lines, least(count(*), 100) AS kept, "
        "count(*) - least(count(*), 100) AS cut FROM lines GROUP BY code"),
    "viewed_products": _with('SELECT "user", country_code, date_time, product, response_code FROM good'),
    "views_per_user": _with(VIEWS_PER_USER),
    "views_per_country": _with(VIEWS_PER_COUNTRY),
    "views_per_hour": _with(
        "SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS views FROM good GROUP BY 1"),
    "views_per_product": _with("SELECT product, count(*) AS views FROM good GROUP BY product"),
    "top_products_100": _with(TOP_PRODUCTS.format(k=100)),
    "top_products_per_user": _with(
        'SELECT "user", product, count(*) AS views FROM good GROUP BY "user", product '
        'ORDER BY views DESC, "user" ASC NULLS LAST, product ASC NULLS LAST LIMIT 100'),
    "top10_products": _with(TOP_PRODUCTS.format(k=10)),
    "top10_by_name_desc": _with(
        "SELECT product, count(*) AS views FROM good GROUP BY product "
        "ORDER BY product DESC NULLS LAST, views DESC LIMIT 10"),
    "frequent_countries": _with(VIEWS_PER_COUNTRY + " HAVING count(*) > 10"),
    "content_size_stats": _with(
        "SELECT CAST(sum(content_size) AS BIGINT) AS total_size, count(*) AS n, "
        "min(content_size) AS min_size, max(content_size) AS max_size, "
        "avg(content_size) AS avg_exact, CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size "
        "FROM good"),
    "response_code_counts": _with(
        "SELECT response_code, count(*) AS total FROM good GROUP BY response_code"),
    "frequent_ips": _with(
        "SELECT ip_address, count(*) AS total FROM good GROUP BY ip_address HAVING count(*) > 10"),
    "top_endpoints": _with(
        "SELECT request_uri, count(*) AS total FROM good GROUP BY request_uri "
        "ORDER BY total DESC, request_uri ASC NULLS LAST LIMIT 10"),
    "log_volume_per_minute": _with(
        "SELECT strftime(date_time, '%Y-%m-%d %H:%M') AS minute, count(*) AS total "
        "FROM good GROUP BY 1"),
    "sql_views_per_user": _with(VIEWS_PER_USER),
    "sql_views_per_country": _with(VIEWS_PER_COUNTRY),
    "sql_views_per_hour": _with(
        "SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(product) AS views "
        "FROM good GROUP BY 1"),
    "sql_top_products_10": _with(TOP_PRODUCTS.format(k=10)),
    "sql_products_per_user": _with(
        'SELECT "user", product, count(*) AS views FROM good GROUP BY "user", product'),
    "sliding_window_counts": _with(
        "SELECT window_start, window_start + INTERVAL '30 seconds' AS window_end, "
        "count(*) AS views FROM win GROUP BY window_start", WINDOWS),
    "sliding_top_products": _with(
        "SELECT window_start, window_end, product, views, CAST(rank AS INTEGER) AS rank FROM ("
        "SELECT window_start, window_start + INTERVAL '30 seconds' AS window_end, product, "
        "count(*) AS views, row_number() OVER (PARTITION BY window_start "
        "ORDER BY count(*) DESC, product ASC NULLS LAST) AS rank "
        "FROM win GROUP BY window_start, product) r WHERE rank <= 10", WINDOWS),
    "all_counts": _with(_counts_sql(), "hourly AS (SELECT *, CAST(hour(date_time) AS INTEGER) AS hour FROM good)"),
    "sessions_per_ip": sessions_sql("ip_address"),
    "sessions_per_user": sessions_sql("user"),
    "reformat_date": (
        "SELECT strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS src, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted FROM events "
        "UNION ALL SELECT strftime(ts + INTERVAL 2 HOURS, '%d/%b/%Y:%H:%M:%S') || ' +0200', "
        "strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events WHERE event_id % 53 = 0 "
        "UNION ALL SELECT CASE (event_id // 97) % 4 WHEN 2 THEN '99/Zzz/2024:00:00:00 +0000' "
        "WHEN 3 THEN '01/Jan/2024:00:00:00 +0000' END, "
        "CASE (event_id // 97) % 4 WHEN 3 THEN '2024-01-01 00:00:00' END FROM events WHERE event_id % 97 = 0"),
    "product_from_uri": (
        "SELECT page_id, url, string_split(regexp_replace(url, '/+$', ''), '/')[4] AS product "
        "FROM pages"),
    "ip_prefix": _with(
        "SELECT ip_address, CASE WHEN ip_address LIKE '%.%' THEN split_part(ip_address, '.', 1) || '.' || "
        "split_part(ip_address, '.', 2) END AS prefix FROM good"),
    "format_log_line": f"SELECT e.event_id, {FORMAT_LINE} AS value FROM events e",
}
