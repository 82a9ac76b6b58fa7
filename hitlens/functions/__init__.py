from .parsing import (LOG_PATTERN, LOG_TIME_FORMAT, observed, parse_logs, parse_summary, rejects,
                      split_once, valid)
from .scalar import (format_ipv4, format_log_line, hour_of, int_div, ip_prefix, java_split,
                     minute_key, product_from_uri, reformat_date)

__all__ = [
    "LOG_PATTERN", "LOG_TIME_FORMAT", "observed", "parse_logs", "parse_summary", "rejects", "split_once", "valid",
    "format_ipv4", "format_log_line", "hour_of", "int_div", "ip_prefix", "java_split",
    "minute_key", "product_from_uri", "reformat_date",
]
