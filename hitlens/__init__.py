"""hitlens: access-log analytics on PySpark DataFrames, SQL and Structured Streaming.

The main entry points::

    from hitlens import parse_logs, valid, rejects, viewed_products, reports
    from hitlens import read_logs, read_country_lookup, read_log_stream
"""

from .functions import parse_logs, parse_summary, rejects, valid
from .operators import reports, viewed_products, windows
from .session import build_session, tune
from .sources import read_country_lookup, read_log_stream, read_logs

__version__ = "0.1.0"

__all__ = [
    "parse_logs", "parse_summary", "rejects", "valid", "reports", "viewed_products", "windows",
    "build_session", "tune", "read_country_lookup", "read_log_stream", "read_logs",
]
