from .logs import (kafka_options, read_log_stream, read_logs, write_lines, write_lines_kafka)
from .lookup import (CLASS_B_PATTERN, MAX_CLASS_B_PREFIXES, lookup_from_lines, lookup_rejects,
                     prefix_dictionary, read_country_lookup, read_lines_in_order)

__all__ = [
    "kafka_options", "read_log_stream", "read_logs", "write_lines",
    "write_lines_kafka", "CLASS_B_PATTERN",
    "MAX_CLASS_B_PREFIXES", "lookup_from_lines", "lookup_rejects", "prefix_dictionary",
    "read_country_lookup", "read_lines_in_order",
]
