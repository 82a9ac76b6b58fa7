from . import refine, reports, windows
from .refine import bounded_broadcast, join_country, viewed_products
from .reports import (content_size_stats, count_by, frequent_countries, frequent_ips,
                      log_volume_per_minute, response_code_counts, top10_by_name_desc,
                      top10_products, top_endpoints, top_k, top_products, top_products_per_user,
                      views_per_country, views_per_hour, views_per_product, views_per_user)
from .windows import sliding_top_products, sliding_window_counts

__all__ = [
    "refine", "reports", "windows", "bounded_broadcast", "join_country",
    "viewed_products", "content_size_stats", "count_by", "frequent_countries", "frequent_ips",
    "log_volume_per_minute", "response_code_counts", "top10_by_name_desc", "top10_products",
    "top_endpoints", "top_k", "top_products", "top_products_per_user", "views_per_country",
    "views_per_hour", "views_per_product", "views_per_user", "sliding_top_products",
    "sliding_window_counts",
]
