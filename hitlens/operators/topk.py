"""First ``k`` rows per group, exact, with bounded work per task.

``row_number() <= k`` over ``partitionBy(group)`` already gets a partial
window-group limit before its shuffle: every input partition sends at most
``k`` rows per group.  For a group that appears in every one of ``M`` input
splits the final task still receives ``k * M`` rows, which grows with the
input.  Two levels cap it: first per (group, input-split bucket) - rows of
one split always share a bucket, so the partial limit still applies per
split - then per group over at most ``k * buckets`` survivors.  Rows per
task: about ``k * M / buckets`` at level one, ``k * buckets`` at level two.
The result is exactly the first ``k`` of each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256


def first_k_per_group(df: DataFrame, group_cols, order_cols, k: int,
                      rank_col: str = "_rank", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Rows ranked ``1..k`` within each group by ``order_cols`` (ties broken
    by the order columns only, so give a unique order for a unique answer)."""
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > limit:   # beyond it no partial limit runs and a whole group meets in one task
        raise ValueError(f"k = {k} is over spark.sql.optimizer.windowGroupLimitThreshold = {limit}")
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    orders = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    level1 = Window.partitionBy(*group_cols, "_bucket").orderBy(*orders)
    level2 = Window.partitionBy(*group_cols).orderBy(*orders)
    bucketed = df.withColumn("_bucket", F.spark_partition_id() % buckets)
    survivors = (bucketed.withColumn("_r1", F.row_number().over(level1))
                 .where(F.col("_r1") <= k).drop("_r1", "_bucket"))
    return survivors.withColumn(rank_col, F.row_number().over(level2)).where(F.col(rank_col) <= k)
