"""The country join beyond the broadcast bound: same rows, no broadcast, busy prefixes spread."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from hitlens import registry
from hitlens.operators.refine import fits_broadcast, join_country, salted_join, with_refined_columns


@pytest.fixture(scope="module")
def logs(spark):
    """A third of the rows of one prefix, a third without any."""
    n = F.col("id")
    ip = F.when(n % 3 == 0, F.concat(F.lit("10.1.0."), (n % 250).cast("string"))).when(n % 3 == 1, "localhost").otherwise(
        F.format_string("%d.%d.0.1", n % 90, n % 7))
    return with_refined_columns(spark.range(30_000, numPartitions=4).select(
        ip.alias("ip_address"), F.lit("/a/b/c").alias("request_uri"), n.alias("n"), F.lit(1).alias("_share")))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(90 * 7).select(F.format_string("%d.%d", F.col("id") % 90, F.col("id") % 7).alias("prefix"),
                                      F.concat(F.lit("C"), F.col("id").cast("string")).alias("country_code")).dropDuplicates(["prefix"])


def test_rows_are_those_of_the_plain_join(spark, logs, lookup):
    got = salted_join(logs, lookup)
    expected = join_country(logs, lookup)
    assert got.columns == expected.columns and "_share" in got.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert salted_join(logs.limit(0), lookup).collect() == []
    assert salted_join(logs, lookup.limit(0)).where("country_code IS NOT NULL").count() == 0


def test_beyond_the_bound_nothing_is_broadcast_and_no_task_has_it_all(spark, logs, lookup):
    assert fits_broadcast(lookup, 65_536) and not fits_broadcast(lookup, 10) and not fits_broadcast(lookup, 65_536, 100)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "16")):
            spark.conf.set(k, v)
        joined = join_country(logs, lookup, max_broadcast_rows=10)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
        most = lambda df: (df.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.max("country_code").alias("used")).agg(F.max("n"), F.max("used")).first()[0])
        n = logs.count()
        assert most(joined) < n / 4
        assert most(logs.join(lookup, "prefix", "left")) > n / 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_reports_are_the_same_either_way(spark):
    parsed, lookup = with_refined_columns(registry.access_logs(spark, SF001)), registry.country_lookup(spark, SF001)
    count = lambda df: sorted(map(tuple, df.groupBy("country_code").count().collect()), key=repr)
    assert count(join_country(parsed, lookup, max_broadcast_rows=1)) == count(join_country(parsed, lookup))
