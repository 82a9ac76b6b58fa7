"""Reports on a hand-made frame, invariants on the fixture, and plan shapes."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, SF01

from hitlens import registry
from hitlens.operators import reports, windows
from hitlens.operators.refine import viewed_products
from hitlens.plans import sql_reports as sq


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _vp(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [
        ("u1", "AA", t, "p1", 200), ("u1", "AA", t, "p1", 200), ("u2", None, t, "p2", 404),
        ("u2", "BB", t.replace(hour=11), None, 200), ("u3", "BB", t.replace(hour=11), "p2", 500),
        ("u3", "BB", t.replace(hour=11, second=25), "p3", 200),
    ]
    return spark.createDataFrame(rows, "user string, country_code string, date_time timestamp, "
                                       "product string, response_code int")


def test_counts_and_rankings(spark):
    vp = _vp(spark)
    assert {r.user: r.views for r in reports.views_per_user(vp).collect()} == \
        {"u1": 2, "u2": 2, "u3": 2}
    assert {r.country_code: r.views for r in reports.views_per_country(vp).collect()} == \
        {"AA": 2, None: 1, "BB": 3}
    assert [(r.hour, r.views) for r in reports.views_per_hour(vp).collect()] == [(10, 3), (11, 3)]
    assert [(r.hour, r.views) for r in reports.views_per_hour(vp, True).collect()] == \
        [(10, 3), (11, 2)]
    top = [(r.product, r.views) for r in reports.top10_products(vp).collect()]
    assert top == [("p1", 2), ("p2", 2), ("p3", 1), (None, 1)]
    by_name = [r.product for r in reports.top10_by_name_desc(vp).collect()]
    assert by_name == ["p3", "p2", "p1", None]
    assert [r.country_code for r in reports.frequent_countries(vp, 2).collect()] == ["BB"]


def test_sliding_windows(spark):
    vp = _vp(spark)
    counts = {(r.window_start.hour, r.window_start.second, r.window_start.minute): r.views
              for r in windows.sliding_window_counts(vp).collect()}
    # rows at 11:00:00 (x2) fall in 3 windows; the one at 11:00:25 in 3 others, 1 shared
    assert counts[(11, 0, 0)] == 2 + 1 and counts[(10, 50, 59)] == 2
    top = windows.sliding_top_products(vp, k=1).where(
        F.col("window_start") == dt.datetime(2024, 1, 1, 10, 0, 0)).collect()
    assert [(r.product, r.views, r.rank) for r in top] == [("p1", 2, 1)]


def test_size_stats_integer_average(spark):
    logs = spark.createDataFrame([(1,), (2,), (4,)], "content_size long")
    r = reports.content_size_stats(logs).collect()[0]
    assert (r.total_size, r.n, r.min_size, r.max_size, r.avg_size) == (7, 3, 1, 4, 2)
    assert abs(r.avg_exact - 7 / 3) < 1e-12


def test_invariants_on_fixture(spark):
    parsed = registry.parsed(spark, SF01)
    s = registry.q_parse_summary(spark, SF01).collect()[0]
    odd, broken = -(-10000 // 53), -(-10000 // 97)
    assert (s.good_lines, s.rejected_lines) == (10000 + odd, broken)
    assert s.total_lines == 10000 + odd + broken
    vp = registry.viewed(spark, SF01)
    for report in (reports.views_per_user, reports.views_per_country, reports.views_per_product):
        assert report(vp).agg(F.sum("views")).collect()[0][0] == s.good_lines
    assert parsed.count() == s.total_lines


def test_join_is_broadcast_and_topk_is_bounded(spark):
    vp = registry.viewed(spark, SF001)
    by_country = _plan(reports.views_per_country(vp))
    assert "BroadcastHashJoin" in by_country
    top = _plan(reports.top10_products(vp))
    assert "TakeOrderedAndProject" in top
    # no country column is used and the lookup is unique per prefix:
    # Catalyst drops the outer join altogether
    assert "Join" not in top
    for plan in (by_country, top):
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "PushedFilters" in plan


def test_join_falls_back_above_bound(spark):
    logs = registry.access_logs(spark, SF001)
    lookup = registry.country_lookup(spark, SF001)
    from hitlens.operators.refine import join_country, with_refined_columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_country(with_refined_columns(logs), lookup, max_broadcast_rows=10)
        assert "BroadcastHashJoin" not in _plan(joined)
        assert joined.count() == logs.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sql_surface_uses_sql_function(spark):
    sq.register_views(spark, viewed=registry.viewed(spark, SF001),
                      logs=registry.access_logs(spark, SF001))
    df = spark.sql(sq.SQL_VIEWS_PER_HOUR)
    assert "BatchEvalPython" not in _plan(df)
    rows = sq.run(spark, sq.SQL_TOP_ENDPOINTS).collect()
    assert len(rows) == 10
    assert {r.hour for r in df.collect()} <= set(range(24))


def test_viewed_products_is_one_to_one(spark):
    from hitlens.sources import fixtures
    from hitlens.sources.lookup import lookup_from_lines
    logs = registry.access_logs(spark, SF01)
    lines = fixtures.lookup_lines(spark, SF01)
    # every lookup line twice: one row per prefix remains, hits are not duplicated
    doubled = lines.unionByName(lines.withColumn("line_order", F.col("line_order") + 10**6))
    lookup = lookup_from_lines(doubled)
    assert lookup.count() == 25 * 7
    assert viewed_products(logs, lookup).count() == logs.count()


def test_sliding_windows_count_per_pane_first(spark):
    vp = registry.viewed(spark, SF01)
    by_expand = vp.groupBy(F.window("date_time", "30 seconds", "10 seconds").alias("w"), "product").agg(
        F.count(F.lit(1)).alias("views")).select(F.col("w.start").alias("window_start"), "product", "views")
    got = windows.windowed_counts(vp, ("product",)).select("window_start", "product", "views")
    assert sorted(got.collect(), key=str) == sorted(by_expand.collect(), key=str)
    plan = _plan(got)
    # the rows are multiplied above the first aggregation, not below it
    assert plan.index("Generate explode(transform") < plan.index("partial_count")


def test_minute_key_and_date_plans(spark):
    minutes = _plan(reports.log_volume_per_minute(registry.access_logs(spark, SF001)))
    below = minutes[minutes.index("Exchange"):]
    assert "date_trunc(minute" in below and "yyyy-MM-dd HH:mm" not in below
    dates = _plan(registry.q_reformat_date(spark, SF001))
    assert dates.count("regexp_extract(") == 1 and "Exchange" not in dates
    sq.register_views(spark, viewed=registry.viewed(spark, SF001))
    order = _plan(spark.sql(sq.SQL_PRODUCTS_PER_USER))
    ranges = order[order.index("rangepartitioning("):].split("\n")[0]
    assert "user" in ranges and "product" in ranges     # equal counts spread over ranges


def test_sliding_top_k_limits_rows_before_shuffle(spark):
    plan = _plan(windows.sliding_top_products(registry.viewed(spark, SF001)))
    assert "WindowGroupLimit" in plan


def test_first_k_per_group_hot_group_is_exact(spark):
    from hitlens.operators.topk import first_k_per_group
    # group 0 holds a third of the rows, spread over 40 input partitions
    df = spark.range(0, 6000, numPartitions=40).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7 + 1).alias("g"),
        ((F.col("id") * 7919) % 6007).alias("o"))
    got = first_k_per_group(df, "g", "o", 25, buckets=4)
    plan = _plan(got)
    assert plan.count("WindowGroupLimit") >= 2 or "WindowGroupLimit" in plan
    rows = {}
    for r in got.collect():
        rows.setdefault(r.g, []).append((r._rank, r.o))
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append(r.o)
    for g, values in want.items():
        assert sorted(rows[g]) == list(enumerate(sorted(values)[:25], start=1))


def test_counts_combine_map_side(spark):
    plan = _plan(reports.views_per_user(registry.viewed(spark, SF001)))
    # partial aggregate below the exchange: a hot user costs one row per partition
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
