"""Plan shape: the feature windows share one exchange on
(series, block); no window runs without a partition; scans are pruned."""

import re

from ledgerline.operators.features import series_features
from ledgerline.operators.splits import time_split
from ledgerline.sources import tables as T


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_windows_share_one_exchange(spark, sf_small):
    df = series_features(T.prices(spark, sf_small), lags=(1, 3, 7), windows=(7, 14, 30))
    plan = _plan(df)
    # stacked windows (the return, then its volatility) are two Window nodes
    # over one exchange: no second shuffle
    assert 1 <= len(re.findall(r"\bWindow \[", plan)) <= 2, plan
    assert len(re.findall(r"Exchange hashpartitioning\(asset#\d+, _block#\d+", plan)) == 1, plan
    assert "SinglePartition" not in plan


def test_global_split_has_no_single_partition_window(spark, sf_small):
    plan = _plan(time_split(T.prices(spark, sf_small)))
    for line in plan.splitlines():
        if "Window [" in line:
            assert "partitionBy" not in line or "[]" not in line.split("Window")[1][:5]
    assert "rangepartitioning" in plan.lower()


def test_scan_reads_only_needed_columns(spark, sf_small):
    df = series_features(T.prices(spark, sf_small), lags=(1,), windows=())
    text = df._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert m and "o_custkey" not in m.group(1) and "o_orderstatus" not in m.group(1)
    assert text


def test_broadcast_only_within_size_check(spark):
    """With Spark's own size-based broadcast off, only the checked hint can
    broadcast: within the limit it does, beyond it the join stays a shuffle join."""
    from ledgerline.functions.broadcast import broadcast_if_small
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    params = spark.range(0, 50).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        small_plan = _plan(big.join(broadcast_if_small(params, max_rows=100), "k"))
        over_plan = _plan(big.join(broadcast_if_small(params, max_rows=10), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in small_plan
    assert "BroadcastHashJoin" not in over_plan and "SortMergeJoin" in over_plan
