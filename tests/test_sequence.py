"""Skew-safe windows equal plain windows (halo blocks, positions, fills)."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions.sequence import (POS, bounded_window, carry_backward, carry_forward,
                                           prefix_sums, with_positions)
from ledgerline.operators.features import series_features


def fx17(spark, n=200):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        asset = "hot" if i % 3 else ("cold" if i % 2 else "tiny")
        rows.append((f"2024-01-{1 + (i // 20):02d}", asset, float(rng.integers(1, 100)), i))
    return spark.createDataFrame(rows, "date string, asset string, price double, row_id long") \
                .withColumn("date", F.to_date("date"))


def test_positions_equal_row_number(spark):
    df = fx17(spark)
    got = with_positions(df, ["asset"], ["date", "row_id"], num_partitions=7)
    w = Window.partitionBy("asset").orderBy("date", "row_id")
    ref = df.withColumn("rn", F.row_number().over(w))
    j = got.join(ref, ["row_id"])
    assert j.filter(F.col(POS) != F.col("rn")).count() == 0
    assert got.count() == df.count()


def test_halo_blocks_equal_plain_windows(spark):
    df = fx17(spark)
    small = series_features(df, ["asset"], ["date", "row_id"], lags=(1, 3, 7), windows=(7, 14, 30),
                            block_rows=33)
    big = series_features(df, ["asset"], ["date", "row_id"], lags=(1, 3, 7), windows=(7, 14, 30),
                          block_rows=1 << 20)
    a = small.toPandas().sort_values("row_id").reset_index(drop=True)
    b = big.toPandas().sort_values("row_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a[sorted(a.columns)], b[sorted(b.columns)], check_exact=False, rtol=1e-9)
    # plain pandas reference for one asset
    hot = a[a.asset == "hot"].sort_values(["date", "row_id"])
    exp = hot.price.rolling(30, min_periods=1).std()
    np.testing.assert_allclose(hot.price_rolling_std_30.fillna(-1), exp.fillna(-1), rtol=1e-9)
    assert (hot.price_lag_7.isna().sum()) == 7


def test_carry_fills(spark):
    rows = [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("a", 4, None), ("a", 5, 7.0), ("a", 6, None),
            ("b", 1, None), ("b", 2, None)]
    df = spark.createDataFrame(rows, "k string, _pos long, v double")
    f = carry_forward(df, ["k"], ["v"], block_rows=2)
    got = {(r.k, r._pos): r.v for r in f.collect()}
    assert [got[("a", i)] for i in range(1, 7)] == [None, 5.0, 5.0, 5.0, 7.0, 7.0]
    fb = carry_backward(f, ["k"], ["v"], block_rows=2)
    got = {(r.k, r._pos): r.v for r in fb.collect()}
    assert got[("a", 1)] == 5.0 and got[("b", 1)] is None


def test_bounded_window_rejects_small_blocks(spark):
    df = fx17(spark).withColumn(POS, F.col("row_id") + 1)
    try:
        bounded_window(df, ["asset"], 10, lambda d, w: d, block_rows=5)
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_prefix_sums(spark):
    df = spark.createDataFrame([("f", float(v), 1, v % 2) for v in range(50)], "feature string, value double, a int, b int")
    out = prefix_sums(df, ["feature"], ["value"], ["a", "b"], num_partitions=6).orderBy("value").collect()
    assert [r.cum_a for r in out] == list(range(1, 51))
    assert out[-1].cum_b == 25
