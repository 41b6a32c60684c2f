"""Features on FX5 (two ramps) and FX24 (calendar edges)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import features as W
from ledgerline.operators.splits import series_split, split_summary, time_split


def fx5(spark):
    rows = []
    for i in range(20):
        d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        rows.append((d, "Stock A", 100.0 + i * 20.0 / 19, i))
        rows.append((d, "Bond A", 90.0 + i * 5.0 / 19, 100 + i))
    return spark.createDataFrame(rows, "date date, asset string, price double, row_id long")


def test_returns_and_lags_restart_per_asset(spark):
    out = W.series_features(fx5(spark), lags=(1,), windows=(7,)).toPandas()
    for _, g in out.groupby("asset"):
        g = g.sort_values("date")
        assert g.daily_return.iloc[0] == 0.0
        assert g.price_lag_1.isna().sum() == 1
        assert (g.price_rolling_mean_7 <= g.price).all()


def test_anomaly_features_have_no_nulls(spark):
    out = W.anomaly_features(fx5(spark))
    assert out.count() == 40
    nulls = out.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in out.columns]).first()
    assert sum(nulls) == 0


def test_calendar_fx24(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 2, 29),),
                                (dt.date(2024, 3, 31),), (dt.date(2024, 4, 1),)], "date date")
    r = W.calendar_features(df, quarter_flags=True).collect()
    assert r[0].week_of_year == 52 and r[0].year == 2023 and r[0].day_of_week == 6
    assert r[1].week_of_year == 1 and r[1].day_of_week == 0 and r[1].is_quarter_start == 1
    assert r[2].is_month_end == 1
    assert r[3].is_quarter_end == 1 and r[4].is_quarter_start == 1


def test_regular_calendar_fills_gaps(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 1.0), (dt.date(2024, 1, 1), "a", 3.0),
                                (dt.date(2024, 1, 4), "a", 5.0)], "date date, asset string, price double")
    out = W.regular_calendar(df).orderBy("date").collect()
    assert [r.price for r in out] == [2.0, 2.0, 2.0, 5.0]


def test_time_split_disjoint_complete(spark):
    df = fx5(spark)
    sp = time_split(df, 0.2, 0.1)
    counts = {r.split: r.rows for r in split_summary(sp).collect()}
    assert counts == {"train": 28, "validation": 4, "test": 8}
    s5 = series_split(df).groupBy("asset", "split").count().collect()
    assert sorted((r.asset, r.split, r["count"]) for r in s5) == [
        ("Bond A", "test", 4), ("Bond A", "train", 16), ("Stock A", "test", 4), ("Stock A", "train", 16)]


def test_first_last_rows(spark):
    first = {r.asset: r.row_id for r in W.first_last(fx5(spark)).collect()}
    last = {r.asset: r.row_id for r in W.first_last(fx5(spark), last=True).collect()}
    assert first == {"Stock A": 0, "Bond A": 100} and last == {"Stock A": 19, "Bond A": 119}


def test_windows_of_few_series_spread_over_tasks(spark):
    """One long series is many blocks without being asked for, with the same values as in one; calendar and asset columns
    are not part of what is shuffled and kept for the medians."""
    from ledgerline.functions.sequence import bounded_window
    from ledgerline.operators.features import model_features

    df = spark.range(100_000).select(F.lit("a").alias("asset"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 50).cast("int")).alias("date"),
                                     (F.col("id") * 37 % 1009).cast("double").alias("price"), F.col("id").alias("row_id"))
    seen = []
    bounded_window(df.withColumn("_pos", F.col("row_id") + 1), ["asset"], 30, lambda d, w: seen.append(d.select("_block").distinct().count()) or d)
    assert seen[0] >= 4
    many, one = model_features(df), model_features(df, block_rows=1 << 20)
    assert many.columns == one.columns and many.columns[:6] == ["asset", "date", "price", "row_id", "year", "month"]
    assert many.exceptAll(one).count() == 0 and one.exceptAll(many).count() == 0
    kept = many._jdf.queryExecution().withCachedData().toString().split("InMemoryRelation [")[1].split("]")[0]
    assert "price_lag_14" in kept and "is_quarter_end" not in kept and "asset_a" not in kept
