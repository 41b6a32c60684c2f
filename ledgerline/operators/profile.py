"""Profiles, summaries and rankings.

Every summary is a grouped aggregate with map-side combine; exact medians
and quartiles go through :mod:`ledgerline.functions.quantiles`. Sorting is
left to the sink (result tables are small).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.functions.exprs import is_numeric_type, numeric_columns, to_number
from ledgerline.functions.quantiles import column_quantiles, group_quantiles

HIST_BINS = 30


# A1
def asset_profile(df: DataFrame, asset: str = "asset", value: str = "price", date: str = "date") -> DataFrame:
    q = group_quantiles(df, [asset], value, [0.5], ["median_price"], extra={
        "average_price": F.avg("_v"), "min_price": F.min("_v"), "max_price": F.max("_v"),
        "std_price": F.stddev_samp("_v")})
    dates = df.groupBy(asset).agg(F.count(F.lit(1)).alias("record_count"),
                                  F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                                  F.count_distinct(date).alias("unique_dates"))
    return dates.join(q.drop("_n"), asset, "left")


# A2
def dataset_overview(df: DataFrame, asset: str = "asset", date: str = "date") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(asset).alias("unique_assets"),
                  F.count_distinct(date).alias("unique_dates"), F.min(date).alias("start_date"),
                  F.max(date).alias("end_date"),
                  F.datediff(F.max(date), F.min(date)).alias("date_span_days"))


# A3
def input_summary(df: DataFrame, asset: str = "asset", value: str = "price", date: str = "date") -> DataFrame:
    """Asset list: distinct names only (bounded by the number of assets)."""
    names = df.select(asset).distinct().agg(F.sort_array(F.collect_list(asset)).alias("assets"))
    stats = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(asset).alias("asset_count"),
                   F.count_distinct(date).alias("date_count"),
                   F.round(F.avg(value), 4).alias("average_price"), F.round(F.min(value), 4).alias("min_price"),
                   F.round(F.max(value), 4).alias("max_price"))
    return stats.crossJoin(names)


# A4
def missing_summary(df: DataFrame) -> DataFrame:
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    long = counts.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
        for i, c in enumerate(cols)])).alias("_c")).select("_rows", "_c.*")
    return long.withColumn("missing_percent",
                           F.coalesce(F.try_divide(F.col("missing_count") * 100.0, F.col("_rows")), F.lit(0.0))) \
               .drop("_rows")


# A5
def duplicate_summary(df: DataFrame) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    distinct = df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows"))
    j = total.crossJoin(distinct)
    return j.select((F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
                    F.coalesce(F.try_divide((F.col("total_rows") - F.col("distinct_rows")) * 100.0,
                                            F.col("total_rows")), F.lit(0.0)).alias("duplicate_percent"))


# A6
def data_quality_report(df: DataFrame, asset: str = "asset", value: str = "price", date: str = "date",
                        multiplier: float = 1.5) -> DataFrame:
    """One row: size, missing cells, negatives, duplicates, distinct assets
    and dates, and global IQR outliers of ``value``."""
    price = to_number(F.col(value), is_numeric_type(df, value))  # text prices are coerced, not cast
    df_num = df.withColumn("_price", price)
    q = group_quantiles(df_num, [], "_price", [0.25, 0.75], ["_q1", "_q3"])
    fences = q.select((F.col("_q1") - multiplier * (F.col("_q3") - F.col("_q1"))).alias("_lo"),
                      (F.col("_q3") + multiplier * (F.col("_q3") - F.col("_q1"))).alias("_hi"))
    j = df_num.crossJoin(F.broadcast(fences))  # one row
    missing = sum(F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns)
    p = F.col("_price")
    main = j.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(len(df.columns)).alias("total_columns"),
                 missing.alias("missing_cells"), F.count_if(p < 0).alias("negative_prices"),
                 F.count_distinct(asset).alias("unique_assets"), F.count_distinct(date).alias("unique_dates"),
                 F.count_if((p < F.col("_lo")) | (p > F.col("_hi"))).alias("iqr_outliers"))
    return main.crossJoin(duplicate_summary(df).select("duplicate_rows"))


# A7
def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact count/mean/std/min/quartiles/max per numeric column (long form)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], extra={
        "mean": F.avg("_v"), "std": F.stddev_samp("_v"), "min": F.min("_v"), "max": F.max("_v")})
    return q.withColumnRenamed("_n", "count")


# A8
def daily_market(df: DataFrame, value: str = "price", date: str = "date", asset: str = "asset") -> DataFrame:
    return df.groupBy(date).agg(F.avg(value).alias("average_price"), F.min(value).alias("min_price"),
                                F.max(value).alias("max_price"), F.count_distinct(asset).alias("asset_count"))


# A9
def monthly_asset_series(df: DataFrame, value: str = "price", date: str = "date", asset: str = "asset") -> DataFrame:
    return df.groupBy(F.date_format(date, "yyyy-MM").alias("year_month"), asset).agg(
        F.avg(value).alias("average_price"), F.min(value).alias("min_price"),
        F.max(value).alias("max_price"), F.count(value).alias("record_count"))


# A10
def month_of_year(df: DataFrame, value: str = "price", date: str = "date") -> DataFrame:
    return df.groupBy(F.month(date).alias("month")).agg(F.avg(value).alias("average_price"))


# A11
def return_summary(df: DataFrame, asset: str = "asset", ret: str = "daily_return") -> DataFrame:
    return df.groupBy(asset).agg(F.avg(ret).alias("mean_return"), F.min(ret).alias("min_return"),
                                 F.max(ret).alias("max_return"), F.stddev_samp(ret).alias("std_return"),
                                 F.count_if(F.col(ret) > 0).alias("positive_days"),
                                 F.count_if(F.col(ret) < 0).alias("negative_days"))


# A12
def volatility_ranking(df: DataFrame, asset: str = "asset", ret: str = "daily_return") -> DataFrame:
    return df.groupBy(asset).agg(F.stddev_samp(ret).alias("volatility"), F.avg(ret).alias("mean_return"),
                                 F.max(ret).alias("max_return"), F.min(ret).alias("min_return"))


# A13
def price_ranking(df: DataFrame, asset: str = "asset", value: str = "price", ret: str = "daily_return") -> DataFrame:
    return df.groupBy(asset).agg(F.avg(value).alias("average_price"), F.max(value).alias("max_price"),
                                 F.min(value).alias("min_price"), F.stddev_samp(value).alias("std_price"),
                                 F.stddev_samp(ret).alias("return_volatility"))


# A14
def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, in one aggregation (nulls 0)."""
    cols = list(columns)
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = filled.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    recs = []
    for i, (a, b) in enumerate(pairs):
        recs.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r")))
        if a != b:
            recs.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"c{i}").alias("r")))
    return agg.select(F.explode(F.array(*recs)).alias("_p")).select("_p.*")


# A15
def histogram(df: DataFrame, value: str = "price", bins: int = HIST_BINS,
              keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max] (per group when ``keys``); the last
    bin is closed. Output: bin index, edges, count."""
    keys = list(keys)
    rng = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    rng = broadcast_if_small(rng) if keys else F.broadcast(rng)
    j = df.join(rng, keys, "inner") if keys else df.crossJoin(rng)
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counts = j.filter(F.col(value).isNotNull()).groupBy(*keys, b.alias("bin"), "_lo", "_hi") \
              .agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return counts.select(*keys, "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                         (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"), "count")


# A16
def five_number_summary(df: DataFrame, asset: str = "asset", value: str = "price",
                        multiplier: float = 1.5) -> DataFrame:
    """min, q1, median, q3, max and the box-plot whiskers (most extreme
    values inside the 1.5 IQR fences) per asset."""
    q = group_quantiles(df, [asset], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"],
                        extra={"min": F.min("_v"), "max": F.max("_v")})
    q = broadcast_if_small(q.drop("_n"))
    j = df.join(q, asset, "inner")
    lo = F.col("q1") - multiplier * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))
    wh = j.groupBy(asset).agg(F.min(F.when(F.col(value) >= lo, F.col(value))).alias("lower_whisker"),
                              F.max(F.when(F.col(value) <= hi, F.col(value))).alias("upper_whisker"))
    return q.join(wh, asset, "inner")


# A17
def records_per_asset(df: DataFrame, asset: str = "asset") -> DataFrame:
    return df.groupBy(asset).agg(F.count(F.lit(1)).alias("record_count"))


# A18
def forecast_summary(df: DataFrame, value: str | None = None) -> DataFrame:
    """Rows, models and assets used (sorted distinct lists - bounded by the
    number of models/assets), date range and forecast stats rounded to 4;
    the value column is ``forecasted_price`` or else ``predicted_price``;
    an empty input gives zeros and empty lists."""
    value = value or ("forecasted_price" if "forecasted_price" in df.columns else "predicted_price")
    models = df.select("model_name").distinct().agg(F.sort_array(F.collect_list("model_name")).alias("models_used"))
    assets = df.select("asset").distinct().agg(F.sort_array(F.collect_list("asset")).alias("assets_forecasted"))
    stats = df.agg(F.count(F.lit(1)).alias("forecast_rows"),
                   F.count_distinct("model_name").alias("model_count"),
                   F.count_distinct("asset").alias("asset_count"),
                   F.min("date").alias("start_date"), F.max("date").alias("end_date"),
                   F.round(F.coalesce(F.avg(value), F.lit(0.0)), 4).alias("average_forecast"),
                   F.round(F.coalesce(F.min(value), F.lit(0.0)), 4).alias("min_forecast"),
                   F.round(F.coalesce(F.max(value), F.lit(0.0)), 4).alias("max_forecast"))
    return stats.crossJoin(models).crossJoin(assets)


# A24
def run_log_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("seconds").alias("total_seconds"),
        F.avg("seconds").alias("average_seconds"), F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"))


# A25
def dataset_status(cleaned: DataFrame, asset: str = "asset", value: str = "price", date: str = "date") -> DataFrame:
    s = cleaned.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(asset).alias("asset_count"),
                    F.min(date).alias("start_date"), F.max(date).alias("end_date"),
                    F.round(F.avg(value), 4).alias("average_price"), F.round(F.min(value), 4).alias("min_price"),
                    F.round(F.max(value), 4).alias("max_price"))
    return s.withColumn("is_valid", F.col("rows") > 0)


# A26
def modelling_readiness(df: DataFrame, value: str = "price") -> DataFrame:
    cols = set(df.columns)
    numeric = value in numeric_columns(df)
    nulls = sum(F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns)
    return df.agg(nulls.alias("total_nulls")).select(
        F.lit({"date", "asset", value} <= cols).alias("has_required_columns"),
        F.lit(numeric).alias("price_is_numeric"), "total_nulls",
        F.lit("daily_return" in cols).alias("has_returns"),
        F.lit(any("_lag_" in c for c in cols)).alias("has_lags"),
        F.lit(any("_rolling_" in c for c in cols)).alias("has_rolling"))
