"""M0: the minimum end-to-end slice on ``ticks``.

clean -> per-asset IQR and z-score flags (one parameter pass) -> combined
flags -> per-asset summary. The feature set is computed only where a
consumer uses it (the forest, the feature queries).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.exprs import r
from ledgerline.operators import anomaly as A
from ledgerline.operators.cleaning import clean_prices
from ledgerline.operators.features import anomaly_features
from ledgerline.sources import tables as T


def ticks_flags(spark: SparkSession, sf_dir: str, features: bool = False) -> DataFrame:
    data = clean_prices(T.ticks(spark, sf_dir), as_date=False)
    if features:
        data = anomaly_features(data)
    return A.combine_flags(A.detect_iqr_zscore(data))


def m0_ticks_asset_anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.asset_anomaly_summary(ticks_flags(spark, sf_dir))
    return s.select("asset", "total_records", "anomaly_count", "iqr_anomaly_count",
                    "zscore_anomaly_count", r("average_price").alias("average_price"),
                    r("min_price").alias("min_price"), r("max_price").alias("max_price"),
                    r("anomaly_rate_percent").alias("anomaly_rate_percent"))


CLEAN_TICKS = (
    "clean AS (SELECT date, asset, price, row_id FROM ticks "
    "WHERE date IS NOT NULL AND asset IS NOT NULL AND price IS NOT NULL "
    "AND NOT isnan(price) AND NOT isinf(price) AND price >= 0)")

FLAGS_SQL = (
    "par AS (SELECT asset, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3, "
    "avg(price) AS m, stddev_samp(price) AS s FROM clean GROUP BY asset), "
    "flags AS (SELECT c.*, coalesce(c.price < p.q1 - 1.5 * (p.q3 - p.q1) OR "
    "c.price > p.q3 + 1.5 * (p.q3 - p.q1), false) AS is_anomaly_iqr, "
    "abs(CASE WHEN p.s = 0 OR p.s IS NULL THEN 0 ELSE (c.price - p.m) / p.s END) > 3 AS is_anomaly_zscore "
    "FROM clean c JOIN par p USING (asset))")

ORACLE = {
    "m0_ticks_asset_anomaly_summary": T.sql_with("ticks") + ", " + CLEAN_TICKS + ", " + FLAGS_SQL + " "
    "SELECT asset, CAST(count(price) AS BIGINT) AS total_records, "
    "CAST(count_if(is_anomaly_iqr OR is_anomaly_zscore) AS BIGINT) AS anomaly_count, "
    "CAST(count_if(is_anomaly_iqr) AS BIGINT) AS iqr_anomaly_count, "
    "CAST(count_if(is_anomaly_zscore) AS BIGINT) AS zscore_anomaly_count, "
    "round(avg(price), 6) AS average_price, round(min(price), 6) AS min_price, "
    "round(max(price), 6) AS max_price, "
    "round(count_if(is_anomaly_iqr OR is_anomaly_zscore) * 100.0 / count(price), 6) AS anomaly_rate_percent "
    "FROM flags GROUP BY asset",
}

QUERIES = {
    "m0_ticks_asset_anomaly_summary": m0_ticks_asset_anomaly_summary,
}
