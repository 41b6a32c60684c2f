"""Queries for anomaly detection (D*) and its report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import anomaly as A
from ledgerline.operators.cleaning import clean_prices
from ledgerline.operators.features import anomaly_features
from ledgerline.operators.iforest import detect_isolation_forest
from ledgerline.operators.splits import time_split
from ledgerline.plans.features import ORACLE as FEATURE_ORACLE
from ledgerline.plans.features import round_doubles
from ledgerline.plans.flagship import CLEAN_TICKS, FLAGS_SQL, ticks_flags
from ledgerline.plans.sqlkit import sql_with
from ledgerline.sources import tables as T

TK = sql_with("ticks") + ", " + CLEAN_TICKS


def _clean_ticks(spark, sf):
    return clean_prices(T.ticks(spark, sf), as_date=False)


def d1_iqr_flags(spark, sf):
    out = A.detect_iqr(_clean_ticks(spark, sf))
    return round_doubles(out.select("date", "asset", "price", "row_id", "iqr_lower_bound", "iqr_upper_bound",
                                    "is_anomaly_iqr"))


def d2_global_iqr_outliers(spark, sf):
    return A.global_iqr_outliers(_clean_ticks(spark, sf))


def d3_zscore_flags(spark, sf):
    return round_doubles(A.detect_zscore(_clean_ticks(spark, sf)))


def d5_combined_flags(spark, sf):
    return ticks_flags(spark, sf).select("date", "asset", "price", "row_id", "is_anomaly_iqr",
                                         "is_anomaly_zscore", "is_anomaly_isolation_forest",
                                         "anomaly_method_count", "is_anomaly", "anomaly_method",
                                         "anomaly_severity")


def _forest_rows(spark, sf):
    feats = anomaly_features(_clean_ticks(spark, sf))
    return A.combine_flags(A.detect_iqr_zscore(detect_isolation_forest(feats)))


def d4_isolation_forest_summary(spark, sf):
    f = _forest_rows(spark, sf)
    return f.groupBy("asset").agg(F.count(F.lit(1)).alias("rows"),
                                  F.count_if("is_anomaly_isolation_forest").alias("forest_anomalies"),
                                  F.round(F.avg("anomaly_score"), 6).alias("average_anomaly_score"))


def d6_fit_detect(spark, sf):
    return round_doubles(A.fit_detect(T.ticks(spark, sf), as_date=False))


def d7_frozen_scoring(spark, sf):
    """Fences and moments fitted on the train part, applied to the test part."""
    sp = time_split(_clean_ticks(spark, sf))
    train, test = sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test").drop("split")
    from ledgerline.operators.features import series_parameters
    params = series_parameters(train, ["asset"], "price")
    state = {"fences": params.drop("_mean", "_std"),
             "moments": params.select("asset", "_mean", "_std")}
    out = A.score_new_data(test, state, mode="frozen", as_date=False)
    return round_doubles(out.select("date", "asset", "price", "row_id", "is_anomaly_iqr", "is_anomaly_zscore",
                                    "price_z_score", "anomaly_severity"))


def d7_refit_scoring(spark, sf):
    """Fences and moments worked out anew on the test part."""
    test = time_split(_clean_ticks(spark, sf)).filter(F.col("split") == "test").drop("split")
    out = A.score_new_data(test, {}, mode="refit", as_date=False)
    return round_doubles(out.select("date", "asset", "price", "row_id", "is_anomaly_iqr", "is_anomaly_zscore",
                                    "price_z_score", "anomaly_severity"))


def d7_saved_state_scoring(spark, sf):
    """State fitted on the train part, saved as a version of the model store, read back and applied to the test part."""
    import uuid

    from ledgerline.session import scratch_path
    from ledgerline.sources.model_store import ModelStore, load_detector, save_detector
    sp = time_split(_clean_ticks(spark, sf))
    train, test = sp.filter(F.col("split") == "train").drop("split"), sp.filter(F.col("split") == "test").drop("split")
    store = ModelStore(spark, scratch_path(spark, f"detector-{uuid.uuid4().hex}"))
    save_detector(store, A.fit_state(train, forest=False))
    out = A.score_new_data(test, load_detector(store), mode="frozen", as_date=False)
    return round_doubles(out.select("date", "asset", "price", "row_id", "is_anomaly_iqr", "is_anomaly_zscore",
                                    "price_z_score", "anomaly_severity"))


def d6_fit_detect_without_forest(spark, sf):
    """Clean, features, fences, z-scores and combined flags in one call; the forest's columns are in d6_fit_detect."""
    out = A.fit_detect(T.ticks(spark, sf), forest=False, as_date=False)
    return round_doubles(out.select("row_id", "asset", "price", "daily_return", "price_lag_7", "price_rolling_std_14", "return_rolling_volatility_30",
                                    "is_anomaly_iqr", "is_anomaly_zscore", "anomaly_method_count", "anomaly_method", "anomaly_severity"))


def d8_detection_report(spark, sf):
    """The report's tables of totals, methods and severities, one under the other."""
    report = A.detection_report(ticks_flags(spark, sf))
    total = report["summary"].select(F.lit("summary").alias("section"), F.lit("anomalies").alias("name"), F.col("total_anomalies").alias("records"))
    methods = report["methods"].select(F.lit("method").alias("section"), F.col("method").alias("name"), F.col("anomaly_count").alias("records"))
    levels = report["severity"].select(F.lit("severity").alias("section"), F.col("anomaly_severity").alias("name"), F.col("record_count").alias("records"))
    return total.unionByName(methods).unionByName(levels)


def d8_asset_summary_with_forest(spark, sf):
    return round_doubles(A.asset_anomaly_summary(_forest_rows(spark, sf)))


def a19_anomaly_summary(spark, sf):
    return A.anomaly_summary(ticks_flags(spark, sf))


def a20_method_summary(spark, sf):
    return A.method_summary(ticks_flags(spark, sf))


def a21_severity_distribution(spark, sf):
    return A.severity_distribution(ticks_flags(spark, sf))


def a23_top_anomalies(spark, sf):
    return A.top_anomalies(ticks_flags(spark, sf), 20)


COMB = (", comb AS (SELECT *, false AS is_anomaly_isolation_forest, CAST(is_anomaly_iqr AS INTEGER) + "
        "CAST(is_anomaly_zscore AS INTEGER) AS anomaly_method_count FROM flags), cf AS (SELECT *, "
        "anomaly_method_count > 0 AS is_anomaly, CASE WHEN anomaly_method_count > 0 THEN concat_ws(', ', "
        "CASE WHEN is_anomaly_iqr THEN 'IQR' END, CASE WHEN is_anomaly_zscore THEN 'Z-Score' END) ELSE 'None' END "
        "AS anomaly_method, ['normal', 'low', 'medium', 'high'][anomaly_method_count + 1] AS anomaly_severity FROM comb)")

ORACLE = {
    "d1_iqr_flags": TK + ", q AS (SELECT asset, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 "
                         "FROM clean GROUP BY asset) SELECT date, asset, round(price, 6) AS price, row_id, "
                         "round(q1 - 1.5 * (q3 - q1), 6) AS iqr_lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS "
                         "iqr_upper_bound, coalesce(price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1), "
                         "false) AS is_anomaly_iqr FROM clean JOIN q USING (asset)",
    "d2_global_iqr_outliers": TK + ", q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 "
                                   "FROM clean) SELECT clean.*, price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * "
                                   "(q3 - q1) AS is_outlier FROM clean, q",
    "d3_zscore_flags": TK + ", st AS (SELECT asset, avg(price) AS m, stddev_samp(price) AS s FROM clean GROUP BY asset), "
                            "z AS (SELECT clean.*, CASE WHEN s = 0 OR s IS NULL THEN 0 ELSE (price - m) / s END AS zz "
                            "FROM clean JOIN st USING (asset)) SELECT date, asset, round(price, 6) AS price, row_id, "
                            "round(zz, 6) AS price_z_score, abs(zz) > 3 AS is_anomaly_zscore FROM z",
    "d5_combined_flags": TK + ", " + FLAGS_SQL + COMB + " SELECT date, asset, price, row_id, is_anomaly_iqr, "
                              "is_anomaly_zscore, is_anomaly_isolation_forest, anomaly_method_count, is_anomaly, "
                              "anomaly_method, anomaly_severity FROM cf",
    "d7_frozen_scoring": TK + ", rk AS (SELECT *, row_number() OVER (ORDER BY date, row_id) AS pos, count(*) OVER () "
                              "AS n FROM clean), tr AS (SELECT * FROM rk WHERE pos <= floor(n * CAST(0.8 AS DOUBLE))), "
                              "te AS (SELECT * FROM rk WHERE pos > floor(n * CAST(0.8 AS DOUBLE))), par AS (SELECT asset, "
                              "quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3, avg(price) AS m, "
                              "stddev_samp(price) AS s FROM tr GROUP BY asset), f AS (SELECT te.*, coalesce(price < q1 - "
                              "1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1), false) AS is_anomaly_iqr, CASE WHEN s = 0 "
                              "OR s IS NULL THEN 0 ELSE (price - m) / s END AS zz FROM te LEFT JOIN par USING (asset)) "
                              "SELECT date, asset, round(price, 6) AS price, row_id, is_anomaly_iqr, abs(zz) > 3 AS "
                              "is_anomaly_zscore, round(zz, 6) AS price_z_score, ['normal', 'low', 'medium', 'high']"
                              "[CAST(is_anomaly_iqr AS INTEGER) + CAST(abs(zz) > 3 AS INTEGER) + 1] AS anomaly_severity "
                              "FROM f",
    "a19_anomaly_summary": TK + ", " + FLAGS_SQL + COMB + " SELECT CAST(count(*) AS BIGINT) AS total_records, "
                                "CAST(count_if(is_anomaly) AS BIGINT) AS total_anomalies, CAST(count_if(NOT is_anomaly) AS "
                                "BIGINT) AS normal_records, round(count_if(is_anomaly) * 100.0 / count(*), 4) AS "
                                "anomaly_rate_percent, CAST(count(DISTINCT asset) AS BIGINT) AS asset_count FROM cf",
    "a20_method_summary": TK + ", " + FLAGS_SQL + COMB + " SELECT 'IQR' AS method, CAST(count_if(is_anomaly_iqr) AS "
                               "BIGINT) AS anomaly_count FROM cf UNION ALL SELECT 'Z-Score', CAST(count_if(is_anomaly_zscore) "
                               "AS BIGINT) FROM cf UNION ALL SELECT 'Isolation Forest', CAST(count_if("
                               "is_anomaly_isolation_forest) AS BIGINT) FROM cf",
    "a21_severity_distribution": TK + ", " + FLAGS_SQL + COMB + " SELECT anomaly_severity, CAST(count(*) AS BIGINT) AS "
                                      "record_count FROM cf GROUP BY ALL",
    "a23_top_anomalies": TK + ", " + FLAGS_SQL + COMB + " SELECT date, asset, price, anomaly_method, anomaly_severity, "
                              "anomaly_method_count, row_id FROM cf WHERE is_anomaly ORDER BY anomaly_method_count DESC, "
                              "row_id LIMIT 20",
}

ORACLE["d7_saved_state_scoring"] = ORACLE["d7_frozen_scoring"]
ORACLE["d7_refit_scoring"] = ORACLE["d7_frozen_scoring"].replace("FROM tr GROUP BY asset", "FROM te GROUP BY asset")
ORACLE["d6_fit_detect_without_forest"] = (
    f"SELECT w.row_id, w.asset, w.price, daily_return, price_lag_7, price_rolling_std_14, return_rolling_volatility_30, is_anomaly_iqr, is_anomaly_zscore, "
    f"anomaly_method_count, anomaly_method, anomaly_severity FROM ({FEATURE_ORACLE['w21c_anomaly_features']}) w JOIN ({ORACLE['d5_combined_flags']}) f USING (row_id)")
ORACLE["d8_detection_report"] = (
    f"SELECT 'summary' AS section, 'anomalies' AS name, total_anomalies AS records FROM ({ORACLE['a19_anomaly_summary']}) UNION ALL "
    f"SELECT 'method', method, anomaly_count FROM ({ORACLE['a20_method_summary']}) UNION ALL "
    f"SELECT 'severity', anomaly_severity, record_count FROM ({ORACLE['a21_severity_distribution']})")

QUERIES = {
    "d1_iqr_flags": d1_iqr_flags,
    "d2_global_iqr_outliers": d2_global_iqr_outliers,
    "d3_zscore_flags": d3_zscore_flags,
    "d4_isolation_forest_summary": d4_isolation_forest_summary,
    "d5_combined_flags": d5_combined_flags,
    "d6_fit_detect": d6_fit_detect,
    "d7_frozen_scoring": d7_frozen_scoring,
    "d7_refit_scoring": d7_refit_scoring,
    "d7_saved_state_scoring": d7_saved_state_scoring,
    "d6_fit_detect_without_forest": d6_fit_detect_without_forest,
    "d8_detection_report": d8_detection_report,
    "d8_asset_summary_with_forest": d8_asset_summary_with_forest,
    "a19_anomaly_summary": a19_anomaly_summary,
    "a20_method_summary": a20_method_summary,
    "a21_severity_distribution": a21_severity_distribution,
    "a23_top_anomalies": a23_top_anomalies,
}


def io7_summary_sink(spark, sf):
    """The anomaly summary (one aggregated row) written as one JSON file and read back."""
    import uuid

    from ledgerline.session import scratch_path
    from ledgerline.sources import files as IO
    path = scratch_path(spark, f"summary-{uuid.uuid4().hex}")
    summary = A.anomaly_summary(ticks_flags(spark, sf))
    IO.write_summary(summary, path, "json")
    return spark.read.schema(summary.schema).json(path)


ORACLE["io7_summary_sink"] = ORACLE["a19_anomaly_summary"]
QUERIES["io7_summary_sink"] = io7_summary_sink
