"""Queries for cleaning (C*) and sources/sinks (IO*)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.exprs import r
from ledgerline.operators import cleaning as C
from ledgerline.operators.anomaly import combine_flags, detect_iqr_zscore
from ledgerline.plans.flagship import CLEAN_TICKS, FLAGS_SQL
from ledgerline.plans.sqlkit import DIRTY_STD, DIRTY_TYPED, asset_type_sql, sql_with
from ledgerline.session import scratch_path
from ledgerline.sources import files as IO
from ledgerline.sources import tables as T

D = sql_with("dirty_prices")


def _dirty_typed(spark, sf):
    df = C.standardize_columns(T.dirty_prices(spark, sf))
    return C.coerce_numeric(C.coerce_dates(df, "date", drop_invalid=False))


def c1_standardize_columns(spark, sf):
    return C.standardize_columns(T.dirty_prices(spark, sf))


def c2_coerce_dates(spark, sf):
    return C.coerce_dates(C.standardize_columns(T.dirty_prices(spark, sf)), "date")


def c3_coerce_numeric(spark, sf):
    return C.coerce_numeric(C.standardize_columns(T.dirty_prices(spark, sf)))


def c6_drop_duplicate_rows(spark, sf):
    return C.drop_duplicate_rows(T.dirty_prices(spark, sf))


def c7_clean_prices(spark, sf):
    return C.clean_prices(T.dirty_prices(spark, sf))


def c8_asset_type(spark, sf):
    p = T.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("asset_name"))
    return C.with_asset_type(p)


def c9_portfolio_adapter(spark, sf):
    return C.portfolio_adapter(T.prices(spark, sf))


def c10_default_columns(spark, sf):
    return C.add_default_columns(T.holdings(spark, sf))


def c11_portfolio_value(spark, sf):
    return C.with_portfolio_value(C.add_default_columns(T.holdings(spark, sf)))


def c12_remove_invalid_rows(spark, sf):
    return C.remove_invalid_rows(_dirty_typed(spark, sf))


def c13_impute_numeric_median(spark, sf):
    return C.impute_numeric(_dirty_typed(spark, sf), "median", ["price"])


def c13_impute_numeric_mean(spark, sf):
    out = C.impute_numeric(_dirty_typed(spark, sf), "mean", ["price"])
    return out.withColumn("price", r("price"))


def c14_impute_categorical(spark, sf):
    return C.impute_categorical(_dirty_typed(spark, sf), "mode", ["asset"])


def c15_winsorize_iqr(spark, sf):
    return C.winsorize_iqr(T.prices(spark, sf), ["price"]).withColumn("price", r("price"))


def c17_clean_portfolio(spark, sf):
    return C.order_output(C.clean_portfolio(T.dirty_prices(spark, sf)))


def c18_anomalies_only(spark, sf):
    flags = combine_flags(detect_iqr_zscore(C.clean_prices(T.ticks(spark, sf), as_date=False)))
    return C.anomalies_only(flags).select("date", "asset", "price", "row_id", "anomaly_method",
                                          "anomaly_severity")


def c19_asset_subset(spark, sf):
    return C.asset_subset(T.prices(spark, sf), ["1-URGENT", "5-LOW"])


def _prediction_file(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return li.select(F.col("l_shipdate").cast("date").alias("ds"),
                     F.col("l_returnflag").alias("asset_encoded_reference"),
                     F.col("l_extendedprice").cast("string").alias("y"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("yhat"))


def c20_normalize_predictions(spark, sf):
    out = C.normalize_predictions(_prediction_file(spark, sf), "xgboost")
    return out.select("date", "asset", r("actual_price").alias("actual_price"),
                      r("predicted_price").alias("predicted_price"),
                      r("absolute_error").alias("absolute_error"))


def c22_record_rejects(spark, sf):
    raw = C.standardize_columns(T.dirty_prices(spark, sf))
    _, rejects = C.validate_records(raw)
    return rejects.select("row_id", "reject_reason")


def c22_valid_records(spark, sf):
    valid, _ = C.validate_records(C.standardize_columns(T.dirty_prices(spark, sf)))
    return valid.select("date", "asset", "price", "row_id")


def c23_asset_slug(spark, sf):
    p = T.table(spark, sf, "part").select("p_partkey", F.initcap(F.col("p_name")).alias("asset"))
    return C.with_asset_slug(p)


def io1_csv_scan(spark, sf):
    path = scratch_path(spark, f"io1-{uuid.uuid4().hex}")
    IO.save_table(T.dirty_prices(spark, sf), path, "csv")
    raw = IO.load_csv(spark, path, [" Date", "Asset", "Price ", "Row ID"])
    return C.clean_prices(raw)


def io2_named_dataset(spark, sf):
    cat = IO.DatasetCatalog(spark, {"raw": (f"{sf}/orders.parquet", "parquet")})
    raw = cat.load("raw")
    return raw.select(F.col("o_orderdate").cast("date").alias("date"),
                      F.col("o_orderpriority").alias("asset"), F.col("o_totalprice").alias("price"))


def io4_records_to_frame(spark, sf):
    p = T.prices(spark, sf)
    rec = p.select(F.to_json(F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"),
                                      "asset", "price")).alias("body"))
    return C.clean_prices(IO.records_to_frame(rec, "body"))


def io5_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, f"io5-{uuid.uuid4().hex}")
    IO.save_table(T.prices(spark, sf), path, "parquet", ["asset"])
    return spark.read.parquet(path).select("date", "asset", "price", "row_id")


def io6_json_records(spark, sf):
    return IO.to_json_records(T.ticks(spark, sf).withColumn("price", F.round("price", 2)))


def io8_ragged_union(spark, sf):
    a = T.prices(spark, sf).select("date", "asset", "price")
    b = T.holdings(spark, sf).select("date", "portfolio_id", "asset_name", "quantity",
                                     r("price").alias("price"))
    return IO.ragged_union([a, b], ["date", "asset", "price"])


AT = asset_type_sql
ORACLE = {
    "c1_standardize_columns": D + ", " + DIRTY_STD + " SELECT * FROM std",
    "c2_coerce_dates": D + ", " + DIRTY_STD + " SELECT TRY_CAST(trim(date) AS DATE) AS date, asset, price, row_id "
                       "FROM std WHERE TRY_CAST(trim(date) AS DATE) IS NOT NULL",
    "c3_coerce_numeric": D + ", " + DIRTY_STD + " SELECT date, asset, CASE WHEN isfinite(TRY_CAST(trim(price) AS DOUBLE)) "
                         "THEN TRY_CAST(trim(price) AS DOUBLE) END AS price, row_id FROM std",
    "c6_drop_duplicate_rows": D + " SELECT DISTINCT * FROM dirty_prices",
    "c7_clean_prices": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + " SELECT date, asset, price, row_id "
                       "FROM typed WHERE date IS NOT NULL AND asset IS NOT NULL AND price IS NOT NULL AND price >= 0",
    "c8_asset_type": f"SELECT p_partkey, p_name AS asset_name, {AT('p_name')} AS asset_type FROM part",
    "c9_portfolio_adapter": sql_with("prices") + ", a AS (SELECT *, coalesce(asset, 'nan') AS asset_name, "
                            "CAST(1 AS BIGINT) AS quantity, price AS asset_value, 'PORTFOLIO_001' AS portfolio_id "
                            "FROM prices), s AS (SELECT portfolio_id, date, coalesce(sum(asset_value), 0) AS portfolio_value "
                            f"FROM a GROUP BY ALL) SELECT a.*, {AT('a.asset_name')} AS asset_type, s.portfolio_value "
                            "FROM a LEFT JOIN s USING (portfolio_id, date)",
    "c10_default_columns": sql_with("holdings") + f" SELECT *, {AT('asset_name')} AS asset_type, "
                           "price * quantity AS asset_value FROM holdings",
    "c11_portfolio_value": sql_with("holdings") + ", a AS (SELECT *, "
                           f"{AT('asset_name')} AS asset_type, price * quantity AS asset_value FROM holdings), "
                           "s AS (SELECT portfolio_id, date, coalesce(sum(asset_value), 0) AS portfolio_value "
                           "FROM a GROUP BY ALL) SELECT a.*, s.portfolio_value FROM a LEFT JOIN s USING (portfolio_id, date)",
    "c12_remove_invalid_rows": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + " SELECT * FROM typed WHERE price >= 0",
    "c13_impute_numeric_median": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + " SELECT date, asset, "
                                 "coalesce(price, (SELECT quantile_cont(price, 0.5) FROM typed)) AS price, row_id FROM typed",
    "c13_impute_numeric_mean": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + " SELECT date, asset, "
                               "round(coalesce(price, (SELECT avg(price) FROM typed)), 6) AS price, row_id FROM typed",
    "c14_impute_categorical": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + ", m AS (SELECT asset FROM typed "
                              "WHERE asset IS NOT NULL GROUP BY asset ORDER BY count(*) DESC, asset LIMIT 1) "
                              "SELECT date, coalesce(typed.asset, (SELECT asset FROM m)) AS asset, price, row_id FROM typed",
    "c15_winsorize_iqr": sql_with("prices") + ", q AS (SELECT quantile_cont(price, 0.25) AS q1, "
                         "quantile_cont(price, 0.75) AS q3 FROM prices) SELECT date, asset, round(CASE WHEN q3 - q1 <> 0 "
                         "THEN least(greatest(price, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) ELSE price END, 6) "
                         "AS price, row_id FROM prices, q",
    "c17_clean_portfolio": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + ", d AS (SELECT * FROM typed WHERE date IS NOT NULL), "
                           "a AS (SELECT *, coalesce(asset, 'nan') AS asset_name, CAST(1 AS BIGINT) AS quantity, "
                           "price AS asset_value, 'PORTFOLIO_001' AS portfolio_id FROM d), "
                           "s AS (SELECT portfolio_id, date, coalesce(sum(asset_value), 0) AS portfolio_value FROM a GROUP BY ALL), "
                           f"b AS (SELECT a.*, {AT('a.asset_name')} AS asset_type, s.portfolio_value FROM a "
                           "LEFT JOIN s USING (portfolio_id, date)), u AS (SELECT DISTINCT * FROM b), "
                           "v AS (SELECT * FROM u WHERE price >= 0 AND quantity >= 0 AND asset_value >= 0 "
                           "AND portfolio_value >= 0), m AS (SELECT asset FROM v WHERE asset IS NOT NULL GROUP BY asset "
                           "ORDER BY count(*) DESC, asset LIMIT 1) SELECT date, coalesce(v.asset, (SELECT asset FROM m)) "
                           "AS asset, price, row_id, asset_name, quantity, asset_value, portfolio_id, asset_type, "
                           "portfolio_value FROM v",
    "c18_anomalies_only": sql_with("ticks") + ", " + CLEAN_TICKS + ", " + FLAGS_SQL + " SELECT date, asset, price, "
                          "row_id, concat_ws(', ', CASE WHEN is_anomaly_iqr THEN 'IQR' END, CASE WHEN is_anomaly_zscore "
                          "THEN 'Z-Score' END) AS anomaly_method, CASE WHEN is_anomaly_iqr AND is_anomaly_zscore "
                          "THEN 'medium' ELSE 'low' END AS anomaly_severity FROM flags "
                          "WHERE is_anomaly_iqr OR is_anomaly_zscore",
    "c19_asset_subset": sql_with("prices") + " SELECT * FROM prices WHERE asset IN ('1-URGENT', '5-LOW')",
    "c20_normalize_predictions": "SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS asset, "
                                 "round(l_extendedprice, 6) AS actual_price, "
                                 "round(l_extendedprice * (1 - l_discount), 6) AS predicted_price, "
                                 "round(abs(l_extendedprice - l_extendedprice * (1 - l_discount)), 6) AS absolute_error "
                                 "FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_discount IS NOT NULL",
    "c22_record_rejects": D + ", " + DIRTY_STD + ", t AS (SELECT row_id, trim(asset) AS a, trim(date) AS d, "
                          "CASE WHEN isfinite(TRY_CAST(trim(price) AS DOUBLE)) THEN TRY_CAST(trim(price) AS DOUBLE) END AS p "
                          "FROM std), x AS (SELECT row_id, concat_ws('; ', CASE WHEN a IS NULL OR a = '' THEN "
                          "'asset must not be empty' END, CASE WHEN d IS NULL OR d = '' THEN 'date must not be empty' END, "
                          "CASE WHEN p IS NULL THEN 'price must be a number' END, CASE WHEN p < 0 THEN "
                          "'price must be >= 0' END) AS reject_reason FROM t) SELECT * FROM x WHERE reject_reason <> ''",
    "c22_valid_records": D + ", " + DIRTY_STD + ", t AS (SELECT date, trim(asset) AS asset, "
                         "CASE WHEN isfinite(TRY_CAST(trim(price) AS DOUBLE)) THEN TRY_CAST(trim(price) AS DOUBLE) END AS price, "
                         "row_id FROM std) SELECT * FROM t WHERE asset IS NOT NULL AND asset <> '' AND date IS NOT NULL "
                         "AND trim(date) <> '' AND price IS NOT NULL AND price >= 0",
    "c23_asset_slug": "SELECT p_partkey, asset, regexp_replace(lower(trim(asset)), '[ /\\\\-]', '_', 'g') AS asset_slug "
                      "FROM (SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), "
                      "lambda x: upper(x[1]) || lower(x[2:])), ' ') AS asset FROM part)",
    "io1_csv_scan": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + " SELECT date, asset, price, row_id "
                    "FROM typed WHERE date IS NOT NULL AND asset IS NOT NULL AND price IS NOT NULL AND price >= 0",
    "io2_named_dataset": "SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS asset, o_totalprice AS price "
                         "FROM orders",
    "io4_records_to_frame": sql_with("prices") + " SELECT date, asset, price FROM prices WHERE price >= 0",
    "io5_parquet_roundtrip": sql_with("prices") + " SELECT * FROM prices",
    "io6_json_records": sql_with("ticks") + " SELECT CAST(json_object('date', strftime(date, '%Y-%m-%dT%H:%M:%S'), "
                        "'asset', asset, 'price', round(price, 2), 'row_id', row_id) AS VARCHAR) AS record FROM ticks",
    "io8_ragged_union": sql_with("prices", "holdings") + " SELECT date, asset, price, NULL::VARCHAR AS portfolio_id, "
                        "NULL::VARCHAR AS asset_name, NULL::DOUBLE AS quantity FROM prices UNION ALL "
                        "SELECT date, NULL, round(price, 6), portfolio_id, asset_name, quantity FROM holdings",
}

QUERIES = {
    "c1_standardize_columns": c1_standardize_columns,
    "c2_coerce_dates": c2_coerce_dates,
    "c3_coerce_numeric": c3_coerce_numeric,
    "c6_drop_duplicate_rows": c6_drop_duplicate_rows,
    "c7_clean_prices": c7_clean_prices,
    "c8_asset_type": c8_asset_type,
    "c9_portfolio_adapter": c9_portfolio_adapter,
    "c10_default_columns": c10_default_columns,
    "c11_portfolio_value": c11_portfolio_value,
    "c12_remove_invalid_rows": c12_remove_invalid_rows,
    "c13_impute_numeric_median": c13_impute_numeric_median,
    "c13_impute_numeric_mean": c13_impute_numeric_mean,
    "c14_impute_categorical": c14_impute_categorical,
    "c15_winsorize_iqr": c15_winsorize_iqr,
    "c17_clean_portfolio": c17_clean_portfolio,
    "c18_anomalies_only": c18_anomalies_only,
    "c18_anomalies_only": c18_anomalies_only,
    "c19_asset_subset": c19_asset_subset,
    "c20_normalize_predictions": c20_normalize_predictions,
    "c22_record_rejects": c22_record_rejects,
    "c22_valid_records": c22_valid_records,
    "c23_asset_slug": c23_asset_slug,
    "io1_csv_scan": io1_csv_scan,
    "io2_named_dataset": io2_named_dataset,
    "io4_records_to_frame": io4_records_to_frame,
    "io5_parquet_roundtrip": io5_parquet_roundtrip,
    "io6_json_records": io6_json_records,
    "io8_ragged_union": io8_ragged_union,
}
