"""Queries for profiles and summaries (A*) and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import cleaning as C
from ledgerline.operators import features as W
from ledgerline.operators import profile as A
from ledgerline.plans.cleaning import _dirty_typed
from ledgerline.plans.features import round_doubles
from ledgerline.plans.sqlkit import DIRTY_STD, DIRTY_TYPED, return_sql, sql_with, w_clause
from ledgerline.sources import files as IO
from ledgerline.sources import tables as T

P = sql_with("prices")
WP = w_clause(["asset"], ["date", "row_id"])
RET = f"(SELECT *, {return_sql('price', WP)} AS daily_return FROM prices)"
RET_T = f"(SELECT *, {return_sql('price', WP)} AS daily_return FROM ticks)"


def _returns(df):
    return W.series_features(df, ("asset",), ("date", "row_id"), lags=(), windows=(), volatility=False)


def a1_asset_profile(spark, sf):
    return round_doubles(A.asset_profile(T.prices(spark, sf)))


def a2_dataset_overview(spark, sf):
    return A.dataset_overview(T.prices(spark, sf))


def a3_input_summary(spark, sf):
    return A.input_summary(T.prices(spark, sf))


def a4_missing_summary(spark, sf):
    return round_doubles(A.missing_summary(_dirty_typed(spark, sf)))


def a5_duplicate_summary(spark, sf):
    return round_doubles(A.duplicate_summary(T.dirty_prices(spark, sf)))


def a6_data_quality_report(spark, sf):
    return A.data_quality_report(_dirty_typed(spark, sf))


def a7_describe(spark, sf):
    return round_doubles(A.describe(T.holdings(spark, sf), ["quantity", "price"]))


def a8_daily_market(spark, sf):
    return round_doubles(A.daily_market(T.prices(spark, sf)))


def a9_monthly_asset_series(spark, sf):
    return round_doubles(A.monthly_asset_series(T.prices(spark, sf)))


def a10_month_of_year(spark, sf):
    return round_doubles(A.month_of_year(T.prices(spark, sf)))


def a11_return_summary(spark, sf):
    return round_doubles(A.return_summary(_returns(T.prices(spark, sf))))


def a12_volatility_ranking(spark, sf):
    return round_doubles(A.volatility_ranking(_returns(T.ticks(spark, sf))))


def a13_price_ranking(spark, sf):
    return round_doubles(A.price_ranking(_returns(T.prices(spark, sf))))


CORR_COLS = ["price", "daily_return", "price_lag_1", "price_rolling_mean_7"]


def a14_correlation_matrix(spark, sf):
    f = W.series_features(T.prices(spark, sf), ("asset",), ("date", "row_id"), lags=(1,), windows=(7,),
                          volatility=False)
    return round_doubles(A.correlation_matrix(f, CORR_COLS))


def a15_price_histogram(spark, sf):
    return round_doubles(A.histogram(T.prices(spark, sf)))


def a15_asset_histogram(spark, sf):
    return round_doubles(A.histogram(T.prices(spark, sf), bins=40, keys=["asset"]))


def a16_five_number_summary(spark, sf):
    return round_doubles(A.five_number_summary(T.prices(spark, sf)))


def a17_records_per_asset(spark, sf):
    return A.records_per_asset(T.prices(spark, sf))


def a24_run_log_summary(spark, sf):
    return round_doubles(A.run_log_summary(T.run_log(spark, sf)))


def a25_dataset_status(spark, sf):
    return A.dataset_status(C.clean_prices(T.dirty_prices(spark, sf)))


def a26_modelling_readiness(spark, sf):
    return A.modelling_readiness(_returns(T.prices(spark, sf)))


def j1_left_join_day_aggregates(spark, sf):
    h = C.add_default_columns(T.holdings(spark, sf))
    return round_doubles(W.portfolio_day_aggregates(h).select(
        "date", "portfolio_id", "asset_name", "asset_value", "total_asset_value", "asset_count"))


def j5_union_by_name(spark, sf):
    """Per-portfolio frames (different column sets) unioned by name."""
    h = C.add_default_columns(T.holdings(spark, sf))
    parts = [h.filter(F.col("portfolio_id") == seg).select("date", "portfolio_id", "asset_value")
             for seg in ("AUTOMOBILE", "BUILDING")]
    parts.append(h.filter(~F.col("portfolio_id").isin("AUTOMOBILE", "BUILDING"))
                  .select("date", "portfolio_id", "asset_name", "asset_value"))
    return round_doubles(IO.ragged_union(parts, ["date", "portfolio_id"]))


H = sql_with("holdings")
D = sql_with("dirty_prices")
CORR_SRC = (f"(SELECT price, {return_sql('price', WP)} AS daily_return, lag(price, 1) OVER {WP} AS price_lag_1, "
            f"avg(price) OVER (PARTITION BY asset ORDER BY date, row_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) "
            "AS price_rolling_mean_7 FROM prices)")


def _corr_sql():
    cols = CORR_COLS
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in cols)
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM f")
            if a != b:
                parts.append(f"SELECT '{b}' AS x, '{a}' AS y, round(corr({a}, {b}), 6) AS r FROM f")
    return P + f", f AS (SELECT {filled} FROM {CORR_SRC}) " + " UNION ALL ".join(parts)


def _hist_sql(bins, keys):
    k = ", ".join(keys)
    kk = (k + ", ") if keys else ""
    join = f"JOIN rg USING ({k})" if keys else ", rg"
    grp = f"GROUP BY {k}" if keys else ""
    return (P + f", rg AS (SELECT {kk}min(price) AS lo, max(price) AS hi FROM prices {grp}), "
            f"b AS (SELECT {kk}lo, hi, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((price - lo) / ((hi - lo) / {bins})), "
            f"{bins - 1}) END AS INTEGER) AS bin FROM prices {join} WHERE price IS NOT NULL) "
            f"SELECT {kk}bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_start, "
            f"round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS bin_end, CAST(count(*) AS BIGINT) AS count "
            f"FROM b GROUP BY ALL")


ORACLE = {
    "a1_asset_profile": P + " SELECT asset, CAST(count(*) AS BIGINT) AS record_count, min(date) AS first_date, "
                            "max(date) AS last_date, CAST(count(DISTINCT date) AS BIGINT) AS unique_dates, "
                            "round(quantile_cont(price, 0.5), 6) AS median_price, round(avg(price), 6) AS average_price, "
                            "round(min(price), 6) AS min_price, round(max(price), 6) AS max_price, "
                            "round(stddev_samp(price), 6) AS std_price FROM prices GROUP BY asset",
    "a2_dataset_overview": P + " SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(DISTINCT asset) AS BIGINT) "
                               "AS unique_assets, CAST(count(DISTINCT date) AS BIGINT) AS unique_dates, min(date) AS "
                               "start_date, max(date) AS end_date, CAST(datediff('day', min(date), max(date)) AS INTEGER) "
                               "AS date_span_days FROM prices",
    "a3_input_summary": P + " SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT asset) AS BIGINT) AS "
                            "asset_count, CAST(count(DISTINCT date) AS BIGINT) AS date_count, round(avg(price), 4) AS "
                            "average_price, round(min(price), 4) AS min_price, round(max(price), 4) AS max_price, "
                            "list_sort(list(DISTINCT asset)) AS assets FROM prices",
    "a4_missing_summary": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + ", t AS (SELECT * FROM typed) "
                          "SELECT col AS column, CAST(missing AS BIGINT) AS missing_count, round(missing * 100.0 / n, 6) "
                          "AS missing_percent FROM (SELECT count(*) AS n, count_if(date IS NULL) AS m_date, "
                          "count_if(asset IS NULL) AS m_asset, count_if(price IS NULL) AS m_price, count_if(row_id IS NULL) "
                          "AS m_row_id FROM t) UNPIVOT (missing FOR col IN (m_date AS 'date', m_asset AS 'asset', "
                          "m_price AS 'price', m_row_id AS 'row_id'))",
    "a5_duplicate_summary": D + " SELECT CAST(n - d AS BIGINT) AS duplicate_rows, round((n - d) * 100.0 / n, 6) AS "
                            "duplicate_percent FROM (SELECT count(*) AS n FROM dirty_prices), "
                            "(SELECT count(*) AS d FROM (SELECT DISTINCT * FROM dirty_prices))",
    "a6_data_quality_report": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + ", q AS (SELECT quantile_cont(price, 0.25) AS q1, "
                              "quantile_cont(price, 0.75) AS q3 FROM typed) SELECT CAST(count(*) AS BIGINT) AS total_rows, "
                              "4 AS total_columns, CAST(count_if(date IS NULL) + count_if(asset IS NULL) + "
                              "count_if(price IS NULL) + count_if(row_id IS NULL) AS BIGINT) AS missing_cells, "
                              "CAST(count_if(price < 0) AS BIGINT) AS negative_prices, CAST(count(DISTINCT asset) AS BIGINT) "
                              "AS unique_assets, CAST(count(DISTINCT date) AS BIGINT) AS unique_dates, "
                              "CAST(count_if(price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS BIGINT) "
                              "AS iqr_outliers, (SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM "
                              "typed)) AS BIGINT) FROM typed) AS duplicate_rows FROM typed, q",
    "a7_describe": H + " SELECT feature, CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean, "
                       "round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, "
                       "round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, "
                       "round(quantile_cont(value, 0.75), 6) AS q75 FROM (SELECT 'quantity' AS feature, "
                       "CAST(quantity AS DOUBLE) AS value FROM holdings UNION ALL SELECT 'price', price FROM holdings) "
                       "WHERE value IS NOT NULL GROUP BY feature",
    "a8_daily_market": P + " SELECT date, round(avg(price), 6) AS average_price, round(min(price), 6) AS min_price, "
                           "round(max(price), 6) AS max_price, CAST(count(DISTINCT asset) AS BIGINT) AS asset_count "
                           "FROM prices GROUP BY date",
    "a9_monthly_asset_series": P + " SELECT strftime(date, '%Y-%m') AS year_month, asset, round(avg(price), 6) AS "
                                   "average_price, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price, "
                                   "CAST(count(price) AS BIGINT) AS record_count FROM prices GROUP BY ALL",
    "a10_month_of_year": P + " SELECT CAST(month(date) AS INTEGER) AS month, round(avg(price), 6) AS average_price "
                             "FROM prices GROUP BY ALL",
    "a11_return_summary": P + f" SELECT asset, round(avg(daily_return), 6) AS mean_return, round(min(daily_return), 6) "
                              "AS min_return, round(max(daily_return), 6) AS max_return, round(stddev_samp(daily_return), 6) "
                              "AS std_return, CAST(count_if(daily_return > 0) AS BIGINT) AS positive_days, "
                              f"CAST(count_if(daily_return < 0) AS BIGINT) AS negative_days FROM {RET} GROUP BY asset",
    "a12_volatility_ranking": sql_with("ticks") + f" SELECT asset, round(stddev_samp(daily_return), 6) AS volatility, "
                                                  "round(avg(daily_return), 6) AS mean_return, round(max(daily_return), 6) "
                                                  "AS max_return, round(min(daily_return), 6) AS min_return "
                                                  f"FROM {RET_T} GROUP BY asset",
    "a13_price_ranking": P + " SELECT asset, round(avg(price), 6) AS average_price, round(max(price), 6) AS max_price, "
                             "round(min(price), 6) AS min_price, round(stddev_samp(price), 6) AS std_price, "
                             f"round(stddev_samp(daily_return), 6) AS return_volatility FROM {RET} GROUP BY asset",
    "a14_correlation_matrix": _corr_sql(),
    "a15_price_histogram": _hist_sql(30, []),
    "a15_asset_histogram": _hist_sql(40, ["asset"]),
    "a16_five_number_summary": P + ", q AS (SELECT asset, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS "
                                   "median, quantile_cont(price, 0.75) AS q3, min(price) AS mn, max(price) AS mx FROM prices "
                                   "GROUP BY asset) SELECT asset, round(q1, 6) AS q1, round(median, 6) AS median, "
                                   "round(q3, 6) AS q3, round(mn, 6) AS min, round(mx, 6) AS max, "
                                   "round(min(price) FILTER (WHERE price >= q1 - 1.5 * (q3 - q1)), 6) AS lower_whisker, "
                                   "round(max(price) FILTER (WHERE price <= q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker "
                                   "FROM prices JOIN q USING (asset) GROUP BY asset, q1, median, q3, mn, mx",
    "a17_records_per_asset": P + " SELECT asset, CAST(count(*) AS BIGINT) AS record_count FROM prices GROUP BY asset",
    "a24_run_log_summary": sql_with("run_log") + " SELECT category, CAST(count(*) AS BIGINT) AS runs, "
                                                 "round(sum(seconds), 6) AS total_seconds, round(avg(seconds), 6) AS "
                                                 "average_seconds, CAST(count_if(status = 'success') AS BIGINT) AS "
                                                 "succeeded, CAST(count_if(status = 'failed') AS BIGINT) AS failed "
                                                 "FROM run_log GROUP BY category",
    "a25_dataset_status": D + ", " + DIRTY_STD + ", " + DIRTY_TYPED + ", c AS (SELECT date, asset, price "
                          "FROM typed WHERE date IS NOT NULL AND asset IS NOT NULL AND price IS NOT NULL AND price >= 0) "
                          "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT asset) AS BIGINT) AS asset_count, "
                          "min(date) AS start_date, max(date) AS end_date, round(avg(price), 4) AS average_price, "
                          "round(min(price), 4) AS min_price, round(max(price), 4) AS max_price, count(*) > 0 AS is_valid "
                          "FROM c",
    "a26_modelling_readiness": P + " SELECT true AS has_required_columns, true AS price_is_numeric, "
                                   "CAST(count_if(date IS NULL) + count_if(asset IS NULL) + count_if(price IS NULL) + "
                                   "count_if(row_id IS NULL) AS BIGINT) AS total_nulls, true AS has_returns, false AS "
                                   "has_lags, false AS has_rolling FROM prices",
    "j1_left_join_day_aggregates": H + ", a AS (SELECT *, price * quantity AS asset_value FROM holdings), ag AS "
                                       "(SELECT portfolio_id, date, sum(asset_value) AS total_asset_value, "
                                       "CAST(count(asset_value) AS BIGINT) AS asset_count FROM a GROUP BY ALL) SELECT date, "
                                       "portfolio_id, asset_name, round(asset_value, 6) AS asset_value, "
                                       "round(total_asset_value, 6) AS total_asset_value, asset_count FROM a LEFT JOIN ag "
                                       "USING (portfolio_id, date)",
    "j5_union_by_name": H + " SELECT date, portfolio_id, round(price * quantity, 6) AS asset_value, "
                            "CASE WHEN portfolio_id IN ('AUTOMOBILE', 'BUILDING') THEN NULL ELSE asset_name END AS "
                            "asset_name FROM holdings",
}

QUERIES = {
    "a1_asset_profile": a1_asset_profile,
    "a2_dataset_overview": a2_dataset_overview,
    "a3_input_summary": a3_input_summary,
    "a4_missing_summary": a4_missing_summary,
    "a5_duplicate_summary": a5_duplicate_summary,
    "a6_data_quality_report": a6_data_quality_report,
    "a7_describe": a7_describe,
    "a8_daily_market": a8_daily_market,
    "a9_monthly_asset_series": a9_monthly_asset_series,
    "a10_month_of_year": a10_month_of_year,
    "a11_return_summary": a11_return_summary,
    "a12_volatility_ranking": a12_volatility_ranking,
    "a13_price_ranking": a13_price_ranking,
    "a14_correlation_matrix": a14_correlation_matrix,
    "a15_price_histogram": a15_price_histogram,
    "a15_asset_histogram": a15_asset_histogram,
    "a16_five_number_summary": a16_five_number_summary,
    "a17_records_per_asset": a17_records_per_asset,
    "a24_run_log_summary": a24_run_log_summary,
    "a25_dataset_status": a25_dataset_status,
    "a26_modelling_readiness": a26_modelling_readiness,
    "j1_left_join_day_aggregates": j1_left_join_day_aggregates,
    "j5_union_by_name": j5_union_by_name,
}


