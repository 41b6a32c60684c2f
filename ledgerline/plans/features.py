"""Queries for feature engineering (W*) and splits (S*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ledgerline.functions.exprs import r
from ledgerline.operators import cleaning as C
from ledgerline.operators import features as W
from ledgerline.operators import splits as S
from ledgerline.plans.sqlkit import (calendar_sql, median_fill_sql, return_sql, series_feature_sql,
                                     sql_with, w_clause)
from ledgerline.sources import tables as T

ASSETS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]  # levels of the prices view
WA = ("asset",)
ORD = ("date", "row_id")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T_.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def rsel(cols_double, cols_plain, src="") -> str:
    pre = f"{src}." if src else ""
    return ", ".join([f"{pre}{c}" for c in cols_plain] + [f"round({pre}{c}, 6) AS {c}" for c in cols_double])


def w1_daily_return(spark, sf):
    out = W.series_features(T.prices(spark, sf), WA, ORD, lags=(), windows=(), volatility=False)
    return round_doubles(out)


def w2_lags(spark, sf):
    return W.series_features(T.prices(spark, sf), WA, ORD, returns=False, lags=W.MODEL_LAGS, windows=())


def w3_w4_rolling_stats(spark, sf):
    out = W.series_features(T.prices(spark, sf), WA, ORD, returns=False, lags=(), windows=W.WINDOWS)
    return round_doubles(out)


def w5_return_volatility(spark, sf):
    out = W.series_features(T.ticks(spark, sf), WA, ORD, lags=(), windows=W.WINDOWS)
    return round_doubles(out.drop(*[f"price_rolling_{k}_{n}" for k in ("mean", "std") for n in W.WINDOWS]))


def w6_calendar(spark, sf):
    return W.calendar_features(T.prices(spark, sf), quarter_flags=True)


def _holdings_valued(spark, sf):
    return C.with_portfolio_value(C.add_default_columns(T.holdings(spark, sf)))


def w7_asset_features(spark, sf):
    out = W.asset_features(_holdings_valued(spark, sf))
    return round_doubles(out.select("date", "portfolio_id", "asset_name", "quantity", "price",
                                    "asset_weight", "price_quantity_interaction"))


def w8_portfolio_day_aggregates(spark, sf):
    out = W.portfolio_day_aggregates(C.add_default_columns(T.holdings(spark, sf)))
    return round_doubles(out.drop("asset_type"))


def w9_one_hot(spark, sf):
    return W.one_hot(T.prices(spark, sf), "asset", prefix="asset")


def w10_inverse_one_hot(spark, sf):
    oh = W.one_hot(T.prices(spark, sf), "asset", prefix="asset")
    return W.inverse_one_hot(oh, "asset", "asset_label").select("row_id", "asset", "asset_label")


def w11_align_features(spark, sf):
    feats = ["price", "price_lag_1", "asset_1-URGENT", "price_rolling_mean_7"]
    return W.align_features(W.one_hot(T.prices(spark, sf), "asset", prefix="asset"), feats, ["row_id"])


def w13_group_zscore(spark, sf):
    return round_doubles(W.group_zscore(T.prices(spark, sf)))


def w14_group_fences(spark, sf):
    return round_doubles(W.group_fences(T.prices(spark, sf)))


def w15_regular_calendar(spark, sf):
    return round_doubles(W.regular_calendar(T.prices(spark, sf)))


def w16_sliding_sequences(spark, sf):
    out = W.series_features(T.prices(spark, sf), WA, ORD, returns=False, lags=(), windows=(),
                            sequence_length=W.SEQUENCE_LENGTH)
    return out.filter(F.size("sequence") == W.SEQUENCE_LENGTH)


def w17_minmax_scale(spark, sf):
    return round_doubles(W.minmax_scale(T.prices(spark, sf)))


def w18_standard_scale(spark, sf):
    return round_doubles(W.standard_scale(T.prices(spark, sf), ["asset"], ["price"]))


def w20_first_rows(spark, sf):
    return W.first_last(T.prices(spark, sf))


def w20_last_rows(spark, sf):
    return W.first_last(T.prices(spark, sf), last=True)


def w21a_portfolio_features(spark, sf):
    return round_doubles(W.portfolio_features(C.portfolio_adapter(T.prices(spark, sf))))


def w21b_model_features(spark, sf):
    return round_doubles(W.model_features(T.prices(spark, sf)))


def w21c_anomaly_features(spark, sf):
    return round_doubles(W.anomaly_features(C.clean_prices(T.ticks(spark, sf), as_date=False)))


def s1_time_split(spark, sf):
    return S.time_split(T.prices(spark, sf))


def s2_train_validation_test(spark, sf):
    return S.time_split(T.prices(spark, sf), S.TEST_SIZE, S.VALIDATION_SIZE)


def s3_shuffled_split(spark, sf):
    return S.shuffled_split(T.prices(spark, sf))


def s5_series_split(spark, sf):
    return S.series_split(T.prices(spark, sf))


def s6_split_summary(spark, sf):
    return S.split_summary(S.time_split(T.prices(spark, sf), S.TEST_SIZE, S.VALIDATION_SIZE))


P = sql_with("prices")
TK = sql_with("ticks")
WP = w_clause(["asset"], ["date", "row_id"])
LAG_COLS = [f"price_lag_{k}" for k in W.MODEL_LAGS]
ROLL_COLS = [f"price_rolling_{s}_{n}" for n in W.WINDOWS for s in ("mean", "std")]
VOL_COLS = [f"return_rolling_volatility_{n}" for n in W.WINDOWS]
CAL = ["year", "month", "quarter", "day", "day_of_week", "week_of_year", "is_month_start", "is_month_end"]
ONEHOT = ", ".join(f"CAST(asset = '{a}' AS INTEGER) AS \"asset_{a}\"" for a in ASSETS)
ONEHOT_COLS = [f'"asset_{a}"' for a in ASSETS]


def _feature_oracle(view_sql, src, lags, vol, quarter, onehot, fill_cols):
    feat = series_feature_sql(src, ["asset"], ["date", "row_id"], "price", lags, W.WINDOWS, vol)
    extra = (", " + ONEHOT) if onehot else ""
    cal = calendar_sql("date", quarter)
    base = f"f AS (SELECT x.*, {cal}{extra} FROM ({feat}) x)"
    cols = (["date", "asset", "price", "row_id", "daily_return"] + [f"price_lag_{k}" for k in lags]
            + ROLL_COLS + (VOL_COLS if vol else []) + CAL
            + (["is_quarter_start", "is_quarter_end"] if quarter else []) + (ONEHOT_COLS if onehot else []))
    filled = median_fill_sql("f", fill_cols, cols)
    dbl = ["price", "daily_return"] + [f"price_lag_{k}" for k in lags] + ROLL_COLS + (VOL_COLS if vol else [])
    plain = [c for c in cols if c not in dbl]
    return f"{view_sql}, {base}, g AS ({filled}) SELECT {rsel(dbl, plain)} FROM g"


def _nullable(lags, vol):
    return ([f"price_lag_{k}" for k in lags] + [f"price_rolling_std_{n}" for n in W.WINDOWS]
            + (VOL_COLS if vol else []))


PORTFOLIO_SRC = ("pa AS (SELECT *, coalesce(asset, 'nan') AS asset_name, CAST(1 AS BIGINT) AS quantity, "
                 "price AS asset_value, 'PORTFOLIO_001' AS portfolio_id FROM prices), "
                 "pv AS (SELECT portfolio_id, date, coalesce(sum(asset_value), 0) AS portfolio_value FROM pa GROUP BY ALL), "
                 "pb AS (SELECT pa.*, 'stock' AS asset_type, pv.portfolio_value FROM pa LEFT JOIN pv USING (portfolio_id, date))")


def _portfolio_oracle():
    feat = series_feature_sql("pb", ["portfolio_id"], ["date", "asset_name", "row_id"], "price",
                              W.LAGS, W.WINDOWS, False)
    agg = ("ag AS (SELECT portfolio_id, date, sum(asset_value) AS total_asset_value, avg(asset_value) AS "
           "average_asset_value, max(asset_value) AS max_asset_value, min(asset_value) AS min_asset_value, "
           "CAST(count(asset_value) AS BIGINT) AS asset_count FROM pb GROUP BY ALL)")
    base = (f"f AS (SELECT x.*, {calendar_sql('date')}, coalesce(CASE WHEN isfinite(x.asset_value / "
            "nullif(x.portfolio_value, 0)) THEN x.asset_value / nullif(x.portfolio_value, 0) END, 0) AS asset_weight, "
            "x.price * x.quantity AS price_quantity_interaction, ag.total_asset_value, ag.average_asset_value, "
            f"ag.max_asset_value, ag.min_asset_value, ag.asset_count FROM ({feat}) x LEFT JOIN ag USING (portfolio_id, date))")
    lags = [f"price_lag_{k}" for k in W.LAGS]
    dbl = (["price", "asset_value", "portfolio_value", "daily_return"] + lags + ROLL_COLS +
           ["asset_weight", "price_quantity_interaction", "total_asset_value", "average_asset_value",
            "max_asset_value", "min_asset_value"])
    plain = ["date", "asset", "row_id", "asset_name", "quantity", "portfolio_id", "asset_type"] + CAL + ["asset_count"]
    fill = lags + [f"price_rolling_std_{n}" for n in W.WINDOWS]
    filled = median_fill_sql("f", fill, plain + dbl)
    return f"{P}, {PORTFOLIO_SRC}, {agg}, {base}, g AS ({filled}) SELECT {rsel(dbl, plain)} FROM g"


TICKS_CLEAN = ("tc AS (SELECT date, asset, price, row_id FROM ticks WHERE date IS NOT NULL "
               "AND asset IS NOT NULL AND price IS NOT NULL AND isfinite(price) AND price >= 0)")

SPLIT_RANK = ("rk AS (SELECT *, row_number() OVER (ORDER BY date, row_id) AS pos, count(*) OVER () AS n FROM prices)")

ORACLE = {
    "w1_daily_return": P + f" SELECT date, asset, round(price, 6) AS price, row_id, "
                           f"round({return_sql('price', WP)}, 6) AS daily_return FROM prices",
    "w2_lags": P + " SELECT *, " + ", ".join(f"lag(price, {k}) OVER {WP} AS price_lag_{k}" for k in W.MODEL_LAGS)
               + " FROM prices",
    "w3_w4_rolling_stats": P + " SELECT " + rsel(["price"] + ROLL_COLS, ["date", "asset", "row_id"]) + " FROM ("
                           + series_feature_sql("prices", ["asset"], ["date", "row_id"], "price", (), W.WINDOWS,
                                                False, returns=False) + ")",
    "w5_return_volatility": TK + " SELECT " + rsel(["price", "daily_return"] + VOL_COLS, ["date", "asset", "row_id"])
                            + " FROM (" + series_feature_sql("ticks", ["asset"], ["date", "row_id"], "price", (),
                                                             W.WINDOWS, True) + ")",
    "w6_calendar": P + f" SELECT *, {calendar_sql('date', True)} FROM prices",
    "w7_asset_features": sql_with("holdings") + ", a AS (SELECT *, price * quantity AS asset_value FROM holdings), "
                         "s AS (SELECT portfolio_id, date, coalesce(sum(asset_value), 0) AS portfolio_value FROM a GROUP BY ALL), "
                         "b AS (SELECT a.*, s.portfolio_value FROM a LEFT JOIN s USING (portfolio_id, date)) SELECT date, "
                         "portfolio_id, asset_name, round(quantity, 6) AS quantity, round(price, 6) AS price, round(coalesce("
                         "CASE WHEN isfinite(asset_value / nullif(portfolio_value, 0)) THEN asset_value / "
                         "nullif(portfolio_value, 0) END, 0), 6) AS asset_weight, round(price * quantity, 6) AS "
                         "price_quantity_interaction FROM b",
    "w8_portfolio_day_aggregates": sql_with("holdings") + ", a AS (SELECT *, price * quantity AS asset_value FROM holdings), "
                                   "ag AS (SELECT portfolio_id, date, sum(asset_value) AS total_asset_value, "
                                   "avg(asset_value) AS average_asset_value, max(asset_value) AS max_asset_value, "
                                   "min(asset_value) AS min_asset_value, CAST(count(asset_value) AS BIGINT) AS asset_count "
                                   "FROM a GROUP BY ALL) SELECT date, portfolio_id, asset_name, round(quantity, 6) AS quantity, "
                                   "round(price, 6) AS price, round(asset_value, 6) AS asset_value, "
                                   "round(total_asset_value, 6) AS total_asset_value, round(average_asset_value, 6) AS "
                                   "average_asset_value, round(max_asset_value, 6) AS max_asset_value, "
                                   "round(min_asset_value, 6) AS min_asset_value, asset_count FROM a LEFT JOIN ag "
                                   "USING (portfolio_id, date)",
    "w9_one_hot": P + f" SELECT *, {ONEHOT} FROM prices",
    "w10_inverse_one_hot": P + " SELECT row_id, asset, asset AS asset_label FROM prices",
    "w11_align_features": P + " SELECT row_id, price, 0 AS price_lag_1, CAST(asset = '1-URGENT' AS INTEGER) AS "
                              "\"asset_1-URGENT\", 0 AS price_rolling_mean_7 FROM prices",
    "w13_group_zscore": P + ", st AS (SELECT asset, avg(price) AS m, stddev_samp(price) AS s FROM prices GROUP BY asset) "
                            "SELECT date, asset, round(price, 6) AS price, row_id, round(CASE WHEN s = 0 OR s IS NULL "
                            "THEN 0 ELSE (price - m) / s END, 6) AS price_z_score FROM prices JOIN st USING (asset)",
    "w14_group_fences": P + ", q AS (SELECT asset, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 "
                            "FROM prices GROUP BY asset) SELECT asset, round(q1, 6) AS iqr_q1, round(q3, 6) AS iqr_q3, "
                            "round(q3 - q1, 6) AS iqr_value, round(q1 - 1.5 * (q3 - q1), 6) AS iqr_lower_bound, "
                            "round(q3 + 1.5 * (q3 - q1), 6) AS iqr_upper_bound FROM q",
    "w15_regular_calendar": P + ", daily AS (SELECT asset, date, avg(price) AS price FROM prices GROUP BY ALL), "
                                "span AS (SELECT asset, min(date) AS d0, max(date) AS d1 FROM daily GROUP BY asset), "
                                "grid AS (SELECT asset, d0, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) "
                                "AS date FROM span), g AS (SELECT grid.asset, grid.date, daily.price, "
                                "CAST(datediff('day', grid.d0, grid.date) + 1 AS BIGINT) AS day_index FROM grid LEFT JOIN "
                                "daily USING (asset, date)) SELECT asset, date, round(coalesce(last_value(price IGNORE NULLS) "
                                "OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
                                "first_value(price IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN "
                                "CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS price, day_index FROM g",
    "w16_sliding_sequences": P + " SELECT * FROM (SELECT *, list(price) OVER (PARTITION BY asset ORDER BY date, row_id "
                                 "ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS sequence FROM prices) WHERE len(sequence) = 10",
    "w17_minmax_scale": P + ", st AS (SELECT asset, min(price) AS lo, max(price) AS hi FROM prices GROUP BY asset) "
                            "SELECT date, asset, round(price, 6) AS price, row_id, round(CASE WHEN hi = lo THEN 0 ELSE "
                            "(price - lo) / (hi - lo) END, 6) AS scaled, round(lo, 6) AS scaled_min, round(hi, 6) AS "
                            "scaled_max FROM prices JOIN st USING (asset)",
    "w18_standard_scale": P + ", st AS (SELECT asset, avg(price) AS m, stddev_pop(price) AS s FROM prices GROUP BY asset) "
                              "SELECT date, asset, round((price - m) / CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END, 6) "
                              "AS price, row_id FROM prices JOIN st USING (asset)",
    "w20_first_rows": P + " SELECT asset, arg_min(date, (date, row_id)) AS date, arg_min(price, (date, row_id)) AS price, "
                          "arg_min(row_id, (date, row_id)) AS row_id FROM prices GROUP BY asset",
    "w20_last_rows": P + " SELECT asset, arg_max(date, (date, row_id)) AS date, arg_max(price, (date, row_id)) AS price, "
                         "arg_max(row_id, (date, row_id)) AS row_id FROM prices GROUP BY asset",
    "w21a_portfolio_features": _portfolio_oracle(),
    "w21b_model_features": _feature_oracle(P, "prices", W.MODEL_LAGS, True, True, True, _nullable(W.MODEL_LAGS, True)),
    "w21c_anomaly_features": _feature_oracle(TK + ", " + TICKS_CLEAN, "tc", W.LAGS, True, False, False,
                                             _nullable(W.LAGS, True)),
    "s1_time_split": P + ", " + SPLIT_RANK + " SELECT date, asset, price, row_id, CASE WHEN pos <= floor(n * "
                         "CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM rk",
    "s3_shuffled_split": P + ", rk AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', row_id, 42)), row_id) AS pos, count(*) OVER () AS n "
                         "FROM prices) SELECT date, asset, price, row_id, CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END "
                         "AS split FROM rk",
    "s2_train_validation_test": P + ", " + SPLIT_RANK + " SELECT date, asset, price, row_id, CASE WHEN pos <= floor(n * "
                                    f"CAST({1 - 0.1 - 0.2!r} AS DOUBLE)) THEN 'train' WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) "
                                    "THEN 'validation' ELSE 'test' END AS split FROM rk",
    "s5_series_split": P + ", rk AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY date, row_id) AS pos, "
                           "count(*) OVER (PARTITION BY asset) AS n FROM prices) SELECT date, asset, price, row_id, "
                           "CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split "
                           "FROM rk WHERE n >= 10",
    "s6_split_summary": P + ", " + SPLIT_RANK + ", sp AS (SELECT date, CASE WHEN pos <= floor(n * "
                            f"CAST({1 - 0.1 - 0.2!r} AS DOUBLE)) THEN 'train' WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) "
                            "THEN 'validation' ELSE 'test' END AS split FROM rk) SELECT split, CAST(count(*) AS BIGINT) "
                            "AS rows, min(date) AS start_date, max(date) AS end_date FROM sp GROUP BY split",
}

QUERIES = {
    "w1_daily_return": w1_daily_return,
    "w2_lags": w2_lags,
    "w3_w4_rolling_stats": w3_w4_rolling_stats,
    "w5_return_volatility": w5_return_volatility,
    "w6_calendar": w6_calendar,
    "w7_asset_features": w7_asset_features,
    "w8_portfolio_day_aggregates": w8_portfolio_day_aggregates,
    "w9_one_hot": w9_one_hot,
    "w10_inverse_one_hot": w10_inverse_one_hot,
    "w11_align_features": w11_align_features,
    "w13_group_zscore": w13_group_zscore,
    "w14_group_fences": w14_group_fences,
    "w15_regular_calendar": w15_regular_calendar,
    "w16_sliding_sequences": w16_sliding_sequences,
    "w17_minmax_scale": w17_minmax_scale,
    "w18_standard_scale": w18_standard_scale,
    "w20_first_rows": w20_first_rows,
    "w20_last_rows": w20_last_rows,
    "w21a_portfolio_features": w21a_portfolio_features,
    "w21b_model_features": w21b_model_features,
    "w21c_anomaly_features": w21c_anomaly_features,
    "s1_time_split": s1_time_split,
    "s2_train_validation_test": s2_train_validation_test,
    "s3_shuffled_split": s3_shuffled_split,
    "s5_series_split": s5_series_split,
    "s6_split_summary": s6_split_summary,
}
