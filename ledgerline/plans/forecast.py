"""Queries for forecasting (F3-F10, F12), feature importance (M12), the
forecast summary (A18) and the history/forecast joins (J2, J3, J6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import forecast as FC
from ledgerline.operators import metrics as M
from ledgerline.operators.features import regular_calendar
from ledgerline.operators.autoregression import lag_products
from ledgerline.operators.profile import forecast_summary
from ledgerline.operators.seasonal import gram_sums
from ledgerline.plans.features import round_doubles
from ledgerline.plans.sqlkit import sql_with
from ledgerline.sources import tables as T


def _prices(spark, sf):
    return T.prices(spark, sf)


def f3_linear_regression_backtest(spark, sf):
    _, _, pred = FC.model_backtest(_prices(spark, sf), "linear")
    return round_doubles(pred.select("date", "asset", "row_id", F.col("price").alias("actual_price"),
                                     "predicted_price"))


def f4_random_forest_backtest(spark, sf):
    _, _, pred = FC.model_backtest(_prices(spark, sf), "forest")
    return round_doubles(pred.select("date", "asset", "row_id", F.col("price").alias("actual_price"),
                                     "predicted_price"))


def f5_gbt_backtest(spark, sf):
    _, _, pred = FC.model_backtest(_prices(spark, sf), "gbt")
    return round_doubles(pred.select("date", "asset", "row_id", F.col("price").alias("actual_price"),
                                     "predicted_price"))


def f6_recursive_forecast(spark, sf):
    return round_doubles(FC._forecast_one(_prices(spark, sf), "xgboost", FC.HORIZON))


def f7_ar_design(spark, sf):
    d = FC.ar_design(_prices(spark, sf))
    return round_doubles(d.select("asset", "date", F.col("y").alias("d0"),
                                  *[F.col("x")[i].alias(f"d{i}") for i in range(1, FC.AR_ORDER + 1)]))


def f7_arima_forecast(spark, sf):
    return round_doubles(FC._forecast_one(_prices(spark, sf), "arima", FC.HORIZON))


def f8_prophet_forecast(spark, sf):
    return round_doubles(FC._forecast_one(_prices(spark, sf), "prophet", FC.HORIZON))


def f9_lstm_forecast(spark, sf):
    return round_doubles(FC._forecast_one(_prices(spark, sf), "lstm", FC.HORIZON))


def f10_forecast_all(spark, sf):
    return round_doubles(FC.forecast(_prices(spark, sf), "all"))


def f7_lag_products(spark, sf):
    """What F7's exact likelihood reads of each series: lag products of the daily differences, as shares of that of lag 0."""
    sums = lag_products(_prices(spark, sf))
    return sums.select("asset", "n", *[F.round(F.col("products")[k] / F.col("products")[0], 6).alias(f"r{k}") for k in range(1, FC.AR_ORDER + 1)],
                       F.round(F.col("first")[0], 6).alias("first"), F.round(F.element_at("last", -1), 6).alias("last"))


def f8_gram_sums(spark, sf):
    """Some of F8's sums per series: each column's product with the scaled price, in order of the columns."""
    g = gram_sums(regular_calendar(_prices(spark, sf)))
    rows = g.select("asset", "days", F.posexplode("xty").alias("term", "xy"))
    return rows.select("asset", F.col("days").cast("long").alias("days"), "term", F.round("xy", 5).alias("xy"))


def f12_test_records(spark, sf):
    """Held-out days that each series' model predicts: all of them."""
    p = _prices(spark, sf)
    out = None
    for name in ("arima", "prophet", "lstm"):
        h = FC.held_out_predictions(p, name)
        one = h.groupBy("asset").agg(F.count_if(F.col("predicted_price").isNotNull()).alias("records"), F.min("date").alias("first_day"),
                                     F.max("date").alias("last_day")).withColumn("model_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def f12_model_comparison(spark, sf):
    p = _prices(spark, sf)
    per = None
    for name in FC.MODEL_NAMES:
        ev = FC.series_model_metrics(p, name)
        per = ev if per is None else per.unionByName(ev)
    return M.comparison_table(M.average_metrics(per), FC.MODEL_NAMES)


def m12_feature_importance(spark, sf):
    model, feats, _ = FC.model_backtest(_prices(spark, sf), "gbt")
    return round_doubles(FC.feature_importance(model, feats, spark, top_n=20))


def a18_forecast_summary(spark, sf):
    return forecast_summary(FC._forecast_one(_prices(spark, sf), "arima", FC.HORIZON))


def _regular_predictions(p):
    """F1 on the regular series: each day's prediction is the price of the day before."""
    from ledgerline.functions.sequence import bounded_window
    reg = regular_calendar(p).withColumnRenamed("day_index", "_pos")
    rows = bounded_window(reg, ["asset"], 1, lambda d, w: d.withColumn("predicted_price", F.lag("price", 1).over(w)), pos_col="_pos")
    return rows.filter("predicted_price IS NOT NULL").select("asset", "date", "predicted_price")


def a18_backtest_summary(spark, sf):
    return forecast_summary(_regular_predictions(_prices(spark, sf)).withColumn("model_name", F.lit("previous_price")))


def j2_actual_prediction_join(spark, sf):
    """Days with an actual price and a prediction (evaluation set)."""
    p = _prices(spark, sf)
    actual = p.groupBy("asset", "date").agg(F.avg("price").alias("actual_price"))
    return round_doubles(actual.join(_regular_predictions(p), ["asset", "date"], "inner"))


def j3_actual_left_join_prediction(spark, sf):
    """All days with an actual price, with their prediction where there is one (a series' first day has none)."""
    p = _prices(spark, sf)
    actual = p.groupBy("asset", "date").agg(F.avg("price").alias("actual_price"))
    return round_doubles(actual.join(_regular_predictions(p), ["asset", "date"], "left"))


def j6_history_and_predictions(spark, sf):
    """History and predictions of each series on one time axis."""
    p = _prices(spark, sf)
    hist = regular_calendar(p).select("asset", "date", "price", F.lit("history").alias("kind"))
    pred = _regular_predictions(p).select("asset", "date", F.col("predicted_price").alias("price"), F.lit("forecast").alias("kind"))
    return round_doubles(hist.unionByName(pred))


def j2_actual_calendar_join(spark, sf):
    p = _prices(spark, sf)
    actual = p.groupBy("asset", "date").agg(F.avg("price").alias("actual_price"))
    cal = regular_calendar(p).select("asset", "date", F.col("price").alias("filled_price"))
    return round_doubles(actual.join(cal, ["asset", "date"], "inner"))


def j3_calendar_left_join_actual(spark, sf):
    p = _prices(spark, sf)
    actual = p.groupBy("asset", "date").agg(F.avg("price").alias("actual_price"))
    cal = regular_calendar(p).select("asset", "date", F.col("price").alias("filled_price"))
    return round_doubles(cal.join(actual, ["asset", "date"], "left"))


def j6_history_and_forecast(spark, sf):
    p = _prices(spark, sf)
    hist = regular_calendar(p).select("asset", "date", "price", F.lit("history").alias("kind"))
    fc = FC._forecast_one(p, "arima", FC.HORIZON).select("asset", "date", F.col("forecasted_price").alias("price"),
                                                          F.lit("forecast").alias("kind"))
    return round_doubles(hist.unionByName(fc))


REG = (sql_with("prices") + ", daily AS (SELECT asset, date, avg(price) AS price FROM prices GROUP BY ALL), "
       "span AS (SELECT asset, min(date) AS d0, max(date) AS d1 FROM daily GROUP BY asset), "
       "grid AS (SELECT asset, d0, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM span), "
       "g AS (SELECT grid.asset, grid.date, daily.price, datediff('day', grid.d0, grid.date) + 1 AS day_index "
       "FROM grid LEFT JOIN daily USING (asset, date)), reg AS (SELECT asset, date, day_index, "
       "coalesce(last_value(price IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN UNBOUNDED "
       "PRECEDING AND CURRENT ROW), first_value(price IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date ROWS "
       "BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM g)")

_LAGS = ", ".join(f"lag(dd, {i}) OVER (PARTITION BY asset ORDER BY date) AS d{i}" for i in range(1, FC.AR_ORDER + 1))

def _design_sql() -> str:
    """The columns of F8's design as one list, day from 0."""
    hinges = ", ".join(f"greatest(t - hp[{j}], 0)" for j in range(1, 26))
    waves = ", ".join(f"sin(2 * pi() * {k} * day / {period}), cos(2 * pi() * {k} * day / {period})"
                      for period, order in (("365.25", 10), ("7.0", 3)) for k in range(1, order + 1))
    return f"[1.0, t, {hinges}, {waves}]"


ORACLE = {
    "f7_lag_products": REG + ", df AS (SELECT asset, date, price - lag(price) OVER (PARTITION BY asset ORDER BY date) AS dd FROM reg), "
                       f"lg AS (SELECT asset, date, dd, {_LAGS} FROM df) SELECT asset, CAST(count(dd) AS BIGINT) AS n, "
                       + ", ".join(f"round(sum(dd * d{k}) / sum(dd * dd), 6) AS r{k}" for k in range(1, 6))
                       + ", round(arg_min(dd, date), 6) AS first, round(arg_max(dd, date), 6) AS last FROM lg WHERE dd IS NOT NULL GROUP BY asset",
    # 25 changepoints: evenly from day 0 to the last day of the first 80 %, without day 0
    "f8_gram_sums": REG + ", sz AS (SELECT asset, max(day_index) AS days, max(abs(price)) AS scale FROM reg GROUP BY asset), "
                    "x AS (SELECT asset, days, price / scale AS y, (day_index - 1) * 1.0 AS day, (day_index - 1.0) / (days - 1) AS t, "
                    "list_transform(range(1, 26), lambda j: round_even(j * (floor(days * CAST(0.8 AS DOUBLE)) - 1) / 25, 0) / (days - 1)) AS hp "
                    "FROM reg JOIN sz USING (asset)), d AS (SELECT asset, days, y, " + _design_sql() + " AS c FROM x), "
                    "u AS (SELECT asset, days, y, unnest(c) AS v, unnest(range(len(c))) AS term FROM d) SELECT asset, CAST(days AS BIGINT) AS days, "
                    "CAST(term AS INTEGER) AS term, round(sum(v * y), 5) AS xy FROM u GROUP BY asset, days, term",
    "f12_test_records": REG + ", sz AS (SELECT asset, max(day_index) AS n FROM reg GROUP BY asset HAVING max(day_index) >= 10), "
                        "c AS (SELECT asset, n, floor(n * CAST(0.8 AS DOUBLE)) AS cut, 10 + floor((n - 10) * CAST(0.8 AS DOUBLE)) AS seq FROM sz), "
                        "t AS (SELECT 'arima' AS model_name, asset, date FROM reg JOIN c USING (asset) WHERE day_index > cut UNION ALL "
                        "SELECT 'prophet', asset, date FROM reg JOIN c USING (asset) WHERE day_index > cut UNION ALL "
                        "SELECT 'lstm', asset, date FROM reg JOIN c USING (asset) WHERE day_index > seq) SELECT asset, CAST(count(*) AS BIGINT) "
                        "AS records, min(date) AS first_day, max(date) AS last_day, model_name FROM t GROUP BY asset, model_name",
    "f7_ar_design": REG + ", df AS (SELECT asset, date, price - lag(price) OVER (PARTITION BY asset ORDER BY date) "
                    f"AS dd FROM reg), lg AS (SELECT asset, date, dd, {_LAGS} FROM df) SELECT asset, date, "
                    "round(dd, 6) AS d0, " + ", ".join(f"round(d{i}, 6) AS d{i}" for i in range(1, FC.AR_ORDER + 1))
                    + f" FROM lg WHERE d{FC.AR_ORDER} IS NOT NULL",
    "j2_actual_calendar_join": REG + " SELECT asset, date, round(daily.price, 6) AS actual_price, "
                               "round(reg.price, 6) AS filled_price FROM daily JOIN reg USING (asset, date)",
    "j3_calendar_left_join_actual": REG + " SELECT asset, date, round(reg.price, 6) AS filled_price, "
                                    "round(daily.price, 6) AS actual_price FROM reg LEFT JOIN daily USING (asset, date)",
}

_PRED = (", pr AS (SELECT asset, date, lag(price) OVER (PARTITION BY asset ORDER BY date) AS predicted_price FROM reg), "
         "pp AS (SELECT * FROM pr WHERE predicted_price IS NOT NULL)")
ORACLE |= {
    "a18_backtest_summary": REG + _PRED + " SELECT CAST(count(*) AS BIGINT) AS forecast_rows, CAST(1 AS BIGINT) AS model_count, CAST(count(DISTINCT asset) "
                            "AS BIGINT) AS asset_count, min(date) AS start_date, max(date) AS end_date, round(avg(predicted_price), 4) AS average_forecast, "
                            "round(min(predicted_price), 4) AS min_forecast, round(max(predicted_price), 4) AS max_forecast, ['previous_price'] AS "
                            "models_used, list_sort(list(DISTINCT asset)) AS assets_forecasted FROM pp",
    "j2_actual_prediction_join": REG + _PRED + " SELECT asset, date, round(daily.price, 6) AS actual_price, round(predicted_price, 6) AS predicted_price "
                                 "FROM daily JOIN pp USING (asset, date)",
    "j3_actual_left_join_prediction": REG + _PRED + " SELECT asset, date, round(daily.price, 6) AS actual_price, round(predicted_price, 6) AS "
                                      "predicted_price FROM daily LEFT JOIN pp USING (asset, date)",
    "j6_history_and_predictions": REG + _PRED + " SELECT asset, date, round(price, 6) AS price, 'history' AS kind FROM reg UNION ALL SELECT asset, date, "
                                  "round(predicted_price, 6), 'forecast' FROM pp",
}

QUERIES = {
    "a18_backtest_summary": a18_backtest_summary,
    "j2_actual_prediction_join": j2_actual_prediction_join,
    "j3_actual_left_join_prediction": j3_actual_left_join_prediction,
    "j6_history_and_predictions": j6_history_and_predictions,
    "j2_actual_calendar_join": j2_actual_calendar_join,
    "j3_calendar_left_join_actual": j3_calendar_left_join_actual,
    "f7_ar_design": f7_ar_design,
    "f7_arima_forecast": f7_arima_forecast,
    "f8_prophet_forecast": f8_prophet_forecast,
    "f9_lstm_forecast": f9_lstm_forecast,
    "a18_forecast_summary": a18_forecast_summary,
    "j6_history_and_forecast": j6_history_and_forecast,
    "f3_linear_regression_backtest": f3_linear_regression_backtest,
    "f5_gbt_backtest": f5_gbt_backtest,
    "m12_feature_importance": m12_feature_importance,
    "f6_recursive_forecast": f6_recursive_forecast,
    "f10_forecast_all": f10_forecast_all,
    "f7_lag_products": f7_lag_products,
    "f8_gram_sums": f8_gram_sums,
    "f12_test_records": f12_test_records,
    "f12_model_comparison": f12_model_comparison,
    "f4_random_forest_backtest": f4_random_forest_backtest,
}
