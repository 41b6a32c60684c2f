"""Queries for forecast metrics and comparison (M*) over the baseline
backtest (F1, F2, F3 one-feature form, F11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import forecast as FC
from ledgerline.operators import metrics as M
from ledgerline.plans.features import round_doubles
from ledgerline.plans.sqlkit import sql_with
from ledgerline.sources import tables as T

PRED_COLS = [f"{m}_prediction" for m in FC.PREDICTION_MODELS]


def _comparable(df):
    """MSE is a squared price (~1e10 here), where a double has no 6th decimal
    left: both engines round it to 2 for the comparison, after all other steps."""
    return df.withColumn("mse", F.round("mse", 2))


def _backtest(spark, sf):
    return FC.baseline_backtest(T.prices(spark, sf))


def f1_f3_baseline_backtest(spark, sf):
    return round_doubles(_backtest(spark, sf))


def f11_backtest_best_model(spark, sf):
    return round_doubles(FC.with_best_prediction(_backtest(spark, sf)))


def m1_m5_metric_set(spark, sf):
    return _comparable(M.metric_set(_backtest(spark, sf), pred="previous_price_prediction"))


def m6_evaluate_by_asset(spark, sf):
    return _comparable(M.evaluate(_backtest(spark, sf), pred="lag_regression_prediction"))


def m7_evaluate_prediction_columns(spark, sf):
    return _comparable(M.evaluate_columns(_backtest(spark, sf), PRED_COLS))


def _averaged(spark, sf):
    return M.average_metrics(M.evaluate_columns(_backtest(spark, sf), PRED_COLS))


def m8_average_metrics(spark, sf):
    return _comparable(_averaged(spark, sf))


def m9_comparison_table(spark, sf):
    return _comparable(M.comparison_table(_averaged(spark, sf)))


def m9_missing_model(spark, sf):
    """A model without metrics is listed as missing, unranked, after the others; each names its metrics file."""
    names = [c.removesuffix("_prediction") for c in PRED_COLS]
    return _comparable(M.comparison_table(_averaged(spark, sf), [*names, "lstm"], metrics_files={m: f"{m}_metrics.json" for m in [*names, "lstm"]}))


def m10_best_model(spark, sf):
    return _comparable(M.best_model(M.comparison_table(_averaged(spark, sf))))


def m11_combined_evaluation(spark, sf):
    ev = M.evaluate_columns(_backtest(spark, sf), PRED_COLS)
    return _comparable(M.combined_evaluation(ev.filter(F.col("asset") == M.ALL)))


BT = (sql_with("prices") + ", f AS (SELECT *, lag(price, 1) OVER (PARTITION BY asset ORDER BY date, row_id) AS l1, "
      "avg(price) OVER (PARTITION BY asset ORDER BY date, row_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rm7 "
      "FROM prices), g AS (SELECT *, coalesce(l1, (SELECT quantile_cont(l1, 0.5) FROM f), 0) AS lag1 FROM f), "
      "rk AS (SELECT *, row_number() OVER (ORDER BY date, row_id) AS pos, count(*) OVER () AS n FROM g), "
      "tr AS (SELECT regr_slope(price, lag1) AS b, regr_intercept(price, lag1) AS a FROM rk "
      "WHERE pos <= floor(n * CAST(0.8 AS DOUBLE))), "
      "bt AS (SELECT date, asset, row_id, price AS actual_price, greatest(lag1, 0) AS previous_price_prediction, "
      "greatest(rm7, 0) AS rolling_mean_7_prediction, greatest(tr.a + tr.b * lag1, 0) AS lag_regression_prediction "
      "FROM rk, tr WHERE pos > floor(n * CAST(0.8 AS DOUBLE))), "
      "lg AS (SELECT asset, actual_price, replace(model_name, '_prediction', '') AS model_name, predicted_price "
      "FROM bt UNPIVOT (predicted_price FOR model_name IN (previous_price_prediction, rolling_mean_7_prediction, "
      "lag_regression_prediction)))")


def msql(y: str, p: str) -> str:
    e = f"({y} - {p})"
    d = f"((abs({y}) + abs({p})) / 2)"
    r2 = (f"CASE WHEN count({y}) < 2 THEN NULL WHEN var_pop({y}) * count({y}) = 0 THEN CASE WHEN sum({e} * {e}) = 0 "
          f"THEN 1.0 ELSE 0.0 END ELSE 1 - sum({e} * {e}) / (var_pop({y}) * count({y})) END")
    return (f"round(avg(abs({e})), 6) AS mae, round(avg({e} * {e}), 6) AS mse, round(sqrt(avg({e} * {e})), 6) AS rmse, "
            f"round(coalesce(avg(CASE WHEN {y} <> 0 THEN abs({e} / {y}) END) * 100, 0), 6) AS mape, "
            f"round(coalesce(avg(CASE WHEN {d} <> 0 THEN abs({e}) / {d} END) * 100, 0), 6) AS smape, "
            f"round({r2}, 6) AS r2_score, CAST(count(*) AS BIGINT) AS records")


EV = (", ev AS (SELECT model_name, '__all__' AS asset, " + msql("actual_price", "predicted_price") + " FROM lg "
      "GROUP BY model_name UNION ALL SELECT model_name, asset, " + msql("actual_price", "predicted_price") +
      " FROM lg GROUP BY model_name, asset)")
AV = (", av AS (SELECT model_name, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in M.METRICS) +
      ", CAST(count(DISTINCT asset) AS BIGINT) AS trained_asset_count, "
      "array_to_string(list_sort(list(DISTINCT asset)), ', ') AS trained_assets FROM ev WHERE asset <> '__all__' "
      "GROUP BY model_name)")
CMP = (", cmp AS (SELECT *, CASE WHEN rmse IS NOT NULL THEN 'available' ELSE 'missing' END AS status, "
       "CAST(row_number() OVER (ORDER BY rmse, model_name) AS DOUBLE) AS rank FROM av)")

ORACLE = {
    "f1_f3_baseline_backtest": BT + " SELECT date, asset, row_id, round(actual_price, 6) AS actual_price, "
                               "round(previous_price_prediction, 6) AS previous_price_prediction, "
                               "round(rolling_mean_7_prediction, 6) AS rolling_mean_7_prediction, "
                               "round(lag_regression_prediction, 6) AS lag_regression_prediction FROM bt",
    "f11_backtest_best_model": BT + ", e AS (SELECT *, abs(actual_price - previous_price_prediction) AS e0, "
                               "abs(actual_price - rolling_mean_7_prediction) AS e1, abs(actual_price - "
                               "lag_regression_prediction) AS e2 FROM bt) SELECT date, asset, row_id, "
                               "round(actual_price, 6) AS actual_price, round(previous_price_prediction, 6) AS "
                               "previous_price_prediction, round(rolling_mean_7_prediction, 6) AS rolling_mean_7_prediction, "
                               "round(lag_regression_prediction, 6) AS lag_regression_prediction, "
                               "round(least(e0, e1, e2), 6) AS absolute_error, CASE WHEN e0 <= e1 AND e0 <= e2 THEN "
                               "'previous_price' WHEN e1 <= e2 THEN 'rolling_mean_7' ELSE 'lag_regression' END AS "
                               "best_model FROM e",
    "m1_m5_metric_set": BT + " SELECT * REPLACE (round(mse, 2) AS mse) FROM (SELECT "
                        + msql("actual_price", "previous_price_prediction") + " FROM bt)",
    "m6_evaluate_by_asset": BT + " SELECT * REPLACE (round(mse, 2) AS mse) FROM (SELECT '__all__' AS asset, "
                            + msql("actual_price", "lag_regression_prediction")
                            + " FROM bt UNION ALL SELECT asset, " + msql("actual_price", "lag_regression_prediction")
                            + " FROM bt GROUP BY asset)",
    "m7_evaluate_prediction_columns": BT + EV + " SELECT * REPLACE (round(mse, 2) AS mse) FROM ev",
    "m8_average_metrics": BT + EV + AV + " SELECT * REPLACE (round(mse, 2) AS mse) FROM av",
    "m9_missing_model": BT + EV + AV + CMP + ", al AS (SELECT * FROM cmp UNION ALL BY NAME SELECT 'lstm' AS model_name, CAST(0 AS BIGINT) AS "
                        "trained_asset_count, '' AS trained_assets, 'missing' AS status) SELECT * REPLACE (round(mse, 2) AS mse), "
                        "model_name || '_metrics.json' AS metrics_file FROM al",
    "m9_comparison_table": BT + EV + AV + CMP + " SELECT * REPLACE (round(mse, 2) AS mse) FROM cmp",
    "m10_best_model": BT + EV + AV + CMP + " SELECT model_name AS best_model, 'rmse' AS selection_metric, "
                      "rmse AS metric_value, " + ", ".join("round(mse, 2) AS mse" if m == "mse" else m for m in M.METRICS) + ", 'Selected because it has the best rmse.' "
                      "AS reason FROM cmp WHERE rank = 1",
    "m11_combined_evaluation": BT + EV + " SELECT * REPLACE (round(mse, 2) AS mse) FROM ev WHERE asset = '__all__'",
}

QUERIES = {
    "f1_f3_baseline_backtest": f1_f3_baseline_backtest,
    "f11_backtest_best_model": f11_backtest_best_model,
    "m1_m5_metric_set": m1_m5_metric_set,
    "m6_evaluate_by_asset": m6_evaluate_by_asset,
    "m7_evaluate_prediction_columns": m7_evaluate_prediction_columns,
    "m8_average_metrics": m8_average_metrics,
    "m9_comparison_table": m9_comparison_table,
    "m9_missing_model": m9_missing_model,
    "m10_best_model": m10_best_model,
    "m11_combined_evaluation": m11_combined_evaluation,
}


def io3_metrics_json_scan(spark, sf):
    """Averaged model metrics written as JSON, scanned back as the long table."""
    import uuid

    from ledgerline.session import scratch_path
    from ledgerline.sources import files as IO
    avg = _comparable(_averaged(spark, sf))
    long = avg.unpivot(["model_name"], list(M.METRICS), "metric", "value") \
              .withColumn("asset", F.lit(M.ALL)).select("model_name", "asset", "metric", "value")
    path = scratch_path(spark, f"metrics-{uuid.uuid4().hex}")
    long.write.mode("overwrite").json(path)
    status, df = IO.load_metrics(spark, path)
    missing_status, _ = IO.load_metrics(spark, path + "-missing")
    return df.withColumn("status", F.lit(status)).withColumn("missing_status", F.lit(missing_status))


ORACLE["io3_metrics_json_scan"] = (BT + EV + AV + " SELECT model_name, '__all__' AS asset, metric, value, "
                                   "'available' AS status, 'missing' AS missing_status FROM (SELECT * REPLACE (round(mse, 2) AS mse) FROM av) UNPIVOT "
                                   "(value FOR metric IN (" + ", ".join(M.METRICS) + "))")
QUERIES["io3_metrics_json_scan"] = io3_metrics_json_scan
