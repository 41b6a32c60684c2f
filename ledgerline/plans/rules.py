"""Queries for monitoring rules (R*)."""

from __future__ import annotations

from ledgerline.operators import metrics as M
from ledgerline.operators import rules as R
from ledgerline.operators.drift import numeric_drift
from ledgerline.plans import drift as PD
from ledgerline.plans import metrics as PM
from ledgerline.plans.cleaning import _dirty_typed
from ledgerline.plans.features import round_doubles
from ledgerline.plans.flagship import CLEAN_TICKS, FLAGS_SQL, ticks_flags
from ledgerline.plans.sqlkit import DIRTY_STD, DIRTY_TYPED, sql_with
from ledgerline.sources import tables as T


def r1_data_quality_alerts(spark, sf):
    m = R.data_quality_metrics(_dirty_typed(spark, sf))
    return round_doubles(R.evaluate_rules(m, R.rule_table(spark, R.DATA_QUALITY_RULES)))


def r2_forecast_alerts(spark, sf):
    ev = M.evaluate(PM._backtest(spark, sf), pred="lag_regression_prediction")
    m = R.long_metrics(ev, "asset", ["rmse", "mae", "mape", "r2_score"])
    return round_doubles(R.evaluate_rules(m, R.rule_table(spark, R.FORECAST_RULES)))


def r3_anomaly_alerts(spark, sf):
    m = R.anomaly_metrics(ticks_flags(spark, sf))
    return round_doubles(R.evaluate_rules(m, R.rule_table(spark, R.ANOMALY_RULES)))


def r4_shift_alerts(spark, sf):
    ref, cur = PD._samples(spark, sf)
    m = R.shift_metrics(numeric_drift(ref, cur, PD.NUM))
    return round_doubles(R.evaluate_rules(m, R.rule_table(spark, R.SHIFT_RULES)))


def r5_step_alerts(spark, sf):
    return R.step_alerts(T.run_log(spark, sf))


def _rules_sql(rules) -> str:
    rows = ", ".join(f"('{a}', '{b}', '{c}', CAST({d} AS DOUBLE), '{e}')" for a, b, c, d, e in rules)
    return f"rl(rule, metric, op, threshold, severity) AS (VALUES {rows})"


EVAL = (", hit AS (SELECT m.scope, rl.rule, m.metric, m.value, rl.threshold, rl.severity, "
        "CASE rl.severity WHEN 'warning' THEN 1 ELSE 2 END AS lvl FROM m JOIN rl USING (metric) WHERE "
        "CASE rl.op WHEN '>' THEN m.value > rl.threshold ELSE m.value < rl.threshold END) "
        "SELECT scope, rule, arg_max(metric, lvl) AS metric, round(arg_max(value, lvl), 6) AS value, "
        "round(arg_max(threshold, lvl), 6) AS threshold, arg_max(severity, lvl) AS severity FROM hit GROUP BY scope, rule")

ORACLE = {
    "r1_data_quality_alerts": sql_with("dirty_prices") + ", " + DIRTY_STD + ", " + DIRTY_TYPED + ", "
    + _rules_sql(R.DATA_QUALITY_RULES) + ", m AS (SELECT 'date' AS scope, 'missing_percent' AS metric, "
    "count_if(date IS NULL) * 100.0 / count(*) AS value FROM typed UNION ALL SELECT 'asset', 'missing_percent', "
    "count_if(asset IS NULL) * 100.0 / count(*) FROM typed UNION ALL SELECT 'price', 'missing_percent', "
    "count_if(price IS NULL) * 100.0 / count(*) FROM typed UNION ALL SELECT 'row_id', 'missing_percent', "
    "count_if(row_id IS NULL) * 100.0 / count(*) FROM typed UNION ALL SELECT 'dataset', 'negative_price_count', "
    "count_if(price < 0) FROM typed UNION ALL SELECT 'dataset', 'record_count', count(*) FROM typed UNION ALL "
    "SELECT 'dataset', 'asset_count', count(DISTINCT asset) FROM typed UNION ALL SELECT 'dataset', "
    "'duplicate_percent', (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM typed))) * 100.0 / count(*) "
    "FROM typed)" + EVAL,
    "r2_forecast_alerts": PM.BT + ", " + _rules_sql(R.FORECAST_RULES) + ", ev AS (SELECT '__all__' AS asset, "
    + PM.msql("actual_price", "lag_regression_prediction") + " FROM bt UNION ALL SELECT asset, "
    + PM.msql("actual_price", "lag_regression_prediction") + " FROM bt GROUP BY asset), m AS (SELECT asset AS scope, "
    "metric, value FROM ev UNPIVOT (value FOR metric IN (rmse, mae, mape, r2_score)))" + EVAL,
    "r3_anomaly_alerts": sql_with("ticks") + ", " + CLEAN_TICKS + ", " + FLAGS_SQL + ", "
    + _rules_sql(R.ANOMALY_RULES) + ", m AS (SELECT 'dataset' AS scope, 'anomaly_rate_percent' AS metric, "
    "count_if(is_anomaly_iqr OR is_anomaly_zscore) * 100.0 / count(*) AS value FROM flags UNION ALL SELECT "
    "'dataset', 'high_severity_count', 0 FROM flags GROUP BY ALL UNION ALL SELECT asset, 'asset_anomaly_count', "
    "count_if(is_anomaly_iqr OR is_anomaly_zscore) FROM flags GROUP BY asset)" + EVAL,
    "r4_shift_alerts": PD.SRC + PD.LNUM + PD.STATS + ", " + _rules_sql(R.SHIFT_RULES) + ", d AS (SELECT feature, "
    "abs((current_mean - reference_mean) / nullif(abs(reference_mean), 0)) * 100 AS mean_shift_percent, "
    "abs((current_std - reference_std) / nullif(abs(reference_std), 0)) * 100 AS std_shift_percent, "
    "abs(current_missing_rate - reference_missing_rate) * 100 AS missing_shift_percent FROM sref JOIN scur "
    "USING (feature)), m AS (SELECT feature AS scope, metric, value FROM d UNPIVOT (value FOR metric IN "
    "(mean_shift_percent, std_shift_percent, missing_shift_percent)))" + EVAL,
    "r5_step_alerts": sql_with("run_log") + ", lim(category, limit_seconds) AS (VALUES " + ", ".join(
        f"('{k}', CAST({v} AS DOUBLE))" for k, v in R.STEP_LIMIT_SECONDS.items()) + ") SELECT run_id, category, seconds, "
    "'slow_step' AS alert, limit_seconds FROM run_log JOIN lim USING (category) WHERE seconds > limit_seconds "
    "UNION ALL SELECT run_id, category, seconds, 'failed_step', limit_seconds FROM run_log LEFT JOIN lim "
    "USING (category) WHERE status = 'failed'",
}

QUERIES = {
    "r1_data_quality_alerts": r1_data_quality_alerts,
    "r2_forecast_alerts": r2_forecast_alerts,
    "r3_anomaly_alerts": r3_anomaly_alerts,
    "r4_shift_alerts": r4_shift_alerts,
    "r5_step_alerts": r5_step_alerts,
}
