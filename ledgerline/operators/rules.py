"""Monitoring rules (R1-R5): metric tables joined with rule tables.

Metrics come in long form (scope, metric, value); a rule is (rule, metric,
op, threshold, severity). The rule table is a fixed list (its broadcast
size bound is its length); the violated rows are the alerts. When several
levels of one rule fire, the most severe one is reported.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.exprs import is_numeric_type, to_number
from ledgerline.operators.profile import missing_summary

# Fixed values of the application: alert thresholds
DATA_QUALITY_RULES = [
    ("high_missing_values", "missing_percent", ">", 5.0, "warning"),
    ("duplicate_rows", "duplicate_percent", ">", 2.0, "warning"),
    ("negative_prices", "negative_price_count", ">", 0.0, "warning"),
    ("too_few_records", "record_count", "<", 10.0, "critical"),
    ("too_few_assets", "asset_count", "<", 1.0, "critical"),
]
FORECAST_RULES = [
    ("high_rmse", "rmse", ">", 50.0, "warning"), ("high_rmse", "rmse", ">", 100.0, "critical"),
    ("high_mae", "mae", ">", 30.0, "warning"), ("high_mae", "mae", ">", 60.0, "critical"),
    ("high_mape", "mape", ">", 25.0, "warning"), ("high_mape", "mape", ">", 50.0, "critical"),
    ("low_r2_score", "r2_score", "<", 0.50, "warning"), ("low_r2_score", "r2_score", "<", 0.20, "critical"),
]
ANOMALY_RULES = [
    ("high_anomaly_rate", "anomaly_rate_percent", ">", 20.0, "warning"),
    ("high_severity_anomalies", "high_severity_count", ">", 5.0, "warning"),
    ("asset_with_many_anomalies", "asset_anomaly_count", ">", 50.0, "warning"),
]
SHIFT_RULES = [
    ("mean_shift", "mean_shift_percent", ">", 20.0, "warning"),
    ("std_shift", "std_shift_percent", ">", 30.0, "warning"),
    ("missing_shift", "missing_shift_percent", ">", 10.0, "warning"),
]
STEP_LIMIT_SECONDS = {"data_pipeline": 120.0, "model_training": 1800.0, "inference": 60.0,
                      "api_request": 10.0, "dashboard_load": 15.0}
LEVELS = ["warning", "critical"]
RULE_SCHEMA = "rule string, metric string, op string, threshold double, severity string"


def rule_table(spark: SparkSession, rules: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def evaluate_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts: one row per (scope, rule) at its most severe violated level."""
    j = metrics.join(F.broadcast(rules), "metric", "inner")  # rule list: fixed, tiny
    hit = F.when(F.col("op") == ">", F.col("value") > F.col("threshold")) \
           .when(F.col("op") == "<", F.col("value") < F.col("threshold")).otherwise(F.lit(False))
    v = j.filter(F.coalesce(hit, F.lit(False)))
    lvl = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.col("severity"))
    best = v.groupBy("scope", "rule").agg(F.max_by(F.struct("metric", "value", "threshold", "severity"), lvl)
                                          .alias("_a"))
    return best.select("scope", "rule", "_a.*")


def long_metrics(df: DataFrame, scope: str, metrics: Sequence[str]) -> DataFrame:
    return df.select(F.col(scope).cast("string").alias("scope"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
        .alias("_m")).select("scope", "_m.*")


# R1
def data_quality_metrics(df: DataFrame, asset: str = "asset", value: str = "price") -> DataFrame:
    miss = missing_summary(df).select(F.col("column").alias("scope"), F.lit("missing_percent").alias("metric"),
                                      F.col("missing_percent").cast("double").alias("value"))
    dup = df.agg(F.count(F.lit(1)).alias("_n")).crossJoin(df.distinct().agg(F.count(F.lit(1)).alias("_d")))
    price = to_number(F.col(value), is_numeric_type(df, value))  # text prices are coerced, not cast
    ds = df.agg(F.count_if(price < 0).cast("double").alias("negative_price_count"),
                F.count(F.lit(1)).cast("double").alias("record_count"),
                F.count_distinct(asset).cast("double").alias("asset_count")).crossJoin(
        dup.select(F.coalesce(F.try_divide((F.col("_n") - F.col("_d")) * 100.0, F.col("_n")), F.lit(0.0))
                   .alias("duplicate_percent")))
    ds = ds.withColumn("_scope", F.lit("dataset"))
    return miss.unionByName(long_metrics(ds, "_scope", ["negative_price_count", "record_count", "asset_count",
                                                        "duplicate_percent"]))


# R3
def anomaly_metrics(flags: DataFrame, asset: str = "asset") -> DataFrame:
    ds = flags.agg((F.count_if("is_anomaly") * 100.0 / F.count(F.lit(1))).alias("anomaly_rate_percent"),
                   F.count_if(F.col("anomaly_severity") == "high").cast("double").alias("high_severity_count")) \
              .withColumn("_scope", F.lit("dataset"))
    per = flags.groupBy(asset).agg(F.count_if("is_anomaly").cast("double").alias("asset_anomaly_count"))
    return long_metrics(ds, "_scope", ["anomaly_rate_percent", "high_severity_count"]).unionByName(
        long_metrics(per, asset, ["asset_anomaly_count"]))


# R4
def shift_metrics(drift_records: DataFrame) -> DataFrame:
    m0, m1 = F.col("reference_mean"), F.col("current_mean")
    s0, s1 = F.col("reference_std"), F.col("current_std")
    d = drift_records.select(
        "feature",
        (F.abs(F.try_divide(m1 - m0, F.abs(m0))) * 100).alias("mean_shift_percent"),
        (F.abs(F.try_divide(s1 - s0, F.abs(s0))) * 100).alias("std_shift_percent"),
        (F.abs(F.col("current_missing_rate") - F.col("reference_missing_rate")) * 100).alias("missing_shift_percent"))
    return long_metrics(d, "feature", ["mean_shift_percent", "std_shift_percent", "missing_shift_percent"])


# R5
def step_alerts(run_log: DataFrame, limits: dict = STEP_LIMIT_SECONDS) -> DataFrame:
    """Runs slower than the limit of their kind, and failed runs."""
    lim = F.element_at(F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))]),
                       F.col("category"))
    slow = run_log.filter(F.col("seconds") > lim).select("run_id", "category", "seconds",
                                                         F.lit("slow_step").alias("alert"), lim.alias("limit_seconds"))
    failed = run_log.filter(F.col("status") == "failed").select(
        "run_id", "category", "seconds", F.lit("failed_step").alias("alert"), lim.alias("limit_seconds"))
    return slow.unionByName(failed)
