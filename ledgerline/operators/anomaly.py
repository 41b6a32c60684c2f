"""Anomaly detection (D1-D3, D5-D8) and its report tables.

Per-series parameters (fences, mean/std) are grouped aggregates joined back
through a size-checked broadcast, never a whole-series window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small, materialize
from ledgerline.functions.exprs import finite
from ledgerline.functions.quantiles import group_quantiles
from ledgerline.operators.cleaning import clean_prices, one_row_fill
from ledgerline.operators.features import (anomaly_features, calendar_features, group_fences, group_zscore,
                                           series_parameters)

# Fixed values of the application
IQR_MULTIPLIER = 1.5
Z_THRESHOLD = 3.0
CONTAMINATION = 0.05
FLAG_COLUMNS = ["is_anomaly_iqr", "is_anomaly_zscore", "is_anomaly_isolation_forest"]
METHOD_NAMES = ["IQR", "Z-Score", "Isolation Forest"]
SEVERITY = ["normal", "low", "medium", "high"]


# D1
def detect_iqr(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
               multiplier: float = IQR_MULTIPLIER, fences: DataFrame | None = None) -> DataFrame:
    """Per-series quartile fences; ``fences`` given = frozen parameters
    (unknown series -> not anomalous)."""
    f = fences if fences is not None else group_fences(df, keys, value, multiplier)
    j = df.join(broadcast_if_small(f), list(keys), "left")
    flag = (F.col(value) < F.col("iqr_lower_bound")) | (F.col(value) > F.col("iqr_upper_bound"))
    return j.withColumn("is_anomaly_iqr", F.coalesce(flag, F.lit(False)))


# D2
def global_iqr_outliers(df: DataFrame, value: str = "price", multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    q = group_quantiles(df, [], value, [0.25, 0.75], ["q1", "q3"])
    b = q.select((F.col("q1") - multiplier * (F.col("q3") - F.col("q1"))).alias("_lo"),
                 (F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))).alias("_hi"))
    j = df.crossJoin(F.broadcast(b))  # one row
    return j.withColumn("is_outlier", (F.col(value) < F.col("_lo")) | (F.col(value) > F.col("_hi"))) \
            .drop("_lo", "_hi")


# D3
def detect_zscore(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                  threshold: float = Z_THRESHOLD) -> DataFrame:
    z = group_zscore(df, keys, value, "price_z_score")
    return z.withColumn("is_anomaly_zscore", F.abs(F.col("price_z_score")) > threshold)


def detect_iqr_zscore(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                      multiplier: float = IQR_MULTIPLIER, threshold: float = Z_THRESHOLD) -> DataFrame:
    """D1 + D3 with one parameter pass and one (size-checked broadcast) join."""
    keys = list(keys)
    params = broadcast_if_small(series_parameters(df, keys, value, multiplier))
    j = df.join(params, keys, "left")
    flag = (F.col(value) < F.col("iqr_lower_bound")) | (F.col(value) > F.col("iqr_upper_bound"))
    z = F.when((F.col("_std") == 0) | F.col("_std").isNull(), F.lit(0.0)) \
         .otherwise((F.col(value) - F.col("_mean")) / F.col("_std"))
    j = j.withColumns({"is_anomaly_iqr": F.coalesce(flag, F.lit(False)), "price_z_score": z})
    return j.withColumn("is_anomaly_zscore", F.abs(F.col("price_z_score")) > threshold) \
            .drop("_mean", "_std")


# D5
def combine_flags(df: DataFrame) -> DataFrame:
    for c in FLAG_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(False))
    count = sum(F.coalesce(F.col(c), F.lit(False)).cast("int") for c in FLAG_COLUMNS)
    df = df.withColumn("anomaly_method_count", count)
    names = F.concat_ws(", ", *[F.when(F.col(c), F.lit(n)) for c, n in zip(FLAG_COLUMNS, METHOD_NAMES)])
    return df.withColumns({
        "is_anomaly": F.col("anomaly_method_count") > 0,
        "anomaly_method": F.when(F.col("anomaly_method_count") > 0, names).otherwise(F.lit("None")),
        "anomaly_severity": F.element_at(F.array(*[F.lit(s) for s in SEVERITY]),
                                         F.col("anomaly_method_count") + 1),
    })


# D6
def fit_detect(raw: DataFrame, keys: Sequence[str] = ("asset",), forest: bool = True,
               as_date: bool = True, seed: int = 42, n_trees: int = 200,
               contamination: float = CONTAMINATION) -> DataFrame:
    """clean -> anomaly features -> IQR -> z-score -> [isolation forest] -> combine."""
    data = clean_prices(raw, as_date=as_date)
    data = anomaly_features(data, keys)
    data = detect_iqr_zscore(data, keys)
    if forest:
        from ledgerline.operators.iforest import detect_isolation_forest
        data = detect_isolation_forest(data, keys, seed=seed, n_trees=n_trees,
                                       contamination=contamination)
    return combine_flags(data)


# A19
def anomaly_summary(df: DataFrame, asset: str = "asset") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_anomaly").alias("total_anomalies"),
        F.count_if(~F.col("is_anomaly")).alias("normal_records"),
        F.round(F.coalesce(F.try_divide(F.count_if("is_anomaly") * 100.0, F.count(F.lit(1))), F.lit(0.0)), 4)
         .alias("anomaly_rate_percent"),
        F.count_distinct(asset).alias("asset_count"))


# A20
def method_summary(df: DataFrame) -> DataFrame:
    present = [(c, n) for c, n in zip(FLAG_COLUMNS, METHOD_NAMES) if c in df.columns]
    sums = df.agg(*[F.count_if(c).alias(n) for c, n in present])
    return sums.unpivot([], [n for _, n in present], "method", "anomaly_count")


# A21
def severity_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("anomaly_severity").agg(F.count(F.lit(1)).alias("record_count"))


# A22
def asset_anomaly_summary(df: DataFrame, asset: str = "asset", value: str = "price") -> DataFrame:
    aggs = [F.count(value).alias("total_records"),
            F.count_if("is_anomaly").alias("anomaly_count"),
            F.count_if("is_anomaly_iqr").alias("iqr_anomaly_count"),
            F.count_if("is_anomaly_zscore").alias("zscore_anomaly_count")]
    if "is_anomaly_isolation_forest" in df.columns:
        aggs.append(F.count_if("is_anomaly_isolation_forest").alias("isolation_forest_anomaly_count"))
    aggs += [F.avg(value).alias("average_price"), F.min(value).alias("min_price"),
             F.max(value).alias("max_price")]
    if "anomaly_score" in df.columns:
        aggs.append(F.avg("anomaly_score").alias("average_anomaly_score"))
    out = df.groupBy(asset).agg(*aggs)
    return out.withColumn("anomaly_rate_percent", F.col("anomaly_count") * 100.0 / F.col("total_records"))


# A23
def top_anomalies(df: DataFrame, n: int = 10, asset: str = "asset") -> DataFrame:
    """Top n anomalies: most methods first, then lowest score. A top-k report:
    the limit is the feature (TakeOrderedAndProject, no global sort)."""
    cols = [c for c in ("date", asset, "price", "anomaly_method", "anomaly_severity",
                        "anomaly_method_count", "anomaly_score", "row_id") if c in df.columns]
    score = [F.col("anomaly_score").asc()] if "anomaly_score" in df.columns else []
    tie = [F.col("row_id").asc()] if "row_id" in df.columns else []
    return df.filter("is_anomaly").orderBy(F.col("anomaly_method_count").desc(), *score, *tie) \
             .limit(n).select(*cols)


# D8
def detection_report(df: DataFrame, top_n: int = 10) -> dict[str, DataFrame]:
    return {"summary": anomaly_summary(df), "methods": method_summary(df),
            "severity": severity_distribution(df), "assets": asset_anomaly_summary(df),
            "top": top_anomalies(df, top_n)}


# D7
def score_new_data(new: DataFrame, state: dict, keys: Sequence[str] = ("asset",),
                   mode: str = "refit", as_date: bool = True) -> DataFrame:
    """Score a new batch with saved state. ``mode='refit'`` recomputes fences
    and z on the batch (the application's behaviour); ``'frozen'`` applies the
    saved fences/mean/std. The forest always uses the saved trees; series
    without saved state are normal with score 0."""
    keys = list(keys)
    data = anomaly_features(clean_prices(new, as_date=as_date), keys)
    if mode == "frozen":
        return apply_state(data, state, keys)
    return _combine_with_forest(detect_iqr_zscore(data, keys), state, keys)


def apply_state(data: DataFrame, state: dict, keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Flags of feature rows by saved state alone: fences, moments, and where saved the medians that stand in for
    missing features and the forest."""
    keys = list(keys)
    if state.get("fills") is not None:
        cols = [c[len("_fill_"):] for c in state["fills"].columns if c[len("_fill_"):] in data.columns]
        data = one_row_fill(data.withColumns({c: finite(F.col(c)) for c in cols}), state["fills"], cols).fillna(0, subset=cols)
    data = detect_iqr(data, keys, fences=state["fences"])
    data = data.join(broadcast_if_small(state["moments"]), keys, "left")
    z = F.when((F.col("_std") == 0) | F.col("_std").isNull(), F.lit(0.0)) \
         .otherwise((F.col("price") - F.col("_mean")) / F.col("_std"))
    data = data.withColumn("price_z_score", z) \
               .withColumn("is_anomaly_zscore", F.abs(F.col("price_z_score")) > Z_THRESHOLD) \
               .drop("_mean", "_std")
    return _combine_with_forest(data, state, keys)


def _combine_with_forest(data: DataFrame, state: dict, keys: list[str]) -> DataFrame:
    if state.get("forest") is not None:
        from ledgerline.operators.iforest import score_with_forest
        data = score_with_forest(data, state["forest"], keys)
    return combine_flags(data)


def fit_state(history: DataFrame, keys: Sequence[str] = ("asset",), forest: bool = True, seed: int = 42, n_trees: int = 200,
              contamination: float = CONTAMINATION) -> dict:
    """State for :func:`score_new_data` and the stream, fitted on cleaned history: fences, moments, medians of
    features that can be missing, and the forest."""
    from ledgerline.operators.features import LAGS, WINDOWS, nullable_columns, series_features
    from ledgerline.operators.cleaning import column_medians
    keys = list(keys)
    params = series_parameters(history, keys, "price", IQR_MULTIPLIER)
    raw = series_features(history, keys, ("date", "row_id"), "price", lags=LAGS, windows=WINDOWS, volatility=True)
    raw = materialize(calendar_features(raw), "state-features")
    cols = nullable_columns("price", LAGS, WINDOWS, True)
    fills = column_medians(raw.withColumns({c: finite(F.col(c)) for c in cols}), cols)
    state = {"fences": params.drop("_mean", "_std"), "moments": params.select(*keys, "_mean", "_std"), "fills": fills}
    if forest:
        from ledgerline.operators.iforest import detect_isolation_forest
        rows = one_row_fill(raw, fills, cols).fillna(0, subset=cols)
        state["forest"] = detect_isolation_forest(rows, keys, seed=seed, n_trees=n_trees, contamination=contamination, return_state=True)[1]
    return state
