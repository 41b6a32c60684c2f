"""Forecasting.

Baselines and the one-feature regression are column expressions over the
feature table. The model-based forecasts train with Spark ML on the
distributed feature table (one model for all assets), or fit tiny per-asset
systems from grouped sums (normal equations) - the data never gathers in one
place; only k x k sums per asset do.
"""

from __future__ import annotations

import warnings
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.cleaning import fill_feature_nulls
from ledgerline.operators.features import series_features
from ledgerline.operators.splits import TEST_SIZE, time_split

PREDICTION_MODELS = ["previous_price", "rolling_mean_7", "lag_regression"]


def clip0(c):
    return F.greatest(c, F.lit(0.0))


# F1, F2, F3 (one-feature form), F11
def baseline_backtest(df: DataFrame, test_size: float = TEST_SIZE, keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Test rows of the time split with three predictions: previous price
    (lag 1, whole-table median for a series' first row), the 7-row rolling
    mean (frame includes the current row, as the application does) and an
    OLS line price ~ lag 1 fitted on the train rows. All clipped at 0."""
    f = series_features(df, keys, ("date", "row_id"), returns=False, lags=(1,), windows=(7,),
                        volatility=False)
    f = fill_feature_nulls(f, ["price_lag_1"])
    split = time_split(f, test_size)
    coef = split.filter(F.col("split") == "train").agg(
        F.regr_slope("price", "price_lag_1").alias("_b"), F.regr_intercept("price", "price_lag_1").alias("_a"))
    test = split.filter(F.col("split") == "test").crossJoin(F.broadcast(coef))  # one row
    return test.select(
        "date", *keys, "row_id", F.col("price").alias("actual_price"),
        clip0(F.col("price_lag_1")).alias("previous_price_prediction"),
        clip0(F.col("price_rolling_mean_7")).alias("rolling_mean_7_prediction"),
        clip0(F.col("_a") + F.col("_b") * F.col("price_lag_1")).alias("lag_regression_prediction"))


def with_best_prediction(backtest: DataFrame, models: Sequence[str] = PREDICTION_MODELS) -> DataFrame:
    """per row, the model with the smallest absolute error (first in
    ``models`` order on ties) and that error."""
    errs = [F.struct(F.abs(F.col("actual_price") - F.col(f"{m}_prediction")).alias("e"),
                     F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(models)]
    best = F.array_min(F.array(*errs))
    return backtest.withColumn("absolute_error", best["e"]).withColumn("best_model", best["m"])


# ---------------------------------------------------------------------------
# Model-based forecasts
# ---------------------------------------------------------------------------

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.regression import LinearRegression  # noqa: E402
from pyspark.sql import Column  # noqa: E402

from ledgerline.functions.broadcast import broadcast_if_small, materialize  # noqa: E402
from ledgerline.functions.price_windows import changes, rolling  # noqa: E402
from ledgerline.operators.autoregression import AR_ORDER, fit_ar  # noqa: E402
from ledgerline.operators.features import (MODEL_LAGS, WINDOWS, minmax_scale,  # noqa: E402
                                           model_features, regular_calendar)
from ledgerline.operators.seasonal import fit_seasonal, seasonal_forecast  # noqa: E402
from ledgerline.operators.splits import MIN_SERIES_ROWS  # noqa: E402
from ledgerline.operators.trees import (Boosting, BoostedTrees, bin_edges, binned_chunks, fit_boosted,  # noqa: E402
                                        grow_forest, score_forest)

# Fixed values of the application
HORIZON = 30
SEQ_LEN = 10
CHECKPOINT_EVERY = 1  # state is one row per series: cut lineage every step
MODEL_NAMES = ["xgboost", "arima", "prophet", "lstm"]
NON_FEATURES = {"date", "asset", "price", "row_id", "split"}


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: numeric columns except the target and identifiers
    (the rolling statistics include the current row, as in the application)."""
    from ledgerline.functions.exprs import numeric_columns
    return [c for c in numeric_columns(df) if c not in NON_FEATURES]


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df)


# F3 / F4 / F5
def fit_regressor(train: DataFrame, features: Sequence[str], kind: str = "gbt", **params):
    """A model of the distributed feature table (all assets, one model): ``linear`` (Spark ML), ``gbt`` or
    ``forest`` (histogram trees, see :mod:`ledgerline.operators.trees`)."""
    if kind == "linear":
        est = LinearRegression(featuresCol="features", labelCol="price", regParam=0.0, **({"solver": "normal"} | params))
        return est.fit(_assembled(train, features))
    if kind == "forest":
        return fit_forest(train, features, **params)
    return fit_boosted(train, features, p=Boosting(**params))


class Forest:
    """A fitted forest: its parts stay a stored table."""

    def __init__(self, features, edges, parts: DataFrame, trees: int):
        self.features, self.edges, self.parts, self.trees = list(features), edges, parts, trees

    def transform(self, df: DataFrame) -> DataFrame:
        return score_forest(self.parts, df, self.features, self.edges, self.trees)


def fit_forest(train: DataFrame, features: Sequence[str], trees: int = 300, depth: int = 64, seed: int = 42) -> Forest:
    """Settings of the application: 300 trees, unlimited depth (64 levels here, more than halving a table ever needs), all features."""
    edges = bin_edges(train, features)
    chunks = binned_chunks(train, features, "price", edges)
    return Forest(features, edges, grow_forest(chunks, len(edges), trees, depth, seed), trees)


def predict(model, df: DataFrame, features: Sequence[str], out: str = "predicted_price") -> DataFrame:
    if isinstance(model, (BoostedTrees, Forest)):
        return model.transform(df).withColumn(out, clip0(F.col("prediction"))).drop("prediction")
    pred = model.transform(_assembled(df, features)).withColumn(out, clip0(F.col("prediction")))
    return pred.drop("features", "prediction")


def model_backtest(df: DataFrame, kind: str = "gbt", test_size: float = TEST_SIZE, **params) -> tuple:
    """Boosted-model features -> time split -> fit on train -> predictions on test."""
    feats_df = materialize(model_features(df), "model-features")
    feats = feature_columns(feats_df)
    split = time_split(feats_df, test_size)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    model = fit_regressor(train, feats, kind, **params)
    return model, feats, predict(model, test, feats)


# M12
def feature_importance(model, features: Sequence[str], spark, top_n: int | None = None) -> DataFrame:
    """The fitted model's importances (one weight per feature: its share of all gains)."""
    own = model.importances()
    imp = [own[f] for f in features]
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    ordered = df.orderBy(F.col("importance").desc(), "feature")
    return ordered.limit(top_n) if top_n else ordered


# recursive multi-step forecast with the boosted model
def _step_features(state: DataFrame, features: Sequence[str], medians: DataFrame, assets: Sequence[str],
                   keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Feature row of the next day for every series: the new row carries the
    last price as a placeholder (as the application does), lags look back
    from it, rolling frames include it. The <= 33 window values of a series
    are exploded to rows and reduced with plain conditional aggregates (a
    tiny groupBy per step instead of nested array lambdas)."""
    keys = list(keys)
    seq = F.concat(F.col("hist"), F.array(F.element_at("hist", -1)))
    prev = F.concat(F.array(F.lit(None).cast("double")), F.col("hist"))
    base = state.select(*keys, "last_date", "hist", "complete", F.size(seq).alias("_n"),
                        F.posexplode(F.arrays_zip(seq.alias("v"), prev.alias("p"))).alias("_i", "_z"))
    v, i, n = F.col("_z.v"), F.col("_i"), F.col("_n")
    ret = F.when(i == 0, F.when(F.col("complete"), F.lit(0.0))) \
           .otherwise(F.coalesce(finite_div(v, F.col("_z.p")) - 1, F.lit(0.0)))
    base = base.withColumns({"_v": v, "_r": ret})
    aggs = [F.first("hist").alias("hist"), F.first("complete").alias("complete"),
            F.max(F.when(i == n - 1, F.col("_v"))).alias("price"),
            F.max(F.when(i == n - 1, F.col("_r"))).alias("daily_return")]
    aggs += [F.max(F.when((i == n - 1 - k) & (n > k), F.col("_v"))).alias(f"price_lag_{k}") for k in MODEL_LAGS]
    for w in WINDOWS:
        inside = i >= n - w
        aggs += [F.avg(F.when(inside, F.col("_v"))).alias(f"price_rolling_mean_{w}"),
                 F.stddev_samp(F.when(inside, F.col("_v"))).alias(f"price_rolling_std_{w}"),
                 F.stddev_samp(F.when(inside, F.col("_r"))).alias(f"return_rolling_volatility_{w}")]
    out = base.groupBy(*keys, "last_date").agg(*aggs)
    d = F.date_add(F.col("last_date"), 1)
    qs = F.trunc(d, "quarter")
    cols = {"date": d, "year": F.year(d), "month": F.month(d), "quarter": F.quarter(d), "day": F.dayofmonth(d),
            "day_of_week": F.weekday(d), "week_of_year": F.weekofyear(d),
            "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
            "is_month_end": (d == F.last_day(d)).cast("int"),
            "is_quarter_start": (d == qs).cast("int"),
            "is_quarter_end": (d == F.date_sub(F.add_months(qs, 3), 1)).cast("int")}
    for a in assets:
        cols[f"asset_{a}"] = (F.col(keys[0]) == F.lit(a)).cast("int")
    out = out.withColumns(cols).crossJoin(F.broadcast(medians))  # one row
    fill = {c: F.coalesce(F.col(c), F.col(f"_fill_{c}"), F.lit(0.0))
            for c in features if f"_fill_{c}" in medians.columns}
    return out.withColumns(fill).drop(*medians.columns)


def finite_div(a: Column, b: Column) -> Column:
    q = F.try_divide(a, b)
    return F.when(F.isnan(q) | (F.abs(q) == float("inf")), F.lit(None)).otherwise(q)


def recursive_forecast(history: DataFrame, model, features: Sequence[str], horizon: int = HORIZON,
                       keys: Sequence[str] = ("asset",), model_name: str = "xgboost",
                       checkpoint_every: int = CHECKPOINT_EVERY, medians: DataFrame | None = None) -> DataFrame:
    """Every series advances one day per step, all series together. State per
    series: last date and the last 32 prices (enough for lag 14, 30-row
    frames and the returns inside them); O(h) per series instead of
    re-engineering the whole history each step. Each step's rows are
    checkpointed (every ``checkpoint_every`` steps; default every step), so
    plans stay small and a lost executor never replays earlier steps."""
    keys = list(keys)
    keep = max(max(WINDOWS) + 2, max(MODEL_LAGS) + 2)
    w = F.struct("date", "row_id")
    st = history.groupBy(*keys).agg(F.max_by("date", w).alias("last_date"), F.count(F.lit(1)).alias("_n"),
                                    F.max_by("row_id", w).alias("_last"))
    # the last `keep` prices per series: rows ranked from the end; only a
    # bounded tail per series is collected
    from ledgerline.functions.sequence import POS, with_positions
    pos = with_positions(history, keys, ["date", "row_id"])
    tail = pos.join(broadcast_if_small(st.select(*keys, "_n")), keys).filter(F.col(POS) > F.col("_n") - keep)
    hist = tail.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(POS, "price"))).alias("_h"))
    state = st.join(hist, keys).select(*keys, F.col("last_date").cast("date").alias("last_date"),
                                       F.transform("_h", lambda x: x["price"]).alias("hist"),
                                       (F.col("_n") < keep).alias("complete"))
    if isinstance(model, BoostedTrees):
        return _advance(state, model, medians, horizon, keys, keep).withColumn("model_name", F.lit(model_name))
    assets = [c[len("asset_"):] for c in features if c.startswith("asset_")]
    if medians is None:
        medians = history.sparkSession.createDataFrame([(0.0,)], "_fill_none double")
    medians = broadcast_if_small(medians)  # one row, computed once for all steps
    outputs = []
    for step in range(1, horizon + 1):
        feats = _step_features(state, features, medians, assets, keys)
        pred = predict(model, feats, features, "forecasted_price").select(
            *keys, "date", "forecasted_price",
            F.slice(F.concat("hist", F.array("forecasted_price")), -keep, keep).alias("hist"),
            F.when(F.size("hist") + 1 > keep, F.lit(False)).otherwise(F.col("complete")).alias("complete"))
        # one row per series: a reliable checkpoint per step keeps every step's
        # plan constant-size (the output and the next state both read it)
        if step % checkpoint_every == 0 or checkpoint_every <= 1:
            pred = pred.checkpoint(eager=True)
        else:
            pred = pred.persist()
        outputs.append(pred.select(*keys, "date", "forecasted_price", F.lit(step).alias("step")))
        state = pred.select(*keys, F.col("date").alias("last_date"), "hist", "complete")
    return _union(outputs).withColumn("model_name", F.lit(model_name))


def _advance(state: DataFrame, model: BoostedTrees, medians: DataFrame | None, horizon: int, keys: list[str], keep: int) -> DataFrame:
    """All steps of all series in one pass: a series' next days depend on its own bounded tail and the model alone, so
    every task advances its series together, without a job per step."""
    fills = {k[len("_fill_"):]: v for k, v in medians.first().asDict().items()} if medians is not None else {}   # one row
    names = model.features

    def step_features(pdf: pd.DataFrame, prices: np.ndarray, dates: pd.DatetimeIndex) -> np.ndarray:
        seq = np.concatenate([prices, prices[:, -1:]], axis=1)         # the new day carries the last price as a placeholder
        change = changes(seq)
        cols = {"daily_return": change[:, -1], "year": dates.year, "month": dates.month, "quarter": dates.quarter, "day": dates.day,
                "day_of_week": dates.dayofweek, "week_of_year": dates.isocalendar().week.to_numpy(float), "is_month_start": dates.is_month_start,
                "is_month_end": dates.is_month_end, "is_quarter_start": dates.is_quarter_start, "is_quarter_end": dates.is_quarter_end}
        cols |= {f"price_lag_{k}": seq[:, -1 - k] for k in MODEL_LAGS}
        for n in WINDOWS:
            cols |= {f"price_rolling_mean_{n}": rolling(seq[:, -n:], n, False)[:, -1], f"price_rolling_std_{n}": rolling(seq[:, -n:], n, True)[:, -1],
                     f"return_rolling_volatility_{n}": rolling(change[:, -n:], n, True)[:, -1]}
        own = pdf[keys[0]].astype(str)
        x = np.column_stack([(own == c[len("asset_"):]).to_numpy(float) if c not in cols else np.asarray(cols[c], float) for c in names])
        for j, c in enumerate(names):
            bad = ~np.isfinite(x[:, j])
            x[bad, j] = fills.get(c) or 0.0
        return x

    def run(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            prices = np.full((len(pdf), keep), np.nan)
            for i, h in enumerate(pdf["hist"]):
                prices[i, keep - len(h):] = h
            dates = pd.DatetimeIndex(pd.to_datetime(pdf["last_date"]))
            for step in range(1, horizon + 1):
                dates = dates + pd.Timedelta(days=1)
                y = np.maximum(model.predict(step_features(pdf, prices, dates)), 0.0)
                prices = np.concatenate([prices[:, 1:], y[:, None]], axis=1)
                yield pdf[keys].assign(date=dates.date, forecasted_price=y, step=step)
    types = dict(state.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", date date, forecasted_price double, step int"
    return state.select(*keys, "last_date", "hist").mapInPandas(run, schema)


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _last_rows(df: DataFrame, keys: Sequence[str], pos: str, n: int) -> DataFrame:
    """The last ``n`` rows of each series by ``pos`` (a bounded tail; the
    series itself is never gathered)."""
    mx = df.groupBy(*keys).agg(F.max(pos).alias("_mx"))
    return df.join(broadcast_if_small(mx), list(keys)).filter(F.col(pos) > F.col("_mx") - n).drop("_mx")


# AR(p) on the differenced regular daily series (ARIMA(p,1,0)); the fit is in operators/autoregression.py
def ar_design(df: DataFrame, keys: Sequence[str] = ("asset",), order: int = AR_ORDER) -> DataFrame:
    """Regular daily series -> rows (x = [1, d_{t-1}..d_{t-p}], y = d_t)."""
    from ledgerline.functions.sequence import bounded_window
    keys = list(keys)
    reg = regular_calendar(df, keys).withColumnRenamed("day_index", "_pos")

    def build(d, w):
        d = d.withColumn("_d", F.col("price") - F.lag("price", 1).over(w))
        return d.withColumns({f"_l{i}": F.lag("_d", i).over(w) for i in range(1, order + 1)})
    lagged = bounded_window(reg, keys, order + 1, build, pos_col="_pos")
    rows = lagged.filter(F.col(f"_l{order}").isNotNull())
    return rows.select(*keys, "date", F.array(F.lit(1.0), *[F.col(f"_l{i}") for i in range(1, order + 1)]).alias("x"),
                       F.col("_d").alias("y"))


def ar_forecast(df: DataFrame, coef: DataFrame, keys: Sequence[str] = ("asset",), horizon: int | Column = HORIZON,
                order: int = AR_ORDER, regular: DataFrame | None = None) -> DataFrame:
    """h-step recursion y_{T+h} = y_{T+h-1} + c + sum phi_i d_{T+h-i}, clipped at 0. ``horizon``: a number, or a
    column of ``coef`` (steps of each series)."""
    keys = list(keys)
    reg = _last_rows(regular if regular is not None else regular_calendar(df, keys), keys, "day_index", order + 1)
    coef = coef.withColumn("_steps", (F.lit(horizon) if isinstance(horizon, int) else horizon).cast("int")).filter("_steps > 0")
    last = reg.groupBy(*keys).agg(F.max("date").alias("_t"),
                                  F.sort_array(F.collect_list(F.struct("day_index", "price"))).alias("_tail"))
    j = last.join(broadcast_if_small(coef.select(*keys, "coef", "_steps")), keys)
    ys = F.transform("_tail", lambda e: e["price"])
    diffs = F.transform(F.sequence(F.lit(2), F.size(ys)), lambda i: F.element_at(ys, i) - F.element_at(ys, i - 1))
    init = F.struct(diffs.alias("d"), F.element_at(ys, -1).alias("y"), F.array().cast("array<double>").alias("out"))

    def step(acc, _h):
        d = acc["d"]
        nxt = F.element_at(F.col("coef"), 1) + F.aggregate(
            F.sequence(F.lit(1), F.lit(order)), F.lit(0.0),
            lambda s, i: s + F.element_at(F.col("coef"), i + 1) * F.element_at(d, -i))
        y = acc["y"] + nxt
        return F.struct(F.slice(F.concat(d, F.array(nxt)), -order, order).alias("d"), y.alias("y"),
                        F.concat(acc["out"], F.array(F.greatest(y, F.lit(0.0)))).alias("out"))
    path = F.aggregate(F.sequence(F.lit(1), F.col("_steps")), init, step)
    out = j.select(*keys, "_t", F.posexplode(path["out"]).alias("_h", "forecasted_price"))
    return out.select(*keys, F.date_add("_t", F.col("_h") + 1).alias("date"), "forecasted_price",
                      (F.col("_h") + 1).alias("step"), F.lit("arima").alias("model_name"))


# sequence regressor (re-aim of the LSTM) on min-max scaled 10-day windows
def fit_sequence_model(df: DataFrame, keys: Sequence[str] = ("asset",), length: int = SEQ_LEN):
    from ledgerline.functions.sequence import bounded_window
    keys = list(keys)
    reg = minmax_scale(regular_calendar(df, keys), keys, "price", "scaled").withColumnRenamed("day_index", "_pos")

    def build(d, w):
        return d.withColumn("seq", F.collect_list("scaled").over(w.rowsBetween(-length, -1)))
    rows = bounded_window(reg, keys, length, build, pos_col="_pos").filter(F.size("seq") == length)
    rows = rows.select(*keys, *[F.col("seq")[i].alias(f"s{i}") for i in range(length)], F.col("scaled").alias("price"))
    feats = [f"s{i}" for i in range(length)]
    model = fit_regressor(rows, feats, "linear")
    return model, reg


def sequence_backtest(regular: DataFrame, keys: Sequence[str] = ("asset",), test_size: float = TEST_SIZE, length: int = SEQ_LEN) -> DataFrame:
    """One day ahead over the last ``test_size`` of each series' windows, by a model of the windows before."""
    rows, feats = _windows(regular, keys, length)
    n = broadcast_if_small(rows.groupBy(*keys).agg(F.max("_at").alias("_n")))
    rows = rows.join(n, list(keys)).withColumn("_test", F.col("_at") > F.floor(F.col("_n") * (1 - test_size)))
    rows = materialize(rows, "sequence-rows")
    model = fit_regressor(rows.filter(~F.col("_test")), feats, "linear")
    pred = model.transform(_assembled(rows.filter("_test"), feats))
    back = lambda c: F.col(c) * (F.col("scaled_max") - F.col("scaled_min")) + F.col("scaled_min")
    return pred.select(*keys, "date", back("price").alias("actual_price"), clip0(back("prediction")).alias("predicted_price"))


def _windows(regular: DataFrame, keys: Sequence[str], length: int) -> tuple[DataFrame, list[str]]:
    """Scaled windows s0 .. and the next value (price), numbered from 1 within their series."""
    from ledgerline.functions.sequence import bounded_window
    keys = list(keys)
    reg = minmax_scale(regular, keys, "price", "scaled").withColumnRenamed("day_index", "_pos")

    def build(d, w):
        return d.withColumn("seq", F.collect_list("scaled").over(w.rowsBetween(-length, -1)))
    rows = bounded_window(reg, keys, length, build, pos_col="_pos").filter(F.size("seq") == length)
    return rows.select(*keys, "date", "scaled_min", "scaled_max", (F.col("_pos") - length).alias("_at"),
                       *[F.col("seq")[i].alias(f"s{i}") for i in range(length)], F.col("scaled").alias("price")), [f"s{i}" for i in range(length)]


def sequence_forecast(model, reg: DataFrame, keys: Sequence[str] = ("asset",), horizon: int = HORIZON,
                      length: int = SEQ_LEN, checkpoint_every: int = CHECKPOINT_EVERY) -> DataFrame:
    keys = list(keys)
    tail = _last_rows(reg, keys, "_pos", length)
    last = tail.groupBy(*keys).agg(F.max("date").alias("last_date"), F.first("scaled_min").alias("lo"),
                                   F.first("scaled_max").alias("hi"),
                                   F.sort_array(F.collect_list(F.struct("_pos", "scaled"))).alias("_t"))
    state = last.select(*keys, "last_date", "lo", "hi", F.transform("_t", lambda e: e["scaled"]).alias("win"))
    feats = [f"s{i}" for i in range(length)]
    outputs = []
    for step in range(1, horizon + 1):
        x = state.select(*keys, "last_date", "lo", "hi", "win", *[F.col("win")[i].alias(f"s{i}") for i in range(length)])
        p = model.transform(_assembled(x, feats)).withColumn("date", F.date_add("last_date", 1))
        p = p.withColumn("forecasted_price", clip0(F.col("prediction") * (F.col("hi") - F.col("lo")) + F.col("lo")))
        p = p.select(*keys, "date", "forecasted_price", "lo", "hi",
                     F.slice(F.concat("win", F.array("prediction")), -length, length).alias("win"))
        p = p.checkpoint(eager=True) if (step % checkpoint_every == 0 or checkpoint_every <= 1) else p.persist()
        outputs.append(p.select(*keys, "date", "forecasted_price", F.lit(step).alias("step")))
        state = p.select(*keys, F.col("date").alias("last_date"), "lo", "hi", "win")
    return _union(outputs).withColumn("model_name", F.lit("lstm"))


# F10
def forecast(df: DataFrame, model_name: str = "all", horizon: int = HORIZON, return_status: bool = False):
    """Forecasts of one model or all of them (union by name). Of all models, one
    that fails while it is fitted or planned is left out with a warning; none left
    -> error. ``return_status`` adds a table (model_name, status, error) with a row per model."""
    names = MODEL_NAMES if model_name == "all" else [model_name]
    bad = [n for n in names if n not in MODEL_NAMES]
    if bad:
        raise ValueError(f"Unknown model(s) {bad}; choose from {MODEL_NAMES + ['all']}")
    frames, status = [], []
    for n in names:
        try:
            frames.append(_forecast_one(df, n, horizon))
            status.append((n, "available", None))
        except Exception as e:  # noqa: BLE001 - the application skips a failing model
            if model_name != "all":
                raise
            warnings.warn(f"no forecast by {n}: {e}", stacklevel=2)
            status.append((n, "failed", str(e)))
    if not frames:
        raise ValueError("No forecasts could be generated")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if return_status:
        return out, df.sparkSession.createDataFrame(status, "model_name string, status string, error string")
    return out


def _forecast_one(df: DataFrame, name: str, horizon: int) -> DataFrame:
    if name == "arima":
        return ar_forecast(df, fit_ar(df), horizon=horizon)
    if name == "prophet":
        return seasonal_forecast(fit_seasonal(df), horizon=horizon)
    if name == "lstm":
        model, reg = fit_sequence_model(df)
        return sequence_forecast(model, reg, horizon=horizon)
    feats_df, fills = model_features(df, return_fills=True)
    fills = broadcast_if_small(fills)  # the medians the training rows were filled with
    feats_df = materialize(feats_df, "model-features")
    feats = feature_columns(feats_df)
    model = fit_regressor(feats_df, feats, "gbt")
    return recursive_forecast(df, model, feats, horizon, medians=fills)


# F12
def held_out_predictions(df: DataFrame, name: str, test_size: float = TEST_SIZE, keys: Sequence[str] = ("asset",),
                         min_rows: int = MIN_SERIES_ROWS, **params) -> DataFrame:
    """Every held-out day with its prediction, as the application evaluates each model: ``arima`` and ``prophet`` are fitted on
    the first part of each regular series and forecast the whole rest of it in one go; ``lstm`` predicts each day of the
    last part of its windows from the days before; ``xgboost`` predicts the rows of the global time split from their features."""
    keys = list(keys)
    if name == "xgboost":
        _, _, pred = model_backtest(df, "gbt", test_size, **params)
        return pred.select(*keys, "date", F.col("price").alias("actual_price"), "predicted_price")
    reg = materialize(regular_calendar(df, keys), "regular-series")
    size = reg.groupBy(*keys).agg(F.max("day_index").alias("_size")).filter(F.col("_size") >= min_rows)
    if name == "lstm":
        return sequence_backtest(reg.join(broadcast_if_small(size.select(*keys)), keys), keys, test_size)
    size = broadcast_if_small(size.select(*keys, F.floor(F.col("_size") * (1 - test_size)).alias("_cut"), "_size"))
    parts = reg.join(size, keys)
    train = parts.filter(F.col("day_index") <= F.col("_cut")).drop("_cut", "_size")
    if name == "arima":
        fit = fit_ar(df, keys, regular=train).join(size, keys)
        fc = ar_forecast(df, fit, keys, F.col("_size") - F.col("_cut"), regular=train)
    else:
        fit = fit_seasonal(df, keys, regular=train).join(size, keys)
        fc = seasonal_forecast(fit, keys, F.col("_size") - F.col("_cut"))
    test = parts.filter(F.col("day_index") > F.col("_cut")).select(*keys, "date", F.col("price").alias("actual_price"))
    return test.join(fc.select(*keys, "date", F.col("forecasted_price").alias("predicted_price")), [*keys, "date"], "left")


def series_model_metrics(df: DataFrame, name: str, test_size: float = TEST_SIZE) -> DataFrame:
    """Metrics of one model over every held-out day, in all and per series."""
    from ledgerline.operators.metrics import evaluate
    return evaluate(held_out_predictions(df, name, test_size)).withColumn("model_name", F.lit(name))
