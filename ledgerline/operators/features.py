"""Feature engineering.

Sequential features (returns, lags, rolling statistics, sliding sequences)
run through :mod:`ledgerline.functions.sequence`: one range shuffle gives
exact positions, one block shuffle evaluates every window of the feature set
together - all windows share the same (key, block) partitioning, so the plan
has a single Exchange for them. Whole-series statistics (z-scores, fences,
scalers) are grouped aggregates joined back through a size-checked broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.functions.exprs import finite, numeric_columns, safe_div, spread
from ledgerline.functions.quantiles import group_quantiles
from ledgerline.functions.sequence import (DEFAULT_BLOCK_ROWS, POS, bounded_window,
                                           carry_backward, carry_forward, with_positions)
from ledgerline.operators.cleaning import fill_feature_nulls

# Fixed values of the application
LAGS = (1, 3, 7)
MODEL_LAGS = (1, 3, 7, 14)
WINDOWS = (7, 14, 30)
SEQUENCE_LENGTH = 10


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def return_expr(price: str, w: WindowSpec):
    """p / lag(p) - 1; first row, division by zero and +-inf -> 0."""
    return F.coalesce(finite(safe_div(F.col(price), F.lag(price, 1).over(w)) - 1), F.lit(0.0))


# W1-W5 (and W16 when sequence_length is given)
def series_features(df: DataFrame, keys: Sequence[str] = ("asset",),
                    order: Sequence[str] = ("date", "row_id"), target: str = "price",
                    returns: bool = True, lags: Sequence[int] = LAGS,
                    windows: Sequence[int] = WINDOWS, volatility: bool = True,
                    sequence_length: int | None = None, keep_position: bool = False,
                    block_rows: int | None = None) -> DataFrame:
    """Per-series daily return, lags, rolling mean/std (frames include the
    current row, min 1 row; std is the sample one) and rolling std of the
    return. ``order`` must be unique within a series."""
    keys = list(keys)
    if POS not in df.columns:
        df = with_positions(df, keys, order)
    reach = [1 if returns else 0, max(lags, default=0), max(windows, default=1) - 1,
             (max(windows, default=1) if (volatility and returns) else 0),
             sequence_length or 0]
    lookback = max(max(reach), 1)

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        cols = {}
        if returns:
            d = d.withColumn("daily_return", return_expr(target, w))
        for k in lags:
            cols[f"{target}_lag_{k}"] = F.lag(target, k).over(w)
        for n in windows:
            cols[f"{target}_rolling_mean_{n}"] = F.avg(target).over(_frame(w, n))
            cols[f"{target}_rolling_std_{n}"] = F.stddev_samp(target).over(_frame(w, n))
            if volatility and returns:
                cols[f"return_rolling_volatility_{n}"] = F.stddev_samp("daily_return").over(_frame(w, n))
        if sequence_length:
            cols["sequence"] = F.collect_list(target).over(w.rowsBetween(-sequence_length, -1))
        return d.withColumns(cols) if cols else d

    out = bounded_window(df, keys, lookback, build, block_rows=block_rows)
    return out if keep_position else out.drop(POS)


# W6
def calendar_features(df: DataFrame, date: str = "date", quarter_flags: bool = False) -> DataFrame:
    d = F.to_date(F.col(date))
    cols = {
        "year": F.year(d), "month": F.month(d), "quarter": F.quarter(d),
        "day": F.dayofmonth(d), "day_of_week": F.weekday(d), "week_of_year": F.weekofyear(d),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
    }
    if quarter_flags:
        qs = F.trunc(d, "quarter")
        cols["is_quarter_start"] = (d == qs).cast("int")
        cols["is_quarter_end"] = (d == F.date_sub(F.add_months(qs, 3), 1)).cast("int")
    return df.withColumns(cols)


# W7
def asset_features(df: DataFrame) -> DataFrame:
    cols = {}
    if {"asset_value", "portfolio_value"} <= set(df.columns):
        cols["asset_weight"] = F.coalesce(finite(safe_div(F.col("asset_value"), F.col("portfolio_value"))),
                                          F.lit(0.0))
    if {"price", "quantity"} <= set(df.columns):
        cols["price_quantity_interaction"] = F.col("price") * F.col("quantity")
    return df.withColumns(cols) if cols else df


# W8 / J1
def portfolio_day_aggregates(df: DataFrame, group: str = "portfolio_id", date: str = "date",
                             value: str = "asset_value") -> DataFrame:
    """Per (group, date) sum/mean/max/min/count of ``value`` joined back (left)."""
    aggs = df.groupBy(group, date).agg(
        F.sum(value).alias("total_asset_value"), F.avg(value).alias("average_asset_value"),
        F.max(value).alias("max_asset_value"), F.min(value).alias("min_asset_value"),
        F.count(value).alias("asset_count"))
    return df.join(broadcast_if_small(aggs), [group, date], "left")


# W9
def one_hot(df: DataFrame, column: str, drop_first: bool = False, prefix: str | None = None,
            levels: Sequence[str] | None = None) -> DataFrame:
    """One int column per level, named ``{prefix}_{level}`` in level order.
    Levels come from a distinct over the column (a small result) unless given."""
    prefix = prefix or column
    if levels is None:
        levels = [r[0] for r in df.select(column).distinct().orderBy(column).collect()
                  if r[0] is not None]
    use = list(levels)[1:] if drop_first else list(levels)
    return df.withColumns({f"{prefix}_{v}": (F.col(column) == F.lit(v)).cast("int") for v in use})


# W10
def inverse_one_hot(df: DataFrame, prefix: str, out: str) -> DataFrame:
    """Label of the first maximal ``{prefix}_*`` column (idxmax)."""
    cols = [c for c in df.columns if c.startswith(prefix + "_")]
    best = F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])
    expr = None
    for c in cols:
        label = c[len(prefix) + 1:]
        expr = F.when(F.col(c) == best, label) if expr is None else expr.when(F.col(c) == best, label)
    return df.withColumn(out, expr)


# W11
def align_features(df: DataFrame, feature_columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Trained feature order; missing features become 0."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c)
                              for c in feature_columns])


# W12
FOREST_FEATURES = ["price", "daily_return", "price_lag_1", "price_lag_3", "price_lag_7",
                   "price_rolling_mean_7", "price_rolling_std_7", "price_rolling_mean_14",
                   "price_rolling_std_14", "price_rolling_mean_30", "price_rolling_std_30",
                   "return_rolling_volatility_7", "return_rolling_volatility_14",
                   "return_rolling_volatility_30", "month", "quarter", "day_of_week"]


def select_feature_columns(df: DataFrame, target: str = "price", preferred: Sequence[str] | None = None,
                           exclude: Sequence[str] = ("date", "row_id")) -> list[str]:
    num = numeric_columns(df)
    if preferred is not None:
        chosen = [c for c in preferred if c in num]
        if chosen:
            return chosen
        return [c for c in num if c != "year"]
    return [c for c in num if c not in set(exclude) | {target}]


def series_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per-series count, mean, sample and population std (partial aggregates)."""
    return df.groupBy(*keys).agg(F.count(value).alias("_cnt"), F.avg(value).alias("_mean"),
                                 spread(value).alias("_std"),
                                 spread(value, F.stddev_pop).alias("_std_pop"),
                                 F.min(value).alias("_min"), F.max(value).alias("_max"))


# W13
def group_zscore(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                 out: str = "price_z_score") -> DataFrame:
    st = broadcast_if_small(series_stats(df, keys, value).select(*keys, "_mean", "_std"))
    j = df.join(st, list(keys), "left")
    z = F.when((F.col("_std") == 0) | F.col("_std").isNull(), F.lit(0.0)) \
         .otherwise((F.col(value) - F.col("_mean")) / F.col("_std"))
    return j.withColumn(out, z).drop("_mean", "_std")


# W14
def group_fences(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                 multiplier: float = 1.5) -> DataFrame:
    """Per-series q1, q3, iqr and fences (exact, linear interpolation)."""
    q = group_quantiles(df, keys, value, [0.25, 0.75], ["iqr_q1", "iqr_q3"])
    return q.select(*keys, "iqr_q1", "iqr_q3", (F.col("iqr_q3") - F.col("iqr_q1")).alias("iqr_value"),
                    (F.col("iqr_q1") - multiplier * (F.col("iqr_q3") - F.col("iqr_q1"))).alias("iqr_lower_bound"),
                    (F.col("iqr_q3") + multiplier * (F.col("iqr_q3") - F.col("iqr_q1"))).alias("iqr_upper_bound"))


def series_parameters(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                      multiplier: float = 1.5) -> DataFrame:
    """W13 + W14 parameters in one pass: per series mean, sample std and the
    quartile fences (count/mean/std ride along the quantile sketch pass)."""
    q = group_quantiles(df, keys, value, [0.25, 0.75], ["iqr_q1", "iqr_q3"],
                        extra={"_mean": F.avg("_v"), "_std": spread("_v")})
    iqr = F.col("iqr_q3") - F.col("iqr_q1")
    return q.select(*keys, "_mean", "_std", "iqr_q1", "iqr_q3", iqr.alias("iqr_value"),
                    (F.col("iqr_q1") - multiplier * iqr).alias("iqr_lower_bound"),
                    (F.col("iqr_q3") + multiplier * iqr).alias("iqr_upper_bound"))


def with_group_fences(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                      multiplier: float = 1.5) -> DataFrame:
    f = broadcast_if_small(group_fences(df, keys, value, multiplier))
    return df.join(f, list(keys), "left")


# W15
def regular_calendar(df: DataFrame, keys: Sequence[str] = ("asset",), date: str = "date",
                     value: str = "price", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Daily mean per (series, day), one row per calendar day from the
    series' first to last day, gaps filled forward then backward."""
    keys = list(keys)
    daily = df.groupBy(*keys, F.to_date(F.col(date)).alias(date)).agg(F.avg(value).alias(value))
    span = daily.groupBy(*keys).agg(F.min(date).alias("_d0"), F.max(date).alias("_d1"))
    # one generated row per calendar day; position = day offset + 1 (exact, no sort needed)
    days = span.select(*keys, "_d0", F.explode(F.sequence(F.col("_d0"), F.col("_d1"))).alias(date))
    grid = days.join(daily, [*keys, date], "left") \
               .withColumn(POS, F.datediff(F.col(date), F.col("_d0")) + 1).drop("_d0")
    filled = carry_forward(grid, keys, [value], block_rows=block_rows)
    filled = carry_backward(filled, keys, [value], block_rows=block_rows)
    return filled.select(*keys, date, value, F.col(POS).cast("long").alias("day_index"))


# W17
def minmax_scale(df: DataFrame, keys: Sequence[str] = ("asset",), value: str = "price",
                 out: str = "scaled") -> DataFrame:
    st = broadcast_if_small(series_stats(df, keys, value).select(*keys, "_min", "_max"))
    j = df.join(st, list(keys), "left")
    rng = F.col("_max") - F.col("_min")
    return j.withColumn(out, F.when(rng == 0, F.lit(0.0)).otherwise((F.col(value) - F.col("_min")) / rng)) \
            .withColumnsRenamed({"_min": f"{out}_min", "_max": f"{out}_max"})



# W18
def standard_scale(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per-series (x - mean) / population std; std 0 -> 1."""
    keys = list(keys)
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"_m_{c}"), spread(c, F.stddev_pop).alias(f"_s_{c}")]
    st = broadcast_if_small(df.groupBy(*keys).agg(*aggs))
    j = df.join(st, keys, "left")
    j = j.withColumns({c: (F.col(c) - F.col(f"_m_{c}")) /
                       F.when((F.col(f"_s_{c}") == 0) | F.col(f"_s_{c}").isNull(), F.lit(1.0))
                        .otherwise(F.col(f"_s_{c}")) for c in columns})
    return j.drop(*[f"_m_{c}" for c in columns], *[f"_s_{c}" for c in columns])


# W19
def sequential_rank(df: DataFrame, metric: str, ascending: bool = True, tie: str = "model_name",
                    out: str = "rank") -> DataFrame:
    """1..n by metric among rows with a metric; rows without one get NULL.
    Used on small result tables (one row per model)."""
    o = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.orderBy(o, F.col(tie))
    have = df.filter(F.col(metric).isNotNull()).withColumn(out, F.row_number().over(w).cast("double"))
    rest = df.filter(F.col(metric).isNull()).withColumn(out, F.lit(None).cast("double"))
    return have.unionByName(rest)


# W20
def first_last(df: DataFrame, keys: Sequence[str] = ("asset",), order: Sequence[str] = ("date", "row_id"),
               last: bool = False) -> DataFrame:
    """The first (or last) row of each series: an aggregate, no sort of the series."""
    keys = list(keys)
    ordkey = F.struct(*[F.col(c) for c in order])
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*others), ordkey).alias("_r")).select(*keys, "_r.*")


def nullable_columns(target: str, lags: Sequence[int], windows: Sequence[int],
                     volatility: bool) -> list[str]:
    """Feature columns that can be NULL (first rows of a series); the
    null policy only needs medians of these - the rest are never NULL."""
    cols = [f"{target}_lag_{k}" for k in lags] + [f"{target}_rolling_std_{n}" for n in windows]
    return cols + ([f"return_rolling_volatility_{n}" for n in windows] if volatility else [])


# W21 (a): the portfolio feature set, grouped by portfolio
def portfolio_features(df: DataFrame, group: str = "portfolio_id", target: str = "price",
                       encode: bool = False, block_rows: int | None = None) -> DataFrame:
    order = ["date"] + [c for c in ("asset_name", "row_id") if c in df.columns]
    out = series_features(df, [group], order, target, lags=LAGS, windows=WINDOWS,
                          volatility=False, block_rows=block_rows)
    out = calendar_features(out)
    out = asset_features(out)
    out = portfolio_day_aggregates(out, group)
    if encode:
        for c in ("asset", "asset_name", "asset_type"):
            if c in out.columns:
                out = one_hot(out, c, drop_first=True)
    return fill_feature_nulls(out, nullable_columns(target, LAGS, WINDOWS, False))


# W21 (b): boosted-model features
def model_features(df: DataFrame, keys: Sequence[str] = ("asset",), target: str = "price",
                   one_hot_assets: bool = True, block_rows: int | None = None,
                   return_fills: bool = False):
    """Only the series' own columns are shuffled and kept for the medians; calendar and asset columns follow, row by row."""
    out = series_features(df, keys, ("date", "row_id"), target, lags=MODEL_LAGS, windows=WINDOWS,
                          volatility=True, block_rows=block_rows)
    first, last = ([c for c in out.columns if (c in df.columns) == own] for own in (True, False))
    out, fills = fill_feature_nulls(out, nullable_columns(target, MODEL_LAGS, WINDOWS, True), return_fills=True)
    out = calendar_features(out, quarter_flags=True)
    calendar = [c for c in out.columns if c not in first + last]
    out = out.select(*first, *calendar, *last)
    if one_hot_assets:
        levels = [r[0] for r in df.select(keys[0]).distinct().orderBy(keys[0]).collect() if r[0] is not None]
        out = one_hot(out, keys[0], drop_first=False, prefix="asset", levels=levels)
    return (out, fills) if return_fills else out


# W21 (c): anomaly features
def anomaly_features(df: DataFrame, keys: Sequence[str] = ("asset",), target: str = "price",
                     block_rows: int | None = None) -> DataFrame:
    out = series_features(df, keys, ("date", "row_id"), target, lags=LAGS, windows=WINDOWS,
                          volatility=True, block_rows=block_rows)
    out = calendar_features(out)
    return fill_feature_nulls(out, nullable_columns(target, LAGS, WINDOWS, True))
