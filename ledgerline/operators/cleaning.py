"""Cleaning, coercion, validation and imputation.

All operators are narrow projections/filters except imputation and
winsorizing, which need one small aggregate (medians, modes, quartiles)
that is joined back as a one-row table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.functions.exprs import (asset_type, finite, is_numeric_type, numeric_columns,
                                        slug, standard_name, string_columns, to_datetime,
                                        to_number)
from ledgerline.functions.quantiles import column_quantiles, table_quantiles

# Fixed values of the application
REQUIRED_COLUMNS = ["date", "asset", "price"]
FINANCIAL_NUMERIC = ["price", "quantity", "asset_value", "portfolio_value", "daily_return"]
NON_NEGATIVE = ["price", "quantity", "asset_value", "portfolio_value"]
DEFAULT_PORTFOLIO = "PORTFOLIO_001"
UNKNOWN = "Unknown"


class MissingColumnError(ValueError):
    pass


class EmptyDataError(ValueError):
    pass


# C1
def standardize_columns(df: DataFrame, slash: bool = True) -> DataFrame:
    return df.toDF(*[standard_name(c, slash) for c in df.columns])


# C2
def coerce_dates(df: DataFrame, column: str = "date", as_date: bool = True,
                 drop_invalid: bool = True) -> DataFrame:
    name = standard_name(column)
    if name not in df.columns:
        raise MissingColumnError(f"Date column '{name}' is missing; available: {df.columns}")
    out = df.withColumn(name, to_datetime(F.col(name), as_date))
    return out.filter(F.col(name).isNotNull()) if drop_invalid else out


# C3
def coerce_numeric(df: DataFrame, columns: Sequence[str] = FINANCIAL_NUMERIC) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(F.col(c), is_numeric_type(df, c)) for c in present}) \
        if present else df


# C4
def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumnError(f"Missing required columns: {missing}")
    return df


# C5
def require_rows(df: DataFrame, name: str = "dataframe") -> DataFrame:
    if df.isEmpty():
        raise EmptyDataError(f"{name} is empty")
    return df


# C6
def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


# C7
def clean_prices(df: DataFrame, date_column: str = "date", asset_column: str = "asset",
                 target_column: str = "price", as_date: bool = True, check_empty: bool = True) -> DataFrame:
    """Canonical model-side cleaning: names, required columns, at least one row (unless it is a stream or
    ``check_empty`` is off), coercion, drop rows with a null key or price, keep price >= 0. Asset
    names stay as they are, blanks included."""
    df = standardize_columns(df, slash=False)
    require_columns(df, [date_column, asset_column, target_column])
    if check_empty and not df.isStreaming:
        require_rows(df, "input data")
    date_is_text = dict(df.dtypes)[date_column] == "string"
    df = df.withColumns({
        date_column: to_datetime(F.col(date_column), as_date) if date_is_text or as_date
        else F.col(date_column),
        asset_column: F.col(asset_column).cast("string"),
        target_column: to_number(F.col(target_column), is_numeric_type(df, target_column)),
    })
    return df.filter(F.col(date_column).isNotNull() & F.col(asset_column).isNotNull()
                     & F.col(target_column).isNotNull() & (F.col(target_column) >= 0))


# C8
def with_asset_type(df: DataFrame, name_column: str = "asset_name",
                    out: str = "asset_type") -> DataFrame:
    return df.withColumn(out, asset_type(F.col(name_column)))


def attach_group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Per-group sum joined back to every row. The sum is combined map-side,
    so a hot group costs no more than any other; the (size-checked) joined
    table has one row per group. Rows with a null key get NULL, as a
    dropped group would."""
    keys = list(keys)
    sums = df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))
    sums = sums.na.drop(subset=keys)
    return df.join(broadcast_if_small(sums), keys, "left")


# C9
def portfolio_adapter(df: DataFrame) -> DataFrame:
    """(date, asset, price) -> full portfolio schema."""
    if not {"date", "asset", "price"}.issubset(df.columns):
        return df
    out = df.withColumns({
        "asset_name": F.coalesce(F.col("asset").cast("string"), F.lit("nan")),
        "quantity": F.lit(1).cast("long"),
        "asset_value": to_number(F.col("price"), is_numeric_type(df, "price")),
        "portfolio_id": F.lit(DEFAULT_PORTFOLIO),
    })
    out = with_asset_type(out)
    return attach_group_sum(out, ["portfolio_id", "date"], "asset_value", "portfolio_value")


# C10
def add_default_columns(df: DataFrame) -> DataFrame:
    if "quantity" not in df.columns:
        df = df.withColumn("quantity", F.lit(1).cast("long"))
    if "asset_name" not in df.columns and "asset" in df.columns:
        df = df.withColumn("asset_name", F.coalesce(F.col("asset").cast("string"), F.lit("nan")))
    if "asset_type" not in df.columns:
        df = with_asset_type(df) if "asset_name" in df.columns \
            else df.withColumn("asset_type", F.lit("stock"))
    if "portfolio_id" not in df.columns:
        df = df.withColumn("portfolio_id", F.lit(DEFAULT_PORTFOLIO))
    if "asset_value" not in df.columns and "price" in df.columns:
        df = df.withColumn("asset_value", F.col("price") * F.col("quantity")
                           if "quantity" in df.columns else F.col("price"))
    return df


# C11
def with_portfolio_value(df: DataFrame) -> DataFrame:
    if "portfolio_value" in df.columns or not {"portfolio_id", "date", "asset_value"} <= set(df.columns):
        return df
    return attach_group_sum(df, ["portfolio_id", "date"], "asset_value", "portfolio_value")


# C12
def remove_invalid_rows(df: DataFrame, columns: Sequence[str] = NON_NEGATIVE) -> DataFrame:
    cond = F.lit(True)
    for c in columns:
        if c in df.columns:
            cond = cond & F.coalesce(F.col(c) >= 0, F.lit(False))
    return df.filter(cond)


def one_row_fill(df: DataFrame, fills: DataFrame, cols: Sequence[str]) -> DataFrame:
    """coalesce each column with the value of the one-row ``fills`` table."""
    types = dict(df.dtypes)
    j = df.crossJoin(F.broadcast(fills))  # one row: size bound is 1
    return j.withColumns({c: F.coalesce(F.col(c), F.col(f"_fill_{c}").cast(types[c]))
                          for c in cols}).drop(*[f"_fill_{c}" for c in cols])


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, ``_fill_<c>`` = exact median of each column."""
    q = table_quantiles(df, cols, [0.5], ["median"])
    return q.groupBy().pivot("feature", list(cols)).agg(F.first("median")) \
            .select(*[F.col(c).cast("double").alias(f"_fill_{c}") for c in cols])


# C13
def impute_numeric(df: DataFrame, strategy: str = "median",
                   columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns) if columns is not None else numeric_columns(df)
    if not cols:
        return df
    if strategy == "zero":
        return df.fillna(0, subset=cols)
    if strategy == "mean":
        fills = df.agg(*[F.avg(c).alias(f"_fill_{c}") for c in cols])
    else:
        fills = column_medians(df, cols)
    return one_row_fill(df, fills, cols)


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, ``_fill_<c>`` = most frequent non-null value (ties -> smallest),
    'Unknown' when a column is all null. Counted per (column, value) with
    map-side combine, so no value list is gathered in one place."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]))
        .alias("_kv")).select("_kv.*").filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("feature").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("a"), F.col("value").alias("b"))).alias("mode"))
    wide = modes.groupBy().pivot("feature", list(cols)).agg(F.first("mode"))
    return wide.select(*[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(f"_fill_{c}") for c in cols])


# C14
def impute_categorical(df: DataFrame, strategy: str = "mode",
                       columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        return df
    if strategy == "unknown":
        return df.fillna(UNKNOWN, subset=cols)
    return one_row_fill(df, column_modes(df, cols), cols)


# C15
def winsorize_iqr(df: DataFrame, columns: Sequence[str] | None = None,
                  multiplier: float = 1.5) -> DataFrame:
    cols = list(columns) if columns is not None else numeric_columns(df)
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    q = column_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"])
    fences = q.select("feature", (F.col("q1") - multiplier * (F.col("q3") - F.col("q1"))).alias("lo"),
                      (F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))).alias("hi"),
                      ((F.col("q3") - F.col("q1")) != 0).alias("use"))
    wide = fences.groupBy().pivot("feature", cols).agg(
        F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("use").alias("use"))
    j = df.crossJoin(F.broadcast(wide))  # one row
    out = j.withColumns({
        c: F.when(F.coalesce(F.col(f"{c}_use"), F.lit(False)),
                  F.least(F.greatest(F.col(c), F.col(f"{c}_lo")), F.col(f"{c}_hi"))).otherwise(F.col(c))
        for c in cols})
    return out.select(*df.columns)


# C16
def order_output(df: DataFrame) -> DataFrame:
    keys = [c for c in ("date", "asset_name") if c in df.columns]
    extra = ["row_id"] if "row_id" in df.columns else []
    return df.orderBy(*keys, *extra) if keys else df


# C17
def clean_portfolio(df: DataFrame, cap_outliers: bool = False,
                    required: Sequence[str] = REQUIRED_COLUMNS, check: bool = True) -> DataFrame:
    """Full cleaning flow, in the application's order (portfolio value is
    computed before duplicates and invalid rows are removed)."""
    if check:
        require_rows(df, "raw dataframe")
    df = standardize_columns(df)
    df = coerce_dates(df, "date")
    df = coerce_numeric(df)
    df = portfolio_adapter(df)
    df = add_default_columns(df)
    df = with_portfolio_value(df)
    require_columns(df, required)
    df = drop_duplicate_rows(df)
    df = remove_invalid_rows(df)
    df = impute_numeric(df, "median")
    df = impute_categorical(df, "mode")
    if cap_outliers:
        df = winsorize_iqr(df)
    return df


# C18
def anomalies_only(df: DataFrame, only: bool = True) -> DataFrame:
    return df.filter(F.col("is_anomaly")) if only else df


# C19
def asset_subset(df: DataFrame, assets: Sequence[str] | None, column: str = "asset") -> DataFrame:
    return df.filter(F.col(column).isin(list(assets))) if assets else df


# C20
def normalize_predictions(df: DataFrame, model_name: str | None = None) -> DataFrame:
    """Prediction files in any of the known layouts -> date, asset,
    actual_price, predicted_price, absolute_error."""
    cols = set(df.columns)
    ren = {}
    for src in ("price", "y"):
        if src in cols and "actual_price" not in cols and "actual_price" not in ren.values():
            ren[src] = "actual_price"
    for src in ("forecasted_price", "yhat"):
        if src in cols and "predicted_price" not in cols and "predicted_price" not in ren.values():
            ren[src] = "predicted_price"
    if "ds" in cols and "date" not in cols:
        ren["ds"] = "date"
    out = df.withColumnsRenamed(ren)
    if "asset" not in out.columns:
        out = out.withColumn("asset", F.col("asset_encoded_reference")
                             if "asset_encoded_reference" in out.columns else F.lit(model_name))
    for c in ("actual_price", "predicted_price"):
        if c not in out.columns:
            raise MissingColumnError(f"prediction data has no {c}")
    out = out.withColumns({"actual_price": to_number(F.col("actual_price")),
                           "predicted_price": to_number(F.col("predicted_price"))})
    out = out.filter(F.col("actual_price").isNotNull() & F.col("predicted_price").isNotNull())
    return out.withColumn("absolute_error", F.abs(F.col("actual_price") - F.col("predicted_price")))


# C21
def fill_feature_nulls(df: DataFrame, columns: Sequence[str] | None = None,
                       exclude: Sequence[str] = (), return_fills: bool = False):
    """+-inf -> null -> whole-table column median -> 0. ``return_fills``:
    also return the one-row table of medians (``_fill_<c>``)."""
    cols = list(columns) if columns is not None else numeric_columns(df, exclude)
    if not cols:
        return (df, None) if return_fills else df
    # medians need two passes over the features and the fill a third:
    # materialize the feature table once instead of recomputing its windows
    df = df.withColumns({c: finite(F.col(c)) for c in cols}).persist(StorageLevel.MEMORY_AND_DISK)
    fills = column_medians(df, cols)
    out = one_row_fill(df, fills, cols).fillna(0, subset=cols)
    return (out, fills) if return_fills else out


# C22
def validate_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Record rules: asset trimmed and non-empty, date non-empty, price a
    non-negative number. Returns (valid, rejects); rejects carry the reasons."""
    asset = F.trim(F.col("asset").cast("string"))
    date_txt = F.trim(F.col("date").cast("string"))
    price = to_number(F.col("price"))
    reasons = F.array_compact(F.array(
        F.when(asset.isNull() | (asset == ""), F.lit("asset must not be empty")),
        F.when(date_txt.isNull() | (date_txt == ""), F.lit("date must not be empty")),
        F.when(price.isNull(), F.lit("price must be a number")),
        F.when(price < 0, F.lit("price must be >= 0"))))
    tagged = df.withColumns({"asset": asset, "_reasons": reasons})
    valid = tagged.filter(F.size("_reasons") == 0).drop("_reasons") \
                  .withColumn("price", to_number(F.col("price")))
    rejects = tagged.filter(F.size("_reasons") > 0) \
                    .withColumn("reject_reason", F.concat_ws("; ", "_reasons")).drop("_reasons")
    return valid, rejects


# C23
def with_asset_slug(df: DataFrame, column: str = "asset", out: str = "asset_slug") -> DataFrame:
    return df.withColumn(out, slug(F.col(column)))

