"""SQL fragments for the DuckDB oracle, built from the same fixed values the
Spark operators use."""

from __future__ import annotations

from ledgerline.functions.exprs import ASSET_TYPE_RULES, DEFAULT_ASSET_TYPE
from ledgerline.sources.tables import sql_with  # noqa: F401 - re-export


def asset_type_sql(col: str) -> str:
    low = f"lower(coalesce(CAST({col} AS VARCHAR), 'nan'))"
    parts = []
    for label, words in ASSET_TYPE_RULES:
        cond = " OR ".join(f"contains({low}, '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{DEFAULT_ASSET_TYPE}' END"


def r6(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


# dirty_prices with standardized names and coerced values (steps C1-C3)
DIRTY_STD = ("std AS (SELECT \" Date\" AS date, \"Asset\" AS asset, \"Price \" AS price, "
             "\"Row ID\" AS row_id FROM dirty_prices)")
DIRTY_TYPED = ("typed AS (SELECT TRY_CAST(trim(date) AS DATE) AS date, asset, "
               "CASE WHEN isfinite(TRY_CAST(trim(price) AS DOUBLE)) THEN TRY_CAST(trim(price) AS DOUBLE) END AS price, "
               "row_id FROM std)")


def w_clause(keys, order) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"({part}ORDER BY {', '.join(order)})"


def frame(keys, order, n: int) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"({part}ORDER BY {', '.join(order)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def return_sql(target: str, w: str) -> str:
    q = f"{target} / nullif(lag({target}) OVER {w}, 0) - 1"
    return f"coalesce(CASE WHEN isfinite({q}) THEN {q} END, 0)"


def series_feature_sql(src: str, keys, order, target: str, lags, windows, volatility: bool,
                       returns: bool = True) -> str:
    """SELECT of src plus the sequential feature columns (two levels so the
    volatility can use the return)."""
    w = w_clause(keys, order)
    lvl1 = [f"{src}.*"]
    if returns:
        lvl1.append(f"{return_sql(target, w)} AS daily_return")
    for k in lags:
        lvl1.append(f"lag({target}, {k}) OVER {w} AS {target}_lag_{k}")
    for n in windows:
        lvl1.append(f"avg({target}) OVER {frame(keys, order, n)} AS {target}_rolling_mean_{n}")
        lvl1.append(f"stddev_samp({target}) OVER {frame(keys, order, n)} AS {target}_rolling_std_{n}")
    inner = f"SELECT {', '.join(lvl1)} FROM {src}"
    if not (volatility and returns):
        return inner
    vols = [f"stddev_samp(daily_return) OVER {frame(keys, order, n)} AS return_rolling_volatility_{n}"
            for n in windows]
    return f"SELECT s1.*, {', '.join(vols)} FROM ({inner}) s1"


def calendar_sql(date: str = "date", quarter_flags: bool = False) -> str:
    d = f"CAST({date} AS DATE)"
    cols = [f"CAST(year({d}) AS INTEGER) AS year", f"CAST(month({d}) AS INTEGER) AS month",
            f"CAST(quarter({d}) AS INTEGER) AS quarter", f"CAST(day({d}) AS INTEGER) AS day",
            f"CAST(isodow({d}) - 1 AS INTEGER) AS day_of_week",
            f"CAST(weekofyear({d}) AS INTEGER) AS week_of_year",
            f"CAST(day({d}) = 1 AS INTEGER) AS is_month_start",
            f"CAST({d} = last_day({d}) AS INTEGER) AS is_month_end"]
    if quarter_flags:
        qs = f"CAST(date_trunc('quarter', {d}) AS DATE)"
        cols += [f"CAST({d} = {qs} AS INTEGER) AS is_quarter_start",
                 f"CAST({d} = CAST({qs} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS INTEGER) AS is_quarter_end"]
    return ", ".join(cols)


def median_fill_sql(src: str, cols, keep_order) -> str:
    """Fill NULLs of ``cols`` with the column median over ``src`` (then 0)."""
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in cols)
    sel = []
    for c in keep_order:
        sel.append(f"coalesce({c}, med.m_{c}, 0) AS {c}" if c in cols else c)
    return f"SELECT {', '.join(sel)} FROM {src}, (SELECT {meds} FROM {src}) med"
