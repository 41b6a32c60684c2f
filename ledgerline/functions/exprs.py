"""Scalar column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def finite(c: Column) -> Column:
    """NaN and +-Inf become NULL (pandas treats them alike; Spark does not)."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def to_number(c: Column, numeric: bool = False) -> Column:
    """Lenient numeric coercion: text that is not a finite number becomes NULL.
    ``numeric=True``: the column already has a number type (no text round trip)."""
    if numeric:
        return finite(c)
    return finite(F.trim(c.cast("string")).try_cast("double"))


def is_numeric_type(df, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NUMERIC_TYPES)


def to_datetime(c: Column, as_date: bool = True) -> Column:
    """Lenient date coercion: unparseable text becomes NULL."""
    s = F.trim(c.cast("string"))
    ts = F.coalesce(F.try_to_timestamp(s), F.try_to_timestamp(s, F.lit("yyyy/MM/dd")),
                    F.try_to_timestamp(s, F.lit("MM/dd/yyyy")))
    return F.to_date(ts) if as_date else ts


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI ``/`` by zero raises)."""
    return F.try_divide(a, b)


def standard_name(name: str, slash: bool = True) -> str:
    """strip, lower, ' ' and '-' (and '/') to '_'."""
    s = name.strip().lower().replace(" ", "_").replace("-", "_")
    return s.replace("/", "_") if slash else s


def slug(c: Column) -> Column:
    """Asset name to a file-safe slug: trim, lower, space / \\ - to '_'."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[ /\\\-]", "_")


# Asset-type rules, checked in this order, first match wins;
# anything else is a stock.
ASSET_TYPE_RULES = [
    ("stock", ["stock", "share", "equity"]),
    ("bond", ["bond"]),
    ("crypto", ["crypto", "bitcoin", "ethereum"]),
    ("fund", ["fund", "etf", "mutual"]),
    ("commodity", ["gold", "silver", "commodity"]),
]
DEFAULT_ASSET_TYPE = "stock"


def asset_type(name: Column) -> Column:
    low = F.lower(F.coalesce(name.cast("string"), F.lit("nan")))
    expr = None
    for label, words in ASSET_TYPE_RULES:
        cond = F.lit(False)
        for w in words:
            cond = cond | low.contains(w)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(DEFAULT_ASSET_TYPE)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in ex]


def r(c: Column | str, digits: int = 6) -> Column:
    """SQL rounding (half-up) used on both sides of every float comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def spread(value, of=F.stddev_samp) -> Column:
    """``of(value)``, exactly 0 where all values are equal: merged partial variances of
    equal values can leave a residue that depends on the partitions."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when((F.min(c) == F.max(c)) & of(c).isNotNull(), F.lit(0.0)).otherwise(of(c))
