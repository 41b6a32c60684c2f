"""Time-based splits.

The global split needs each row's rank in (date, row_id) order. A
``row_number()`` without ``partitionBy`` runs in one task; instead the rank
comes from :func:`with_positions` with no series key: range partitioning
spreads even a single hot date over many tasks, and a small
(partition -> offset) table turns local numbers into global ranks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.functions.sequence import POS, with_positions

# Fixed values of the application
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.1
SEED = 42
MIN_SERIES_ROWS = 10


# S4
def check_split_parameters(test_size: float, validation_size: float = 0.0) -> None:
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    if not 0 <= validation_size < 1:
        raise ValueError("validation_size must be between 0 and 1")
    if test_size + validation_size >= 1:
        raise ValueError("test_size + validation_size must be below 1")


def _ranked(df: DataFrame, order: Sequence[str]) -> DataFrame:
    ranked = with_positions(df, [], order)
    total = ranked.agg(F.max(POS).alias("_total"))
    return ranked.crossJoin(F.broadcast(total))  # one row


# S1 / S2
def time_split(df: DataFrame, test_size: float = TEST_SIZE, validation_size: float = 0.0,
               order: Sequence[str] = ("date", "row_id")) -> DataFrame:
    """Adds ``split`` in {train, validation, test}: the first
    int(n*(1-val-test)) rows of the (date, row_id) order are train, up to
    int(n*(1-test)) validation, the rest test."""
    check_split_parameters(test_size, validation_size)
    r = _ranked(df, order)
    train_end = F.floor(F.col("_total") * (1 - validation_size - test_size))
    val_end = F.floor(F.col("_total") * (1 - test_size))
    split = F.when(F.col(POS) <= train_end, "train").when(F.col(POS) <= val_end, "validation") \
             .otherwise("test")
    return r.withColumn("split", split).drop(POS, "_total")


# S3
def shuffled_split(df: DataFrame, test_size: float = TEST_SIZE, validation_size: float = 0.0,
                   seed: int = SEED, row_id: str = "row_id") -> DataFrame:
    """As S1 but over a seeded pseudo-random order (MD5 of "row id:seed", then the row id)."""
    shuf = df.withColumn("_shuffle", F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed)))))
    return time_split(shuf, test_size, validation_size, ["_shuffle", row_id]).drop("_shuffle")


# S5
def series_split(df: DataFrame, keys: Sequence[str] = ("asset",), test_size: float = TEST_SIZE,
                 order: Sequence[str] = ("date", "row_id"),
                 min_rows: int = MIN_SERIES_ROWS) -> DataFrame:
    """Each series cut at int(count*(1-test)) of its own rows; series shorter
    than ``min_rows`` are left out (too short to model)."""
    keys = list(keys)
    ranked = with_positions(df, keys, order)
    counts = broadcast_if_small(ranked.groupBy(*keys).agg(F.max(POS).alias("_cnt")))
    j = ranked.join(counts, keys, "inner").filter(F.col("_cnt") >= min_rows)
    cut = F.floor(F.col("_cnt") * (1 - test_size))
    return j.withColumn("split", F.when(F.col(POS) <= cut, "train").otherwise("test")).drop(POS, "_cnt")


# S6
def split_summary(df: DataFrame, date: str = "date") -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("start_date"),
                                   F.max(date).alias("end_date"))
