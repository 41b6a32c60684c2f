"""Skew-safe sequential windows over (series key, order) data.

A plain ``Window.partitionBy(asset)`` puts a whole series into one task; a
series that holds a third of all rows then becomes one giant sort. The
helpers here give identical results with bounded tasks:

* :func:`with_positions` gives every row its exact 1-based position inside
  its series. Rows are range-partitioned on (key, order) - the sampled range
  bounds split a hot series over many partitions - sorted inside each
  partition and numbered with ``monotonically_increasing_id``. A small table
  of (partition, key) counts turns the local numbers into global positions.
  Requires the order columns to be unique within a key (a ``row_id``
  tie-breaker), so recomputation after an executor loss gives equal ids.
* :func:`bounded_window` evaluates windows whose frames look back at most
  ``lookback`` rows. Rows are cut into blocks of ``block_rows`` positions;
  the last ``lookback`` rows of each block are copied into the next block
  ("halo"), the window runs per (key, block), and the copies are dropped.
* :func:`carry_forward` / :func:`carry_backward` are exact forward/backward
  fills (``last_value(ignoreNulls)`` over an unbounded frame) done as a
  segmented scan: per block, then a carry between blocks on a small table.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small

POS = "_pos"
BLOCK = "_block"
HALO = "_halo"
DEFAULT_BLOCK_ROWS = 1 << 20
WINDOW_BLOCK_ROWS = 1 << 15   # least size of a bounded window's block: few series still give every core a share



def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   pos_col: str = POS, num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col``: 1-based row position within ``keys`` ordered by ``order``."""
    keys, order = list(keys), list(order)
    cols = [F.col(c) for c in keys + order]
    # without an explicit count AQE may coalesce small range partitions
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols))
    ranged = (ranged
                .sortWithinPartitions(*keys, *order)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_part", F.shiftright(F.col("_mid"), 33)))
    # Both uses below must see the same ids: persist the ranged rows once.
    ranged = ranged.persist(StorageLevel.MEMORY_AND_DISK)
    stats = ranged.groupBy("_part", *keys).agg(F.min("_mid").alias("_first_mid"),
                                               F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1) if keys else Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_offset", F.coalesce(F.sum("_cnt").over(before), F.lit(0))) \
                   .drop("_cnt")
    # rows of `offsets` <= #range partitions + #keys; checked before broadcast
    offsets = broadcast_if_small(offsets)
    out = ranged.join(offsets, ["_part", *keys], "inner")
    out = out.withColumn(pos_col, F.col("_offset") + F.col("_mid") - F.col("_first_mid") + 1)
    return out.drop("_mid", "_part", "_first_mid", "_offset")


def _halo_blocks(df: DataFrame, lookback: int, block_rows: int, pos_col: str) -> DataFrame:
    """Assign blocks and duplicate the last ``lookback`` rows of each block
    into the following block(s) as halo copies."""
    if lookback >= block_rows:
        raise ValueError("block_rows must exceed the window lookback")
    blk = F.floor((F.col(pos_col) - 1) / block_rows)
    within = (F.col(pos_col) - 1) % block_rows
    targets = F.when(within >= block_rows - lookback,
                     F.array(F.struct(blk.alias("b"), F.lit(False).alias("h")),
                             F.struct((blk + 1).alias("b"), F.lit(True).alias("h")))) \
               .otherwise(F.array(F.struct(blk.alias("b"), F.lit(False).alias("h"))))
    return (df.withColumn("_t", F.explode(targets))
              .withColumn(BLOCK, F.col("_t.b"))
              .withColumn(HALO, F.col("_t.h"))
              .drop("_t"))


def bounded_window(df: DataFrame, keys: Sequence[str], lookback: int,
                   build: Callable[[DataFrame, WindowSpec], DataFrame],
                   pos_col: str = POS, block_rows: int | None = None) -> DataFrame:
    """Run ``build(df, w)`` where ``w`` orders rows of a series by position.

    ``build`` may only use frames that reach at most ``lookback`` rows back
    (``lag(c, k<=lookback)``, ``rowsBetween(-lookback, 0)``), possibly stacked
    as long as the total reach stays within ``lookback``. ``df`` must carry
    ``pos_col`` (see :func:`with_positions`).
    """
    keys = list(keys)
    block_rows = block_rows or max(WINDOW_BLOCK_ROWS, 64 * lookback)
    blocked = _halo_blocks(df, lookback, block_rows, pos_col)
    w = Window.partitionBy(*keys, BLOCK).orderBy(pos_col)
    out = build(blocked, w)
    return out.filter(~F.col(HALO)).drop(BLOCK, HALO)


def _carry(df: DataFrame, keys: Sequence[str], cols: Sequence[str], pos_col: str,
           block_rows: int, forward: bool) -> DataFrame:
    keys, cols = list(keys), list(cols)
    blk = F.floor((F.col(pos_col) - 1) / block_rows)
    df = df.withColumn(BLOCK, blk)
    order = F.col(pos_col) if forward else F.col(pos_col).desc()
    w_in = Window.partitionBy(*keys, BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        df = df.withColumn(c, F.last(c, ignorenulls=True).over(w_in))
    # After the in-block fill the block's edge row holds its carried value;
    # it seeds the following blocks.
    pick = F.max_by if forward else F.min_by
    tails = df.groupBy(*keys, BLOCK).agg(*[
        pick(F.col(c), F.col(pos_col)).alias(f"_tail_{c}") for c in cols])
    blk_order = F.col(BLOCK) if forward else F.col(BLOCK).desc()
    w_blk = (Window.partitionBy(*keys) if keys else Window).orderBy(blk_order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    seeds = tails.select(*keys, BLOCK, *[
        F.last(f"_tail_{c}", ignorenulls=True).over(w_blk).alias(f"_seed_{c}") for c in cols])
    seeds = broadcast_if_small(seeds)
    out = df.join(seeds, [*keys, BLOCK], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_seed_{c}")))
    return out.drop(BLOCK, *[f"_seed_{c}" for c in cols])


def carry_forward(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                  pos_col: str = POS, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Forward fill ``cols`` within each series (exact, block-parallel)."""
    return _carry(df, keys, cols, pos_col, block_rows, forward=True)


def carry_backward(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   pos_col: str = POS, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Backward fill ``cols`` within each series (exact, block-parallel)."""
    return _carry(df, keys, cols, pos_col, block_rows, forward=False)





def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], weights: Sequence[str],
                num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``weights`` within ``keys`` in ``order`` (inclusive),
    exact and without a whole-key task: range partitions (bounded), running
    sums inside each (key, partition), and a small per-(key, partition)
    total table carried forward. ``order`` must be unique within a key."""
    keys, order, weights = list(keys), list(order), list(weights)
    cols = [F.col(c) for c in keys + order]
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols))
    ranged = (ranged.withColumn("_part", F.spark_partition_id())
                .persist(StorageLevel.MEMORY_AND_DISK))  # both uses see one partitioning
    w_local = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_cum_{c}": F.sum(c).over(w_local) for c in weights})
    totals = ranged.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_tot_{c}") for c in weights])
    w_before = (Window.partitionBy(*keys) if keys else Window).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_part", *[
        F.coalesce(F.sum(f"_tot_{c}").over(w_before), F.lit(0)).alias(f"_off_{c}") for c in weights])
    out = local.join(broadcast_if_small(offsets), [*keys, "_part"], "inner")
    out = out.withColumns({f"cum_{c}": F.col(f"_cum_{c}") + F.col(f"_off_{c}") for c in weights})
    return out.drop("_part", *[f"_cum_{c}" for c in weights], *[f"_off_{c}" for c in weights])
