"""Size-checked broadcast of small parameter tables."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir, scratch_path

# A parameter table (per-asset fences, bin edges, offsets per range partition,
# fitted coefficients) is broadcast only when its rows and the bytes of its
# rows written as JSON (at least their own width) are at most these. Above
# them the join stays a shuffle join and AQE decides at run time.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def broadcast_if_small(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Materialize ``small`` once, measure it, and hint a broadcast only when it
    is within ``max_rows`` and ``max_bytes``; above them the join stays a shuffle join.

    The table is checkpointed (reliably, to the shared folder named by
    ``spark.checkpoint.dir``): the later join reuses it without recomputing
    it, it survives executor loss, and its lineage is cut - parameter tables
    are built from the data they are joined back to, and without the cut
    every use would carry (and re-plan) the whole upstream plan again."""
    checkpoint_dir(small.sparkSession)
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    n, size = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0))).first()
    fits = n <= max_rows and size <= max_bytes
    # a checked-small table: one partition is enough (later scans of it
    # run one task instead of one per shuffle partition)
    kept = (small.coalesce(1) if fits else small).checkpoint(eager=True)
    small.unpersist()
    return F.broadcast(kept) if fits else kept


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back: cuts lineage before a table with several consumers (the
    reads are column-pruned), and survives executor loss."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
