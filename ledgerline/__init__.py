"""ledgerline: price time-series analytics as Spark DataFrame jobs.

Every public operator is a ``DataFrame -> DataFrame`` function (or returns a
small dict of DataFrames for report-style outputs). The core work runs on
Spark: windows, grouping, joins and shuffles. Python inside executors is
limited to the isolation-forest trainer (<= 256 rows per tree) and scorer
(bounded row chunks), the k x k least-squares solves (one row per series)
and the chi-square p-value (one row per feature).
"""

from ledgerline.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
