"""Exact linear-interpolated quantiles per group without whole-group tasks.

``percentile`` keeps every distinct value of a group in one task's memory
during its final merge; a group with a third of all rows does not fit. This
module returns the same numbers (linear interpolation between the values at
ranks floor(h) and floor(h)+1, h = (n-1)p, like numpy's default and SQL
``quantile_cont``) in two passes:

1. per group: ``count`` and ``approx_percentile`` at p +- margin. The GK
   sketch's rank error is at most n/accuracy, so the exact answer's ranks lie
   inside the returned value band. Groups smaller than ``exact_rows`` use an
   unbounded band (the whole group is small).
2. one aggregation keyed by (group, target, value) over rows inside a band,
   plus a per-(group, target) count of rows below the band. The candidate
   table holds at most ~6n/accuracy distinct values per target (or the small
   group), so the final ordered pick runs on bounded data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small

DEFAULT_ACCURACY = 100_000


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, accuracy: int = DEFAULT_ACCURACY,
                    exact_rows: int | None = None, extra: dict | None = None) -> DataFrame:
    """One row per group: ``keys`` + one column per prob (named ``names``)
    with the exact quantile of non-null ``value``; plus ``_n`` (non-null count)
    and the ``extra`` aggregates (name -> aggregate over ``_v``, the value as
    double), computed in the same first pass. Groups without a non-null value are absent."""
    keys = list(keys)
    probs = [float(p) for p in probs]
    names = list(names or [f"q_{i}" for i in range(len(probs))])
    exact_rows = exact_rows or 4 * accuracy
    margin = 3.0 / accuracy
    lo_p = [max(p - margin, 0.0) for p in probs]
    hi_p = [min(p + margin, 1.0) for p in probs]
    v = F.col(value).cast("double")
    data = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull())

    # pass 1: counts and value bands (one small row per group)
    extra = dict(extra or {})
    extra_names = list(extra)
    bands = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.approx_percentile("_v", F.array(*[F.lit(p) for p in lo_p + hi_p]), accuracy).alias("_b"),
        *[agg.alias(name) for name, agg in extra.items()])
    t = len(probs)
    small = F.col("_n") <= exact_rows
    bands = bands.select(
        *keys, "_n", *extra_names,
        F.array(*[F.when(small, F.lit(None).cast("double")).otherwise(F.col("_b")[i])
                  for i in range(t)]).alias("_lo"),
        F.array(*[F.when(small, F.lit(None).cast("double")).otherwise(F.col("_b")[t + i])
                  for i in range(t)]).alias("_hi"))
    bands = broadcast_if_small(bands)

    # pass 2: per (group, target): rows below the band, and value counts inside it
    j = data.join(bands, keys, "inner") if keys else data.crossJoin(bands)
    tgt = F.explode(F.filter(F.sequence(F.lit(0), F.lit(t - 1)), lambda i: (
        F.col("_hi")[i].isNull() | (F.col("_v") <= F.col("_hi")[i])))).alias("_t")
    j = j.select(*keys, "_v", "_lo", tgt)
    below = F.col("_lo")[F.col("_t")].isNotNull() & (F.col("_v") < F.col("_lo")[F.col("_t")])
    cand = (j.select(*keys, "_t", F.when(below, F.lit(None)).otherwise(F.col("_v")).alias("_cv"))
              .groupBy(*keys, "_t", "_cv").agg(F.count(F.lit(1)).alias("_c")))

    targets = bands.select(*keys, "_n", F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("_t", "_p"))
    wide = _picked(cand, targets, keys, names)
    counts = bands.select(*keys, "_n", *extra_names)
    return counts.join(wide, keys, "left") if keys else counts.crossJoin(wide)


def _picked(cand: DataFrame, targets: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The ordered pick on the bounded candidate table (``_t``, value ``_cv`` or null for all below the band, number ``_c``)."""
    t = len(names)
    wk = Window.partitionBy(*keys, "_t").orderBy(F.col("_cv").asc_nulls_first())
    cum = cand.withColumn("_cum", F.sum("_c").over(wk.rowsBetween(Window.unboundedPreceding, 0)))
    targets = targets.withColumn("_h", (F.col("_n") - 1) * F.col("_p")) \
                     .withColumn("_k", F.floor("_h")) \
                     .withColumn("_k2", F.least(F.col("_k") + 1, F.col("_n") - 1)) \
                     .withColumn("_frac", F.col("_h") - F.col("_k"))
    # value at 0-based rank r = first candidate value whose cumulative count > r
    m = cum.filter(F.col("_cv").isNotNull()).join(targets, [*keys, "_t"], "inner")
    picked = m.groupBy(*keys, "_t").agg(
        F.min_by("_cv", F.when(F.col("_cum") > F.col("_k"), F.col("_cum"))).alias("_v1"),
        F.min_by("_cv", F.when(F.col("_cum") > F.col("_k2"), F.col("_cum"))).alias("_v2"),
        F.first("_frac").alias("_frac"))
    picked = picked.withColumn(
        "_q", F.when(F.col("_frac") == 0, F.col("_v1"))
               .otherwise(F.col("_v1") + F.col("_frac") * (F.col("_v2") - F.col("_v1"))))
    wide = picked.groupBy(*keys).pivot("_t", list(range(t))).agg(F.first("_q"))
    return wide.select(*keys, *[F.col(str(i)).alias(names[i]) for i in range(t)])


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     names: Sequence[str] | None = None, **kw) -> DataFrame:
    """Exact quantiles of several columns at once: long form on ``feature``."""
    cols = list(columns)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("_kv")).select("_kv.feature", "_kv.value")
    return group_quantiles(long, ["feature"], "value", probs, names, **kw)


def table_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    names: Sequence[str] | None = None, accuracy: int = DEFAULT_ACCURACY,
                    exact_rows: int | None = None) -> DataFrame:
    """As :func:`column_quantiles`, for many rows and no further aggregates.

    The bands of a whole table's columns are known to every task, so in the second pass only values inside a band
    (or of a column of few values) become rows."""
    cols, probs = list(columns), [float(p) for p in probs]
    names = list(names or [f"q_{i}" for i in range(len(probs))])
    exact_rows = exact_rows or 4 * accuracy
    margin, t, spark = 3.0 / accuracy, len(probs), df.sparkSession
    shares = F.array(*[F.lit(max(p - margin, 0.0)) for p in probs], *[F.lit(min(p + margin, 1.0)) for p in probs])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_kv"))
    v = [F.col(c).cast("double") for c in cols]

    # pass 1: counts and value bands, one row per column
    first = long.select("_kv.feature", "_kv._v").where("_v is not null").groupBy("feature").agg(
        F.count(F.lit(1)).alias("_n"), F.approx_percentile("_v", shares, accuracy).alias("_b")).collect()
    band = {r["feature"]: (r["_n"], r["_b"]) for r in first}
    banded = [c in band and band[c][0] > exact_rows for c in cols]

    # pass 2: per (column, target): rows below the band, and value counts inside it
    items, below = [], []
    for i, x in enumerate(v):
        for k in range(t):
            lo, hi = (F.lit(band[cols[i]][1][k]), F.lit(band[cols[i]][1][t + k])) if banded[i] else (None, None)
            inside = x.isNotNull() & (x >= lo) & (x <= hi) if banded[i] else x.isNotNull()
            items.append(F.when(inside, F.struct(F.lit(cols[i]).alias("feature"), F.lit(k).alias("_t"), x.alias("_cv"))))
            below.append((F.count(F.when(x < lo, 1)) if banded[i] else F.lit(0).cast("long")).alias(f"s{i}_{k}"))
    cand = (df.select(F.explode(F.filter(F.array(*items), lambda z: z.isNotNull())).alias("_z"))
              .select("_z.feature", "_z._t", "_z._cv").groupBy("feature", "_t", "_cv").agg(F.count(F.lit(1)).alias("_c")))
    less = df.agg(*below).first() if any(banded) else None
    rows = [(c, k, None, less[f"s{i}_{k}"]) for i, c in enumerate(cols) if banded[i] for k in range(t) if less[f"s{i}_{k}"]]
    if rows:
        cand = cand.unionByName(spark.createDataFrame(rows, "feature string, _t int, _cv double, _c long"))

    counts = spark.createDataFrame([(c, n) for c, (n, _) in band.items()], "feature string, _n long")
    targets = counts.select("feature", "_n", F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("_t", "_p"))
    return counts.join(_picked(cand, F.broadcast(targets), ["feature"], names), ["feature"], "left")
