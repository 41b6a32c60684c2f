"""Drift between a reference and a current sample.

Both samples are brought into one long table (feature, sample, value), so
every statistic is a grouped aggregate over all features at once; bin edges
and per-feature parameters are small tables joined back through a
size-checked broadcast.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.functions.exprs import numeric_columns, spread, string_columns
from ledgerline.functions.quantiles import group_quantiles
from ledgerline.functions.sequence import prefix_sums

# Fixed values of the application
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
P_VALUE = 0.05
BINS = 10
EPSILON = 1e-6
MISSING = "missing"
KS_TERMS = 100
EXACT_KS_ROWS = 10_000   # the size up to which the application's library is exact too


def long_numeric(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    def one(df, tag):
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
            .alias("_kv")).select(F.lit(tag).alias("sample"), "_kv.*")
    return one(ref, "ref").unionByName(one(cur, "cur"))


# X2
def psi_level(psi):
    return F.when(psi.isNull() | (psi < PSI_MODERATE), "no_drift").when(psi < PSI_SIGNIFICANT, "moderate_drift") \
            .otherwise("significant_drift")


# X1
def psi_table(long: DataFrame, bins: int = BINS, epsilon: float = EPSILON) -> DataFrame:
    """PSI per feature: edges = distinct reference quantiles at 0, 1/bins, ..,
    1; two or fewer distinct -> ``bins`` equal bins over the joint range
    (constant -> 0). Bins are [a, b) with the last one closed; values outside
    the edges are not counted but stay in the denominator."""
    vals = long.filter(F.col("value").isNotNull())
    probs = [i / bins for i in range(bins + 1)]
    q = group_quantiles(vals.filter(F.col("sample") == "ref"), ["feature"], "value", probs,
                        [f"p{i}" for i in range(bins + 1)])
    rng = vals.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    e = q.join(rng, "feature", "inner")
    distinct = F.array_distinct(F.array(*[F.col(f"p{i}") for i in range(bins + 1)]))
    lin = F.transform(F.sequence(F.lit(0), F.lit(bins)),
                      lambda i: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * i / bins)
    edges = e.select("feature", F.when(F.size(distinct) <= 2, lin).otherwise(distinct).alias("edges"),
                     (F.col("_lo") == F.col("_hi")).alias("_const"))
    edges = broadcast_if_small(edges)
    j = vals.join(edges, "feature", "inner")
    nb = F.size("edges") - 1
    inside = (F.col("value") >= F.col("edges")[0]) & (F.col("value") <= F.element_at("edges", -1))
    b = F.least(F.size(F.filter("edges", lambda x: x <= F.col("value"))) - 1, nb - 1)
    counts = j.withColumn("_bin", F.when(inside, b)).groupBy("feature", "sample", "_bin").agg(
        F.count(F.lit(1)).alias("_c"))
    totals = counts.groupBy("feature", "sample").agg(F.sum("_c").alias("_n"))
    grid = edges.select("feature", "_const", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("_bin"))
    c_in = counts.filter(F.col("_bin").isNotNull())
    pivot = c_in.groupBy("feature", "_bin").agg(
        F.sum(F.when(F.col("sample") == "ref", F.col("_c")).otherwise(0)).alias("_cr"),
        F.sum(F.when(F.col("sample") == "cur", F.col("_c")).otherwise(0)).alias("_cc"))
    tot = totals.groupBy("feature").agg(
        F.sum(F.when(F.col("sample") == "ref", F.col("_n"))).alias("_nr"),
        F.sum(F.when(F.col("sample") == "cur", F.col("_n"))).alias("_nc"))
    g = grid.join(pivot, ["feature", "_bin"], "left").join(tot, "feature", "inner").fillna(0, ["_cr", "_cc"])
    r = F.col("_cr") / F.col("_nr")
    c = F.col("_cc") / F.col("_nc")
    r = F.when(r == 0, F.lit(epsilon)).otherwise(r)
    c = F.when(c == 0, F.lit(epsilon)).otherwise(c)
    term = (c - r) * F.log(c / r)
    out = g.groupBy("feature").agg(F.sum(term).alias("_psi"), F.first("_const").alias("_const"))
    psi = F.when(F.col("_const"), F.lit(0.0)).otherwise(F.col("_psi"))
    sides = vals.groupBy("feature").agg(F.count_distinct("sample").alias("_sides"))
    # a feature without values on one side has nothing to compare: PSI 0
    return sides.join(out.select("feature", psi.alias("psi")), "feature", "left") \
                .select("feature", F.when(F.col("_sides") < 2, F.lit(0.0)).otherwise(F.col("psi")).alias("psi"))


# X3
def ks_table(long: DataFrame) -> DataFrame:
    """Two-sample KS statistic per feature (max |F_ref - F_cur| over the
    merged values) and its p-value: exact where neither sample has more than ``EXACT_KS_ROWS`` values, asymptotic above."""
    vals = long.filter(F.col("value").isNotNull())
    per = vals.groupBy("feature", "value").agg(
        F.count_if(F.col("sample") == "ref").alias("w_ref"), F.count_if(F.col("sample") == "cur").alias("w_cur"))
    cum = prefix_sums(per, ["feature"], ["value"], ["w_ref", "w_cur"])
    n = vals.groupBy("feature").agg(F.count_if(F.col("sample") == "ref").alias("n_ref"),
                                    F.count_if(F.col("sample") == "cur").alias("n_cur"))
    j = cum.join(broadcast_if_small(n), "feature", "inner")
    # no values on one side: null statistic and p-value
    d = F.abs(F.try_divide("cum_w_ref", "n_ref") - F.try_divide("cum_w_cur", "n_cur"))
    stat = j.groupBy("feature", "n_ref", "n_cur").agg(F.max(d).alias("ks_statistic"))
    ne = F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    lam = (F.sqrt(ne) + 0.12 + F.try_divide(F.lit(0.11), F.sqrt(ne))) * F.col("ks_statistic")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
                         lambda acc, k: acc + 2 * F.pow(F.lit(-1.0), k - 1) * F.exp(-2 * k * k * lam * lam))
    p = F.when(F.col("ks_statistic") == 0, F.lit(1.0)).when(
        F.col("ks_statistic").isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    small = F.greatest("n_ref", "n_cur") <= EXACT_KS_ROWS
    exact = exact_ks_p_value(F.when(small, F.col("ks_statistic")), F.col("n_ref"), F.col("n_cur"))   # one row per feature
    return stat.select("feature", "ks_statistic", F.when(small, exact).otherwise(p).alias("ks_p_value"), "n_ref", "n_cur")


def ks_exact(stat: float, n: int, m: int) -> float:
    """P(D >= stat) for two samples of n and m values without ties: the share of lattice paths from (0, 0) to (n, m) that
    touch |i/n - j/m| >= stat. ``b`` goes from one anti-diagonal to the next; a path to (i, j) came from
    (i - 1, j) with probability i / (i + j)."""
    h = round(stat * n * m)                                   # the statistic is a whole number of 1/(n m)
    if h <= 0:
        return 1.0
    b = np.zeros(1)                                           # places (i, s - i), i from lo
    lo = 0
    for s in range(1, n + m + 1):
        low, high = max(0, s - m), min(n, s)
        i = np.arange(low, high + 1)
        wide = np.zeros(high - low + 3)                       # the last diagonal at i - 1 .. i
        at = lo - (low - 1)
        wide[at:at + len(b)] = b
        b = (i * wide[:len(i)] + (s - i) * wide[1:len(i) + 1]) / s
        b[np.abs(i * m - (s - i) * n) >= h] = 1.0
        lo = low
    return float(min(b[0], 1.0))


@F.pandas_udf(T.DoubleType())
def exact_ks_p_value(stat: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(d) or not a or not b else ks_exact(float(d), int(a), int(b)) for d, a, b in zip(stat, n, m)], dtype=float)


def _gammaincc(a: float, x: float) -> float:
    """Upper regularized gamma Q(a, x) (series for x < a + 1, else a
    continued fraction)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1:
        s, term, ap = 1.0 / a, 1.0 / a, a
        for _ in range(1000):
            ap += 1
            term *= x / ap
            s += term
            if abs(term) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    b, c, d = x + 1 - a, 1e300, 1.0 / (x + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


@F.pandas_udf(T.DoubleType())
def chi2_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Survival function of the chi-square distribution (one row per feature)."""
    return pd.Series([None if (s is None or pd.isna(s) or d is None or pd.isna(d) or d <= 0)
                      else _gammaincc(float(d) / 2.0, float(s) / 2.0) for s, d in zip(stat, dof)])


def long_categorical(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    def one(df, tag):
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]))
            .alias("_kv")).select(F.lit(tag).alias("sample"), "_kv.*")
    return one(ref, "ref").unionByName(one(cur, "cur"))


# X4
def chi_square_table(long: DataFrame) -> DataFrame:
    """Chi-square statistic of the 2 x k table of category counts (null ->
    'missing'); k <= 1 -> NULL; Yates' correction when k = 2."""
    counts = long.withColumn("value", F.coalesce("value", F.lit(MISSING))).groupBy("feature", "value").agg(
        F.count_if(F.col("sample") == "ref").alias("o_ref"), F.count_if(F.col("sample") == "cur").alias("o_cur"))
    tot = counts.groupBy("feature").agg(F.sum("o_ref").alias("n_ref"), F.sum("o_cur").alias("n_cur"),
                                        F.count(F.lit(1)).alias("k"))
    j = counts.join(broadcast_if_small(tot), "feature", "inner")
    n = F.col("n_ref") + F.col("n_cur")

    def cell(o, rowtot):
        e = rowtot * (F.col("o_ref") + F.col("o_cur")) / n
        diff = F.abs(e - o)
        adj = F.when(F.col("k") == 2, F.greatest(diff - 0.5, F.lit(0.0))).otherwise(diff)
        return adj * adj / e
    stat = j.groupBy("feature", "k").agg(F.sum(cell(F.col("o_ref"), F.col("n_ref")) +
                                               cell(F.col("o_cur"), F.col("n_cur"))).alias("_s"))
    return stat.select("feature", F.when(F.col("k") <= 1, F.lit(None).cast("double")).otherwise(F.col("_s"))
                       .alias("chi2_statistic"), (F.col("k") - 1).alias("dof"))


# X5 / X7
def numeric_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None,
                  bins: int = BINS, with_medians: bool = False, feature_type: str = "numerical") -> DataFrame:
    cols = list(columns) if columns is not None else sorted(set(numeric_columns(ref)) & set(numeric_columns(cur)))
    long = long_numeric(ref, cur, cols)

    def side(tag):
        s = long.filter(F.col("sample") == tag).groupBy("feature").agg(
            F.avg("value").alias(f"{tag}_mean"), spread("value").alias(f"{tag}_std"),
            (F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias(f"{tag}_missing_rate"))
        if with_medians:
            med = group_quantiles(long.filter(F.col("sample") == tag), ["feature"], "value", [0.5],
                                  [f"{tag}_median"]).drop("_n")
            s = s.join(med, "feature", "left")
        return s
    stats = side("ref").join(side("cur"), "feature", "outer")
    stats = stats.select("feature", *[F.col(c).alias(c.replace("ref_", "reference_").replace("cur_", "current_"))
                                      for c in stats.columns if c != "feature"])
    out = stats.join(psi_table(long, bins), "feature", "left").join(ks_table(long).drop("n_ref", "n_cur"),
                                                                   "feature", "left")
    stat_drift = F.coalesce(F.col("ks_p_value") < P_VALUE, F.lit(False))
    out = out.withColumns({
        "feature_type": F.lit(feature_type), "psi_drift_level": psi_level(F.col("psi")),
        "statistical_drift": stat_drift,
        "drift_detected": (F.col("psi") >= PSI_MODERATE) | stat_drift})
    out = out.withColumn("psi", F.round("psi", 6))
    if with_medians:
        m0 = F.col("reference_mean")
        out = out.withColumn("mean_change_percent",
                             F.when((m0 != 0) & m0.isNotNull(), (F.col("current_mean") - m0) / m0 * 100))
    return out


# X6
def categorical_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = list(columns) if columns is not None else sorted(set(string_columns(ref)) & set(string_columns(cur)))
    long = long_categorical(ref, cur, cols)

    def side(tag):
        d = long.filter(F.col("sample") == tag)
        uniq = d.groupBy("feature").agg(F.count_distinct("value").alias(f"{tag}_unique_count"),
                                        (F.count_if(F.col("value").isNull()) / F.count(F.lit(1)))
                                        .alias(f"{tag}_missing_rate"), F.count(F.lit(1)).alias("_n"))
        vc = d.withColumn("value", F.coalesce("value", F.lit(MISSING))).groupBy("feature", "value") \
              .agg(F.count(F.lit(1)).alias("_c"))
        top = vc.groupBy("feature").agg(F.min_by(F.struct("value", "_c"), F.struct((-F.col("_c")).alias("a"),
                                                                                   F.col("value").alias("b")))
                                        .alias("_t"))
        j = uniq.join(top, "feature", "left")
        return j.select("feature", f"{tag}_unique_count", f"{tag}_missing_rate",
                        F.col("_t.value").alias(f"{tag}_top_category"),
                        (F.col("_t._c") / F.col("_n")).alias(f"{tag}_top_category_share"))
    s = side("ref").join(side("cur"), "feature", "outer")
    s = s.select("feature", *[F.col(c).alias(c.replace("ref_", "reference_").replace("cur_", "current_"))
                              for c in s.columns if c != "feature"])
    chi = chi_square_table(long)
    chi = chi.withColumn("chi2_p_value", chi2_p_value(F.col("chi2_statistic"), F.col("dof").cast("double")))
    out = s.join(chi.drop("dof"), "feature", "left")
    stat_drift = F.coalesce(F.col("chi2_p_value") < P_VALUE, F.lit(False))
    changed = ~F.col("reference_top_category").eqNullSafe(F.col("current_top_category"))
    return out.withColumns({
        "feature_type": F.lit("categorical"),
        "category_count_change": F.abs(F.col("current_unique_count") - F.col("reference_unique_count")),
        "statistical_drift": stat_drift, "top_category_changed": changed,
        "drift_detected": stat_drift | changed})


# X8
def drift_report(ref: DataFrame, cur: DataFrame, numerical: Sequence[str] | None = None,
                 categorical: Sequence[str] | None = None, target: str | None = "portfolio_value") -> dict:
    parts = [numeric_drift(ref, cur, numerical), categorical_drift(ref, cur, categorical)]
    if target and target in ref.columns and target in cur.columns:
        parts.append(numeric_drift(ref, cur, [target], with_medians=True, feature_type="target"))
    records = parts[0]
    for p in parts[1:]:
        records = records.unionByName(p, allowMissingColumns=True)
    summary = records.agg(
        F.count(F.lit(1)).alias("total_features_checked"),
        F.count_if("drift_detected").alias("drifted_feature_count"),
        F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted_features"),
        (F.count_if("drift_detected") > 0).alias("drift_detected"))
    rows = ref.agg(F.count(F.lit(1)).alias("reference_rows")).crossJoin(cur.agg(F.count(F.lit(1)).alias("current_rows")))
    return {"records": records, "summary": summary.crossJoin(rows)}
