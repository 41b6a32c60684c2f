"""Queries for drift (X*): reference = train part, current = test part of
the time split of the portfolio-shaped prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import cleaning as C
from ledgerline.operators import drift as X
from ledgerline.operators.splits import time_split
from ledgerline.plans.features import round_doubles
from ledgerline.plans.sqlkit import sql_with
from ledgerline.sources import tables as T

NUM = ["asset_value", "portfolio_value", "price", "quantity"]
CAT = ["asset", "asset_name", "asset_type", "portfolio_id"]


def _samples(spark, sf):
    sp = time_split(C.portfolio_adapter(T.prices(spark, sf)))
    return sp.filter(F.col("split") == "train").drop("split"), sp.filter(F.col("split") == "test").drop("split")


def x1_psi(spark, sf):
    ref, cur = _samples(spark, sf)
    return round_doubles(X.psi_table(X.long_numeric(ref, cur, NUM)))


def x3_ks_test(spark, sf):
    ref, cur = _samples(spark, sf)
    return round_doubles(X.ks_table(X.long_numeric(ref, cur, NUM)))


def x4_chi_square(spark, sf):
    ref, cur = _samples(spark, sf)
    return round_doubles(X.chi_square_table(X.long_categorical(ref, cur, CAT)))


def x5_numeric_drift(spark, sf):
    ref, cur = _samples(spark, sf)
    return round_doubles(X.numeric_drift(ref, cur, NUM))


def x6_categorical_drift(spark, sf):
    ref, cur = _samples(spark, sf)
    return round_doubles(X.categorical_drift(ref, cur, CAT))


def x7_target_drift(spark, sf):
    ref, cur = _samples(spark, sf)
    return round_doubles(X.numeric_drift(ref, cur, ["portfolio_value"], with_medians=True, feature_type="target"))


def x8_drift_summary(spark, sf):
    ref, cur = _samples(spark, sf)
    return X.drift_report(ref, cur, NUM, CAT)["summary"]


SRC = (sql_with("prices") + ", pa AS (SELECT *, coalesce(asset, 'nan') AS asset_name, 'stock' AS asset_type, "
       "CAST(1 AS BIGINT) AS quantity, price AS asset_value, 'PORTFOLIO_001' AS portfolio_id FROM prices), "
       "pv AS (SELECT portfolio_id, date, coalesce(sum(asset_value), 0) AS portfolio_value FROM pa GROUP BY ALL), "
       "pb AS (SELECT pa.*, pv.portfolio_value FROM pa LEFT JOIN pv USING (portfolio_id, date)), "
       "rk AS (SELECT *, row_number() OVER (ORDER BY date, row_id) AS pos, count(*) OVER () AS n FROM pb), "
       "sp AS (SELECT *, CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'ref' ELSE 'cur' END AS sample FROM rk)")


def _long(cols, cast):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, sample, CAST({c} AS {cast}) AS value FROM sp" for c in cols)


LNUM = f", lg AS ({_long(NUM, 'DOUBLE')}), v AS (SELECT * FROM lg WHERE value IS NOT NULL)"
PSI = (", q AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, "
       "0.7, 0.8, 0.9, 1.0]))) AS d FROM v WHERE sample = 'ref' GROUP BY feature), "
       "rg AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature), "
       "ed AS (SELECT feature, CASE WHEN len(d) <= 2 THEN list_transform(range(0, 11), lambda i: lo + (hi - lo) * i / 10) "
       "ELSE d END AS edges, lo = hi AS cst FROM q JOIN rg USING (feature)), "
       "b AS (SELECT v.feature, sample, CASE WHEN value >= edges[1] AND value <= edges[-1] THEN "
       "least(len(list_filter(edges, lambda x: x <= value)) - 1, len(edges) - 2) END AS bin FROM v JOIN ed USING (feature)), "
       "nt AS (SELECT feature, count_if(sample = 'ref') AS nr, count_if(sample = 'cur') AS nc FROM b GROUP BY feature), "
       "grid AS (SELECT feature, cst, unnest(range(0, len(edges) - 1)) AS bin FROM ed), "
       "cn AS (SELECT feature, bin, count_if(sample = 'ref') AS cr, count_if(sample = 'cur') AS cc FROM b "
       "WHERE bin IS NOT NULL GROUP BY ALL), "
       "g AS (SELECT grid.feature, grid.cst, coalesce(cr, 0) AS cr, coalesce(cc, 0) AS cc, nr, nc FROM grid "
       "LEFT JOIN cn USING (feature, bin) JOIN nt USING (feature)), "
       "t AS (SELECT feature, cst, CASE WHEN cr / nr = 0 THEN 1e-6 ELSE cr / nr END AS r, "
       "CASE WHEN cc / nc = 0 THEN 1e-6 ELSE cc / nc END AS c FROM g), "
       "psi AS (SELECT feature, CASE WHEN any_value(cst) THEN 0 ELSE sum((c - r) * ln(c / r)) END AS psi "
       "FROM t GROUP BY feature)")
KS = (", per AS (SELECT feature, value, count_if(sample = 'ref') AS wr, count_if(sample = 'cur') AS wc FROM v GROUP BY ALL), "
      "cum AS (SELECT feature, sum(wr) OVER (PARTITION BY feature ORDER BY value) AS cr, sum(wc) OVER (PARTITION BY "
      "feature ORDER BY value) AS cc FROM per), nn AS (SELECT feature, count_if(sample = 'ref') AS nr, "
      "count_if(sample = 'cur') AS nc FROM v GROUP BY feature), st AS (SELECT feature, nr, nc, max(abs(cr / nr - cc / nc)) "
      "AS ks FROM cum JOIN nn USING (feature) GROUP BY ALL), ks AS (SELECT feature, nr, nc, ks, CASE WHEN ks = 0 THEN 1.0 "
      "ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101), lambda k: 2 * pow(-1, k - 1) * exp(-2 * k * k "
      "* pow((sqrt(nr * nc / (nr + nc)) + 0.12 + 0.11 / sqrt(nr * nc / (nr + nc))) * ks, 2)))))) END AS p FROM st)")
STATS = (", sref AS (SELECT feature, avg(value) AS reference_mean, stddev_samp(value) AS reference_std, "
         "count_if(value IS NULL) / count(*) AS reference_missing_rate FROM lg WHERE sample = 'ref' GROUP BY feature), "
         "scur AS (SELECT feature, avg(value) AS current_mean, stddev_samp(value) AS current_std, "
         "count_if(value IS NULL) / count(*) AS current_missing_rate FROM lg WHERE sample = 'cur' GROUP BY feature)")
LEVEL = ("CASE WHEN psi.psi < 0.10 THEN 'no_drift' WHEN psi.psi < 0.25 THEN 'moderate_drift' "
         "ELSE 'significant_drift' END")
NUMSEL = ("round(reference_mean, 6) AS reference_mean, round(reference_std, 6) AS reference_std, "
          "round(reference_missing_rate, 6) AS reference_missing_rate, round(current_mean, 6) AS current_mean, "
          "round(current_std, 6) AS current_std, round(current_missing_rate, 6) AS current_missing_rate, "
          f"round(psi.psi, 6) AS psi, {LEVEL} AS psi_drift_level, round(ks.ks, 6) AS ks_statistic, "
          "round(ks.p, 6) AS ks_p_value, coalesce(ks.p < 0.05, false) AS statistical_drift, "
          "psi.psi >= 0.10 OR coalesce(ks.p < 0.05, false) AS drift_detected")
CHI = (f", lc AS (SELECT feature, sample, coalesce(value, 'missing') AS value FROM ({_long(CAT, 'VARCHAR')})), "
       "cn2 AS (SELECT feature, value, count_if(sample = 'ref') AS o_ref, count_if(sample = 'cur') AS o_cur FROM lc "
       "GROUP BY ALL), tt AS (SELECT feature, sum(o_ref) AS n_ref, sum(o_cur) AS n_cur, count(*) AS k FROM cn2 "
       "GROUP BY feature), cells AS (SELECT feature, k, o_ref, o_cur, n_ref * (o_ref + o_cur) / (n_ref + n_cur) AS e_ref, "
       "n_cur * (o_ref + o_cur) / (n_ref + n_cur) AS e_cur FROM cn2 JOIN tt USING (feature)), "
       "chi AS (SELECT feature, CASE WHEN k <= 1 THEN NULL ELSE sum(pow(CASE WHEN k = 2 THEN greatest(abs(e_ref - o_ref) "
       "- 0.5, 0) ELSE abs(e_ref - o_ref) END, 2) / e_ref + pow(CASE WHEN k = 2 THEN greatest(abs(e_cur - o_cur) - 0.5, 0) "
       "ELSE abs(e_cur - o_cur) END, 2) / e_cur) END AS chi2, k - 1 AS dof FROM cells GROUP BY feature, k)")

LNUM7 = ", lg AS (" + _long(["portfolio_value"], "DOUBLE") + "), v AS (SELECT * FROM lg WHERE value IS NOT NULL)"
MED = (", med AS (SELECT feature, quantile_cont(value, 0.5) FILTER (WHERE sample = 'ref') AS reference_median, "
       "quantile_cont(value, 0.5) FILTER (WHERE sample = 'cur') AS current_median FROM v GROUP BY feature)")

ORACLE = {
    "x7_target_drift": SRC + LNUM7 + PSI + KS + STATS + MED + " SELECT feature, 'target' AS feature_type, " + NUMSEL
                       + ", round(reference_median, 6) AS reference_median, round(current_median, 6) AS current_median, "
                       "round(CASE WHEN reference_mean <> 0 THEN (current_mean - reference_mean) / reference_mean * 100 "
                       "END, 6) AS mean_change_percent FROM sref JOIN scur USING (feature) LEFT JOIN psi USING (feature) "
                       "LEFT JOIN ks USING (feature) LEFT JOIN med USING (feature)",
    "x1_psi": SRC + LNUM + PSI + " SELECT feature, round(psi, 6) AS psi FROM psi",
    "x3_ks_test": SRC + LNUM + KS + " SELECT feature, round(ks, 6) AS ks_statistic, round(p, 6) AS ks_p_value, "
                                    "CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur FROM ks",
    "x4_chi_square": SRC + CHI + " SELECT feature, round(chi2, 6) AS chi2_statistic, dof FROM chi",
    "x5_numeric_drift": SRC + LNUM + PSI + KS + STATS + " SELECT feature, 'numerical' AS feature_type, " + NUMSEL +
                        " FROM sref JOIN scur USING (feature) LEFT JOIN psi USING (feature) LEFT JOIN ks USING (feature)",
}

# the chi-square tail by the series of the lower incomplete gamma function, a = dof / 2, x = statistic / 2
X6_SQL = (SRC + CHI + ", raw AS (" + _long(CAT, "VARCHAR") + "), un AS (SELECT feature, sample, count(DISTINCT value) AS u, "
          "count_if(value IS NULL) / count(*) AS miss, count(*) AS n FROM raw GROUP BY ALL), vc AS (SELECT feature, sample, value, count(*) AS c FROM lc GROUP BY ALL), "
          "tp AS (SELECT feature, sample, value, c FROM vc QUALIFY row_number() OVER (PARTITION BY feature, sample ORDER BY c DESC, value) = 1), "
          "sd AS (SELECT un.feature, un.sample, u, miss, value AS top, c / n AS share FROM un JOIN tp USING (feature, sample)), "
          "pv2 AS (SELECT feature, chi2, CASE WHEN chi2 IS NULL THEN NULL WHEN chi2 <= 0 THEN 1.0 ELSE greatest(0, 1 - exp(dof / 2.0 * ln(chi2 / 2) - chi2 / 2 "
          "- lgamma(dof / 2.0 + 1)) * list_sum(list_transform(range(0, 2000), lambda i: exp(i * ln(chi2 / 2) + lgamma(dof / 2.0 + 1) - lgamma(dof / 2.0 + i + 1))))) "
          "END AS p FROM chi) SELECT a.feature, CAST(a.u AS BIGINT) AS reference_unique_count, round(a.miss, 6) AS reference_missing_rate, a.top AS "
          "reference_top_category, round(a.share, 6) AS reference_top_category_share, CAST(b.u AS BIGINT) AS current_unique_count, round(b.miss, 6) AS "
          "current_missing_rate, b.top AS current_top_category, round(b.share, 6) AS current_top_category_share, round(chi2, 6) AS chi2_statistic, "
          "round(p, 6) AS chi2_p_value, 'categorical' AS feature_type, CAST(abs(b.u - a.u) AS BIGINT) AS category_count_change, coalesce(p < 0.05, false) AS "
          "statistical_drift, a.top IS DISTINCT FROM b.top AS top_category_changed, coalesce(p < 0.05, false) OR a.top IS DISTINCT FROM b.top AS drift_detected "
          "FROM sd a JOIN sd b ON a.feature = b.feature AND a.sample = 'ref' AND b.sample = 'cur' LEFT JOIN pv2 ON pv2.feature = a.feature")
ORACLE["x6_categorical_drift"] = X6_SQL

QUERIES = {
    "x1_psi": x1_psi,
    "x3_ks_test": x3_ks_test,
    "x4_chi_square": x4_chi_square,
    "x5_numeric_drift": x5_numeric_drift,
    "x6_categorical_drift": x6_categorical_drift,
    "x7_target_drift": x7_target_drift,
    "x8_drift_summary": x8_drift_summary,
}
