"""Anomaly detection on FX8 (one spike), flag combination and the forest."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import anomaly as A
from ledgerline.operators.iforest import c_factor, detect_isolation_forest, grow_tree, path_lengths


def fx8(spark):
    prices = [100, 101, 102, 103, 500, 104, 105, 106, 107, 108]
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "Stock A", float(p), i) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "date date, asset string, price double, row_id long")


def test_spike_is_flagged_by_iqr(spark):
    out = A.combine_flags(A.detect_iqr_zscore(fx8(spark))).orderBy("row_id").collect()
    assert [r.is_anomaly_iqr for r in out].count(True) == 1 and out[4].is_anomaly_iqr
    assert out[4].anomaly_method == "IQR" and out[4].anomaly_severity == "low"
    assert out[0].anomaly_method == "None" and out[0].anomaly_severity == "normal"


def test_combine_flags_severity_monotone(spark):
    df = spark.createDataFrame([(a, b, c) for a in (False, True) for b in (False, True) for c in (False, True)],
                               "is_anomaly_iqr boolean, is_anomaly_zscore boolean, is_anomaly_isolation_forest boolean")
    out = A.combine_flags(df).collect()
    order = ["normal", "low", "medium", "high"]
    for r in out:
        assert order.index(r.anomaly_severity) == r.anomaly_method_count
    full = [r for r in out if r.anomaly_method_count == 3][0]
    assert full.anomaly_method == "IQR, Z-Score, Isolation Forest"


def test_summaries(spark):
    flags = A.combine_flags(A.detect_iqr_zscore(fx8(spark)))
    s = A.anomaly_summary(flags).first()
    assert (s.total_records, s.total_anomalies, s.anomaly_rate_percent) == (10, 1, 10.0)
    m = {r.method: r.anomaly_count for r in A.method_summary(flags).collect()}
    assert m == {"IQR": 1, "Z-Score": 0, "Isolation Forest": 0}
    top = A.top_anomalies(flags, 5).collect()
    assert len(top) == 1 and top[0].price == 500.0


def test_tree_isolates_outlier():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (255, 3)), [[8.0, 8.0, 8.0]]])
    depth = 8
    trees = [grow_tree(x, np.random.default_rng(i), depth) for i in range(50)]
    mean_path = np.mean([path_lengths(x, t) for t in trees], axis=0)
    assert mean_path[-1] < np.percentile(mean_path[:-1], 5)
    assert c_factor(256) > c_factor(2) == 1.0


def test_forest_rate_near_contamination(spark):
    rng = np.random.default_rng(1)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i % 300), "A" if i % 2 else "B", float(v), i,
             float(rng.normal())) for i, v in enumerate(rng.normal(100, 5, 1200))]
    df = spark.createDataFrame(rows, "date date, asset string, price double, row_id long, noise double")
    out = detect_isolation_forest(df, features=["price", "noise"], n_trees=50, seed=7)
    rate = out.groupBy("asset").agg(F.avg(F.col("is_anomaly_isolation_forest").cast("double")).alias("r")).collect()
    for r in rate:
        assert abs(r.r - 0.05) <= 0.01
    again = detect_isolation_forest(df, features=["price", "noise"], n_trees=50, seed=7)
    a = {r.row_id: r.anomaly_score for r in out.select("row_id", "anomaly_score").collect()}
    b = {r.row_id: r.anomaly_score for r in again.select("row_id", "anomaly_score").collect()}
    assert a == b  # deterministic for a seed


def test_fx9_anomaly_output_summary(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "Stock A", 100 + i, i == 2) for i in range(5)]
    fx9 = spark.createDataFrame(rows, "date date, asset string, price long, is_anomaly_iqr boolean")
    flags = A.combine_flags(fx9)
    s = A.anomaly_summary(flags).first()
    assert (s.total_records, s.total_anomalies, s.anomaly_rate_percent) == (5, 1, 20.0)
    empty = A.anomaly_summary(flags.limit(0)).first()
    assert (empty.total_records, empty.total_anomalies, empty.anomaly_rate_percent) == (0, 0, 0.0)
    per = A.asset_anomaly_summary(flags).first()
    assert (per.anomaly_count, per.iqr_anomaly_count, per.anomaly_rate_percent) == (1, 1, 20.0)


def test_frozen_scoring_unknown_asset_is_normal(spark):
    from ledgerline.operators.features import series_parameters
    train = fx8(spark)
    params = series_parameters(train, ["asset"], "price")
    state = {"fences": params.drop("_mean", "_std"), "moments": params.select("asset", "_mean", "_std")}
    new = spark.createDataFrame([("2024-02-01", "Stock A", 900.0, 1), ("2024-02-01", "Other", 900.0, 2)],
                                "date string, asset string, price double, row_id long")
    out = {r.asset: r for r in A.score_new_data(new, state, mode="frozen").collect()}
    assert out["Stock A"].is_anomaly_iqr and out["Stock A"].anomaly_severity in ("low", "medium")
    assert not out["Other"].is_anomaly and out["Other"].price_z_score == 0.0


def test_constant_series_has_no_spread(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators.anomaly import detect_zscore
    df = spark.range(100_000).select(F.lit("a").alias("asset"), F.lit(0.1).alias("price")).repartition(8)
    assert detect_zscore(df).where("is_anomaly_zscore or price_z_score <> 0").count() == 0


def test_forest_sample_is_drawn_without_a_lambda(spark):
    """Pairs of row and tree are tried in generated code, and walks by blocks add up to the trees' own paths."""
    from pyspark.sql import functions as F

    from ledgerline.operators.iforest import fit_forest, path_sums
    df = spark.range(900).select(F.lit("a").alias("asset"), F.col("id").alias("row_id"), F.rand(1).alias("p"), F.rand(2).alias("q"))
    state = fit_forest(df, ["asset"], ["p", "q"], n_trees=5, max_samples=64)
    assert "lambda" not in state["trees"]._jdf.queryExecution().optimizedPlan().toString()
    assert [r.psi for r in state["trees"].collect()] == [64] * 5

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    x[5, 1] = np.nan
    trees = [grow_tree(x[6:70], np.random.default_rng(i), 6) for i in range(4)]

    def by_hand(row, tree, at=0):
        feat, thr, left, right, leaf = tree
        return leaf[at] if leaf[at] >= 0 else by_hand(row, tree, left[at] if row[feat[at]] < thr[at] else right[at])
    want = [sum(by_hand(r, t) for t in trees) for r in x]
    assert np.allclose(path_sums(x, trees, block_rows=128), want)
