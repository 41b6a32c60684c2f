"""Metrics on FX11 and drift invariants (FX21, FX22)."""

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import drift as X
from ledgerline.operators import metrics as M


def test_fx11_metrics(spark):
    y = [100.0, 120.0, 130.0, 150.0, 170.0]
    p = [98.0, 125.0, 128.0, 148.0, 175.0]
    df = spark.createDataFrame(list(zip(y, p)), "actual_price double, predicted_price double")
    r = M.metric_set(df).first()
    ya, pa = np.array(y), np.array(p)
    e = ya - pa
    assert r.mae == round(np.mean(np.abs(e)), 6)
    assert r.rmse == round(float(np.sqrt(np.mean(e * e))), 6)
    assert r.mape == round(float(np.mean(np.abs(e / ya)) * 100), 6)
    assert abs(r.r2_score - (1 - np.sum(e * e) / np.sum((ya - ya.mean()) ** 2))) < 1e-6


def test_r2_constant_target(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "actual_price double, predicted_price double")
    assert M.metric_set(df).first().r2_score == 1.0
    df2 = spark.createDataFrame([(5.0, 4.0), (5.0, 5.0)], "actual_price double, predicted_price double")
    assert M.metric_set(df2).first().r2_score == 0.0


def test_comparison_and_best_with_missing_model(spark):
    avg = spark.createDataFrame([("a", 1.0, 1.0, 2.0, 1.0, 1.0, 0.5, 3, "x"), ("b", 1.0, 1.0, 1.0, 1.0, 1.0, 0.6, 3, "x")],
                                "model_name string, mae double, mse double, rmse double, mape double, smape double, "
                                "r2_score double, trained_asset_count long, trained_assets string")
    cmp = {r.model_name: r for r in M.comparison_table(avg, ["a", "b", "c"]).collect()}
    assert cmp["b"].rank == 1.0 and cmp["a"].rank == 2.0 and cmp["c"].rank is None
    assert cmp["c"].status == "missing"
    assert M.best_model(M.comparison_table(avg, ["a", "b", "c"])).first().best_model == "b"


def _long(spark, ref, cur):
    r = spark.createDataFrame([(float(v),) for v in ref], "x double")
    c = spark.createDataFrame([(float(v),) for v in cur], "x double")
    return r, c, X.long_numeric(r, c, ["x"])


def test_psi_ks_identical_zero(spark):
    vals = list(np.random.default_rng(2).normal(size=400))
    _, _, lg = _long(spark, vals, vals)
    assert abs(X.psi_table(lg).first().psi) < 1e-12
    ks = X.ks_table(lg).first()
    assert ks.ks_statistic == 0.0 and ks.ks_p_value == 1.0


def test_psi_matches_numpy_and_shift_detected(spark):
    rng = np.random.default_rng(4)
    ref, cur = rng.normal(0, 1, 500), rng.normal(0.8, 1, 300)
    _, _, lg = _long(spark, ref, cur)
    bp = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    rc, _ = np.histogram(ref, bp)
    cc, _ = np.histogram(cur, bp)
    rp, cp = rc / len(ref), cc / len(cur)
    rp, cp = np.where(rp == 0, 1e-6, rp), np.where(cp == 0, 1e-6, cp)
    exp = float(np.sum((cp - rp) * np.log(cp / rp)))
    assert abs(X.psi_table(lg).first().psi - exp) < 1e-9
    d = np.max(np.abs(np.searchsorted(np.sort(ref), np.sort(np.concatenate([ref, cur])), side="right") / 500
                      - np.searchsorted(np.sort(cur), np.sort(np.concatenate([ref, cur])), side="right") / 300))
    assert abs(X.ks_table(lg).first().ks_statistic - d) < 1e-12


def test_psi_constant_is_zero(spark):
    _, _, lg = _long(spark, [3.0] * 20, [3.0] * 10)
    assert X.psi_table(lg).first().psi == 0.0


def test_chi_square_yates(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 20, "c string")
    cur = spark.createDataFrame([("a",)] * 10 + [("b",)] * 30, "c string")
    r = X.chi_square_table(X.long_categorical(ref, cur, ["c"])).first()
    obs = np.array([[30, 20], [10, 30]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    adj = np.maximum(np.abs(obs - e) - 0.5, 0)
    assert abs(r.chi2_statistic - float(np.sum(adj ** 2 / e))) < 1e-9 and r.dof == 1
    one = X.chi_square_table(X.long_categorical(ref.filter("c = 'a'"), cur.filter("c = 'a'"), ["c"])).first()
    assert one.chi2_statistic is None
    p = X.categorical_drift(ref, cur, ["c"]).first()
    assert 0 <= p.chi2_p_value < 0.05 and p.drift_detected
    assert F is not None


def test_drift_report_summary(spark):
    rng = np.random.default_rng(9)
    ref = spark.createDataFrame([(float(v), "a" if v > 0 else "b", float(v) * 2) for v in rng.normal(0, 1, 300)],
                                "x double, c string, portfolio_value double")
    cur = spark.createDataFrame([(float(v), "a", float(v) * 2) for v in rng.normal(2, 1, 200)],
                                "x double, c string, portfolio_value double")
    rep = X.drift_report(ref, cur, ["x"], ["c"])
    s = rep["summary"].first()
    assert s.reference_rows == 300 and s.current_rows == 200
    assert s.total_features_checked == 3 and s.drift_detected
    assert "x" in s.drifted_features and "portfolio_value" in s.drifted_features


def test_drift_with_one_empty_side(spark):
    from ledgerline.operators import drift as X
    for lone in ("ref", "cur"):
        rows = [("x", lone, float(i)) for i in range(20)] + [("y", s, float(i)) for s in ("ref", "cur") for i in range(20)]
        long = spark.createDataFrame(rows, "feature string, sample string, value double")
        ks = {r["feature"]: r for r in X.ks_table(long).collect()}
        assert ks["x"]["ks_statistic"] is None and ks["x"]["ks_p_value"] is None and ks["y"]["ks_statistic"] == 0
        psi = {r["feature"]: r["psi"] for r in X.psi_table(long).collect()}
        assert psi["x"] == 0 and abs(psi["y"]) < 1e-9


def test_unreadable_metrics_are_invalid(spark, tmp_path):
    from ledgerline.sources import files as IO
    (tmp_path / "bad.json").write_text("this is no json\n")
    status, df = IO.load_metrics(spark, str(tmp_path / "bad.json"))
    assert status == "invalid" and df.count() == 0
