"""F6-F8, F12 and X3 against reference computations: Kalman likelihood, dense solves, planted slopes, enumerated paths."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import autoregression as AR
from ledgerline.operators import drift as X
from ledgerline.operators import forecast as FC
from ledgerline.operators import seasonal as SE

PHI = np.array([0.5, -0.3, 0.2, 0.1, -0.25])


def ar_series(n, seed=0):
    rng, z = np.random.default_rng(seed), np.zeros(n + 60)
    for t in range(5, n + 60):
        z[t] = PHI @ z[t - 5:t][::-1] + rng.normal()
    return z[60:]


def frame(spark, prices: dict[str, np.ndarray]):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), a, float(v), i) for a, y in prices.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "date date, asset string, price double, row_id long").repartition(3)


def kalman(z, phi, s2):
    """Log-likelihood of a zero-mean AR(p), one observation after the other from the stationary state."""
    p = len(phi)
    t = np.zeros((p, p))
    t[:, 0] = phi
    t[:-1, 1:] = np.eye(p - 1)
    q = np.zeros((p, p))
    q[0, 0] = s2
    cov, a, out = np.linalg.solve(np.eye(p * p) - np.kron(t, t), q.ravel()).reshape(p, p), np.zeros(p), 0.0
    for x in z:
        f, v = cov[0, 0], x - a[0]
        out -= 0.5 * (math.log(2 * math.pi * f) + v * v / f)
        k = t @ cov[:, 0] / f
        a, cov = t @ a + k * v, t @ cov @ t.T + q - np.outer(k, k) * f
    return out


@pytest.mark.parametrize("n", [11, 12, 30, 500])
def test_exact_likelihood(n):
    z = ar_series(n)
    products = [float(z[:n - k] @ z[k:]) for k in range(6)]
    coef, s2, ll, r = AR.fit_series(products, z[:10], z[-10:], n)
    assert abs(ll - kalman(z, np.array(coef[1:]), s2)) < 1e-6 * max(1, abs(ll)) and all(abs(x) < 1 for x in r)
    d, rng = AR.edge_free(np.array(products), z[:10], z[-10:], n), np.random.default_rng(1)
    near = [AR.log_likelihood(np.clip(np.array(r) + rng.normal(0, 1e-3, 5), -0.99999, 0.99999), d, n)[0] for _ in range(100)]
    assert max(near) <= ll + 1e-6                              # nothing near is more likely
    roots = np.roots(np.r_[1, -np.array(coef[1:])])
    assert (np.abs(roots) < 1).all()                           # stationary


def test_fit_ar_on_spark(spark):
    z = {"A": ar_series(400, 1), "B": ar_series(300, 2), "flat": np.zeros(40), "short": ar_series(6, 3)}
    got = {r.asset: r for r in AR.fit_ar(frame(spark, {k: 100 + np.r_[0, np.cumsum(v)] for k, v in z.items()})).collect()}
    for a in ("A", "B"):
        assert got[a].n == len(z[a]) and abs(got[a].log_likelihood - kalman(z[a], np.array(got[a].coef[1:]), got[a].sigma2)) < 1e-5
        assert np.abs(np.array(got[a].coef[1:]) - PHI).max() < 0.2
    for a in ("flat", "short"):
        assert got[a].coef == [0.0] * 6 and got[a].log_likelihood is None


def test_changepoints_recovered(spark):
    """Planted slopes 0.4, -0.8, 1.2 come back; most hinges are exactly zero."""
    days, rng = 900, np.random.default_rng(0)
    t = np.arange(days) / (days - 1)
    y = 0.5 + 0.4 * t - 1.2 * np.maximum(t - 0.3, 0) + 2.0 * np.maximum(t - 0.55, 0) + 0.05 * np.sin(2 * np.pi * np.arange(days) / 7) + rng.normal(0, 0.02, days)
    df = frame(spark, {"A": y * 200 / y.max(), "B": np.full(50, 7.0)})
    fit = {r.asset: r for r in SE.fit_seasonal(df).collect()}
    beta = np.array(fit["A"].coef) * y.max()
    slope = np.diff(SE.design(np.arange(days, dtype=float), days)[:, :27] @ beta[:27]) * (days - 1)
    assert abs(slope[120] - 0.4) < 0.2 and abs(slope[380] + 0.8) < 0.2 and abs(slope[800] - 1.2) < 0.2
    assert (np.array(fit["A"].coef)[SE.HINGES] == 0).sum() >= 10 and abs(fit["A"].sigma * y.max() - 0.02) < 0.005
    ahead = SE.seasonal_forecast(SE.fit_seasonal(df), horizon=20).collect()
    assert len(ahead) == 40 and all(r.forecast_lower_bound <= r.forecasted_price <= r.forecast_upper_bound for r in ahead)
    far = sorted((r.step, r.forecasted_price) for r in ahead if r.asset == "B")
    assert all(abs(p - 7.0) < 0.1 for _, p in far)
    one = SE.seasonal_forecast(SE.fit_seasonal(df).withColumn("h", F.when(F.col("asset") == "A", 3).otherwise(0)), horizon=F.col("h"))
    assert sorted(r.asset for r in one.collect()) == ["A"] * 3


def test_sparse_solve_is_the_minimum():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 12)) @ rng.standard_normal((12, 12))
    g, c, level = x.T @ x, x.T @ rng.standard_normal(60) * 5, np.full(12, 6.0)
    b = SE.sparse_solve(g, c, level, np.zeros(12))
    rest = c - g @ b
    assert (np.abs(rest[b == 0]) <= 6 + 1e-6).all() and np.allclose(rest[b != 0], 6 * np.sign(b[b != 0]), atol=1e-6) and (b == 0).any()
    dense = SE.sparse_solve(g, c, np.zeros(12), np.zeros(12))
    assert np.allclose(dense, np.linalg.solve(g, c), rtol=1e-5, atol=1e-8)


def test_seasonal_solution_equals_dense_solve():
    """With the hinges that are left and their signs, all equations at once give the same parameters."""
    days, rng = 500, np.random.default_rng(5)
    x = SE.design(np.arange(days, dtype=float), days)
    y = 0.6 + 0.3 * x[:, 1] - 0.8 * x[:, 10] + rng.normal(0, 0.03, days)
    beta, noise = SE.fit_sums((x.T @ x).ravel(), x.T @ y, float(y @ y), days)
    beta = np.array(beta)
    hinge = np.zeros(SE.WIDTH, bool)
    hinge[SE.HINGES] = True
    on = np.flatnonzero(~hinge | (beta != 0))
    ridge = np.where(hinge, 0, np.where(np.arange(SE.WIDTH) < 2, 1 / SE.TREND_SD ** 2, 1 / SE.SEASON_SD ** 2)) * noise ** 2
    pull = np.where(hinge, noise ** 2 / SE.PRIOR_SCALE * np.sign(beta), 0)
    dense = np.linalg.solve((x.T @ x)[np.ix_(on, on)] + np.diag(ridge[on]), (x.T @ y - pull)[on])
    assert np.allclose(beta[on], dense, atol=1e-7)


def test_held_out_part_is_predicted_whole(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, {"A": 100 + np.cumsum(rng.normal(0, 1, 200)), "B": 50 + np.cumsum(rng.normal(0, 1, 90)), "tiny": np.ones(5)})
    for name in ("arima", "prophet"):
        got = FC.held_out_predictions(df, name).groupBy("asset").agg(F.count("predicted_price").alias("n"), F.count(F.lit(1)).alias("all")).collect()
        assert {r.asset: (r.n, r["all"]) for r in got} == {"A": (40, 40), "B": (18, 18)}
    got = FC.held_out_predictions(df, "lstm").groupBy("asset").count().collect()
    assert {r.asset: r["count"] for r in got} == {"A": 38, "B": 16}


def test_recursion_by_trees_equals_the_step_by_step_loop(spark):
    """All steps in one pass equal feature tables worked out anew for each day."""
    rng = np.random.default_rng(7)
    prices = {"A": 100 + np.cumsum(rng.normal(0, 1, 80)), "B": 30 + np.cumsum(rng.normal(0, 1, 12))}
    df = frame(spark, prices)
    feats_df, fills = FC.model_features(df, return_fills=True)
    feats = FC.feature_columns(feats_df)
    model = FC.fit_boosted(feats_df, feats, p=FC.Boosting(trees=20, step=0.3))
    got = {(r.asset, r.step): (r.date, r.forecasted_price) for r in FC.recursive_forecast(df, model, feats, horizon=3, medians=fills).collect()}
    assert len(got) == 6
    history = {a: list(y) for a, y in prices.items()}
    for step in (1, 2, 3):
        longer = frame(spark, {a: np.array(y + [y[-1]]) for a, y in history.items()})
        raw = FC.model_features(longer)
        for a in history:
            last = raw.filter(F.col("asset") == a).orderBy(F.col("date").desc()).first()
            x = np.array([[float(last[c]) for c in feats]])
            want = max(float(model.predict(x)[0]), 0.0)
            day, price = got[(a, step)]
            assert day == last.date and abs(price - want) < 1e-6
            history[a].append(want)


def test_exact_ks_equals_enumeration():
    for n, m in itertools.product(range(1, 9), repeat=2):
        paths = list(itertools.combinations(range(n + m), n))
        stats = []
        for p in paths:
            up, worst = set(p), 0
            i = j = 0
            for k in range(n + m):
                i, j = (i + 1, j) if k in up else (i, j + 1)
                worst = max(worst, abs(i * m - j * n))
            stats.append(worst)
        for h in sorted(set(stats)):
            want = sum(s >= h for s in stats) / len(paths)
            assert abs(X.ks_exact(h / (n * m), n, m) - want) < 1e-12
    assert X.ks_exact(0.0, 5, 7) == 1.0 and X.ks_exact(1.0, 300, 200) < 1e-100


def test_ks_table_is_exact_for_small_samples(spark):
    rows = [("f", "ref", float(v)) for v in (1, 2, 3, 4, 5)] + [("f", "cur", float(v)) for v in (3.5, 6, 7)] + [("g", "ref", 1.0)]
    got = {r.feature: r for r in X.ks_table(spark.createDataFrame(rows, "feature string, sample string, value double")).collect()}
    assert abs(got["f"].ks_p_value - X.ks_exact(got["f"].ks_statistic, 5, 3)) < 1e-12 and got["g"].ks_p_value is None
