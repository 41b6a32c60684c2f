"""Exact distributed quantiles equal numpy's linear interpolation, also on
the band path (tiny accuracy forces the approximate band + exact pick)."""

import numpy as np
from pyspark.sql import functions as F

from ledgerline.functions.quantiles import column_quantiles, group_quantiles


def test_band_path_exact(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.lognormal(3, 1, 3000), np.full(500, 7.0)])  # heavy tail + a hot value
    rows = [("g" if i % 4 else "h", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = group_quantiles(df, ["k"], "v", probs, accuracy=50, exact_rows=10).collect()
    for r in got:
        sub = np.array([v for k, v in rows if k == r.k])
        exp = np.percentile(sub, [p * 100 for p in probs])
        np.testing.assert_allclose([r[f"q_{i}"] for i in range(len(probs))], exp, rtol=1e-12)
        assert r._n == len(sub)


def test_global_and_columns(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(101)], "a double, b double")
    g = group_quantiles(df, [], "a", [0.5]).first()
    assert g.q_0 == 50.0
    c = {r.feature: r.m for r in column_quantiles(df, ["a", "b"], [0.5], ["m"]).collect()}
    assert c == {"a": 50.0, "b": 2500.0}
    assert F is not None


def test_table_quantiles_by_bands(spark):
    """Bands, small columns, nulls, nan and a column without values: as by column; only values of a band become rows."""
    from ledgerline.functions import quantiles as Q

    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(size=6000), 2), rng.exponential(size=6000)
    rows = [(float(a[i]), float(b[i]) if i % 3 else None, float("nan") if i % 50 == 0 else float(i % 7), None, float(i) if i < 40 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    names, probs = list("abcde"), [0.25, 0.5]
    one, two = ({r.feature: (r._n, r.lo, r.mid) for r in f(df, names, probs, ["lo", "mid"], accuracy=100, exact_rows=100).collect()}
                for f in (Q.column_quantiles, Q.table_quantiles))
    assert one == two and set(two) == set("abce")
    assert np.isclose(two["a"][2], np.quantile(a, 0.5)) and np.isclose(two["b"][1], np.quantile(np.delete(b, np.s_[::3]), 0.25))
