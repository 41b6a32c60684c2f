"""AR(p) on first differences of the regular daily series by exact Gaussian maximum likelihood.

The exact likelihood of n values of a zero-mean AR(p) needs them only through p + 1 lag products, the first and
the last p values: with u = (1, -phi_1 .. -phi_p) the exact sum of squares is u'Du, where D is the (p+1) x (p+1)
matrix of lag products without those at the edges, and the determinant term is sum_k k ln(1 - r_k^2) / 2 over the
partial autocorrelations r_k (Box and Jenkins). So the data are read once, by partial aggregates; what is left is a
few numbers per series, and the maximum is searched over r_k = tanh(x_k): inside the stationary region throughout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small, materialize
from ledgerline.functions.sequence import bounded_window
from ledgerline.operators.features import regular_calendar

AR_ORDER = 5
FIT = "coef array<double>, sigma2 double, log_likelihood double, partial array<double>"


def lag_products(df: DataFrame, keys: Sequence[str] = ("asset",), order: int = AR_ORDER, regular: DataFrame | None = None) -> DataFrame:
    """Per series: ``n`` differences, their lag products ``products`` (lags 0 to ``order``), and the first and last
    2 * ``order`` differences (all of them where there are fewer)."""
    keys = list(keys)
    reg = regular if regular is not None else materialize(regular_calendar(df, keys), "regular-series")
    size = broadcast_if_small(reg.groupBy(*keys).agg(F.max("day_index").alias("_size")))

    def build(d, w):
        d = d.withColumn("_d", F.col("price") - F.lag("price", 1).over(w))
        return d.withColumns({f"_l{k}": F.lag("_d", k).over(w) for k in range(1, order + 1)})
    rows = bounded_window(reg.withColumnRenamed("day_index", "_pos"), keys, order + 1, build, pos_col="_pos").filter("_d IS NOT NULL").join(size, keys)
    value = F.struct("_pos", "_d")
    ends = {"first": F.col("_pos") <= 2 * order + 1, "last": F.col("_pos") > F.col("_size") - 2 * order}
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(F.sum(F.col("_d") * F.col("_d")), *[F.coalesce(F.sum(F.col("_d") * F.col(f"_l{k}")), F.lit(0.0)) for k in range(1, order + 1)]).alias("products"),
        *[F.transform(F.sort_array(F.collect_list(F.when(c, value))), lambda x: x["_d"]).alias(name) for name, c in ends.items()])


def edge_free(products: np.ndarray, first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """The matrix D: D_ij sums z_(i+m) z_(j+m), m = 0 .. n+1-i-j (i, j from 1)."""
    p = len(products) - 1
    out = np.zeros((p + 1, p + 1))
    for i in range(1, p + 2):
        for j in range(i, p + 2):
            k, cut = j - i, i - 1
            if n <= len(first):                               # the whole series is there
                m = n + 2 - i - j
                s = float(first[i - 1:i - 1 + m] @ first[j - 1:j - 1 + m]) if m > 0 else 0.0
            else:
                s = products[k] - float(first[:cut] @ first[k:k + cut])
                s -= float(last[len(last) - k - cut:len(last) - k] @ last[len(last) - cut:]) if cut else 0.0
            out[i - 1, j - 1] = out[j - 1, i - 1] = s
    return out


def from_partial(r: np.ndarray) -> np.ndarray:
    """AR coefficients of partial autocorrelations (Levinson's recursion)."""
    phi = np.zeros(0)
    for x in r:
        phi = np.append(phi - x * phi[::-1], x)
    return phi


def log_likelihood(r: np.ndarray, d: np.ndarray, n: int) -> tuple[float, float]:
    """The exact log-likelihood at its best innovation variance, and that variance."""
    u = np.append(1.0, -from_partial(r))
    s2 = max(float(u @ d @ u), 0.0) / n
    if s2 <= 0:
        return -math.inf, 0.0
    return -n / 2 * (math.log(2 * math.pi * s2) + 1) + 0.5 * float(np.arange(1, len(r) + 1) @ np.log1p(-r ** 2)), s2


def yule_walker(products: np.ndarray) -> np.ndarray:
    """Partial autocorrelations of the lag products (inside (-1, 1): the products of a finite series are positive definite)."""
    phi, r, v = np.zeros(0), [], products[0]
    for k in range(1, len(products)):
        x = (products[k] - phi @ products[k - 1:0:-1][:len(phi)]) / v if v > 0 else 0.0
        x = min(max(x, -0.999), 0.999)
        phi, v = np.append(phi - x * phi[::-1], x), v * (1 - x * x)
        r.append(x)
    return np.array(r)


def maximise(products: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Partial autocorrelations of the highest likelihood: quasi-Newton steps on x = artanh(r) from Yule and Walker's."""
    def f(x):
        return -log_likelihood(np.tanh(x), d, n)[0] / n

    def slope(x):
        e, out = 1e-6, np.empty(len(x))
        for i in range(len(x)):
            h = np.zeros(len(x))
            h[i] = e
            out[i] = (f(x + h) - f(x - h)) / (2 * e)
        return out

    x = np.arctanh(yule_walker(products))
    p = len(x)
    inverse, now, g = np.eye(p), f(x), slope(x)
    for _ in range(100):
        step = -inverse @ g
        if g @ step >= 0:
            inverse, step = np.eye(p), -g
        a = min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-300))
        while a > 1e-10 and not f(x + a * step) <= now + 1e-4 * a * float(g @ step):
            a /= 2
        if a <= 1e-10:
            break
        new = x + a * step
        g2, y = slope(new), None
        y, s = g2 - g, new - x
        if y @ s > 1e-14:
            rho = 1.0 / float(y @ s)
            left = np.eye(p) - rho * np.outer(s, y)
            inverse = left @ inverse @ left.T + rho * np.outer(s, s)
        x, g, now = new, g2, f(new)
        if np.abs(g).max() < 1e-9:
            break
    return np.tanh(np.clip(x, -18, 18))


def fit_series(products, first, last, n: int) -> tuple:
    """(coefficients after a zero intercept, innovation variance, log-likelihood, partial autocorrelations). A series
    without change, or of fewer differences than twice the coefficients, has none: zeros and null."""
    products, first, last = (np.asarray(a, float) for a in (products, first, last))
    p = len(products) - 1
    if n < 2 * p or not products[0] > 0:
        return [0.0] * (p + 1), None, None, [0.0] * p
    d = edge_free(products, first, last, n)
    r = maximise(products, d, n)
    ll, s2 = log_likelihood(r, d, n)
    return [0.0, *from_partial(r).tolist()], s2, ll, r.tolist()


def fit_ar(df: DataFrame, keys: Sequence[str] = ("asset",), order: int = AR_ORDER, regular: DataFrame | None = None) -> DataFrame:
    """Exact maximum likelihood per series: ``coef`` (a zero intercept, then phi_1 .. phi_p), ``sigma2``, ``log_likelihood``, ``partial``."""
    keys = list(keys)

    @F.pandas_udf(FIT)
    def solve(products: pd.Series, first: pd.Series, last: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fit_series(*row) for row in zip(products, first, last, n)], columns=["coef", "sigma2", "log_likelihood", "partial"])
    sums = lag_products(df, keys, order, regular)
    return sums.withColumn("_fit", solve("products", "first", "last", "n")).select(*keys, "n", "_fit.*")
