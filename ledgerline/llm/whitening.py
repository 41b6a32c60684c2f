"""Embedding whitening (12): a blockwise QR, a bidiagonal qd solver, twisted factorisations.

Every task reduces its centred rows block by block to a triangle R (rows of R have the
covariance of the rows they stand for); triangles meet by the dozen in a tree of
stored tables until one is left. Householder reflections turn it into an upper bidiagonal B,
whose squared singular values come from shifted differential qd steps (dqds), to high
relative accuracy down to the smallest, and whose right singular vectors come from twisted factorisations of
B'B. Everything after the triangle is of the size of one vector squared, whatever the number of rows.

Defined cases: a row whose vector is null, or holds null or non-finite entries, or one that is no
long after scaling (2^53 and above), takes no part; nor does one whose vector is not as long as
most (of equally many, the longest); empty vectors have no components. Repeated rows count as
often as they come. A null id is an id like any other. A component without variance (the singular
value is rounding only) has no unit to be scaled to and is left out, so constant columns,
fewer rows than dimensions and a single row give fewer components or none. An empty table gives an
empty result. ``deviation`` is null where the exact sum is beyond a long. Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, ddl, keep_table

SCALE, SHIFT = 64, 1_000_000     # c becomes floor(SCALE * c) + SHIFT
COMPONENTS = 32
BLOCK_ROWS = 1024                # rows that one QR step takes in
TREE_BYTES = 32 << 20            # triangles that one task of the tree holds
SLICE = 512

SUMS = pa.schema([("dims", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
TRIANGLE = pa.schema([("part", pa.int64()), ("r", pa.binary())])
PARTS = pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.float64()))])
ROWS = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                  ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


# ---------------------------------------------------------------- rows as integers

def scaled(batch: pa.RecordBatch):
    """The usable rows of a batch by length of their vectors: (length, places in the batch, int64 matrix)."""
    col = batch.column("embedding")
    if len(col) == 0:
        return
    size = np.asarray(pa.compute.list_value_length(col).fill_null(0))
    values = col.flatten()                                 # null vectors have no values there
    flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry becomes nan
    start = np.cumsum(size) - size
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        x = flat[start[rows][:, None] + np.arange(d)]
        fits = (np.abs(x) < 2.0 ** 53 / SCALE).all(axis=1)  # false for nan and infinite
        if fits.any():
            yield d, rows[fits], np.floor(SCALE * x[fits]).astype(np.int64) + SHIFT


def _sums(batches):
    """Exact sums per dimension, in rows that can't overflow a long."""
    held: dict[int, list] = {}
    for batch in batches:
        for d, _, x in scaled(batch):
            for at in range(0, len(x), SLICE):
                part = x[at:at + SLICE]
                most = int(np.abs(part).max()) * len(part)
                if d in held and held[d][2] + most >= 1 << 62:
                    n, s, _ = held.pop(d)
                    yield batch_of(SUMS, dims=[d], n=[n], sums=[s.tolist()])
                n, s, m = held.get(d, (0, 0, 0))
                held[d] = [n + len(part), s + part.sum(axis=0), m + most]
    for d, (n, s, _) in held.items():
        yield batch_of(SUMS, dims=[d], n=[n], sums=[s.tolist()])


def deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S: int64 where that and the sum of its squares surely fit, else Python's integers."""
    bound = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in total), default=0)
    if bound < 1 << 62:
        d = n * x - np.array(total, np.int64)
        if int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 1 << 62:
            return d
    return n * x.astype(object) - np.array(total, object)


# ---------------------------------------------------------------- the triangle

def triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR decomposition (Householder), at most as many rows as columns."""
    return np.linalg.qr(rows, mode="r")


def _triangles(n: int, total: list[int]):
    dims = len(total)

    def run(batches):
        from pyspark import TaskContext

        r, held = None, []
        for batch in batches:
            for d, _, x in scaled(batch):
                if d != dims:
                    continue
                held.append(deviations(x, n, total).astype(np.float64) / n)
                if sum(map(len, held)) >= BLOCK_ROWS:
                    r, held = triangle(np.vstack(held if r is None else [r, *held])), []
        if held:
            r = triangle(np.vstack(held if r is None else [r, *held]))
        if r is not None:
            yield batch_of(TRIANGLE, part=[TaskContext.get().partitionId()], r=[r.tobytes()])
    return run


def _meet(dims: int):
    def run(key, table):
        r = None
        for raw in table.column("r"):                       # one at a time: the rest stays compact
            one = np.frombuffer(raw.as_py()).reshape(-1, dims)
            r = one if r is None else triangle(np.vstack([r, one]))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})
    return run


# ---------------------------------------------------------------- bidiagonal solver

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder bidiagonalisation R = U B V': B's diagonal, its upper diagonal, and V."""
    a = np.array(r, np.float64)
    d = a.shape[1]
    if len(a) < d:
        a = np.vstack([a, np.zeros((d - len(a), d))])
    v = np.eye(d)

    def reflector(x):
        norm = np.linalg.norm(x)
        if norm == 0:
            return None
        u = x.copy()
        u[0] += math.copysign(norm, x[0])
        return u / np.linalg.norm(u)

    for k in range(d):
        u = reflector(a[k:, k])
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < d - 2:
            u = reflector(a[k, k + 1:])
            if u is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ u, u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _qd_step(q: list[float], e: list[float], shift: float):
    """One differential qd step with a shift; None if the shift is beyond the smallest eigenvalue."""
    n = len(q)
    out_q, out_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    if d < 0:
        return None
    for i in range(n - 1):
        out_q[i] = d + e[i]
        if out_q[i] == 0.0:
            return None
        t = q[i + 1] / out_q[i]
        out_e[i] = e[i] * t
        d = d * t - shift
        if not d >= 0:
            return None
        least = min(least, d)
    out_q[n - 1] = d
    return out_q, out_e, least


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B for the upper bidiagonal B (diagonal ``a``, upper diagonal ``b``), falling.

    Shifts are tried from the smallest number the last step left on its way down;
    the step without a shift always works and keeps all relative accuracy."""
    eps = np.finfo(float).eps
    found, todo = [], [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0, 0.0)]
    while todo:
        q, e, moved, least = todo.pop()
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + moved)
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= eps * eps * min(moved + q[i], moved + q[i + 1]) or e[i] == 0.0), None)
            if cut is not None:                             # falls into two
                todo.append((q[:cut + 1], e[:cut], moved, 0.0))
                q, e, least = q[cut + 1:], e[cut + 1:], 0.0
                continue
            if 0.0 in q:                                    # singular: chase the zero to the end without a shift
                i = q.index(0.0)
                q[i] = np.finfo(float).tiny
            for s in (least * (1 - 4 * eps), least * 0.98, least * 0.75, least * 0.25, 0.0):
                if s > 0 and moved + s == moved and s != 0.0:
                    s = 0.0
                step = _qd_step(q, e, s)
                if step is not None:
                    q, e, least = step
                    moved += s
                    break
            else:
                raise ArithmeticError("qd step without a shift failed")
    return np.sort(np.maximum(found, 0.0))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B for ``value``: stationary and progressive qd transforms of
    L D L' - value, joined at the twist where the remaining pivot is least."""
    n, tiny = len(a), np.finfo(float).tiny
    if n == 1:
        return np.ones(1)
    floor = np.finfo(float).eps * max(float(np.max(np.abs(a))), float(np.max(np.abs(b)))) * 1e-8
    a = np.where(np.abs(a) < floor, max(floor, tiny), a)     # L needs a diagonal without zeros
    big, low = a * a, b / a[:-1]                               # D and the subdiagonal of L
    s, p = np.empty(n), np.empty(n)
    up, down = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        plus = big[i] + s[i] or tiny
        up[i] = big[i] * low[i] / plus
        s[i + 1] = up[i] * low[i] * s[i] - value
    p[n - 1] = big[n - 1] - value
    for i in range(n - 2, -1, -1):
        minus = big[i] * low[i] ** 2 + p[i + 1] or tiny
        t = big[i] / minus
        down[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -up[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -down[i] * z[i]
    return z / np.linalg.norm(z)


def _orthogonal(vectors: list[np.ndarray], z: np.ndarray, b_: np.ndarray, value: float, rng) -> np.ndarray:
    """``z`` made orthogonal to the vectors of its cluster; if little is left, inverse iteration from a new start."""
    for _ in range(16):
        left = 1.0
        for _ in range(3):
            for v in vectors:
                z = z - (v @ z) * v
            norm = np.linalg.norm(z)
            left *= norm
            if left < 1e-3:
                break
            z = z / norm
        else:
            return z
        z = rng.standard_normal(len(z))
        for v in vectors:
            z = z - (v @ z) * v
        try:
            z = np.linalg.solve(b_ - value * (1 + 4e-16) * np.eye(len(z)), z)
        except np.linalg.LinAlgError:
            pass
        z /= np.linalg.norm(z)
    raise ArithmeticError("no vector orthogonal to its cluster was found")


def principal(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Up to ``top`` eigenvalues of R'R above rounding (falling), their unit vectors as columns, and the trace."""
    a, b, v = bidiagonal(r)
    n = len(a)
    values, vectors = [], []
    scale = max(float(np.max(np.abs(a), initial=0)), float(np.max(np.abs(b), initial=0)))
    cuts = [0, *(np.flatnonzero(np.abs(b) <= np.finfo(float).eps * scale) + 1).tolist(), n]
    rng = np.random.default_rng(1)
    for lo, hi in zip(cuts[:-1], cuts[1:]):                  # blocks have vectors of their own
        x, y = a[lo:hi], b[lo:hi - 1]
        dense = np.diag(x * x + np.r_[0, y * y]) + np.diag(x[:-1] * y, 1) + np.diag(x[:-1] * y, -1)
        near, last = [], math.inf
        for value in dqds(x, y).tolist():
            z = twisted(x, y, value)
            if last - value > 1e-3 * last:
                near = []
            z = _orthogonal(near, z, dense, value, rng) if near else z
            near, last = [*near, z], value
            values.append(value)
            vectors.append(np.r_[np.zeros(lo), z, np.zeros(n - hi)])
    trace = math.fsum(values)
    order = np.argsort(np.array(values), kind="stable")[::-1][:top]
    order = [i for i in order if values[i] > max(values) * (n * np.finfo(float).eps) ** 2 * 16]
    return np.array([values[i] for i in order]), v @ np.array([vectors[i] for i in order]).T.reshape(n, len(order)), trace


# ---------------------------------------------------------------- results

def _moments(n: int, total: list[int], matrix: np.ndarray):
    """Sums and products of the whitened rows of a task."""
    def run(batches):
        count, sums = 0, np.zeros(matrix.shape[1] * (matrix.shape[1] + 1))
        for batch in batches:
            for d, _, x in scaled(batch):
                if d == len(total):
                    z = (deviations(x, n, total).astype(np.float64) / n) @ matrix
                    sums += np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
                    count += len(z)
        if count:
            yield batch_of(PARTS, n=[count], sums=[sums.tolist()])
    return run


def _rows(n: int, total: list[int], matrix: np.ndarray, explained: np.ndarray, error: float):
    k = matrix.shape[1]

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id").cast(pa.int64())
            for d, rows, x in scaled(batch):
                if d != len(total):
                    continue
                for at in range(0, len(rows), SLICE):
                    part, own = x[at:at + SLICE], rows[at:at + SLICE]
                    dev = deviations(part, n, total)
                    square = (dev * dev).sum(axis=1).tolist()
                    z = (dev.astype(np.float64) / n) @ matrix
                    m = len(own)
                    yield batch_of(ROWS, vec_id=ids.take(pa.array(np.repeat(own, k))), component=np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                                   n=np.full(m * k, n), deviation=pa.array([s if s < 1 << 63 else None for s in square for _ in range(k)], pa.int64()),
                                   whitened=z.ravel(), explained=np.tile(explained, m), identity_error=np.full(m * k, error))
    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each usable row's whitened coordinates: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    only = vectors.select("embedding")
    empty = spark.createDataFrame([], ddl(ROWS))

    sums = keep_table(only.mapInArrow(_sums, "dims int, n long, sums array<long>"), "whiten-sums")
    most = sums.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    if most is None:
        return empty
    n, dims = most["n"], most["dims"]
    cells = (sums.filter(F.col("dims") == dims).select(F.posexplode("sums")).groupBy("pos")
             .agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect())        # one row per dimension
    total = [int(c["s"]) for c in sorted(cells, key=lambda c: c["pos"])]

    fan = max(2, min(64, TREE_BYTES // (8 * dims * dims)))
    level = keep_table(only.mapInArrow(_triangles(n, total), ddl(TRIANGLE)), "whiten-r")
    while level.count() > 1:
        level = keep_table(level.withColumn("part", F.floor(F.col("part") / fan).cast("long")).groupBy("part").applyInArrow(_meet(dims), ddl(TRIANGLE)), "whiten-r")
    r = np.frombuffer(level.first()["r"]).reshape(-1, dims)

    values, axes, trace = principal(r, components)
    if len(values) == 0:
        return empty
    matrix = axes / np.sqrt(values / n)
    cells = (only.mapInArrow(_moments(n, total, matrix), "n long, sums array<double>").select(F.posexplode("sums"))
             .groupBy("pos").agg(F.sum("col").alias("s")).collect())                       # components x (components + 1) cells
    flat = np.array([c["s"] for c in sorted(cells, key=lambda c: c["pos"])]) / n
    k = len(values)
    error = float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max())
    return vectors.mapInArrow(_rows(n, total, matrix, values / trace, error), ddl(ROWS))
