"""Hard-negative mining (11): anchor clusters walk shared candidate lists, in the manner of MAXIMUS.

All rows are dealt to cells (nearest centre; centres are fitted on a bounded sample) and cells to blocks of about
``BLOCK_ROWS`` rows, anchors to clusters of about ``CLUSTER_ROWS``. For a cluster with centre c and radius b (the
largest angle between c and a member), a candidate v scores at most |u| |v| cos(max(0, angle(v, c) - b)) with any member u.
So the candidates of a block are sorted by that bound once per cluster, and every member walks the list, some
hundred candidates at a time, until its bound for the next candidate is below the last score that
it still needs: that ends its walk with proof, nothing is left out.

Blocks reach clusters in two rounds: first the blocks of a cluster's own cell, which give every member
a score to beat; then the others, without those whose own bound (centre, radius, longest vector) can't
reach it. Two such searches follow each other: positives, then negatives inside each positive's window.
What a round finds goes back to its cluster, a stored row; no step holds more than a block and a few clusters.

Defined cases: rows with a null label, a null vector, null or non-finite entries, entries of 2^24 and above after
scaling (their products aren't exact), or a vector not as long as most (of equally many, the longest) take
no part. A null id keeps its label, is never an anchor and comes after all others among equal
scores. Rows repeated whole count once; an anchor's other rows are all with another id. Anchors without positives,
and positives without negatives in their window, give no rows. An empty table gives an empty result.
Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import NULL_ID, batch_of, ddl, dec, enc, keep_table

SCALE = 256
EVERY = 50                 # ids divisible by this are anchors
LABELS, FLIP = 10, 7       # ids divisible by FLIP get the next of so many labels
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95         # percent of the positive's score between which a negative's lies
BLOCK_ROWS, CLUSTER_ROWS = 4096, 256
MOST_CELLS = 256
SAMPLE = 4096              # rows that the cells' centres are fitted on
TOGETHER = 16              # clusters that meet a block in one step
STEP = 512                 # candidates of one step of a walk
SLACK = 1e-7               # angles and bounds are in doubles

ITEM = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.binary())])
DEALT = pa.schema([*ITEM, ("cell", pa.int64())])
BLOCK = pa.schema([("block", pa.int64()), ("cell", pa.int64()), ("centre", pa.binary()), ("radius", pa.float64()), ("longest", pa.float64()),
                   ("rows", pa.binary())])
CLUSTER = pa.schema([("cluster", pa.int64()), ("cell", pa.int64()), ("state", pa.binary())])
HIT = pa.schema([("cluster", pa.int64()), ("found", pa.binary())])
PAIR = pa.schema([("block", pa.int64()), ("cluster", pa.int64())])
ROWS = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                  ("positive_score", pa.int64()), ("negative_score", pa.int64())])


# ---------------------------------------------------------------- rows

def _items(dims: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            flat = batch.column("embedding").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
            x = flat.reshape(len(batch), dims)                  # a null entry is nan
            fits = (np.abs(x) < 2.0 ** 24 / SCALE).all(axis=1)
            v = np.floor(SCALE * x[fits]).astype("<i4")
            ids, label = ids[fits], label[fits].astype(np.int64)
            flip = (ids != NULL_ID) & (ids % FLIP == 0)
            label[flip] = (label[flip] + 1) % LABELS
            yield batch_of(ITEM, vec_id=ids, label=label, v=[r.tobytes() for r in v])
    return run


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of equal length from a column of their bytes."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<i4").reshape(len(column), -1).astype(np.float64)


def unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm == 0, 1, norm)


def fit_centres(v: np.ndarray, k: int, turns: int = 8) -> np.ndarray:
    """Unit centres of ``k`` cells: spherical k-means from evenly dealt starts."""
    u = unit(v)
    centres = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(turns if k > 1 else 1):
        near = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, u)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, unit(sums), centres)
    return centres


def _deal(centres: np.ndarray):
    def run(batches):
        for batch in batches:
            if len(batch):
                near = (unit(matrix(batch.column("v"))) @ centres.T).argmax(axis=1)
                yield batch_of(DEALT, **{n: batch.column(n) for n in ITEM.names}, cell=near)
    return run


def ball(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The centre of some vectors' directions, their cosines to it, and the largest angle (with slack)."""
    u = unit(v)
    mean = u.sum(axis=0)
    centre = mean / np.linalg.norm(mean) if np.linalg.norm(mean) > 1e-9 else u[np.argmax(np.linalg.norm(u, axis=1))]
    cos = np.clip(u @ centre, -1, 1)
    cos[~u.any(axis=1)] = 1.0                                   # null vectors: their bound is 0 anyway
    return centre, cos, float(np.arccos(cos.min())) + SLACK


def _block(key, table):
    v = matrix(table.column("v"))
    order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
    centre, _, radius = ball(v)
    rows = enc(table.column("vec_id").to_numpy()[order], table.column("label").to_numpy()[order], v[order].astype("<i4").ravel())
    return pa.Table.from_batches([batch_of(BLOCK, block=[key[0].as_py()], cell=[table.column("cell")[0].as_py()], centre=[centre.tobytes()], radius=[radius],
                                           longest=[float(np.linalg.norm(v, axis=1).max())], rows=[rows])])


class Cluster:
    """Some anchors and what is known of them: best positives, and best negatives of each positive."""

    def __init__(self, ids, label, v):
        self.ids, self.label, self.v = ids, label, v
        n = len(ids)
        self.ps, self.pi = np.full((n, POSITIVES), -np.inf), np.full((n, POSITIVES), NULL_ID)
        self.ns, self.ni = np.full((n, POSITIVES, NEGATIVES), -np.inf), np.full((n, POSITIVES, NEGATIVES), NULL_ID)

    def pack(self) -> bytes:
        return enc(self.ids, self.label, self.v.astype("<i4").ravel(), self.ps.ravel(), self.pi.ravel(), self.ns.ravel(), self.ni.ravel())

    @classmethod
    def of(cls, blob: bytes) -> "Cluster":
        ids, label, v, ps, pi, ns, ni = dec(blob)
        c = cls(ids, label, v.reshape(len(ids), -1).astype(np.float64))
        c.ps, c.pi = ps.reshape(c.ps.shape).copy(), pi.reshape(c.pi.shape).copy()
        c.ns, c.ni = ns.reshape(c.ns.shape).copy(), ni.reshape(c.ni.shape).copy()
        return c

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score of a negative for each positive (infinite: no positive)."""
        low, high = np.ceil(LOW * self.ps / 100), np.floor(HIGH * self.ps / 100)
        return np.where(np.isfinite(self.ps), low, np.inf), np.where(np.isfinite(self.ps), high, -np.inf)

    def need(self, negatives: bool) -> np.ndarray:
        """The least score of use to each anchor (infinite: none is)."""
        if not negatives:
            return self.ps[:, -1].copy()
        low, high = self.windows()
        return np.where(low <= high, np.maximum(low, self.ns[:, :, -1]), np.inf).min(axis=1)


def _cluster(key, table):
    c = Cluster(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), matrix(table.column("v")))
    return pa.Table.from_batches([batch_of(CLUSTER, cluster=[key[0].as_py()], cell=[table.column("cell")[0].as_py()], state=[c.pack()])])


# ---------------------------------------------------------------- walks

def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0 ** 53:
        return a @ b.T
    return (a.astype(np.int64) @ b.astype(np.int64).T).astype(np.float64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k best scores and their ids; of equal scores the first (columns are in id order). -inf is no candidate."""
    scores, rows = scores.copy(), np.arange(len(scores))
    s, i = np.full((len(scores), k), -np.inf), np.full((len(scores), k), NULL_ID)
    for j in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        s[:, j] = scores[rows, at]
        i[:, j] = np.where(np.isfinite(s[:, j]), ids[at], NULL_ID)
        scores[rows, at] = -np.inf
    return s, i


def merge(s: np.ndarray, i: np.ndarray, s2: np.ndarray, i2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The better of two lists (last axis), by falling score, then id."""
    k = s.shape[-1]
    s, i = np.concatenate([s, s2], axis=-1), np.concatenate([i, i2], axis=-1)
    order = np.lexsort((i, -s), axis=-1)[..., :k]
    return np.take_along_axis(s, order, -1), np.take_along_axis(i, order, -1)


def walk(c: Cluster, ids: np.ndarray, label: np.ndarray, v: np.ndarray, negatives: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """The best of some candidates (scores, ids; -inf: none) that can be among a cluster's best, with
    those it has; and how many products that took."""
    centre, _, radius = ball(c.v)
    norm = np.linalg.norm(v, axis=1)
    angle = np.arccos(np.clip(v @ centre / np.where(norm == 0, 1, norm), -1, 1))
    bound = norm * np.maximum(np.cos(np.maximum(angle - radius - SLACK, 0)), 0) * (1 + SLACK)
    order = np.argsort(-bound, kind="stable")                   # the shared list
    length, done = np.linalg.norm(c.v, axis=1), 0
    had = c.ns if negatives else c.ps
    s_best, i_best = np.full(had.shape, -np.inf), np.full(had.shape, NULL_ID)
    k = had.shape[-1]
    low, high = c.windows() if negatives else (None, None)

    def least(who):
        """What a score must reach to be among the best of the lists."""
        both = np.partition(np.concatenate([had[who], s_best[who]], axis=-1), -k, axis=-1)[..., -k]
        return both if not negatives else np.where(low[who] <= high[who], np.maximum(low[who], both), np.inf)

    live = np.arange(len(c.ids))
    for at in range(0, len(order), STEP):
        need = least(live)
        need = need.min(axis=1) if negatives else need
        top = bound[order[at]] * length[live] + SLACK
        live = live[(top >= need) if bound[order[at]] > 0 else (need <= 0)]
        if len(live) == 0:
            break
        part = np.sort(order[at:at + STEP])                     # rows are in id order
        s = products(c.v[live], v[part])
        done += s.size
        same = c.label[live][:, None] == label[part]
        if not negatives:
            own = c.ids[live][:, None] == ids[part]
            got = best(np.where(same & ~own, s, -np.inf), ids[part], k)
            s_best[live], i_best[live] = merge(s_best[live], i_best[live], *got)
            continue
        s[same] = np.nan
        floor = least(live)
        for j in range(POSITIVES):
            ok = (s >= floor[:, j, None]) & (s <= high[live, j][:, None])
            rows = np.flatnonzero(ok.any(axis=1))
            if len(rows):
                got = best(np.where(ok[rows], s[rows], -np.inf), ids[part], k)
                who = live[rows]
                s_best[who, j], i_best[who, j] = merge(s_best[who, j], i_best[who, j], *got)
    s_best[s_best < had[..., -1:]] = -np.inf                    # equal ones may have the smaller id
    return s_best, i_best, done


def _walk(negatives: bool):
    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                ids, label, v = dec(batch.column("rows")[k].as_py())
                v = v.reshape(len(ids), -1).astype(np.float64)
                for one in batch.column("came")[k].as_py():
                    s, i, _ = walk(Cluster.of(one["state"]), ids, label, v, negatives)
                    new = np.flatnonzero(np.isfinite(s))
                    if len(new):
                        yield batch_of(HIT, cluster=[one["cluster"]], found=[enc(new, s.ravel()[new], i.ravel()[new])])
    return run


def _take(negatives: bool):
    def run(key, states, hits):
        out = []
        for row in states.to_pylist():
            c = Cluster.of(row["state"])
            s, i = (c.ns, c.ni) if negatives else (c.ps, c.pi)
            for found in hits.column("found"):                  # one block's finds at a time
                at, score, ids = dec(found.as_py())
                s2, i2 = np.full(s.size, -np.inf), np.full(s.size, NULL_ID)
                s2[at], i2[at] = score, ids
                s, i = merge(s, i, s2.reshape(s.shape), i2.reshape(i.shape))
            if negatives:
                c.ns, c.ni = s, i
            else:
                c.ps, c.pi = s, i
            out.append(batch_of(CLUSTER, cluster=[row["cluster"]], cell=[row["cell"]], state=[c.pack()]))
        return pa.Table.from_batches(out, CLUSTER)
    return run


# ---------------------------------------------------------------- which blocks meet which clusters

PACK = pa.schema([("pack", pa.int64()), ("balls", pa.binary())])


def _balls(negatives: bool):
    """What bounds a pack of clusters: ids, cells, centres, radii, and the least score needed per unit of length."""
    def run(key, table):
        centres, radii, needs = [], [], []
        for blob in table.column("state"):
            c = Cluster.of(blob.as_py())
            centre, _, radius = ball(c.v)
            need, length = c.need(negatives), np.linalg.norm(c.v, axis=1)
            centres.append(centre)
            radii.append(radius)
            needs.append(np.where(length > 0, need / np.where(length > 0, length, 1), np.where(need > 0, np.inf, -np.inf)).min())
        blob = enc(table.column("cluster").to_numpy(), table.column("cell").to_numpy(), np.concatenate(centres), np.array(radii), np.array(needs))
        return pa.Table.from_batches([batch_of(PACK, pack=[key[0].as_py()], balls=[blob])])
    return run


def _reach(batches):
    """Blocks of other cells that could still hold something for a cluster."""
    for batch in batches:
        for k in range(len(batch)):
            ids, cells, centres, radii, needs = dec(batch.column("balls")[k].as_py())
            centre = np.frombuffer(batch.column("centre")[k].as_py())
            angle = np.arccos(np.clip(centres.reshape(len(ids), -1) @ centre, -1, 1)) - radii - batch.column("radius")[k].as_py() - SLACK
            most = batch.column("longest")[k].as_py() * np.maximum(np.cos(np.maximum(angle, 0)), 0) * (1 + SLACK) + SLACK
            go = np.flatnonzero((most >= needs) & (cells != batch.column("cell")[k].as_py()))
            yield batch_of(PAIR, block=np.full(len(go), batch.column("block")[k].as_py()), cluster=ids[go])


def _round(blocks: DataFrame, clusters: DataFrame, pairs: DataFrame, n_clusters: int, negatives: bool) -> DataFrame:
    """Clusters meet blocks; what is found comes back to the clusters."""
    spread = -(-n_clusters // TOGETHER)
    met = (pairs.join(clusters.select("cluster", "state"), "cluster")
           .groupBy("block", F.pmod(F.xxhash64("cluster"), F.lit(spread)).alias("turn"))
           .agg(F.collect_list(F.struct("cluster", "state")).alias("came")))
    found = met.join(blocks.select("block", "rows"), "block").select("rows", "came").mapInArrow(_walk(negatives), ddl(HIT))
    return keep_table(clusters.groupBy("cluster").cogroup(found.groupBy("cluster")).applyInArrow(_take(negatives), ddl(CLUSTER)), "negatives-clusters")


def _search(blocks: DataFrame, clusters: DataFrame, n_clusters: int, negatives: bool) -> DataFrame:
    near = blocks.select("block", "cell").join(clusters.select("cluster", "cell"), "cell").select("block", "cluster")
    clusters = _round(blocks, clusters, near, n_clusters, negatives)
    packs = -(-n_clusters // CLUSTER_ROWS)
    balls = clusters.groupBy(F.pmod(F.xxhash64("cluster"), F.lit(packs)).alias("pack")).applyInArrow(_balls(negatives), ddl(PACK))
    every = blocks.drop("rows").withColumn("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(packs - 1).cast("long"))))
    far = every.join(balls, "pack").mapInArrow(_reach, ddl(PAIR))
    return _round(blocks, clusters, far, n_clusters, negatives)


def _rows(batches):
    for batch in batches:
        for blob in batch.column("state"):
            c = Cluster.of(blob.as_py())
            a, p, r = np.nonzero(np.isfinite(c.ns))
            null = lambda x: pa.array(x, pa.int64(), mask=x == NULL_ID)
            yield batch_of(ROWS, anchor_id=c.ids[a], positive_id=null(c.pi[a, p]), rank=(r + 1).astype(np.int32), negative_id=null(c.ni[a, p, r]),
                           positive_score=c.ps[a, p].astype(np.int64), negative_score=c.ns[a, p, r].astype(np.int64))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = embeddings.sparkSession
    empty = spark.createDataFrame([], ddl(ROWS))
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                               F.col("embedding").cast("array<double>").alias("embedding")).filter("label IS NOT NULL AND size(embedding) > 0")
    most = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if most is None:
        return empty
    items = keep_table(usable.filter(F.size("embedding") == most["d"]).mapInArrow(_items(most["d"]), ddl(ITEM)).distinct(), "negatives-items")
    n = items.count()
    if n == 0:
        return empty
    sample = items.select("v").orderBy(F.xxhash64("vec_id", "v"), "v").limit(SAMPLE).collect()     # bounded: the centres' sample
    centres = fit_centres(np.stack([np.frombuffer(r["v"], "<i4") for r in sample]).astype(np.float64), min(MOST_CELLS, -(-n // BLOCK_ROWS), len(sample)))
    dealt = keep_table(items.mapInArrow(_deal(centres), ddl(DEALT)), "negatives-dealt")
    anchor = (F.col("vec_id") != NULL_ID) & (F.col("vec_id") % EVERY == 0)
    sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("a")).collect()   # one row per cell
    if sum(r["a"] for r in sizes) == 0:
        return empty

    def parts(rows: int, per: str):
        table = F.create_map(*[F.lit(x) for r in sizes for x in (r["cell"], max(1, -(-r[per] // rows)))])
        return F.col("cell") * F.lit(1 << 40) + F.pmod(F.xxhash64("vec_id", "v"), table[F.col("cell")])

    blocks = keep_table(dealt.groupBy(parts(BLOCK_ROWS, "n").alias("block")).applyInArrow(_block, ddl(BLOCK)), "negatives-blocks")
    clusters = keep_table(dealt.filter(anchor).groupBy(parts(CLUSTER_ROWS, "a").alias("cluster")).applyInArrow(_cluster, ddl(CLUSTER)), "negatives-clusters")
    n_clusters = clusters.count()
    clusters = _search(blocks, clusters, n_clusters, False)
    clusters = _search(blocks, clusters, n_clusters, True)
    return clusters.mapInArrow(_rows, ddl(ROWS))
