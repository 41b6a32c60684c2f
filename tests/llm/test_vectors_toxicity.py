"""Hard negatives, whitening and toxicity against brute force and held-out labels, with nulls, ties, repeats and clashing columns."""

import math
import zlib

import numpy as np
import pytest

from ledgerline.llm import hard_negatives as hn
from ledgerline.llm import toxicity as tox
from ledgerline.llm import whitening as wh

VECTORS = "vec_id long, embedding array<float>, label int, n long, cell long, text string"


def vectors(n=700, d=12, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (n, d)).astype(np.float32)
    x[100:300] = x[100] + rng.normal(0, 0.01, (200, d)).astype(np.float32)     # a third of all rows are near copies
    x[400:430] = x[400]                                                         # exact ties
    x[450:455] = 0
    rows = [(i, x[i].tolist(), int(i % 3), 7, 9, "x") for i in range(n)]
    rows += [rows[100], rows[50]]                                               # repeated whole
    rows += [(None, x[5].tolist(), 1, 1, 1, None), (n + 50, None, 2, None, None, None), (n + 51, [*x[3][:-1].tolist(), None], 0, None, None, None),
             (n + 52, [*x[3][:-1].tolist(), float("nan")], 0, None, None, None), (n + 53, [math.inf] * d, 0, None, None, None),
             (n + 54, x[9].tolist(), None, None, None, None), (n + 55, [1.0, 2.0], 0, None, None, None), (n + 56, [], 0, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def data():
    return vectors()


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, VECTORS).repartition(5).cache()


def usable(rows, d, label=True):
    out = [r for r in rows if r[1] is not None and len(r[1]) == d and all(x is not None and math.isfinite(x) for x in r[1])]
    return [r for r in out if r[2] is not None] if label else out


def mined(rows, d):
    """All pairs, one by one."""
    seen, items = set(), []
    for i, v, y, *_ in usable(rows, d):
        q = tuple(math.floor(256 * float(x)) for x in v)
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        if (i, y, q) not in seen:
            seen.add((i, y, q))
            items.append((i, y, q))
    big = math.inf
    out = []
    for i, y, q in items:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(q, r)), big if j is None else j, z == y) for j, z, r in items if j != i]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2]][:5]:
            neg = [s for s in scored if not s[2] and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(i, None if p == big else p, k + 1, None if s[1] == big else s[1], ps, s[0]) for k, s in enumerate(neg)]
    return sorted(map(str, out))


@pytest.mark.parametrize("block, cluster, step", [(4096, 256, 512), (64, 4, 16)])
def test_hard_negatives(table, data, monkeypatch, block, cluster, step):
    for name, value in (("BLOCK_ROWS", block), ("CLUSTER_ROWS", cluster), ("STEP", step), ("TOGETHER", 2)):
        monkeypatch.setattr(hn, name, value)
    got = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in hn.hard_negatives(table).collect()]
    assert sorted(map(str, got)) == mined(data, 12)


def test_walks_end_with_proof():
    """A walk that stops early still has the best of all candidates, and does stop early."""
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(0, 1, (3000, 8)) * rng.gamma(1, 1, (3000, 1)))
    u = np.floor(256 * (rng.normal(0, 1, 8) + rng.normal(0, 0.05, (20, 8))))
    label, ids = rng.integers(0, 2, 3000), np.arange(3000)
    c = hn.Cluster(np.arange(5000, 5020), np.zeros(20, np.int64), u)
    s, i, done = hn.walk(c, ids, label, v, False)
    exact = u @ v.T
    for k in range(20):
        order = np.lexsort((ids, -exact[k]))
        assert i[k].tolist() == [x for x in order if label[x] == 0][:5]
    assert done < exact.size / 2


def test_hard_negatives_empty(spark):
    assert hn.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    only = spark.createDataFrame([(50, [1.0], 1, 0, 0, ""), (None, [2.0], 1, 0, 0, "")], VECTORS)
    assert hn.hard_negatives(only).count() == 0                                 # a positive, no negative


def test_whitening(table, data):
    got = wh.whiten(table, 12).collect()
    rows = usable(data, 12, label=False)
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r[1]] for r in rows], dtype=object)
    n, total = len(rows), x.sum(axis=0)
    dev = [int(sum((n * a - s) ** 2 for a, s in zip(r, total))) for r in x]
    centred = ((n * x - total).astype(float)) / n
    value, axes = np.linalg.eigh(centred.T @ centred / n)
    value, axes = value[::-1], axes[:, ::-1]
    z = centred @ axes / np.sqrt(value)
    want = sorted((str(r[0]), k + 1, d, round(abs(z[i, k]), 6)) for i, (r, d) in enumerate(zip(rows, dev)) for k in range(12))
    assert sorted((str(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 6)) for r in got) == want
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for r in got:
        assert abs(r.explained - value[r.component - 1] / value.sum()) < 1e-12
    again = {(r.vec_id, r.component, r.deviation, round(abs(r.whitened), 6)) for r in wh.whiten(table.repartition(2), 12).collect()}
    assert again == {(r.vec_id, r.component, r.deviation, round(abs(r.whitened), 6)) for r in got}


def test_whitening_edges(spark):
    assert wh.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, 0, 0, "")], VECTORS)).count() == 0      # no variance
    rows = [(i, [float(i), 3.0, 2.0 * i], 0, 0, 0, "") for i in range(9)]                                # one direction only
    got = wh.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("name", ["random", "graded", "rank", "few", "repeated", "unit", "zero columns", "one"])
def test_bidiagonal_solver(name):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    a = {"random": rng.standard_normal((80, 24)), "graded": rng.standard_normal((80, 24)) * 10.0 ** -np.arange(24),
         "rank": rng.standard_normal((80, 3)) @ rng.standard_normal((3, 24)), "few": rng.standard_normal((3, 24)),
         "repeated": (np.repeat([5.0, 3, 2, 1], 6)[:, None] * q) @ np.linalg.qr(rng.standard_normal((24, 24)))[0], "unit": np.eye(24),
         "zero columns": np.hstack([rng.standard_normal((40, 5)), np.zeros((40, 3))]), "one": rng.standard_normal((9, 1))}[name]
    value, axes, trace = wh.principal(np.linalg.qr(a, mode="r"), 24)
    exact = np.linalg.svd(a, compute_uv=False) ** 2
    k = len(value)
    assert k >= min(np.linalg.matrix_rank(a), 24) and np.allclose(value, exact[:k], rtol=1e-12, atol=0)
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-11
    assert np.abs(a.T @ (a @ axes) - axes * value).max() < 1e-11 * exact[0] and abs(trace / exact.sum() - 1) < 1e-12


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string"
INSULTS = ["blorfnik", "zugwharp", "quimbast"]


def toxic_rows(n=600, seed=5):
    rng = np.random.default_rng(seed)
    syllables = ["an", "re", "to", "li", "mo", "ver", "sta", "con", "ni", "pe", "du", "ca"]
    vocab = ["".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choice(vocab, int(rng.integers(8, 120))).tolist()
        bad = i % 5 == 0
        for _ in range(int(rng.integers(2, 5)) if bad else 0):
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(INSULTS)))
        words = [w + "." if rng.random() < 0.1 else w for w in words]
        docs.append((i, " ".join(words), "xx", "s", 1, 0.0, "q"))
        if i % 4:
            labels.append((i, 1, int(bad)))
    return docs, labels, vocab


def disguised(word):
    return [word[:3] + "." + word[3:], "-".join(word), " ".join(word), word[:4] + "x" + word[4:], word + "ness", word.upper()]


def test_toxicity(spark):
    docs, labels, vocab = toxic_rows()
    rng = np.random.default_rng(8)
    plain = lambda k: " ".join(rng.choice(vocab, k))
    planted = [(1000 + k, f"{plain(12)} {w} {plain(9)} {w} {plain(6)} {w}", None, None, 0, 0.0, "") for k, w in enumerate(x for v in INSULTS for x in disguised(v))]
    edges = [(5000, None, None, None, None, None, None), (5001, "", "", "", 0, 0.0, ""), (None, plain(20), "xx", None, 0, 0.0, ""), docs[3],
             (5002, plain(30_000), "xx", "s", 0, 0.0, ""), (5003, "z" * 100_000, "xx", "s", 0, 0.0, "")]
    table = spark.createDataFrame(docs + planted + edges, DOCS).repartition(6)
    marks = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1), (77777, 1, 1), (2, 0, 7)], "doc_id long, quality int, toxic int")
    got = tox.score_toxicity(table, marks).collect()
    assert len(got) == len(docs) + len(planted) + len(edges) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    score = {r.doc_id: r.score for r in got}
    held = [i for i in range(len(docs)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((score[i] >= 0.5) == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert sum(score[r[0]] >= 0.5 for r in planted) >= 0.9 * len(planted)          # insults with gaps and put-in characters
    assert score[5000] == score[5001] < 0.5 and score[5002] < 0.5 and score[5003] < 0.5 and score[None] < 0.5
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    again = {r.doc_id: r.score for r in tox.score_toxicity(table.repartition(2), marks).collect()}
    assert all(abs(again[k] - v) < 1e-9 for k, v in score.items())


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame(toxic_rows(20)[0], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in tox.score_toxicity(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert len({r.score for r in tox.score_toxicity(docs, one).collect()}) == 1
    assert tox.score_toxicity(docs.limit(0), none).count() == 0


def test_subsequence_kernel():
    """The sparse kernel equals the sum over all subsequences of three characters, written out."""
    def vector(w):
        w, out = f"\x02{w}\x03", {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(i + tox.SPAN, len(w))):
                    key = (w[i], w[j], w[k])
                    out[key] = out.get(key, 0) + tox.DECAY ** (k - i - 2)
        norm = math.sqrt(sum(x * x for x in out.values()))
        return {k: x / norm for k, x in out.items()}

    words = ["idiot", "id.iot", "idxiot", "i", "aaaa", "aaaaa", "übel", "notable", "idiots"]
    marks = tox.Landmarks(["idiot", "aaa", "übel"])
    got = marks.kernel(tox.subsequences(words), len(words), 1)
    for a, w in enumerate(words):
        for b, m in enumerate(marks.words):
            x, y = vector(w), vector(m)
            assert abs(got[a, b] - sum(v * y.get(k, 0) for k, v in x.items())) < 1e-5
    assert got[1, 0] > 0.5 and got[2, 0] > 0.5 and got[7, 0] < 0.2
