"""Document fingerprints (10) from closed syncmers.

A k-mer of the UTF-8 bytes is a closed syncmer when its smallest inner s-mer
(by hash) is its first or its last: that depends on the k-mer alone, so equal
passages give equal anchors in any context. A fingerprint is the ``SKETCH``
smallest distinct anchor hashes, each with its byte position, in hash order, as
hex (8 digits hash, 8 digits place). Likeness: of the smallest hashes of both
together, those in both, as far as their positions are in one order
(longest chain), give a Jaccard estimate j; 2j / (1 + j) estimates the share of
anchors in common.

Defined cases: a text shorter than k is one anchor; an empty (or null) text has
the empty fingerprint, alike (1.0) to another empty one and unlike (0.0) to all
else; rows with equal doc_id follow one another in the order of their texts; a
null doc_id is last; one document alone follows itself; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import (U64, batch_of, byte_values, dec, ddl, enc, give_back_ids, id_and_text, rolling, small_batches,
                                   spans, squeeze, texts, unsqueeze)

K, S = 24, 8
SKETCH = 64
BUCKET_BYTES = 3 << 20

RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def syncmers(data: np.ndarray, offsets: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``data``, hashes) of the closed syncmers of the texts that lie between the offsets."""
    w = k - s + 1
    if len(data) < k:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    prefix = rolling(byte_values(data))
    at = np.arange(len(data) - s + 1)
    inner = spans(prefix, at, at + s)
    low, width = inner, 1                       # minimum over w neighbours, by doubling
    while 2 * width <= w:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(inner) - w + 1], low[w - width:][:len(inner) - w + 1])
    n = len(low)
    hit = np.flatnonzero((low == inner[:n]) | (low == inner[w - 1:w - 1 + n]))
    end = offsets[np.searchsorted(offsets, hit, "right")]
    hit = hit[hit + k <= end]
    return hit, spans(prefix, hit, hit + k)


def sketch(places: np.ndarray, hashes: np.ndarray, size: int = SKETCH) -> tuple[np.ndarray, np.ndarray]:
    """The smallest distinct hashes (upper 32 bits) and the first place of each."""
    h = (hashes >> U64(32)).astype(np.uint32)
    if len(h) > 8 * size:                       # enough small ones to hold the sketch, unless many repeat
        few = np.argpartition(h, 4 * size)[:4 * size]
        if len(np.unique(h[few])) >= size:
            keep = h <= h[few].max()
            h, places = h[keep], places[keep]
    u, first = np.unique(h, return_index=True)
    return u[:size], places[first][:size].astype(np.uint32)


def _text(sk: tuple[np.ndarray, np.ndarray]) -> str:
    out = np.empty((len(sk[0]), 2), ">u4")
    out[:, 0], out[:, 1] = sk
    return out.tobytes().hex()


def likeness(a: tuple, b: tuple, size: int = SKETCH) -> float:
    (ha, pa_), (hb, pb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    both = np.union1d(ha, hb)[:size]
    shared, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    inside = shared <= both[-1]
    order = np.argsort(pa_[ia[inside]], kind="stable")
    chain: list[int] = []                       # longest ascending run of places in b
    for p in pb[ib[inside]][order].tolist():
        i = bisect.bisect_right(chain, p)
        chain[i:i + 1] = [p]
    j = len(chain) / len(both)
    return 2 * j / (1 + j)


def _short(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.zeros(1, np.int64), spans(rolling(byte_values(data)), np.array([0]), np.array([len(data)]))


def _anchors(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    at, h = syncmers(data, offsets)
    cut = np.searchsorted(at, offsets)
    return [(at[a:b] - o, h[a:b]) if e - o >= K else _short(data[o:e])
            for a, b, o, e in zip(cut[:-1], cut[1:], offsets[:-1], offsets[1:])]


def _route(bounds: np.ndarray):
    """Texts to the bucket of their doc_id, as blobs; the first of each bucket also to the bucket before."""
    def run(batches):
        for batch in batches:
            data, off = texts(batch)
            ids = batch.column("doc_id").to_numpy()
            bucket = np.maximum(np.searchsorted(bounds, ids, "right") - 1, 0)
            head = bounds[bucket] == ids
            to = np.concatenate([bucket, (bucket[head] - 1) % len(bounds)])
            row = np.concatenate([np.arange(len(ids)), np.flatnonzero(head)])
            extra = np.concatenate([np.zeros(len(ids), bool), np.ones(int(head.sum()), bool)])
            order = np.argsort(to, kind="stable")
            to, row, extra = to[order], row[order], extra[order]
            edge = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
            out = []
            for a, b in zip(edge, [*edge[1:], len(to)]):
                own = row[a:b]
                raw = b"".join(data[off[r]:off[r + 1]].tobytes() for r in own)
                out.append((int(to[a]), enc(ids[own], extra[a:b], off[own + 1] - off[own]), squeeze(raw, 3)))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                                              pa.array([o[2] for o in out], pa.binary())], ["bucket", "rows", "blob"])
    return run


def _bucket(table: pa.Table) -> pa.Table:
    docs = []
    for rows, blob in zip(table.column("rows").to_pylist(), table.column("blob").to_pylist()):
        ids, extra, lens = dec(rows)
        raw, at = unsqueeze(blob), 0
        for i, x, n in zip(ids.tolist(), extra.tolist(), lens.tolist()):
            docs.append((x, i, raw[at:at + n]))
            at += n
    docs.sort()
    own = [d for d in docs if not d[0]]
    heads = [d for d in docs if d[0]][:1]
    every = own + heads
    raw = [np.frombuffer(d[2], np.uint8) for d in every]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    found = _anchors(np.concatenate(raw) if raw else np.zeros(0, np.uint8), off)
    sk = [sketch(*f) for f in found]
    chars = [np.flatnonzero((r & 0xC0) != 0x80) for r in raw]

    tails, cuts, shas = [], [], []
    for i in range(len(own)):
        after = (i + 1) % len(every)
        n = len(chars[i])
        m = n // 4
        cut = int(chars[i][n - m]) if m else len(raw[i])
        borrowed = raw[after][:int(chars[after][m]) if m < len(chars[after]) else len(raw[after])]
        digest = hashlib.sha256(raw[i][:cut])
        digest.update(borrowed)
        shas.append(digest.hexdigest())
        cuts.append(cut)
        tails.append(np.concatenate([raw[i][max(0, cut - K + 1):cut], borrowed]))
    toff = np.concatenate([[0], np.cumsum([len(t) for t in tails])]).astype(np.int64)
    late = _anchors(np.concatenate(tails) if tails else np.zeros(0, np.uint8), toff)
    rows = {f.name: [] for f in RESULT}
    for i, d in enumerate(own):
        cut, tail = cuts[i], tails[i]
        if cut + (len(tail) - min(cut, K - 1)) < K:          # a short text is one anchor
            edited = sketch(*_short(tail))
        else:
            early = found[i][0] + K <= cut if len(raw[i]) >= K else np.zeros(len(found[i][0]), bool)
            more = late[i] if len(tail) >= K else (np.zeros(0, np.int64), np.zeros(0, U64))
            edited = sketch(np.concatenate([found[i][0][early], more[0] + max(0, cut - K + 1)]),
                            np.concatenate([found[i][1][early], more[1]]))
        for name, v in (("doc_id", d[1]), ("n_chars", len(chars[i])), ("edited_sha256", shas[i]), ("fingerprint", _text(sk[i])),
                        ("edited_fingerprint", _text(edited)), ("near_edited", likeness(sk[i], edited)),
                        ("near_next", likeness(sk[i], sk[(i + 1) % len(every)]))):
            rows[name].append(v)
    return pa.Table.from_batches([batch_of(RESULT, **rows)])


def fingerprints(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents meet their successors in buckets of consecutive doc_ids, whose
    bounds are ids of the table (approximate percentiles), so the first document of
    each bucket is known from its id and goes to the bucket before as well."""
    small_batches(docs.sparkSession)
    d = id_and_text(docs)
    first, n, size = d.agg(F.min("doc_id"), F.count(F.lit(1)), F.sum(F.octet_length("text").cast("long"))).first()
    buckets = int(max(1, min(n, -(-(size or 0) // bucket_bytes))))
    cuts = d.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0] if buckets > 1 else []
    bounds = np.unique(np.array([first if n else 0, *cuts], np.int64))
    sent = d.mapInArrow(_route(bounds), "bucket long, rows binary, blob binary")
    return give_back_ids(sent.groupBy("bucket").applyInArrow(_bucket, ddl(RESULT)))
