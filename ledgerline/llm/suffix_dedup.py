"""Suffix-array dedup (5): byte strings of ``length`` bytes that a document with a smaller doc_id holds as well.

Every string of ``length`` bytes holds a k-gram of smallest hash; strings that share
that k-gram and are next to each other form a run, one suffix record per run,
led by the k-gram. Only runs whose k-gram occurs in two documents can matter: a
first pass finds them (each chunk sends the distinct hash cells of its k-grams,
as in a count-min row; none that repeats is lost). Smallest hashes crowd at small numbers, so they are mixed once more
before their upper bits name a cell and its shard. Their suffixes are
range-partitioned by leading bytes with sampled splitters; a bucket sorts its
suffixes by multikey quicksort, 8 bytes a key, refining only ties, so equal
records become neighbours. The smallest document of each distinct record is kept; records that
differ but share the k-gram are compared string by string (two 64-bit hashes of the bytes).
Splitters cut between different leading bytes; ranges of one frequent lead, and all ranges where there would be
more than ``MOST_SPLITTERS``, are cut further by the hash of the whole k-gram. So all suffixes
that share a k-gram meet in one bucket and no match crosses a boundary.

Within a chunk, equal records of later documents are settled at once, so a passage that
very many documents share sends one record a chunk. Its edges do not: there every document has its own record around
one k-gram. The first pass also adds up the records of each cell, and a k-gram with more than
``bucket_records`` / ``HOT_PART`` of them is hot. Hot records are not gathered by k-gram: a chunk takes the smallest document of
each of their strings, and these minima meet by the hash of the whole string.

Defined cases: a null text is empty (0 bytes, nothing removed); a text shorter than ``length``
keeps all; rows with the same doc_id are one document (no removal between them); rows
repeated whole therefore both stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import (U64, Chunk, batch_of, byte_values, ddl, dec, enc, give_back_ids, keep_table, leading, lean,
                                   member, mix, pack_corpus, rolling, shard_bits, spans, with_lists)
from ledgerline.llm.substring_dedup import CELLS_PER_WINDOW, TO_CHUNK, TO_SHARD, cells_of, _by_shard

LENGTH, K = 50, 24
PER_SHARD = 1 << 20
BUCKET_RECORDS = 50_000
SLICE_RECORDS, SLICE_STRINGS = 20_000, 200_000   # of a bucket, worked on at a time
HOT_PART = 10
STRETCH = 1 << 17    # strings of a chunk whose k-grams are worked out together
MOST_SPLITTERS = 10_000
STRINGS = 1 << 40     # shards from here on hold strings of hot records
_Q2 = 0x94D049BB133111EB

RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()), ("kept", pa.binary())])


class Runs:
    """Runs of neighbouring strings with one smallest k-gram: start, number of strings, document, that k-gram's hash and place,
    and the hash of the whole run. Worked out ``STRETCH`` strings at a time; a run ends where its stretch does."""

    def __init__(self, chunk: Chunk, length: int, k: int):
        n = len(chunk.data) - length + 1
        got = [np.zeros((6, 0), np.int64), *(self._stretch(chunk, a, min(STRETCH, n - a), length, k) for a in range(0, n, STRETCH))]
        self.start, self.count, self.doc, self.at = (np.concatenate([g[i] for g in got]) for i in range(4))
        self.low, self.same = (np.concatenate([g[i].astype(U64) for g in got]) for i in (4, 5))

    @staticmethod
    def _stretch(chunk: Chunk, a: int, n: int, length: int, k: int) -> tuple[np.ndarray, ...]:
        """Of the runs among the ``n`` strings from place ``a`` on."""
        w = length - k + 1
        data, off = chunk.data[a:a + n + length - 1], chunk.offsets
        prefix = rolling(byte_values(data))
        pos = np.arange(len(data) - k + 1)
        grams = spans(prefix, pos, pos + k)
        low, width = grams, 1
        while 2 * width <= w:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:n], low[w - width:w - width + n])
        here = a + np.arange(n)
        doc = np.searchsorted(off, here, "right") - 1
        fits = here + length <= off[doc + 1]
        new = np.r_[True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])]
        start = np.flatnonzero(new)
        count = np.diff(np.r_[start, n])
        # strings that reach into the next document come last in theirs
        good = np.concatenate([[0], np.cumsum(fits)])
        count = good[start + count] - good[start]
        start, count = start[count > 0], count[count > 0]
        # a text of equal bytes has one smallest k-gram all along: no run is longer than a k-gram stays inside
        parts = -(-count // w)
        first = np.repeat(np.cumsum(parts) - parts, parts)
        nth = np.arange(len(first)) - first
        start = np.repeat(start, parts) + nth * w
        count = np.minimum(np.repeat(count, parts) - nth * w, w)
        doc, low = doc[start], low[start]
        # the k-gram lies at or after the run's last string's start
        at = tail = start + count - 1
        for i in range(0, len(tail), 20_000):
            t, v = tail[i:i + 20_000], low[i:i + 20_000]
            at[i:i + 20_000] = t + np.argmax(grams[t[:, None] + np.arange(w)[None, :]] == v[:, None], axis=1)
        size = count + length - 1
        same = spans(prefix, start, start + size) ^ mix(size.astype(U64))
        # smallest hashes are small: mixed, else the first of 64 shards (by upper bits) gets a third of all runs
        return a + start, count, doc, a + at, mix(low), same


def _own_records(c: Chunk, runs: Runs, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the runs ``keep``: the document, and whether an earlier document of the chunk has the same record."""
    doc, same = c.ids[runs.doc[keep]], runs.same[keep]
    order = np.lexsort((doc, same))
    head = np.r_[True, same[order][1:] != same[order][:-1]] if len(order) else np.zeros(0, bool)
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))] if len(order) else order
    smallest = np.empty(len(order), np.int64)
    smallest[order] = doc[first]
    return doc, doc > smallest


def _sketch(length: int, k: int, bits: int, cell_bits: int):
    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                c = Chunk(blob.as_py())
                runs = Runs(c, length, k)
                # one entry per cell; "2 or more" only if two documents of the chunk have it; the records the chunk would send
                cell = cells_of(runs.low, cell_bits)
                doc, later = _own_records(c, runs, np.arange(len(cell)))
                order = np.lexsort((doc, cell))
                cell, doc = cell[order], doc[order]
                new = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, int)
                last = np.r_[new[1:], len(cell)] - 1 if len(new) else new
                cells, two = cell[new], doc[new] != doc[last]
                times = np.add.reduceat(~later[order], new, dtype=np.int64) if len(new) else new
                times = np.minimum(times, 65535).astype(np.uint16)
                out = [(s, enc(cells[a:b], np.packbits(two[a:b]), times[a:b])) for s, a, b in _by_shard(cells << U64(64 - cell_bits), bits)]
                yield batch_of(TO_SHARD, shard=[s for s, _ in out], chunk=[chunk] * len(out), blob=[b for _, b in out])
    return run


def _repeated(hot: int):
    """Adds up the sketches of one shard; each chunk gets back its cells that count 2 or more in all, and which of
    them have more than ``hot`` records in all."""
    def run(table: pa.Table) -> pa.Table:
        got = [dec(b.as_py()) for b in table.column("blob")]
        cells = np.concatenate([g[0] for g in got])
        twice = np.concatenate([np.unpackbits(g[1], count=len(g[0])).astype(bool) for g in got])
        times = np.concatenate([g[2] for g in got]).astype(np.int64)
        order = np.argsort(cells, kind="stable")
        edge = np.flatnonzero(np.r_[True, cells[order][1:] != cells[order][:-1]])
        per = np.diff(np.r_[edge, len(cells)])
        hit, many = np.zeros(len(cells), bool), np.zeros(len(cells), bool)
        hit[order] = np.repeat((per > 1) | np.logical_or.reduceat(twice[order], edge), per)
        many[order] = np.repeat(np.add.reduceat(times[order], edge) > hot, per)
        ends = np.cumsum([len(g[0]) for g in got])
        back = []
        for c, g, e in zip(table.column("chunk").to_pylist(), got, ends):
            own = hit[e - len(g[0]):e]
            if own.any():
                back.append((c, enc(g[0][own], many[e - len(g[0]):e][own].astype(np.uint8))))
        return pa.Table.from_batches([batch_of(TO_CHUNK, chunk=[c for c, _ in back], blob=[b for _, b in back])])
    return run


def _spans_of(at: np.ndarray, length: int) -> bytes:
    """The strings at ascending places as spans; neighbours (always of one document) as one."""
    up = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
    return enc(at[up].astype(U64), at[np.r_[up[1:], len(at)] - 1] - at[up] + length)


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many slices, one after the other."""
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return data[np.arange(int(size.sum())) + shift]


def _string_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Every string of many slices: its slice, its place there and two hashes."""
    strings = size - length + 1
    who = np.repeat(np.arange(len(start)), strings)
    at = np.arange(len(who)) - np.repeat(np.cumsum(strings) - strings, strings)
    values = byte_values(_slices(data, start, size))
    here = (np.cumsum(size) - size)[who] + at
    return who, at, spans(rolling(values), here, here + length), spans(rolling(mix(values), _Q2), here, here + length, _Q2)


def _hot_strings(c: Chunk, start: np.ndarray, count: np.ndarray, doc: np.ndarray, length: int, bits: int) -> tuple[np.ndarray, list]:
    """Places of the strings that an earlier document of the chunk has; the others as messages to the shards of their hashes."""
    at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    doc = np.repeat(doc, count)
    h, g = np.empty(len(at), U64), np.empty(len(at), U64)
    ends, a = np.cumsum(count), 0
    while a < len(start):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + SLICE_STRINGS, "right")))
        h[done:ends[b - 1]], g[done:ends[b - 1]] = _string_hashes(c.data, start[a:b], count[a:b] + length - 1, length)[2:]
        a = b
    o = np.lexsort((doc, g, h))
    at, doc, h, g = at[o], doc[o], h[o], g[o]
    new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]
    late = doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
    settled, own = np.sort(at[late]), ~late
    at, doc, h, g = at[own], doc[own], h[own], g[own]
    return settled, [(STRINGS + s, enc(h[a:b], g[a:b], doc[a:b], at[a:b].astype(np.uint32 if len(c.data) < 1 << 32 else U64)))
                     for s, a, b in _by_shard(h, bits)]


def _strings(table: pa.Table, length: int) -> pa.Table:
    """Each chunk gets back its strings that a document with a smaller id has."""
    got = [dec(b.as_py()) for b in table.column("blob")]
    h, g, doc, at = (np.concatenate([x[i] for x in got]) for i in range(4))
    o = np.lexsort((doc, g, h))
    new = np.r_[True, (h[o][1:] != h[o][:-1]) | (g[o][1:] != g[o][:-1])]
    late = np.zeros(len(o), bool)
    late[o] = doc[o] > doc[o][np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
    ends = np.cumsum([len(x[0]) for x in got])
    back = [(c, _spans_of(np.sort(at[e - len(x[0]):e][late[e - len(x[0]):e]].astype(np.int64)), length))
            for c, x, e in zip(table.column("chunk").to_pylist(), got, ends) if late[e - len(x[0]):e].any()]
    return pa.Table.from_batches([batch_of(TO_CHUNK, chunk=[c for c, _ in back], blob=[b for _, b in back])])


def _suffixes(length: int, k: int, cell_bits: int, splitters: np.ndarray, weight: np.ndarray, subs: int, hot_bits: int):
    """Records to the buckets (0 and up), strings of hot records to the shards of their hashes (``STRINGS`` and up); what
    a chunk settles itself goes back to it (a group of its own, below 0)."""
    def run(batches):
        for batch in batches:
            for chunk, blob, got in zip(batch.column("chunk").to_pylist(), batch.column("blob"), batch.column("got").to_pylist()):
                if not got:
                    continue
                flagged, hot = (np.concatenate(x) for x in zip(*map(dec, got)))
                by_cell = np.argsort(flagged)
                flagged, hot = flagged[by_cell], hot[by_cell] > 0
                c = Chunk(blob.as_py())
                runs = Runs(c, length, k)
                cell = cells_of(runs.low, cell_bits)
                keep = np.flatnonzero(member(cell, flagged))
                start, size, at, low = runs.start[keep], runs.count[keep] + length - 1, runs.at[keep], runs.low[keep]
                doc, later = _own_records(c, runs, keep)
                out = []
                if later.any():
                    out.append((-1 - chunk, chunk, enc(start[later].astype(U64), size[later])))
                is_hot = ~later & hot[np.searchsorted(flagged, cell[keep])] if len(keep) else later
                if is_hot.any():
                    settled, sent = _hot_strings(c, start[is_hot], runs.count[keep][is_hot], doc[is_hot], length, hot_bits)
                    if len(settled):
                        out.append((-1 - chunk, chunk, _spans_of(settled, length)))
                    out += [(s, chunk, b) for s, b in sent]
                s = np.flatnonzero(~later & ~is_hot)
                lead = leading(c.data, at[s])
                bucket = np.searchsorted(splitters, lead, "right")
                parts = np.full(len(s), subs)
                if len(splitters):                        # a lead that takes up several splitters is cut in as many
                    own = np.maximum(bucket - 1, 0)
                    parts = np.where(splitters[own] == lead, weight[own] * subs, subs)
                bucket = bucket + (len(splitters) + 1) * (mix(low[s]) % parts.astype(U64)).astype(np.int64)
                s = s[np.argsort(bucket, kind="stable")]
                bucket = np.sort(bucket, kind="stable")
                edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
                for a, b in zip(edge, [*edge[1:], len(bucket)]):
                    own = s[a:b]
                    out.append((int(bucket[a]), chunk, enc(start[own].astype(U64), size[own].astype(np.uint32), doc[own],
                                                           (at[own] - start[own]).astype(np.uint8), _slices(c.data, start[own], size[own]))))
                yield batch_of(TO_SHARD, shard=[o[0] for o in out], chunk=[o[1] for o in out], blob=[o[2] for o in out])
    return run


def multikey_order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by several keys, the next key only inside ties of those before; also the
    number of the class of equal rows, per ordered row."""
    n = len(keys[0])
    order, cls = np.arange(n), np.zeros(n, np.int64)
    live = np.arange(n)                                   # places still tied
    for key in keys:
        if len(live) < 2:
            break
        inner = np.lexsort((key[order[live]], cls[live]))
        order[live] = order[live][inner]
        v = key[order[live]]
        new = np.r_[True, (v[1:] != v[:-1]) | (cls[live][1:] != cls[live][:-1])]
        at = np.flatnonzero(new)
        cls[live] = live[at][np.cumsum(new) - 1]          # a class is named by its first place
        size = np.diff(np.r_[at, len(live)])
        live = live[np.repeat(size > 1, size)]
    return order, cls


def _words_of(data: np.ndarray, start: np.ndarray, size: np.ndarray, words: int) -> list[np.ndarray]:
    """The first 8 * words bytes of each slice as big-endian numbers (zero bytes after its end)."""
    out = []
    for j in range(words):
        v = np.zeros(len(start), U64)
        for i in range(8 * j, 8 * j + 8):
            inside = i < size
            v = (v << U64(8)) | np.where(inside, data[np.where(inside, start + i, 0)], 0).astype(U64)
        out.append(v)
    return out


def _by_gram(data: np.ndarray, start: np.ndarray, size: np.ndarray, lead: np.ndarray, k: int) -> list[np.ndarray]:
    """A bucket's records in slices of about ``SLICE_RECORDS``, in the order of their k-grams; a k-gram is in one slice."""
    if len(start) <= SLICE_RECORDS:
        return [np.arange(len(start))]
    order, cls = multikey_order(_words_of(data, start + lead, np.minimum(size - lead, k), -(-k // 8)))
    head = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    cuts = head[np.unique(np.searchsorted(head, np.arange(0, len(order), SLICE_RECORDS)).clip(max=len(head) - 1))]
    return np.split(order, cuts[cuts > 0])


def _shared(data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray, lead: np.ndarray, length: int, k: int):
    """What other records with smaller documents have of some records (whole k-grams of them): record, place in it, bytes."""
    suffix = _words_of(data, start + lead, size - lead, -(-(2 * length - k) // 8))
    gram = 8 * (k // 8) == k and k // 8
    order, cls = multikey_order([*suffix, size, *_words_of(data, start, lead, -(-2 * (length - k) // 8) or 1)])
    least = np.full(len(order), np.iinfo(np.int64).max)
    np.minimum.at(least, cls, doc[order])             # smallest document of each distinct record
    gone = np.zeros(len(order), bool)
    gone[order] = doc[order] > least[cls]
    # distinct records that share their k-gram: compare string by string
    head = np.unique(cls)
    rep = order[head]
    grams = np.stack([suffix[j][rep] for j in range(gram)]) if gram else np.stack(_words_of(data, start[rep] + lead[rep], np.full(len(rep), k), -(-k // 8)))
    change = np.r_[True, (grams[:, 1:] != grams[:, :-1]).any(axis=0)] if len(rep) else np.zeros(0, bool)
    group = np.cumsum(change) - 1
    several = np.bincount(group)[group] > 1 if len(rep) else change
    owner, fro, to = _late_strings(data, start[rep[several]], size[rep[several]], least[cls[head[several]]], cls[head[several]], group[several], length)
    # parts of the records whose document is the smallest of its class, and whole records
    of_cls = np.empty(len(order), np.int64)
    of_cls[order] = cls
    o = np.argsort(owner, kind="stable")
    owner, fro, to = owner[o], fro[o], to[o]
    a, b = np.searchsorted(owner, of_cls, "left"), np.searchsorted(owner, of_cls, "right")
    times = np.where(gone, 0, b - a)
    src = np.repeat(np.arange(len(order)), times)
    nth = np.repeat(a, times) + np.arange(len(src)) - np.repeat(np.cumsum(times) - times, times)
    w = np.flatnonzero(gone)
    return np.concatenate([w, src]), np.concatenate([np.zeros(len(w), np.int64), fro[nth]]), np.concatenate([size[w], to[nth] - fro[nth]])


def _late_strings(data: np.ndarray, start: np.ndarray, size: np.ndarray, least: np.ndarray, name: np.ndarray, group: np.ndarray, length: int):
    """Runs of strings that a smaller document's record of the same group has: record's name, from, to. Groups lie together
    and are worked through some ``SLICE_STRINGS`` strings at a time."""
    out = [(np.zeros(0, np.int64),) * 3]
    total = np.cumsum(size - length + 1)
    ends = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1 if len(group) else np.zeros(0, np.int64)
    a = 0
    while a < len(start):
        room = np.searchsorted(total, (total[a - 1] if a else 0) + SLICE_STRINGS, "right")
        fits = ends[(ends > a) & (ends <= room)]
        b = int(fits[-1]) if len(fits) else int(ends[ends > a][0])      # a group at least
        own = slice(a, b)
        who, at, h, g = _string_hashes(data, start[own], size[own], length)
        d = least[own][who]
        o = np.lexsort((d, g, h))
        new = np.r_[True, (h[o][1:] != h[o][:-1]) | (g[o][1:] != g[o][:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))
        late = np.zeros(len(o), bool)
        late[o] = d[o] > d[o][first]
        mark = np.r_[False, late, False]                       # runs of such strings inside a record
        cut = np.r_[True, who[1:] != who[:-1], True]
        up = np.flatnonzero(mark[1:-1] & (~mark[:-2] | cut[:-1]))
        down = np.flatnonzero(mark[1:-1] & (~mark[2:] | cut[1:]))
        out.append((name[own][who[up]], at[up], at[down] + length))
        a = b
    return tuple(np.concatenate(x) for x in zip(*out))


def _bucket(length: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:          # settled by its chunk
            return table.select(["chunk", "blob"])
        if table.column("shard")[0].as_py() >= STRINGS:
            return _strings(table, length)
        got = [(c, dec(b.as_py())) for c, b in zip(table.column("chunk").to_pylist(), table.column("blob"))]
        n = [len(g[0]) for _, g in got]
        pos, size, doc, lead = (np.concatenate([g[i] for _, g in got]) for i in range(4))
        size, lead = size.astype(np.int64), lead.astype(np.int64)
        data = np.concatenate([g[4] for _, g in got])
        start = np.cumsum(size) - size
        pos = pos.astype(np.int64)
        rec, begin, span = [], [], []
        for own in _by_gram(data, start, size, lead, k):
            r, fro, n_bytes = _shared(data, start[own], size[own], doc[own], lead[own], length, k)
            r = own[r]
            rec.append(r)
            begin.append(pos[r] + fro)
            span.append(n_bytes)
        rec, begin, span = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rec, begin, span))
        chunk_no = np.repeat(np.arange(len(n)), n)[rec]
        o = np.lexsort((begin, chunk_no))
        chunk_no, begin, span = chunk_no[o], begin[o], span[o]
        cuts = np.searchsorted(chunk_no, np.arange(len(n) + 1))
        back = [(got[i][0], enc(begin[x:y].astype(U64), span[x:y])) for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
        return pa.Table.from_batches([batch_of(TO_CHUNK, chunk=[c for c, _ in back], blob=[b for _, b in back])])
    return run


def _remove(batches):
    for batch in batches:
        for blob, got in zip(batch.column("blob"), batch.column("got").to_pylist()):
            c = Chunk(blob.as_py())
            edge = np.zeros(len(c.data) + 1, np.int64)
            for b in got or []:
                begin, span = dec(b)
                begin = begin.astype(np.int64)
                np.add.at(edge, begin, 1)
                np.subtract.at(edge, begin + span.astype(np.int64), 1)
            gone = np.cumsum(edge[:-1]) > 0
            off = c.offsets
            total = np.concatenate([[0], np.cumsum(gone)])
            up = np.r_[True, ~gone[:-1]] & gone if len(gone) else gone
            up[off[:-1][np.diff(off) > 0]] = gone[off[:-1][np.diff(off) > 0]]
            begun = np.concatenate([[0], np.cumsum(up)])
            kept = [c.data[a:b][~gone[a:b]].tobytes() for a, b in zip(off[:-1], off[1:])]
            yield batch_of(RESULT, doc_id=c.ids, n_bytes=np.diff(off), n_removed=np.diff(total[off]), n_spans=np.diff(begun[off]),
                           kept_sha256=[hashlib.sha256(x).hexdigest() for x in kept], kept=kept)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, k: int = K, chunk_bytes: int = 2 << 20, per_shard: int = PER_SHARD,
                 bucket_records: int = BUCKET_RECORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay)."""
    chunks = pack_corpus(docs, chunk_bytes)
    n = int(chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0])
    runs = max(1, 2 * n // (length - k + 2))              # about one smallest k-gram in half a window
    bits = shard_bits(runs, per_shard)
    cell_bits = max(bits, (CELLS_PER_WINDOW * runs - 1).bit_length())
    buckets = int(max(1, runs // 4 // bucket_records))
    subs = -(-buckets // MOST_SPLITTERS)                  # ranges are cut by hash where splitters alone would be too many
    ranges = -(-buckets // subs)
    splitters, weight = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if ranges > 1:                                        # a few numbers: percentiles of 32 sampled places a chunk
        cuts = chunks.select(F.explode("lead").alias("lead")).agg(
            F.percentile_approx("lead", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
        splitters, weight = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    sketches = chunks.mapInArrow(lean(_sketch(length, k, bits, cell_bits)), ddl(TO_SHARD))
    repeated = keep_table(sketches.groupBy("shard").applyInArrow(lean(_repeated(bucket_records // HOT_PART)), ddl(TO_CHUNK)), "cells")
    # strings are at most as many as bytes, some 14 a run: four times the shards of the runs hold them
    sent = with_lists(chunks, repeated).mapInArrow(lean(_suffixes(length, k, cell_bits, splitters, weight, subs, bits + 2)), ddl(TO_SHARD))
    gone = keep_table(sent.groupBy("shard").applyInArrow(lean(_bucket(length, k)), ddl(TO_CHUNK)), "gone")
    return give_back_ids(with_lists(chunks, gone).mapInArrow(lean(_remove), ddl(RESULT)))
