"""Substring dedup (8) with a count-min prefilter.

A window is ``window`` consecutive words of one document. Pass one: every chunk
of documents counts its windows in a count-min row (cells of a hash; counts stop
at 2) whose width grows with the corpus, and sends the cells it used to the
shards of the row, where the chunks' sketches are added up. A cell's count is never
below a window's, so a window whose cell stays at 1 occurs once. Pass two: chunks
send only windows estimated to repeat, each once with its first place, and the
shards group them exactly by 128 hash bits. Pass three: each word covered by a
window that also starts earlier is removed.

A chunk sends one entry per cell or window however often it holds it, so a window
that a third of all documents share costs one entry per chunk.

Defined cases: a null or blank text has no words and comes back empty; rows with
the same doc_id are the same document to the order (a window at the same start of
both is not "earlier"); fewer words than a window: nothing is removed; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import (U64, Chunk, Words, batch_of, ddl, dec, enc, give_back_ids, keep_table, member, merged,
                                   mix, pack_corpus, rolling, shard_bits, spans, string_array, with_lists)

WINDOW = 20
CELLS_PER_WINDOW = 32
PER_SHARD = 2 << 20
_Q, _Q2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

TO_SHARD = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])
TO_CHUNK = pa.schema([("chunk", pa.int64()), ("blob", pa.binary())])
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash, second hash) of every window."""
    n = len(words.start) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    at = np.flatnonzero(words.doc[:n] == words.doc[size - 1:])
    h = words.hashes()
    return at, spans(rolling(h, _Q), at, at + size, _Q), spans(rolling(mix(h.copy()), _Q2), at, at + size, _Q2)


def _by_shard(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of ascending hashes, by their upper bits."""
    top = (keys >> U64(64 - bits)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, top[1:] != top[:-1]]) if len(top) else []
    return [(int(top[a]), a, b) for a, b in zip(edge, [*edge[1:], len(top)])]


def cells_of(keys: np.ndarray, cell_bits: int) -> np.ndarray:
    return keys >> U64(64 - cell_bits)


def counted(keys: np.ndarray, bits: int, cell_bits: int) -> list[tuple[int, bytes]]:
    """A chunk's sketch, by shard: its cells, and which of them count 2 or more."""
    cells, n = np.unique(cells_of(keys, cell_bits), return_counts=True)
    return [(s, enc(cells[a:b], np.packbits(n[a:b] > 1))) for s, a, b in _by_shard(cells << U64(64 - cell_bits), bits)]


def _sketch(size: int, bits: int, cell_bits: int):
    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                _, h, _ = windows(Words.of(Chunk(blob.as_py())), size)
                out = counted(h, bits, cell_bits)
                yield batch_of(TO_SHARD, shard=[s for s, _ in out], chunk=[chunk] * len(out), blob=[b for _, b in out])
    return run


def add_up(table: pa.Table) -> pa.Table:
    """Adds up the sketches of one shard; each chunk gets back its cells that count 2 or more in all."""
    got = [dec(b.as_py()) for b in table.column("blob")]
    cells = np.concatenate([g[0] for g in got])
    twice = np.concatenate([np.unpackbits(g[1], count=len(g[0])).astype(bool) for g in got])
    order = np.argsort(cells, kind="stable")
    run = cells[order]
    same = run[1:] == run[:-1]
    hit = np.zeros(len(cells), bool)
    hit[order[1:]] |= same
    hit[order[:-1]] |= same
    hit |= twice
    ends = np.cumsum([len(g[0]) for g in got])
    back = [(c, enc(g[0][hit[e - len(g[0]):e]])) for c, g, e in zip(table.column("chunk").to_pylist(), got, ends)
            if hit[e - len(g[0]):e].any()]
    return pa.Table.from_batches([batch_of(TO_CHUNK, chunk=[c for c, _ in back], blob=[b for _, b in back])])


def _exact(size: int, bits: int, cell_bits: int):
    def run(batches):
        for batch in batches:
            for chunk, blob, got in zip(batch.column("chunk").to_pylist(), batch.column("blob"), batch.column("got").to_pylist()):
                flagged = merged(got)
                if not len(flagged):
                    continue
                words = Words.of(Chunk(blob.as_py()))
                at, h, g = windows(words, size)
                keep = member(cells_of(h, cell_bits), flagged)
                at, h, g = at[keep], h[keep], g[keep]
                doc = words.ids[words.doc[at]]
                start = at - words.first[words.doc[at]]
                order = np.lexsort((start, doc, g, h))
                h, g, doc, start = h[order], g[order], doc[order], start[order]
                one = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])] if len(h) else np.zeros(0, bool)
                h, g, doc, start = h[one], g[one], doc[one], start[one].astype(np.uint32)
                out = [(s, enc(h[a:b], g[a:b], doc[a:b], start[a:b])) for s, a, b in _by_shard(h, bits)]
                yield batch_of(TO_SHARD, shard=[s for s, _ in out], chunk=[chunk] * len(out), blob=[b for _, b in out])
    return run


def _group(table: pa.Table) -> pa.Table:
    """Exact grouping of one shard: each chunk gets back the windows whose first occurrence is earlier than its own."""
    got = [dec(b.as_py()) for b in table.column("blob")]
    h, g, doc, start = (np.concatenate([x[i] for x in got]) for i in range(4))
    order = np.lexsort((start, doc, g, h))
    h, g, doc, start = h[order], g[order], doc[order], start[order]
    head = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]
    first = np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))
    late = np.zeros(len(h), bool)
    late[order] = (doc != doc[first]) | (start != start[first])
    ends = np.cumsum([len(x[0]) for x in got])
    back = [(c, enc(x[0][late[e - len(x[0]):e]])) for c, x, e in zip(table.column("chunk").to_pylist(), got, ends)
            if late[e - len(x[0]):e].any()]
    return pa.Table.from_batches([batch_of(TO_CHUNK, chunk=[c for c, _ in back], blob=[b for _, b in back])])


def removed_words(words: Words, size: int, elsewhere: np.ndarray) -> np.ndarray:
    """Which words a window covers that starts earlier here or (hash in ``elsewhere``) in another chunk."""
    cover = np.zeros(len(words.start) + 1, np.int64)
    at, h, g = windows(words, size)
    late = member(h, elsewhere)
    ranked = np.sort(h)
    twice = np.flatnonzero(member(h, ranked[1:][ranked[1:] == ranked[:-1]]))
    doc, start = words.ids[words.doc[at[twice]]], at[twice] - words.first[words.doc[at[twice]]]
    order = np.lexsort((start, doc, g[twice], h[twice]))
    hh, gg, doc, start = h[twice][order], g[twice][order], doc[order], start[order]
    if len(hh):
        head = np.r_[True, (hh[1:] != hh[:-1]) | (gg[1:] != gg[:-1])]
        first = np.maximum.accumulate(np.where(head, np.arange(len(hh)), 0))
        late[twice[order]] |= (doc != doc[first]) | (start != start[first])
    np.add.at(cover, at[late], 1)
    np.subtract.at(cover, at[late] + size, 1)
    return np.cumsum(cover)[:-1] > 0


def _remove(size: int):
    def run(batches):
        for batch in batches:
            for blob, got in zip(batch.column("blob"), batch.column("got").to_pylist()):
                words = Words.of(Chunk(blob.as_py()))
                gone = removed_words(words, size, merged(got))
                n, data = len(words.ids), words.data
                keep = np.flatnonzero(~gone)
                edge = np.zeros(len(data) + 1, np.int8)
                edge[words.start[keep]] += 1
                edge[words.end[keep]] -= 1
                ink = np.cumsum(edge[:-1], dtype=np.int8) > 0
                last = keep[np.r_[words.doc[keep][1:] != words.doc[keep][:-1], True]] if len(keep) else keep
                data[words.end[keep]] = 32
                ink[words.end[keep]] = True
                ink[words.end[last]] = False
                offsets = np.concatenate([[0], np.cumsum(ink)])[words.offsets]
                yield batch_of(KEPT, doc_id=words.ids, n_words=np.diff(words.first),
                               n_removed=np.bincount(words.doc[gone], minlength=n), text=string_array(data[ink], offsets))
    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = 4 << 20, per_shard: int = PER_SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, text (the words that stay, joined by one space)."""
    chunks = pack_corpus(docs, chunk_bytes)
    n = int(chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0])
    bits = shard_bits(n, per_shard)
    cell_bits = max(bits, (CELLS_PER_WINDOW * max(n, 1) - 1).bit_length())
    sketches = chunks.mapInArrow(_sketch(window, bits, cell_bits), ddl(TO_SHARD))
    repeated = keep_table(sketches.groupBy("shard").applyInArrow(add_up, ddl(TO_CHUNK)), "cells")
    exact = with_lists(chunks, repeated).mapInArrow(_exact(window, bits, cell_bits), ddl(TO_SHARD))
    late = keep_table(exact.groupBy("shard").applyInArrow(_group, ddl(TO_CHUNK)), "late")
    return give_back_ids(with_lists(chunks, late).mapInArrow(_remove(window), ddl(KEPT)))
