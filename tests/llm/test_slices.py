"""Bounds on what a task works on at a time change no result."""

import numpy as np

from ledgerline.llm import packing, suffix_dedup


def table(spark):
    rng = np.random.default_rng(6)
    shared = ["".join(rng.choice(list("abcd efgh"), 90)) for _ in range(5)]
    rows = []
    for i in range(80):
        own = "".join(rng.choice(list("ijkl mnop"), int(rng.integers(0, 120))))
        rows.append((i, own[:40] + shared[i % 5][int(rng.integers(0, 20)):] + own[40:] + (shared[0] if i % 3 == 0 else ""), "en", "s"))
    return spark.createDataFrame([*rows, rows[7], (None, rows[3][1], None, None), (200, None, "en", "s")], "doc_id long, text string, lang string, source string").repartition(3)


def by_hand(rows, length=50):
    """What each document keeps, string by string."""
    first, big = {}, 1 << 62
    texts = [((big if i is None else i), (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for a in range(len(t) - length + 1):
            s = t[a:a + length]
            first[s] = min(first.get(s, big), i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if first[t[a:a + length]] < i:
                gone[a:a + length] = True
        out.append((None if i == big else i, int(gone.sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out, key=str)


def test_suffix_buckets_in_slices(spark, monkeypatch):
    docs = table(spark)
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()])
    for records, strings in ((20_000, 200_000), (5, 7), (1, 1)):
        monkeypatch.setattr(suffix_dedup, "SLICE_RECORDS", records)
        monkeypatch.setattr(suffix_dedup, "SLICE_STRINGS", strings)
        got = suffix_dedup.suffix_dedup(docs).collect()
        assert sorted(((r.doc_id, r.n_removed, bytes(r.kept)) for r in got), key=str) == want


def one_chunk(texts):
    """A batch with a chunk of the texts, as pack_corpus stores it."""
    import struct

    import pyarrow as pa

    from ledgerline.llm.common import squeeze
    ids, ends = np.arange(len(texts)), np.cumsum([0] + [len(t) for t in texts])
    raw = struct.pack("<Q", len(texts)) + ids.tobytes() + ends.tobytes() + b"".join(texts)
    return pa.RecordBatch.from_pydict({"chunk": [0], "blob": [squeeze(raw)]})


def test_suffix_shards_are_filled_evenly():
    """Smallest hashes are small numbers: shards by their upper bits got 27 times their share, cells as well."""
    from ledgerline.llm.common import dec
    rng = np.random.default_rng(8)
    batch = one_chunk([bytes(rng.integers(97, 123, 2000, dtype=np.uint8)) for _ in range(100)])
    out, = suffix_dedup._sketch(50, 24, 4, 24)([batch])
    n = [len(dec(b)[0]) for b in out.column("blob").to_pylist()]
    assert len(n) == 16 and max(n) < 1.5 * sum(n) / 16


def test_suffix_runs_in_stretches(spark, monkeypatch):
    """Runs cut where a stretch of the chunk ends, and strings of hot runs hashed a few at a time, change no result."""
    docs = table(spark)
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()])
    for stretch, strings in ((1 << 17, 200_000), (61, 7), (1, 1)):
        monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
        monkeypatch.setattr(suffix_dedup, "SLICE_STRINGS", strings)
        got = suffix_dedup.suffix_dedup(docs, chunk_bytes=3000, per_shard=200, bucket_records=20).collect()
        assert sorted(((r.doc_id, r.n_removed, bytes(r.kept)) for r in got), key=str) == want


def test_suffix_room_does_not_grow_with_the_text():
    """The k-grams of a chunk, or of one long text, are worked out in stretches."""
    import tracemalloc
    rng = np.random.default_rng(9)
    for n in (1, 200):
        batch = one_chunk([bytes(rng.integers(97, 123, (1 << 20) // n, dtype=np.uint8)) for _ in range(n)])
        tracemalloc.start()
        list(suffix_dedup._sketch(50, 24, 4, 31)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 50 << 20


def test_token_batches(spark, monkeypatch):
    docs = table(spark)
    want = sorted(map(str, packing.token_pieces(docs).collect()))
    monkeypatch.setattr(packing, "BATCH_CHARS", 100)
    assert sorted(map(str, packing.token_pieces(docs).collect())) == want


def test_join_sends_sets_and_signatures_as_differences():
    """The sets of the second reading and the signatures of the prefixes take less room than their numbers, and come back whole."""
    import pyarrow as pa

    from ledgerline.llm import ngram_join as J
    from ledgerline.llm.common import U64, dec

    rng = np.random.default_rng(2)
    docs = [" ".join(f"w{k}" for k in rng.integers(0, 10 ** 6, 300)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"text": docs, "p1": np.zeros(60, np.int64), "p2": np.zeros(60, np.int64)})
    none, want = np.zeros(0, U64), J.gram_sets(batch)
    sent = [b for out in J._sets(5, none, none, np.ones(1 << 21, np.uint32))([batch]) for b in out.column("grams").to_pylist()]
    assert sum(map(len, sent)) < 0.92 * sum(g.nbytes for g in want)
    assert all((dec(b)[0] == g).all() for b, g in zip(sent, want))
    shards = [dec(b) for out in J._prefixes(5, 75, none, none, 5)([batch]) for b in out.column("blob").to_pylist()]
    assert all((s[2][1:] > s[2][:-1]).all() for s in shards)
    size = {J.signature(g): (len(g), set(g[:J.prefix_size(len(g))].tolist())) for g in want}
    got = {}
    for gram, node, sig, sizes in shards:
        for k, s in enumerate(sig.view(np.int64).tolist()):
            assert size[s][0] == sizes[k]
            got.setdefault(s, set()).update(gram[node == k].tolist())
    assert got == {s: g for s, (_, g) in size.items()}


def test_words_of_a_batch_are_worked_out_in_stretches(monkeypatch):
    """N-grams and symbols are those of all texts at once, but room grows with a stretch of texts, not with the batch."""
    import tracemalloc

    import pyarrow as pa

    from ledgerline.llm import common, ngram_join, quality

    rng = np.random.default_rng(4)
    words = np.array([f"w{k}" for k in range(5000)] + ["Äé", "  ", "x x x", "\n"])
    docs = ["", " ", *(" ".join(rng.choice(words, int(n))) for n in rng.integers(0, 40, 200)), ""]
    batch = pa.RecordBatch.from_pydict({"text": docs})
    monkeypatch.setattr(common, "SLICE_BYTES", 1 << 30)
    grams, marks = ngram_join.gram_sets(batch), quality.trigrams(*common.texts(batch))
    for most in (1, 100, 3000):
        monkeypatch.setattr(common, "SLICE_BYTES", most)
        assert [g.tolist() for g in ngram_join.gram_sets(batch)] == [g.tolist() for g in grams]
        assert [(g.tolist(), n.tolist()) for g, n in quality.trigrams(*common.texts(batch))] == [(g.tolist(), n.tolist()) for g, n in marks]
    monkeypatch.undo()

    batch = pa.RecordBatch.from_pydict({"text": [" ".join(rng.choice(words, 1500)) for _ in range(400)]})
    for work in (lambda: ngram_join.gram_sets(batch), lambda: quality.trigrams(*common.texts(batch))):
        tracemalloc.start()
        kept = work()
        left, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert len(kept) == 400 and peak - left < 12 * batch.nbytes


def test_workers_keep_one_kind_and_give_back(monkeypatch):
    from ledgerline.llm import common

    common.process_cache("word ids")["path"] = 1
    assert common.process_cache("word ids") == {"path": 1}
    common.rolling(np.arange(5, dtype=np.uint64))
    assert common.process_cache("word ids") == {}
    told = []
    monkeypatch.setattr(common, "give_back_memory", lambda: told.append(1))

    def doubled(batches):
        for b in batches:
            yield 2 * b

    def failing(table):
        raise ValueError(table)

    assert list(common.lean(doubled)([1, 2])) == [2, 4] and len(told) == 1
    common.lean(doubled)([1]).close()
    assert common.lean(lambda t: t + 1)(1) == 2 and common.lean(lambda a, b: a + b)(1, 2) == 3 and len(told) == 3
    try:
        common.lean(failing)(1)
    except ValueError:
        assert len(told) == 4


def test_prefixes_meet_as_by_hand():
    """Pairs of sets that share prefix n-grams, from several messages with sets sent twice; none where all n-grams come once."""
    import pyarrow as pa

    from ledgerline.llm import ngram_join as J
    from ledgerline.llm.common import U64, enc

    rng = np.random.default_rng(8)
    sets = {int(s): (int(rng.integers(90, 130)), np.sort(rng.choice(400, 12, replace=False)).astype(U64)) for s in rng.integers(1, 1 << 62, 60)}

    def message(sigs):
        node = np.repeat(np.arange(len(sigs), dtype=np.uint32), [len(sets[s][1]) for s in sigs])
        gram = np.concatenate([sets[s][1] for s in sigs])
        o = np.argsort(gram, kind="stable")
        return enc(gram[o], node[o], np.array(sigs, np.int64).view(U64), np.array([sets[s][0] for s in sigs], np.uint32))

    sigs = sorted(sets)
    parts = [message(p) for p in (sigs[:25], sigs[20:40], sigs[35:])]
    got = J._meet(75, 24)(pa.table({"blob": pa.array(parts, pa.binary())})).to_pylist()
    want = {}
    for i, a in enumerate(sigs):
        for b in sigs[i + 1:]:
            n = len(np.intersect1d(sets[a][1], sets[b][1]))
            if n and 100 * min(sets[a][0], sets[b][0]) >= 75 * max(sets[a][0], sets[b][0]):
                want[a, b] = (sets[a][0], sets[b][0], n)
    assert {(r["a"], r["b"]): (r["na"], r["nb"], r["n"]) for r in got} == want and all(r["kind"] == 0 for r in got)
    alone = enc(np.arange(9, dtype=U64), np.zeros(9, np.uint32), np.array([7], U64), np.array([9], np.uint32))
    assert J._meet(75, 24)(pa.table({"blob": pa.array([alone], pa.binary())})).num_rows == 0
