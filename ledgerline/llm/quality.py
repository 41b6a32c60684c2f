"""Quality classifier (7): an interpolated modified Kneser-Ney model of trusted text.

Texts become a stream of symbols: characters, with digits as one symbol, white space as
one space, and a word that repeats the word before it as one symbol, another for the second repeat in a row
and so on (ordinary text has few of the first and hardly any of the later ones). The model is of order 3 over these symbols, trained on all documents labelled as of good
quality. Counting and scoring are joins by trigram, sharded by its hash: each chunk of
documents sends every shard its trigrams with the documents and counts they have there; a shard adds up
the trusted counts; discounted and back-off probabilities come from joins of the
count tables (trigram, its context, its shorter forms); each shard returns sums of log-probabilities per
document, which add up to the perplexity.

Thresholds are language by language: from the median m and the ``QUANTILE`` quantile q of the trusted
documents' log-perplexity (each weighed by its length against that of very short ones,
see ``settled``) a document is rejected beyond m + ``SLACK`` * (q - m). A language with fewer than
``LEAST_TRUSTED`` trusted documents uses the thresholds of all of them; without any trusted
document all are kept and the perplexity is null.

Defined cases: a null or blank text is kept (there is nothing to judge: its stream is the end
symbol); a null language is a language of its own; equal rows get equal decisions; labels of
documents that are not there, and nulls in labels, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.llm.common import (NULL_ID, U64, Words, batch_of, dec, enc, free_names, give_back_ids, id_and_text, keep_table, lean, mix,
                                   shard_bits, slices, small_batches, texts)

START, END = 2, 3
DITTO = 0x110000        # above all characters; the d-th repeat of a word in a row is DITTO + d
QUANTILE = 0.99
SLACK = 4.0
SETTLE = 200          # symbols after which a text's perplexity counts by half at least
LEAST_TRUSTED = 50
CHUNK_BYTES = 4 << 20
PER_SHARD = 16 << 20

POST = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()),
                  ("lang", pa.string()), ("n", pa.int64()), ("blob", pa.binary())])
_POST_DDL = "kind int, chunk long, at long, doc_id long, h long, lang string, n long, blob binary"


def symbols(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol streams of some texts, one after the other, and their offsets. Each has two start symbols and an end."""
    n = len(off) - 1
    words = Words(np.arange(n), data, off)
    h = words.hashes()
    again = np.flatnonzero((h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])) + 1
    nth = np.arange(len(again))
    nth = nth - np.maximum.accumulate(np.where(np.diff(again, prepend=-1) != 1, nth, 0)) + 1
    raw = words.data                                       # texts set apart by a space
    lead = (raw & 0xC0) != 0x80
    cp = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.uint32)
    place = np.cumsum(lead) - 1                            # byte -> character
    own = np.repeat(np.arange(n), np.diff(np.append(place[words.offsets[:-1]], len(cp)))) if n else np.zeros(0, int)
    cp[(cp >= 48) & (cp <= 57)] = 48
    blank = (cp == 32) | ((cp >= 9) & (cp <= 13))
    cp[blank] = 32
    keep = ~(blank & np.concatenate([[True], blank[:-1]]))  # one blank of a run
    edge = np.zeros(len(cp) + 1, np.int32)
    a, b = place[words.start[again]], place[words.end[again] - 1] + 1
    np.add.at(edge, a, 1)
    np.subtract.at(edge, b, 1)
    inside = np.cumsum(edge[:-1]) > 0
    keep &= ~inside
    cp[a] = DITTO + np.minimum(nth, 0xFFFF)
    keep[a] = True
    last = np.append(place[words.offsets[1:-1]] - 1, len(cp) - 1) if n else np.zeros(0, int)
    keep[last] = True                                      # the separator stands for the end
    cp[last] = END
    first = np.append(place[words.offsets[:-1]], len(cp))
    kept = np.concatenate([[0], np.cumsum(keep)])[first]
    size = np.diff(kept) + 2
    out = np.full(int(size.sum()), START, np.uint32)
    to = np.cumsum(size) - size
    body = cp[keep]
    out[np.arange(len(body)) + 2 * (own[keep] + 1)] = body
    return out, np.append(to, len(out))


def trigrams(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct trigrams (three 21-bit symbols) with counts."""
    out = []
    for part in slices(data, off):
        s, cut = symbols(*part)
        s = s.astype(U64)
        key = (s[:-2] << U64(42)) | (s[1:-1] << U64(21)) | s[2:] if len(s) > 2 else np.zeros(0, U64)
        for a, b in zip(cut[:-1], cut[1:]):
            g = np.sort(key[a:b - 2])
            new = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            out.append((g[new], np.diff(np.r_[new, len(g)])))
    return out


def _post(chunk_bytes: int, bits: int):
    """Rows of kind 0: the documents of a chunk; of kind 1: for a shard, trigrams with their documents and counts."""
    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        docs, grams, held = [], [], 0

        def flush():
            nonlocal chunk, docs, grams, held
            key = np.concatenate([g for g, _ in grams])
            count = np.concatenate([c for _, c in grams]).astype(np.uint32)
            doc = np.repeat(np.arange(len(grams), dtype=np.uint32), [len(g) for g, _ in grams])
            u, inv = np.unique(key, return_inverse=True)
            shard = (mix(u.copy()) >> U64(64 - bits)).astype(np.int64)
            o = np.lexsort((u, shard))
            rank = np.empty(len(u), np.int64)
            rank[o] = np.arange(len(u))
            order = np.argsort(rank[inv], kind="stable")
            doc, count = doc[order], count[order]
            per = np.bincount(rank[inv], minlength=len(u))
            u, shard = u[o], shard[o]
            ends = np.cumsum(per)
            step = doc.copy()
            step[1:] -= doc[:-1]
            step[ends[:-1]] = doc[ends[:-1]]               # documents of a trigram as differences
            edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            n = len(docs)
            yield batch_of(POST, kind=[0] * n, chunk=[chunk] * n, at=list(range(n)), doc_id=[d[0] for d in docs], h=[d[1] for d in docs],
                           lang=[d[2] for d in docs], n=[int(c.sum()) for _, c in grams], blob=[None] * n)
            out = []
            for a, b in zip(edge, [*edge[1:], len(u)]):
                x, y = ends[a] - per[a], ends[b - 1]
                out.append((int(shard[a]), enc(u[a:b], per[a:b].astype(np.uint32), step[x:y], count[x:y])))
            n = len(out)
            none = [None] * n
            yield batch_of(POST, kind=[1] * n, chunk=[chunk] * n, at=[s for s, _ in out], doc_id=none, h=none, lang=none, n=none,
                           blob=[b for _, b in out])
            chunk, docs, grams, held = chunk + 1, [], [], 0

        for batch in batches:
            data, off = texts(batch)
            docs += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "lang")))
            grams += trigrams(data, off)
            held += len(data)
            if held >= chunk_bytes:
                yield from flush()
        if docs:
            yield from flush()
    return run


def opened(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams, place of each posting's trigram, document, count)."""
    u, per, step, count = dec(blob)
    which = np.repeat(np.arange(len(u)), per)
    total = np.cumsum(step.astype(np.int64))
    ends = np.cumsum(per.astype(np.int64))
    before = total[ends - per.astype(np.int64)] - step[ends - per.astype(np.int64)].astype(np.int64) if len(u) else total[:0]
    return u, which, total - before[which], count.astype(np.int64)


def _train(table: pa.Table) -> pa.Table:
    """All trigrams of a shard with their count in trusted documents (0: none)."""
    keys, sums = [], []
    for blob, trusted in zip(table.column("blob"), table.column("trusted").to_pylist()):
        u, which, doc, count = opened(blob.as_py())
        good = np.zeros(int(doc.max()) + 1 if len(doc) else 1, bool)
        t = np.array(trusted or [], np.int64)
        good[t[t < len(good)]] = True
        keys.append(u)
        sums.append(np.bincount(which, weights=count * good[doc], minlength=len(u)))
    u, inv = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(inv, weights=np.concatenate(sums), minlength=len(u)).astype(np.int64)
    shard = table.column("at")[0].as_py()
    return pa.table({"at": pa.array([shard] * len(u), pa.int64()), "gram": pa.array(u.astype(np.int64)), "n": pa.array(n)})


def _score(post: pa.Table, prob: pa.Table) -> pa.Table:
    """Per chunk, the sums of log-probabilities that its documents have in this shard."""
    gram = prob.column("gram").to_numpy().astype(U64)
    logp = prob.column("logp").to_numpy()
    o = np.argsort(gram)
    gram, logp = gram[o], logp[o]
    out = []
    for chunk, blob in zip(post.column("chunk").to_pylist(), post.column("blob")):
        u, which, doc, count = opened(blob.as_py())
        own = logp[np.searchsorted(gram, u)]
        sums = np.bincount(doc, weights=own[which] * count)
        out.append((chunk, enc(sums)))
    return pa.table({"chunk": pa.array([c for c, _ in out], pa.int64()), "blob": pa.array([b for _, b in out], pa.binary())})


def _sum(table: pa.Table) -> pa.Table:
    parts = [dec(b.as_py())[0] for b in table.column("blob")]
    total = np.zeros(max(map(len, parts)))
    for p in parts:
        total[:len(p)] += p
    return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()] * len(total), pa.int64()),
                     "at": pa.array(np.arange(len(total))), "logp": pa.array(total)})


def discounts(counts: DataFrame, column: str) -> list[float]:
    """The three discounts of modified Kneser-Ney, from how many entries have count 1, 2, 3, 4."""
    row = counts.agg(*[F.sum((F.col(column) == k).cast("long")) for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (int(x or 0) for x in row)
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [k - (k + 1) * y * b / a if a else k * 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [min(max(d, 0.1), k - 0.1) for k, d in enumerate(raw, 1)]


def _contexts(counts: DataFrame, key, column: str, d: list[float], name: str) -> DataFrame:
    """Per context: the total and the mass set free by the discounts, as a share of it."""
    n = F.col(column)
    free = F.sum(F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2]))
    return counts.groupBy(key.alias(name)).agg(F.sum(n).alias(f"{name}_total"), free.alias(f"{name}_free"))


def kneser_ney(seen: DataFrame) -> DataFrame:
    """(at, gram, n) with trusted counts -> (at, gram, logp) for every row, seen in training or not."""
    low = F.lit((1 << 42) - 1)
    tri = seen.where("n > 0").select("gram", "n")
    bi = tri.groupBy(F.col("gram").bitwiseAND(low).alias("pair")).agg(F.count(F.lit(1)).alias("n2"))
    uni = bi.groupBy(F.col("pair").bitwiseAND(F.lit((1 << 21) - 1)).alias("one")).agg(F.count(F.lit(1)).alias("n1"))
    tri, bi, uni = (keep_table(x, "counts") for x in (tri, bi, uni))
    d3, d2, d1 = discounts(tri, "n"), discounts(bi, "n2"), discounts(uni, "n1")
    c3 = _contexts(tri, F.shiftright("gram", 21), "n", d3, "c3")
    c2 = _contexts(bi, F.shiftright("pair", 21), "n2", d2, "c2")
    total1, free1, types = uni.agg(F.coalesce(F.sum("n1"), F.lit(0)), F.sum(F.when(F.col("n1") == 1, d1[0]).when(F.col("n1") == 2, d1[1]).otherwise(d1[2])),
                                   F.count(F.lit(1))).first()
    if not total1:
        return seen.select("at", "gram", F.lit(0.0).alias("logp"))

    def less(n: str, d: list[float]):
        c = F.coalesce(F.col(n), F.lit(0))
        return F.when(c == 0, 0.0).when(c == 1, 1 - d[0]).when(c == 2, 2 - d[1]).otherwise(c - d[2])

    x = seen.select("at", "gram", F.shiftright("gram", 21).alias("c3"), F.col("gram").bitwiseAND(low).alias("pair"))
    x = x.withColumn("c2", F.shiftright("pair", 21)).withColumn("one", F.col("pair").bitwiseAND(F.lit((1 << 21) - 1)))
    x = x.join(tri, "gram", "left").join(c3, "c3", "left").join(bi, "pair", "left").join(c2, "c2", "left").join(uni, "one", "left")
    p1 = (less("n1", d1) + F.lit(float(free1)) / (types + 1)) / float(total1)
    p2 = F.when(F.col("c2_total").isNull(), p1).otherwise((less("n2", d2) + F.col("c2_free") * p1) / F.col("c2_total"))
    p3 = F.when(F.col("c3_total").isNull(), p2).otherwise((less("n", d3) + F.col("c3_free") * p2) / F.col("c3_total"))
    return x.select("at", "gram", F.log(p3).alias("logp"))


def settled(logppl, n, middle):
    """A short text's log-perplexity drawn towards the middle: one of SETTLE symbols by half."""
    return middle + (logppl - middle) * n / (n + SETTLE)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, least_trusted: int = LEAST_TRUSTED,
             chunk_bytes: int = CHUNK_BYTES, per_shard: int = PER_SHARD) -> DataFrame:
    """doc_id, h (hash of text and language), lang, n_symbols, perplexity, threshold, kept: one row per row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    lang = F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit("n"))
    d = id_and_text(docs, lang.alias("lang"))
    d = d.withColumn("h", F.xxhash64("text", "lang"))
    size = d.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    bits = shard_bits(int(size) // 3, per_shard)           # a posting for about three bytes
    post = keep_table(d.mapInArrow(lean(_post(chunk_bytes, bits)), _POST_DDL), "postings")
    rows = post.where("kind = 0").select("chunk", "at", "doc_id", "h", "lang", "n")
    sent = post.where("kind = 1").select("chunk", "at", "blob")
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    marked = keep_table(rows.join(good.withColumn("good", F.lit(True)), "doc_id", "left")
                        .withColumn("good", F.coalesce("good", F.lit(False))), "rows")
    trusted = marked.where("good").groupBy("chunk").agg(F.collect_list("at").alias("trusted"))
    seen = keep_table(sent.join(trusted, "chunk", "left").groupBy("at").applyInArrow(lean(_train), "at long, gram long, n long"), "trigrams")
    prob = kneser_ney(seen)
    sums = sent.groupBy("at").cogroup(prob.groupBy("at")).applyInArrow(lean(_score), "chunk long, blob binary")
    sums = sums.groupBy("chunk").applyInArrow(lean(_sum), "chunk long, at long, logp double")
    scored = keep_table(marked.join(sums, ["chunk", "at"]).withColumn("x", -F.col("logp") / F.col("n")), "scores")

    g = scored.where("good")
    any_trusted = g.limit(1).count() > 0
    middle = g.groupBy("lang").agg(F.percentile_approx("x", 0.5, 10000).alias("m"), F.count(F.lit(1)).alias("k"))
    all_m = g.agg(F.percentile_approx("x", 0.5, 10000)).first()[0] if any_trusted else 0.0
    # one row a language, broadcast behind its count: a hot language must not meet in one task
    own = g.join(broadcast_if_small(middle), "lang").withColumn("y", settled(F.col("x"), F.col("n"), F.col("m")))
    per = own.groupBy("lang").agg(F.max("m").alias("m"), F.max("k").alias("k"), F.percentile_approx("y", quantile, 10000).alias("q"))
    all_q = g.agg(F.percentile_approx(settled(F.col("x"), F.col("n"), F.lit(all_m)), quantile, 10000)).first()[0] if any_trusted else 0.0
    few = F.coalesce(F.col("k"), F.lit(0)) < least_trusted
    out = scored.join(broadcast_if_small(per), "lang", "left").withColumn("m", F.when(few, F.lit(all_m)).otherwise(F.col("m"))) \
        .withColumn("q", F.when(few, F.lit(all_q)).otherwise(F.col("q")))
    limit = F.col("m") + slack * (F.col("q") - F.col("m"))
    known = F.lit(any_trusted)
    out = out.select("doc_id", "h", F.when(F.col("lang") != "n", F.substring("lang", 2, 1 << 30)).alias("lang"), F.col("n").alias("n_symbols"),
                     F.when(known, F.exp("x")).alias("perplexity"), F.when(known, F.exp(limit)).alias("threshold"),
                     (~known | (F.col("n") <= 1) | (settled(F.col("x"), F.col("n"), F.col("m")) <= limit)).alias("kept"))
    return give_back_ids(out)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    own, row = free_names(docs, "_id", "_h")
    bad = classify(docs, labels).where("not kept").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias(own), F.col("h").alias(row)).distinct()
    lang = F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit("n"))
    d = (docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
         .withColumn(row, F.xxhash64(F.coalesce(F.col("text"), F.lit("")), lang)))
    return d.join(bad, [own, row], "left_anti").select(*docs.columns)
