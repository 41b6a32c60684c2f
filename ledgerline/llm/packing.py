"""Best-fit packing (6) by exact-complement hashing.

Documents are tokenized and only those longer than a sequence are cut. The
packing itself is decided on the histogram of piece lengths, which has at most
``SEQ_TOKENS`` rows whatever the data: from the longest length down, the gap a
piece leaves is filled exactly by a single length, a pair or a triple that is
still available (pair sums are indexed; a triple is a length plus an indexed
pair), as often as the counts allow; what stays is packed best-fit decreasing.
The plan is a list of patterns with counts; each step of the plan uses up a
length or a class of bins, so the list is bounded by the number of lengths
too, and may go to every task. Pieces then find their place by their rank among
pieces of equal length, which is computed per hash bucket plus offsets.

Defined cases: a null or blank text is one piece, the end token; rows repeated
whole are packed separately; a null doc_id comes back as null; an empty table
gives an empty result; the tokenizer's special strings are encoded as its file
says.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, ddl, give_back_ids, hex_digits, id_and_text, keep_table, process_cache, running_before, small_batches

SEQ_TOKENS = 4096
END_ID = 1
CACHED_WORDS = 300_000
CACHED_UNITS = 500_000
BATCH_ROWS, BATCH_CHARS = 2048, 6 << 20    # texts whose distinct words are looked up together

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of texts as little-endian uint32 bytes.

    No token crosses a space or a line feed, so the ids of a text are those of
    the stretches between them. A stretch of letters, or of letters and then
    punctuation, is one or two units to the tokenizer, which lower-cases; such units are
    encoded many at a time and told apart by the tokens that end a word. Stretches
    and units are remembered in two generations of bounded size."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        for token, i in self.tok.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.young, self.old, self.units, self.old_units = {}, {}, {}, {}

    @staticmethod
    def parts(word: str) -> tuple[str, str] | None:
        """A stretch as (letters, punctuation), lower-cased, where that is all it holds and no
        character of it is special to the tokenizer's rules."""
        low = word.lower()
        core = low.rstrip(".,;:!?%&*$#)|")
        return (core, low[len(core):]) if core.isalpha() and (core.isascii() or max(core) < "\u0130") else None

    def learn_units(self, units: set[str]) -> None:
        units = units.difference(self.units)
        known = units.intersection(self.old_units)
        self.units.update((u, self.old_units[u]) for u in known)
        todo = list(units.difference(known))
        for at in range(0, len(todo), 5000):
            own = todo[at:at + 5000]
            ids = np.array(self.tok.encode(" ".join(own), add_special_tokens=False).ids, "<u4")
            cut = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cut) != len(own):
                raise ValueError("the tokenizer does not end units as expected")
            raw = ids.tobytes()
            self.units.update(zip(own, (raw[x:y] for x, y in zip([0, *cut[:-1].tolist()], cut.tolist()))))

    def learn(self, words: set[str]) -> None:
        young, old = self.young, self.old
        known = words.intersection(old)
        young.update((w, old[w]) for w in known)
        words = words.difference(known)
        plain = {w for w in words if w.isascii() and w.isalpha() and w.islower()}    # one unit as they are
        split, whole, units = [], [], set(plain)
        for w in words.difference(plain):
            if two := self.parts(w):
                split.append((w, two))
                units.update(two)
            else:
                whole.append(w)
        units.discard("")
        self.learn_units(units)
        get = self.units.get
        young.update(zip(plain, map(get, plain)))
        young.update((w, get(a) + get(b, b"")) for w, (a, b) in split)
        for w, e in zip(whole, self.tok.encode_batch(whole, add_special_tokens=False)):
            young[w] = np.array(e.ids, "<u4").tobytes()
        if len(self.units) > CACHED_UNITS:
            self.old_units, self.units = self.units, {}

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn(set().union(*split).difference(self.young))       # each distinct word of a batch is looked up once
        get = self.young.get
        out = [b"".join(map(get, words)) for words in split]
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        return out


def _cut(path: str, seq: int, end: int, with_ids: bool):
    def run(batches):
        kept = process_cache("word ids")
        tok = kept.get(path) or kept.setdefault(path, WordIds(path))
        last = np.array([end], "<u4").tobytes()
        def pieces(doc_ids, texts):
            rows = {f.name: [] for f in PIECES}
            for doc_id, ids in zip(doc_ids, tok.ids(texts)):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * seq)):
                    own = ids[at:at + 4 * seq]
                    for name, v in (("doc_id", doc_id), ("piece", piece), ("start", at // 4), ("length", len(own) // 4),
                                    ("ids_crc32", zlib.crc32(own)), ("ids", own if with_ids else None)):
                        rows[name].append(v)
            return batch_of(PIECES, **rows)

        for batch in batches:
            doc_ids, texts, first, size = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BATCH_CHARS or i == len(texts) - 1:
                    yield pieces(doc_ids[first:i + 1], texts[first:i + 1])
                    first, size = i + 1, 0
    return run


def token_pieces(docs: DataFrame, path: str | None = None, seq_tokens: int = SEQ_TOKENS, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and, if asked for, the ids as little-endian uint32)."""
    small_batches(docs.sparkSession, BATCH_ROWS)
    return id_and_text(docs).mapInArrow(_cut(path or tokenizer_path(), seq_tokens, end_id, with_ids), ddl(PIECES))


def plan(counts: dict[int, int], seq: int = SEQ_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of one sequence, number of such sequences)] that uses every piece once."""
    have = np.zeros(seq + 1, np.int64)
    for n, c in counts.items():
        have[n] += c
    out: list[tuple[tuple[int, ...], int]] = []
    there = (have > 0).astype(float)
    size = 1 << (2 * seq + 1).bit_length()
    pair_sums = np.rint(np.fft.irfft(np.fft.rfft(there, size) ** 2, size))[:seq + 1] > 0   # only ever shrinks

    def use(lengths: tuple[int, ...]) -> bool:
        need = {n: lengths.count(n) for n in lengths}
        k = int(min(have[n] // c for n, c in need.items()))
        if k <= 0:
            return False
        for n, c in need.items():
            have[n] -= c * k
        out.append((lengths, k))
        return True

    def pairs(total: int) -> list[int]:
        b = np.arange(1, total // 2 + 1)
        return b[(have[b] > 0) & (have[total - b] > 0)].tolist()[::-1]

    def complete(first: int) -> None:
        gap = seq - first
        if gap == 0:
            use((first,))
            return
        if have[gap]:
            use((first, gap))
        if have[first] and gap >= 2 and pair_sums[gap]:
            for b in pairs(gap):
                if not have[first]:
                    return
                use((first, gap - b, b))
        if have[first] and gap >= 3:
            a = np.arange(gap - 2, 0, -1)
            for x in a[(have[a] > 0) & pair_sums[gap - a]].tolist():
                if not have[first]:
                    return
                if not have[x]:
                    continue
                found = pairs(gap - x)
                if not found:
                    pair_sums[gap - x] = False
                for b in found:
                    if not have[first] or not have[x]:
                        break
                    use((first, x, gap - x - b, b))

    for length in range(seq, 0, -1):
        if have[length]:
            complete(length)

    room: dict[int, list[list]] = {}   # free tokens -> [lengths, number of such open sequences]
    for length in range(seq, 0, -1):
        left = int(have[length])
        while left:
            fit = min((g for g in room if g >= length and room[g]), default=None)
            if fit is None:
                per = seq // length
                for each, k in ((per, left // per), (left % per, 1)):
                    if each and k:
                        room.setdefault(seq - each * length, []).append([(length,) * each, k])
                break
            own = room[fit][-1]
            k = min(left, own[1])
            own[1] -= k
            if not own[1]:
                room[fit].pop()
            room.setdefault(fit - length, []).append([own[0] + (length,), k])
            left -= k
    out += [(lengths, k) for bins in room.values() for lengths, k in bins if k]
    return out


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), ascending: the k-th piece of a length
    belongs to the last row of that length whose first rank is at most k."""
    rows, used, seq = [], {}, 0
    for lengths, k in patterns:
        at = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), seq, at))
            used[n] = used.get(n, 0) + k
            at += n
        seq += k
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _place(rows: np.ndarray):
    def run(batches):
        first = {}
        edge = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else np.zeros(0, int)
        for a, b in zip(edge, [*edge[1:], len(rows)]):
            first[int(rows[a, 0])] = (a, rows[a:b, 1])
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                a, ranks = first[int(n)]
                at[own] = a + np.searchsorted(ranks, rank[own], "right") - 1
            got = rows[at]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(got[:, 2] + rank - got[:, 1]), pa.array(got[:, 3])],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str | None = None, seq_tokens: int = SEQ_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece's place."""
    pieces = keep_table(token_pieces(docs, path, seq_tokens, end_id).drop("ids"), "pieces")
    # at most seq_tokens rows, whatever the data
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan(hist, seq_tokens))
    hashed = pieces.withColumn("hash", F.md5(F.concat_ws(":", "doc_id", "piece", "ids_crc32")))
    digits = hex_digits(max(hist.values(), default=1))
    ranked = running_before(hashed, ["length"], ["doc_id", "piece"], None, digits, "rank").drop("hash")
    out = ranked.mapInArrow(_place(places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return give_back_ids(out)
