"""Toxicity (13): a subsequence string-kernel support vector machine with Nystroem landmarks.

Words are compared by a gap-weighted subsequence kernel: a word is the vector of its
subsequences of three characters (its edges count as characters) that span at most ``SPAN``
places, each weighing ``DECAY`` per character skipped; the kernel is the cosine of two such vectors,
cubed. An insult with characters put in between, left out or added at its end keeps most of
its subsequences. Characters that are no letters, digits or underscores are dropped from words before, and letters set
apart by blanks ("i d i o t") count as one word. A sentence is the sum of its words
in the kernel's space, approximated by ``LANDMARKS`` landmark words (Nystroem). Landmarks are
picked from the words whose subsequences are commoner in toxic documents, by pivoted Cholesky steps, so that
near forms of one word don't take several places.

The machine (squared hinge loss, primal Newton steps) learns from labelled sentences: those of clean documents are
clean, of a toxic document the ones that it finds toxic itself, one at least, in a few rounds. As the kernel
expansion is a sum over words, a word's share is worked out once per task. A document's score is a logistic
function of its strongest words and sentences, the sum of its toxic words and its length, fitted on documents that
the machine did not learn from (each of ``PARTS`` parts by a machine of the others).

The model is fitted on a bounded sample of labelled rows (``TRAIN_CHARS`` characters of each class, whole texts of at most
``TRAIN_TEXT`` characters, by hash); every document is scored over its whole text. Labels, languages,
sources and ids are no inputs of a score.

Defined cases: rows with crc32(doc_id as text) mod 5 = 0 are held out; a null id is in the last fold (not held
out). A null text counts as empty; texts without words get the score of no evidence. Labels of other
documents, null labels, and labels other than 0 and 1 are ignored; of several labels of one id the largest
counts. Without labelled rows of both classes every score is the share of toxic ones (0 without any). Repeated
rows get equal scores. Words above ``WORD`` characters are scored in overlapping pieces. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import broadcast_if_small
from ledgerline.llm.common import U64, batch_of, ddl, mix

SPAN = 6
DECAY = 0.5
POWER = 3
CHANCE = 0.9995
SHORTEST = 4                     # characters of a landmark word
LANDMARKS = 128
CANDIDATES = 2500
FEWEST = 8                       # landmark words beyond chance that are enough
STRATA = 8                       # classes of documents of like length
WORD, OVERLAP = 48, 16           # longer words are cut into pieces that overlap
SENTENCE = 48                    # words of a sentence at most
ROUNDS = 4
FOLDS = 5
PARTS = 4                        # of the training rows: each is judged by a machine of the others
TRAIN_CHARS = 1_500_000
TRAIN_TEXT = 200_000
KEPT_WORDS = 400_000             # word scores that a task keeps
SLICE = 8192
BATCH_CHARS = 4 << 20

OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


# ---------------------------------------------------------------- words and sentences

_STOP, _MARK, _NOISE = re.compile(r"[.!?]+(?=\s|$)"), "\x01", re.compile(r"[^\w\s\x01]+")


def words_of(text: str) -> tuple[list[str], list[bool]]:
    """Lower-cased words of letters, digits and underscores, what else stands inside a word dropped; runs of single
    characters are one word, words above WORD characters are overlapping pieces. And whether each ends a sentence."""
    out: list[str] = []
    ends: list[bool] = []
    run: list[str] = []
    for w in _NOISE.sub("", _STOP.sub(_MARK, text.lower())).split():
        stop = w[-1] == _MARK
        if stop:
            w = w.replace(_MARK, "")
            if not w:
                if ends:
                    ends[-1] = True
                continue
        if len(w) == 1:
            run.append(w)
            if not stop:
                continue
        if run:
            joined = ["".join(run)] if len(run) > 2 else run
            out += joined
            ends += [False] * (len(joined) - 1) + [stop and len(w) == 1]
            run = []
        if len(w) > WORD:
            parts = [w[i:i + WORD] for i in range(0, len(w) - OVERLAP, WORD - OVERLAP)]
            out += parts
            ends += [False] * (len(parts) - 1) + [stop]
        elif len(w) > 1:
            out.append(w)
            ends.append(stop)
    if run:
        joined = ["".join(run)] if len(run) > 2 else run
        out += joined
        ends += [False] * len(joined)
    return out, ends


def sentence_starts(ends: list[bool]) -> np.ndarray:
    """Where sentences begin: after a word that ends one, and after SENTENCE words."""
    n = len(ends)
    first = np.flatnonzero(np.r_[True, np.array(ends[:-1], bool)])
    return np.concatenate([np.arange(a, b, SENTENCE) for a, b in zip(first, np.r_[first[1:], n])])


# ---------------------------------------------------------------- the kernel

def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of words, sparse: (word number, subsequence, weight), by word and subsequence."""
    cp = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(U64)
    own = np.repeat(np.arange(len(words), dtype=U64), [len(w) + 2 for w in words])
    keys, weights = [], []
    for a in range(1, SPAN - 1):
        for b in range(1, SPAN - a):
            n = max(len(cp) - a - b, 0)
            ok = np.flatnonzero(own[:n] == own[a + b:])
            key = cp[ok] | (cp[ok + a] << U64(21)) | (cp[ok + a + b] << U64(42))
            keys.append((own[ok] << U64(44)) | (mix(key) >> U64(20)))
            weights.append(np.full(len(ok), DECAY ** (a + b - 2), np.float32))
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    weights = np.add.reduceat(weights, new) if len(new) else weights
    word = (keys[new] >> U64(44)).astype(np.int64)
    norm = np.sqrt(np.bincount(word, weights ** 2, len(words))).astype(np.float32)
    return word, keys[new] & U64((1 << 44) - 1), weights / norm[word]


class Landmarks:
    """Kernel values of words against fixed landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        word, key, weight = subsequences(words)
        order = np.argsort(key, kind="stable")
        self.keys, self.first = np.unique(key[order], return_index=True)     # each subsequence's landmarks and weights lie together
        self.first = np.append(self.first, len(key))
        self.word, self.weight = word[order], weight[order]

    def kernel(self, vectors: tuple, n: int, power: int = POWER, keys: np.ndarray | None = None) -> np.ndarray:
        """``vectors`` as :func:`subsequences` gives them; with ``keys`` its subsequences are numbers of these."""
        word, key, weight = vectors
        m = len(self.words)
        out = np.zeros((n, m), np.float32)
        at = np.minimum(np.searchsorted(self.keys, key if keys is None else keys), len(self.keys) - 1)
        same = self.keys[at] == (key if keys is None else keys)
        if keys is not None:
            at, same = at[key], same[key]
        hit = np.flatnonzero(same)
        cuts = np.searchsorted(word[hit], np.arange(0, n + SLICE, SLICE))
        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            h = hit[lo:hi]
            f = at[h]
            size = self.first[f + 1] - self.first[f]
            own = np.repeat(np.arange(len(h)), size)
            to = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + self.first[f][own]
            part = out[k * SLICE:(k + 1) * SLICE]
            cell = (word[h][own] - k * SLICE) * m + self.word[to]
            part += np.bincount(cell, weight[h][own] * self.weight[to], part.size).reshape(part.shape)
        np.power(out, power, out=out)
        return out


# ---------------------------------------------------------------- fitting

class Sample:
    """Labelled documents as numbers of distinct words, with sentence starts."""

    def __init__(self, texts: list[str]):
        seen: dict[str, int] = {}
        self.docs, self.starts = [], []
        for t in texts:
            words, ends = words_of(t)
            self.docs.append(np.array([seen.setdefault(w, len(seen)) for w in words], np.int64))
            self.starts.append(sentence_starts(ends) if words else np.zeros(0, np.int64))
        self.words = list(seen)
        parts = [(w.astype(np.int32) + i, k, v) for i in range(0, len(self.words), SLICE) for w, k, v in [subsequences(self.words[i:i + SLICE])]]
        word, key, self.weight = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int32), np.zeros(0, U64), np.zeros(0, np.float32))
        del parts
        self.word = word
        self.keys, at = np.unique(key, return_inverse=True)
        self.mass = np.bincount(word, self.weight, len(self.words))
        self.at = at.astype(np.int32)                       # each word's subsequences by number
        del key, at
        first = np.searchsorted(self.word, np.arange(len(self.words) + 1))
        self.seen = []                                      # each document's subsequences and the part of its words that have them
        for d in map(np.unique, self.docs):
            found = np.concatenate([self.at[first[w]:first[w + 1]] for w in d]) if len(d) else np.zeros(0, np.int64)
            key, n = np.unique(found, return_counts=True)
            self.seen.append((key.astype(np.int32), (n / max(len(d), 1)).astype(np.float32)))
        size = np.array([len(x) for x, _ in self.seen])
        self.stratum = np.searchsorted(np.quantile(size, np.linspace(0, 1, STRATA + 1)[1:-1]), size)

    def kernel(self, marks: Landmarks) -> np.ndarray:
        return marks.kernel((self.word, self.at, self.weight), len(self.words), keys=self.keys)


def excess(sample: Sample, toxic: np.ndarray, use: np.ndarray) -> np.ndarray:
    """How much commoner than by chance each word's subsequences are in toxic documents: the mean of score
    statistics (the part of a document's words that have the subsequence, against documents of like length)."""
    over, var = np.zeros(len(sample.keys)), np.full(len(sample.keys), 1e-6)
    for c in range(STRATA):
        own = np.flatnonzero(use & (sample.stratum == c))
        p = toxic[own].mean() if len(own) else 0
        for i in own:
            key, part = sample.seen[i]
            over[key] += (toxic[i] - p) * part
            var[key] += p * (1 - p) * part ** 2
    word, weight = sample.word, sample.weight
    z, total = (over / np.sqrt(var)).astype(np.float32), np.zeros(len(sample.words))
    for lo in range(0, len(word), 1 << 20):
        part = slice(lo, lo + (1 << 20))
        total += np.bincount(word[part], weight[part] * z[sample.at[part]], len(total))
    return total / sample.mass


def pick_landmarks(sample: Sample, toxic: np.ndarray, use: np.ndarray) -> Landmarks:
    """Words of toxic documents whose subsequences are commoner there than the ``CHANCE`` quantile of words when the
    labels are dealt anew (within documents of like length), spread by pivoted Cholesky steps."""
    dealt, rng = toxic.copy(), np.random.default_rng(13)
    for c in range(STRATA):
        own = np.flatnonzero(use & (sample.stratum == c))
        dealt[own] = rng.permutation(toxic[own])
    has = np.array(list(map(len, sample.words))) >= SHORTEST
    share, chance = excess(sample, toxic, use), excess(sample, dealt, use)
    level = max(np.quantile(chance[has], CHANCE), 0.0) if has.any() else 0.0
    there = np.zeros(len(sample.words), bool)
    for i in np.flatnonzero(use & toxic):
        there[sample.docs[i]] = True
    share[~(there & has)] = -np.inf
    if (share > level).sum() >= FEWEST:
        share[share <= level] = -np.inf
    order = np.lexsort((sample.words, -share))[:CANDIDATES]
    order = order[np.isfinite(share[order])] if np.isfinite(share[order]).any() else order[:1]
    names = [sample.words[i] for i in order]
    marks = Landmarks(names)
    full = marks.kernel(subsequences(names), len(names), 1).astype(np.float64)
    left, value, rows, picked = np.diagonal(full).copy(), np.maximum(share[order], 1e-6), [], []
    while len(picked) < min(LANDMARKS, len(names)):
        k = int(np.argmax(left * value))
        if left[k] < 1e-3:
            break
        row = full[k] - sum((r[k] * r for r in rows), np.zeros(len(names)))
        rows.append(row / np.sqrt(left[k]))
        left = np.maximum(left - rows[-1] ** 2, 0)
        left[k] = 0
        picked.append(k)
    return Landmarks([names[k] for k in picked])


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Squared hinge loss with a ridge, Newton steps on the rows inside the margin; the last column is the bias."""
    x = np.c_[x, np.ones(len(x))]
    w, reg = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    reg[-1] = 1e-3
    inside = None
    for _ in range(30):
        now = y * (x @ w) < 1
        if inside is not None and (now == inside).all():
            break
        inside = now
        a = x[now] * weight[now][:, None]
        w = np.linalg.solve(a.T @ x[now] + np.diag(reg), a.T @ y[now])
    return w


class Machine:
    """Landmarks, what each of them adds to a word's share, and the bias."""

    def __init__(self, sample: Sample, toxic: np.ndarray, use: np.ndarray):
        self.marks = pick_landmarks(sample, toxic, use)
        share = sample.kernel(self.marks)
        gram = self.marks.kernel(subsequences(self.marks.words), len(self.marks.words)).astype(np.float64)
        value, axes = np.linalg.eigh(gram)
        root = axes / np.sqrt(np.maximum(value, 1e-6)) @ axes.T
        who = np.flatnonzero(use)
        x = np.concatenate([np.add.reduceat(share[sample.docs[i]], sample.starts[i], axis=0) if len(sample.starts[i]) else
                            np.zeros((1, share.shape[1]), np.float32) for i in who])
        own = np.repeat(np.arange(len(who)), [max(len(sample.starts[i]), 1) for i in who])
        bad = toxic[who][own]
        x = (x @ root).astype(np.float64)
        taken = np.ones(len(x), bool)
        for turn in range(ROUNDS):
            y = np.where(bad, 1.0, -1.0)
            weight = np.where(bad, 1 / max(int((bad & taken).sum()), 1), 1 / max(int((~bad).sum()), 1)) * taken.sum()
            w = svm(x[taken], y[taken], weight[taken])
            f = x @ w[:-1] + w[-1]
            best = np.full(len(who), -np.inf)
            np.maximum.at(best, own, f)
            taken = ~bad | (f > 0) | (f >= best[own])          # of toxic documents what looks toxic, one sentence at least
        self.beta, self.bias = (root @ w[:-1]).astype(np.float32), float(w[-1])

    def shares(self, words: list[str]) -> np.ndarray:
        # sums row by row: a word's share doesn't depend on the words beside it
        return np.concatenate([(self.marks.kernel(subsequences(words[i:i + SLICE]), len(words[i:i + SLICE])) * self.beta).sum(axis=1)
                               for i in range(0, len(words), SLICE)]) if words else np.zeros(0)


def evidence(share: np.ndarray, starts: np.ndarray, bias: float, longest: int) -> np.ndarray:
    """What the logistic function sees of a document, given its words' shares. A document of more than ``longest``
    words (more than the function was fitted on) counts like one of so many words with as many toxic ones in a thousand."""
    if len(share) == 0:
        return np.array([bias, 0, 0, 0, 0, 0, 0, 0.0])
    top = np.sort(np.partition(share, max(len(share) - 4, 0))[-4:])[::-1]
    top = np.maximum(np.r_[top, np.zeros(4 - len(top))], 0)
    n = min(len(share), longest)
    whole = np.log1p(np.maximum(share - 0.25, 0).sum() * n / len(share))
    lines = np.add.reduceat(share, starts) + bias
    return np.array([np.clip(lines.max(), -3, 3), *np.minimum(top, 2), whole, np.log1p(n), whole / np.log(3 + n)])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights (last: intercept) for weighted rows by Newton steps with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), x.T @ (weight * (y - p)) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """The machine and the logistic function; scores words once and keeps them."""

    def __init__(self, texts: list[str], toxic: list[bool], prior: float | None = None):
        """``prior``: share of toxic rows where the sample was drawn from (None: as in the sample)."""
        toxic = np.array(toxic, bool)
        drawn = float(toxic.mean()) if len(toxic) else 0.0
        self.prior = drawn if prior is None else prior
        self.machine = None
        sample = Sample(texts)
        if not toxic.any() or toxic.all() or not sample.words:
            return
        part = np.zeros(len(toxic), int)                        # each class dealt to the parts in turn
        for c in (True, False):
            part[toxic == c] = np.arange((toxic == c).sum()) % PARTS
        self.longest = max(map(len, sample.docs))
        x = np.zeros((len(toxic), 8))
        for k in range(PARTS):
            use = part != k
            m = Machine(sample, toxic, use if toxic[use].any() and not toxic[use].all() else np.ones(len(toxic), bool))
            share = sample.kernel(m.marks) @ m.beta
            for i in np.flatnonzero(~use):
                x[i] = evidence(share[sample.docs[i]], sample.starts[i], m.bias, self.longest)
        self.mean, self.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        self.weights = logistic((x - self.mean) / self.spread, toxic.astype(float),
                                np.where(toxic, self.prior / drawn, (1 - self.prior) / (1 - drawn)))
        self.machine = Machine(sample, toxic, np.ones(len(toxic), bool))

    def state(self) -> dict:
        """What scoring needs, as plain lists and numbers."""
        if self.machine is None:
            return {"prior": self.prior}
        m = self.machine
        return {"prior": self.prior, "words": m.marks.words, "beta": m.beta.tolist(), "bias": m.bias, "mean": self.mean.tolist(),
                "spread": self.spread.tolist(), "weights": self.weights.tolist(), "longest": self.longest}

    @classmethod
    def of(cls, state: dict) -> "Model":
        new = cls.__new__(cls)
        new.prior, new.machine = state["prior"], None
        if "words" in state:
            new.machine = Machine.__new__(Machine)
            new.machine.marks, new.machine.beta, new.machine.bias = Landmarks(state["words"]), np.array(state["beta"], np.float32), state["bias"]
            new.mean, new.spread, new.weights = (np.array(state[k]) for k in ("mean", "spread", "weights"))
            new.longest = state["longest"]
        return new

    def score(self, texts: list[str], kept: dict[str, float]) -> np.ndarray:
        if self.machine is None:
            return np.full(len(texts), self.prior)
        lists = [words_of(t) for t in texts]
        new = list({w for ws, _ in lists for w in ws if w not in kept})
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear()
            new = list({w for ws, _ in lists for w in ws})
        kept.update(zip(new, self.machine.shares(new).tolist()))
        x = np.array([evidence(np.fromiter(map(kept.__getitem__, ws), float, len(ws)), sentence_starts(ends) if ws else None, self.machine.bias, self.longest)
                      for ws, ends in lists]).reshape(len(texts), 8)
        z = ((x - self.mean) / self.spread * self.weights[:-1]).sum(axis=1) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ---------------------------------------------------------------- on Spark

def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample of the labelled rows outside the held-out fold, fitted in one task."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .filter(F.length("text") <= TRAIN_TEXT)
    sized = texts.select("doc_id", F.length("text").alias("size")).join(marks, "doc_id")
    found = {r["toxic"]: r for r in sized.groupBy("toxic").agg(F.sum("size").alias("chars"), F.count(F.lit(1)).alias("rows")).collect()}
    prior = (found[1]["rows"] if 1 in found else 0) / max(sum(r["rows"] for r in found.values()), 1)
    if len(found) < 2:
        return Model.of({"prior": prior})
    rate = F.lit(0.0)
    for c, r in found.items():
        rate = F.when(F.col("toxic") == c, F.lit(min(1.0, TRAIN_CHARS / max(r["chars"], 1)))).otherwise(rate)
    chosen = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < rate * (1 << 20))
    sample = texts.join(broadcast_if_small(chosen), "doc_id").select("doc_id", "text", "toxic")

    def train(batches):
        rows = sorted((r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())    # bounded by TRAIN_CHARS
        model = Model([t for _, t, _ in rows], [bool(y) for _, _, y in rows], prior)
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(model.state())]})

    return Model.of(json.loads(sample.repartition(1).mapInArrow(train, "model string").first()["model"]))


def _score(state: dict):
    def run(batches):
        fitted, kept = Model.of(state), {}
        for batch in batches:
            ids, out = batch.column("doc_id"), batch.column("held_out")
            texts, size = [], 0
            first = 0
            for i in range(len(batch)):
                texts.append(batch.column("text")[i].as_py())
                size += len(texts[-1])
                if size >= BATCH_CHARS or i == len(batch) - 1:
                    s = fitted.score(texts, kept)
                    yield batch_of(OUT, doc_id=ids.slice(first, len(texts)), held_out=out.slice(first, len(texts)), score=s, predicted=(s >= 0.5).astype(np.int32))
                    first, texts, size = i + 1, [], 0
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    state = fit(docs, labels).state()                            # LANDMARKS words and a number for each
    data = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("held_out", _held_out())
    return data.mapInArrow(_score(state), ddl(OUT))

