"""Secret scans (9): a randomness battery over tokens, with false-discovery control.

Base findings are three patterns (assign, access, hex). The method adds spans of
kind ``random``: runs of 20 or more characters of ``[A-Za-z0-9+/_=-]`` with a letter and a
digit that no base span touches. For each such token the encoding is inferred (the
smallest alphabet that holds it) and three tests ask whether it looks drawn evenly
from that alphabet: chi-squared over the alphabet, runs above and below its middle, lag-1
serial correlation; Simes' rule combines them. Evidence against ordinary
text is the likelihood ratio of the even alphabet to the character frequencies of the whole
corpus; it grows with length, and 1/ratio bounds a p-value, so ordering ratios by the
Benjamini-Hochberg rule for such e-values, within each length class, keeps the expected share of
false findings of the class at ``FDR``. A token is added when the ratio passes and the battery
does not reject.

The texts are read once. Candidates and base spans are stored; frequencies (128 numbers)
and the thresholds (one number a length class) come from sums over all of them.

Defined cases: a null text is empty; places count code points, ends exclusive; equal rows
give equal results; a null doc_id comes back null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, give_back_ids, id_and_text, keep_table, small_batches, texts

# fixed values of the base findings
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16, "random": 20}

FDR = 0.01
BATTERY = 0.001
LENGTH_CLASSES = (20, 32, 48, 64)
STEPS = 4            # bins of the log ratio per unit; the threshold is a bin's lower edge
TOP_BIN = 400

_D, _L, _U = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (_D + "abcdef", _D + "ABCDEF", _U + "234567", _D + _L, _D + _U, _D + _L + _U, _U + _L + _D + "+/", _U + _L + _D + "-_",
             _U + _L + _D + "+/-_")

_TOKEN, _DIGIT, _ALPHA, _HEXD, _KEYED = (np.isin(np.arange(256), list(x.encode())) for x in
                                         (_D + _L + _U + "+/_=-", _D, _L + _U, _D + "abcdef", _U + _D))

FOUND = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("base", pa.string()), ("starts", pa.list_(pa.int64())),
                   ("tokens", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_FOUND_DDL = "kind int, doc_id long, base string, starts array<long>, tokens array<string>, counts array<long>"
SCORED = "doc_id long, base string, starts array<long>, ends array<long>, classes array<int>, bins array<int>"
RESULT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_random", pa.int64())])


def long_runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = b - a >= least
    return a[keep], b[keep]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, order of kind, end) of the base findings, sorted."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]] if "=" in text or ":" in text else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]] if "AKIA" in text else []
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


def listed(found) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _scan(batches):
    total = np.zeros(128, np.int64)
    for batch in batches:
        data, off = texts(batch)
        ids = batch.column("doc_id").to_pylist()
        total += np.bincount(data[data < 128], minlength=128)
        apart = np.insert(data, off[1:-1], 32) if len(off) > 2 else data      # runs end where texts do
        shift = off + np.arange(len(off))
        doc_of = lambda at: np.searchsorted(shift, at, "right") - 1
        digits, letters = (np.concatenate([[0], np.cumsum(t[apart])]) for t in (_DIGIT, _ALPHA))
        a, b = long_runs(_TOKEN[apart], LEAST["random"])
        good = (digits[b] > digits[a]) & (letters[b] > letters[a])
        a, b = a[good], b[good]
        some = np.zeros(len(ids), bool)
        some[doc_of(a)] = True
        some[doc_of(long_runs(_HEXD[apart], LEAST["hex"])[0])] = True
        some[doc_of(long_runs(_KEYED[apart], LEAST["access"])[0])] = True
        some[doc_of(np.flatnonzero((apart == 61) | (apart == 58)))] = True
        rows = {f.name: [] for f in FOUND}
        cut = np.searchsorted(a, shift)
        for i, doc_id in enumerate(ids):
            base, starts, tokens = [], [], []
            if some[i]:
                raw = data[off[i]:off[i + 1]].tobytes()
                base = base_spans(raw.decode())
                for x, y in zip((a[cut[i]:cut[i + 1]] - shift[i]).tolist(), (b[cut[i]:cut[i + 1]] - shift[i]).tolist()):
                    at = len(raw[:x].decode())
                    if not any(s < at + y - x and at < e for s, _, e in base):
                        starts.append(at)
                        tokens.append(raw[x:y].decode())
            for name, v in (("kind", 0), ("doc_id", doc_id), ("base", listed(base)), ("starts", starts), ("tokens", tokens), ("counts", None)):
                rows[name].append(v)
        yield batch_of(FOUND, **rows)
    yield batch_of(FOUND, kind=[1], doc_id=[None], base=[None], starts=[None], tokens=[None], counts=[total.tolist()])


def _tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[int, float]:
    """(size of the inferred alphabet, combined p-value of the three tests against an even draw from it)."""
    s = token.rstrip("=").replace("=", "")
    alphabet = next((x for x in ALPHABETS if all(c in x for c in s)), ALPHABETS[-1])
    n, size = len(s), len(alphabet)
    v = np.array([alphabet.find(c) for c in s], float)
    counts = np.bincount(v.astype(int), minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    p = [_tail((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (1 - 1 / n)))]
    high = v >= size / 2
    n1, n0 = int(high.sum()), int((~high).sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean, var = 1 + 2 * n1 * n0 / n, 2 * n1 * n0 * (2 * n1 * n0 - n) / (n * n * (n - 1)) if n > 1 else 0
    p.append(_tail((runs - mean) / math.sqrt(var)) if var > 0 else 0.0)
    d = v - v.mean()
    p.append(_tail(float((d[1:] * d[:-1]).sum() / (d * d).sum()) * math.sqrt(n)) if (d * d).sum() > 0 else 0.0)
    p.sort()
    return size, min(1.0, min(p[i] * len(p) / (i + 1) for i in range(len(p))))


def _score(frequency: np.ndarray):
    cost = -np.log(frequency)

    def run(batches):
        for batch in batches:
            rows = {n: [] for n in ("doc_id", "base", "starts", "ends", "classes", "bins")}
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "base", "starts", "tokens")]
            for doc_id, base, starts, tokens in zip(*cols):
                ends, classes, bins = [], [], []
                for at, t in zip(starts, tokens):
                    size, p = battery(t)
                    ratio = float(cost[np.frombuffer(t.encode(), np.uint8)].sum()) - len(t) * math.log(size)
                    ends.append(at + len(t))
                    classes.append(sum(len(t) >= c for c in LENGTH_CLASSES) - 1)
                    bins.append(min(TOP_BIN, math.floor(ratio * STEPS)) if p >= BATTERY else -1)
                for n, v in (("doc_id", doc_id), ("base", base), ("starts", starts), ("ends", ends), ("classes", classes), ("bins", bins)):
                    rows[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(rows["base"], pa.string()),
                                              *[pa.array(rows[n], pa.list_(pa.int64())) for n in ("starts", "ends")],
                                              *[pa.array(rows[n], pa.list_(pa.int32())) for n in ("classes", "bins")]], list(rows))
    return run


def _thresholds(scored: DataFrame, fdr: float) -> dict[int, int]:
    """The lowest bin of each length class whose tokens are findings (a few rows of sums)."""
    bins = (scored.select(F.explode(F.arrays_zip("classes", "bins")).alias("t")).select("t.classes", F.greatest("t.bins", F.lit(-1)).alias("bin"))
            .groupBy("classes", "bin").agg(F.count(F.lit(1)).alias("n")))
    down = Window.partitionBy("classes").orderBy(F.desc("bin"))
    bins = (bins.withColumn("k", F.sum("n").over(down)).withColumn("m", F.sum("n").over(Window.partitionBy("classes")))
            .where((F.col("bin") >= 0) & (F.col("bin") / F.lit(float(STEPS)) >= F.log(F.col("m") / (F.lit(fdr) * F.col("k"))))))
    return {r["classes"]: r["bin"] for r in bins.groupBy("classes").agg(F.min("bin").alias("bin")).collect()}


def _findings(thresholds: dict[int, int]):
    def run(batches):
        for batch in batches:
            rows = {f.name: [] for f in RESULT}
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "base", "starts", "ends", "classes", "bins")]
            for doc_id, base, starts, ends, classes, bins in zip(*cols):
                own = [(int(a), KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in base.split(",") if x)]
                more = [(a, 3, b) for a, b, c, v in zip(starts, ends, classes, bins) if c in thresholds and v >= thresholds[c]]
                count = [sum(k == i for _, k, _ in own) for i in range(3)]
                for n, v in zip(RESULT.names, (doc_id, *count, hashlib.sha256(base.encode()).hexdigest(), listed(sorted(own + more)), len(more))):
                    rows[n].append(v)
            yield batch_of(RESULT, **rows)
    return run


def scan_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (base findings), base_sha256, spans (all), n_random (added)."""
    small_batches(docs.sparkSession)
    found = keep_table(id_and_text(docs).mapInArrow(_scan, _FOUND_DDL), "found")
    counts = np.zeros(128)
    for r in found.where("kind = 1").select(F.posexplode("counts").alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n")).collect():
        counts[r["c"]] = r["n"]
    token = _TOKEN[:128]
    frequency = np.where(token, counts + 1, 1)
    frequency = frequency / frequency[token].sum()
    scored = keep_table(found.where("kind = 0").select("doc_id", "base", "starts", "tokens").mapInArrow(_score(frequency), SCORED), "scored")
    out = scored.mapInArrow(_findings(_thresholds(scored, fdr)),
                            "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
    return give_back_ids(out)
