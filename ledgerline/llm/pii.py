"""PII (2): a character-level bidirectional LSTM with CRF transitions, in numpy.

Base findings are four patterns (email, ip, card, phone). Every span of these
kinds holds a digit or an "@", so the tagger reads the regions around such
characters: neighbouring ones are one region, with ``MARGIN`` characters on either side. It is trained from
labelled spans: the base findings in a bounded sample of regions, the same spans
rewritten in other notations (no plus sign, other separators), and numbers that are none of the
kinds. Long regions are read in overlapping windows; a character's scores are
averaged over the windows that hold it (the middle of a window counts most), and one Viterbi pass over the
whole region reconciles them. Decoded spans that overlap no base span, satisfy their kind's check and
are sure (mean probability ``SURE``) are added as findings.

Defined cases: a null text is empty; places count code points, ends exclusive; equal rows
give equal results; a null doc_id comes back null; an empty table, or one without
labelled spans, adds nothing; a text without digits and "@" has no findings.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, give_back_ids, id_and_text, keep_table, small_batches, texts

# fixed values of the base findings (a run of digits is always entered at its first digit)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
KINDS = ("email", "ip", "card", "phone")

MARGIN, JOIN = 24, 16
WINDOW, STRIDE = 96, 48
TRAIN_REGIONS = 600            # bound of the sample of labelled regions
SURE = 0.6
CHARS, EMBED, HIDDEN, TAGS = 130, 12, 16, 9
EPOCHS, BATCH, RATE = 10, 32, 0.02

RESULT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()),
                    ("n_added", pa.int64())])


def luhn(digits: str) -> bool:
    v = [int(c) for c in digits[::-1]]
    return (sum(v[::2]) + sum(sum(divmod(2 * x, 10)) for x in v[1::2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches: a match's local part reaches back from its "@" to the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def fits(kind: int, s: str) -> bool:
    digits = re.sub("[^0-9]", "", s)
    if kind == 0:
        return "@" in s and "." in s.split("@")[-1]
    if kind == 1:
        return len(p := s.split(".")) == 4 and all(x.isascii() and x.isdigit() and int(x) <= 255 for x in p)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of kind, end) of the base findings, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            s = m[0]
            if kind == 1 and not all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in s.split(".")):
                continue
            if kind == 1 or fits(kind, s):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def listed(found) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def regions(text: str) -> list[tuple[int, str]]:
    """(start, text) of the stretches around digits and "@"."""
    at = [m.start() for m in re.finditer("[0-9@]", text)]
    out, i = [], 0
    while i < len(at):
        j = i
        while j + 1 < len(at) and at[j + 1] - at[j] <= JOIN:
            j += 1
        a = max(0, at[i] - MARGIN)
        out.append((a, text[a:at[j] + 1 + MARGIN]))
        i = j + 1
    return out


# ---------------------------------------------------------------- the tagger

def codes(text: str) -> np.ndarray:
    v = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(v < 128, v, 128 + (v > 0x24F))


def start_model(rng) -> dict[str, np.ndarray]:
    def w(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = {"emb": w(CHARS, EMBED), "out": w(2 * HIDDEN, TAGS), "out_b": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
    for d in "fb":
        m |= {f"{d}x": w(EMBED, 4 * HIDDEN), f"{d}h": w(HIDDEN, 4 * HIDDEN), f"{d}b": np.zeros(4 * HIDDEN, np.float32)}
        m[f"{d}b"][HIDDEN:2 * HIDDEN] = 1
    return m


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(m, d, x, live):
    """Forward pass in time order; ``live`` (time, batch, 1) stops the state at the end of a text."""
    t, n, _ = x.shape
    h, c, kept, out = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), [], np.empty((t, n, HIDDEN), np.float32)
    gates = x @ m[d + "x"] + m[d + "b"]
    for i in range(t):
        z = gates[i] + h @ m[d + "h"]
        s = _sigmoid(z[:, :3 * HIDDEN])
        a, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
        new = f * c + a * g
        tc = np.tanh(new)
        kept.append((h, c, a, f, o, g, tc))
        c, h = np.where(live[i], new, c), np.where(live[i], o * tc, h)
        out[i] = h
    return out, kept


def _lstm_back(m, d, x, live, kept, grad, into):
    dh, dc = np.zeros_like(kept[0][0]), np.zeros_like(kept[0][0])
    dz = np.empty((len(kept), dh.shape[0], 4 * HIDDEN), np.float32)
    for i in range(len(kept) - 1, -1, -1):
        h, c, a, f, o, g, tc = kept[i]
        on = live[i]
        dh = dh + grad[i]
        dho = np.where(on, dh, 0)
        dcn = np.where(on, dc, 0) + dho * o * (1 - tc * tc)
        z = dz[i]
        z[:, :HIDDEN] = dcn * g * a * (1 - a)
        z[:, HIDDEN:2 * HIDDEN] = dcn * c * f * (1 - f)
        z[:, 2 * HIDDEN:3 * HIDDEN] = dho * tc * o * (1 - o)
        z[:, 3 * HIDDEN:] = dcn * a * (1 - g * g)
        into[d + "h"] += h.T @ z
        dh = np.where(on, 0, dh) + z @ m[d + "h"].T
        dc = np.where(on, dcn * f, dc)
    into[d + "x"] += np.tensordot(x, dz, ([0, 1], [0, 1]))
    into[d + "b"] += dz.sum((0, 1))
    return dz @ m[d + "x"].T


def emissions(m, x: np.ndarray, live: np.ndarray):
    """Scores (time, batch, tag); x (time, batch) codes."""
    e = m["emb"][x]
    f, kf = _lstm(m, "f", e, live)
    b, kb = _lstm(m, "b", e[::-1], live[::-1])
    h = np.concatenate([f, b[::-1]], 2)
    return h @ m["out"] + m["out_b"], (e, h, kf, kb)


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def crf_loss(m, score, y, live):
    """Negative log-likelihood and its gradients (scores, transitions)."""
    t, n, _ = score.shape
    alpha, on = [score[0]], live[:, :, 0]
    for i in range(1, t):
        nxt = _logsum(alpha[-1][:, :, None] + m["trans"][None], 1) + score[i]
        alpha.append(np.where(live[i], nxt, alpha[-1]))
    z = _logsum(alpha[-1], 1)
    beta, ds, dt = np.zeros((n, TAGS), np.float32), np.zeros_like(score), np.zeros_like(m["trans"])
    gold = np.zeros(n)
    for i in range(t - 1, -1, -1):
        p = np.exp(alpha[i] + beta - z[:, None]) * live[i]
        ds[i] = p
        ds[i][np.arange(n), y[i]] -= on[i]
        gold += score[i][np.arange(n), y[i]] * on[i]
        if i:
            ahead = score[i] + beta
            pair = np.exp(alpha[i - 1][:, :, None] + m["trans"][None] + ahead[:, None, :] - z[:, None, None]) * live[i][:, :, None]
            dt += pair.sum(0)
            np.subtract.at(dt, (y[i - 1], y[i]), on[i])
            gold += m["trans"][y[i - 1], y[i]] * on[i]
            beta = np.where(live[i], _logsum(m["trans"][None] + ahead[:, None, :], 2), beta)
    return float((z - gold).sum()), ds, dt


def train(examples: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 11) -> dict[str, np.ndarray]:
    """Fit to texts with labelled (start, kind, end) spans by Adam; equal examples give an equal model."""
    rng = np.random.default_rng(seed)
    m = start_model(rng)
    one, two = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    data = []
    for text, found in examples:
        y = np.zeros(len(text), np.int64)
        for a, k, b in found:
            y[a:b], y[a] = 2 * k + 2, 2 * k + 1
        for at in range(0, max(1, len(text) - WINDOW // 4), WINDOW):
            data.append((codes(text)[at:at + WINDOW], y[at:at + WINDOW]))
    data = [d for d in data if len(d[0])]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        order = order[np.argsort([len(data[i][0]) // 16 for i in order], kind="stable")]
        groups = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
        for g in rng.permutation(len(groups)):
            own = [data[i] for i in groups[g]]
            t = max(len(x) for x, _ in own)
            x, y, live = np.zeros((t, len(own)), np.int64), np.zeros((t, len(own)), np.int64), np.zeros((t, len(own), 1), bool)
            for j, (cx, cy) in enumerate(own):
                x[:len(cx), j], y[:len(cy), j], live[:len(cx), j] = cx, cy, True
            score, (e, h, kf, kb) = emissions(m, x, live)
            _, ds, dt = crf_loss(m, score, y, live)
            ds = (ds / len(own)).astype(np.float32)
            into = {k: np.zeros_like(v) for k, v in m.items()}
            into["trans"] = dt / len(own)
            into["out"] = np.tensordot(h, ds, ([0, 1], [0, 1]))
            into["out_b"] = ds.sum((0, 1))
            dh = ds @ m["out"].T
            de = _lstm_back(m, "f", e, live, kf, dh[:, :, :HIDDEN], into)
            de = de + _lstm_back(m, "b", e[::-1], live[::-1], kb, dh[::-1, :, HIDDEN:], into)[::-1]
            np.add.at(into["emb"], x, de * live)
            step += 1
            for k in m:
                grad = np.clip(into[k], -5, 5)
                one[k] = 0.9 * one[k] + 0.1 * grad
                two[k] = 0.99 * two[k] + 0.01 * grad * grad
                m[k] = (m[k] - RATE * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return m


def decode(m, batch: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind, end, mean probability) of the spans of each text: scores averaged over
    overlapping windows, then one Viterbi pass over the whole text."""
    pieces = [(i, at) for i, s in enumerate(batch) for at in range(0, max(1, len(s) - STRIDE), STRIDE)]
    code = [codes(s) for s in batch]
    total = [np.zeros((len(s), TAGS), np.float32) for s in batch]
    weight = [np.zeros((len(s), 1), np.float32) for s in batch]
    hat = (1 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)[:, None]
    for lo in range(0, len(pieces), 256):
        own = [(i, at, code[i][at:at + WINDOW]) for i, at in pieces[lo:lo + 256]]
        t = max(len(x) for *_, x in own)
        if not t:
            continue
        x, live = np.zeros((t, len(own)), np.int64), np.zeros((t, len(own), 1), bool)
        for j, (_, _, v) in enumerate(own):
            x[:len(v), j], live[:len(v), j] = v, True
        score, _ = emissions(m, x, live)
        for j, (i, at, v) in enumerate(own):
            total[i][at:at + len(v)] += score[:len(v), j] * hat[:len(v)]
            weight[i][at:at + len(v)] += hat[:len(v)]
    out = []
    for s, w in zip(total, weight):
        found = []
        if len(s):
            s = s / w
            best, back = s[0], []
            for row in s[1:]:
                way = best[:, None] + m["trans"]
                back.append(way.argmax(0))
                best = way.max(0) + row
            path = [int(best.argmax())]
            for b in reversed(back):
                path.append(int(b[path[-1]]))
            path.reverse()
            sure = np.exp(s - _logsum(s, 1)[:, None])
            i = 0
            while i < len(path):
                if path[i]:
                    kind, j = (path[i] - 1) // 2, i + 1
                    while j < len(path) and path[j] == 2 * kind + 2:
                        j += 1
                    found.append((i, kind, j, float(np.mean([sure[q, path[q]] for q in range(i, j)]))))
                    i = j
                else:
                    i += 1
        out.append(found)
    return out


def examples_from(sample: list[str], seed: int = 5) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Regions with their base spans; the same with spans in other notations; and with numbers that are no finding."""
    rng = np.random.default_rng(seed)
    out = []
    for text in sample:
        found = base_spans(text)
        whole: list[tuple[int, int, int]] = []
        for f in found:                                    # spans of several kinds can overlap: the first one labels
            if not whole or f[0] >= whole[-1][2]:
                whole.append(f)
        out.append((text, whole))
        parts, spans, at = [], [], 0
        for a, k, b in whole:
            parts.append(text[at:a])
            s, digits = text[a:b], re.sub("[^0-9]", "", text[a:b])
            if k == 3 and len(digits) >= 10:
                d, sep = digits[-10:], "-. "[rng.integers(3)]
                s = [f"({d[:3]}) {d[3:6]}-{d[6:]}", sep.join((d[:3], d[3:6], d[6:]))][rng.integers(2)]
            elif k == 2:
                s = "-. "[rng.integers(3)].join(digits[i:i + 4] for i in range(0, len(digits), 4))
            here = sum(map(len, parts))
            spans.append((here, k, here + len(s)))
            parts.append(s)
            at = b
        if whole:
            out.append(("".join([*parts, text[at:]]), spans))
        words = re.sub("[0-9@]+", "", text).split(" ")
        number = [str(rng.integers(1, 10 ** int(rng.integers(1, 15)))), f"{rng.integers(1900, 2100)}", f"{rng.integers(1, 99)}.{rng.integers(0, 99)}",
                  f"{rng.integers(1, 99)}%", f"{rng.integers(1900, 2100)}-{rng.integers(1, 12):02d}-{rng.integers(1, 28):02d}",
                  f"v{rng.integers(0, 9)}.{rng.integers(0, 9)}.{rng.integers(0, 9)}", f"{rng.integers(1, 999)},{rng.integers(100, 999)}"][rng.integers(7)]
        words.insert(int(rng.integers(0, len(words) + 1)), number)
        plain = " ".join(words)
        if not base_spans(plain):
            out.append((plain, []))
    return out


# ---------------------------------------------------------------- the jobs

def _scan(batches):
    for batch in batches:
        data, off = texts(batch)
        some = np.zeros(len(off), bool)
        some[np.searchsorted(off, np.flatnonzero((data == 64) | ((data >= 48) & (data <= 57))), "right") - 1] = True
        base, starts, parts = [], [], []
        for i in range(len(off) - 1):
            text = data[off[i]:off[i + 1]].tobytes().decode() if some[i] else ""
            base.append(listed(base_spans(text)))
            around = regions(text)
            starts.append([a for a, _ in around])
            parts.append([s for _, s in around])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, pa.string()), pa.array(starts, pa.list_(pa.int64())),
                                          pa.array(parts, pa.list_(pa.string()))], ["doc_id", "base", "starts", "regions"])


def _findings(model: dict | None):
    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "base", "starts", "regions")]
            flat = [s for around in cols[3] for s in around] if model else []
            decoded = iter(decode(model, flat) if flat else [])
            rows = {f.name: [] for f in RESULT}
            for doc_id, base, starts, around in zip(*cols):
                own = [(int(a), KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in base.split(",") if x)]
                more = []
                for a0, s in zip(starts, around) if model else ():
                    for a, k, b, sure in next(decoded):
                        while b > a and s[b - 1] in " .,-(":
                            b -= 1
                        clear = not any(x < a0 + b and a0 + a < y for x, _, y in own)
                        if sure >= SURE and clear and fits(k, s[a:b]) and (a == 0 or not s[a - 1].isdigit()) and (b == len(s) or not s[b].isdigit()):
                            more.append((a0 + a, k, a0 + b))
                count = [sum(k == i for _, k, _ in own) for i in range(4)]
                for n, v in zip(RESULT.names, (doc_id, *count, hashlib.sha256(base.encode()).hexdigest(), listed(sorted({*own, *more})), len(set(more)))):
                    rows[n].append(v)
            yield batch_of(RESULT, **rows)
    return run


def find_pii(docs: DataFrame, train_regions: int = TRAIN_REGIONS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base findings), base_sha256, spans (all), n_added.

    The tagger is fitted on the driver to at most ``train_regions`` regions, chosen by a
    hash of their text, so the sample does not depend on partitions."""
    small_batches(docs.sparkSession)
    found = keep_table(id_and_text(docs).mapInArrow(_scan, "doc_id long, base string, starts array<long>, regions array<string>"), "regions")
    around = found.where("base <> ''").select(F.explode("regions").alias("s")).where(F.length("s") <= 8 * WINDOW).distinct()
    sample = [r["s"] for r in around.orderBy(F.xxhash64("s"), "s").limit(train_regions).collect()]
    model = train(examples_from(sample)) if sample else None
    return give_back_ids(found.mapInArrow(_findings(model), ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in RESULT)))
