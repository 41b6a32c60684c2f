"""Shared pieces of the text operators: input columns, numpy hashing of bytes
and words, compact blobs for shuffled messages, and the packed corpus.

Input rules that hold for every operator here: only ``doc_id``, ``text`` (and
``source``/``lang`` where an operator names them) are read, by name, so further
columns with any name do no harm; a null text is the empty text; a null doc_id
orders after all others and comes back as null; an empty table gives an empty
result.
"""

from __future__ import annotations

import ctypes
import struct
import uuid
from inspect import isgeneratorfunction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.broadcast import materialize
from ledgerline.session import checkpoint_dir, scratch_path

NULL_ID = (1 << 63) - 1

U64 = np.uint64
_P = 0x9E3779B97F4A7C15            # odd multipliers of the rolling sums (any odd number works)
_P2 = 0xC2B2AE3D27D4EB4F
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (null: the largest long) and ``text`` (null: empty), plus named columns."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as no column of ``df`` has it (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def give_back_ids(df: DataFrame, *cols: str) -> DataFrame:
    """Undo :func:`id_and_text` for id columns of a result."""
    for c in cols or ("doc_id",):
        df = df.withColumn(c, F.when(F.col(c) != F.lit(NULL_ID), F.col(c)))
    return df


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again (cuts lineage, survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return materialize(df, name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def process_cache(kind: str) -> dict:
    """What a Python worker keeps from task to task (functions arrive there by value) for one kind of work; what it
    kept for another kind goes, so the stages of a job do not pile their caches up in one worker."""
    import sys

    kept = sys.__dict__.setdefault("_ledgerline_kept", {})
    if kind not in kept:
        kept.clear()
    return kept.setdefault(kind, {})


def give_back_memory() -> None:
    """Freed memory goes back to the system: Arrow's, and the allocator's where it can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run):
    """``run`` (over batches, over a group's table or a cogroup's two) that gives freed memory back at its end: Python
    workers stay for later tasks, and what they hold counts beside whatever their executor does meanwhile."""
    def of_batches(batches):
        try:
            yield from run(batches)
        finally:
            give_back_memory()

    def of_group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back_memory()

    def of_groups(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back_memory()

    if isgeneratorfunction(run):
        return of_batches
    return of_group if run.__code__.co_argcount == 1 else of_groups


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows: the rows here are whole texts or blobs of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


# rows of one hash bucket that a window task handles
BUCKET_ROWS = 50_000


def hex_digits(rows: int) -> int:
    """Hex digits of a hash that cut ``rows`` rows into buckets of about BUCKET_ROWS."""
    k = 1
    while 16 ** k * BUCKET_ROWS < rows:
        k += 1
    return k


def running_before(df: DataFrame, group: list[str], order: list[str], value: str | None, digits: int, out: str) -> DataFrame:
    """Running sum of ``value`` (None: count) before each row, within ``group`` by
    ``hash`` and ``order``: per hash bucket, plus the totals of earlier buckets."""
    v = F.col(value) if value else F.lit(1).cast("long")
    df = df.withColumn("_b", F.substring("hash", 1, digits))
    inner = Window.partitionBy(*group, "_b").orderBy("hash", *order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, "_b").agg(F.sum(v).alias("_n"))
    totals = totals.select(*group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (df.withColumn("_in", F.coalesce(F.sum(v).over(inner), F.lit(0)))
            .join(totals, [*group, "_b"])
            .withColumn(out, F.col("_off") + F.col("_in")).drop("_b", "_in", "_off"))


# ---------------------------------------------------------------- hashing

def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word (in place)."""
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def _power(base: int, n: int) -> list[np.ndarray]:
    """[base^i], [base^-i] modulo 2^64 for i < n, kept for the next call."""
    kept = process_cache("powers")
    got = kept.get(base)
    if got is None or len(got[0]) < n:
        m = max(n + n // 8, 1 << 16)
        fwd, back = np.full(m, base, U64), np.full(m, pow(base, -1, 1 << 64), U64)
        fwd[0] = back[0] = 1
        got = kept[base] = [np.cumprod(fwd, dtype=U64), np.cumprod(back, dtype=U64)]
    return got


def rolling(values: np.ndarray, base: int = _P) -> np.ndarray:
    """Prefix sums of values[i] * base^i; :func:`spans` reads hashes of slices from them."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _power(base, len(values) + 1)[0][:len(values)], out=out[1:], dtype=U64)
    return out


def spans(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _P) -> np.ndarray:
    """Mixed 64-bit hashes of the slices [start, end); equal slices hash equally."""
    return mix((prefix[end] - prefix[start]) * _power(base, len(prefix))[1][start])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are neither space nor 0x09-0x0D."""
    ink = np.zeros(len(data) + 2, np.int8)
    ink[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    step = np.diff(ink)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


# ---------------------------------------------------------------- blobs

def squeeze(raw: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(raw)


def unsqueeze(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def enc(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob. An ascending uint64 array is stored as
    differences; bytes of equal weight are stored together, which is what
    makes small numbers compress."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        up = a.dtype == U64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        body = np.concatenate([a[:1], np.diff(a)]) if up else a
        planes = body.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else body.view(np.uint8)
        parts.append(struct.pack("<8sBQ", a.dtype.str.encode(), up, len(a)) + planes.tobytes())
    return squeeze(b"".join(parts))


def dec(blob: bytes) -> list[np.ndarray]:
    raw = unsqueeze(blob)
    (k,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(k):
        kind, up, n = struct.unpack_from("<8sBQ", raw, at)
        at += struct.calcsize("<8sBQ")
        kind = np.dtype(kind.rstrip(b"\0").decode())
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n) if n else np.zeros((kind.itemsize, 0), np.uint8)
        body = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        out.append(np.cumsum(body, dtype=U64) if up else body)
        at += n * kind.itemsize
    return out


# ------------------------------------------------------ texts in Arrow batches

def texts(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """A string column as (UTF-8 bytes, offsets), without making Python strings."""
    col = batch.column(name)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


# bytes of text whose words and n-grams are worked out together (a longer text alone)
SLICE_BYTES = 256 << 10


def slices(data: np.ndarray, offsets: np.ndarray):
    """(bytes, offsets) of the texts, a stretch of whole texts at a time."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        yield data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """UTF-8 bytes and offsets as an Arrow string array."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def batch_of(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type)
                                       for n, c in ((f.name, cols[f.name]) for f in schema)], schema=schema)


# ---------------------------------------------------------------- packed corpus

class Chunk:
    """Some whole documents in ascending doc_id order: ids, bytes, offsets."""

    def __init__(self, blob: bytes):
        raw = unsqueeze(blob)
        n, = struct.unpack_from("<Q", raw)
        self.ids = np.frombuffer(raw, np.int64, n, 8)
        self.offsets = np.frombuffer(raw, np.int64, n + 1, 8 + 8 * n)
        self.data = np.frombuffer(raw, np.uint8, -1, 8 + 8 * n + 8 * (n + 1))


PACKED = pa.schema([("chunk", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64()), ("n_words", pa.int64()),
                    ("lead", pa.list_(pa.int64())), ("blob", pa.binary())])


def _pack(chunk_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        ids, data, lens, held, n = [], [], [], 0, 0
        first = TaskContext.get().partitionId() << 32

        def flush():
            nonlocal ids, data, lens, held, n
            every, sizes = np.concatenate(ids), np.concatenate(lens)
            text = np.concatenate(data) if held else np.zeros(0, np.uint8)
            ends = np.cumsum(sizes)
            order = np.argsort(every, kind="stable")
            pieces = [text[ends[i] - sizes[i]:ends[i]] for i in order]
            off = np.concatenate([[0], np.cumsum(sizes[order])]).astype(np.int64)
            text = np.concatenate(pieces) if held else text
            gap = np.insert(text, off[1:-1], 32) if len(off) > 2 else text   # words end where documents do
            starts, _ = word_bounds(gap)
            at = np.linspace(0, max(len(text) - 9, 0), 32).astype(np.int64)
            lead = leading(text, at) if len(text) >= 8 else np.zeros(0, np.int64)
            raw = struct.pack("<Q", len(every)) + every[order].tobytes() + off.tobytes() + text.tobytes()
            out = batch_of(PACKED, chunk=[first + n], n_docs=[len(every)], n_bytes=[int(off[-1])],
                           n_words=[len(starts)], lead=[lead.tolist()], blob=[squeeze(raw, 3)])
            ids, data, lens, held, n = [], [], [], 0, n + 1
            return out

        for batch in batches:
            raw, off = texts(batch)
            every, a = batch.column("doc_id").to_numpy(zero_copy_only=False), 0
            while a < len(every):
                b = int(np.searchsorted(off, off[a] + max(chunk_bytes - held, 1), "left"))
                b = min(max(b, a + 1), len(every))
                ids.append(every[a:b])
                lens.append(np.diff(off[a:b + 1]))
                data.append(raw[off[a]:off[b]])
                held += int(off[b] - off[a])
                a = b
                if held >= chunk_bytes:
                    yield flush()
        if ids:
            yield flush()
    return run


def leading(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as a number that orders as the bytes do (last bit dropped)."""
    out = np.zeros(len(at), U64)
    for j in range(8):
        out = (out << U64(8)) | text[at + j].astype(U64)
    return (out >> U64(1)).astype(np.int64)


def pack_corpus(docs: DataFrame, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Whole documents packed into compressed chunks of about ``chunk_bytes``
    (a longer document is a chunk of its own), stored in the shared folder,
    bucketed by chunk id: later joins on ``chunk`` move only the other side."""
    spark = docs.sparkSession
    small_batches(spark)
    checkpoint_dir(spark)
    name = f"packed_{uuid.uuid4().hex}"
    (id_and_text(docs).mapInArrow(_pack(chunk_bytes), _ddl(PACKED))
     .write.format("parquet").option("compression", "none").option("path", scratch_path(spark, name))
     .bucketBy(partitions(spark), "chunk").saveAsTable(name))
    return spark.table(name)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.float64(): "double",
             pa.list_(pa.int64()): "array<long>", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


ddl = _ddl


def with_lists(chunks: DataFrame, lists: DataFrame) -> DataFrame:
    """Chunks with the blobs sent to each of them (``lists``: chunk, blob) as the array ``got``."""
    got = lists.groupBy("chunk").agg(F.collect_list("blob").alias("got"))
    return chunks.select("chunk", "blob").join(got, "chunk", "left")


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """values in among (ascending)."""
    if len(among) == 0:
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def merged(blobs) -> np.ndarray:
    got = [dec(b)[0] for b in blobs or []]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, U64)


def shard_bits(total: int, per_shard: int) -> int:
    """log2 of the number of shards of about ``per_shard`` items each."""
    return max(3, (max(1, -(-total // per_shard)) - 1).bit_length())


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some documents: places in ``data`` (documents set apart by a space), document numbers, hashes."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        n = len(ids)
        self.ids = ids
        self.data = np.full(len(data) + n, 32, np.uint8)
        shift = np.repeat(np.arange(n), np.diff(offsets))
        self.data[np.arange(len(data)) + shift] = _LOWER[data] if lower else data
        self.offsets = offsets + np.arange(n + 1)
        self.start, self.end = word_bounds(self.data)
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(n + 1))      # each document's first word

    @classmethod
    def of(cls, chunk: Chunk) -> "Words":
        return cls(chunk.ids, chunk.data, chunk.offsets)

    def hashes(self) -> np.ndarray:
        return spans(rolling(byte_values(self.data)), self.start, self.end)
