"""Shared helpers of the operators: Arrow text buffers as numpy arrays, word spans and
64-bit hashes over whole batches, column-clash-safe input selection, shared storage.

Texts reach Python workers as Arrow batches; the helpers work on the flat UTF-8 buffer of
a batch, so a word costs a few vector operations and no Python object.
"""

from __future__ import annotations

import ctypes
import os
import sys
import types
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import checkpoint_dir

# [^\x20\x09-\x0D]+ in the contracts' notation, for Spark's regex functions
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 2**64))
#: bytes of text a worker handles at once
CHUNK = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost
    executors and keeps later plans from computing it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """``df``, which has ``rows`` rows at most, in no more tasks than they are worth."""
    return df.coalesce(max(1, -(-rows // per_task)))


def screened(df: DataFrame, key: str, wanted: DataFrame, most: int = 1 << 27) -> DataFrame:
    """``df`` without most of the rows whose long ``key`` isn't among those of ``wanted``, which
    has the same column: what is joined with ``wanted`` isn't dealt out whole. The tasks look
    hashes up in a bitmap with 16 bits for each row of ``wanted``, ``most`` at most."""
    bits = 1 << min(most.bit_length() - 1, max(16, (16 * wanted.count()).bit_length()))
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    marks = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("marks")).toPandas()
    words = np.zeros(bits >> 6, np.int64)
    words[marks["word"].to_numpy(np.int64)] = marks["marks"].to_numpy(np.int64)
    held = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def marked(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy(np.int64)
        return pd.Series((held.value[at >> 6] >> (at & 63)) & 1 == 1)

    return df.filter(marked(slot))


def crc_bucket(doc_id: Column, n: int = 5) -> Column:
    """crc32(doc_id as text) mod n; a null id gives null."""
    return F.crc32(doc_id.cast("string")) % F.lit(n)


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """(rows, total bytes of the text column): sizes the partition counts below."""
    r = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    return int(r[0]), int(r[1] or 0)


def parts_for(total: int, per_part: int, least: int) -> int:
    return max(least, -(-total // per_part))


def worker_cache(name: str) -> dict:
    """A dict that outlives tasks in a reused Python worker (never needed for results)."""
    mod = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    return mod.__dict__.setdefault(name, {})


def release() -> None:
    """Gives memory that a worker no longer uses back to the system: workers are kept between
    tasks and stages, and what one stage once took would count in the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run):
    """``run`` (a function for mapInArrow) that releases memory when its task ends."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return tidied


def small_batches(spark: SparkSession) -> None:
    """Texts travel to workers in Arrow batches of a few MB, however long they are: the batches'
    buffers lie beside the JVM's heap, for every running task."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def flat_text(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.large_binary()
    if column.type != large:
        column = column.cast(pa.large_string() if pa.types.is_string(column.type) else large)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def doc_groups(off: np.ndarray, size: int = CHUNK):
    """Ranges [i, j) of whole documents with about ``size`` bytes together (one at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of True that don't cross the positions in cuts."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    c = cuts[(cuts > 0) & (cuts < n)]
    first[c] = inside[c]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[c - 1] = inside[c - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    c = worker_cache("powers")
    if c.get("n", -1) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, _P), np.full(size, _P_INV)
        up[0] = down[0] = 1
        c.update(up=np.multiply.accumulate(up), down=np.multiply.accumulate(down), n=size)
    return c["up"], c["down"]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span [start, end) of ``buf``, equal for equal bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(buf))
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    b = buf.astype(np.uint64)
    b += np.uint64(1)
    b *= up[:len(buf)]
    np.cumsum(b, out=sums[1:])
    h = sums[ends] - sums[starts]
    h *= down[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words of every document; ``first[d]:first[d+1]`` are
    the words of document d."""
    s, e = runs(~IS_SPACE[buf], off)
    return s, e, np.searchsorted(s, off)


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, first): the sorted distinct 64-bit hashes of the ``width``-word shingles of
    document d are shingles[first[d]:first[d+1]]. A-Z are lower-cased; a document with fewer
    words has its whole sequence as its one shingle, one without words none."""
    buf = TO_LOWER[buf]
    s, e, first = words(buf, off)
    h = span_hashes(buf, s, e)
    n = np.diff(first)
    wide = np.minimum(n, width)
    count = np.where(n > 0, n - wide + 1, 0)
    at = ragged(first[:-1], count)
    doc = np.repeat(np.arange(len(n), dtype=np.uint32), count)
    wide = wide[doc]
    total = np.zeros(len(at), np.uint64)
    full = bool((wide == width).all())
    for k in range(width):
        use = slice(None) if full else wide > k
        t = total[use] * np.uint64(0x9E3779B97F4A7C15) + h[at[use] + k]
        total[use] = t ^ (t >> np.uint64(29))
    total = mix(total + wide.astype(np.uint64))
    # by hash, then (stable) by document
    order = np.argsort(total)
    order = order[np.argsort(doc[order].astype(np.uint16) if len(n) <= 1 << 16 else doc[order], kind="stable")]
    total, doc = total[order], doc[order]
    if len(total):
        new = np.concatenate([[True], (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])])
        total, doc = total[new], doc[new]
    return total, np.searchsorted(doc, np.arange(len(n) + 1))


def set_keys(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set, from its members and size."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets + np.uint64(1)), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def parity_masks(sets: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
    """A row of ``words`` unsigned 64-bit words for each set: for each bit the parity of the number of
    members hashed to it. The masks of two sets differ in at most as many bits as the sets have
    members not in common."""
    bits = 64 * words
    out = np.zeros((len(first) - 1, words), np.uint64)
    step = max(1, (1 << 18) // bits)
    for i in range(0, len(out), step):
        j = min(i + step, len(out))
        doc = np.repeat(np.arange(j - i), np.diff(first[i:j + 1]))
        at = ((sets[first[i]:first[j]] >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(doc * bits + at, minlength=(j - i) * bits).reshape(j - i, bits) & 1
        out[i:j] = np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges start, start+1, ... of the given lengths."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def blobs(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary Arrow column whose row i is data[off[i]:off[i+1]] (any item size)."""
    data = np.ascontiguousarray(data)
    o = (off * data.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(o), pa.py_buffer(data)]) \
        .cast(pa.binary())


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; LLM_TOKENIZERS names another folder."""
    folder = os.environ.get("LLM_TOKENIZERS", "")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)
