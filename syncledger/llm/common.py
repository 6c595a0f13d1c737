"""Helpers shared by the llm operators.

* whole texts as numpy arrays: byte blocks, words, 64-bit word hashes, shingles;
* bounded Arrow batches and values kept for the life of a Python worker;
* intermediate tables in the shared folder, and joins on id lists of a checked size.

A *word* is ``[^\\x20\\x09-\\x0D]+``. All its separators are single bytes, so
words are cut on the UTF-8 bytes. Hashes are polynomial over the bytes, then
mixed; they are the same on every machine and in every run.
"""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once; memory in a task is a small multiple of it.
BLOCK = 1 << 19
#: Ids that a join may broadcast (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000

_U = np.uint64
_M = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)


# ---------------------------------------------------------------- Spark side

def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """At most ``rows`` rows in an Arrow batch, so that a batch of very long texts fits a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hinted(ids: DataFrame, bound: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` marked for broadcast if it has at most ``bound`` rows; else left to a shuffled join."""
    return F.broadcast(ids) if ids.count() <= bound else ids


def by_place(df: DataFrame) -> DataFrame:
    """``df`` with its columns named ``c0``, ``c1``, ... by place: whatever their names are, none clashes with a column
    that an operator adds, and none needs quoting. ``toDF`` gives them their names back."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def is_training(id_col: str, mod: int, held: int):
    """Not held out: crc32 of the id as text, modulo ``mod``, is not ``held`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod != held


# --------------------------------------------------------------- worker side

def worker_state(key: str, build: Callable[[], object]) -> object:
    """A value built once in a Python worker and kept for the tasks that follow."""
    held = sys.modules.setdefault("_syncledger_worker_state", types.ModuleType("_syncledger_worker_state"))
    if not hasattr(held, key):
        setattr(held, key, build())
    return getattr(held, key)


def tidied(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` that at a task's end gives memory it no longer uses back to the system, as workers live on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim is not None:
            trim(0)

    return run


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def blocks(data: np.ndarray, offs: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: (first row, end row, bytes, offsets)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut[data]


def space_table() -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return lut


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~space_table()[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = offs[:-1][offs[:-1] < len(data)]
    start[heads] = inside[heads]
    end[offs[1:] - 1] = inside[offs[1:] - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    def build(m: int) -> tuple[np.ndarray, np.ndarray]:
        both = []
        for base in (_P, _PINV):
            out = np.ones(m, _U)
            have = 1
            while have < m:  # doubling
                step = min(have, m - have)
                out[have:have + step] = out[:step] * _U(pow(base, have, 1 << 64))
                have += step
            both.append(out)
        return both[0], both[1]

    state = worker_state("powers", lambda: {"p": build(BLOCK + 1)})
    if len(state["p"][0]) < n:
        if n > 8 * BLOCK:
            return build(n)
        state["p"] = build(n)
    return state["p"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over all 64 (a fixed public mixing function)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def byte_values() -> np.ndarray:
    return worker_state("byte_values", lambda: mix64(np.arange(1, 257, dtype=_U) * _U(_P)))


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    if not len(s):
        return np.zeros(0, _U)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(byte_values()[data] * power[:len(data)], out=sums[1:])
    h = sums[e]
    h -= sums[s]
    h *= inverse[s]
    h += (e - s).astype(_U) * _U(0xD6E8FEB86659FD93)
    return mix64(h)


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block and each text's first index (n + 1 values).

    One text longer than a block is hashed piece by piece, cut at white space,
    so that only 8 bytes a word are held for it.
    """
    if len(data) <= 2 * BLOCK or len(offs) > 2:
        s, e, first = word_spans(data, offs)
        return span_hashes(data, s, e), first
    space, parts, i = space_table(), [], 0
    while i < len(data):
        j = min(len(data), i + BLOCK)
        while j < len(data):
            gap = np.flatnonzero(space[data[j:j + BLOCK]])
            if len(gap):
                j += int(gap[0])
                break
            j = min(len(data), j + BLOCK)
        s, e, _ = word_spans(data[i:j], np.array([0, j - i]))
        parts.append(span_hashes(data[i:j], s, e))
        i = j
    h = np.concatenate(parts)
    return h, np.array([0, len(h)])


def window_hashes(h: np.ndarray, first: np.ndarray, k: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k-word window, text after text, and each text's first index.

    ``short``: a text with 1 to k - 1 words has one window, its whole sequence;
    else it has none.
    """
    n = np.diff(first)
    odd = [_U((_P * (2 * j + 3)) & _M | 1) for j in range(k)]
    total = len(h)
    if not total:
        return np.zeros(0, _U), np.zeros(len(first), np.int64)
    w = np.zeros(total, _U)
    for j in range(k):
        w[:max(total - j, 0)] += h[j:] * odd[j]
    valid = np.ones(total, bool)
    for j in range(1, k):
        at = first[1:][n >= j] - j
        valid[at] = False
    for m in range(1, k):
        at = first[:-1][n == m]
        for j in range(m):
            valid[at + j] = False
        if short and len(at):
            value = np.zeros(len(at), _U)
            for j in range(m):
                value += h[at + j] * odd[j]
            w[at] = value + _U(m)
            valid[at] = True
    counts = np.maximum(n - k + 1, 0)
    if short:
        counts = np.where((n > 0) & (n < k), 1, counts)
    return mix64(w[valid]), np.concatenate([[0], np.cumsum(counts)])
