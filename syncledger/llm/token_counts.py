"""Operator 5: token counts by heap-and-linked-list byte-pair merging.

Each piece of a text starts as its bytes in a linked list; a heap gives the
adjacent pair of lowest rank (leftmost first), which is merged, until no pair
is left. The count is the number of symbols less the number of merges; no ids
are made. Counts of pieces are kept in a table of a fixed size per worker.

Defined cases: a null or empty text has 0 bytes and 0 tokens; an id may be
null or repeat, every row is counted for itself; an empty table gives no rows.
Only ``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_bytes, tidied, worker_state
from .pieces import PieceCache, Vocabulary, piece_blocks, ship_vocabulary, vocabulary

LIMIT = 512
#: Pieces kept per worker, as a power of two (16 bytes each).
CACHE_BITS = 21


def merged_length(piece: bytes, vocab: Vocabulary) -> int:
    """How many tokens byte-pair merging leaves of ``piece``."""
    if piece in vocab.special:
        return 1
    n = len(piece)
    if n < 2:
        return n
    rank_of, merged, byte_id = vocab.rank_of, vocab.merged, vocab.byte_id
    ids = [byte_id[b] for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = rank_of.get(ids[i] << 32 | ids[i + 1])
        if rank is not None:
            heap.append(rank << 32 | i)
    heapify(heap)
    count = n
    while heap:
        top = heappop(heap)
        rank, i = top >> 32, top & 0xFFFFFFFF
        j = after[i]
        if ids[i] < 0 or j >= n or rank_of.get(ids[i] << 32 | ids[j]) != rank:
            continue  # one of the two was merged meanwhile
        ids[i], ids[j] = merged[rank], -1
        k = after[i] = after[j]
        count -= 1
        if k < n:
            before[k] = i
            rank = rank_of.get(ids[i] << 32 | ids[k])
            if rank is not None:
                heappush(heap, rank << 32 | i)
        h = before[i]
        if h >= 0:
            rank = rank_of.get(ids[h] << 32 | ids[i])
            if rank is not None:
                heappush(heap, rank << 32 | h)
    return count


def token_counts(docs: DataFrame, limit: int = LIMIT, vocab_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = ship_vocabulary(spark, vocab_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shipped.value
        vocab = vocabulary(raw)
        cache = worker_state(f"piece_counts_{zlib.crc32(raw):08x}",
                             lambda: PieceCache(CACHE_BITS, lambda pieces: [merged_length(p, vocab) for p in pieces]))
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            totals = np.zeros(batch.num_rows, np.int64)
            for i, j, d, s, e, first in piece_blocks(data, offs, vocab.special):
                sums = np.concatenate([[0], np.cumsum(cache.lookup(d, s, e))])
                totals[i:j] = sums[first[1:]] - sums[first[:-1]]
            yield pa.record_batch([batch.column(0), pa.array(np.diff(offs)), pa.array(totals)],
                                  ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(count), "doc_id bigint, n_bytes bigint, n_tokens bigint") \
        .withColumn("over_limit", F.col("n_tokens") > limit)


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
