"""Operator 8: hierarchical residual packing into sequences of a token budget.

Documents become token ids and an end id; longer ones are cut into full
pieces, of which the first may be shorter. Full pieces are sequences as they
are. The rest is packed best-fit (longest first) within each partition; bins
that are nearly full are emitted, and the underfull ones go up a tree, as items
of the next round, with fewer partitions each time. A bin carries its members,
at most as many as it has tokens, so no task holds more than its share.

Defined cases: a null or empty text is one piece of the end id alone; an id may
be null or repeat, every row is packed for itself; an empty table gives no
rows. Only ``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stored, text_bytes, tidied, worker_state
from .pieces import PieceCache, piece_blocks, ship_vocabulary

LENGTH = 1024
END_ID = 2
#: A bin with at most this many tokens to spare is emitted before the last round.
SLACK = 8
#: Items packed in one task, and partitions merged into one from round to round.
ITEMS = 65_536
FAN_IN = 8
CACHE_BITS = 19
#: Ids kept per worker for pieces seen before; the table starts anew beyond it.
POOL = 3_000_000

PIECE = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _IdCache:
    """The ids of pieces seen before, made by the tokenizer library."""

    def __init__(self, raw: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.special = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.clear()

    def clear(self) -> None:
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.cache = PieceCache(CACHE_BITS, self.compute)

    def compute(self, pieces: list[bytes]) -> list[int]:
        out = []
        for e in self.tokenizer.encode_batch([p.decode() for p in pieces], add_special_tokens=False):
            ids = e.ids
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
            self.pool[self.used:self.used + len(ids)] = ids
            out.append(self.used << 32 | len(ids))
            self.used += len(ids)
        return out

    def ids(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each piece's ids begin (n + 1 values)."""
        if self.used > POOL:
            self.clear()
        found = self.cache.lookup(data, s, e)
        ends = np.cumsum(found & 0xFFFFFFFF)
        begins = np.concatenate([[0], ends]).astype(np.int64)
        if not len(found) or not begins[-1]:
            return np.zeros(0, np.uint32), begins
        shift = np.repeat((found >> 32) - begins[:-1], np.diff(begins))
        shift += np.arange(begins[-1])
        return self.pool[shift], begins


def cut(n: int, length: int) -> list[int]:
    """Starts of the pieces of a document of ``n`` ids, and its end."""
    short = n % length
    return [0, *range(short if short else length, n, length), n]


def document_pieces(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, vocab_path: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) and, if asked, ids, of every piece, stored.
    ``row`` tells rows with the same id apart."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = ship_vocabulary(spark, vocab_path)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shipped.value
        cache = worker_state(f"piece_ids_{zlib.crc32(raw):08x}", lambda: _IdCache(raw))
        end = np.array([end_id], np.uint32).tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            out: list[list] = [[] for _ in range(6)]
            held: list[np.ndarray] = []
            for i, j, d, s, e, first in piece_blocks(data, offs, cache.special):
                ids, begins = cache.ids(d, s, e)
                lo, raw_ids = begins[first].tolist(), ids.tobytes()
                for k in range(j - i):
                    own = raw_ids[4 * lo[k]:4 * lo[k + 1]] + end
                    cuts = cut(len(own) // 4, length)
                    for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        part = own[4 * a:4 * b]
                        for column, value in zip(out, (row, keys[i + k], p, a, b - a, zlib.crc32(part)), strict=True):
                            column.append(value)
                        if with_ids:
                            held.append(np.frombuffer(part, np.uint32).astype(np.int32))
                    row += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(arrays, names)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(tidied(tokenize), PIECE + (", ids array<int>" if with_ids else "")), "pack-pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that takes it."""
    room_of: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room
    rooms = 0  # bit r: some bin has room r
    bins: list[list[int]] = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = room_of[room].pop()
            if not room_of[room]:
                rooms ^= 1 << room
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
        room_of[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def _pack_round(items: DataFrame, level: int, length: int, last: bool) -> DataFrame:
    """One round: (sequence_id or null if underfull, fill, members) of every bin of every partition."""
    members = items.schema["members"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        fill = np.concatenate([b.column(0).to_numpy() for b in held])
        lists = pa.concat_arrays([b.column(1) for b in held])
        offs, flat = lists.offsets.to_numpy(), lists.values
        sizes = flat.field("length").to_numpy()
        base = (level << 57) | (TaskContext.get().partitionId() << 32)
        bins = best_fit(fill, length)
        for at in range(0, len(bins), 4096):
            some = bins[at:at + 4096]
            order = np.fromiter((i for b in some for i in b), np.int64)
            fills = np.array([int(fill[b].sum()) for b in some])
            done = (fills >= length - SLACK) | last
            counts = (offs[order + 1] - offs[order]).astype(np.int64)
            ends = np.cumsum(counts)
            index = np.repeat(offs[order] - (ends - counts), counts) + np.arange(ends[-1])
            bounds = np.concatenate([[0], np.cumsum([len(b) for b in some])])
            cuts = np.concatenate([[0], ends])[bounds].astype(np.int32)
            before = np.concatenate([[0], np.cumsum(sizes[index])])
            offsets = before[:-1] - np.repeat(before[cuts[:-1]], np.diff(cuts))
            yield pa.record_batch(
                [pa.array(base + at + np.arange(len(some)), mask=~done), pa.array(fills),
                 pa.ListArray.from_arrays(pa.array(cuts), flat.take(pa.array(index))),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(offsets))],
                ["sequence_id", "fill", "members", "offsets"])

    return items.mapInArrow(tidied(pack), f"sequence_id bigint, fill bigint, members {members}, offsets array<bigint>")


def place_pieces(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    member = [c for c in pieces.columns if c != "ids"]
    full = pieces.filter(F.col("length") == length)
    rest = pieces.filter(F.col("length") < length)
    # full pieces are numbered below 0, bins above
    alone = full.select(*member, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                        F.lit(0).cast("bigint").alias("offset"))
    items = rest.select(F.col("length").alias("fill"), F.array(F.struct(*member)).alias("members"))
    n = rest.count()
    parts, level, packed = max(1, -(-n // ITEMS)), 0, []
    while n:
        level += 1
        last = parts == 1
        bins = stored(_pack_round(items.coalesce(parts), level, length, last), f"pack-round{level}")
        packed.append(bins.filter("sequence_id IS NOT NULL"))
        if last:
            break
        items = bins.filter("sequence_id IS NULL").select("fill", "members")
        n = items.count()
        fewer = max(-(-n // ITEMS), -(-parts // FAN_IN), 1)
        if fewer >= parts and n:  # merging shrinks nothing more: deal the bins out anew once, then end
            packed.append(_pack_last(items, parts, level + 1, length))
            break
        parts = fewer
    place = alone
    for bins in packed:
        rows = bins.select("sequence_id", F.explode(F.arrays_zip("members", "offsets")).alias("m")) \
            .select(*[F.col(f"m.members.{c}").alias(c) for c in member], "sequence_id", F.col("m.offsets").alias("offset"))
        place = place.unionByName(rows)
    return place


def _pack_last(items: DataFrame, parts: int, level: int, length: int) -> DataFrame:
    return stored(_pack_round(items.repartition(parts), level, length, True), f"pack-round{level}")


def pack_documents(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, vocab_path: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, length, ids, doc_ids): the sequences themselves, each of at most ``length`` ids."""
    pieces = document_pieces(docs, length, end_id, vocab_path, id_col, text_col, with_ids=True)
    placed = place_pieces(pieces, length).select("row", "piece", "sequence_id", "offset")
    rows = placed.join(pieces, ["row", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")) \
        .select("sequence_id", "length", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def packed_pieces(docs: DataFrame, **options) -> DataFrame:
    """Contract columns: one row per piece and its place."""
    placed = place_pieces(document_pieces(docs, **options), options.get("length", LENGTH))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_pack_best_fit(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    return packed_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
