"""Operator 12: ranked lexical search by grouping documents under their matched-term masks.

Every item (a text) asks for the documents with the highest scores over its
terms. The documents are dealt to blocks; a block keeps, for every term, a
bitmap of the documents that hold it. An item's documents in a block are
grouped by *mask*, the set of its terms that they hold: a bitmap union of the
terms that alone could lift a document to the running k-th score names the
documents that matter, bitmap reads give their masks, and the distinct masks
are evaluated from the highest possible score downwards until the next one
cannot reach the k-th score. A mask's highest possible score is the sum, over
its terms, of the highest score that any document of the block has for the
term. The k best of every task are merged by a window.

Terms are the maximal runs of ASCII letters and digits and of bytes from 0x80
on, A-Z in lower case. A term is a 64-bit hash. Items go in slices of at most
``SLICE_TERMS`` (item, term) pairs, each a pass over the documents, so that what
is broadcast is bounded at any number of items.

Defined cases: a text that is null or has no term is no document in N and no
item has it; an item without terms, or none of whose terms occurs, has no rows;
repeated rows are documents of their own (equal scores and ids in any order),
and repeated items are items of their own; a null doc_id comes after all others
of its score; with no documents or no items there are no rows. Only the id and
text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK, blocks, bounded_batches, lower_ascii, span_hashes, stored, text_bytes, tidied

#: Documents in a block, and postings beyond which a block is closed early.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
#: (item, term) pairs of one slice of items.
SLICE_TERMS = 1 << 20
#: Documents evaluated at least, before masks are compared with the k-th score again.
STEP = 64

_U = np.uint64


def _term_table() -> np.ndarray:
    lut = np.zeros(256, bool)
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        lut[a:b] = True
    return lut


def term_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a block of texts (bytes, offsets), and each text's first index (n + 1 values)."""
    if len(offs) == 2 and len(data) > 2 * BLOCK:  # one long text, piece by piece, cut where no term goes on
        inside, parts, i = _term_table(), [], 0
        while i < len(data):
            j = min(len(data), i + BLOCK)
            while j < len(data) and inside[data[j]]:
                gap = np.flatnonzero(~inside[data[j:j + BLOCK]])
                j = j + int(gap[0]) if len(gap) else min(len(data), j + BLOCK)
            parts.append(term_hashes(data[i:j], np.array([0, j - i]))[0] if j - i <= 2 * BLOCK
                         else _hashes(data[i:j], np.array([0, j - i]))[0])
            i = j
        h = np.concatenate(parts)
        return h, np.array([0, len(h)])
    return _hashes(data, offs)


def _hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _term_table()[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offs[:-1]
    start[heads] = inside[heads]  # a text begins a term of its own
    end = inside[:-1].copy()
    end &= ~inside[1:]
    ends = offs[1:][offs[1:] > 0] - 1
    end[ends] = inside[ends]
    s, e = np.flatnonzero(start[:-1]), np.flatnonzero(end) + 1
    return span_hashes(lower_ascii(data), s, e), np.searchsorted(s, offs)


# ------------------------------------------------------------------ the items

def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, terms): ``item`` tells items with one id apart, ``terms`` are its distinct terms; stored."""
    bounded_batches(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for i, j, d, o in blocks(*text_bytes(batch.column(2))):
                h, first = term_hashes(d, o)
                lists += [np.unique(h[first[k]:first[k + 1]]).view(np.int64) for k in range(j - i)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))],
                                  ["item", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                        F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return stored(rows.mapInArrow(tidied(cut), f"item bigint, item_id {kind}, terms array<bigint>")
                  .filter(F.size("terms") > 0), "lexical-items")


def item_slice(rows: list) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Items (item, terms) as arrays: their keys, the sorted vocabulary, and the places of each item's terms in it."""
    lists = [np.array(r["terms"], np.int64).view(_U) for r in rows]
    vocabulary = np.unique(np.concatenate(lists)) if lists else np.zeros(0, _U)
    return (np.array([r["item"] for r in rows], np.int64), vocabulary,
            [np.searchsorted(vocabulary, x).astype(np.int32) for x in lists])


# ---------------------------------------------------------- the documents' side

POSTINGS = "docs binary, nulls binary, lengths binary, counts binary, terms binary, tfs binary, n bigint, l bigint"


def index_blocks(docs: DataFrame, held: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of documents, stored: ids, their numbers of terms, and the slice's terms they hold with their counts;
    ``n`` documents have a term and ``l`` is the sum of all terms of the block."""
    bounded_batches(docs.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, vocabulary, _ = held.value
        block = _Block()
        for batch in batches:
            ids = batch.column(0)
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            keys = ids.fill_null(0).to_numpy().astype(np.int64)
            for i, j, d, o in blocks(*text_bytes(batch.column(1))):
                h, first = term_hashes(d, o)
                lengths = np.diff(first).astype(np.int64)
                owner = np.repeat(np.arange(j - i), lengths)
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                known = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
                pair, tf = np.unique(owner[known] * len(vocabulary) + at[known], return_counts=True)
                of = pair // max(len(vocabulary), 1)
                block.add(keys[i:j], nulls[i:j], lengths, np.bincount(of, minlength=j - i),
                          pair - of * len(vocabulary), tf)
                if block.full():
                    yield block.row()
                    block = _Block()
        if block.parts:
            yield block.row()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(tidied(index), POSTINGS), "lexical-index")


class _Block:
    def __init__(self):
        self.parts: list[tuple] = []
        self.docs = self.postings = 0

    def add(self, ids, nulls, lengths, counts, terms, tfs) -> None:
        some = lengths > 0
        self.parts.append((ids[some], nulls[some], lengths[some], counts[some].astype(np.int32),
                           terms.astype(np.int32), tfs.astype(np.int32)))
        self.docs += int(some.sum())
        self.postings += len(terms)

    def full(self) -> bool:
        return self.docs >= BLOCK_DOCS or self.postings >= BLOCK_POSTINGS

    def row(self) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        values = [pa.array([c.tobytes()], pa.binary()) for c in columns]
        n, total = len(columns[0]), int(columns[2].sum())
        return pa.record_batch([*values, pa.array([n]), pa.array([total])],
                               ["docs", "nulls", "lengths", "counts", "terms", "tfs", "n", "l"])


def document_counts(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of the slice's terms (at most SLICE_TERMS numbers on the driver)."""
    total = index.agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                df += np.bincount(np.frombuffer(value.as_buffer(), np.int32), minlength=size)
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some), pa.array(df[some])], ["term", "df"])

    df = np.zeros(size, np.int64)
    counted = index.select("terms").mapInArrow(tidied(count), "term bigint, df bigint") \
        .groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    return total["n"] or 0, total["l"] or 0, df


def weights(n: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


class MaskBlock:
    """A block's bitmaps by term and its postings by document."""

    def __init__(self, row: dict, n: int, total: int, size: int):
        self.ids = np.frombuffer(row["docs"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        lengths = np.frombuffer(row["lengths"], np.int64)
        terms = np.frombuffer(row["terms"], np.int32)
        tfs = np.frombuffer(row["tfs"], np.int32).astype(np.int64)
        owner = np.repeat(np.arange(len(self.ids)), np.frombuffer(row["counts"], np.int32))
        m = 50 + (50 * lengths * n) // total
        self.impact = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owner])
        self.size = size
        self.key = owner * size + terms  # ascending: documents, and terms within them, are in order
        self.present = np.unique(terms)
        place = np.searchsorted(self.present, terms)
        self.highest = np.zeros(len(self.present), np.int64)
        np.maximum.at(self.highest, place, self.impact)
        wide = -(-len(self.ids) // 8)
        bits = np.zeros(len(self.present) * wide, np.uint8)
        np.bitwise_or.at(bits, place * wide + (owner >> 3), np.uint8(1) << (owner & 7).astype(np.uint8))
        self.bits = bits.reshape(len(self.present), wide)

    def local(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``terms`` occur in the block, and their rows of bitmaps."""
        at = np.searchsorted(self.present, terms)
        at[at == len(self.present)] = 0
        found = self.present[at] == terms if len(self.present) else np.zeros(len(terms), bool)
        return found, at[found]

    def best(self, terms: np.ndarray, w: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (rows of the block) that may be among the k best, given that k documents elsewhere have
        ``floor`` or more (0 if there are none), and their scores."""
        found, rows = self.local(terms)
        terms, w = terms[found], w[found]
        bound = w * self.highest[rows]
        order = np.argsort(bound, kind="stable")
        terms, w, rows, bound = terms[order], w[order], rows[order], bound[order]
        # terms that even together stay below the floor name no document alone
        needed = np.cumsum(bound) >= max(floor, 1)
        if not needed.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        union = np.bitwise_or.reduce(self.bits[rows[needed]], axis=0)
        docs = np.flatnonzero(np.unpackbits(union, bitorder="little"))
        held = (self.bits[np.ix_(rows, docs >> 3)] >> (docs & 7).astype(np.uint8)) & 1
        packed = np.packbits(held, axis=0, bitorder="little").T
        wide = -(-packed.shape[1] // 8)
        mask = np.zeros((len(docs), 8 * wide), np.uint8)
        mask[:, :packed.shape[1]] = packed
        masks, group = np.unique(mask.view(_U if wide == 1 else f"V{8 * wide}").ravel(), return_inverse=True)
        first = np.zeros(len(masks), np.int64)
        first[group] = np.arange(len(docs))
        highest = bound @ held[:, first].astype(np.int64)
        by_mask = np.argsort(-highest, kind="stable")
        place = np.empty(len(masks), np.int64)
        place[by_mask] = np.arange(len(masks))
        order = np.argsort(place[group], kind="stable")  # documents, from the highest mask down
        limit = highest[by_mask][place[group][order]]
        best_docs, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = 0
        while i < len(order):
            if limit[i] < max(floor, 1):  # no mask from here on can reach the k-th score
                break
            j = min(len(order), i + max(STEP, i))
            j = int(np.searchsorted(-limit, -limit[j - 1], "right"))  # whole masks
            some = order[i:j]
            best_docs = np.concatenate([best_docs, docs[some]])
            best = np.concatenate([best, self.scores(docs[some], held[:, some], terms, w)])
            i = j
            if len(best) >= k:
                floor = max(floor, int(np.partition(best, -k)[-k]))
        keep = best >= max(floor, 1)
        return best_docs[keep], best[keep]

    def scores(self, docs: np.ndarray, held: np.ndarray, terms: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Exact scores of documents from the terms they hold."""
        t, d = np.nonzero(held)
        at = np.searchsorted(self.key, docs[d] * self.size + terms[t])
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, d, w[t] * self.impact[at])
        return out


def _slice_best(index: DataFrame, held: Broadcast, k: int) -> DataFrame:
    """(item, doc_id, score): of every task, each item's k best documents."""
    n, total, df = document_counts(index, len(held.value[1]))
    weight = index.sparkSession.sparkContext.broadcast(weights(n, df))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, vocabulary, asked = held.value
        size, own = len(vocabulary), [weight.value[t] for t in asked]
        kept: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(items)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r].as_buffer() for name in batch.schema.names if name not in "nl"}
                if not len(row["docs"]):
                    continue
                block = MaskBlock(row, n, total, size)
                for q, terms in enumerate(asked):
                    ids, nulls, scores = kept[q]
                    floor = int(scores[-1]) if len(scores) == k else 0
                    docs, found = block.best(terms, own[q], k, floor)
                    if len(docs):
                        kept[q] = _merge(ids, nulls, scores, block.ids[docs], block.nulls[docs], found, k)
        counts = np.array([len(x[0]) for x in kept], np.int64)
        for a in range(0, len(kept), 4096):
            ids, nulls, scores = (np.concatenate(c) for c in zip(*kept[a:a + 4096], strict=True))
            yield pa.record_batch(
                [pa.array(np.repeat(items[a:a + 4096], counts[a:a + 4096])), pa.array(ids, mask=nulls),
                 pa.array(scores)], ["item", "doc_id", "score"])

    return index.mapInArrow(tidied(search), "item bigint, doc_id bigint, score bigint")


def _merge(ids, nulls, scores, more_ids, more_nulls, more, k: int) -> tuple:
    ids, nulls, scores = np.concatenate([ids, more_ids]), np.concatenate([nulls, more_nulls]), \
        np.concatenate([scores, more])
    order = np.lexsort((ids, nulls, -scores))[:k]
    return ids[order], nulls[order], scores[order]


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", slice_terms: int = SLICE_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 for every row of ``items``
    (``item_col``, ``text_col``)."""
    spark = docs.sparkSession
    terms = item_terms(items, item_col, text_col)
    pairs = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    slices = -(-pairs // slice_terms)
    if slices > 1:
        terms = stored(terms.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(slices))), "lexical-slices")
    found = None
    for s in range(max(slices, 1)):
        rows = (terms.filter(F.col("slice") == s) if slices > 1 else terms).select("item", "terms").collect()
        held = spark.sparkContext.broadcast(item_slice(rows))
        best = stored(_slice_best(index_blocks(docs, held, id_col, text_col), held, k), "lexical-best")
        found = best if found is None else found.unionByName(best)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.join(terms.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_mask_search(spark, sf_dir: str) -> DataFrame:
    """Contract columns: the 50 best ``documents`` for every ``benchmark`` item."""
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 50)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH docs AS (
  SELECT row, doc_id, len(t)::BIGINT AS n, unnest(t) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL)),
sizes AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS l FROM (SELECT DISTINCT row, n FROM docs)),
tf AS (SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM docs GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, sizes),
items AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(t) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark WHERE text IS NOT NULL))),
scores AS (
  SELECT item, item_id, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // l))))::BIGINT AS score
  FROM items JOIN w USING (term) JOIN tf USING (term), sizes GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
