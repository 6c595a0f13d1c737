"""Operator 3: exact top-k inner products over a bit-sliced index.

Components become integers floor(64 * x). Rows are dealt into blocks of about
``BLOCK_ROWS``; a block keeps, for each component, one bitmap per binary digit
(after taking off the component's least value in the block). A query adds the
slices of all components, weighted by its own integers, with carry-save bitmap
arithmetic, which leaves one bitmap per digit of the score of all rows of the
block at once. From the most significant digit downward the rows that are sure
to be among the k best are set apart; rows that tie at the boundary are told
apart by the smaller id. Scores are read from the slices, so all is exact.

Every block of rows meets every block of queries, in tasks of a bounded size.
The join that brings them together repeats both sides, so it never broadcasts:
Spark would judge a side by its size before it is repeated. With many cells a
block of rows is sent once to a group of blocks of queries. The best of the
blocks are merged in a tree.

Defined cases: vectors that are null, empty, or hold a null, a non-finite
component, or one so large that sums of products exceed a long (see :func:`quantised`), take no part, nor do rows
without an id; vectors are compared with those of their own length only; rows
with a query's id are not its candidates; rows that share an id are candidates
each; an id that is a query in several rows is one query (the smallest
vector). An empty table gives no rows. Only ``id_col`` and ``vec_col`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, tidied

SCALE = 64
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 256
FAN_IN = 256
#: Blocks of queries are grouped as long as so many cells are left, so many in a group at most.
GRID = 256
GROUP = 64
#: Tasks that the cells are dealt to at most.
TASKS = 4096
#: Rows of blocks in an Arrow batch; each may have a few MB.
BATCH = 4
_U = np.uint64


@contextmanager
def _small_batches(spark: SparkSession):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    spark.conf.set(key, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """(vec_id, q) of the vectors that take part: q as array<bigint>. Finite vectors take part as long as every sum of
    their products, and the slices' parts of it, fit a long: components up to sqrt(2**60 / length)."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    q = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("bigint"))
    fits = F.size("x") > 0
    largest = F.sqrt(F.lit(float(1 << 60)) / F.size("x")) / scale
    fits &= ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > largest))
    return vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("x")) \
        .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).filter(fits).select("vec_id", q.alias("q"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows (vec_id, q) of a partition by length of vector: (length, ids, integers), ordered by id."""
    held: dict[int, tuple[list, list]] = {}
    for batch in batches:
        ids, q = batch.column(0).to_numpy(), batch.column(1)
        offs, flat = q.offsets.to_numpy(), q.values.to_numpy()
        size = np.diff(offs)
        for dim in np.unique(size).tolist():
            at = np.flatnonzero(size == dim)
            rows = flat[offs[at][:, None] + np.arange(dim)]
            a, b = held.setdefault(dim, ([], []))
            a.append(ids[at])
            b.append(rows)
    for dim, (a, b) in held.items():
        ids, rows = np.concatenate(a), np.concatenate(b)
        order = np.argsort(ids, kind="stable")
        yield dim, ids[order], rows[order]


def index_blocks(vectors: DataFrame, blocks: int) -> DataFrame:
    """(block, dim, ids, low, digits, slices): one row per block and length of vector, stored."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, rows in _matrices(batches):
            low = rows.min(axis=0)
            above = (rows - low).astype(_U)
            digits = np.array([int(v).bit_length() for v in above.max(axis=0)], np.int64)
            padded = np.zeros((-(-len(ids) // 64) * 64, dim), _U)
            padded[:len(ids)] = above
            slices = [np.packbits((padded[:, d] >> _U(i)).astype(np.uint8) & 1, bitorder="little")
                      for d in range(dim) for i in range(digits[d])]
            raw = np.concatenate(slices).tobytes() if slices else b""
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([dim]),
                                   pa.array([ids.astype(np.int64).tobytes()]), pa.array([low.astype(np.int64).tobytes()]),
                                   pa.array([digits.tobytes()]), pa.array([raw], pa.binary())],
                                  ["block", "dim", "ids", "low", "digits", "slices"])

    return stored(vectors.repartition(blocks).mapInArrow(
        tidied(build), "block bigint, dim bigint, ids binary, low binary, digits binary, slices binary"), "topk-index")


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """(part, dim, query_ids, weights): one row per block of queries and length of vector, stored; weights are as
    narrow as their values allow."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, rows in _matrices(batches):
            width = next(w for w in (np.int8, np.int16, np.int32, np.int64)
                         if np.iinfo(w).min <= rows.min() and rows.max() <= np.iinfo(w).max)
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([dim]),
                                   pa.array([ids.astype(np.int64).tobytes()]),
                                   pa.array([rows.astype(width).tobytes()])],
                                  ["part", "dim", "query_ids", "weights"])

    return stored(queries.repartition(blocks).mapInArrow(
        tidied(build), "part bigint, dim bigint, query_ids binary, weights binary"), "topk-queries")


class BitSlices:
    """One block: slices of all components, and their complements, as rows of 64-bit words."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, digits: np.ndarray, raw: bytes):
        self.ids, self.low, self.digits = ids, low, digits
        self.words = -(-len(ids) // 64)
        slices = np.frombuffer(raw, _U).reshape(int(digits.sum()), self.words)
        self.planes = np.concatenate([slices, ~slices])
        self.of = np.repeat(np.arange(len(digits)), digits)  # component and digit of each slice
        self.digit = np.arange(len(self.of)) - np.repeat(np.cumsum(digits) - digits, digits)
        self.all = np.packbits(np.arange(self.words * 64) < len(ids), bitorder="little").view(_U)

    def add(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the sum of all components times their weights, and what to add to each sum."""
        size = np.abs(weights)
        full = (1 << self.digits) - 1
        offset = int(np.where(weights > 0, size * self.low, -size * (full + self.low)).sum())
        place, row = [], []
        complement = np.where(weights[self.of] < 0, len(self.of), 0) + np.arange(len(self.of))
        for j in range(int(size.max()).bit_length() if len(size) else 0):
            on = np.flatnonzero((size[self.of] >> j) & 1)
            place.append(self.digit[on] + j)
            row.append(complement[on])
        place, row = (np.concatenate(place), np.concatenate(row)) if place else (np.zeros(0, int), np.zeros(0, int))
        out, carried, p = [], [], 0
        while p <= (place.max() if len(place) else -1) or carried:
            x = np.concatenate([self.planes[row[place == p]], *carried])
            carried = []
            while len(x) >= 3:  # three planes become their sum and their carry
                k = len(x) // 3
                a, b, c = x[:k], x[k:2 * k], x[2 * k:3 * k]
                ab = a ^ b
                carried.append((a & b) | (ab & c))
                x = np.concatenate([ab ^ c, x[3 * k:]]) if len(x) > 3 * k else ab ^ c
            if len(x) == 2:
                carried.append(x[:1] & x[1:])
                x = x[:1] ^ x[1:]
            out.append(x[0] if len(x) else np.zeros(self.words, _U))
            p += 1
        return out, offset

    def best(self, slices: list[np.ndarray], offset: int, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with the k highest sums, ties to the smaller id, and their sums."""
        maybe = self.all.copy()
        for at in range(np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")):
            maybe[at >> 6] &= ~(_U(1) << _U(at & 63))
        sure = np.zeros_like(maybe)
        for s in reversed(slices):
            x = sure | (maybe & s)
            n = int(np.bitwise_count(x).sum())
            if n > k:
                maybe &= s
            else:
                sure = x
                maybe &= ~s
                if n == k:
                    maybe[:] = 0
                    break
        rows, ties = _positions(sure), _positions(maybe)
        rows = np.concatenate([rows, ties[:k - len(rows)]])
        score = np.full(len(rows), offset, np.int64)
        for w, s in enumerate(slices):
            score += ((s[rows >> 6] >> (rows & 63).astype(_U)) & _U(1)).astype(np.int64) << w
        return rows, score


def _positions(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row (vec_id, q) of ``queries`` the k rows (vec_id, q) of
    ``vectors`` with the highest inner products; both as :func:`quantised` gives them."""
    spark = vectors.sparkSession
    asked = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    n_blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    n_parts = max(1, -(-asked.count() // BLOCK_QUERIES))
    index, parts = index_blocks(vectors, n_blocks), query_blocks(asked, n_parts)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                block = BitSlices(np.frombuffer(cell["ids"], np.int64), np.frombuffer(cell["low"], np.int64),
                                  np.frombuffer(cell["digits"], np.int64), cell["slices"])
                query_ids = np.frombuffer(cell["query_ids"], np.int64)
                width = len(cell["weights"]) // (len(query_ids) * cell["dim"])
                weights = np.frombuffer(cell["weights"], f"i{width}").reshape(len(query_ids), cell["dim"]).astype(np.int64)
                owner, found, score = [], [], []
                for own, w in zip(query_ids.tolist(), weights, strict=True):
                    rows, sums = block.best(*block.add(w), own, k)
                    owner.append(np.full(len(rows), own))
                    found.append(block.ids[rows])
                    score.append(sums)
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (owner, found, score)]
                yield pa.record_batch([*columns, pa.array(np.full(len(columns[0]), cell["block"]))],
                                      ["query_id", "vec_id", "score", "block"])

    per_group = min(GROUP, max(1, n_blocks * n_parts // GRID))
    n_groups = -(-n_parts // per_group)
    keys = ["block", "group", "dim"]

    def each(df: DataFrame, name: str, n: int) -> DataFrame:
        every = df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
        return every.repartition(min(n_blocks * n_groups, TASKS), *keys).hint("merge")

    grouped = parts.withColumn("group", F.floor(F.col("part") / per_group))
    cells = each(index, "group", n_groups).join(each(grouped, "block", n_blocks), keys)
    with _small_batches(spark):
        found = stored(cells.mapInArrow(tidied(search), "query_id bigint, vec_id bigint, score bigint, block bigint"),
                       "topk-found")
    best_first = [F.desc("score"), F.asc("vec_id")]
    while n_blocks > FAN_IN:  # merge neighbouring blocks first
        n_blocks = -(-n_blocks // FAN_IN)
        found = found.withColumn("block", F.floor(F.col("block") / FAN_IN))
        w = Window.partitionBy("query_id", "block").orderBy(*best_first)
        found = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("rank")
    w = Window.partitionBy("query_id").orderBy(*best_first)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op3_bit_sliced_topk(spark, sf_dir: str) -> DataFrame:
    """Contract columns: the 20 best of every query (vec_id divisible by 20) of ``embeddings``."""
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


OP3_SQL = """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
fit AS (SELECT vec_id FROM parts GROUP BY vec_id HAVING count(*) = count(CASE WHEN isfinite(x) THEN 1 END)),
e AS (SELECT vec_id, i, floor(64 * x)::BIGINT AS c FROM parts JOIN fit USING (vec_id)),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, sum(a.c * b.c)::BIGINT AS score
  FROM e a JOIN e b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
