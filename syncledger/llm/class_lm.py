"""Operator 9: scoring by a class-based n-gram model (Brown classes by exchange).

Every token of the training texts is counted, and every word seen is put into a
class by the exchange algorithm on bigram counts over the whole training corpus;
the number of classes grows with the number of words. The most frequent words
(``CLASS_WORDS``) begin the classes; then sweeps over the corpus count each
word's neighbours by class and move it to the class that raises the likelihood
most, first every word that has no class, then half of all words at a time. A
sweep that does not raise the likelihood is undone and is the last. A text's
end, which also stands before its start, has a class of its own, and so have
unseen words. A token's probability is that of its class after the class before
it, smoothed, times the word's share in its class.

Counts and classes of frequent words (a proven bound) are sent to every worker.
The texts are read three times: to count, to write them as numbers (the tape),
and to score. A sweep reads the tape alone. Its counts by word and class travel
in packed runs, each to the part its word is dealt to, where the word is judged.
A rarer word has its neighbours listed with it; only where two of them meet is a
class joined. Scoring joins a text's rarer words with their counts and classes,
hash by hash. Tables that a sweep has replaced are deleted.

Defined cases: a null or empty text is one end token; an id may be null (it
counts as the empty text) or repeat, every row is scored for itself; without
training texts all counts are 0; an empty table gives no rows. Only ``id_col``
and ``text_col`` are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import (
    blocks,
    bounded_batches,
    is_training,
    lower_ascii,
    stored,
    text_bytes,
    tidied,
    word_hashes,
    worker_state,
)

#: Words that begin the classes, and the fewest classes of a corpus with that many words.
CLASS_WORDS = 512
CLASSES = 40
SWEEPS = 8
#: Sweeps over all words of the corpus, the first assignment included.
CORPUS_SWEEPS = 2
#: Counts up to this have their gains in a table.
SMALL = 8
#: At most this many words have their counts sent to every worker (16 bytes each).
BROADCAST_WORDS = 1_000_000
#: Tokens gathered in a worker before they are counted.
CHUNK = 2_000_000
#: Tokens in a run of the tape, values in a packed row, and bytes of a row group of packed rows.
RUN, PIECE, ROW_GROUP = 1 << 14, 1 << 13, 16 << 20
#: The fewest parts that words are dealt to, and tokens of the corpus to a part.
PARTS, PART_TOKENS = 64, 4_000_000
#: Words judged at once.
WORDS = 512
#: Flags of a neighbour: it stands before the word; it is not sent to the workers.
BEFORE, RARE = 1, 2
END = np.uint64(1)
_U = np.uint64
_STEP = "cast(floor(4 * log2(n)) as int)"


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a block, each text's end included, and each text's first token (n + 1 values)."""
    h, first = word_hashes(lower_ascii(data), offs)
    n = len(offs) - 1
    tokens = np.full(len(h) + n, END, _U)
    own = np.ones(len(tokens), bool)
    first = first + np.arange(n + 1)
    own[first[1:] - 1] = False
    tokens[own] = h
    return tokens, first


def count_tokens(texts: DataFrame) -> tuple[DataFrame, str]:
    """(h, n): every token of the column ``text`` by its hash, with its count, stored; and its path."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(found.view(np.int64)), pa.array(n)], ["h", "n"])

        for batch in batches:
            data, offs = text_bytes(batch.column(0))
            for _, _, d, o in blocks(data, offs):
                held.append(_tokens(d, o)[0])
                size += len(held[-1])
                if size >= CHUNK:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return _table(texts.select("text").mapInArrow(tidied(count), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")),
                  "lm-counts")


def _lookup(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``h`` in the sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


def finder(keys: np.ndarray):
    """A function that gives the places of hashes in the sorted ``keys``, and whether they are there. Hashes are spread
    evenly, so their first bits lead to within a key or two of the place."""
    if not len(keys):
        return lambda h: (np.zeros(len(h), np.int64), np.zeros(len(h), bool))
    bits, last = len(keys).bit_length(), len(keys) - 1
    shift = _U(64 - bits)
    starts = np.searchsorted(keys, np.arange(1 << bits, dtype=_U) << shift)

    def find(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(starts[(h >> shift).astype(np.int64)], last)
        low = np.flatnonzero((keys[at] < h) & (at < last))
        while len(low):
            at[low] += 1
            low = low[(keys[at[low]] < h[low]) & (at[low] < last)]
        return at, keys[at] == h

    return find


def _word_ids(keys: np.ndarray, ids: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """0 to K - 1: class words; K: any other word; K + 1: the end."""
    at, known = _lookup(keys, tokens)
    out = np.where(known, ids[at] if len(ids) else 0, len(keys))
    out[tokens == END] = len(keys) + 1
    return out


def _table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder in small row groups (its rows are long), read back, and its path."""
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _drop(spark, path: str) -> None:
    """Delete a table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _cuts(part: np.ndarray, limit: int = PIECE) -> np.ndarray:
    """Bounds of runs of equal values of the sorted ``part``, none longer than ``limit``."""
    heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(part))
    return np.append(np.concatenate([np.arange(i, j, limit) for i, j in zip(heads, ends)]) if len(heads) else [],
                     len(part)).astype(np.int64)


def _packed(part: np.ndarray, columns: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Rows (part, one binary a column): runs of the arrays in ``columns``, which are in the order of ``part``. The
    other columns of ``names`` are null."""
    cuts = _cuts(part)
    out = [pa.array(part[cuts[:-1]].astype(np.int32))]
    for name in names:
        values = columns.get(name)
        raw = None if values is None else np.ascontiguousarray(values).view(np.uint8)
        size = 0 if values is None else values.itemsize
        out.append(pa.array([None if raw is None else raw[i * size:j * size].tobytes() for i, j in zip(cuts[:-1], cuts[1:])],
                            pa.binary()))
    return pa.record_batch(out, ["part", *names])


def _unpacked(column: pa.Array, dtype) -> np.ndarray:
    """The values of a column of binaries, one after the other."""
    return np.concatenate([np.zeros(0, dtype), *[np.frombuffer(v.as_buffer(), dtype) for v in column if v.is_valid]])


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> _U(32)) % _U(parts)).astype(np.int64)


_TAPE = ["ids", "r", "near", "flag"]
_TOLD = ["r", "near", "flag", "own", "cell", "word", "n", "of"]


def _schema(names: list[str]) -> str:
    return "part int, " + ", ".join(f"{name} binary" for name in names)


def tape(texts: DataFrame, keys: np.ndarray, parts: int) -> tuple[DataFrame, str]:
    """The column ``text`` as numbers, stored; no later step reads the texts. Rows of part -1 hold in ``ids`` the places
    of tokens in the sorted ``keys`` (any other word: their number), each run after the token before it. The other rows
    hold two entries for every word that is not in ``keys`` (``r``, dealt to parts by hash): the token after it and the one
    before it in ``near`` (``flag`` has BEFORE), as a place or, with RARE, as a hash."""
    shipped = texts.sparkSession.sparkContext.broadcast(keys)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shipped.value
        find, other = finder(keys), len(keys)
        end = int(np.searchsorted(keys, END))
        held, rows, size = [], [], 0

        def written() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([np.array([end], np.int32), *held])
            at = np.arange(0, len(ids) - 1, RUN)
            runs = [ids[i:i + RUN + 1].tobytes() for i in at]
            yield pa.record_batch([pa.array(np.full(len(runs), -1, np.int32)), pa.array(runs, pa.binary()),
                                   *[pa.nulls(len(runs), pa.binary())] * 3], ["part", *_TAPE])
            r, near, flag = (np.concatenate(x) for x in zip(*rows))
            part = _part_of(r, parts)
            order = np.argsort(part, kind="stable")
            yield _packed(part[order], {"r": r[order], "near": near[order], "flag": flag[order]}, _TAPE)

        for batch in batches:
            data, offs = text_bytes(batch.column(0))
            for _, _, d, o in blocks(data, offs):
                tokens = _tokens(d, o)[0]
                at, known = find(tokens)
                near = np.where(known, at.astype(_U), tokens)
                rare = np.where(known, 0, RARE).astype(np.uint8)
                own = np.flatnonzero(~known)
                r = tokens[own]  # an end stands after every word, and before the first
                rows.append((r, near[own + 1], rare[own + 1]))
                rows.append((r, np.where(own > 0, near[own - 1], _U(end)),
                             np.where(own > 0, rare[own - 1], 0).astype(np.uint8) | np.uint8(BEFORE)))
                held.append(np.where(known, at, other).astype(np.int32))
                size += len(tokens)
                if size >= CHUNK:
                    yield from written()
                    held, rows, size = [], [], 0
        if held:
            yield from written()

    return _table(texts.select("text").mapInArrow(tidied(encode), _schema(_TAPE)), "lm-tape")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and the tokens after them, run by run."""
    for value in batch.column(0):
        ids = np.frombuffer(value.as_buffer(), np.int32).astype(np.int64)
        yield ids[:-1], ids[1:]


def _grid(df: DataFrame, count, side: int) -> np.ndarray:
    """side x side sums of what ``count`` (batch -> pair numbers and times, or None for 1) finds in ``df``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for pair in count(batch):
                total += np.bincount(pair, minlength=side * side)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["pair", "n"])

    found = df.mapInArrow(tidied(work), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")) \
        .toArrow()  # at most side ** 2 rows
    out = np.zeros(side * side, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(side, side)


def count_bigrams(runs: DataFrame, of: np.ndarray, side: int) -> np.ndarray:
    """side x side counts of classes after classes in the runs; ``of`` has the class of each id."""
    shipped = runs.sparkSession.sparkContext.broadcast(of)

    def count(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        of = shipped.value
        for x, y in _runs(batch):
            yield of[x] * side + of[y]

    return _grid(runs, count, side)


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the word ids: each word in turn moves to the class that raises the likelihood of the class
    bigrams most, until a sweep moves none. The last two ids keep classes of their own (the last two)."""
    def f(x):
        return x * np.log(np.maximum(x, 1))

    side = len(bigrams)
    words, seeds = side - 2, min(classes, side - 2)
    # words whose neighbours are least like each other's begin a class each, the others join the one most like them
    near = np.concatenate([bigrams, bigrams.T], axis=1).astype(float)
    near /= np.maximum(np.sqrt((near ** 2).sum(axis=1, keepdims=True)), 1)
    of = np.zeros(side, np.int64)
    like = np.full((words, seeds), -1.0)
    for c in range(seeds):
        seed = int(like.max(axis=1).argmin()) if c else 0
        like[:, c] = near[:words] @ near[seed]
        like[seed, c] = 2.0
    if seeds:
        of[:words] = like.argmax(axis=1)
    of[words:] = [classes, classes + 1]
    both = classes + 2
    member = np.zeros((side, both))
    member[np.arange(side), of] = 1
    b = bigrams.astype(float)
    n = member.T @ b @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            old, own = of[w], b[w, w]
            right, left = b[w] @ member, b[:, w] @ member
            right[old] -= own
            left[old] -= own
            n[old, :] -= right
            n[:, old] -= left
            n[old, old] -= own
            m = n[:classes]
            rows, cols = n.sum(axis=1)[:classes], n.sum(axis=0)[:classes]
            gain = (f(m + right) - f(m)).sum(axis=1) + (f(n[:, :classes] + left[:, None]) - f(n[:, :classes])).sum(axis=0)
            k = np.arange(classes)
            corner = n[k, k]
            gain += f(corner + right[k] + left[k] + own) - f(corner + right[k]) - f(corner + left[k]) + f(corner)
            gain -= f(rows + right.sum() + own) - f(rows) + f(cols + left.sum() + own) - f(cols)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            n[new, :] += right
            n[:, new] += left
            n[new, new] += own
            member[w, old], member[w, new], of[w] = 0, 1, new
            moved += new != old
        if not moved:
            break
    return of


def class_number(types: int) -> int:
    """Twice the fourth root of the number of types, at least ``CLASSES`` and at most ``CLASS_WORDS``."""
    return min(CLASS_WORDS, max(CLASSES, round(2 * types ** 0.25)))


def _f(x):
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """What classes add to the log-likelihood of the corpus, but for a constant."""
    return float(_f(table).sum() - _f(table.sum(axis=1)).sum() - _f(table.sum(axis=0)).sum())


def best_classes(table: np.ndarray, old: np.ndarray, row: np.ndarray, cell: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class that raises the likelihood most, for each word by its contexts. In its own class a word is judged
    without its own counts, in all others by the table as it stands. Class side - 2 is no choice."""
    side = len(table)
    classes, words = side - 2, len(old)
    small, near = worker_state("lm_gains", dict), np.concatenate([table[:classes].T, table[:, :classes]])
    if small.get("table") is not table:  # gains by count and cell
        small.update(table=table, gains=np.stack([_f(near + k) - _f(near) for k in range(SMALL + 1)]))
    gain = np.zeros((words, classes))
    plain = cell < 2 * side
    w, c, m = row[plain], cell[plain], n[plain].astype(float)
    after, before = np.zeros(words), np.zeros(words)
    own = np.bincount(row[~plain], n[~plain], words)
    for i in range(0, len(w), 1 << 14):
        ww, cc, mm = w[i:i + (1 << 14)], c[i:i + (1 << 14)], m[i:i + (1 << 14)]
        value = small["gains"][np.minimum(mm, SMALL).astype(np.int64), cc]
        big = np.flatnonzero(mm > SMALL)
        value[big] = _f(near[cc[big]] + mm[big, None]) - _f(near[cc[big]])
        start = np.flatnonzero(np.concatenate([[True], ww[1:] != ww[:-1]]))
        gain[ww[start]] += np.add.reduceat(value, start, axis=0)
    right = c < side
    after += np.bincount(w[right], m[right], words)
    before += np.bincount(w[~right], m[~right], words)
    rows, cols = table.sum(axis=1)[:classes], table.sum(axis=0)[:classes]
    gain -= _f(rows + after[:, None]) - _f(rows) + _f(cols + before[:, None]) - _f(cols)
    # classes on both sides of a word meet in one cell of the table if it joins them
    at_right, at_left = w[right] * side + c[right], w[~right] * side + c[~right] - side
    _, i, j = np.intersect1d(at_right, at_left, assume_unique=True, return_indices=True)
    k, r, l = c[right][i], m[right][i], m[~right][j]
    inner = k < classes
    k, r, l, who = k[inner], r[inner], l[inner], w[right][i][inner]
    corner = table[k, k]
    gain[who, k] += _f(corner + r + l) - _f(corner + r) - _f(corner + l) + _f(corner)
    # its own class, without it
    at = np.flatnonzero(old < classes)
    if len(at):
        o = np.minimum(old, classes - 1)
        cells = np.where(right, o[w] * side + c, (c - side) * side + o[w])
        mine = table.ravel()[cells]
        stay = np.bincount(w, _f(mine) - _f(np.maximum(mine - m, 0)), words)
        hit = old[who] == k
        who, k, r, l = who[hit], k[hit], r[hit], l[hit]
        corner, twice = table[k, k], own[who]  # its own pairs are in both counts
        stay[who] += _f(corner - r) + _f(corner - l) - _f(corner) - _f(np.maximum(corner - r - l + twice, 0))
        stay -= _f(rows[o]) - _f(rows[o] - after) + _f(cols[o]) - _f(cols[o] - before)
        gain[at, old[at]] = stay[at]
    best = gain.argmax(axis=1)
    rise = gain[np.arange(words), best] > gain[np.arange(words), np.minimum(old, classes - 1)] + 1e-9
    return np.where((old >= classes) | rise, best, old)


def frequent_cells(runs: DataFrame, told: DataFrame | None, of: np.ndarray, side: int, go: np.ndarray,
                   parts: int) -> DataFrame:
    """(part, code, n): how often each class comes after the words of ``keys`` that ``go`` (cells 0 to side - 1) and
    before them (side to 2 * side - 1). Cell 2 * side: a word after itself, which the other cells count too. A code is
    place * (2 * side + 1) + cell. Words that are not in ``keys`` have the classes ``told``; without, all have the last
    of ``of``."""
    shipped = runs.sparkSession.sparkContext.broadcast((of, go))
    span, names, apart = 2 * side + 1, ["code", "n"], told is not None

    def work(pairs, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, go = shipped.value
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            part = code // span * parts // len(of)
            return _packed(part, {"code": code, "n": n.astype(np.int32)}, names)

        for batch in batches:
            for codes in pairs(batch, of, go):
                held.append(codes)
                size += len(codes)
                if size >= 2 * CHUNK:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    def seen(batch: pa.RecordBatch, of: np.ndarray, go: np.ndarray) -> Iterator[np.ndarray]:
        other = len(of) - 1
        for x, y in _runs(batch):
            right, left = go[x], go[y]
            if apart:
                right, left = right & (y != other), left & (x != other)
            twin = x[right & (x == y)]
            yield np.concatenate([x[right] * span + of[y[right]], y[left] * span + side + of[x[left]], twin * span + 2 * side])

    def heard(batch: pa.RecordBatch, of: np.ndarray, go: np.ndarray) -> Iterator[np.ndarray]:
        near, flag, own = (_unpacked(batch.column(k), t) for k, t in ((0, np.int64), (1, np.uint8), (2, np.int32)))
        at = np.flatnonzero(flag & RARE == 0)
        at = at[go[near[at]]]
        yield near[at] * span + own[at] + np.where(flag[at] & BEFORE, 0, side)

    cells = runs.mapInArrow(tidied(lambda batches: work(seen, batches)), _schema(names))
    if told is None:
        return cells
    return cells.unionByName(told.filter("r is not null").select("near", "flag", "own")
                             .mapInArrow(tidied(lambda batches: work(heard, batches)), _schema(names)))


def _by_part(batches: Iterator[pa.RecordBatch], columns: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Whole parts of rows that are in the order of their part (the first column): the arrays of the other columns."""
    held, of = [[] for _ in columns], None
    for batch in batches:
        part = batch.column(0).to_numpy()
        cuts = _cuts(part, len(part) + 1)
        for i, j in zip(cuts[:-1], cuts[1:]):
            if of is not None and part[i] != of:
                yield of, [np.concatenate(x) for x in held]
                held = [[] for _ in columns]
            of = int(part[i])
            for x, k in zip(held, range(len(columns))):
                x.append(_unpacked(batch.column(k + 1).slice(i, j - i), columns[k]))
    if of is not None:
        yield of, [np.concatenate(x) for x in held]


def _judged(table: np.ndarray, old: np.ndarray, code: np.ndarray, n: np.ndarray, span: int) -> np.ndarray:
    """The new classes of words 0, 1, ...: ``code`` (sorted) is word * span + cell, seen ``n`` times."""
    new = old.copy()
    row, cell = code // span, code % span
    for i in range(0, len(old), WORDS):
        j = min(len(old), i + WORDS)
        a, b = np.searchsorted(row, [i, j])
        new[i:j] = best_classes(table, old[i:j], row[a:b] - i, cell[a:b], n[a:b])
    return new


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[heads], np.add.reduceat(n, heads) if len(heads) else n


def move_frequent(cells: DataFrame, of: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The classes after a sweep over the words whose ``cells`` are given."""
    shipped = cells.sparkSession.sparkContext.broadcast((of, table))
    span = 2 * len(table) + 1

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = shipped.value
        for _, (code, n) in _by_part(batches, [np.int64, np.int32]):
            code, n = _summed(code, n.astype(np.int64))
            word, place = np.unique(code // span, return_inverse=True)
            new = _judged(table, of[word], place * span + code % span, n, span)
            yield pa.record_batch([pa.array(word.astype(np.int32)), pa.array(new.astype(np.int32))], ["id", "of"])

    got = cells.repartition("part").sortWithinPartitions("part").mapInArrow(tidied(move), "id int, of int") \
        .toArrow()  # as many as are sent
    out = of.copy()
    out[got.column("id").to_numpy()] = got.column("of").to_numpy()
    return out


def move_rare(rows: DataFrame, of: np.ndarray, table: np.ndarray, sweep: int) -> tuple[DataFrame, str]:
    """The entries of the tape's words that are not sent, stored with their word's class after a sweep (``own``), and
    (word, n, of) of every such word. ``rows``: entries as they were, and from the second sweep on their cells by
    neighbours that are not sent either (``r``, ``cell``)."""
    shipped = rows.sparkSession.sparkContext.broadcast((of, table))
    side = len(table)
    span, unset = 2 * side + 1, side - 2

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = shipped.value
        kinds = [_U, _U, np.uint8, np.int32, _U, np.int32]
        for part, (r, near, flag, own, met, cell) in _by_part(batches, kinds):
            word, at = np.unique(r, return_inverse=True)
            sent = flag & RARE == 0
            cells = np.full(len(r), unset)
            cells[sent] = of[near[sent].astype(np.int64)]
            cells += np.where(flag & BEFORE, side, 0)
            twin = np.flatnonzero(~sent & (near == r) & (flag & BEFORE == 0))
            first = sent if sweep else np.ones(len(r), bool)  # later on, neighbours that are not sent come as cells
            code, n = np.unique(np.concatenate([at[first] * span + cells[first], at[twin] * span + 2 * side,
                                                np.searchsorted(word, met) * span + cell]), return_counts=True)
            old = np.full(len(word), unset)
            if sweep:
                old[at] = own
            turn = (word >> _U(20)) % _U(2) == _U(sweep % 2) if sweep else np.ones(len(word), bool)
            go = np.flatnonzero(turn)
            mine = turn[code // span]
            place = np.cumsum(turn) - 1
            new = old.copy()
            new[go] = _judged(table, old[go], place[code[mine] // span] * span + code[mine] % span, n[mine], span)
            new = new.astype(np.int32)
            yield _packed(np.full(len(r), part), {"r": r, "near": near, "flag": flag, "own": new[at]}, _TOLD)
            times = np.bincount(at[flag & BEFORE == 0], minlength=len(word))
            yield _packed(np.full(len(word), part), {"word": word, "n": times, "of": new}, _TOLD)

    found = rows.repartition("part").sortWithinPartitions("part").mapInArrow(tidied(move), _schema(_TOLD))
    return _table(found, "lm-told")


def rare_words(told: DataFrame) -> DataFrame:
    """(h, n, of) of the words that are not sent."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.record_batch([pa.array(_unpacked(batch.column(k).slice(i, 1), t)) for k, t in
                                       enumerate((np.int64, np.int64, np.int32))], ["h", "n", "of"])

    return told.filter("word is not null").select("word", "n", "of").mapInArrow(tidied(each), "h bigint, n bigint, of int")


def meetings(told: DataFrame) -> tuple[DataFrame, str]:
    """(r, flag, own, of), stored: entries whose neighbour is not sent either, with its class."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [_unpacked(batch.column(k), t) for k, t in enumerate((np.int64, np.int64, np.uint8, np.int32))]
            at = np.flatnonzero(columns[2] & RARE)
            yield pa.record_batch([pa.array(x[at].astype(np.int32) if k == 2 else x[at]) for k, x in enumerate(columns)],
                                  ["r", "h", "flag", "own"])

    rows = told.filter("r is not null").select("r", "near", "flag", "own") \
        .mapInArrow(tidied(each), "r bigint, h bigint, flag int, own int")
    return _table(rows.join(rare_words(told).select("h", "of"), "h").select("r", "flag", "own", "of"), "lm-meetings")


def met_cells(met: DataFrame, side: int, parts: int) -> DataFrame:
    """(part, r, cell) of the meetings, for :func:`move_rare`."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, flag, of = (batch.column(k).to_numpy() for k in (0, 1, 3))
            cell = (of + np.where(flag & BEFORE, side, 0)).astype(np.int32)
            part = _part_of(r.view(_U), parts)
            order = np.argsort(part, kind="stable")
            yield _packed(part[order], {"met": r[order], "cell": cell[order]}, ["met", "cell"])

    return met.mapInArrow(tidied(each), "part int, met binary, cell binary")


def class_table(runs: DataFrame, told: DataFrame | None, met: DataFrame | None, of: np.ndarray, side: int) -> np.ndarray:
    """side x side counts of classes after classes."""
    if told is None:
        return count_bigrams(runs, of, side)
    # pairs with a word that is not sent fall in a row or column of their own, and are counted from its entries instead
    out = count_bigrams(runs, np.append(of[:-1], side), side + 1)[:side, :side]
    shipped = runs.sparkSession.sparkContext.broadcast(of)

    def count(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        near, flag, own = (_unpacked(batch.column(k), t) for k, t in ((0, np.int64), (1, np.uint8), (2, np.int32)))
        at = np.flatnonzero(flag & RARE == 0)
        near, before, own = shipped.value[near[at]], flag[at] & BEFORE != 0, own[at].astype(np.int64)
        yield np.where(before, near * side + own, own * side + near)

    out = out + _grid(told.filter("r is not null").select("near", "flag", "own"), count, side)
    for r in met.filter(F.col("flag").bitwiseAND(BEFORE) == 0).groupBy("own", "of").count().collect():  # at most side ** 2
        out[r["own"], r["of"]] += r["count"]
    return out


def classify(tape_: DataFrame, keys: np.ndarray, of: np.ndarray, table: np.ndarray, rare: bool, parts: int,
             sweeps: int = CORPUS_SWEEPS) -> tuple[np.ndarray, DataFrame | None, np.ndarray]:
    """Sweeps over the corpus until all words have classes and no sweep raises the likelihood: the classes of the sorted
    ``keys`` (and of any other word), the entries of the words that are not in ``keys`` (if there are any, ``rare``) with
    their classes, and counts of classes after classes. ``of`` and ``table`` are those before the first sweep."""
    spark, side = tape_.sparkSession, len(table)
    runs = tape_.filter("part < 0").select("ids")
    kept, told, met, paths = (of, None, table), None, None, []
    for sweep in range(sweeps):
        turn = (of == side - 2) if not sweep else (np.append(keys, _U(0)) >> _U(20)) % _U(2) == _U(sweep % 2)
        go = turn & (of < side - 1)
        go[-1] = False
        new = move_frequent(frequent_cells(runs, told, of, side, go, parts), of, table)
        if rare:
            blank = F.lit(None).cast("binary")
            if sweep:
                rows = told.filter("r is not null").select("part", "r", "near", "flag", "own", blank.alias("met"),
                                                           blank.alias("cell")) \
                    .unionByName(met_cells(met, side, parts), allowMissingColumns=True)
            else:
                rows = tape_.filter("part >= 0").select("part", "r", "near", "flag", blank.alias("own"),
                                                        blank.alias("met"), blank.alias("cell"))
            told, told_at = move_rare(rows, of, table, sweep)
            met, met_at = meetings(told)
            paths.append((told_at, met_at))
        of = new
        table = class_table(runs, told, met, of, side)
        if sweep and likelihood(table) <= likelihood(kept[2]):
            paths[-2:] = paths[-2:][::-1]
            break
        kept = of, told, table
    for k, (told_at, met_at) in enumerate(paths):  # all but the classes that are kept
        _drop(spark, met_at)
        if k < len(paths) - 1:
            _drop(spark, told_at)
    return kept


@dataclass
class ClassModel:
    tokens: int  # N
    types: int  # V
    keys: np.ndarray  # hashes of the words whose counts are sent, sorted
    counts: np.ndarray
    words: np.ndarray  # those of them that are words, not the end
    ids: np.ndarray  # their ids
    of: np.ndarray  # class of each word id; of unseen words and of the end
    after: np.ndarray  # log10 P(class | class before)
    emit: np.ndarray  # log10 P(word | class) of the words that are sent, 0 for the others
    size: np.ndarray  # tokens of each class


def train(texts: DataFrame, class_words: int = CLASS_WORDS, classes: int | None = None,
          broadcast_words: int = BROADCAST_WORDS) -> tuple[ClassModel, DataFrame]:
    """The model of the column ``text``, and (h, n, of) of the words whose counts are not in it."""
    spark = texts.sparkSession
    bounded_batches(spark)
    counts, counts_at = count_tokens(texts)
    tokens, types = counts.agg(F.sum("n"), F.count("*")).first()
    tokens = tokens or 0
    steps = sorted(((r["step"], r["count"]) for r in counts.groupBy(F.expr(_STEP).alias("step")).count().collect()),
                   reverse=True)  # four steps for each doubling of a count
    least, held = 1 << 30, 0
    for step, n in steps:
        if held + n > broadcast_words:
            break
        least, held = step, held + n
    top = counts.filter(F.col("h") != int(END)).orderBy(F.desc("n"), "h").limit(class_words).toArrow()
    sent = pa.concat_tables([counts.filter((F.expr(_STEP) >= least) | (F.col("h") == int(END))).toArrow(), top])
    keys, at = np.unique(sent.column("h").to_numpy().view(_U), return_index=True)  # the end and the top words are always sent
    number = sent.column("n").to_numpy()[at]
    plain = keys != END
    words, times = keys[plain], number[plain]
    seeds = top.column("h").to_numpy().view(_U)
    classes = max(1, min(classes or class_number(int(types)), len(seeds)))
    side, parts = classes + 2, max(PARTS, int(tokens) // PART_TOKENS)
    told, of = None, np.append(np.where(plain, classes, classes + 1), classes)
    n = np.zeros((side, side))
    _drop(spark, counts_at)
    if len(keys):
        tape_, tape_at = tape(texts, keys, parts)
        runs = tape_.filter("part < 0").select("ids")
        ids = np.append(np.where(plain, len(seeds), len(seeds) + 1), len(seeds))
        at = np.searchsorted(keys, seeds)
        ids[at] = np.arange(len(seeds))
        bigrams = count_bigrams(runs, ids, len(seeds) + 2)
        seeded = exchange(bigrams, classes)
        of[at] = seeded[:len(seeds)]
        n = np.zeros((side, len(seeds) + 2))
        np.add.at(n, seeded, bigrams)
        table = np.zeros((side, side))
        np.add.at(table.T, seeded, n.T)
        of, told, n = classify(tape_, keys, of, table, len(keys) < types, parts)
        _drop(spark, tape_at)
    of = np.concatenate([of[:-1][plain], [classes, classes + 1]])
    after = np.log10((n + 1) / (n.sum(axis=1, keepdims=True) + side))
    size = n.sum(axis=0)
    emit = np.zeros(len(of))
    emit[:len(words)] = np.log10(times / np.maximum(size[of[:-2]], 1))
    model = ClassModel(int(tokens), int(types), keys, number, words, np.arange(len(words)), of, after, emit, size)
    return model, spark.createDataFrame([], "h bigint, n bigint, of int") if told is None else rare_words(told)


def score(docs: DataFrame, model: ClassModel, rare: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = spark.sparkContext.broadcast(model)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        base_of = np.log10(m.counts + 1.0)
        row = TaskContext.get().partitionId() << 33
        other, side = len(m.words), len(m.after)
        find, ids_of = finder(m.keys), np.cumsum(m.keys != END) - 1
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            n_tokens, n_rare = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            base, own = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            hashes, times, lengths = [], [], np.zeros(batch.num_rows, np.int64)
            lefts, rights, met = [], [], np.zeros(batch.num_rows, np.int64)
            for i, j, d, o in blocks(data, offs):
                tokens, first = _tokens(d, o)
                at, known = find(tokens)
                logs = np.where(known, base_of[at] if len(base_of) else 0.0, 0.0)
                ids = np.where(known, ids_of[at] if len(ids_of) else other, other)
                ids[tokens == END] = other + 1
                base[i:j] = np.add.reduceat(logs, first[:-1])
                n_tokens[i:j] = np.diff(first)
                tail = np.flatnonzero(~known)
                doc = np.searchsorted(first, tail, "right") - 1
                n_rare[i:j] = np.bincount(doc, minlength=j - i)
                order = np.lexsort((tokens[tail], doc))
                h, doc = tokens[tail][order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                start = np.flatnonzero(new)
                hashes.append(h[start].view(np.int64))
                times.append(np.diff(np.append(start, len(h))))
                lengths[i:j] = np.bincount(doc[start], minlength=j - i)
                # classes, or side + the place among the text's rarer words
                code = m.of[ids]
                places = np.cumsum(new) - 1 - np.concatenate([[0], np.cumsum(lengths[i:j])])[doc]
                far = ids[tail[order]] == other
                code[tail[order][far]] = side + places[far]
                before = np.concatenate([[m.of[-1]], code[:-1]])
                before[first[:-1]] = m.of[-1]
                both = (code < side) & (before < side)
                value = m.emit[ids]
                value[both] += m.after[before[both], code[both]]
                own[i:j] = np.add.reduceat(value, first[:-1])
                open_ = np.flatnonzero(~both)
                lefts.append(before[open_].astype(np.int32))
                rights.append(code[open_].astype(np.int32))
                met[i:j] = np.bincount(np.searchsorted(first, open_, "right") - 1, minlength=j - i)
            base -= n_tokens * np.log10(m.tokens + m.types + 1.0)
            cuts = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            ends = pa.array(np.concatenate([[0], np.cumsum(met)]).astype(np.int32))
            empty, none = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            yield pa.record_batch(
                [pa.array(row + np.arange(batch.num_rows)), batch.column(0), pa.array(n_tokens), pa.array(n_rare),
                 pa.array(base), pa.array(own),
                 pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(hashes or empty))),
                 pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(times or empty))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lefts or none))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rights or none)))],
                ["row", "doc_id", "n_tokens", "n_rare", "base", "own", "h", "times", "lefts", "rights"])
            row += batch.num_rows

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        unseen, side = len(m.after) - 2, len(m.after)
        for batch in batches:
            n_tokens, n_rare, base, own = (batch.column(k).to_numpy().copy() for k in range(1, 5))
            times = batch.column(5)
            cuts = times.offsets.to_numpy() - times.offsets[0].as_py()
            times, doc = times.flatten().to_numpy(), np.repeat(np.arange(len(own)), np.diff(cuts))
            n, of = np.zeros(len(times), np.int64), np.full(len(times), unseen)
            found = batch.column(8)
            counted = np.diff(found.offsets.to_numpy())
            parts = found.flatten()
            at = np.repeat(cuts[:-1], np.where(found.is_valid().to_numpy(zero_copy_only=False), counted, 0)) \
                + parts.field(0).to_numpy()
            n[at], of[at] = parts.field(1).to_numpy(), parts.field(2).to_numpy()
            base += np.bincount(doc, times * np.log10(n + 1.0), len(own))
            logs = np.where((n > 0) & (of < unseen), np.log10(np.maximum(n, 1) / np.maximum(m.size[of], 1)), 0.0)
            own += np.bincount(doc, times * logs, len(own))
            lists = batch.column(6)
            row = np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))
            a, b = lists.flatten().to_numpy().astype(np.int64), batch.column(7).flatten().to_numpy().astype(np.int64)
            for code in (a, b):
                far = np.flatnonzero(code >= side)
                code[far] = of[cuts[row[far]] + code[far] - side]
            own += np.bincount(row, m.after[a, b], len(own))
            known = n_tokens - n_rare + np.bincount(doc, np.where(n > 0, times, 0), len(own)).astype(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(n_tokens), pa.array(known), pa.array(base), pa.array(own)],
                                  ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = ("row bigint, doc_id bigint, n_tokens bigint, n_rare bigint, base double, own double, "
              "h array<bigint>, times array<bigint>, lefts array<int>, rights array<int>")
    scored = stored(rows.mapInArrow(tidied(local), schema), "lm-scored")
    tail = scored.select("row", F.posexplode("h").alias("at", "h")).join(rare, "h") \
        .groupBy("row").agg(F.collect_list(F.struct("at", F.col("n").cast("bigint").alias("n"),
                                                    F.col("of").cast("int").alias("of"))).alias("found"))
    whole = scored.drop("h").join(tail, "row", "left").select(
        "doc_id", "n_tokens", "n_rare", "base", "own", "times", "lefts", "rights",
        F.coalesce("found", F.expr("cast(array() as array<struct<at:int,n:bigint,of:int>>)")).alias("found"))
    return whole.mapInArrow(tidied(finish), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double") \
        .select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
                "base_score", "score") \
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op9_class_ngram_score(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bounded_batches(spark)
    training = is_training("doc_id", 7, 2)
    model, rare = train(docs.filter(training).select(F.col("text").cast("string").alias("text")))
    return score(docs, model, rare).withColumn("held_out", ~training).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
