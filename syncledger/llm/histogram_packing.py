"""Operator 11: packing by non-negative least squares over the histogram of lengths.

Documents become token ids and an end id, cut into full windows and a rest. All
pieces of one length are alike, so the packing is planned on the histogram of
lengths alone, at most ``WINDOW`` numbers on the driver:

1. enumerate the combinations of two or three lengths that fill a window exactly;
2. solve for repeat counts >= 0 whose pieces come nearest to the histogram in
   least squares, by coordinate descent;
3. round the counts and clip them to the pieces there are;
4. pack what is left greedily: the longest piece, then always the longest that
   fits, and where nothing fits a piece is cut to fill the window. The last
   tokens, less than a window, go to sequences of powers of two.

So every sequence is a full window or has a power of two of tokens, and only
what the combinations leave over is cut. A piece is known by its length and its
rank among the pieces of that length (counts by partition and length, summed
over partitions); the plan maps ranges of ranks to places. Texts never move:
only the token ids of pieces that are cut are read again.

Defined cases: a null or empty text is the end id alone; an id may be null or
repeat, every row is packed for itself; an empty table gives no rows. Only the
id and text columns are read.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, bounded_batches, hinted, lower_ascii, stored, text_bytes, tidied, worker_state
from .pieces import NUMBER, SPACE, PieceCache, default_vocabulary, latin_classes, ship_vocabulary

WINDOW = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Sweeps of the coordinate descent, and the relative gain below which it ends.
SWEEPS = 12
GAIN = 1e-3
CACHE_BITS = 20
#: Ids kept per worker for words seen before; the table starts anew beyond it.
POOL = 8_000_000
#: Bytes of a text that the tokenizer library takes at once.
CHUNK = 1 << 18
RANK_BITS = 42


# ------------------------------------------------------------- token ids

class WordIds:
    """Token ids of whole texts by the tokenizer library, which is asked once for a word."""

    def __init__(self, raw: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.cache = PieceCache(CACHE_BITS, self.compute)

    def compute(self, words: list[bytes]) -> list[int]:
        out = []
        for e in self.tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False):
            ids = e.ids
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
            self.pool[self.used:self.used + len(ids)] = ids
            out.append(self.used << 32 | len(ids))
            self.used += len(ids)
        return out

    def of_words(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, and where each text's begin (n + 1 values)."""
        if self.used > POOL:
            self.clear()
        data = lower_ascii(data)
        s, e = plain_words(data, offs)
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        found = self.cache.lookup(data, s, e)
        begins = np.concatenate([[0], np.cumsum(found & 0xFFFFFFFF)]).astype(np.int64)
        shift = np.repeat((found >> 32) - begins[:-1], np.diff(begins))
        shift += np.arange(begins[-1])
        return self.pool[shift], begins[np.searchsorted(s, offs)]

    def of_text(self, raw: bytes) -> np.ndarray:
        """Ids of any text."""
        out = [self.tokenizer.encode(part.decode(), add_special_tokens=False).ids for part in safe_chunks(raw)]
        return np.array([i for ids in out for i in ids], np.uint32)

    def of_block(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, and where each text's begin (n + 1 values)."""
        raw = data.tobytes()
        # beyond ASCII and Latin letters, and for the one letter that becomes two when lowered: the library
        odd_at = (data == 0xC2) | (data >= 0xCA)
        odd_at[1:] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)
        odd = np.zeros(len(offs) - 1, bool)
        odd[np.searchsorted(offs, np.flatnonzero(odd_at), "right") - 1] = True
        for token in self.special:
            if token in raw:
                odd |= [token in raw[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)]
        if not odd.any():
            return self.of_words(data, offs)
        cuts = [0, *(np.flatnonzero(np.diff(odd)) + 1).tolist(), len(odd)]
        ids, counts = [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if odd[a]:
                for k in range(a, b):
                    ids.append(self.of_text(raw[offs[k]:offs[k + 1]]))
                    counts.append([len(ids[-1])])
            else:
                some, begins = self.of_words(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                ids.append(some)
                counts.append(np.diff(begins))
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


def plain_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words that the vocabulary's pattern finds in lowered texts of ASCII and Latin letters:
    runs of letters, single digits, runs of other characters, and a contraction's apostrophe with its letters."""
    n = len(data)
    kind = latin_classes(data)
    begin = np.ones(n + 1, bool)
    begin[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    begin[offs] = True
    edge = np.zeros(n + 3, bool)
    edge[offs] = True
    quote = np.flatnonzero((data == 0x27) & begin[:-1] & begin[1:] & ~edge[1:n + 1])
    if len(quote):
        quote = quote[quote + 1 < n]
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        c1, c2 = padded[quote + 1], np.where(edge[quote + 2], 0, padded[quote + 2])
        one = np.isin(c1, np.frombuffer(b"stmd", np.uint8))
        two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) \
            | ((c1 == ord("l")) & (c2 == ord("l")))
        begin[quote[one | two] + 1] = False
        begin[quote[one] + 2] = True
        begin[quote[two] + 3] = True
    s = np.flatnonzero(begin[:n])
    e = np.append(s[1:], n)
    word = kind[s] != SPACE
    return s[word], e[word]


def safe_chunks(raw: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """Parts of a text that have the ids of the whole: cut at a blank between ASCII letters or digits."""
    a = 0
    while len(raw) - a > size:
        b = a + size
        while b < len(raw) and not (raw[b] == 0x20 and raw[b - 1:b].isalnum() and raw[b + 1:b + 2].isalnum()):
            b += 1
        yield raw[a:b]
        a = b
    yield raw[a:]


PIECE = "part int, row bigint, doc_id bigint, start bigint, length int, nth bigint, doc_tokens bigint, " \
        "ids_crc32 bigint, ids array<int>"


def window_pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocab_path: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text", all_ids: bool = False) -> DataFrame:
    """Full windows and the rest of every document, stored. ``row`` tells rows with one id apart, ``nth`` counts the
    pieces of a length in a partition. Ids are kept for pieces shorter than a window, or for all."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = ship_vocabulary(spark, vocab_path or default_vocabulary(VOCABULARY))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shipped.value
        words = worker_state(f"word_ids_{zlib.crc32(raw):08x}", lambda: WordIds(raw))
        part = TaskContext.get().partitionId()
        row, seen = part << 33, np.zeros(window + 1, np.int64)
        for batch in batches:
            keys = batch.column(0)
            for i, j, d, o in blocks(*text_bytes(batch.column(1))):
                ids, begins = words.of_block(d, o)
                ids = np.insert(ids, begins[1:], end_id)
                begins = begins + np.arange(len(begins))
                sizes = np.diff(begins)
                pieces = -(-sizes // window)
                owner = np.repeat(np.arange(j - i), pieces)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * window
                length = np.minimum(sizes[owner] - start, window)
                first = begins[owner] + start
                view = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
                kept = np.full(len(owner), True) if all_ids else length < window
                bounds = np.concatenate([[0], np.cumsum(np.where(kept, length, 0))])
                flat = ids if kept.all() else ids[np.repeat(kept, length)]
                yield pa.record_batch(
                    [pa.array(np.full(len(owner), part, np.int32)), pa.array(row + owner), keys.take(pa.array(i + owner)),
                     pa.array(start), pa.array(length.astype(np.int32)), pa.array(_running(length, seen)),
                     pa.array(sizes[owner]), pa.array(crc, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32)))],
                    ["part", "row", "doc_id", "start", "length", "nth", "doc_tokens", "ids_crc32", "ids"])
                row += j - i

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(tidied(cut), PIECE), "window-pieces")


def _running(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each piece, how many of its length came before it in the partition; ``seen`` is brought up to date."""
    order = np.argsort(length, kind="stable")
    sorted_lengths = length[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_lengths[1:] != sorted_lengths[:-1]]))
    counts = np.diff(np.append(heads, len(length)))
    out = np.empty(len(length), np.int64)
    out[order] = np.arange(len(length)) - np.repeat(heads, counts) + seen[sorted_lengths]
    seen[sorted_lengths[heads]] += counts
    return out


# ------------------------------------------------------------ the plan

def combinations(present: np.ndarray) -> np.ndarray:
    """All (a, b, c), a <= b <= c, of present lengths with the sum of the window (a = 0: pairs). ``present``: by
    length, up to the window."""
    window = len(present) - 1
    out = []
    for a in range(window // 3 + 1):
        if a and not present[a]:
            continue
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        c = window - a - b
        b = b[present[b] & present[c]]
        out.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(out)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Counts >= 0 that bring the pieces of the combinations nearest to the histogram in least squares, by coordinate
    descent from 0. (A length that occurs twice in a combination weighs twice.)"""
    rest = histogram.astype(float).tolist()
    rest[0] = 0.0
    counts = [0.0] * len(combos)
    rows = [(j, a, b, c) for j, (a, b, c) in enumerate(combos.tolist())]
    # squared norm of a column by its pattern: pairs 2 (equal 4); triples 3, 5 with two equal, 9 with three
    error = sum(r * r for r in rest)
    for _ in range(sweeps):
        for j, a, b, c in rows:
            x = counts[j]
            gain = rest[a] + rest[b] + rest[c]
            if a:
                norm = 3 if a != b and b != c else 9 if a == c else 5
            else:
                norm = 2 if b != c else 4
            new = x + gain / norm
            if new < 0.0:
                new = 0.0
            if new != x:
                step = new - x
                counts[j] = new
                if a:
                    rest[a] -= step
                rest[b] -= step
                rest[c] -= step
        now = sum(r * r for r in rest)
        if error - now <= GAIN * error:
            break
        error = now
    return np.array(counts)


class Plan:
    """Places for all pieces, as ranges: the pieces of a length with ranks from ``rank`` on, ``count`` of them, give
    ``part_length`` tokens from ``part_start`` on. ``per`` of them in a row lie in each of the sequences from
    ``sequence`` on, the first ``skip`` of them in an earlier range, one after another from ``offset`` on. A piece that
    is cut is in one range of every generation."""

    FIELDS = ("generation", "length", "rank", "count", "part_start", "part_length", "skip", "per", "sequence", "offset")

    def __init__(self, histogram: np.ndarray):
        self.window = len(histogram) - 1
        self.entries: list[tuple] = []
        self.sequences = 0
        #: pieces by the length that is left of them: (generation, first length, rank, count, start)
        self.pool: dict[int, list[tuple]] = defaultdict(list)
        self.count = [int(x) for x in histogram]
        for length, n in enumerate(self.count):
            if n:
                self.pool[length].append((0, length, 0, n, 0))

    def place(self, parts: list[tuple[int, int, int]], times: int) -> None:
        """``times`` sequences of (length of the pieces, pieces in each, tokens taken of each). What is not taken of a
        piece goes back."""
        offset = 0
        for length, per, taken in parts:
            need, done, runs = per * times, 0, self.pool[length]
            self.count[length] -= need
            while done < need:
                generation, first, rank, n, start = runs.pop()
                use = min(n, need - done)
                if use < n:
                    runs.append((generation, first, rank + use, n - use, start))
                self.entries.append((generation, first, rank, use, start, taken, done, per, self.sequences, offset))
                if taken < length:
                    self.pool[length - taken].append((generation + 1, first, rank, use, start + taken))
                    self.count[length - taken] += use
                done += use
            offset += per * taken
        self.sequences += times

    def fill(self, combos: np.ndarray, counts: np.ndarray) -> None:
        """The combinations as often as rounded, the most frequent first, as far as there are pieces."""
        counts = np.rint(counts).astype(np.int64)
        some = np.flatnonzero(counts)
        for j in some[np.argsort(-counts[some], kind="stable")].tolist():
            need: dict[int, int] = {}
            for length in combos[j].tolist():
                if length:
                    need[length] = need.get(length, 0) + 1
            times = min([int(counts[j]), *[self.count[x] // m for x, m in need.items()]])
            if times:
                self.place([(x, m, x) for x, m in need.items()], times)

    def greedy(self) -> None:
        """All that is left: longest first, cut where nothing fits."""
        left = sum(x * n for x, n in enumerate(self.count))
        have = sum(1 << x for x, n in enumerate(self.count) if n)
        while left >= self.window:
            used: dict[int, int] = {}
            parts, gap, free = [], self.window, have
            while gap:
                fits = free & ((2 << gap) - 1)
                if fits:
                    length = fits.bit_length() - 1
                    per = min(gap // length, self.count[length])
                    parts.append((length, per, length))
                    gap -= per * length
                else:
                    length, per = free.bit_length() - 1, 1
                    parts.append((length, 1, gap))
                    gap = 0
                used[length] = used.get(length, 0) + per
                if used[length] >= self.count[length]:
                    free &= ~(1 << length)
            times = min(self.count[x] // m for x, m in used.items())
            self.place(parts, times)
            left -= times * self.window
            for length, _, taken in parts:
                for x in {length, length - taken} - {0}:
                    have = have | 1 << x if self.count[x] else have & ~(1 << x)
        self.last(left)

    def last(self, left: int) -> None:
        """Less than a window: sequences of powers of two."""
        for bit in range(left.bit_length() - 1, -1, -1):
            gap, parts = left & 1 << bit, []
            while gap:
                length = max(x for x, n in enumerate(self.count) if n and x)
                taken = min(length, gap)
                # one piece at a time: there are less than a window's
                self._part(length, taken, (1 << bit) - gap)
                gap -= taken
                parts.append(taken)
            if parts:
                self.sequences += 1

    def _part(self, length: int, taken: int, offset: int) -> None:
        generation, first, rank, n, start = self.pool[length].pop()
        if n > 1:
            self.pool[length].append((generation, first, rank + 1, n - 1, start))
        self.count[length] -= 1
        self.entries.append((generation, first, rank, 1, start, taken, 0, 1, self.sequences, offset))
        if taken < length:
            self.pool[length - taken].append((generation + 1, first, rank, 1, start + taken))
            self.count[length - taken] += 1

    def ranges(self) -> list[np.ndarray]:
        """The ranges by generation, each sorted by length and rank."""
        table = np.array(self.entries, np.int64).reshape(-1, len(self.FIELDS))
        out = []
        for generation in range(int(table[:, 0].max()) + 1 if len(table) else 0):
            own = table[table[:, 0] == generation]
            out.append(own[np.lexsort((own[:, 2], own[:, 1]))])
        return out


def plan_windows(histogram: np.ndarray) -> Plan:
    """The whole plan for a histogram of lengths (0 to the window)."""
    plan = Plan(histogram)
    window = plan.window
    if histogram[window]:
        plan.place([(window, 1, window)], int(histogram[window]))
    rest = histogram.copy()
    rest[[0, window]] = 0
    combos = combinations(rest > 0)
    if len(combos):
        plan.fill(combos, repeat_counts(combos, rest))
    plan.greedy()
    return plan


# ------------------------------------------------------------ the placement

PLACED = "row bigint, doc_id bigint, piece_start bigint, start bigint, length bigint, ids_crc32 bigint, " \
         "doc_tokens bigint, sequence_id bigint, offset bigint, whole boolean"


def place_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every part of every piece and its place: PLACED, with crcs of the parts."""
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "window-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                   "window-bases")
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row for a length
        histogram[r["length"]] = r["n"]
    held = spark.sparkContext.broadcast(plan_windows(histogram).ranges())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generations = held.value
        keyed = [(g, (g[:, 1] << RANK_BITS) + g[:, 2]) for g in generations]
        for batch in batches:
            row, doc, start, length, crc, tokens, rank = (batch.column(k) for k in range(7))
            begin, size = start.to_numpy(), length.to_numpy().astype(np.int64)
            key, number = (size << RANK_BITS) + rank.to_numpy(), rank.to_numpy()
            for table, starts in keyed:
                at = np.searchsorted(starts, key, "right") - 1
                hit = np.flatnonzero((at >= 0) & (key < starts[at] + table[at, 3]))
                if not len(hit):
                    continue
                own = table[at[hit]]
                n = number[hit] - own[:, 2] + own[:, 6]  # place among the pieces of this part of the pattern
                sequence, slot = own[:, 8] + n // own[:, 7], n % own[:, 7]
                some = pa.array(hit)
                yield pa.record_batch(
                    [row.take(some), doc.take(some), start.take(some), pa.array(begin[hit] + own[:, 4]),
                     pa.array(own[:, 5]), crc.take(some), tokens.take(some), pa.array(sequence),
                     pa.array(own[:, 9] + slot * own[:, 5]), pa.array(own[:, 5] == size[hit])],
                    [c.split(" ")[0] for c in PLACED.split(", ")])

    ranked = pieces.drop("ids").join(hinted(bases), ["part", "length"]) \
        .select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("rank"))
    placed = stored(ranked.mapInArrow(tidied(place), PLACED), "window-placed")

    parts = placed.filter("NOT whole")
    cut_rows = hinted(stored(parts.select("row", F.col("piece_start").alias("start")).distinct(), "window-cut"))
    ids = pieces.select("row", "start", "ids").join(cut_rows, ["row", "start"], "left_semi") \
        .withColumnRenamed("start", "piece_start")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: k for k, name in enumerate(batch.schema.names)}
            base, start, length = (batch.column(at[c]).to_pylist() for c in ("piece_start", "start", "length"))
            own = batch.column(at["ids"])
            crc = []
            for k in range(batch.num_rows):
                a = start[k] - base[k]
                crc.append(zlib.crc32(own[k].values.to_numpy()[a:a + length[k]].astype("<u4").tobytes()))
            columns = [pa.array(crc, pa.int64()) if c == "ids_crc32" else batch.column(at[c]) for c in names]
            yield pa.record_batch(columns, names)

    names = placed.columns
    mended = parts.join(ids, ["row", "piece_start"]).mapInArrow(tidied(digest), PLACED)
    return placed.filter("whole").unionByName(mended)


def pack_documents(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """(sequence_id, length, ids, doc_ids): the sequences themselves."""
    pieces = window_pieces(docs, window, all_ids=True, **options)
    placed = place_pieces(pieces, window)
    rows = placed.join(pieces.select("row", F.col("start").alias("piece_start"), "ids"), ["row", "piece_start"])
    own = F.slice("ids", (F.col("start") - F.col("piece_start") + 1).cast("int"), F.col("length").cast("int"))
    return rows.select("sequence_id", "offset", "doc_id", "length", own.alias("ids")).groupBy("sequence_id") \
        .agg(F.sum("length").alias("length"),
             F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")) \
        .select("sequence_id", "length", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def op11_pack_by_histogram(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    pieces = window_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return place_pieces(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
