"""Operator 1: near-duplicate documents by min-max hashing.

A document is the set of its distinct 5-word shingles. Each of ``HASHES``
permutations is evaluated once per shingle and gives two signature values, the
minimum and the maximum, so 128 values take 64 evaluations. Bands of ``ROWS``
values propose candidates; links are confirmed on the full sets.

* Documents with equal sets are one class from the start (a grouping by a
  128-bit digest of the set); only class representatives are banded.
* In a bucket, all members are compared with one member (the leader), which
  joins most of a group of copies into one component. Of buckets that still hold
  two components or more, members leave that have too many shingles of their own
  to be linked with any other. What is left outside the largest component is
  compared with all others of its family of buckets, inside a join that gives
  the links alone. No pairs inside a component are looked at, no bucket is
  gathered in one task, and no possible link is dropped.
* No band holds the minimum and the maximum of one permutation, which depend on
  each other in small sets. A pair with i of u shingles in common is missed by
  all 32 bands with probability (1 - 2 J^4 + (J (i - 1) / (u - 1))^4)^16: with
  J = 0.75, 1.4e-6 for u = 4, 2.8e-6 for u = 8, and 5.2e-6 at most at any size.
* A key that many members share is dealt to parts, by its number of members, on
  both sides of every join on it.

Defined cases: without words, or with a null text, the set is empty and the
document is linked with nothing; with one to four words the whole sequence is
the one shingle. Rows that share an id are linked only by their texts: the nodes
are sets, not ids. A null id has no component (null) and is kept. An empty table gives no rows. Only
``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (
    blocks,
    bounded_batches,
    by_place,
    hinted,
    lower_ascii,
    mix64,
    stored,
    text_bytes,
    tidied,
    window_hashes,
    word_hashes,
)
from .components import add_edges

WORDS = 5
PERCENT = 75
HASHES = 64
ROWS = 4
#: Members on each side of one cell of a family's comparisons in the last step.
SIDE = 500
#: Members of a bucket in one part of a join on its key.
PART = 1000
_U = np.uint64


def multipliers(n: int) -> list[np.uint64]:
    """Odd numbers, each a permutation of the 64-bit shingle hashes by multiplication."""
    return [_U(int(x) | 1) for x in mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))]


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block, one after another, and where each begins."""
    h, first = word_hashes(lower_ascii(data), offs)
    w, at = window_hashes(h, first, words, short=True)
    parts, sizes = [], np.zeros(len(at) - 1, np.int64)
    for k in range(len(sizes)):
        own = np.sort(w[at[k]:at[k + 1]])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        parts.append(own)
        sizes[k] = len(own)
    return np.concatenate(parts) if parts else w, np.concatenate([[0], np.cumsum(sizes)])


def signatures(sets: np.ndarray, at: np.ndarray, perms: list[np.uint64]) -> np.ndarray:
    """Minimum and maximum of every non-empty set under each permutation: one row per set, all minima first."""
    starts = at[:-1][np.diff(at) > 0]
    out = np.zeros((len(starts), 2 * len(perms)), _U)
    if len(starts):
        moved = np.empty_like(sets)
        for k, a in enumerate(perms):
            np.multiply(sets, a, out=moved)
            out[:, k] = np.minimum.reduceat(moved, starts)
            out[:, len(perms) + k] = np.maximum.reduceat(moved, starts)
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature values."""
    bands = values.shape[1] // rows
    keys = np.zeros((len(values), bands), _U)
    for b in range(bands):
        key = np.full(len(values), b + 1, _U)
        for r in range(rows):
            key = mix64(key * _U(0xD6E8FEB86659FD93) + values[:, b * rows + r])
        keys[:, b] = key
    return keys


def set_digests(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every set; 0 for empty ones."""
    d1, d2 = np.zeros(len(at) - 1, _U), np.zeros(len(at) - 1, _U)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        d1[full] = np.add.reduceat(mix64(sets + _U(1)), at[full])
        d2[full] = np.add.reduceat(mix64(sets ^ _U(0x5555555555555555)), at[full])
    return d1, d2


def document_signatures(docs: DataFrame, words: int = WORDS, hashes: int = HASHES, rows: int = ROWS,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, d1, d2, bands) of every row: size and digest of its set, and its band keys, stored."""
    bounded_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = multipliers(hashes)
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            n = np.zeros(batch.num_rows, np.int64)
            d1, d2 = np.zeros(batch.num_rows, _U), np.zeros(batch.num_rows, _U)
            keys = []
            for i, j, d, o in blocks(data, offs):
                sets, at = shingle_sets(d, o, words)
                n[i:j] = np.diff(at)
                d1[i:j], d2[i:j] = set_digests(sets, at)
                keys.append(band_keys(signatures(sets, at, perms), rows))
            flat = np.concatenate(keys) if keys else np.zeros((0, 2 * hashes // rows), _U)
            cuts = np.concatenate([[0], np.cumsum((n > 0) * flat.shape[1])]).astype(np.int32)
            yield pa.record_batch(
                [batch.column(0), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat.reshape(-1).view(np.int64)))],
                ["doc_id", "n", "d1", "d2", "bands"])

    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(out.mapInArrow(tidied(sign), "doc_id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>"),
                  "dup-signatures")


def _full_sets(docs: DataFrame, classes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles) of the ``classes`` (rep, first, d1, d2): their whole sets as sorted 64-bit numbers, stored. A class
    is read from the rows of its first id; those with another text of that id fall out by the digest."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(3))
            d1, d2 = (batch.column(k).to_numpy().view(_U) for k in (1, 2))
            for i, j, d, o in blocks(data, offs):
                sets, at = shingle_sets(d, o, words)
                e1, e2 = set_digests(sets, at)
                same = (d1[i:j] == e1) & (d2[i:j] == e2)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.record_batch([batch.column(0).slice(i, j - i), lists], ["id", "shingles"]).filter(pa.array(same))

    rows = docs.select(F.col(id_col).cast("bigint").alias("first"), F.col(text_col).cast("string").alias("text"))
    wanted = hinted(classes.select("rep", "first", "d1", "d2").distinct())
    return stored(rows.join(wanted, "first").select("rep", "d1", "d2", "text")
                  .mapInArrow(tidied(gather), "id bigint, shingles array<bigint>"), "dup-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough, stored."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            (xs, xo), (ys, yo) = ((c.values.to_numpy().view(_U), c.offsets.to_numpy()) for c in batch.columns[2:])
            for k in range(batch.num_rows):
                x, y = xs[xo[k]:xo[k + 1]], ys[yo[k]:yo[k + 1]]
                if len(x) > len(y):
                    x, y = y, x
                if len(x) and 100 * len(x) >= percent * len(y):
                    both = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
                    keep[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    sa = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
    return stored(both.mapInArrow(tidied(compare), "a bigint, b bigint").distinct(), "dup-links")


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of (rep, n) and (other, other_n) whose sizes allow a link."""
    sized = 100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n")
    return rows.filter((F.col("rep") != F.col("other")) & sized) \
        .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _on_key(left: DataFrame, right: DataFrame, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` (key, rep, ...) joined with ``right``, one row a key. The keys of ``hot`` (key, parts) are dealt to parts."""
    parts = F.coalesce("parts", F.lit(1))
    dealt = left.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int")).drop("parts")
    copies = right.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copies, ["key", "part"], how).drop("part")


def _unsettled(held: DataFrame, hot: DataFrame) -> DataFrame:
    """The members of buckets that hold two components or more, stored."""
    held = stored(held, "dup-held")
    keys = held.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")) \
        .filter("x < y").select("key")
    return stored(_on_key(held, keys, hot, "left_semi"), "dup-open")


def _supported(held: DataFrame, sets: DataFrame, percent: int, hot: DataFrame) -> DataFrame:
    """``held`` without the members that can have no link in their bucket: a link to a set of ``m`` shingles takes
    ``percent / (100 + percent) * (n + m)`` common ones, and those of a member that no other member of any bucket
    has are common to none. Exact, and one count of shingles, however many members a bucket has."""
    reps = hinted(held.select(F.col("rep").alias("id")).distinct())
    own = sets.join(reps, "id", "left_semi").select(F.col("id").alias("rep"), F.explode("shingles").alias("h")) \
        .groupBy("h").agg(F.min("rep").alias("rep"), F.max("rep").alias("last")).filter("rep = last") \
        .groupBy("rep").agg(F.count("*").alias("own"))
    least = held.groupBy("key").agg(F.min("n").alias("least"))
    partner = F.greatest("least", F.ceil(F.col("n") * F.lit(percent) / 100))
    can = (100 + percent) * (F.col("n") - F.coalesce("own", F.lit(0))) >= percent * (F.col("n") + partner)
    return _on_key(held.join(own, "rep", "left"), least, hot).filter(can) \
        .select("key", "rep", "n", "component", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"))


def _links_across(held: DataFrame, sets: DataFrame, percent: int, hot: DataFrame) -> DataFrame:
    """All links (a, b) between different components of buckets that share members, stored.

    Buckets that share members are one family, so that no pair is looked at once per bucket. Of each family the
    members outside its largest component meet the others; the join's own condition compares the full sets, so only
    links are made. A large family is dealt to a grid of cells with about ``SIDE`` members on each side."""
    first = held.groupBy("key").agg(F.min("rep").alias("a"))
    spokes = _on_key(held.select("key", "rep"), first, hot).withColumnRenamed("rep", "b").filter("a < b") \
        .select("a", "b").distinct()
    family = add_edges(spokes).select(F.col("node").alias("rep"), F.col("label").alias("family"))
    members = stored(held.select("rep", "n", "component", "shared").distinct().join(family, "rep"), "dup-family")
    by_component = members.groupBy("family", "component").agg(F.count("*").alias("size"))
    largest = by_component.groupBy("family").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"),
        F.ceil(F.sum("size") / SIDE).cast("int").alias("q_parts"),
        F.greatest(F.ceil((F.sum("size") - F.max("size")) / SIDE), F.lit(1)).cast("int").alias("p_parts"))
    full = members.join(largest, "family").join(sets.withColumnRenamed("id", "rep"), "rep")
    share = F.xxhash64("rep")
    left = full.filter("component != largest").select(
        "family", F.pmod(share, "p_parts").cast("int").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q"), "rep", "n", "component", "shared", "shingles")
    right = full.select(
        "family", F.explode(F.sequence(F.lit(0), F.col("p_parts") - 1)).alias("p"),
        F.pmod(share, "q_parts").cast("int").alias("q"), F.col("rep").alias("rep2"), F.col("n").alias("n2"),
        F.col("component").alias("component2"), F.col("shared").alias("shared2"), F.col("shingles").alias("shingles2"))
    needed = percent * (F.col("n") + F.col("n2"))
    alike = (F.col("component") != F.col("component2")) \
        & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) \
        & ((100 + percent) * F.least("shared", "shared2") >= needed) \
        & ((100 + percent) * F.size(F.array_intersect("shingles", "shingles2")) >= needed)
    same = (left["family"] == right["family"]) & (left["p"] == right["p"]) & (left["q"] == right["q"])
    found = left.join(right, same & alike) \
        .select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b"))
    return stored(found.distinct(), "dup-links")


def _components(docs: DataFrame, reps: DataFrame, words: int, percent: int, id_col: str,
                text_col: str) -> DataFrame | None:
    """(node, label) of the classes (rep, first, n, d1, d2, bands) that are linked; null if none can be."""
    banded = reps.select("rep", "n", F.explode("bands").alias("key"))
    shared = stored(banded.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("first"), F.max("rep").alias("last"),
                                              F.count("*").alias("size")).filter("first.rep < last"), "dup-shared")
    hot = hinted(shared.filter(F.col("size") > PART).select("key", F.ceil(F.col("size") / PART).cast("int").alias("parts")))
    leaders = shared.select("key", F.col("first.rep").alias("other"), F.col("first.n").alias("other_n"))
    members = stored(_on_key(banded, leaders, hot), "dup-buckets")
    pairs = stored(_pairs(members, percent), "dup-pairs")
    if pairs.isEmpty():
        return None
    classes = reps.join(hinted(members.select("rep").distinct()), "rep", "left_semi")
    sets = _full_sets(docs, classes, words, id_col, text_col)
    labels = add_edges(_confirmed(pairs, sets, percent))
    held = members.filter("rep != other").select("key", "rep", "n") \
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("key", "rep", "n", F.coalesce("label", "rep").alias("component"))
    held = _unsettled(_supported(_unsettled(held, hot), sets, percent, hot), hot)
    if not held.isEmpty():
        links = _links_across(held, sets, percent, hot)
        if not links.isEmpty():
            labels = add_edges(links, labels)
    return labels


def _classified(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES, rows: int = ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, d1, d2) of every row, and (n, d1, d2, rep, first, component, chosen) of every distinct set: its smallest
    id, its component's smallest id, and whether it is the one of its component that holds that id."""
    signed = document_signatures(docs, words, hashes, rows, id_col, text_col)
    usable = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(usable.groupBy("n", "d1", "d2").agg(F.min(F.struct("doc_id", "bands")).alias("m"))
                     .select("n", "d1", "d2", F.monotonically_increasing_id().alias("rep"),
                             F.col("m.doc_id").alias("first"), F.col("m.bands").alias("bands")), "dup-classes")
    labels = _components(docs, classes, words, percent, id_col, text_col)
    classes = classes.drop("bands")
    if labels is None:
        return signed, classes.withColumn("component", F.col("first")).withColumn("chosen", F.lit(True))
    linked = classes.join(labels.withColumnRenamed("node", "rep"), "rep")
    heads = linked.groupBy("label").agg(F.min(F.struct("first", "rep")).alias("head"))
    of = linked.join(heads, "label").select("rep", F.col("head.first").alias("component"),
                                            (F.col("rep") == F.col("head.rep")).alias("chosen"))
    return signed, classes.join(of, "rep", "left").withColumn("component", F.coalesce("component", "first")) \
        .withColumn("chosen", F.coalesce("chosen", F.lit(True)))


def _verdicts(signed: DataFrame, classes: DataFrame) -> DataFrame:
    found = signed.filter("n > 0 AND doc_id IS NOT NULL").join(classes, ["n", "d1", "d2"]) \
        .select("doc_id", "n", "component")
    alone = signed.filter("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component"))
    return found.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES,
                    rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return _verdicts(*_classified(docs, words, percent, hashes, rows, id_col, text_col))


def _with_digests(rows: DataFrame, text_col: str, words: int) -> DataFrame:
    """``rows`` (columns by place) with ``n``, ``d1`` and ``d2`` of their sets."""
    at = rows.columns.index(text_col)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            d1, d2 = np.zeros(batch.num_rows, _U), np.zeros(batch.num_rows, _U)
            for i, j, d, o in blocks(*text_bytes(batch.column(at))):
                sets, cuts = shingle_sets(d, o, words)
                n[i:j] = np.diff(cuts)
                d1[i:j], d2[i:j] = set_digests(sets, cuts)
            more = [pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))]
            yield pa.record_batch([*batch.columns, *more], [*batch.schema.names, "n", "d1", "d2"])

    schema = T.StructType(rows.schema.fields + [T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")])
    return rows.mapInArrow(tidied(sign), schema)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                **options) -> DataFrame:
    """One row of each group of near-duplicates (one with the smallest id), same columns. Rows without an id, and rows
    without words, stay. Rows that share an id are told apart by their sets, repeated rows are one."""
    signed, classes = _classified(docs, words=words, id_col=id_col, text_col=text_col, **options)
    found = stored(_verdicts(signed, classes), "dup-verdicts")
    own = by_place(docs)
    doc_id, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    key = own[doc_id].cast("bigint")
    gone = hinted(found.filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct())
    often = stored(signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
                   .select(F.col("doc_id").alias("__often")), "dup-often")
    if often.isEmpty():
        return own.join(gone, key == gone["__gone"], "left_anti").toDF(*docs.columns)
    often = hinted(often)
    once = own.join(often, key == often["__often"], "left_anti")
    once = once.join(gone, once[doc_id].cast("bigint") == gone["__gone"], "left_anti")
    bounded_batches(docs.sparkSession)
    more = _with_digests(own.join(often, key == often["__often"], "left_semi"), text, words)
    heads = classes.filter("chosen AND first = component").select("n", "d1", "d2", F.col("first").alias("__first"))
    kept = more.filter("n > 0").join(heads, ["n", "d1", "d2"]).filter(F.col(doc_id).cast("bigint") == F.col("__first")) \
        .withColumn("__id", F.col(doc_id).cast("bigint")).dropDuplicates(["__id", "n", "d1", "d2"])
    return once.unionByName(kept.select(*own.columns)).unionByName(more.filter("n = 0").select(*own.columns)) \
        .toDF(*docs.columns)


def op1_minmax_near_dup(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
