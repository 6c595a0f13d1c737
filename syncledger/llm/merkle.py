"""Operator 13: a Merkle manifest of a dataset, and proofs by descent from the root.

Every document is a leaf. The leaves of a tree (a language), in order, are
joined two by two into nodes until one is left; the subroots, in the order of
their trees, likewise give the root. The manifest is content-addressed: a node
is stored as *digest -> children*, and the digest is the hash of the children's
text. ``DIGITS`` levels of a tree are one *segment*, a row with the records of
its nodes, so that no task holds more than ``2**DIGITS`` leaves of a tree and a
tree of n leaves takes log(n) / DIGITS rounds.

A proof starts at the root: the digits of a leaf's rank choose the child at
every node, the children not chosen are collected, and the segments of the path
are put in reverse. Requests for leaves below one segment travel together, so
the root's record is read once and not once a leaf.

Defined cases: a null value is written ``-`` and an empty one ``0:``; a null
language is a tree of its own, before all others; equal ids (and null ones,
which come first) are ordered by the leaf's digest, and repeated rows are
leaves of their own; one leaf is its own subroot and one subroot the root, both
with an empty proof; an empty table has no root and no rows. Only the columns
named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import group_row_number
from .common import bounded_batches, stored, tidied

#: Levels of a tree in one segment.
DIGITS = 8
WIDTH = 1 << DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64

SEGMENT = "tree string, seg bigint, digest string, height int, nodes array<string>, children array<string>"
REQUEST = "tree string, seg bigint, digest string, siblings array<string>, sides string, subroot string"


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """The hash of the values, each with its UTF-8 length in front."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def tree_key(lang: Column) -> Column:
    """A key that is never null and sorts as the languages do, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


@dataclass
class Manifest:
    """``leaves`` (tree, rank, leaf, ...), the segments of every round from the leaves up, and the subroots."""
    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    top_rounds: list[DataFrame]
    root: str | None


def segment(entries: list[str], lone: bool) -> tuple[str, int, dict[str, str]]:
    """The digest of a run of nodes, its height, and the records digest -> children. A ``lone`` segment is a whole
    tree and ends at one node; any other ends at DIGITS levels."""
    height, level, records = 0, entries, {}
    while len(level) > 1 if lone else height < DIGITS:
        texts = [level[i] + (level[i + 1] if i + 1 < len(level) else "") for i in range(0, len(level), 2)]
        level = [digest(t) for t in texts]
        records.update(zip(level, texts, strict=True))
        height += 1
    return level[0], height, records


def _segments(rows: DataFrame, name: str) -> DataFrame:
    """One round: ``rows`` (tree, rank, digest) in runs of WIDTH."""
    runs = rows.groupBy("tree", F.shiftright("rank", DIGITS).alias("seg")) \
        .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run")) \
        .select("tree", "seg", F.col("run.digest").alias("entries"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                # ranks leave no gap: a first run that is not full is all there is of its tree
                lone = row["seg"] == 0 and len(row["entries"]) < WIDTH
                top, height, records = segment(row["entries"], lone)
                out.append({"tree": row["tree"], "seg": row["seg"], "digest": top, "height": height,
                            "nodes": list(records), "children": list(records.values())})
            yield _batch(out, _SEGMENT)

    return stored(runs.mapInArrow(tidied(fold), SEGMENT), name)


_SEGMENT = pa.schema([("tree", pa.string()), ("seg", pa.int64()), ("digest", pa.string()), ("height", pa.int32()),
                      ("nodes", pa.list_(pa.string())), ("children", pa.list_(pa.string()))])
_REQUEST = pa.schema([("tree", pa.string()), ("seg", pa.int64()), ("digest", pa.string()),
                      ("siblings", pa.list_(pa.string())), ("sides", pa.string()), ("subroot", pa.string())])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _rounds(rows: DataFrame, name: str) -> list[DataFrame]:
    """Segments of ``rows`` (tree, rank, digest), round by round until every tree has one."""
    out = []
    while True:
        out.append(_segments(rows, f"{name}-{len(out)}"))
        rows = out[-1].select("tree", F.col("seg").alias("rank"), "digest")
        if rows.filter("rank > 0").isEmpty():
            return out


def build(leaves: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``leaves`` (tree, leaf and any others), in the order of the columns ``order`` and then of the
    leaves' digests."""
    bounded_batches(leaves.sparkSession)
    ranked = group_row_number(leaves, ["tree"], [*order, "leaf"], out="rank").withColumn("rank", F.col("rank") - 1)
    ranked = stored(ranked, "merkle-leaves")
    rounds = _rounds(ranked.select("tree", "rank", F.col("leaf").alias("digest")), "merkle-tree")
    subroots = rounds[-1].select(F.col("tree").alias("name"), "digest")
    subroots = stored(group_row_number(subroots, [], ["name"], out="rank").withColumn("rank", F.col("rank") - 1),
                      "merkle-subroots")
    top = _rounds(subroots.select(F.lit("").alias("tree"), "rank", "digest"), "merkle-top")
    root = top[-1].first()
    return Manifest(ranked, rounds, subroots, top, root["digest"] if root else None)


def descend(node: str, height: int, rank: int, records: dict[str, str]) -> tuple[str, list[str], str]:
    """The node that the ``height`` low digits of ``rank`` lead to, and the children left out with their sides
    (l, r, or - for none), from the node found upwards."""
    siblings, sides = [], []
    for level in range(height - 1, -1, -1):
        children = records[node]
        if rank >> level & 1:
            node, other, side = children[HEX:], children[:HEX], "l"
        else:
            node, other, side = children[:HEX], children[HEX:], "r" if len(children) > HEX else "-"
        siblings.append(other)
        sides.append(side)
    return node, siblings[::-1], "".join(sides[::-1])


def fold(leaf: str, siblings: list[str], sides: str, known: dict[str, str]) -> str:
    """The root that a leaf and its siblings give. ``known``: hashes of the same segment's other leaves."""
    for other, side in zip(siblings, sides, strict=True):
        text = other + leaf if side == "l" else leaf + other
        leaf = known.get(text) or known.setdefault(text, digest(text))
    return leaf


def _asked(requests: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requests with their segment's records, found by digest, and what is wanted below."""
    store = records.filter("height > 0").select("digest", "height", "nodes", "children").dropDuplicates(["digest"])
    return requests.join(wanted, ["tree", "seg"]).join(store, "digest", "left")


def _down(requests: DataFrame, records: DataFrame, children: DataFrame, below: bool) -> DataFrame:
    """One round down: a request for each of ``children`` (tree, rank, name). ``below``: from the top tree into the
    trees, whose names the children have."""
    wanted = children.groupBy("tree", F.shiftright("rank", DIGITS).alias("seg")) \
        .agg(F.collect_list(F.struct("rank", "name")).alias("wanted"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                records = dict(zip(row["nodes"] or [], row["children"] or [], strict=True))
                out = []
                for child in row["wanted"]:
                    node, siblings, sides = descend(row["digest"], row["height"] or 0, child["rank"], records)
                    out.append({"tree": child["name"] if below else row["tree"], "seg": 0 if below else child["rank"],
                                "digest": node, "siblings": siblings + row["siblings"], "sides": sides + row["sides"],
                                "subroot": node if below else row["subroot"]})
                yield _batch(out, _REQUEST)

    return _asked(requests, records, wanted).mapInArrow(tidied(step), REQUEST)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank of a leaf in its tree, leaf to test, about: any struct) with ``subroot``, ``root``,
    ``siblings`` from the leaf to the root (empty where a run has none), ``sides``, and ``folded``, the root that the
    leaf to test gives."""
    spark = requests.sparkSession
    bounded_batches(spark)
    about = requests.schema["about"].dataType.simpleString()
    # what is asked at each round, from the leaves up
    asked = requests.groupBy("tree", F.shiftright("rank", DIGITS).alias("seg")) \
        .agg(F.collect_list(F.struct("rank", "leaf", "about")).alias("wanted"))
    asked = stored(asked, "merkle-asked")
    levels = [asked.select("tree", F.col("seg").alias("rank"))]
    for _ in manifest.rounds[1:]:
        levels.append(levels[-1].select("tree", F.shiftright("rank", DIGITS).alias("rank")).distinct())
    names = levels[-1].select(F.col("tree").alias("name")).distinct()
    ranks = manifest.subroots.join(names, "name").select(F.lit("").alias("tree"), "rank", "name")
    tops = [ranks]
    for _ in manifest.top_rounds[1:]:
        tops.append(tops[-1].select("tree", F.shiftright("rank", DIGITS).alias("rank"),
                                    F.lit("").alias("name")).distinct())

    now = spark.createDataFrame([("", 0, manifest.root, [], "", None)] if manifest.root else [], REQUEST)
    for level in range(len(tops) - 1, -1, -1):
        now = _down(now, manifest.top_rounds[level], tops[level], level == 0)
    for level in range(len(manifest.rounds) - 1, 0, -1):
        now = stored(_down(now, manifest.rounds[level], levels[level - 1].withColumn("name", F.lit("")), False),
                     f"merkle-requests-{level}")

    root = manifest.root
    path = [("subroot", pa.string()), ("root", pa.string()), ("siblings", pa.list_(pa.string())),
            ("sides", pa.string()), ("folded", pa.string())]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("wanted").type.value_type
            schema = pa.schema([("tree", pa.string()), *[(f.name, f.type) for f in kind], *path])
            for row in batch.to_pylist():
                records = dict(zip(row["nodes"] or [], row["children"] or [], strict=True))
                known: dict[str, str] = {}
                out = []
                for leaf in row["wanted"]:
                    _, siblings, sides = descend(row["digest"], row["height"] or 0, leaf["rank"], records)
                    siblings, sides = siblings + row["siblings"], sides + row["sides"]
                    out.append(leaf | {"tree": row["tree"], "subroot": row["subroot"], "root": root,
                                       "siblings": siblings, "sides": sides,
                                       "folded": fold(leaf["leaf"], siblings, sides, known)})
                yield _batch(out, schema)

    return _asked(now, manifest.rounds[0], asked).mapInArrow(
        tidied(answer), f"tree string, rank bigint, leaf string, about {about}, subroot string, root string, "
                        "siblings array<string>, sides string, folded string")


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered) of every document; ``tampered``, null for most, is the leaf after a change."""
    doc_id, source, lang, n_chars, text = [F.col(c) for c in FIELDS]
    more = n_chars.cast("decimal(20,0)") + 1
    hit = F.crc32(doc_id.cast("string")) % 7 == 0
    return docs.select(tree_key(lang).alias("tree"), doc_id.cast("bigint").alias("doc_id"),
                       leaf_digest([doc_id, source, lang, n_chars, text]).alias("leaf"),
                       F.when(hit & n_chars.isNotNull(), leaf_digest([doc_id, source, lang, more, text]))
                       .alias("tampered"))


def tampering_report(docs: DataFrame) -> DataFrame:
    """Contract columns: every document's proof, and whether its leaf, some tampered with, still gives the root."""
    manifest = build(document_leaves(docs.select(*FIELDS)), ["doc_id"])
    requests = manifest.leaves.select("tree", "rank", F.coalesce("tampered", "leaf").alias("leaf"),
                                      F.struct("doc_id", "leaf").alias("about"))
    proofs = prove(manifest, requests)
    return proofs.select("about.doc_id", "about.leaf", "subroot", "root",
                         F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                         F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    return tampering_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = """
WITH RECURSIVE
d AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, row_number() OVER () AS num,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda a, x: list_reduce([xor(a, x)] || range(8),
        lambda b, i: xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)), 4294967295) AS crc
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n
  FROM (SELECT doc_id, tree, num,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-')
      || tail) END AS tampered FROM d)),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM nodes
  WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
subroots AS (
  SELECT tree, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM tops
  WHERE n > 1 GROUP BY lvl, pos // 2, n),
root AS (SELECT digest AS root, lvl AS height FROM tops WHERE n = 1),
levels AS (  -- every leaf's place on every level below the root
  SELECT l.num, s.tree, v.lvl, v.lvl AS place, l.pos >> v.lvl AS pos, FALSE AS top
  FROM leaves l JOIN subroots s USING (tree) CROSS JOIN range(64) v(lvl) WHERE v.lvl < s.height
  UNION ALL
  SELECT l.num, s.tree, v.lvl, s.height + v.lvl, s.pos >> v.lvl, TRUE
  FROM leaves l JOIN subroots s USING (tree) CROSS JOIN root r CROSS JOIN range(64) v(lvl) WHERE v.lvl < r.height),
siblings AS (
  SELECT p.num, p.place, p.pos % 2 = 1 AS is_left, coalesce(b.digest, t.digest, '') AS sibling
  FROM levels p
  LEFT JOIN nodes b ON NOT p.top AND b.tree = p.tree AND b.lvl = p.lvl AND b.pos = xor(p.pos, 1)
  LEFT JOIN tops t ON p.top AND t.lvl = p.lvl AND t.pos = xor(p.pos, 1)),
proofs AS (SELECT num, string_agg(sibling, '' ORDER BY place) AS proof FROM siblings GROUP BY num),
folds AS (
  SELECT num, 0::BIGINT AS place, coalesce(tampered, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.num, f.place + 1, sha256(CASE WHEN s.is_left THEN s.sibling || f.digest ELSE f.digest || s.sibling END)
  FROM folds f JOIN siblings s ON s.num = f.num AND s.place = f.place)
SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.digest AS folded_root,
  f.digest = r.root AS verified
FROM leaves l JOIN subroots s USING (tree) CROSS JOIN root r LEFT JOIN proofs p ON p.num = l.num
JOIN folds f ON f.num = l.num AND f.place = s.height + r.height
"""
