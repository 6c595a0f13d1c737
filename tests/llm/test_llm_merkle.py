"""Operator 13 against a tree built level by level in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from syncledger.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank long, seg long"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [doc_id, source, lang, n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The top of a list of nodes, and each node's siblings from below, with their sides."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(places):
            other = p ^ 1
            paths[i].append((nodes[other] if other < len(nodes) else "", p % 2 == 1))
        nodes = [h("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        places = [p // 2 for p in places]
    return nodes[0], paths


def plain(rows):
    """Contract rows, one a document."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        tops[lang] = own, *tree([leaf(*r) for r in own])
    root, upper = tree([tops[x][1] for x in langs])
    out = []
    for lang, above in zip(langs, upper, strict=True):
        own, subroot, paths = tops[lang]
        for r, path in zip(own, paths, strict=True):
            path = path + above
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf(*r[:4], r[4] + 1) if hit else leaf(*r)
            for other, left in path:
                node = h(other + node if left else node + other)
            out.append((r[0], leaf(*r), subroot, root, h("".join(s for s, _ in path)), node, node == root))
    return out


def got(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                       "verified").collect()), key=repr)


def rows_of(n, seed, langs):
    rnd = random.Random(seed)
    return [(i, f"text {i} é", rnd.choice(langs), rnd.choice(["s", None, ""]), rnd.choice([None, 0, 7]))
            for i in range(n)]


ODD = [(1, None, None, None, None), (2, "", "", "", 0), (2, "", "", "", 0), (None, "日本", "en", "s", 5),
       (None, None, "en", None, None), (7, "x" * 200_000, "en", "s", 2**63 - 1), (8, "-", "é", "0:", -3),
       *[(i, "t", "z", "s", 2**63 - 1) for i in range(40)]]


@pytest.mark.parametrize("rows", [ODD, rows_of(1, 1, ["en"]), rows_of(2, 2, ["en", None]),
                                  rows_of(600, 3, ["en"] * 30 + [None, "de", "fr"]),
                                  rows_of(300, 4, [f"l{i}" for i in range(280)])])
def test_against_plain_trees(spark, rows):
    assert got(merkle.tampering_report(docs(spark, rows))) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("n", [255, 256, 257, 511, 512, 513, 1025])
def test_runs_that_fill_segments(spark, n):
    rows = rows_of(n, n, ["en"])
    assert got(merkle.tampering_report(docs(spark, rows))) == sorted(plain(rows), key=repr)


def test_many_rounds(spark, monkeypatch):
    """Segments of two levels: four rounds of leaves, three of languages."""
    monkeypatch.setattr(merkle, "DIGITS", 2)
    monkeypatch.setattr(merkle, "WIDTH", 4)
    rows = rows_of(400, 9, ["en"] * 60 + [f"l{i}" for i in range(40)])
    assert got(merkle.tampering_report(docs(spark, rows))) == sorted(plain(rows), key=repr)


def test_empty_table(spark):
    assert merkle.tampering_report(docs(spark, []).filter("false")).collect() == []


def test_proofs_of_some_leaves(spark):
    """Only what is asked for comes back, with siblings that fold to the root; another leaf's text does not."""
    rows = rows_of(700, 5, ["en", "de"])
    manifest = merkle.build(merkle.document_leaves(docs(spark, rows)), ["doc_id"])
    some = manifest.leaves.filter("doc_id % 50 = 3")
    asked = some.select("tree", "rank", "leaf", F.struct("doc_id").alias("about"))
    proofs = merkle.prove(manifest, asked).collect()
    assert sorted(r["about"]["doc_id"] for r in proofs) == list(range(3, 700, 50))
    for r in proofs:
        assert r["folded"] == r["root"] == manifest.root
        assert merkle.fold(h("other"), r["siblings"], r["sides"], {}) != manifest.root


def test_records_are_content_addressed(spark):
    manifest = merkle.build(merkle.document_leaves(docs(spark, rows_of(300, 6, ["en"]))), ["doc_id"])
    for segment in manifest.rounds:
        for r in segment.collect():
            assert all(h(c) == n for n, c in zip(r["nodes"], r["children"], strict=True))
            assert r["height"] == 0 or r["digest"] in r["nodes"]
