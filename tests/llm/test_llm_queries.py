"""The registered queries: SQL oracles, and the pipeline stage by stage against plain computations."""

import os

import duckdb
import numpy as np
import pytest
from llm_plain import components
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from syncledger.llm import mixing, pii, queries
from syncledger.llm.pieces import default_vocabulary
from syncledger.testing import compare

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "conversations", "benchmark")


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return db


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names}
    assert "pipeline" in names and set(queries.ORACLES) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "mix", "pack"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, message = compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_gives_a_row_for_every_document(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        results[name] = before, after = docs, corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        docs = after
        if name != "pack":
            assert after.columns == columns and after.schema == before.schema
    before, after = results["language_id"]
    lost = {r["text"] for r in before.join(after, "doc_id", "left_anti").collect()}
    assert not any(t and sum(map(str.isalpha, t)) > 20 for t in lost)

    before, after = results["near_dedup"]
    want, _ = components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(want.values()))

    before, after = results["pii"]
    new = {r["doc_id"]: r for r in after.collect()}
    for r in before.collect():
        assert not pii.base_spans(new[r["doc_id"]]["text"])
        assert new[r["doc_id"]]["n_chars"] == len(new[r["doc_id"]]["text"])
        if not any(c.isdigit() or c in "@[(" for c in r["text"]):
            assert new[r["doc_id"]]["text"] == r["text"]

    before, after = results["mix"]
    sized = mixing.sizes(before)
    copies = {r["doc_id"]: r["copies"] for r in mixing.repetitions(sized, mixing.source_rates(sized)).collect()}
    got = after.groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {d: n for d, n in copies.items() if n}

    before, after = results["pack"]
    tokenizer = Tokenizer.from_file(default_vocabulary())
    tokens = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before.collect())
    rows = after.collect()
    assert sum(r["length"] for r in rows) == tokens
    fill = np.bincount(np.unique([r["sequence_id"] for r in rows], return_inverse=True)[1], [r["length"] for r in rows])
    assert fill.max() <= 1024 and len(fill) <= 1.05 * -(-tokens // 1024) + 2


def test_the_rest_stands_alone():
    """Nothing outside the subpackage imports it but the guarded registration."""
    top = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(top, "syncledger")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, f)).read(), f
