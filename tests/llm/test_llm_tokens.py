import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_plain import docs, odd_rows
from tokenizers import Tokenizer

from syncledger.llm import packing as pk
from syncledger.llm import token_counts as tc
from syncledger.llm.pieces import Vocabulary, default_vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def texts():
    rng = random.Random(5)
    parts = ["a", "'", "'s", "'re", "'ll", "'v", " ", "  ", "\n", "\t", "t", "é", "×", "1", "23", "!", "<|endoftext|>", "²",
             "日本", " ", "\x85", "я", "½", "\x1c", "Z"]
    return [(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(3000)]


def test_counts_equal_the_library(spark, tokenizer):
    rows = odd_rows() + texts()
    out = tc.token_counts(docs(spark, rows)).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()),
                   len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in out)
    assert tc.token_counts(docs(spark, [])).count() == 0


def test_heap_merging_of_one_piece(tokenizer):
    vocab = Vocabulary(open(default_vocabulary(), "rb").read())
    for piece in (" hello", "antidisestablishmentarianism", "aaaaaaaaaaaaaaaa", "é", " 1234567890", "!!!!!!!"):
        assert tc.merged_length(piece.encode(), vocab) == len(tokenizer.encode(piece, add_special_tokens=False).ids)


def check_packing(pieces, ids_of, length):
    """Pieces tile their documents, sequences are gapless and within the budget."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids_of)
    for d, own in by_doc.items():
        at = 0
        for n, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            part = np.array(ids_of[d][at:at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part.tobytes()))
            assert r["length"] == length or n == 0
            at += r["length"]
        assert at == len(ids_of[d])
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= length
    return len(by_sequence)


def test_packing_in_rounds(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "ITEMS", 40)
    monkeypatch.setattr(pk, "FAN_IN", 3)
    rng = random.Random(2)
    rows = [(2000 + i, " word" * rng.randint(0, 150)) for i in range(600)] + [r for r in odd_rows() if r[0] not in (8, None)]
    table = docs(spark, rows).repartition(17)
    ids_of = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    out = pk.packed_pieces(table, length=64).collect()
    n = check_packing(out, ids_of, 64)
    least = -(-sum(map(len, ids_of.values())) // 64)
    assert n <= 1.02 * least + 2


def test_items_that_do_not_pair(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "ITEMS", 10)
    rows = [(i, " word" * 40) for i in range(200)]  # 41 tokens each: no two fit
    out = pk.packed_pieces(docs(spark, rows).repartition(7), length=64).collect()
    assert len({r["sequence_id"] for r in out}) == 200 == len(out)


def test_sequences_hold_the_ids(spark, tokenizer):
    rows = [(i, " word" * (i % 9) + " end") for i in range(40)] + [(7, " twice"), (7, " twice"), (None, "none")]
    got = pk.pack_documents(docs(spark, rows), length=16).collect()
    ids = [x for r in got for x in r["ids"]]
    want = [x for _, t in rows for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    assert sorted(ids) == sorted(want)
    assert all(len(r["ids"]) == r["length"] <= 16 for r in got)


def test_repeated_rows_and_empty_table(spark):
    out = pk.packed_pieces(docs(spark, odd_rows()), length=1024).collect()
    assert sum(r["doc_id"] == 8 for r in out) == 2 and sum(r["doc_id"] is None for r in out) == 1
    assert [r["length"] for r in out if r["doc_id"] in (1, 2)] == [1, 1]
    assert pk.packed_pieces(docs(spark, [])).count() == 0
