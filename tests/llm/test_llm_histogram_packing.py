"""Operator 11: ids by the tokenizer library, an exact round trip, and the plan by its own rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_plain import docs, odd_rows
from tokenizers import Tokenizer

from syncledger.llm import histogram_packing as hp
from syncledger.llm.pieces import default_vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw():
    with open(default_vocabulary(hp.VOCABULARY), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def tokenizer(raw):
    return Tokenizer.from_str(raw.decode())


HARD = ["don't 'Tis I'LL we've 'sx ''s 's' '", "ÉCOLE İstanbul × ÷ ﬁ ①² ½ x", "日本 語 <|endoftext|> it's 12345 !!'s...",
        "", " ", "ábc \u0085x y", "'", "x'", "'ré 're 'RE 'l 'll 'v", "<|startoftext|><|endoftext|>", "é ̈a",
        "tab\tnl\n\x0b\x0c\r\x1c end's", "a" * 5000, "?!" * 3000, "ſ K Å ẞ Σας ΟΔΟΣ", "𝒳 🙂 ‍ ﻿"]


def test_ids_are_the_librarys(raw, tokenizer):
    rnd = random.Random(1)
    signs = ["'", "s", "T", "re", "VE", "ll", " ", "  ", "\n", "é", "Ü", "7", "42", "×", "÷", "-", "İ", "ǆ", "x", " "]
    texts = HARD + ["".join(rnd.choices(signs, k=rnd.randint(1, 30))) for _ in range(3000)]
    words = hp.WordIds(raw)
    for a in range(0, len(texts), 50):
        some = [t.encode() for t in texts[a:a + 50]]
        offs = np.concatenate([[0], np.cumsum([len(b) for b in some])]).astype(np.int64)
        ids, begins = words.of_block(np.frombuffer(b"".join(some), np.uint8), offs)
        for k, t in enumerate(texts[a:a + 50]):
            want = tokenizer.encode(t, add_special_tokens=False).ids
            assert ids[begins[k]:begins[k + 1]].tolist() == want, t


def test_chunks_of_long_texts_have_the_ids_of_the_whole(raw, tokenizer, monkeypatch):
    monkeypatch.setattr(hp, "CHUNK", 64)
    text = " ".join(random.Random(2).choices([*[h for h in HARD if len(h) < 99], "plain", "words 12"], k=400))
    parts = list(hp.safe_chunks(text.encode(), 64))
    assert len(parts) > 20 and b"".join(parts) == text.encode()
    assert hp.WordIds(raw).of_text(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_places(rows, window):
    """Rows (doc_id, start, length, crc, doc_tokens, sequence_id, offset): gapless sequences and whole documents."""
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    fills = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window  # full, or a power of two
        fills.append(at)
    return fills


def check_documents(rows, want, end_id=hp.END_ID):
    """Every document's ids by its parts. ``want``: ids by doc_id, of ids that do not repeat."""
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append(r)
    assert set(parts) == set(want)
    for d, own in parts.items():
        ids, at = [*want[d], end_id], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at:at + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)


def test_query_round_trip(spark, tokenizer):
    rows = hp.op11_pack_by_histogram(spark, SF).collect()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids for r in texts}
    fills = check_places(rows, hp.WINDOW)
    check_documents(rows, want)
    assert sum(1 for f in fills if f < hp.WINDOW) <= 11


def test_odd_rows(spark, tokenizer):
    table = odd_rows()
    rows = hp.place_pieces(hp.window_pieces(docs(spark, table), 128), 128).collect()
    check_places(rows, 128)
    once = [(d, t) for d, t in table if d != 8]
    check_documents([r for r in rows if r["doc_id"] != 8],
                    {d: tokenizer.encode(t or "", add_special_tokens=False).ids for d, t in once})
    twice = [r for r in rows if r["doc_id"] == 8]
    assert len({r["row"] for r in twice}) == 2 and sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"]


def test_empty_table(spark):
    assert hp.place_pieces(hp.window_pieces(docs(spark, [(1, "a")]).filter("false"))).collect() == []


def test_sequences_themselves(spark, tokenizer):
    rnd = random.Random(3)
    table = [(i, " ".join(rnd.choices(["alpha", "beta", "it's", "42"], k=rnd.randint(0, 90)))) for i in range(300)]
    out = hp.pack_documents(docs(spark, table), 64).collect()
    want = [tokenizer.encode(t, add_special_tokens=False).ids for _, t in table]
    assert sorted(i for r in out for i in r["ids"]) == sorted([i for ids in want for i in ids] + [1] * len(table))
    assert all(r["length"] == len(r["ids"]) for r in out)
    by_doc = defaultdict(set)
    for r in out:
        for d in r["doc_ids"]:
            by_doc[d].add(r["sequence_id"])
    assert set(by_doc) == set(range(300))


def histogram(lengths, window):
    return np.bincount(lengths, minlength=window + 1).astype(np.int64)


@pytest.mark.parametrize("lengths", [
    [], [5], [64], [64] * 3, [1] * 1000, [63] * 50, [40] * 9, [32, 32], [33, 31, 20, 20, 24], [60, 3],
    *[random.Random(s).choices(range(1, 65), k=10 ** (1 + s % 4)) for s in range(12)],
    *[[int(random.Random(s).expovariate(1 / 9)) % 64 + 1 for _ in range(3000)] for s in range(3)]])
def test_plan_places_every_token_once(lengths):
    """The ranges, spelled out: every token of every piece has one place, and sequences have no gap."""
    rnd = random.Random(4)
    window = 64
    if len(lengths) > 500:
        lengths = [rnd.choice(lengths) for _ in lengths]
    plan = hp.plan_windows(histogram(np.array(lengths, np.int64), window))
    left = {(x, r): set(range(x)) for x, n in enumerate(histogram(np.array(lengths, np.int64), window)) for r in range(n)}
    sequences = defaultdict(list)
    for _, length, rank, count, start, taken, skip, per, sequence, offset in plan.entries:
        for n in range(count):
            own = left[length, rank + n]
            part = set(range(start, start + taken))
            assert part <= own
            own -= part
            place = skip + n
            sequences[sequence + place // per].append((offset + place % per * taken, taken))
    assert not any(left.values())
    assert sorted(sequences) == list(range(plan.sequences))
    fills = check_places([{"sequence_id": s, "offset": o, "length": n} for s, p in sequences.items() for o, n in p], window)
    total = sum(lengths)
    assert fills.count(window) == total // window and sum(fills) == total


def test_least_squares_reaches_a_histogram_that_combinations_make():
    """Counts drawn at random, and their histogram: the solution gives that histogram again, and nothing is cut."""
    window, rnd = 128, np.random.default_rng(5)
    combos = hp.combinations(np.ones(window + 1, bool))
    assert {tuple(c) for c in combos.tolist()} == {
        (a, b, window - a - b) for a in range(window) for b in range(max(a, 1), window) if window - a - b >= b}
    counts = rnd.integers(0, 50, len(combos))
    made = np.bincount(combos.ravel(), np.repeat(counts, 3), window + 1).astype(np.int64)
    made[0] = 0
    solved = hp.repeat_counts(combos, made, sweeps=200)
    back = np.bincount(combos.ravel(), np.repeat(solved, 3), window + 1)
    assert (solved >= 0).all() and np.abs(back - made)[1:].sum() <= 0.02 * made.sum()


def test_most_pieces_stay_whole():
    """On many lengths, few of the pieces are cut."""
    rnd = np.random.default_rng(6)
    lengths = np.minimum(rnd.lognormal(4.0, 1.0, 200_000).astype(np.int64) + 1, 512)
    plan = hp.plan_windows(histogram(lengths, 512))
    assert sum(e[3] for e in plan.entries if e[0]) <= 0.05 * len(lengths)
