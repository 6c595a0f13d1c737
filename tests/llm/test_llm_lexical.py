"""Operator 12 against scores computed one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
from llm_plain import LOWER, docs, odd_rows

from syncledger.llm import lexical
from syncledger.llm.common import BLOCK

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, k):
    counts = [(d, Counter(terms(t))) for d, t in rows if terms(t)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "y") for r in rows], "item_id long, text string, item long, doc_id string")


def search(spark, rows, items, k, **options):
    out = lexical.ranked_search(docs(spark, rows), items_of(spark, items), k, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


def corpus(n, seed, words=400):
    rnd = random.Random(seed)
    pool = [f"w{int(rnd.paretovariate(0.7)) % words}" for _ in range(20_000)]
    return [(i, " ".join(rnd.choices(pool, k=rnd.randint(1, 120)))) for i in range(n)]


def test_against_plain_scores(spark):
    rows = corpus(900, 1)
    items = [(i, " ".join(t.split()[:40])) for i, t in corpus(25, 2)] + [(90, "w1 w2 w3"), (91, "absent words")]
    assert search(spark, rows, items, 50) == plain(rows, items, 50)


def test_many_small_blocks_and_slices(spark, monkeypatch):
    """Running k-th scores across blocks of a task, several tasks, and several slices of items."""
    rows = corpus(700, 3, words=2000)
    items = [(i, t) for i, t in corpus(30, 4, words=2000)]
    want = plain(rows, items, 5)
    assert search(spark, rows, items, 5, slice_terms=60) == want
    held = lexical.item_slice([{"item": i, "terms": np.unique(np.array([h for h in hashes(t)], np.uint64)).view(np.int64)}
                               for i, t in items])
    # the same block search, called with blocks of seven documents
    texts = [t for _, t in rows]
    found = {i: [] for i, _ in items}
    n, total, df = sizes(texts, held[1])
    w = lexical.weights(n, df)
    for a in range(0, len(texts), 7):
        block = block_of(range(a, min(a + 7, len(texts))), texts, held[1], n, total)
        for q, (i, _) in enumerate(items):
            floor = sorted(found[i])[-5][0] if len(found[i]) >= 5 else 0
            at, scores = block.best(held[2][q], w[held[2][q]], 5, floor)
            found[i] += [(s, -d) for s, d in zip(scores.tolist(), block.ids[at].tolist(), strict=True)]
    got = [(i, r, -d, s) for i in found for r, (s, d) in enumerate(sorted(found[i], reverse=True)[:5], 1)]
    assert sorted(got, key=repr) == want


def hashes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return lexical.term_hashes(data, np.array([0, len(data)]))[0]


def sizes(texts, vocabulary):
    df = np.zeros(len(vocabulary), np.int64)
    for t in texts:
        df[np.searchsorted(vocabulary, np.intersect1d(hashes(t), vocabulary))] += 1
    return len(texts), sum(len(hashes(t)) for t in texts), df


def block_of(ids, texts, vocabulary, n, total):
    block = lexical._Block()
    for d in ids:
        h = hashes(texts[d])
        known, tf = np.unique(np.searchsorted(vocabulary, h[np.isin(h, vocabulary)]), return_counts=True)
        block.add(np.array([d]), np.array([False]), np.array([len(h)]), np.array([len(known)]), known, tf)
    row = block.row()
    return lexical.MaskBlock({c: row.column(c)[0].as_buffer() for c in row.schema.names if c not in "nl"}, n, total,
                             len(vocabulary))


def test_odd_rows_ties_and_repeats(spark):
    rows = [*odd_rows(), (20, "Tie tie"), (19, "TIE tie"), (21, "tie Tie"), (None, "tie tie"), (None, "tie tie")]
    items = [(1, "tie"), (1, "tie"), (2, None), (3, ""), (4, "... -- !"), (None, "one TWO three, four! five_six"),
             (5, "日本 é"), (6, "w1 w2 w3 w4 w5 tis"), (7, "x" * 300_000)]
    got, want = search(spark, rows, items, 3), plain(rows, items, 3)
    assert got == want and sum(r[0] == 1 for r in got) == 6


def test_more_terms_than_a_mask_word(spark):
    """Items of several hundred terms."""
    rows = corpus(300, 5, words=3000)
    items = [(1, " ".join(f"w{i}" for i in range(500))), (2, " ".join(f"w{i}" for i in range(0, 3000, 7)))]
    assert search(spark, rows, items, 20) == plain(rows, items, 20)


def test_empty_tables(spark):
    assert search(spark, [(1, "a")], [], 5) == []
    assert search(spark, [(1, None), (2, "!?")], [(1, "a")], 5) == []
    none = lexical.ranked_search(docs(spark, [(1, "a")]).filter("false"), items_of(spark, [(1, "a")]), 5)
    assert none.collect() == []


def test_terms_of_long_texts():
    text = "".join(random.Random(7).choices(["abc ", "Dé-", "x" * 50_000, " \x00", "z9"], [50, 50, 1, 5, 9], k=60_000))
    assert len(text.encode()) > 2 * BLOCK
    assert len(hashes(text)) == len(terms(text))
    words = Counter(terms(text))
    assert sorted(Counter(hashes(text).tolist()).values()) == sorted(words.values())
    assert set(hashes(" ".join(words)).tolist()) == set(hashes(text).tolist())
