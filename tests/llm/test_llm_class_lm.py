import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_plain import LOWER, WORD, docs, odd_rows
from pyspark.sql import functions as F

from syncledger.llm import class_lm as lm


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def sentences(n=400, seed=2):
    """Words of two kinds in turn, so classes tell more than counts."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = []
        for k in range(rng.randint(2, 20)):
            words.append(rng.choice(["Red", "blue", "green", "pink"] if k % 2 else ["cat", "dog", "Cow", "hen"]))
        if i % 5 == 0:
            words.append(f"rare{i // 10}")
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("broadcast", [1_000_000, 6])
def test_base_scores_equal_brute_force(spark, broadcast):
    rows = sentences() + [(i and 1000 + i, t) for i, t in odd_rows()]
    table = docs(spark, rows).repartition(5)
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1
    model, rare = lm.train(table.filter(learn).select("text"), 6, 3, broadcast)
    counts = Counter()
    for i, t in rows:
        if (i or 0) % 3 != 1:
            counts.update(tokens(t))
    total, types = sum(counts.values()), len(counts)
    assert (model.tokens, model.types) == (total, types)
    out = lm.score(table, model, rare).collect()
    assert len(out) == len(rows)
    text_of = dict(rows)
    for r in out:
        own = tokens(text_of[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(counts[w] > 0 for w in own))
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in own)
        assert r["base_score"] == pytest.approx(base)
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(own)))


def test_scores_do_not_depend_on_what_is_broadcast(spark):
    table = docs(spark, sentences())
    scores = []
    for broadcast in (1_000_000, 9):
        model, rare = lm.train(table.select("text"), 8, 3, broadcast)
        scores.append({r["doc_id"]: r["score"] for r in lm.score(table, model, rare).collect()})
    assert scores[0] == pytest.approx(scores[1])


@pytest.mark.parametrize("broadcast", [1_000_000, 9])
def test_scores_equal_a_plain_class_model(spark, broadcast):
    """Class pairs counted one by one with the classes found; a word after itself, a word before itself, unseen words."""
    rows = sentences(200) + [(900, "odd odd odd even even"), (901, "odd lone1 lone2 lone2"), (902, "lone3")]
    table = docs(spark, rows + [(903, "cat never seen blue"), (904, None)]).repartition(4)
    model, rare = lm.train(table.filter("doc_id < 903").select("text"), 6, 3, broadcast)
    of = dict(zip(model.words.tolist(), model.of[:-2].tolist(), strict=True))
    left = rare.collect()
    of |= {r["h"] % (1 << 64): r["of"] for r in left}

    def hashed(text):
        raw = (text or "").encode()
        return lm._tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist()

    count, pairs, size = Counter(), Counter(), Counter()
    for _, text in rows:
        own = hashed(text)
        count.update(own)
        named = [3 + 1, *[of.get(h, 3 + 1) for h in own]]
        pairs.update(zip(named[:-1], named[1:], strict=True))
        size.update(named[1:])
    assert {r["h"] % (1 << 64): r["n"] for r in left} == {h: count[h] for h in of if h not in set(model.words.tolist())}
    before = Counter()
    for (a, _), n in pairs.items():
        before[a] += n
    for r in lm.score(table, model, rare).collect():
        total, last = 0.0, 4
        for h in hashed(dict(rows + [(903, "cat never seen blue")]).get(r["doc_id"])):
            c = 4 if h == int(lm.END) else of.get(h, 3)
            total += math.log10((pairs[last, c] + 1) / (before[last] + 5))
            total += math.log10(count[h] / size[c]) if c < 3 else 0.0
            last = c
        assert r["score"] == pytest.approx(total)


def test_places_of_hashes():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 50, 3000):
        keys = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
        keys = np.unique(np.concatenate([keys, np.array([1, (1 << 64) - 1], np.uint64)])) if size > 1 else keys
        asked = np.concatenate([keys, rng.integers(0, 1 << 64, 500, np.uint64), keys + np.uint64(1)])
        at, known = lm.finder(keys)(asked)
        assert list(known) == list(np.isin(asked, keys))
        assert not size or list(keys[at[known]]) == list(asked[known])


def test_classes_beat_counts_on_held_out_text(spark):
    table = docs(spark, sentences())
    model, rare = lm.train(table.filter("doc_id % 7 != 2").select("text"), 8, 2)
    held = lm.score(table.filter("doc_id % 7 = 2"), model, rare).agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1] + 50


def test_exchange_finds_the_classes_and_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    side = 10  # words 0-3 and 4-7 follow each other; 8: other words; 9: the end
    b = np.zeros((side, side), np.int64)
    for x in range(4):
        for y in range(4, 8):
            b[x, y], b[y, x] = rng.integers(20, 30, 2)
    b[9, :4] += 5
    b[4:8, 9] += 5
    of = lm.exchange(b, 2)
    assert len(set(of[:4])) == len(set(of[4:8])) == 1 and of[0] != of[4]
    assert list(of[8:]) == [2, 3]


def test_a_distribution(spark):
    """Over all words (one unseen), the probabilities after a text's start sum to 1."""
    table = docs(spark, sentences())
    model, rare = lm.train(table.select("text"), 5, 2)
    words = sorted({w for _, t in sentences() for w in tokens(t) if w})
    asked = docs(spark, [(i, w) for i, w in enumerate([*words, "unseen!"])])
    empty = lm.score(docs(spark, [(0, "")]), model, rare).first()["score"]
    ends = {}  # P(end | word) by class: taken out of the score of a one-word text
    total = 10 ** empty
    for r in lm.score(asked, model, rare).collect():
        h = lm._tokens(np.frombuffer(([*words, "unseen!"][r["doc_id"]]).encode(), np.uint8),
                       np.array([0, len([*words, "unseen!"][r["doc_id"]].encode())]))[0]
        ids = lm._word_ids(model.words, model.ids, h)
        ends = model.after[model.of[ids[0]], model.of[-1]]
        total += 10 ** (r["score"] - ends)
    assert total == pytest.approx(1.0)


def test_empty_tables(spark):
    empty = docs(spark, [])
    model, rare = lm.train(empty.select("text"))
    assert lm.score(empty, model, rare).count() == 0
    out = lm.score(docs(spark, [(1, "some words"), (2, None)]), model, rare).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out} == {(1, 3, 0, 0), (2, 1, 0, 0)}


@pytest.mark.parametrize("broadcast", [1_000_000, 6])
def test_every_seen_word_gets_a_class(spark, broadcast):
    """Words beyond those that begin the classes are clustered too, sent to the workers or not."""
    table = docs(spark, [(i, f"{t} {t}") for i, t in sentences()])
    model, rare = lm.train(table.select("text"), 3, 2, broadcast)
    of = dict(zip(model.words.tolist(), model.of[:-2].tolist(), strict=True))
    of |= {r["h"] % (1 << 64): r["of"] for r in rare.collect() if r["h"] != int(lm.END)}
    assert len(of) == 8 + 40 and set(of.values()) == {0, 1}
    kinds = []
    for kind in ("red blue green pink", "cat dog cow hen"):
        raw = kind.encode()
        h = lm._tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0][:-1]
        kinds.append({of[x] for x in h.tolist()})
    assert sorted(kinds, key=min) == [{0}, {1}]


def test_the_number_of_classes_grows_with_the_corpus():
    assert [lm.class_number(n) for n in (0, 1000, 10 ** 7, 10 ** 8)] == [40, 40, 112, 200]
