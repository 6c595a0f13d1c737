import random
from collections import Counter

import numpy as np
from llm_plain import WORD, docs, odd_rows

from syncledger.llm import quality as ql


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def rows_of(seed=4):
    rng = random.Random(seed)
    out = odd_rows()
    for i in range(300):
        words = [rng.choice(["the", "ab", "cd é", "#", "efg.", "x|y", "\n", "\x0b", "  "]) for _ in range(rng.randint(0, 60))]
        text = " ".join(words)
        out.append((100 + i, text + ("\n" + text) * rng.choice([0, 0, 1, 2])))
    return out


def test_statistics_equal_brute_force(spark):
    rows = rows_of()
    out = ql.quality(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    want = Counter((i, *plain(t)) for i, t in rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in out) == want
    for r in out:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert ql.quality(docs(spark, [])).count() == 0


def test_estimation_finds_the_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.85, 0.7, 0.6]
    votes = []
    for a in accuracy:
        right = rng.random(len(good)) < a
        vote = np.where(right == good, "2", "0")
        votes.append(np.where(rng.random(len(good)) < 0.2, "1", vote))
    patterns = Counter(map("".join, zip(*votes, strict=True)))
    names = sorted(patterns)
    posterior, found = ql.estimate(names, np.array([float(patterns[p]) for p in names]))
    assert abs(found["share_good"] - 0.8) < 0.03
    for k, a in enumerate(accuracy):
        given = found["given_good"][k]
        assert abs(given[2] / (given[0] + given[2]) - a) < 0.04
    p = dict(zip(names, posterior, strict=True))
    assert p["22222"] > 0.99 and p["00000"] < 0.01


def test_one_failed_rule_does_not_drop_a_document(spark):
    rng = random.Random(9)
    words = [f"word{rng.randrange(500)}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)) + ".") for i in range(60)]
    rows.append((99, "# " + " ".join(w.upper() for w in rng.choices(words, k=80)) + "."))
    rows += [(200 + i, " ".join(rng.choice(["###", "|||", "12", "$$"]) for _ in range(60))) for i in range(15)]
    kept = {r["doc_id"]: r["kept"] for r in ql.quality(docs(spark, rows)).collect()}
    assert kept[99] and all(kept[i] for i in range(60))
    assert not any(kept[200 + i] for i in range(15))


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = ql.quality(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("NOT base_failed").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in rows)
    assert right >= 0.97 * len(rows)
