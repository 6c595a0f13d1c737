from collections import Counter

import pytest
from llm_plain import WORD, docs, odd_rows

from syncledger.llm import mixing as mx


def plain_targets(sizes, share=1.5, cap=2):
    """Targets by source, shared again and again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped, budget = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(capped.values())
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return capped | {s: left * weight[s] / total for s in free}
        capped |= {s: cap * sizes[s] for s in over}


def rows_of(n=400):
    return [(i, "w " * (i % 37), "en", [None, "a", "b", "é", "Z", "hot", "hot", "hot"][i * 7 % 8]) for i in range(n)]


def test_targets_and_taken_words(spark):
    rows = rows_of()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text))
    want = plain_targets(sizes)
    sized = mx.sizes(docs(spark, rows))
    rates = {r["source"]: r for r in mx.source_rates(sized).collect()}
    assert {s: r["source_size"] for s, r in rates.items()} == dict(sizes)
    for s, t in want.items():
        assert rates[s]["target"] == pytest.approx(t)
    taken, most = Counter(), 0
    out = mx.repetitions(sized, mx.source_rates(sized)).collect()
    source_of = {r[0]: r[3] for r in rows}
    for r in out:
        taken[source_of[r["doc_id"]]] += r["size"] * r["copies"]
        most = max(most, r["copies"])
    assert most <= 2 and len(out) == len(rows)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.3 * sizes[s]


def test_reruns_agree_and_copies_are_rows(spark):
    table = docs(spark, rows_of())
    first = Counter(r["doc_id"] for r in mx.mix_sources(table).collect())
    again = Counter(r["doc_id"] for r in mx.mix_sources(table.repartition(5)).collect())
    sized = mx.sizes(table)
    copies = {r["doc_id"]: r["copies"] for r in mx.repetitions(sized, mx.source_rates(sized)).collect()}
    assert first == again == Counter({d: n for d, n in copies.items() if n})
    assert mx.mix_sources(table).columns == table.columns


def test_odd_rows_and_empty_table(spark):
    table = docs(spark, odd_rows())
    sized = mx.sizes(table)
    out = mx.repetitions(sized, mx.source_rates(sized)).collect()
    assert len(out) == len(odd_rows())
    assert {r["size"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    empty = docs(spark, [])
    assert mx.mix_sources(empty).count() == 0
    zero = docs(spark, [(1, None, "en", "a"), (2, "", "en", "b")])
    assert mx.mix_sources(zero).count() == 0
