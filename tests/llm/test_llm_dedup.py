import random

import numpy as np
import pytest
from llm_plain import components, docs, odd_rows, shingles

from syncledger.llm import near_dup as nd
from syncledger.llm.common import mix64
from syncledger.llm.components import add_edges


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def near_copies(seed=3):
    """A group of copies with edits of many sizes, exact copies, chains and documents of their own."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((100 + i, " ".join(w)))
    rows += [(300 + i, rows[i][1].upper()) for i in range(20)]
    chain = [rng.choice(words) for _ in range(100)]
    for i in range(12):  # each a little further from the first
        chain = chain[:i * 3] + [f"c{i}a", f"c{i}b"] + chain[i * 3 + 2:]
        rows.append((400 + i, " ".join(chain)))
    rows += [(500 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    return rows


def test_groups_equal_brute_force(spark):
    rows = near_copies()
    want, sizes = components(rows)
    got = by_id(nd.near_duplicates(docs(spark, rows)))
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert {d: r["n_shingles"] for d, r in got.items()} == sizes
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())
    assert len(set(want.values())) < len(want)


def test_odd_rows(spark):
    out = nd.near_duplicates(docs(spark, odd_rows())).collect()
    assert len(out) == len(odd_rows())
    got = {r["doc_id"]: r for r in out}
    for d in (1, 2, 3):
        assert (got[d]["n_shingles"], got[d]["component_id"], got[d]["kept"]) == (0, d, True)
    assert got[5]["component_id"] == 5 and got[6]["component_id"] == 5 and not got[6]["kept"]
    assert got[4]["n_shingles"] == 1 and got[7]["n_shingles"] == len(shingles(odd_rows()[6][1]))
    assert [r["component_id"] for r in out if r["doc_id"] in (8, 12)] == [8, 8, 8]
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_empty_table(spark):
    assert nd.near_duplicates(docs(spark, [])).count() == 0
    assert nd.deduplicate(docs(spark, [])).count() == 0


def test_deduplicate_keeps_one_of_each_group(spark):
    table = docs(spark, odd_rows())
    out = nd.deduplicate(table)
    assert out.columns == table.columns
    ids = sorted((r["doc_id"] for r in out.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11, None]


def test_one_id_on_different_texts(spark):
    """Rows are linked by their sets: an id that two texts share joins nothing."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (2, a), (3, b), (4, c), (5, c), (5, c), (1, b), (6, None), (6, None), (6, ""), (None, a)]
    table = docs(spark, rows)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                 for r in nd.near_duplicates(table.filter("doc_id IS NOT NULL")).collect())
    assert got == sorted([(1, 26, 1, True)] * 3 + [(2, 26, 1, False), (3, 26, 1, False), (4, 26, 4, True)]
                         + [(5, 26, 4, False)] * 2 + [(6, 0, 6, True)] * 3)
    left = sorted(((r["doc_id"] or 0, r["text"] or "") for r in nd.deduplicate(table).collect()))
    assert left == sorted([(1, a), (1, b), (4, c), (6, ""), (6, ""), (6, ""), (0, a)])


def test_an_id_that_clashes_joins_no_components(spark):
    """Two texts of one id, each with near copies of its own: two groups, and one row of each stays."""
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b))]
    rows += [(10 + i, " ".join([*a[:-1], f"new{i}"])) for i in range(4)] + [(20 + i, " ".join([*b[:-1], f"new{i}"])) for i in range(4)]
    assert all(r["component_id"] == 1 for r in nd.near_duplicates(docs(spark, rows)).collect())
    left = nd.deduplicate(docs(spark, rows)).collect()
    assert sorted(r["text"] for r in left) == sorted([rows[0][1], rows[1][1]])


def test_hot_buckets_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nd, "PART", 5)
    rows = near_copies()
    want, _ = components(rows)
    assert {d: r["component_id"] for d, r in by_id(nd.near_duplicates(docs(spark, rows))).items()} == want


@pytest.mark.parametrize("union, bound", [(4, 3e-6), (8, 5e-6), (400, 1e-5)])
def test_no_band_holds_both_ends_of_a_permutation(union, bound):
    """The share of bands that two sets of J = 0.75 have in common, over many drawn pairs, is J to the fourth; and the
    stated chance that none is."""
    rng = np.random.default_rng(union)
    inside, hit, pairs = union * 3 // 4, 0, 400
    for _ in range(pairs):
        x = np.unique(mix64(rng.integers(1, 1 << 62, union).astype(np.uint64)))
        common, rest = x[rng.permutation(union)][:inside], x[inside:]
        other = rng.permutation(np.concatenate([common, rest[:0]]))
        sets = np.concatenate([np.sort(x), np.sort(other)])
        values = nd.signatures(sets, np.array([0, union, union + inside]), nd.multipliers(nd.HASHES))
        keys = nd.band_keys(values, nd.ROWS)
        hit += int((keys[0] == keys[1]).sum())
    j = inside / union
    assert abs(hit / (pairs * 32) - j ** 4) < 0.05
    miss = (1 - 2 * j ** 4 + (j * (inside - 1) / (union - 1)) ** 4) ** 16
    assert miss < bound


def test_min_and_max_estimate_the_similarity():
    rng = np.random.default_rng(0)
    both, a, b = (mix64(rng.integers(1, 1 << 62, n).astype(np.uint64)) for n in (600, 100, 100))
    sets = np.concatenate([np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))])
    values = nd.signatures(sets, np.array([0, 700, 1400]), nd.multipliers(256))
    assert values.shape == (2, 512)  # two values from each of 256 evaluations
    assert abs((values[0] == values[1]).mean() - 600 / 800) < 0.08


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    labels = add_edges(spark.createDataFrame(chain + star, "a long, b long"))
    got = {r["node"]: r["label"] for r in labels.collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(50))
    joined = add_edges(spark.createDataFrame([(40, 149), (7, 500)], "a long, b long"), labels)
    assert {r["label"] for r in joined.collect()} == {1}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_documents_equal_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    want, _ = components([(r["doc_id"], r["text"]) for r in table.collect()])
    assert {d: r["component_id"] for d, r in by_id(nd.near_duplicates(table)).items()} == want
