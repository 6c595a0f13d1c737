import math
import random
import struct

from syncledger.llm import topk as tk

SCHEMA = "vec_id long, embedding array<float>, score long, block long, part string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def plain(rows, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def answer(df, k):
    v = tk.quantised(df)
    out = {}
    for r in tk.top_k(v, v.filter("vec_id % 20 = 0"), k).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in out.items()}


def test_equals_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(tk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(tk, "BLOCK_QUERIES", 4)
    monkeypatch.setattr(tk, "FAN_IN", 2)
    rng = random.Random(1)
    rows = [(i, [float(rng.choice([-0.5, -0.25, 0.0, 0.125, 0.3])) for _ in range(8)]) for i in range(400)]  # many ties
    assert answer(table(spark, rows), 20) == plain(rows, 20)


def test_odd_vectors(spark):
    rows = [(0, [0.5, -0.5]), (1, [0.5, -0.5]), (2, None), (3, []), (4, [0.5, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [-3.7, 2.2]), (8, [1.0, 2.0, 3.0]), (20, [0.0, 0.0]), (40, [1.0, 2.0, 2.0]),
            (None, [1.0, 1.0]), (60, [1e30, 1.0]), (-20, [1000.0, -1000.0]), (9, [0.25, 0.25])]
    beyond = [r for r in rows if r[0] != 60]  # too large to take part
    assert answer(table(spark, rows), 3) == plain(beyond, 3)


def test_large_vectors(spark):
    """Components far beyond those of embeddings, with sums up to 2^60."""
    rng = random.Random(2)
    rows = [(20, [3e5, 1.0]), (1, [3e5, 2.0]), (2, [-3e5, 0.5]), (40, [1.0, 3e5]), (3, [0.0, 0.0]), (60, [-1e7, 1e7])]
    rows += [(100 + i, [float(rng.randrange(-10**7, 10**7)), rng.choice([0.25, -0.5, 1.0])]) for i in range(60)]
    assert answer(table(spark, rows), 10) == plain(rows, 10)


def test_repeated_rows_and_empty_table(spark):
    rows = [(0, [0.5, 1.0]), (0, [0.5, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.1, 0.1])]
    got = answer(table(spark, rows), 20)
    assert [(i, s) for _, i, s in got[0]] == [(1, 96 * 64), (1, 96 * 64), (2, 6 * 96)]
    assert answer(table(spark, []), 20) == {}


def test_search_never_broadcasts_and_groups_blocks_of_queries(spark, monkeypatch):
    """Either side is repeated for the join, so its size before says nothing about a broadcast."""
    plans, store = {}, tk.stored

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(tk, "stored", seen)
    monkeypatch.setattr(tk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(tk, "BLOCK_QUERIES", 4)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-0.6, 0.6) for _ in range(8)]) for i in range(380)]
    rows += [(20 * i, [rng.uniform(-500, 500), 2e5 * i]) for i in range(20, 40)]  # weights of several widths
    rows += [(1000 + i, [rng.uniform(-1, 1), 1.0]) for i in range(10)]
    rows = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    df = table(spark, rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        for grid, group in ((256, 64), (8, 64), (1, 3)):  # groups of one, several and at most three blocks
            monkeypatch.setattr(tk, "GRID", grid, raising=False)
            monkeypatch.setattr(tk, "GROUP", group, raising=False)
            assert answer(df, 20) == plain(rows, 20)
            assert "Broadcast" not in plans["topk-found"] and "SortMergeJoin" in plans["topk-found"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
