"""Interval labels, running aggregates and the ordered scan for topmost paths, against plain walks and loops."""
import random

import pytest
from pyspark.sql import functions as F

from syncledger.operators import hierarchy as H
from syncledger.operators import intervals as I
from syncledger.operators.scan import running

FOLDER = "application/vnd.folder"
NODES = ("file_id string, name string, parent_id string, mime_type string, md5sum string, modified_time timestamp_ntz, "
         "size bigint, trashed boolean")


def listing(spark, rows):
    """rows: (id, parent, is_folder, trashed)"""
    return spark.createDataFrame([(i, f"n{i}", p, FOLDER if d else "text/csv", None, None, 1, t) for i, p, d, t in rows], NODES)


def random_rows(rnd, n):
    """A forest with tops, an unlisted parent, trashed nodes, files that have children, and one folder with a third of all."""
    rows = [("top", None, True, False), ("lost", "nowhere", True, False), ("lost2", "nowhere", False, False)]
    folders = ["top", "lost"]
    for k in range(n):
        parent = "top" if k % 3 == 0 else rnd.choice(folders)
        is_folder = rnd.random() < 0.4
        rows.append((f"x{k}", parent, is_folder, rnd.random() < 0.15))
        if is_folder or rnd.random() < 0.05:
            folders.append(f"x{k}")
    return rows


def preorder(rows):
    kids, ids = {}, {i for i, *_ in rows}
    for i, p, *_ in rows:
        kids.setdefault(p if p in ids else None, []).append(i)
    out, count = {}, [0]

    def visit(i, depth, path):
        at, path = count[0], f"{path}/n{i}"
        count[0] += 1
        for c in sorted(kids.get(i, [])):
            visit(c, depth + 1, path)
        out[i] = (at, count[0] - 1, depth, path)
    # all tops have the same group only when their parent is not listed
    for i in sorted(kids.get(None, [])):
        visit(i, 0, "")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_labels_are_a_preorder(spark, seed):
    rows = random_rows(random.Random(seed), 120)
    got = {r["file_id"]: (r["enter"], r["exit"], r["depth"], r["remote_path"])
           for r in I.interval_labels(listing(spark, rows)).collect()}
    assert got == preorder(rows)


def test_labels_of_deep_chains_empty_listings_and_cycles(spark):
    chain = [(f"c{k:04}", f"c{k - 1:04}" if k else None, True, False) for k in range(300)]
    got = {r["file_id"]: (r["enter"], r["exit"]) for r in I.interval_labels(listing(spark, chain)).collect()}
    assert got == {f"c{k:04}": (k, 299) for k in range(300)}
    assert I.interval_labels(listing(spark, chain).limit(0)).count() == 0
    with pytest.raises(H.TreeCycle):
        I.interval_labels(listing(spark, [("a", "b", True, False), ("b", "a", True, False), ("c", "a", False, False)]))


def test_ancestors_and_walks_equal_those_of_the_listing(spark, tmp_path):
    rnd = random.Random(7)
    rows = random_rows(rnd, 150)
    remote = listing(spark, rows)
    labelled = I.write_labelled(remote, str(tmp_path / "labelled"), 3)
    ids = [i for i, *_ in rows] + ["absent", None]
    pairs = spark.createDataFrame([(rnd.choice(ids), rnd.choice(ids)) for _ in range(300)] + [("top", "top")],
                                  "folder_id string, file_id string").distinct()
    got = {tuple(r) for r in I.is_ancestor_labelled(labelled, pairs).collect()}
    assert got == {tuple(r) for r in H.is_ancestor(remote, pairs.dropna()).collect()} | {
        (r[0], r[1], False) for r in pairs.filter("folder_id IS NULL OR file_id IS NULL").collect()}
    cols = ["file_id", "path", "depth", "type", "is_root"]
    for root in ("top", "lost", "lost2", "absent", *[i for i, p, d, t in rows if t][:2]):
        want = sorted(tuple(r) for r in H.walk(remote, root).select(*cols).collect())
        assert sorted(tuple(r) for r in I.walk_labelled(labelled, root).select(*cols).collect()) == want, root


def test_a_subtree_is_a_pushed_range(spark, tmp_path):
    labelled = I.write_labelled(listing(spark, random_rows(random.Random(3), 60)), str(tmp_path / "labelled"))
    plan = I.subtree(labelled, "top")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(enter" in plan and "LessThanOrEqual(enter" in plan and "Exchange" not in plan


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_with_a_hot_group_nulls_and_empty_tables(spark, by):
    rnd = random.Random(5)
    rows = [(None if k % 11 == 0 else "hot" if k % 3 else f"g{k % 7}", k, None if k % 5 == 0 else rnd.randint(-9, 9))
            for k in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    groups = {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(g if by else 0, []).append((k, v))
    for how in ("sum", "max"):
        want = {}
        for members in groups.values():
            for at, (k, _) in enumerate(members):
                before = [v for _, v in members[:at] if v is not None]
                want[k] = sum(before) if how == "sum" else max(before, default=None)
        got = {r["k"]: r["o"] for r in running(df, by, ["k"], "v", how, "o", 5).collect()}
        assert got == want, how
        assert running(df.limit(0), by, ["k"], "v", how, "o").count() == 0


def plain_topmost(paths, mode):
    def above(o, p):
        return p.startswith(o) if mode == "prefix" else o == "/" or p.startswith(o + "/")
    return sorted(p for p in set(paths) if not any(o != p and above(o, p) for o in paths))


@pytest.mark.parametrize("mode", ["descendant", "prefix"])
def test_topmost_paths_sort_with_the_separator_lowest(spark, mode):
    rnd = random.Random(9)
    names = ["a", "a b", "a-b", "a.b", "a!", "b", "\u0001", "a\u0001", "é", "\U0001f600", "ab"]
    some = ["/" + "/".join(rnd.choice(names) for _ in range(rnd.randint(1, 5))) for _ in range(150)]
    for paths in (some, [p for p in some if p.count("/") > 2], ["/", *some], some + some, ["/a", "/a b", "/a/c", "/a b/c"], []):
        df = spark.createDataFrame([(p,) for p in paths], "path string")
        assert sorted(r[0] for r in H.topmost(df, mode=mode).collect()) == plain_topmost(paths, mode)


def test_topmost_exchanges_a_row_a_path(spark):
    deep = spark.range(20).select(F.concat(F.lit("/"), F.array_join(F.array_repeat(F.lit("d"), 60), "/"), F.lit("/"),
                                           "id").alias("path"))
    plan = H.topmost(deep)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and H.topmost(deep).count() == 20
