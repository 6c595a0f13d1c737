import pytest
from pyspark.sql import functions as F

from syncledger.operators import diff as D
from syncledger.operators import hierarchy as H

FOLDER = "application/vnd.folder"
COLS = "file_id string, name string, parent_id string, mime_type string, md5sum string, " \
       "modified_time timestamp_ntz, size bigint, trashed boolean"


def node(i, name, parent, folder=True, trashed=False):
    return (i, name, parent, FOLDER if folder else "text/plain", None if folder else "m", None, 0, trashed)


@pytest.fixture(scope="module")
def remote(spark):
    rows = [node("r", "r", None), node("a", "a", "r"), node("b", "b", "a"), node("f", "f", "b", folder=False),
            node("t", "t", "a", trashed=True), node("u", "u", "t", folder=False),
            node("x", "x", "y"), node("y", "y", "x")]
    return spark.createDataFrame(rows, COLS)


def test_walk_skips_trashed_subtrees(remote):
    got = {r["file_id"]: r["path"] for r in H.walk(remote, "a").collect()}
    assert got == {"a": "a", "b": "a/b", "f": "a/b/f"}
    assert H.walk(remote, "missing").count() == 0


def test_walk_where_cuts_folders(remote):
    cut = {r["file_id"] for r in H.walk(remote, "r", where=F.col("name") != "b").collect()}
    keep = {r["file_id"] for r in H.walk(remote, "r", where=F.col("name") != "b", where_files_only=True).collect()}
    assert cut == {"r", "a"} and keep == {"r", "a", "b", "f"}


def test_remote_path_and_stop(spark, remote):
    ids = spark.createDataFrame([("f",), ("a",), ("nope",)], "file_id string")
    top = {r["file_id"]: r["remote_path"] for r in H.remote_path(remote.filter("file_id NOT IN ('x','y')"), ids)
           .collect()}
    assert top == {"f": "/r/a/b/f", "a": "/r/a", "nope": None}
    rel = {r["file_id"]: r["remote_path"] for r in H.remote_path(remote, ids, stop_id="a").collect()}
    assert rel["f"] == "/b/f" and rel["a"] == "/"


def test_cycle_guard(spark, remote):
    ids = spark.createDataFrame([("x",)], "file_id string")
    with pytest.raises(H.TreeTooDeep):
        H.id_ancestors(remote, ids, max_depth=6).collect()


def test_nearest_tracked(spark, remote):
    archive = spark.createDataFrame([("/r/a", "a")], "path string, drive_id string")
    changes = spark.createDataFrame([("f", "b"), ("b", "a"), ("a", "r"), ("z", None)], "file_id string, parent_id string")
    got = {r["file_id"]: (r["tracked_id"], r["mid_path"]) for r in
           H.nearest_tracked_ancestor(changes, remote, archive, root_ids=["r"]).collect()}
    assert got == {"f": ("a", "b"), "b": ("a", ""), "a": ("r", ""), "z": (None, None)}
    blocked = {r["file_id"]: r["tracked_id"] for r in
               H.nearest_tracked_ancestor(changes, remote, archive, ["r"], ignored_ids=["b"]).collect()}
    assert blocked["f"] is None and blocked["b"] is None and blocked["a"] == "r"


def test_is_ancestor(spark, remote):
    pairs = spark.createDataFrame([("a", "f"), ("f", "f"), ("b", "a")], "folder_id string, file_id string")
    got = {(r["folder_id"], r["file_id"]): r["is_ancestor"] for r in H.is_ancestor(remote, pairs).collect()}
    assert got == {("a", "f"): True, ("f", "f"): True, ("b", "a"): False}


def test_prefix_vs_descendant_and_topmost(spark):
    archive = spark.createDataFrame([("/a/b", "1"), ("/a/b/c", "2"), ("/a/bc", "3"), ("/z", "4")],
                                    "path string, drive_id string")
    paths = spark.createDataFrame([("/a/b",)], "path string")
    desc = {r["path"] for r in D.descendants_join(archive, paths).collect()}
    pref = {r["path"] for r in D.descendants_join(archive, paths, mode="prefix").collect()}
    cont = {r["path"] for r in D.descendants_join(archive, spark.createDataFrame([("b",)], "path string"),
                                                  mode="contains").collect()}
    assert desc == {"/a/b", "/a/b/c"} and pref == {"/a/b", "/a/b/c", "/a/bc"} and cont == pref
    tops = {r["path"] for r in H.topmost(archive.select("path")).collect()}
    assert tops == {"/a/b", "/a/bc", "/z"}


def test_subtree_rollup(spark):
    local = spark.createDataFrame([("/a/x", False, 2), ("/a/b/y", False, 3), ("/a", True, 0)],
                                  "path string, is_dir boolean, size bigint")
    got = {r["folder"]: (r["n_files"], r["bytes"]) for r in H.subtree_rollup(local).collect()}
    assert got == {"/": (2, 5), "/a": (2, 5), "/a/b": (1, 3)}


def test_contains_equals_substring_test(spark, inv):
    archive = inv.A.select("path", "drive_id")
    pats = archive.filter(F.col("path").endswith(".tmp")).select("path").limit(40)
    want = archive.crossJoin(F.broadcast(pats.withColumnRenamed("path", "matched_path"))) \
        .filter(F.col("path").contains(F.col("matched_path")))
    got = D.descendants_join(archive, pats, mode="contains")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() > 0


def exchanged_bytes(df):
    """What the shuffle exchanges of a plan that has run have written."""
    plan, total, stack = df._jdf.queryExecution().executedPlan(), 0, []
    df.collect()
    stack.append(plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan)
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "Exchange":
            total += node.metrics().apply("shuffleBytesWritten").value()
        stack += [node.plan()] if name in ("ShuffleQueryStage", "BroadcastQueryStage") else []
        children = node.children()
        stack += [children.apply(k) for k in range(children.size())]
    return total


def test_grams_of_paths_are_not_exchanged(spark, tmp_path):
    spark.range(20_000).select(F.concat(F.lit("/r/"), F.sha2(F.col("id").cast("string"), 256)).alias("path"),
                               F.col("id").cast("string").alias("drive_id")).write.parquet(str(tmp_path / "a"))
    archive = spark.read.parquet(str(tmp_path / "a"))  # some 60 grams a path
    pats = archive.filter("drive_id < '11'").select(F.substring("path", 20, 20).alias("path"))
    got = D.descendants_join(archive, pats, mode="contains")
    assert exchanged_bytes(got) < 1_000_000  # the paths alone are over 1 MB
    want = archive.crossJoin(F.broadcast(pats.withColumnRenamed("path", "matched_path"))) \
        .filter(F.col("path").contains(F.col("matched_path")))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0


def test_prefixes_from_any_separator_on(spark):
    names = ["/", "/a", "/a/b", "/a/b/c", "/b/a/b", "/b/a/bc", "/a/a/a", "/c/é/ab", "/é/a"]
    archive = spark.createDataFrame([(p, str(k)) for k, p in enumerate(names)], "path string, drive_id string")
    pats = ["/", "/a", "/a/", "/a/b", "/b/a", "/é", "/é/a", "/a/a", "/x", "/b"]
    patterns = spark.createDataFrame([(p,) for p in pats], "path string")
    for mode, test in (("prefix", str.startswith), ("contains", str.__contains__)):
        got = D.descendants_join(archive, patterns, mode=mode).select("path", "matched_path").collect()
        assert sorted(map(tuple, got)) == sorted((n, p) for n in names for p in pats if test(n, p))


def test_depth_guard_counts_levels(spark):
    chain = [node("d0", "d0", None)] + [node(f"d{k}", f"d{k}", f"d{k - 1}") for k in range(1, 6)]
    remote = spark.createDataFrame(chain, COLS)
    assert H.walk(remote, "d0", max_depth=5).count() == 6   # exactly deep enough
    with pytest.raises(H.TreeTooDeep):
        H.walk(remote, "d0", max_depth=4).collect()
    cyc = spark.createDataFrame([node("p", "p", "q"), node("q", "q", "p")], COLS)
    with pytest.raises(H.TreeTooDeep):
        H.walk(cyc, "p", max_depth=8).collect()
