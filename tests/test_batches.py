"""Small batches against large tables: what is exchanged, how many rounds chains take, and rows that pile up."""

import datetime

import pytest
from pyspark.sql import functions as F

from syncledger.operators import hierarchy as H
from syncledger.operators.exclude import Exclusions, is_excluded, is_excluded_up, prune_excluded
from syncledger.operators.reconcile import reconcile
from syncledger.operators.semijoin import matching
from syncledger.plans.download import download_changes_plan

FOLDER = "application/vnd.folder"
NODES = "file_id string, name string, parent_id string, mime_type string, md5sum string, " \
        "modified_time timestamp_ntz, size bigint, trashed boolean"
NOON = datetime.datetime(2024, 1, 1, 12)
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    """Only hinted broadcasts: any other join exchanges both sides."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    """Archive and local listing of 200,000 files, and the nodes of a batch of 1,000, as tables on disk."""
    base = str(tmp_path_factory.mktemp("big"))
    ids = spark.range(200_000)
    path = F.concat(F.lit("/r/d"), F.col("id") % 100, F.lit("/f"), F.col("id"))
    ids.select(path.alias("path"), F.concat(F.lit("f"), "id").alias("drive_id"),
               F.lit(NOON).cast("timestamp_ntz").alias("date_modified_on_disk"), F.lit("a").alias("md5sum")) \
        .write.parquet(f"{base}/archive")
    ids.select(path.alias("path"), F.lit(False).alias("is_dir"), F.lit(NOON).cast("timestamp_ntz").alias("mtime"),
               F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("md5sum"), F.lit(1).cast("bigint").alias("size")) \
        .write.parquet(f"{base}/local")
    return {t: spark.read.parquet(f"{base}/{t}") for t in ("archive", "local")}


def exchanged(df, table):
    """The shuffle exchanges between a scan of ``table`` (its folder's name) and the semi join above it, if any."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    stack, found = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, line))
        if "FileScan" in line and f"/{table}" in line:
            lines = [x for _, x in stack]
            cut = max((i for i, x in enumerate(lines) if "BroadcastHashJoin" in x and "LeftSemi" in x), default=0)
            found += [x for x in lines[cut:] if "Exchange" in x and "BroadcastExchange" not in x]
    assert f"/{table}" in plan
    return found


def test_a_batch_exchanges_no_large_table(spark, big, no_broadcast):
    batch = spark.range(1000).select((F.col("id") * 150).alias("id"))
    ids = batch.select(F.concat(F.lit("f"), "id").alias("file_id"))
    cut = matching(big["archive"], "drive_id", ids, "file_id")
    assert cut.count() == 1000 and not exchanged(cut, "archive")
    plain = big["archive"].join(ids.withColumnRenamed("file_id", "drive_id"), "drive_id", "left_semi")
    assert exchanged(plain, "archive")  # the same test sees an exchange where there is one


def test_a_batch_gives_the_rows_of_the_whole(spark, big, no_broadcast):
    nodes = spark.range(1000).select(
        F.when(F.col("id") % 7 == 0, F.concat(F.lit("new"), "id")).otherwise(F.concat(F.lit("f"), F.col("id") * 150))
        .alias("file_id"), F.lit("text/plain").alias("mime_type"), F.lit("b").alias("md5sum"),
        F.lit(NOON).cast("timestamp_ntz").alias("modified_time"))
    ex = Exclusions(("/r/d0/f150",), ("f300",))
    one = reconcile(nodes, big["archive"], big["local"], ex, batch=True)
    assert not exchanged(one, "local")
    whole = reconcile(nodes, big["archive"], big["local"], ex)
    assert one.exceptAll(whole).count() == 0 and one.count() == whole.count() == 1000


def test_more_keys_than_the_bound_leave_the_table(spark, big):
    assert matching(big["archive"], "drive_id", big["archive"].select("drive_id"), bound=10) is big["archive"]
    none = big["archive"].filter("false")
    assert matching(big["archive"], "drive_id", none).count() == 0


def test_the_plan_of_a_batch_of_events(spark, big, no_broadcast):
    """1,000 events: rows as by hand, and neither the archive nor the local listing is exchanged."""
    events = spark.range(1000).select(
        F.col("id").alias("seq"), F.concat(F.lit("f"), F.col("id") * 151).alias("file_id"), F.lit(False).alias("removed"),
        F.lit(False).alias("trashed"), F.concat(F.lit("f"), F.col("id") * 151).alias("name"),
        F.lit("text/plain").alias("mime_type"), F.lit("c").alias("md5sum"), F.lit("d").alias("parent_id"),
        F.lit(NOON).cast("timestamp_ntz").alias("modified_time"))
    remote = spark.createDataFrame([("d", "d", None, FOLDER, None, None, 0, False)], NODES)
    roots = spark.createDataFrame([("/r/d0/f0", "f0")], "path string, drive_id string")
    plan = download_changes_plan(events, remote, big["archive"], big["local"], Exclusions(), roots,
                                 datetime.datetime(2020, 1, 1), extra_root=("d", "/base"))
    rows = plan.collect()
    # the remote content is new; where the local copy is still the archived one the remote is ahead. f0 is a root.
    assert {r["seq"]: r["why"] for r in rows} == {i: "r" if 151 * i % 3 else "conflict" for i in range(1, 1000)}
    assert all(r["dest_path"].startswith("/base/f") for r in rows)
    assert not exchanged(plan, "local")


def chain(n, parent=None):
    return [(f"d{k}", f"d{k}", f"d{k - 1}" if k else parent, FOLDER, None, None, 0, False) for k in range(n)]


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    cut = H._cut_count
    monkeypatch.setattr(H, "_cut_count", lambda *a, **k: rounds.append(1) or cut(*a, **k))
    nodes = spark.createDataFrame(chain(1000), NODES)
    ids = spark.createDataFrame([("d999",), ("d500",), ("none",), (None,)], "file_id string")
    got = H.id_ancestors(nodes, ids).collect()
    assert len(rounds) <= 12
    assert sorted(r["depth"] for r in got if r["file_id"] == "d999") == list(range(1000))
    assert {r["ancestor_id"] for r in got if r["file_id"] == "d500"} == {f"d{k}" for k in range(501)}
    assert len(got) == 1501


def test_a_lineage_serves_many_batches(spark):
    nodes = spark.createDataFrame(chain(20), NODES)
    kept = H.lineage(nodes)
    archive = spark.createDataFrame([("/x", "d7")], "path string, drive_id string")
    changes = spark.createDataFrame([("f", "d12"), ("g", "d3"), ("h", "gone"), ("i", None)], "file_id string, parent_id string")
    rows = H.nearest_tracked_ancestor(changes, nodes, archive, ["d1"], ["d2"], kept=kept).collect()
    assert {r["file_id"]: (r["tracked_id"], r["mid_path"]) for r in rows} == {
        "f": ("d7", "d8/d9/d10/d11/d12"), "g": (None, None), "h": (None, None), "i": (None, None)}
    assert rows and {tuple(r) for r in rows} == {
        tuple(r) for r in H.nearest_tracked_ancestor(changes, nodes, archive, ["d1"], ["d2"]).collect()}


def test_only_what_meets_a_cycle_raises(spark):
    loop = [(a, a, b, FOLDER, None, None, 0, False) for a, b in (("p", "q"), ("q", "s"), ("s", "p"), ("in", "p"))]
    nodes = spark.createDataFrame(loop + chain(5) + [("leaf", "leaf", "in", "text/plain", "m", None, 1, False)], NODES)
    one = spark.createDataFrame([("d4",)], "file_id string")
    assert H.remote_path(nodes, one).first()["remote_path"] == "/d0/d1/d2/d3/d4"
    for start in ("p", "in", "leaf"):
        with pytest.raises(H.TreeCycle):
            H.id_ancestors(nodes, spark.createDataFrame([(start,)], "file_id string"))
    self_loop = spark.createDataFrame([("a", "a", "a", FOLDER, None, None, 0, False)], NODES)
    with pytest.raises(H.TreeCycle):
        H.id_ancestors(self_loop, spark.createDataFrame([("a",)], "file_id string"))


def test_a_path_listed_twice_is_one_exclusion(spark):
    rows = spark.createDataFrame([("/a", 1), ("/b", 2), (None, 3)], "path string, n int")
    out = is_excluded(rows, "path", Exclusions(("/a", "/a"))).collect()
    assert sorted((r["n"], r["excluded"]) for r in out) == [(1, True), (2, False), (3, False)]
    table = spark.createDataFrame([("/a",), ("/a",), (None,)], "path string")
    assert is_excluded(rows, "path", Exclusions(("/a",), paths_df=table)).count() == 3
    nodes = spark.createDataFrame([("f", "text/plain", "m", NOON)],
                                  "file_id string, mime_type string, md5sum string, modified_time timestamp_ntz")
    archive = spark.createDataFrame([("/a", "f", NOON, "x")],
                                    "path string, drive_id string, date_modified_on_disk timestamp_ntz, md5sum string")
    local = spark.createDataFrame([("/a", NOON, "y")], "path string, mtime timestamp_ntz, md5sum string")
    assert [r["why"] for r in reconcile(nodes, archive, local, Exclusions(("/a", "/a"))).collect()] == ["excluded"]


def test_rows_without_a_path_are_spread(spark, no_broadcast):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("/p"), "id")).alias("path"))
    out = is_excluded(rows, "path", Exclusions(paths_df=rows.select("path")))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    joined = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in joined and out.filter("excluded").count() == 2000
    key = "coalesce(path#" in joined or "__xkey" in joined
    assert key and max(sizes) < 20_000
    spread = rows.withColumn("k", F.coalesce("path", F.concat(F.lit("\0nopath:"), F.xxhash64("id", "path").cast("string"))))
    assert spread.select("k").distinct().count() == 20_000


def by_hand(path, paths, names, stops, include):
    """The ancestors from the path up to the nearest stop, one by one."""
    at = path
    while True:
        if at in stops and not include:
            return False
        if at in paths or at.rsplit("/", 1)[-1] in names:
            return True
        if at in stops or at == "/":
            return False
        at = at.rsplit("/", 1)[0] or "/"


def test_nested_stops(spark):
    tree = ["/", "/a", "/a/x", "/a/x/b", "/a/x/b/c", "/a/x/b/c/x", "/a/bx/c", "/x", "/x/y", "/ax", "/a/x/b/x/z", "/a/x/bb"]
    rows = spark.createDataFrame([(p,) for p in tree], "path string")
    for stops in ((), ("/a",), ("/a", "/a/x/b"), ("/a/x/b/", "/a"), ("/",), ("/", "/a/x"), ("/a/x/b/c/x", "/x")):
        for paths in ((), ("/a",), ("/a/x/b", "/x"), ("/",)):
            for names in ((), ("x",)):
                ex, plain = Exclusions(paths, names), {s.rstrip("/") or "/" for s in stops}
                up = {r["path"]: r["excluded"] for r in is_excluded_up(rows, "path", ex, stops).collect()}
                assert up == {p: by_hand(p, paths, names, plain, False) for p in tree}, (stops, paths, names)
                if stops:
                    down = {r["path"]: r["pruned"] for r in prune_excluded(rows, "path", ex, sorted(plain)).collect()}
                    under = {p for p in tree if any(p == s or p.startswith(s.rstrip("/") + "/") for s in plain)}
                    assert down == {p: by_hand(p, paths, names, plain, True) if p in under else None for p in tree}


@pytest.mark.parametrize("few", [True, False])
def test_excluded_ancestors_exchange_no_listing(spark, big, no_broadcast, few, monkeypatch):
    from syncledger.operators import exclude as X
    paths = spark.createDataFrame([("/r/d7",), ("/r/d8/f8",), ("/",), ("/r/d9/x",), ("/nowhere/a/b/c",)], "path string")
    if not few:
        monkeypatch.setattr(X, "MOST_DEPTHS", 2)  # the join of exploded ancestors
    for stops, hits in (([], 200_000), (["/r"], 2001), (["/r/d7"], 200_000 - 2000)):
        flagged = is_excluded_up(big["local"], "path", Exclusions((), (), paths), stops)
        assert flagged.filter("excluded").count() == hits
        assert not few or not exchanged(flagged, "local")


def counted(spark, df, col):
    """``df`` with a column read through a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def note(value):
        calls.add(1)
        return value

    return df.withColumn(col, F.udf(note, "string")(col)), calls


def test_updates_are_worked_out_once(spark, big):
    from syncledger.operators import catalog as U
    from syncledger.plans.download import apply_uploads
    rows = [(f"/r/d{k % 100}/f{k}", f"f{k}", False, NOON, "c", 1) for k in range(50)] + [("/r/d1/new", "n1", False, NOON, "c", 1)]
    results = spark.createDataFrame(rows, "path string, drive_id string, is_dir boolean, mtime timestamp_ntz, md5sum string, size bigint")
    for update in (U.record_uploads, lambda a, r: apply_uploads(spark.createDataFrame([], NODES), a, r)[1],
                   lambda a, r: U.upsert_changes(a, r.withColumnRenamed("mtime", "date_modified_on_disk").withColumn("seq", F.lit(1)))):
        given, calls = counted(spark, results, "drive_id")
        after = update(big["archive"], given)
        assert after.filter("md5sum = 'c'").count() == 51 and calls.value == 51


def test_names_without_a_number_are_not_exchanged(spark):
    from test_tree import exchanged_bytes
    from syncledger.operators.ordering import free_name
    local = spark.range(20_000).select(F.concat(F.lit("/d/"), F.sha2(F.col("id").cast("string"), 256)).alias("path")) \
        .unionByName(spark.createDataFrame([("/d/a (4).txt",), ("/d/a.txt",)], "path string"))
    plan = spark.createDataFrame([(1, "/d/a.txt"), (2, "/d/b.txt")], "seq int, dest_path string")
    out = free_name(plan, local)
    assert exchanged_bytes(out) < 100_000
    assert {r["free_path"] for r in out.collect()} == {"/d/a (5).txt", "/d/b (1).txt"}


def test_parents_have_their_chains_without_the_listing(spark, no_broadcast):
    nodes = spark.createDataFrame(chain(20) + [("leaf", "leaf", "d19", "text/plain", "m", None, 1, False)], NODES)
    kept = H.lineage(nodes)
    listing, calls = counted(spark, nodes.select("file_id", "parent_id", "name"), "name")
    ids = spark.createDataFrame([("d12",), ("d19",), ("d12",), (None,)], "file_id string")
    got = {r["start_id"]: (len(r["chain"]), r["found"]) for r in H.chains(listing, ids, kept=kept).collect()}
    assert got == {"d12": (13, True), "d19": (20, True), None: (0, False)} and calls.value == 0
    ids = spark.createDataFrame([("d12",), ("leaf",), ("gone",), (None,)], "file_id string")
    got = {r["start_id"]: (len(r["chain"]), r["found"]) for r in H.chains(listing, ids, kept=kept).collect()}
    assert got == {"d12": (13, True), "leaf": (21, True), "gone": (0, False), None: (0, False)} and calls.value > 0
    with pytest.raises(H.TreeTooDeep):
        H.chains(listing, ids, max_depth=15, kept=kept)


def test_roots_exchange_no_archive(spark, big, no_broadcast):
    from syncledger.operators.diff import tracked_roots
    roots = spark.createDataFrame([("/r/d5/f5",), ("/r/d7/f100007",), ("/nowhere",)], "path string")
    tracked = tracked_roots(roots, big["archive"])
    assert {tuple(r) for r in tracked.collect()} == {("f5", "/r/d5/f5"), ("f100007", "/r/d7/f100007")}
    assert not exchanged(tracked, "archive")


def test_the_plan_of_events_keeps_what_ids_say_twice(spark):
    """An archived id with two paths gives two destinations; roots, ignored ids and events without ids or parents none."""
    remote = spark.createDataFrame([("d", "d", None, FOLDER, None, None, 0, False), ("e", "e", "d", FOLDER, None, None, 0, False)],
                                   NODES)
    archive = spark.createDataFrame([("/one", "d", NOON, ""), ("/two", "d", NOON, "")], "path string, drive_id string, "
                                    "date_modified_on_disk timestamp_ntz, md5sum string")
    local = spark.createDataFrame([], "path string, is_dir boolean, mtime timestamp_ntz, md5sum string, size bigint")
    events = spark.createDataFrame(
        [(k, i, False, False, "x", "text/plain", "m", p, NOON) for k, (i, p) in enumerate(
            [("a", "e"), ("d", "e"), ("skip", "e"), (None, "e"), ("b", None), ("c", "gone")])],
        "seq bigint, file_id string, removed boolean, trashed boolean, name string, mime_type string, md5sum string, "
        "parent_id string, modified_time timestamp_ntz")
    plan = download_changes_plan(events, remote, archive, local, Exclusions(), spark.createDataFrame([("/one",)], "path string"),
                                 datetime.datetime(2020, 1, 1), ignored_ids=("skip",))
    assert sorted((r["seq"], r["dest_path"], r["root_parent_id"]) for r in plan.collect()) == [
        (0, "/one/e/x", "d"), (0, "/two/e/x", "d")]
