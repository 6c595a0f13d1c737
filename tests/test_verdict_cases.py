"""Rows that tell right answers from plausible ones: each was wrong once."""
import datetime as dt
import mimetypes

import pytest

from syncledger.functions.mime import guess_mime
from syncledger.operators import catalog as U
from syncledger.operators import diff as D
from syncledger.operators import hierarchy as H
from syncledger.operators.exclude import Exclusions
from syncledger.operators.ordering import assign_batches, free_name
from syncledger.plans import upload as PU
from syncledger.sources import store
from syncledger.sources.listing import scan_local

ARCHIVE = "path string, drive_id string, date_modified_on_disk timestamp_ntz, md5sum string"
NODES = ("file_id string, name string, parent_id string, mime_type string, md5sum string, modified_time timestamp_ntz, "
         "size bigint, trashed boolean")
FOLDER = "application/vnd.folder"


def day(n):
    return dt.datetime(2024, 1, n)


def chain(n):
    return [(f"d{k}", f"d{k}", f"d{k - 1}" if k else None, FOLDER, None, None, 0, False) for k in range(n)]


def test_updates_apply_in_order(spark):
    archive = spark.createDataFrame([("/p", "1", day(1), "a"), ("/q", "2", day(1), "b")], ARCHIVE)
    updates = spark.createDataFrame(
        [("/p", None, day(3), "path3", 3), ("/p", "1", day(5), "id5", 5), ("/q", "2", day(2), "id2", 2),
         ("/q", None, day(4), "path4", 4)], ARCHIVE + ", seq long")
    got = {r["drive_id"]: r["md5sum"] for r in U.upsert_archive(archive, updates).collect()}
    assert got == {"1": "id5", "2": "path4"}


def test_path_clash_is_reported(spark):
    archive = spark.createDataFrame([("/p", "1", day(1), "a"), ("/q", "2", day(1), "b")], ARCHIVE)
    clash = spark.createDataFrame([("/q", "1", day(2), "c", 1)], ARCHIVE + ", seq long")
    with pytest.raises(U.UniquenessError):
        U.upsert_archive(archive, clash, check=True)
    swap = spark.createDataFrame([("/q", "1", day(2), "c", 1), ("/p", "2", day(2), "d", 2)], ARCHIVE + ", seq long")
    assert U.upsert_archive(archive, swap, check=True).count() == 2
    with pytest.raises(U.UniquenessError):
        U.insert_archive(archive, spark.createDataFrame([("/new", "2", day(1), "x")], ARCHIVE))
    assert U.insert_archive(archive, spark.createDataFrame([("/new", "3", day(1), "x")], ARCHIVE)).count() == 3


def test_linked_path_leaves_its_other_id(spark):
    archive = spark.createDataFrame([("/p", "old", day(1), "")], ARCHIVE)
    local = spark.createDataFrame([("/p", True, day(1), None, 0), ("/p/f", False, day(2), "m", 3)],
                                  "path string, is_dir boolean, mtime timestamp_ntz, md5sum string, size bigint")
    plan = PU.upload_sync_plan(local, archive, Exclusions(), "new", "/p").collect()
    assert [(r["path"], r["parent_id"]) for r in plan] == [("/p/f", "new")]


def test_free_names_are_free(spark):
    rows = [(1, "/d/a.txt"), (2, "/d/a (1).txt"), (3, "/d/a.txt"), (4, None), (5, "/d/b (12345678901234567890).txt")]
    plan = spark.createDataFrame(rows, "seq int, dest_path string")
    local = spark.createDataFrame([("/d/a.txt",), ("/d/a (1).txt",)], "path string")
    got = {r["seq"]: r["free_path"] for r in free_name(plan, local).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[4] is None
    named = [p for p in got.values() if p]
    assert len(set(named)) == 4 and not set(named) & {"/d/a.txt", "/d/a (1).txt"}


def test_batches_keep_null_groups(spark):
    rows = spark.createDataFrame([(f"f{i}", None if i % 2 else "g") for i in range(100)], "file_id string, kind string")
    out = assign_batches(rows, 32, by=["kind"], order="file_id").collect()
    assert len(out) == 100
    assert sorted(r["batch"] for r in out if r["kind"] is None) == [0] * 32 + [1] * 18


def test_a_deep_chain_has_no_limit(spark):
    nodes = spark.createDataFrame(chain(70), NODES)
    assert H.walk(nodes, "d0").count() == 70
    assert H.id_ancestors_all(nodes).filter("file_id = 'd69'").count() == 70
    ids = spark.createDataFrame([("d69",)], "file_id string")
    assert H.remote_path(nodes, ids).first()["remote_path"].count("/") == 70


def test_cycles_are_told_by_id(spark):
    loop = [("p", "p", "r", FOLDER, None, None, 0, False), ("q", "q", "p", FOLDER, None, None, 0, False),
            ("r", "r", "q", FOLDER, None, None, 0, False), ("f", "f", "r", "text/plain", "m", None, 1, False)]
    nodes = spark.createDataFrame(loop + chain(3), NODES)
    with pytest.raises(H.TreeCycle):
        H.id_ancestors_all(nodes)
    with pytest.raises(H.TreeCycle):
        H.walk(nodes, "p")
    with pytest.raises(H.TreeCycle):
        H.id_ancestors(nodes, spark.createDataFrame([("f",)], "file_id string"))
    assert H.walk(nodes, "d0").count() == 3


def test_any_number_of_depths(spark):
    """Depths up to 5,000, none of them lost."""
    deep = ["/" + "/".join("a" * d) for d in range(1, 5001, 500)]
    archive = spark.createDataFrame([(p + "/leaf", str(i)) for i, p in enumerate(deep)], "path string, drive_id string")
    one = spark.createDataFrame([(deep[-1],), (deep[4],)], "path string")
    got = D.descendants_join(archive, one).groupBy("matched_path").count().collect()
    assert {len(r["matched_path"]): r["count"] for r in got} == {len(deep[-1]): 1, len(deep[4]): 6}
    tops = H.topmost(spark.createDataFrame([(p,) for p in deep] + [("/b",)], "path string"))
    assert {r["path"] for r in tops.collect()} == {"/a", "/b"}


def test_prefixes_in_one_flat_folder_stay_linear(spark):
    """2,000 patterns and 3,000 rows in one folder: the rows between are bounded by the lengths, not by the pairs."""
    archive = spark.createDataFrame([(f"/flat/f{i:05d}.txt", str(i)) for i in range(3000)], "path string, drive_id string")
    patterns = spark.createDataFrame([(f"/flat/f{i:05d}",) for i in range(2000)], "path string")
    out = D.descendants_join(archive, patterns, mode="prefix")
    assert out.count() == 2000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" not in plan and "Cartesian" not in plan
    contained = D.descendants_join(archive, patterns.limit(50), mode="contains")
    assert contained.count() == 50 and "Python" not in contained._jdf.queryExecution().executedPlan().toString()


def test_scan_with_a_scheme_lists_folders(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.txt").write_text("x")
    plain = {r["path"] for r in scan_local(spark, str(tmp_path)).collect()}
    assert {r["path"] for r in scan_local(spark, f"file://{tmp_path}").collect()} == plain
    assert {r["path"] for r in scan_local(spark, f"file:{tmp_path}").collect()} == plain
    assert plain == {str(tmp_path), f"{tmp_path}/sub", f"{tmp_path}/sub/x.txt"}


def test_a_lost_version_log_is_an_error(spark, tmp_path):
    base = str(tmp_path / "archive")
    rows = spark.createDataFrame([("/p", "1", day(1), "a")], ARCHIVE)
    assert store.write_archive(rows, base) == 0 and store.write_archive(rows, base) == 1
    assert store.read_archive(spark, base).count() == 1
    for f in (tmp_path / "archive" / "_versions").iterdir():
        f.unlink()
    with pytest.raises(RuntimeError):
        store.write_archive(rows, base)
    assert spark.read.parquet(f"{base}/version=0").count() == 1


def test_mime_types_equal_the_registry(spark):
    names = ["a.tar.gz", "a.gz", "a.tgz", "a.svgz", "a.TXT", "a.csv", ".bashrc", "a", "a.b.json", "x.unknown", "a.tar.Z",
             "a.html.bz2", "a.", "..a.png", "a.jpeg", "a.docx", "a.GZ", "A.TGZ", "a.tar.xz"]
    rows = spark.createDataFrame([(f"/d.e/{n}",) for n in names], "path string")
    got = {r["path"][5:]: r["mime_type"] for r in guess_mime(rows).collect()}
    registry = mimetypes.MimeTypes()
    assert got == {n: registry.guess_type(f"/d.e/{n}")[0] or "application/octet-stream" for n in names}
