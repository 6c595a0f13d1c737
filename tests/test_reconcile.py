"""Decision table of the three-way reconciliation, row by row, with NULL md5s,
folders, and the whole-second truncation of the remote time."""
import datetime as dt

from syncledger.operators.exclude import Exclusions
from syncledger.operators.reconcile import collides, needs_upload, reconcile

FOLDER = "application/vnd.folder"
T0 = dt.datetime(2020, 1, 1, 10, 0, 0)


def ts(sec=0.0):
    return T0 + dt.timedelta(seconds=sec)


# (file_id, mime, remote md5, remote time, archive path, archive md5, archive time, local md5, local time, want)
ROWS = [
    ("new", "text/csv", "R", ts(), None, None, None, None, None, "new"),
    ("excl_path", "text/csv", "R", ts(), "/ex", "A", ts(), "L", ts(), "excluded"),
    ("excl_rule", "text/csv", "R", ts(), "/d/x.pyc", "A", ts(), "L", ts(), "excluded"),
    ("gone", "text/csv", "R", ts(), "/d/gone", "A", ts(), None, None, "gone"),
    ("p", "text/csv", "A", ts(), "/d/p", "A", ts(), "L", ts(), "p"),
    ("q", "text/csv", "L", ts(), "/d/q", "A", ts(), "L", ts(), "q"),
    ("r", "text/csv", "R", ts(), "/d/r", "A", ts(), "A", ts(), "r"),
    ("older", "text/csv", "R", ts(-10), "/d/older", "A", ts(), "L", ts(-20), "older"),
    ("older_local", "text/csv", "R", ts(-10), "/d/older_local", "A", ts(-20), "L", ts(), "older"),
    ("conflict", "text/csv", "R", ts(10), "/d/conflict", "A", ts(), "L", ts(), "conflict"),
    ("folder_p", FOLDER, None, ts(-99), "/d/fold", "", ts(), None, ts(), "p"),
    ("folder_null_archive", FOLDER, None, ts(-99), "/d/fold2", None, ts(), None, ts(), "r"),
    ("file_no_md5", "text/csv", None, ts(10), "/d/nomd5", None, ts(), "L", ts(), "conflict"),
    ("trunc", "text/csv", "R", ts(0.5), "/d/trunc", "A", ts(0.3), "L", ts(), "older"),
]

DECISION = {"new": 1, "r": 1, "gone": -1, "conflict": -1}


def frames(spark):
    nodes = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in ROWS],
                                  "file_id string, mime_type string, md5sum string, modified_time timestamp_ntz")
    archive = spark.createDataFrame([(r[4], r[0], r[6], r[5]) for r in ROWS if r[4]],
                                    "path string, drive_id string, date_modified_on_disk timestamp_ntz, md5sum string")
    local = spark.createDataFrame([(r[4], r[1] == FOLDER, r[8], r[7], 1) for r in ROWS if r[4] and r[8]],
                                  "path string, is_dir boolean, mtime timestamp_ntz, md5sum string, size bigint")
    return nodes, archive, local


def test_truth_table(spark):
    nodes, archive, local = frames(spark)
    ex = Exclusions(paths=("/ex",), rules=("*.pyc",))
    got = {r["file_id"]: (r["why"], r["decision"]) for r in reconcile(nodes, archive, local, ex).collect()}
    for r in ROWS:
        assert got[r[0]] == (r[9], DECISION.get(r[9], 0)), r[0]


def test_total_and_single_valued(spark):
    nodes, archive, local = frames(spark)
    out = reconcile(nodes, archive, local, Exclusions())
    assert out.count() == nodes.count()
    assert out.filter("why IS NULL OR decision IS NULL").count() == 0


def test_folder_time_switch(spark):
    # A folder with differing md5s falls to the time test only when times are passed.
    nodes = spark.createDataFrame([("f", FOLDER, "X", ts(-50))], "file_id string, mime_type string, md5sum string, "
                                  "modified_time timestamp_ntz")
    archive = spark.createDataFrame([("/f", "f", ts(), "A")], "path string, drive_id string, "
                                    "date_modified_on_disk timestamp_ntz, md5sum string")
    local = spark.createDataFrame([("/f", True, ts(), "L", 0)], "path string, is_dir boolean, mtime timestamp_ntz, "
                                  "md5sum string, size bigint")
    walk = reconcile(nodes, archive, local, Exclusions()).first()["why"]
    feed = reconcile(nodes, archive, local, Exclusions(), folder_time=True).first()["why"]
    assert (walk, feed) == ("conflict", "older")


def test_needs_upload_and_collides(spark):
    local = spark.createDataFrame([("/n", False, ts(), "x", 1), ("/u", False, ts(5), "x", 1),
                                   ("/same", False, ts(), "x", 1), ("/dir", True, ts(9), None, 0)],
                                  "path string, is_dir boolean, mtime timestamp_ntz, md5sum string, size bigint")
    archive = spark.createDataFrame([("/u", "u", ts()), ("/same", "s", ts()), ("/dir", "d", ts())],
                                    "path string, drive_id string, date_modified_on_disk timestamp_ntz")
    got = {r["path"]: r["op"] for r in needs_upload(local, archive).collect()}
    assert got == {"/n": "NEW", "/u": "UPDATE"}
    plan = spark.createDataFrame([("/n",), ("/x",), ("/x",)], "dest_path string")
    rows = sorted((r["dest_path"], r["exists_locally"], r["dup_dest"]) for r in collides(plan, local).collect())
    assert rows == [("/n", True, False), ("/x", False, True), ("/x", False, True)]
