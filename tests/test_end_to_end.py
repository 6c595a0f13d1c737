"""A real directory tree through the whole upload cycle: scan (S1), plan (P1),
record the results (U5), publish a snapshot (S9), read it back (S6), re-plan."""
import os
import time

from pyspark.sql import functions as F

from syncledger.operators import catalog as U
from syncledger.operators.exclude import Exclusions
from syncledger.plans.upload import upload_plan
from syncledger.sources.listing import scan_local
from syncledger.sources.store import read_archive, write_archive


def test_upload_cycle(spark, tmp_path):
    root = tmp_path / "home"
    for rel, data in [("docs/a.txt", b"a"), ("docs/b.pyc", b"b"), ("src/x/y.py", b"y"), ("skip/z.txt", b"z")]:
        f = root / rel
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(data)
    base = os.path.realpath(str(root))
    ex = Exclusions(paths=(f"{base}/skip",), rules=("*.pyc",))
    empty = spark.createDataFrame([], "path string, drive_id string, date_modified_on_disk timestamp_ntz, "
                                      "md5sum string")
    local = scan_local(spark, str(root), with_md5=True)
    plan = upload_plan(local, empty, ex, [base], root_id="root")
    got = {r["path"][len(base):] or "/": (r["op"], r["type"]) for r in plan.collect()}
    assert got == {"/": ("NEW", "#folder"), "/docs": ("NEW", "#folder"), "/docs/a.txt": ("NEW", "#file"),
                   "/src": ("NEW", "#folder"), "/src/x": ("NEW", "#folder"), "/src/x/y.py": ("NEW", "#file")}
    # the root goes under the given remote folder; the rest under folders the plan creates
    assert plan.filter(F.col("path") == base).first()["parent_id"] == "root"
    results = plan.join(local.select("path", "mtime", "md5sum", "is_dir"), "path").select(
        "path", F.concat(F.lit("id-"), F.md5("path")).alias("drive_id"), "mtime",
        F.when(F.col("is_dir"), F.lit("")).otherwise(F.col("md5sum")).alias("md5sum"))
    store = str(tmp_path / "archive")
    write_archive(U.record_uploads(empty, results), store)
    archive = read_archive(spark, store)
    assert upload_plan(scan_local(spark, str(root), with_md5=True), archive, ex, [base]).count() == 0
    # a newer file is an UPDATE with its archived id; its folder is not touched
    time.sleep(1.1)
    (root / "docs" / "a.txt").write_bytes(b"changed")
    again = upload_plan(scan_local(spark, str(root), with_md5=True), archive, ex, [base]).collect()
    assert [(r["path"][len(base):], r["op"], r["drive_id"] is not None) for r in again] == [("/docs/a.txt", "UPDATE", True)]
