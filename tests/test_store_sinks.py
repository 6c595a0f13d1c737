import hashlib
import os

from pyspark.sql import functions as F

from syncledger.sources.listing import scan_local
from syncledger.sources.sinks import write_transfer_log, write_tree_report
from syncledger.sources.store import latest_version, read_archive, write_archive


def test_snapshots(spark, inv, tmp_path):
    base = str(tmp_path / "archive")
    assert latest_version(spark, base) is None
    assert write_archive(inv.A, base) == 0
    smaller = inv.A.limit(10)
    assert write_archive(smaller, base) == 1
    assert read_archive(spark, base).count() == 10
    assert read_archive(spark, base, version=0).count() == inv.A.count()


def test_scan_local(spark, tmp_path):
    root = tmp_path / "tree"
    (root / "a" / "b").mkdir(parents=True)
    (root / "a" / "x.txt").write_bytes(b"hello")
    (root / "a" / "b" / "y.bin").write_bytes(b"\x00\x01")
    df = scan_local(spark, str(root), with_md5=True)
    got = {r["path"]: (r["is_dir"], r["md5sum"], r["size"]) for r in df.collect()}
    base = os.path.realpath(str(root))
    assert got[f"{base}/a/x.txt"] == (False, hashlib.md5(b"hello").hexdigest(), 5)
    assert got[f"{base}/a/b/y.bin"][1] == hashlib.md5(b"\x00\x01").hexdigest()
    assert got[f"{base}/a"][0] and got[f"{base}/a/b"][0] and got[base][0]
    assert {r["md5sum"] for r in scan_local(spark, str(root)).collect()} == {None}
    assert {r["path"] for r in scan_local(spark, str(root), with_dirs=False).collect()} == {f"{base}/a/x.txt", f"{base}/a/b/y.bin"}


def test_reports(spark, inv, tmp_path):
    out = str(tmp_path / "trees")
    write_tree_report(inv.L, ["/data/ASIA"], False, out)
    lines = spark.read.text(f"{out}/root=%2Fdata%2FASIA").count() if os.path.exists(f"{out}/root=%2Fdata%2FASIA") \
        else spark.read.text(out).count()
    assert lines == inv.L.filter("is_dir AND (path = '/data/ASIA' OR path LIKE '/data/ASIA/%')").count()
    log = str(tmp_path / "log")
    write_transfer_log(inv.A.limit(5).select(F.lit("DELETE").alias("op"), F.col("drive_id").alias("file_id")), log)
    back = spark.read.option("header", "true").csv(log)
    assert back.columns == ["operation", "file_id", "remote_path", "local_path"] and back.count() == 5
    assert back.filter("remote_path = '---'").count() == 5
