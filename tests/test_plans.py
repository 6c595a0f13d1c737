"""Plan properties on the derived inventories (sf0.001)."""
from pyspark.sql import functions as F

from syncledger import fixtures as fx
from syncledger.operators import catalog as U
from syncledger.operators.diff import removed_locally
from syncledger.operators.exclude import Exclusions
from syncledger.operators.hierarchy import ancestors, topmost
from syncledger.plans import maintenance as PM
from syncledger.plans import mirror as PMI
from syncledger.plans import upload as PU


def ex_of(inv):
    return Exclusions.from_df(inv.exclusions)


def uploaded(inv, plan):
    loc = inv.L.select("path", "mtime", F.when(F.col("is_dir"), F.lit("")).otherwise(F.col("md5sum")).alias("md5sum"))
    res = plan.select("path", F.coalesce("drive_id", F.concat(F.lit("u-"), F.md5("path"))).alias("drive_id")) \
        .join(loc, "path")
    return U.record_uploads(inv.A, res)


def test_upload_then_replan_is_empty(spark, inv):
    ex = ex_of(inv)
    plan = PU.upload_plan(inv.L, inv.A, ex, fx.ROOT_PATHS)
    assert plan.count() > 0
    after = uploaded(inv, plan)
    assert PU.upload_plan(inv.L, after, ex, fx.ROOT_PATHS).count() == 0
    assert U.check_unique(after).count() == 0


def test_parents_resolvable(spark, inv):
    plan = PU.upload_plan(inv.L, inv.A, ex_of(inv), fx.ROOT_PATHS)
    # a NULL parent id always points at a folder created by the same plan
    orphans = plan.filter(F.col("parent_id").isNull()).join(
        plan.filter(F.col("type") == "#folder").select(F.col("path").alias("parent_path")), "parent_path", "left_anti")
    assert orphans.count() == 0


def test_upsert_idempotent(spark, inv):
    upd = inv.A.limit(50).select("path", "drive_id", "date_modified_on_disk",
                                  F.lit("new").alias("md5sum"), F.lit(1).alias("seq"))
    once = U.upsert_archive(inv.A, upd)
    twice = U.upsert_archive(once, upd)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_topmost_antichain_covers(spark, inv):
    gone = removed_locally(inv.A, inv.L).select("path")
    tops = topmost(gone)
    anc = tops.select("path", F.explode(ancestors(F.col("path"))).alias("a")).filter("a <> path")
    assert anc.join(tops.select(F.col("path").alias("a")), "a", "left_semi").count() == 0
    covered = gone.select("path", F.explode(ancestors(F.col("path"))).alias("a")) \
        .join(tops.select(F.col("path").alias("a")), "a", "left_semi").select("path").distinct()
    assert covered.count() == gone.distinct().count()


def test_mirror_fast_deletes_subset_of_archive(spark, inv):
    plan = PMI.mirror_fast_plan(inv.L, inv.A, ex_of(inv), "/data/ASIA")
    deletes = plan.filter("action = 'delete'").select("drive_id")
    assert deletes.join(inv.A, "drive_id", "left_anti").count() == 0
    assert plan.filter("action = 'forget'").count() >= deletes.count()


def test_mirror_all_equals_per_root(spark, inv):
    ex = ex_of(inv)
    together = PMI.mirror_all(inv.L, inv.A, ex, fx.ROOT_PATHS).filter("action <> 'upload'")
    per_root = None
    for r in fx.ROOT_PATHS:
        p = PMI.mirror_fast_plan(inv.L, inv.A, ex, r).filter("action <> 'upload'")
        per_root = p if per_root is None else per_root.unionByName(p)
    assert together.exceptAll(per_root).count() == 0 and per_root.exceptAll(together).count() == 0


def test_delete_results(spark, inv):
    plan = PM.purge_removed_local(inv.A, inv.L)
    res = plan.select("drive_id", F.when(F.col("batch") % 2 == 0, 404).otherwise(403).alias("status"))
    new_archive, retry = PM.apply_delete_results(inv.A, res)
    assert retry.count() == plan.filter(F.col("batch") % 2 == 1).count()
    assert inv.A.count() - new_archive.count() == plan.filter(F.col("batch") % 2 == 0).count()


def test_insert_rejects_duplicates(spark, inv):
    import pytest
    dup = inv.A.limit(3)
    with pytest.raises(U.UniquenessError):
        U.insert_archive(inv.A, dup)
    fresh = dup.select(F.concat(F.lit("/new"), "path").alias("path"), F.concat(F.lit("n-"), "drive_id").alias("drive_id"),
                       "date_modified_on_disk", "md5sum")
    assert U.insert_archive(inv.A, fresh).count() == inv.A.count() + 3


def test_rename_subtree(spark, inv):
    moved = U.rename_paths(inv.A, "/data/ASIA", "/moved")
    assert moved.filter(F.col("path").startswith("/data/ASIA/")).count() == 0
    assert moved.count() == inv.A.count() and U.check_unique(moved).count() == 0


def test_mirror_flags_the_root(spark):
    folder = "application/vnd.folder"
    cols = ("file_id string, name string, parent_id string, mime_type string, md5sum string, "
            "modified_time timestamp_ntz, size bigint, trashed boolean")
    remote = spark.createDataFrame([("R", "home", None, folder, None, None, 0, False),
                                    ("f", "a.txt", "R", "text/plain", "m", None, 1, False)], cols)
    archive = spark.createDataFrame([], "path string, drive_id string, date_modified_on_disk timestamp_ntz, "
                                        "md5sum string")
    local = spark.createDataFrame([("/home", True, None, None, 0)],
                                  "path string, is_dir boolean, mtime timestamp_ntz, md5sum string, size bigint")
    plan = PMI.mirror_full_plan(remote, local, archive, Exclusions(), "R", "/home")
    rows = {(r["action"], r["drive_id"], r["is_root"]) for r in plan.collect()}
    # the unarchived root is flagged (and not entered); callers can refuse to delete it
    assert ("delete", "R", True) in rows and not any(d == "f" for _a, d, _r in rows)
