"""Mirror plans (P4, P5, P6): make the remote side match a local root.

Output rows: ``root, action, op, type, path, drive_id, parent_id, is_root`` where
``action`` is ``delete`` (remote delete), ``forget`` (archive row to drop) or
``upload`` (``op`` NEW / UPDATE, from the upload plan computed on the archive
without the forgotten rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import explode_ancestors
from ..session import checkpoint_dir
from ..operators.catalog import delete_archive
from ..operators.diff import descendants_join, removed_locally
from ..operators.exclude import Exclusions
from ..operators.hierarchy import tag_archived, topmost, walk_pruned
from ..operators.semijoin import null_safe_key
from .upload import upload_plan, upload_sync_plan

OUT_COLS = ["root", "action", "op", "type", "path", "drive_id", "parent_id", "is_root"]


def _flag_root(plan: DataFrame, root_id) -> DataFrame:
    """``is_root``: the row is the mirrored root itself (its local path or its
    remote id), so a caller can refuse to delete or forget it."""
    rid = F.lit(root_id) if isinstance(root_id, str) or root_id is None else root_id
    return plan.withColumn("is_root", (F.col("path") == F.col("root")) |
                           F.coalesce(F.col("drive_id") == rid, F.lit(False)))


def _materialise(df: DataFrame) -> DataFrame:
    """Write a set the plan reads several times (gone / forgotten rows, small
    next to the archive) once into the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
UNKNOWN_ID = "?UNKNOWN?"  # fixed value: folder id placeholder of a dry run for an unlinked root


def _rows(df: DataFrame, root, action: str) -> DataFrame:
    r = F.lit(root) if isinstance(root, str) else root
    return df.select(r.alias("root"), F.lit(action).alias("action"), F.lit(None).cast("string").alias("op"),
                     F.when(F.col("md5sum") == "", "#folder").otherwise("#file").alias("type"), "path", "drive_id",
                     F.lit(None).cast("string").alias("parent_id"))


def _upload_rows(plan: DataFrame) -> DataFrame:
    return plan.select("root", F.lit("upload").alias("action"), "op", "type", "path", "drive_id", "parent_id")


def root_folder_id(archive: DataFrame, root: str) -> str:
    rows = archive.filter(F.col("path") == root).select("drive_id").limit(1).collect()
    return rows[0][0] if rows else UNKNOWN_ID


def mirror_fast_plan(local: DataFrame, archive: DataFrame, ex: Exclusions, root: str,
                     mode: str = "descendant", folder_id: str | None = None) -> DataFrame:
    """Archive rows at/below ``root`` gone locally: the topmost are deleted
    remotely, every archive row at/below a deleted one is forgotten, then the
    upload plan of the root runs on the remaining archive.

    ``mode='prefix'`` reproduces plain ``startswith`` matching.
    """
    gone = _materialise(removed_locally(archive, local, under=root, mode=mode))
    tops = topmost(gone.select("path"), mode=mode)
    deletes = gone.join(tops, "path", "left_semi")
    forget = _materialise(descendants_join(archive, tops, mode=mode).select(*archive.columns)
                          .dropDuplicates(["drive_id"]))
    remaining = delete_archive(archive, forget, "drive_id")
    fid = folder_id or root_folder_id(archive, root)
    up = upload_sync_plan(local, remaining, ex, fid, root)
    out = _rows(deletes, root, "delete").unionByName(_rows(forget, root, "forget")).unionByName(_upload_rows(up))
    return _flag_root(out, fid)


def flag_removed(remote: DataFrame, archive: DataFrame, local: DataFrame) -> DataFrame:
    """Remote nodes with ``flag``: unarchived, or archived but gone locally."""
    t = tag_archived(remote, archive)
    here = null_safe_key(F.col("archive_path"), F.col("file_id"), "noarchive")  # unarchived nodes spread over tasks
    t = t.join(local.select(F.col("path").alias("__lp")), here == F.col("__lp"), "left")
    return t.withColumn("flag", ~F.col("archived") | F.col("__lp").isNull()).drop("__lp")


def mirror_full_plan(remote: DataFrame, local: DataFrame, archive: DataFrame, ex: Exclusions, folder_id: str,
                     root: str, mode: str = "descendant") -> DataFrame:
    """P5: walk the remote folder, not entering flagged folders; every flagged
    node is deleted remotely; archived ones also forget their archive rows
    (and those below); then the upload plan of the root."""
    w = walk_pruned(flag_removed(remote, archive, local), folder_id, "flag")
    removed = w.filter(F.col("flag"))
    deletes = removed.select(F.coalesce(F.col("archive_path"), F.col("path")).alias("path"),
                             F.col("file_id").alias("drive_id"),
                             F.when(F.col("type") == "#folder", "").otherwise("x").alias("md5sum"))
    archived_tops = removed.filter(F.col("archived")).select(F.col("archive_path").alias("path"))
    forget = _materialise(descendants_join(archive, archived_tops, mode=mode).select(*archive.columns)
                          .dropDuplicates(["drive_id"]))
    remaining = delete_archive(archive, forget, "drive_id")
    up = upload_sync_plan(local, remaining, ex, folder_id, root)
    out = _rows(deletes, root, "delete").unionByName(_rows(forget, root, "forget")).unionByName(_upload_rows(up))
    return _flag_root(out, folder_id)


def mirror_all(local: DataFrame, archive: DataFrame, ex: Exclusions, roots, fast: bool = True,
               remote: DataFrame | None = None) -> DataFrame:
    """P4 (``fast``) or P5 for every root at once, roots as a column.

    Fast mode assigns gone archive rows to roots by an ancestor join against
    the (configuration-sized, broadcast) root list, takes the topmost per root
    and forgets by an ancestor equi-join; full mode runs one multi-seed pruned
    walk. The upload part is one P1 over all roots.
    """
    spark = archive.sparkSession
    roots = list(roots)
    rdf = spark.createDataFrame([(r,) for r in roots], "root string")
    ids = {r["path"]: r["drive_id"] for r in archive.filter(F.col("path").isin(roots))
           .select("path", "drive_id").collect()}  # one row per configured root
    if fast:
        gone = _materialise(archive.join(local.select("path"), "path", "left_anti"))
        rooted = explode_ancestors(gone, "path", "__anc", rdf, "root") \
            .join(rdf, F.col("__anc") == F.col("root")).drop("__anc")
        proper = explode_ancestors(rooted.select("root", "path"), "path", "__anc", rooted, "path") \
            .filter(F.col("__anc") != F.col("path"))
        covered = proper.join(rooted.select("root", F.col("path").alias("__anc")), ["root", "__anc"], "left_semi")
        deletes = rooted.join(covered.select("root", "path"), ["root", "path"], "left_anti")
        forget = explode_ancestors(archive, "path", "__anc", deletes, "path") \
            .join(deletes.select("root", F.col("path").alias("__anc")), "__anc").drop("__anc")
    else:
        if remote is None:
            raise ValueError("full mirror needs the remote listing")
        seeds = list(ids.values())
        w = walk_pruned(flag_removed(remote, archive, local), seeds, "flag")
        back = spark.createDataFrame([(v, k) for k, v in ids.items()], "seed_id string, root string")
        removed = w.filter(F.col("flag")).join(back, "seed_id")
        deletes = removed.select("root", F.coalesce(F.col("archive_path"), F.col("path")).alias("path"),
                                 F.col("file_id").alias("drive_id"),
                                 F.when(F.col("type") == "#folder", "").otherwise("x").alias("md5sum"))
        tops = removed.filter(F.col("archived")).select("root", F.col("archive_path").alias("__anc"))
        forget = explode_ancestors(archive, "path", "__anc", tops, "__anc") \
            .join(tops, "__anc").drop("__anc")
    forget = _materialise(forget.dropDuplicates(["root", "drive_id"]))
    remaining = delete_archive(archive, forget, "drive_id")
    up = upload_plan(local, remaining, ex, roots, root_ids={k: v for k, v in ids.items()})
    out = (_rows(deletes, F.col("root"), "delete").unionByName(_rows(forget, F.col("root"), "forget"))
           .unionByName(_upload_rows(up)))
    rid = F.create_map(*[x for k, v in ids.items() for x in (F.lit(k), F.lit(v))])[F.col("root")] if ids \
        else F.lit(None).cast("string")
    return _flag_root(out, rid)
