"""Download plans.

Rows: ``type``, remote ``file_id``, ``dest_path``, ``md5sum``, the decision
(``decision``/``why`` from :func:`reconcile`) and the conflict flags:
``conflict`` is true for a decision of -1 or a destination that already exists
locally (those rows go to conflict resolution, W1), ``dup_dest`` when two rows
share a destination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import FOLDER_MIME
from ..functions.mime import DEFAULT_MIME
from ..functions.paths import basename, is_descendant_or_self, join_path, parent_dir, strip_first_segment
from ..operators.catalog import record_uploads
from ..operators.diff import lookup, tracked_roots
from ..operators.exclude import Exclusions
from ..operators.hierarchy import tracked_parents, walk
from ..operators.reconcile import NEUTRAL, collides, reconcile
from ..operators.semijoin import broadcast_if_few, matching
from ..session import checkpoint_dir
from ..sources.listing import read_changes
from ..streaming.feed import changed_since


def _once(plan: DataFrame) -> DataFrame:
    """The plan written to the shared folder: what is read twice below is not decided twice."""
    checkpoint_dir(plan.sparkSession)
    return plan.checkpoint(eager=True)


def download_folder_plan(remote: DataFrame, archive: DataFrame, local: DataFrame, ex: Exclusions, folder_id: str,
                         local_path: str) -> DataFrame:
    """Nodes below a remote folder that are missing, outdated or in conflict
    locally. Folders are compared with md5 ``''`` and no time; the destination
    is ``local_path`` + the remote path without its first segment."""
    w = walk(remote, folder_id)
    nodes = w.withColumn("md5sum", F.when(F.col("type") == "#folder", F.lit("")).otherwise(
        F.coalesce(F.col("md5sum"), F.lit(""))))
    dec = reconcile(nodes.drop("type"), archive, local, ex, folder_time=False).filter(F.col("decision") != NEUTRAL)
    plan = dec.select("decision", "why", "type", "file_id", F.col("path").alias("remote_path"),
                      join_path(F.lit(local_path), strip_first_segment(F.col("path"))).alias("dest_path"),
                      "md5sum", "size")
    below = local.filter(is_descendant_or_self(F.col("path"), F.lit(local_path)))  # where all destinations are
    out = collides(_once(plan), below, "dest_path")
    return out.withColumn("conflict", (F.col("decision") == -1) | F.col("exists_locally"))


def download_changes_plan(changes: DataFrame, remote: DataFrame, archive: DataFrame, local: DataFrame,
                          ex: Exclusions, roots: DataFrame, last_sync, start_seq: int | None = None,
                          extra_root: tuple[str, str] | None = None, ignored_ids=(),
                          kept: DataFrame | None = None) -> DataFrame:
    """Rows to fetch from the change feed.

    Non-removed, non-trashed events at or after ``start_seq`` whose time is not
    older than ``last_sync``; kept when an ancestor (from the parent up) is a
    tracked root or archived (J8) and the decision (J2, time passed for
    folders too) is not neutral. Destination = archived path of that ancestor
    (else the root's base path) + the names between it and the parent + name.

    The archive and the local listing are cut down to the batch's ids, paths and
    destinations by broadcast semi joins (:func:`matching`), so a small batch
    exchanges neither. ``kept``: the remote listing's ``lineage``, if it is there
    already (a stream works it out once).
    """
    tracked, _ = broadcast_if_few(tracked_roots(roots, archive, extra_root))
    root_ids = sorted(r[0] for r in tracked.select("drive_id").collect())  # one row per configured root
    c = changes if start_seq is None else read_changes(changes, start_seq, include_removed=False)
    c = c.filter(~F.col("removed") & ~F.coalesce(F.col("trashed"), F.lit(False)))
    c = changed_since(c, last_sync)
    ignored_ids = list(ignored_ids)
    parents, archived = tracked_parents(c, remote, archive, root_ids, ignored_ids, kept=kept)
    a = archived.select(F.col("id").alias("__tid"), F.col("archive_path").alias("__tpath"))
    t = tracked.select(F.col("drive_id").alias("__tid2"), F.col("base_path").alias("__tbase"))
    parents = parents.filter("__tracked IS NOT NULL").join(a, F.col("__tracked") == F.col("__tid"), "left") \
        .join(t, F.col("__tracked") == F.col("__tid2"), "left") \
        .select("__p", "__tracked", "__mid", F.coalesce("__tpath", "__tbase").alias("__pre"))
    top = F.coalesce(F.col("file_id").isin(root_ids + ignored_ids), F.lit(False))  # neither roots nor ignored ids
    ev = _once(c.filter(F.col("file_id").isNotNull() & ~top).join(parents, F.col("parent_id") == F.col("__p")).select(
        "seq", "file_id", "mime_type", "md5sum", "modified_time", F.col("__tracked").alias("root_parent_id"),
        join_path(F.col("__pre"), F.col("__mid"), F.col("name")).alias("dest_path")))
    dec = reconcile(ev, archive, local, ex, folder_time=True, batch=True).filter(F.col("decision") != NEUTRAL)
    plan = _once(dec.select("seq", "file_id", "type", "decision", "why", "root_parent_id", "dest_path",
                            F.coalesce(F.col("md5sum"), F.lit("")).alias("md5sum")))
    out = collides(plan, matching(local, "path", plan, "dest_path"), "dest_path")
    return out.withColumn("conflict", (F.col("decision") == -1) | F.col("exists_locally"))


def copy_down_plan(remote: DataFrame, folder_id: str, save_path: str, folder_name: str | None = None) -> DataFrame:
    """The whole non-trashed subtree to ``save_path`` (no archive, no
    conflict test): one row per folder to create and file to fetch."""
    w = walk(remote, folder_id, root_name=folder_name)
    return w.select(F.lit("DOWNLOAD").alias("op"), "type", "file_id", F.col("path").alias("remote_path"),
                    join_path(F.lit(save_path), F.col("path")).alias("dest_path"),
                    F.when(F.col("type") == "#file", F.col("md5sum")).alias("md5sum"),
                    F.when(F.col("type") == "#file", F.col("size")).otherwise(F.lit(0)).alias("size"))


def apply_uploads(remote: DataFrame, archive: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The remote listing and the archive after uploads (U5): ``results(path,
    drive_id, is_dir, mtime, md5sum, size)``. Nodes that exist take the time, md5
    and size; new ones hang under the id their parent folder has by then."""
    results = _once(results)  # a whole plan, read several times here and wherever its outcome is
    after = _once(record_uploads(archive, results.select("path", "drive_id", "mtime", "md5sum")))
    r = results.select(F.col("drive_id").alias("__rid"), F.col("mtime").alias("__time"), F.col("md5sum").alias("__md5"),
                       F.col("size").alias("__size"), F.lit(True).alias("__up"))
    is_file = F.col("__up") & (F.col("mime_type") != FOLDER_MIME)
    changed = remote.join(r, F.col("file_id") == F.col("__rid"), "left") \
        .withColumn("modified_time", F.coalesce(F.col("__time"), F.col("modified_time"))) \
        .withColumn("md5sum", F.when(is_file, F.col("__md5")).otherwise(F.col("md5sum"))) \
        .withColumn("size", F.when(is_file, F.col("__size")).otherwise(F.col("size"))).select(*remote.columns)
    fresh = results.join(remote.select(F.col("file_id").alias("drive_id")), "drive_id", "left_anti") \
        .withColumn("__parent", parent_dir(F.col("path")))
    nodes = lookup(fresh, after, "__parent", "path", "drive_id", out="parent_id").select(
        F.col("drive_id").alias("file_id"), basename(F.col("path")).alias("name"), "parent_id",
        F.when(F.col("is_dir"), FOLDER_MIME).otherwise(DEFAULT_MIME).alias("mime_type"),
        F.when(~F.col("is_dir"), F.col("md5sum")).alias("md5sum"), F.col("mtime").alias("modified_time"),
        F.col("size").cast("bigint").alias("size"), F.lit(False).alias("trashed"))
    return _once(changed.unionByName(nodes.select(*remote.columns))), after


def folder_sync_plan(upload: DataFrame, download: DataFrame) -> DataFrame:
    """The upload side (P7) then the download side (P2) of one folder pair,
    in a common shape: ``direction, type, local_path, file_id, action``. As a
    dry run both sides see the state before; for a sync, plan the download on
    what :func:`apply_uploads` returns."""
    up = upload.select(F.lit("up").alias("direction"), "type", F.col("path").alias("local_path"),
                       F.col("drive_id").alias("file_id"),
                       F.when(F.col("op") == "NEW", "upload_new").otherwise("upload_update").alias("action"))
    down = download.select(F.lit("down").alias("direction"), "type", F.col("dest_path").alias("local_path"),
                           "file_id", F.when(F.col("conflict"), "conflict").otherwise("download").alias("action"))
    return up.unionByName(down)


__all__ = ["download_folder_plan", "download_changes_plan", "copy_down_plan", "apply_uploads", "folder_sync_plan", "FOLDER_MIME"]
