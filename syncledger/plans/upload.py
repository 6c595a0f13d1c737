"""Upload plans.

A plan is a DataFrame of rows to execute: ``op`` (NEW / UPDATE), ``type``,
local ``path``, ``drive_id`` (for updates), ``parent_path`` and ``parent_id``
(NULL when the parent folder is created earlier in the same plan), plus
``stage``/``depth`` so that :func:`parents_first` orders folders before their
content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import is_descendant_or_self, parent_dir, path_depth
from ..operators.catalog import FOLDER_MD5, upsert_archive
from ..operators.diff import lookup
from ..operators.exclude import Exclusions, prune_excluded
from ..operators.reconcile import needs_upload
from ..operators.semijoin import broadcast_if_few

PLAN_COLS = ["root", "op", "type", "path", "drive_id", "parent_path", "parent_id", "stage", "depth", "size"]


def _finish(cand: DataFrame, archive: DataFrame, root_id_col) -> DataFrame:
    cand = cand.withColumn("parent_path", parent_dir(F.col("path")))
    cand = lookup(cand, archive, "parent_path", "path", "drive_id", out="__pid")
    parent_id = F.when(F.col("__pid").isNotNull(), F.col("__pid")) \
        .when(F.col("path") == F.col("root"), root_id_col)
    return cand.select(
        "root", "op", F.when(F.col("is_dir"), "#folder").otherwise("#file").alias("type"), "path", "drive_id",
        "parent_path", parent_id.alias("parent_id"),
        F.when(F.col("is_dir"), 0).otherwise(1).alias("stage"), path_depth(F.col("path")).alias("depth"), "size")


def upload_plan(local: DataFrame, archive: DataFrame, ex: Exclusions, roots, root_id: str = "root",
                root_ids: dict | None = None) -> DataFrame:
    """Everything under the sync roots that is not pruned by the exclusions
    (walk semantics, F9) and needs uploading (J1). Folders first (stage 0).

    The parent id comes from the archive; a root's parent falls back to
    ``root_id`` (or ``root_ids[root]``); other unarchived parents are created
    by the plan itself (``parent_id`` NULL, resolve via ``parent_path``).
    """
    roots = list(roots)
    pr = prune_excluded(local, "path", ex, roots, out="__pruned")
    walked = pr.filter(F.col("root").isNotNull() & ~F.col("__pruned")).drop("__pruned")
    # all that is looked up lies at or below a root, or is a root's parent
    near, above = F.lit(False), [r.rstrip("/").rpartition("/")[0] or "/" for r in roots]
    for r in roots:
        near = near | is_descendant_or_self(F.col("path"), F.lit(r))
    archive = archive.filter(near | F.col("path").isin(above))
    cand = needs_upload(walked, archive)
    if root_ids:
        m = F.create_map(*[x for k, v in root_ids.items() for x in (F.lit(k), F.lit(v))])
        rid = F.coalesce(m[F.col("root")], F.lit(root_id))
    else:
        rid = F.lit(root_id)
    return _finish(cand, archive, rid)


def link_root(local: DataFrame, archive: DataFrame, folder_id: str, local_path: str) -> DataFrame:
    """Link ``local_path`` to ``folder_id`` in the archive (as a folder) when the
    path exists locally; the archive is unchanged otherwise. The path leaves any
    other id it was archived under, so it stays unique."""
    link = local.filter(F.col("path") == local_path).select(
        "path", F.lit(folder_id).alias("drive_id"), F.col("mtime").alias("date_modified_on_disk"),
        F.lit(FOLDER_MD5).alias("md5sum"), F.lit(0).alias("seq"))
    other = (F.col("path") == local_path) & (F.col("drive_id") != folder_id)
    replaced = archive.filter(other).join(link.select("path"), "path", "left_semi").select("drive_id")
    return upsert_archive(archive.join(broadcast_if_few(replaced)[0], "drive_id", "left_anti"), link)


def upload_sync_plan(local: DataFrame, archive: DataFrame, ex: Exclusions, folder_id: str,
                     local_path: str) -> DataFrame:
    """P1 for one (remote folder, local path) pair, after linking the pair in
    the archive so no new base folder is created. Empty when the path does not
    exist locally."""
    linked = link_root(local, archive, folder_id, local_path)
    return upload_plan(local, linked, ex, [local_path], root_id=folder_id)


def copy_up_plan(local: DataFrame, root: str, root_id: str = "root") -> DataFrame:
    """The whole local tree under ``root`` as NEW rows, no archive, no
    exclusions; the top folder goes under ``root_id``."""
    root = root.rstrip("/") or "/"
    under = local.filter(is_descendant_or_self(F.col("path"), F.lit(root)))
    return under.select(
        F.lit(root).alias("root"), F.lit("NEW").alias("op"),
        F.when(F.col("is_dir"), "#folder").otherwise("#file").alias("type"), "path",
        F.lit(None).cast("string").alias("drive_id"), parent_dir(F.col("path")).alias("parent_path"),
        F.when(F.col("path") == root, F.lit(root_id)).alias("parent_id"),
        F.when(F.col("is_dir"), 0).otherwise(1).alias("stage"), path_depth(F.col("path")).alias("depth"), "size")
