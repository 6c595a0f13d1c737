"""Maintenance plans (P9-P13): forget, exclude and purge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import result_outcomes
from ..operators.catalog import delete_archive
from ..operators.diff import descendants_join, excluded_archived, removed_locally, removed_remotely, unarchived_nodes
from ..operators.exclude import Exclusions, add_exclusions, minimal_exclusions
from ..operators.hierarchy import walk
from ..operators.ordering import DELETE_BATCH, assign_batches


def forget_removed(changes: DataFrame, archive: DataFrame, mode: str = "descendant",
                   start_seq: int | None = None) -> DataFrame:
    """The archive without the rows named by removed/trashed events and the
    rows below them (``contains`` reproduces substring matching)."""
    removed = removed_remotely(changes, archive, start_seq).select("path")
    matched = descendants_join(archive, removed, mode=mode).select("drive_id")
    return delete_archive(archive, matched, "drive_id")


def exclude_removed(changes: DataFrame, archive: DataFrame, local: DataFrame, ex: Exclusions, roots,
                    mode: str = "descendant", start_seq: int | None = None):
    """P10: P9, and the exclusion paths after adding the removed paths (E3) and
    cleaning the set (E2). Returns ``(archive, exclusion_paths)``."""
    removed = removed_remotely(changes, archive, start_seq).select("path")
    added = add_exclusions(ex, removed, local, roots)
    known = ex.path_table(archive)
    merged = Exclusions((), ex.rules, added if known is None else known.unionByName(added).distinct())
    return forget_removed(changes, archive, mode, start_seq), minimal_exclusions(merged, local, roots)


def purge_unarchived(remote: DataFrame, archive: DataFrame, folder_id: str, size: int = DELETE_BATCH) -> DataFrame:
    """Delete plan (in batches) for the unarchived nodes below a folder."""
    nodes = unarchived_nodes(walk(remote, folder_id), archive).select("file_id", "path")
    return assign_batches(nodes, size, order="file_id")


def purge_removed_local(archive: DataFrame, local: DataFrame, size: int = DELETE_BATCH) -> DataFrame:
    """Delete plan (in batches) for archived items gone locally."""
    gone = removed_locally(archive, local).select("drive_id", "path").dropDuplicates(["drive_id"])
    return assign_batches(gone, size, order="drive_id")


def apply_delete_results(archive: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """After a delete run: ``results(drive_id, status)``. Rows deleted or already
    gone (404) leave the archive; rate-limited ones (403) form the next
    attempt. Returns ``(archive, retry)``."""
    r = result_outcomes(results)
    return delete_archive(archive, r.filter(F.col("forget")), "drive_id"), r.filter(F.col("outcome") == "retry")


def purge_excluded(archive: DataFrame, ex: Exclusions, roots) -> DataFrame:
    """Delete plan for archived rows excluded under F8."""
    return excluded_archived(archive, ex, roots).select("drive_id", "path")
