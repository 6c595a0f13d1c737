"""Listing sources (S1-S5) and the field-mask projection (F1, F2).

Listings are plain DataFrames; the operators here are filters and
projections that Catalyst pushes into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import FOLDER_MIME
from ..functions.paths import basename, normalize_path
from ..operators.reconcile import classify_type
from .directory import LOCAL_SCHEMA, read_tree

def scan_local(spark: SparkSession, path: str, with_md5: bool = False, with_dirs: bool = True) -> DataFrame:
    """Recursive listing of a directory tree as ``local_files``, the folder
    itself included: every file and folder, empty ones too, each with its own
    time (:mod:`.directory`). ``with_md5`` adds the files' md5 (T6), worked out
    block by block where they are listed; without it no content is read.
    ``path`` may have a scheme (``file:``, ``hdfs://host``); the listed paths
    have none."""
    tree = read_tree(spark, path, digest=with_md5).withColumn("path", normalize_path("path"))
    return tree if with_dirs else tree.filter(~F.col("is_dir"))


def list_children(remote: DataFrame, folder_id: str, kind: str = "all", where: Column | None = None,
                  folder_mime: str = FOLDER_MIME) -> DataFrame:
    """Direct non-trashed children of a folder: ``all``, ``files`` or ``folders``."""
    cond = (F.col("parent_id") == folder_id) & ~F.col("trashed")
    if kind == "files":
        cond = cond & (F.col("mime_type") != folder_mime)
    elif kind == "folders":
        cond = cond & (F.col("mime_type") == folder_mime)
    elif kind != "all":
        raise ValueError(f"unknown kind {kind!r}")
    if where is not None:
        cond = cond & where
    return classify_type(remote.filter(cond), folder_mime=folder_mime)


def list_all(remote: DataFrame, where: Column | None = None) -> DataFrame:
    """S3: flat listing with an optional predicate; trashed nodes are kept."""
    return remote if where is None else remote.filter(where)


def find_by_name(remote: DataFrame, name: str, first: bool = False) -> DataFrame:
    """Nodes with this exact name; ``first`` keeps the smallest id only
    (a fixed order instead of whatever order a service returns)."""
    hits = remote.filter(F.col("name") == name)
    return hits.orderBy("file_id").limit(1) if first else hits


def read_changes(changes: DataFrame, start_seq: int, include_removed: bool = True) -> DataFrame:
    """Change events from offset ``start_seq`` on. Without
    ``include_removed`` the removal events are left out."""
    c = changes.filter(F.col("seq") >= start_seq)
    return c if include_removed else c.filter(~F.col("removed"))


def nest_changes(changes: DataFrame) -> DataFrame:
    """Change events in the nested shape of the service (D8):
    ``seq, file_id, removed, file struct<...>``."""
    return changes.select("seq", "file_id", "removed", F.struct(
        F.col("file_id").alias("id"), "name", F.col("md5sum").alias("md5Checksum"),
        F.col("modified_time").alias("modifiedTime"), F.array("parent_id").alias("parents"),
        "trashed", F.col("mime_type").alias("mimeType")).alias("file"))


__all__ = ["scan_local", "list_children", "list_all", "find_by_name", "read_changes", "nest_changes",
           "basename", "LOCAL_SCHEMA"]
