"""Three-way reconciliation of remote, archive and local state.

Everything is two hash-partitioned joins and an ordered ``CASE``; nothing is
looked up row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixtures import FOLDER_MIME
from ..session import checkpoint_dir
from .exclude import Exclusions, is_excluded
from .semijoin import matching, null_safe_key

CONFLICT, NEUTRAL, SAFE = -1, 0, 1


def classify_type(df: DataFrame, mime_col: str = "mime_type", out: str = "type",
                  folder_mime: str = FOLDER_MIME) -> DataFrame:
    """``#folder`` / ``#file`` from the mime type."""
    return df.withColumn(out, F.when(F.col(mime_col) == folder_mime, "#folder").otherwise("#file"))


def truncate_second(col: Column) -> Column:
    """Drop the fraction of a second (the remote time format keeps whole
    seconds). Built from the wall-clock fields, so no time zone is involved."""
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), F.minute(col),
                                F.second(col))


def reconcile(nodes: DataFrame, archive: DataFrame, local: DataFrame, ex: Exclusions,
              folder_time: bool = False, folder_mime: str = FOLDER_MIME, batch: bool = False) -> DataFrame:
    """Decision per remote node, first matching rule wins.

    ``nodes`` needs ``file_id, mime_type, md5sum, modified_time``. Adds
    ``type, archive_path, decision, why``. ``why`` is one of ``new``,
    ``excluded``, ``gone``, ``p`` (remote = archive), ``q`` (remote = local),
    ``r`` (local = archive, remote ahead), ``older``, ``conflict``. md5
    comparisons are NULL-safe; the remote md5 is ``coalesce(md5, '')`` and the
    archive md5 is compared as stored. ``folder_time`` passes the remote time
    for folders too (change feed); a folder walk passes none.

    With ``batch`` the nodes are few against the archive and the listing (a
    batch of a feed): both are cut down to the nodes' ids and paths first, and
    neither is exchanged.
    """
    if batch:
        checkpoint_dir(nodes.sparkSession)
        known = matching(archive, "drive_id", nodes, "file_id")
        if known is not archive:
            archive = known.checkpoint(eager=True)  # at most as many rows as there are ids
            local = matching(local, "path", archive)
    n = classify_type(nodes, folder_mime=folder_mime)
    a = archive.select(
        F.col("drive_id").alias("__a_id"), F.col("path").alias("archive_path"),
        F.col("date_modified_on_disk").alias("__a_time"), F.col("md5sum").alias("__a_md5"))
    loc = local.select(F.col("path").alias("__l_path"), F.col("mtime").alias("__l_time"),
                       F.col("md5sum").alias("__l_md5"))
    j = n.join(a, F.col("file_id") == F.col("__a_id"), "left")
    j = is_excluded(j, "archive_path", ex, out="__excl", row_id="file_id")
    j = j.withColumn("__l_key", null_safe_key(F.col("archive_path"), F.col("file_id"), "noarchive"))
    j = j.join(loc, F.col("__l_key") == F.col("__l_path"), "left")

    rmd5 = F.coalesce(F.col("md5sum"), F.lit(""))
    rtime = truncate_second(F.col("modified_time"))
    if not folder_time:
        rtime = F.when(F.col("type") == "#file", rtime)
    older = rtime.isNotNull() & ((rtime < F.col("__a_time")) | (rtime < F.col("__l_time")))
    why = (F.when(F.col("__a_id").isNull(), "new")
           .when(F.col("__excl"), "excluded")
           .when(F.col("__l_path").isNull(), "gone")
           .when(rmd5.eqNullSafe(F.col("__a_md5")), "p")
           .when(rmd5.eqNullSafe(F.col("__l_md5")), "q")
           .when(F.col("__l_md5").eqNullSafe(F.col("__a_md5")), "r")
           .when(older, "older")
           .otherwise("conflict"))
    decision = (F.when(F.col("why").isin("new", "r"), F.lit(SAFE))
                .when(F.col("why").isin("gone", "conflict"), F.lit(CONFLICT))
                .otherwise(F.lit(NEUTRAL)))
    return (j.withColumn("why", why).withColumn("decision", decision)
            .drop("__a_id", "__a_time", "__a_md5", "__excl", "__l_key", "__l_path", "__l_time", "__l_md5"))


def needs_upload(local: DataFrame, archive: DataFrame) -> DataFrame:
    """Local rows to upload: not archived, or a file whose mtime is strictly
    newer than the archived one. Archived folders never. Adds ``op``
    (``NEW``/``UPDATE``) and ``drive_id``."""
    a = archive.select(F.col("path").alias("__a_path"), F.col("drive_id"),
                       F.col("date_modified_on_disk").alias("__a_time"))
    j = local.join(a, F.col("path") == F.col("__a_path"), "left")
    keep = F.col("__a_path").isNull() | (~F.col("is_dir") & (F.col("mtime") > F.col("__a_time")))
    return (j.filter(keep)
            .withColumn("op", F.when(F.col("__a_path").isNull(), "NEW").otherwise("UPDATE"))
            .drop("__a_path", "__a_time"))


def collides(plan: DataFrame, local: DataFrame, dest_col: str = "dest_path") -> DataFrame:
    """``exists_locally`` when the destination is already on disk and
    ``dup_dest`` when two plan rows share one destination.

    Duplicate detection is a partial (map-side combined) count per
    destination joined back, so a hot destination does not land in one task.
    """
    loc = local.select(F.col("path").alias("__dest"), F.lit(True).alias("__exists"))
    dup = (plan.groupBy(F.col(dest_col).alias("__dest2")).agg(F.count(F.lit(1)).alias("__n")))
    out = plan.join(loc, F.col(dest_col) == F.col("__dest"), "left").join(
        dup, F.col(dest_col).eqNullSafe(F.col("__dest2")), "left")
    return (out.withColumn("exists_locally", F.coalesce(F.col("__exists"), F.lit(False)))
            .withColumn("dup_dest", F.coalesce(F.col("__n"), F.lit(1)) > 1)
            .drop("__dest", "__exists", "__dest2", "__n"))
