"""Catalog (archive) updates as DataFrame -> DataFrame functions.

The archive is ``path`` (unique), ``drive_id`` (unique),
``date_modified_on_disk``, ``md5sum`` (``''`` marks a folder). Updates never
mutate in place: each function returns the next archive state, which
:mod:`syncledger.sources.store` writes as a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import is_descendant_or_self, replace_prefix
from ..session import checkpoint_dir
from .semijoin import BATCH_KEYS, broadcast_if_few

ARCHIVE_COLS = ["path", "drive_id", "date_modified_on_disk", "md5sum"]
FOLDER_MD5 = ""  # fixed value: the md5 stored for folders


class UniquenessError(ValueError):
    """An insert would break the uniqueness of ``path`` or ``drive_id``."""


def _once(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder: what is read several times is worked out once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _latest(updates: DataFrame, key: str, seq_col: str) -> DataFrame:
    """Last update per key (by ``seq_col``); partial aggregation keeps a hot key cheap."""
    cols = [c for c in updates.columns if c != key]
    latest = updates.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(seq_col)).alias("__u"))
    return latest.select(key, *[F.col("__u")[c].alias(c) for c in cols])


def upsert_archive(archive: DataFrame, updates: DataFrame, seq_col: str = "seq", check: bool = True) -> DataFrame:
    """Create-or-update. Rows with a ``drive_id`` are keyed by it (path,
    time and md5 are replaced, a new id is created); rows without one are keyed
    by ``path`` and only update time and md5 of an existing row. Updates apply in
    the order of ``seq_col``: of all that reach a row, by id or by path, the last
    one wins. An id moved onto a path that another id holds is a clash and an
    error (a few keys are read back), as both columns are unique; ``check=False``
    leaves the test to the caller (:func:`path_clashes`, :func:`check_unique`)."""
    a = archive.select(*ARCHIVE_COLS)
    if check:  # the updates may be a whole plan, and are read several times from here on
        updates = _once(updates.select(*ARCHIVE_COLS, seq_col))
    by_id = _latest(updates.filter(F.col("drive_id").isNotNull()).select(*ARCHIVE_COLS, seq_col), "drive_id",
                    seq_col).select(*ARCHIVE_COLS, F.col(seq_col).alias("__useq"))
    # replace-or-insert by id: rows whose id is updated leave, the latest updates come in.
    # A left anti join (not a full outer join) lets AQE broadcast a small update set,
    # so a handful of updates does not shuffle the whole archive.
    ids = by_id.select("drive_id")
    if check:
        by_id = _once(by_id)
        ids, _few = broadcast_if_few(by_id.select("drive_id"))
    kept = a.join(ids, "drive_id", "left_anti").select(*ARCHIVE_COLS)
    if check:
        bad = [r["path"] for r in _clashes(kept, by_id).limit(5).collect()]
        if bad:
            raise UniquenessError(f"update breaks the uniqueness of path: {bad}")
    merged = kept.withColumn("__useq", F.lit(None)).unionByName(by_id)
    by_path_src = updates.filter(F.col("drive_id").isNull())
    by_path = _latest(by_path_src.select("path", "date_modified_on_disk", "md5sum", seq_col), "path", seq_col)
    p = by_path.select(F.col("path").alias("__p"), F.col("date_modified_on_disk").alias("__pt"),
                       F.col("md5sum").alias("__pm"), F.col(seq_col).alias("__pseq"))
    if check:
        p, _few = broadcast_if_few(p, BATCH_KEYS // 10)
    j2 = merged.join(p, F.col("path") == F.col("__p"), "left")
    hit = F.col("__p").isNotNull() & (F.col("__useq").isNull() | (F.col("__pseq") >= F.col("__useq")))
    return j2.select(
        "path", "drive_id",
        F.when(hit, F.col("__pt")).otherwise(F.col("date_modified_on_disk")).alias("date_modified_on_disk"),
        F.when(hit, F.col("__pm")).otherwise(F.col("md5sum")).alias("md5sum"))


def _touched(archive: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The archive rows whose ``key`` occurs in ``batch``, whose keys are worked out once. Few keys are sent to the
    archive; for none of them it is not read."""
    keys, _few = broadcast_if_few(batch.select(key).filter(F.col(key).isNotNull()).distinct())
    if keys.isEmpty():
        return archive.filter(F.lit(False))
    return archive.join(keys, key, "left_semi").select(archive.columns)


def upsert_changes(archive: DataFrame, updates: DataFrame, seq_col: str = "seq", check: bool = True) -> DataFrame:
    """U1 as a delta: only the rows that :func:`upsert_archive` would write, with ``removed`` false. The archive is
    scanned for the ids and paths of the updates, and not rewritten; clashes are found as there."""
    a, updates = archive.select(*ARCHIVE_COLS), _once(updates.select(*ARCHIVE_COLS, seq_col))
    touched = _once(_touched(a, updates, "drive_id").unionByName(_touched(a, updates, "path")).distinct())
    return upsert_archive(touched, updates, seq_col, check).withColumn("removed", F.lit(False))


def delete_changes(archive: DataFrame, keys: DataFrame, field: str = "drive_id", key_col: str | None = None) -> DataFrame:
    """U3 as a delta: the rows that :func:`delete_archive` would drop, with ``removed`` true."""
    batch = keys.select(F.col(key_col or field).alias(field))
    return _touched(archive.select(*ARCHIVE_COLS), batch, field).withColumn("removed", F.lit(True))


def _clashes(kept: DataFrame, by_id: DataFrame) -> DataFrame:
    moved = by_id.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return _touched(kept.select("path"), moved, "path") \
        .unionByName(moved.filter("n > 1").select("path")).distinct()


def path_clashes(archive: DataFrame, updates: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Paths (``path``) that two ids would hold after :func:`upsert_archive` of ``updates``."""
    by_id = _latest(updates.filter(F.col("drive_id").isNotNull()).select(*ARCHIVE_COLS, seq_col), "drive_id", seq_col)
    return _clashes(archive.join(by_id.select("drive_id"), "drive_id", "left_anti"), by_id)


def check_unique(archive: DataFrame) -> DataFrame:
    """Keys used more than once: ``column, key, n``."""
    dup_p = archive.groupBy(F.col("path").alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1).withColumn("column", F.lit("path"))
    dup_i = archive.groupBy(F.col("drive_id").alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1).withColumn("column", F.lit("drive_id"))
    return dup_p.unionByName(dup_i).select("column", "key", "n")


def insert_archive(archive: DataFrame, rows: DataFrame, check: bool = True) -> DataFrame:
    """Insert rows; a clash on ``path`` or ``drive_id`` is an error (checked
    eagerly when ``check``: the new rows against each other and, by semi joins,
    against the archive; only a few offending keys are read back)."""
    out = archive.select(*ARCHIVE_COLS).unionByName(rows.select(*ARCHIVE_COLS))
    if check:
        clashes = check_unique(rows.select(*ARCHIVE_COLS))
        for column in ("path", "drive_id"):
            taken = archive.join(rows.select(column), column, "left_semi")
            clashes = clashes.unionByName(taken.select(F.lit(column).alias("column"), F.col(column).alias("key"),
                                                       F.lit(2).cast("bigint").alias("n")))
        bad = clashes.limit(5).collect()
        if bad:
            raise UniquenessError(f"insert breaks uniqueness: {[tuple(b) for b in bad]}")
    return out


def delete_archive(archive: DataFrame, keys: DataFrame, field: str = "drive_id", key_col: str | None = None) -> DataFrame:
    """Drop rows whose ``field`` is in ``keys``."""
    key_col = key_col or field
    return archive.join(keys.select(F.col(key_col).alias(field)).distinct(), field, "left_anti")


def rename_paths(archive: DataFrame, old: str, new: str, mode: str = "descendant") -> DataFrame:
    """U4: move a subtree: paths at/below ``old`` (``descendant``) or starting
    with it (``prefix``, the original tool's behaviour) get ``old`` replaced by
    ``new`` once, at the start."""
    hit = F.col("path").startswith(old) if mode == "prefix" else is_descendant_or_self(F.col("path"), F.lit(old))
    return archive.withColumn("path", F.when(hit, replace_prefix(F.col("path"), old, new)).otherwise(F.col("path")))


def record_uploads(archive: DataFrame, results: DataFrame, seq_col: str = "seq", check: bool = True) -> DataFrame:
    """After uploads: ``results(path, drive_id, mtime, md5sum[, seq])``.
    Folders carry ``md5sum = ''``. ``check`` reports path clashes as in U1."""
    r = results.select("path", "drive_id", F.col("mtime").alias("date_modified_on_disk"), "md5sum",
                       (F.col(seq_col) if seq_col in results.columns else F.lit(0)).alias(seq_col))
    return upsert_archive(archive, r, seq_col, check)


def record_downloads(archive: DataFrame, results: DataFrame, seq_col: str = "seq", check: bool = True) -> DataFrame:
    """After downloads: same shape; the md5 comes from the remote side."""
    return record_uploads(archive, results, seq_col, check)
