"""Versioned archive snapshots.

Each version is a Parquet folder ``<base>/version=<n>``. A version becomes
visible only after its data is fully written: its number is then appended to
``<base>/_versions`` (a small Parquet log). Readers take the highest logged
version, so a half-written snapshot (lost executor, failed job) is never read
and rerunning the write is safe.

A version is a whole archive or a delta: the rows that changed, with ``removed``
for those that left. A reader takes the last whole archive at or before the
version asked for and, by ``drive_id``, the last of the deltas after it; the
archive itself is scanned but not exchanged while the deltas are small.
:func:`compact_archive` folds deltas into a new whole archive.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.catalog import ARCHIVE_COLS

#: Kinds of versions in the log; entries without one are whole archives.
FULL, DELTA = "full", "delta"
_LOG = "version bigint, written_at timestamp_ntz, kind string"


def _log(spark: SparkSession, base: str) -> DataFrame | None:
    """The version log, or None where nothing was ever written. A base that holds
    snapshots but no readable log is an error, never an empty store."""
    if not exists(spark, base):
        return None
    try:
        spark.read.parquet(f"{base}/_versions")  # fails here where there is none
        return spark.read.schema(_LOG).parquet(f"{base}/_versions").fillna(FULL, ["kind"])
    except AnalysisException as e:
        raise RuntimeError(f"{base} holds files but no readable version log") from e


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds anything, on whatever file system Spark reads it from."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(where) and len(fs.listStatus(where)) > 0


def latest_version(spark: SparkSession, base: str) -> int | None:
    log = _log(spark, base)
    if log is None:
        return None
    v = log.agg(F.max("version")).first()[0]
    return None if v is None else int(v)


def read_archive(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The archive at ``version`` (latest published when ``None``)."""
    log = _log(spark, base)
    v = latest_version(spark, base) if version is None else version
    known = [] if log is None or v is None else log.filter(F.col("version") <= v).groupBy("kind").agg(
        F.max("version").alias("last")).collect()
    last = {r["kind"]: r["last"] for r in known}
    if FULL not in last or v not in last.values():
        raise FileNotFoundError(f"no published archive snapshot {'' if version is None else version} under {base}")
    whole = spark.read.parquet(f"{base}/version={last[FULL]}").select(*ARCHIVE_COLS)
    later = [r["version"] for r in log.filter((F.col("version") > last[FULL]) & (F.col("version") <= v))
             .select("version").collect()]  # the deltas since the last compaction
    if not later:
        return whole
    deltas = spark.read.parquet(*[f"{base}/version={n}" for n in sorted(later)])
    newest = deltas.groupBy("drive_id").agg(F.max_by(F.struct("path", "date_modified_on_disk", "md5sum", "removed"),
                                                     "version").alias("__u"))
    return whole.join(deltas.select("drive_id"), "drive_id", "left_anti").select(*ARCHIVE_COLS).unionByName(
        newest.filter("NOT __u.removed").select("__u.path", "drive_id", "__u.date_modified_on_disk", "__u.md5sum"))


def write_archive(df: DataFrame, base: str, partitions: int | None = None) -> int:
    """Write the next snapshot and publish it. Returns the new version."""
    spark = df.sparkSession
    v = _free_version(spark, base)
    out = df.select(*ARCHIVE_COLS)
    if partitions:
        out = out.repartition(partitions, "path")
    _publish(out, base, v, FULL)
    return v


def write_delta(changes: DataFrame, base: str) -> int:
    """S9 for a small change: ``changes`` (the columns of the archive and ``removed``, one row a ``drive_id``, as
    :func:`~syncledger.operators.catalog.upsert_changes` and ``delete_changes`` give them) as the next version.
    Returns it. There must be a whole archive to change."""
    spark = changes.sparkSession
    if latest_version(spark, base) is None:
        raise FileNotFoundError(f"no published archive snapshot under {base}")
    v = _free_version(spark, base)
    _publish(changes.select(*ARCHIVE_COLS, "removed", F.lit(v).cast("bigint").alias("version")), base, v, DELTA)
    return v


def compact_archive(spark: SparkSession, base: str, partitions: int | None = None) -> int:
    """Fold the deltas since the last whole archive into a new one; without any, nothing is written. Returns the latest
    version. Earlier versions stay as they are."""
    log = _log(spark, base)
    if log is None:
        raise FileNotFoundError(f"no published archive snapshot under {base}")
    if log.agg(F.max_by("kind", "version")).first()[0] == FULL:
        return latest_version(spark, base)
    return write_archive(read_archive(spark, base), base, partitions)


def _free_version(spark: SparkSession, base: str) -> int:
    current = latest_version(spark, base)
    v = 0 if current is None else current + 1
    while exists(spark, f"{base}/version={v}"):
        v += 1  # a snapshot that was never published, or is being written
    return v


def _publish(out: DataFrame, base: str, v: int, kind: str) -> None:
    # two writers that chose the same number do not overwrite each other: the second one fails here
    out.write.mode("errorifexists").parquet(f"{base}/version={v}")
    entry = out.sparkSession.createDataFrame([(v, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), kind)], _LOG)
    entry.write.mode("append").parquet(f"{base}/_versions")
