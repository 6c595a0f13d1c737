"""Inventories stored bucketed and sorted by their join keys.

A table written here keeps its rows hashed by ``key`` into a fixed number of
files. Joins on the keys of two such tables with the same number of buckets
read bucket against bucket: no row is exchanged, on any later day. Keys of the
inventories are unique, so buckets are even.

Tables live in the session's catalog with their files under a folder of the
caller's, on storage that the executors share.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, key: str, folder: str, buckets: int, table: str | None = None) -> str:
    """``df`` as a table bucketed and sorted by ``key``: a file per bucket, as rows are brought together by the hash the
    buckets use. Returns its name (a new one if none is given); an existing table or folder is an error."""
    table = table or f"bucketed_{uuid.uuid4().hex}"
    if buckets < 1:
        raise ValueError("a bucketed table needs at least one bucket")
    df.repartition(buckets, F.col(key)).write.format("parquet").bucketBy(buckets, key).sortBy(key) \
        .option("path", folder).mode("errorifexists").saveAsTable(table)
    return table


@dataclass
class BucketedCatalog:
    """The inventories by the keys their joins use. The archive is kept by path (for the local side) and by id (for the
    remote side); a join picks the copy of its key."""

    spark: SparkSession
    local_table: str
    archive_path_table: str
    archive_id_table: str
    remote_table: str

    @property
    def local(self) -> DataFrame:
        return self.spark.table(self.local_table)

    @property
    def archive_by_path(self) -> DataFrame:
        return self.spark.table(self.archive_path_table)

    @property
    def archive_by_id(self) -> DataFrame:
        return self.spark.table(self.archive_id_table)

    @property
    def remote(self) -> DataFrame:
        return self.spark.table(self.remote_table)

    def drop(self) -> None:
        """Forget the tables; the files stay in their folder."""
        for t in (self.local_table, self.archive_path_table, self.archive_id_table, self.remote_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")


def write_catalog(local: DataFrame, archive: DataFrame, remote: DataFrame, base: str,
                  buckets: int | None = None) -> BucketedCatalog:
    """All inventories under ``base``, each with ``buckets`` buckets (the session's shuffle partitions if not given;
    choose them so that one fits a task's memory: bytes of the largest table / 128 MB)."""
    spark = local.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return BucketedCatalog(
        spark,
        write_bucketed(local, "path", f"{base}/local_by_path", n),
        write_bucketed(archive, "path", f"{base}/archive_by_path", n),
        write_bucketed(archive, "drive_id", f"{base}/archive_by_id", n),
        write_bucketed(remote, "file_id", f"{base}/remote_by_id", n))
