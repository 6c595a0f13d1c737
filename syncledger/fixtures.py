"""Input inventories derived from the TPC-H-like test tables.

The tree is root -> region -> nation -> customer (folders) -> order (file).
Residues of the order key decide which side holds a file and which version
each side has (see FIXTURES.md). The four inventories are written once per
scale factor as Parquet below the shared checkpoint folder and read back, so
every query starts from plain scans with real size statistics.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .session import scratch_path

FIXTURE_VERSION = "v1"
FOLDER_MIME = "application/vnd.folder"

# Fixed values of the fixture set-up (FIXTURES.md "Constants").
ROOT_PATHS = ["/data/AFRICA", "/data/ASIA"]
EXCLUDED_PATHS = ["/data/AFRICA/NATION_5", "/data/ASIA/NATION_7"]
EXCLUDED_RULES = ["*.pyc", "*.tmp"]
LAST_SYNC_TIME = "1998-01-01 00:00:00"
TOP_ID = "root"


def _ts(text: str):
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def _days(col, n: int):
    return col + F.expr(f"INTERVAL {n} DAY")


def read_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _fx_file(t) -> DataFrame:
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = t["region"].select("r_regionkey", "r_name")
    j = (o.join(c, F.col("c_custkey") == F.col("o_custkey"))
         .join(n, F.col("n_nationkey") == F.col("c_nationkey"))
         .join(r, F.col("r_regionkey") == F.col("n_regionkey")))
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    ext = F.when(k % 7 == 0, ".pyc").when(k % 7 == 1, ".tmp").otherwise(".csv")
    return j.select(
        k.alias("k"),
        F.concat(F.lit("o"), k.cast("string")).alias("file_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_id"),
        F.concat(F.lit("Order_"), k.cast("string"), ext).alias("name"),
        F.concat_ws("/", F.lit("/data"), F.col("r_name"), F.col("n_name"), F.col("c_name")).alias("dir_path"),
        F.when(k % 16 == 7, "X").when((k % 4 == 1) | (k % 4 == 3), "R").otherwise("A").alias("remote_ver"),
        F.when(k % 16 == 7, "X").when((k % 4 == 2) | (k % 4 == 3), "L").otherwise("A").alias("local_ver"),
        F.when(k % 3 == 0, d).when(k % 3 == 1, _days(d, 1)).otherwise(_days(d, 4)).alias("remote_time"),
        F.when(k % 2 == 0, d).otherwise(_days(d, 2)).alias("local_time"),
        _days(d, 1).alias("archive_time"),
        (F.lit(1) + k % 1000).cast("bigint").alias("size"),
    )


def _fx_dir(t) -> DataFrame:
    r = t["region"].select("r_regionkey", "r_name")
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    nr = n.join(r, F.col("r_regionkey") == F.col("n_regionkey"))
    none = F.lit(None).cast("string")
    top = t["region"].limit(1).select(
        F.lit(TOP_ID).alias("file_id"), none.alias("parent_id"), F.lit("data").alias("name"),
        F.lit("/data").alias("path"), F.lit(-1).cast("bigint").alias("k"))
    regions = r.select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("file_id"),
        F.lit(TOP_ID).alias("parent_id"), F.col("r_name").alias("name"),
        F.concat(F.lit("/data/"), F.col("r_name")).alias("path"), F.lit(-1).cast("bigint").alias("k"))
    nations = nr.select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("file_id"),
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"),
        F.col("n_name").alias("name"),
        F.concat_ws("/", F.lit("/data"), F.col("r_name"), F.col("n_name")).alias("path"),
        F.lit(-1).cast("bigint").alias("k"))
    customers = c.join(nr, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("file_id"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_id"),
        F.col("c_name").alias("name"),
        F.concat_ws("/", F.lit("/data"), F.col("r_name"), F.col("n_name"), F.col("c_name")).alias("path"),
        F.col("c_custkey").cast("bigint").alias("k"))
    return top.unionByName(regions).unionByName(nations).unionByName(customers)


def build_views(t) -> dict[str, DataFrame]:
    """Lazily defined inventories (not yet materialised)."""
    fx_file, fx_dir = _fx_file(t), _fx_dir(t)
    k = F.col("k")
    none = F.lit(None).cast("string")
    remote = fx_dir.select(
        "file_id", "name", "parent_id", F.lit(FOLDER_MIME).alias("mime_type"), none.alias("md5sum"),
        _ts("1995-01-01 00:00:00").alias("modified_time"), F.lit(0).cast("bigint").alias("size"),
        (k % 23 == 4).alias("trashed"),
    ).unionByName(fx_file.filter(k % 11 != 3).select(
        "file_id", "name", "parent_id", F.lit("text/csv").alias("mime_type"),
        F.md5(F.concat("file_id", "remote_ver")).alias("md5sum"),
        F.col("remote_time").alias("modified_time"), "size", (k % 13 == 5).alias("trashed"),
    ))
    local = fx_dir.filter((k == -1) | (k % 17 != 0)).select(
        "path", F.lit(True).alias("is_dir"), _ts("1995-01-01 00:00:00").alias("mtime"),
        none.alias("md5sum"), F.lit(0).cast("bigint").alias("size"),
    ).unionByName(fx_file.filter((k % 6 != 5) & (F.substring("parent_id", 2, 1 << 20).cast("bigint") % 17 != 0)).select(
        F.concat_ws("/", "dir_path", "name").alias("path"), F.lit(False).alias("is_dir"),
        F.col("local_time").alias("mtime"), F.md5(F.concat("file_id", "local_ver")).alias("md5sum"), "size",
    ))
    archive = fx_dir.filter((k == -1) | (k % 19 != 0)).select(
        "path", F.col("file_id").alias("drive_id"), _ts("1995-01-01 00:00:00").alias("date_modified_on_disk"),
        F.lit("").alias("md5sum"),
    ).unionByName(fx_file.filter(k % 5 != 4).select(
        F.concat_ws("/", "dir_path", "name").alias("path"), F.col("file_id").alias("drive_id"),
        F.col("archive_time").alias("date_modified_on_disk"),
        F.when(k % 97 == 0, none).otherwise(F.md5(F.concat("file_id", F.lit("A")))).alias("md5sum"),
    ))
    return {"remote_files": remote, "local_files": local, "archive": archive, "fx_file": fx_file}


def build_changes(events: DataFrame, remote: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    e = events.select(
        eid.alias("seq"), F.col("ts"),
        (F.col("event_type") == "error").alias("removed"),
        (F.col("event_type") == "signup").alias("trashed_e"),
        F.when(eid % 50 == 0, F.concat(F.lit("zzz"), eid.cast("string")))
        .when(eid % 40 == 1, F.concat(F.lit("c"), F.col("user_id").cast("string")))
        .otherwise(F.concat(F.lit("o"), (F.col("user_id") * 10 + eid % 10).cast("string"))).alias("file_id"),
    )
    f = remote.select(F.col("file_id").alias("f_id"), "name", "mime_type", "md5sum", "parent_id",
                      F.col("modified_time").alias("f_time"))
    return e.join(f, F.col("file_id") == F.col("f_id"), "left").select(
        "seq", "file_id", "removed", F.col("trashed_e").alias("trashed"), "name", "mime_type", "md5sum",
        "parent_id", F.when(F.col("seq") % 2 == 0, F.col("ts")).otherwise(F.col("f_time")).alias("modified_time"),
    )


@dataclass
class Inventories:
    remote_files: DataFrame
    local_files: DataFrame
    archive: DataFrame
    changes: DataFrame
    exclusions: DataFrame
    roots: DataFrame
    paths: dict

    @property
    def R(self):  # noqa: N802 - short names follow the survey
        return self.remote_files

    @property
    def L(self):  # noqa: N802
        return self.local_files

    @property
    def A(self):  # noqa: N802
        return self.archive

    @property
    def C(self):  # noqa: N802
        return self.changes


_CACHE: dict[tuple, Inventories] = {}


def _materialise(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def exclusions_df(spark: SparkSession) -> DataFrame:
    rows = [("path", p) for p in EXCLUDED_PATHS] + [("rule", r) for r in EXCLUDED_RULES]
    return spark.createDataFrame(rows, "kind string, value string")


def roots_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in ROOT_PATHS], "path string")


def load(spark: SparkSession, sf_dir: str) -> Inventories:
    """Inventories for one test-data folder, materialised once per session."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _CACHE:
        return _CACHE[key]
    import inspect
    code = "".join(inspect.getsource(f) for f in (_fx_file, _fx_dir, build_views, build_changes))
    tag = hashlib.sha1(f"{FIXTURE_VERSION}|{sf_dir}|{code}".encode()).hexdigest()[:12]
    base = scratch_path(spark, "fixtures", tag)
    t = read_tables(spark, sf_dir, ["orders", "customer", "nation", "region", "events"])
    views = build_views(t)
    remote = _materialise(spark, views["remote_files"], f"{base}/remote_files")
    local = _materialise(spark, views["local_files"], f"{base}/local_files")
    archive = _materialise(spark, views["archive"], f"{base}/archive")
    changes = _materialise(spark, build_changes(t["events"], remote), f"{base}/changes")
    paths = {n: f"{base}/{n}" for n in ("remote_files", "local_files", "archive", "changes")}
    inv = Inventories(remote, local, archive, changes, exclusions_df(spark), roots_df(spark), paths)
    _CACHE[key] = inv
    return inv
