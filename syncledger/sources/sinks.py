"""Report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hierarchy import tree_listing

UNKNOWN_FIELD = "---"  # fixed value: placeholder for an unknown log field


def transfer_log(plan: DataFrame) -> DataFrame:
    """S11 rows: ``operation, file_id, remote_path, local_path`` from a plan or
    results table (``op``, ``file_id``, ``remote_path``, ``local_path``);
    unknown fields become ``---``."""
    def f(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN_FIELD)) if c in plan.columns else F.lit(UNKNOWN_FIELD)
    return plan.select(F.col("op").alias("operation"), f("file_id").alias("file_id"),
                       f("remote_path").alias("remote_path"), f("local_path").alias("local_path"))


def write_transfer_log(plan: DataFrame, out: str, fmt: str = "csv") -> None:
    """Persist the transfer log (CSV with a header, or Parquet)."""
    log = transfer_log(plan)
    if fmt == "csv":
        log.write.mode("overwrite").option("header", "true").csv(out)
    else:
        log.write.mode("overwrite").parquet(out)


def write_tree_report(local: DataFrame, roots, files: bool, out: str) -> None:
    """One text listing per root, lines in tree order, written as
    ``out/root=<root>/part-*.txt``. Rows are range-partitioned by their sort
    key, so the order holds across part files without a single-task sort. The
    listing is scanned once for all roots."""
    ordered = tree_listing(local, list(roots), files).repartitionByRange("root", "sort_key").sortWithinPartitions("root", "sort_key")
    ordered.select("root", "line").write.mode("overwrite").partitionBy("root").text(out)
