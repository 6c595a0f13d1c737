"""Aggregations over plans, logs and results (A1-A4).

All are ``groupBy`` with partial aggregation, so a hot group (one operation
type holding most rows) is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The operation rows of the transfer summary, in report order.
SUMMARY_OPS = ["NEWER", "UPDATED", "DELETED", "DOWNLOADED"]


def transfer_summary(log: DataFrame) -> DataFrame:
    """A1: count and bytes per operation from a transfer log
    (``op`` in NEW / UPDATE / DELETE / DOWNLOAD, ``size``).

    NEW (folders too, 0 bytes) -> NEWER, UPDATE -> UPDATED, DELETE -> DELETED
    (bytes unknown: NULL), DOWNLOAD (local folders too, 0 bytes) ->
    DOWNLOADED. All four rows are always present.
    """
    label = (F.when(F.col("op") == "NEW", "NEWER").when(F.col("op") == "UPDATE", "UPDATED")
             .when(F.col("op") == "DELETE", "DELETED").when(F.col("op") == "DOWNLOAD", "DOWNLOADED"))
    agg = log.select(label.alias("operation"), F.coalesce(F.col("size"), F.lit(0)).alias("size")) \
        .filter(F.col("operation").isNotNull()) \
        .groupBy("operation").agg(F.count(F.lit(1)).alias("count"), F.sum("size").alias("bytes"))
    spark = log.sparkSession
    ops = spark.createDataFrame([(o, k) for k, o in enumerate(SUMMARY_OPS)], "operation string, ord int")
    out = ops.join(F.broadcast(agg), "operation", "left")
    return out.select(
        "operation", "ord", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        F.when(F.col("operation") == "DELETED", F.lit(None).cast("bigint"))
        .otherwise(F.coalesce(F.col("bytes"), F.lit(0)).cast("bigint")).alias("bytes"))


def decision_counts(reconciled: DataFrame) -> DataFrame:
    """A3: rows per (decision, why)."""
    return reconciled.groupBy("decision", "why").agg(F.count(F.lit(1)).alias("n"))


def result_outcomes(results: DataFrame, status_col: str = "status") -> DataFrame:
    """A4: classify delete results. ``status`` NULL or 2xx -> ``deleted``; 404 ->
    ``deleted`` (already gone); 403 -> ``retry`` (rate limited); other ->
    ``failed``. Adds ``outcome`` and ``forget`` (drop the archive row)."""
    s = F.col(status_col)
    outcome = (F.when(s.isNull() | ((s >= 200) & (s < 300)), "deleted").when(s == 404, "deleted")
               .when(s == 403, "retry").otherwise("failed"))
    return results.withColumn("outcome", outcome).withColumn("forget", F.col("outcome") == "deleted")
