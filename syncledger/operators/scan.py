"""Running aggregates along an order, without putting a group or the whole table into one task.

:func:`running` range-partitions by ``(group, order)``, works out the aggregate
inside every partition and adds what the earlier partitions carry over. A
partition has at most one group that begins before it, so the carries are at
most one row per partition and are broadcast. Every row is exchanged twice,
whatever the size of its group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_COMBINE = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, lambda a, b: F.greatest(a, b)),  # NULLs are skipped
}


def running(df: DataFrame, by: list[str], order: list[str], value: str, how: str, out: str,
            num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``out`` = ``how`` (``sum`` or ``max``) of ``value`` over the rows of the same ``by`` group (NULL is a
    group) strictly before the row in ``order``. The first row of a group gets 0 for a sum and NULL for a maximum. Rows
    that tie in ``order`` come one after the other, in no fixed order."""
    spark = df.sparkSession
    agg, combine = _COMBINE[how]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(n, *by, *order).withColumn("__pid", F.spark_partition_id()) \
        .checkpoint(eager=True)  # fixes the partition of every row
    w = Window.partitionBy("__pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("__inside", agg(value).over(w))
    totals = ranged.groupBy("__pid", *by).agg(agg(value).alias("__total"))
    earlier = Window.partitionBy(*by).orderBy("__pid") if by else Window.orderBy("__pid")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("__carry", agg("__total").over(earlier)).filter("__carry IS NOT NULL").select(
        F.col("__pid").alias("__cpid"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(by)], "__carry")
    same = F.col("__pid") == F.col("__cpid")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__c{i}"))
    joined = inside.join(F.broadcast(carry), same, "left")  # at most one row a partition
    return joined.select(*df.columns, combine(F.col("__inside"), F.col("__carry")).alias(out))
