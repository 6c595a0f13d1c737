"""Ordered computations.

The one hard part is numbering rows inside a group when a single group may
hold a large share of all rows: ``row_number() OVER (PARTITION BY g ...)``
would sort that whole group in one task. :func:`group_row_number` instead
range-partitions by ``(group, order)`` so a hot group is spread over many
tasks, numbers rows locally, and adds per-(partition, group) offsets from a
small table of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import basename, parent_dir, path_depth
from ..session import checkpoint_dir

DELETE_BATCH = 32  # fixed value: requests per delete batch of the remote service


def group_row_number(df: DataFrame, by: list[str], order: list[str], out: str = "rn",
                     num_partitions: int | None = None) -> DataFrame:
    """Exact ``row_number()`` (1-based) per ``by`` group ordered by ``order``,
    without putting any group into a single task. ``order`` must make rows
    unique within a group for the numbering to be deterministic."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) \
        .withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
    checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)  # fixes partition ids and positions
    gkeys = ["__pid", *by]
    counts = ranged.groupBy(*gkeys).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by).orderBy("__pid") if by else Window.orderBy("__pid")
    counts = counts.withColumn("__off", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    # groups may be NULL, so the offsets are joined null-safely; without groups there is one row per partition
    renamed = counts.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(gkeys)], "__first", "__off")
    same = F.lit(True)
    for i, c in enumerate(gkeys):
        same = same & ranged[c].eqNullSafe(renamed[f"__g{i}"])
    joined = ranged.join(renamed if by else F.broadcast(renamed), same) \
        .drop(*[f"__g{i}" for i in range(len(gkeys))])
    rn = F.coalesce(F.col("__off"), F.lit(0)) + (F.col("__mid") - F.col("__first")) + 1
    return joined.withColumn(out, rn.cast("bigint")).drop("__pid", "__mid", "__first", "__off")


def assign_batches(plan: DataFrame, size: int = DELETE_BATCH, by: list[str] | None = None,
                   order: str = "drive_id", out: str = "batch") -> DataFrame:
    """Cut an id list into batches of ``size`` (in ``order`` per ``by`` group):
    ``batch = (row_number - 1) // size``."""
    by = list(by or [])
    numbered = group_row_number(plan, by, [order], out="__rn")
    return numbered.withColumn(out, F.floor((F.col("__rn") - 1) / size).cast("bigint")).drop("__rn")


def parents_first(plan: DataFrame, path_col: str = "path", type_col: str = "type") -> DataFrame:
    """O1: folders before their content and before files:
    ``orderBy(stage, depth, path)`` with ``stage`` 0 for folders, 1 for files."""
    staged = plan.withColumn("stage", F.when(F.col(type_col) == "#folder", 0).otherwise(1)) \
        .withColumn("depth", path_depth(F.col(path_col)))
    return staged.orderBy("stage", "depth", path_col)


# The conflict answers and what each sticky answer stands for.
ANSWERS = {"y": "accept", "n": "reject", "o": "accept_renamed"}
STICKY = {"a": "y", "r": "n", "c": "o"}


def resolve_conflicts(conflicts: DataFrame, answers: DataFrame, order: str = "seq", by: list[str] | None = None,
                      default: str = "n") -> DataFrame:
    """Replay the interactive conflict loop over an answers table.

    ``answers(seq, answer)``: ``y`` accept, ``n`` reject, ``o`` accept under a
    new name, ``a``/``r``/``c`` the same for this and every later row. The
    first sticky answer (by ``order``, per ``by`` group) fixes all rows from it
    on; earlier rows use their own answer; rows without a valid answer get
    ``default``. Adds ``answer`` (effective y/n/o) and ``resolution``.
    """
    by = list(by or [])
    a = answers.select(F.col("seq").alias("__aseq"), F.col("answer").alias("__ans"))
    j = conflicts.join(a, F.col(order) == F.col("__aseq"), "left")
    sticky = j.filter(F.col("__ans").isin(list(STICKY)))
    grp = by if by else []
    first = sticky.groupBy(*grp).agg(F.min_by(F.col("__ans"), F.col(order)).alias("__sticky"),
                                     F.min(F.col(order)).alias("__sticky_from"))
    if grp:
        j = j.join(first, grp, "left")
    else:
        j = _attach_scalar(j, first, conflicts.schema[order].dataType.simpleString())
    mapped_sticky = F.when(F.col("__sticky") == "a", "y").when(F.col("__sticky") == "r", "n") \
        .when(F.col("__sticky") == "c", "o")
    own = F.when(F.col("__ans").isin(list(ANSWERS)), F.col("__ans")).otherwise(F.lit(default))
    eff = F.when(F.col("__sticky_from").isNotNull() & (F.col(order) >= F.col("__sticky_from")), mapped_sticky) \
        .otherwise(own)
    res = F.when(eff == "y", "accept").when(eff == "n", "reject").otherwise("accept_renamed")
    return j.withColumn("answer", eff).withColumn("resolution", res) \
        .drop("__aseq", "__ans", "__sticky", "__sticky_from")


def _attach_scalar(df: DataFrame, one_row: DataFrame, order_type: str) -> DataFrame:
    """Attach a global single-row aggregate to every row (one row read on the driver)."""
    row = one_row.first()
    sticky = row["__sticky"] if row else None
    start = row["__sticky_from"] if row else None
    return df.withColumn("__sticky", F.lit(sticky).cast("string")).withColumn(
        "__sticky_from", F.lit(start).cast(order_type))


_NAME_RE = r"^(.*?)( \((\d{1,18})\))?(\.[^./]*)?$"  # longer numbers belong to the stem


def free_name(plan: DataFrame, local: DataFrame, dest_col: str = "dest_path", order_col: str = "seq",
              out: str = "free_path") -> DataFrame:
    """A destination that clashes with nothing: ``stem (n).ext`` in the same
    folder, where ``n`` is the highest ``n`` already used for that stem and
    extension, locally or by the plan's own destinations (0 if none), plus the
    rank (by ``order_col``) among the plan rows of that folder, stem and
    extension. A NULL destination gets none."""
    def parts(df, col):
        name = basename(F.col(col))
        return df.withColumn("__dir", parent_dir(F.col(col))) \
            .withColumn("__stem", F.regexp_extract(name, _NAME_RE, 1)) \
            .withColumn("__num", F.regexp_extract(name, _NAME_RE, 3)) \
            .withColumn("__ext", F.regexp_extract(name, _NAME_RE, 4))
    key = ["__dir", "__stem", "__ext"]
    names = local.select(F.col("path").alias("__p")).unionByName(plan.select(F.col(dest_col).alias("__p")))
    numbered = names.filter(F.col("__p").contains(" ("))  # a name without a number counts as 0, as no name does
    used = parts(numbered, "__p").groupBy(*key) \
        .agg(F.max(F.coalesce(F.expr("try_cast(__num AS bigint)"), F.lit(0))).alias("__max"))
    ranked = group_row_number(parts(plan, dest_col), key, [order_col, dest_col], out="__rank")
    keyed = ranked.join(used, key, "left")
    n = F.coalesce(F.col("__max"), F.lit(0)) + F.col("__rank")
    newname = F.concat(F.col("__stem"), F.lit(" ("), n.cast("string"), F.lit(")"), F.col("__ext"))
    newpath = F.when(F.col("__dir") == "/", F.concat(F.lit("/"), newname)).otherwise(
        F.concat(F.col("__dir"), F.lit("/"), newname))
    return keyed.withColumn(out, newpath).drop(*key, "__num", "__max", "__rank")
