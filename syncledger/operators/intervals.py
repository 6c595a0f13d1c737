"""Interval labels of a parent-pointer tree (J14, H4 without a walk).

Every node gets the numbers ``enter`` and ``exit`` of a pre-order (siblings by
``file_id``): the nodes at or below it are those whose ``enter`` lies between
them. An ancestor test is two comparisons, a subtree one range of a stored
listing. The numbers come from the sizes of subtrees and running sums over
siblings; nothing is walked node by node.

Labels belong to one state of the listing: store them with it
(:func:`write_labelled`) and make them anew when it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import FOLDER_MIME
from .hierarchy import TreeCycle, lineage
from .scan import running
from .semijoin import null_safe_key

LABELS = ["enter", "exit", "depth", "remote_path"]


def interval_labels(remote: DataFrame) -> DataFrame:
    """``file_id, enter, exit, depth, remote_path`` of every node; ``remote_path`` as in H3, from the top.

    Nodes without a parent, or with one that is not listed, are tops: their
    trees follow each other. Ids must be unique; nodes on or below a parent
    cycle raise :class:`TreeCycle`. One folder may hold any share of all nodes:
    siblings are summed along ranges, not in one task."""
    nodes = remote.select("file_id", "parent_id", "name")
    kept = lineage(nodes)
    lost = [r["file_id"] for r in kept.filter("cyclic").select("file_id").limit(5).collect()]
    if lost:
        raise TreeCycle(f"nodes without a root, such as {lost} (parent cycle)")
    children = nodes.filter("parent_id IS NOT NULL").groupBy("parent_id").agg(F.count(F.lit(1)).alias("__n"))
    # a folder holds itself and the children of every folder at or below it
    sizes = kept.join(children, F.col("file_id") == F.col("parent_id")) \
        .select(F.explode(F.col("chain")["id"]).alias("__sid"), "__n") \
        .groupBy("__sid").agg((F.sum("__n") + 1).alias("__size"))
    unknown = children.select(F.col("parent_id").alias("__unknown")).join(
        kept.select(F.col("file_id").alias("__unknown")), "__unknown", "left_anti")
    up = null_safe_key(F.col("parent_id"), F.col("file_id"), "top")
    sized = nodes.join(sizes, F.col("file_id") == F.col("__sid"), "left").withColumn("__up", up) \
        .join(unknown, F.col("__up") == F.col("__unknown"), "left") \
        .select("file_id", "name", F.when(F.col("__unknown").isNull(), F.col("parent_id")).alias("__parent"),
                F.coalesce("__size", F.lit(1)).cast("bigint").alias("__size"))
    placed = running(sized, ["__parent"], ["file_id"], "__size", "sum", "__before")
    # a child begins one after its parent, behind its earlier siblings
    placed = placed.withColumn("__off", F.col("__before") + F.when(F.col("__parent").isNull(), 0).otherwise(1)) \
        .drop("__before").checkpoint(eager=True)
    steps = placed.join(kept.select(F.col("file_id").alias("__k")), F.col("file_id") == F.col("__k"), "left_semi") \
        .select(F.col("file_id").alias("__anc"), "__off")
    folders = kept.select(F.col("file_id").alias("__folder"), F.explode(F.col("chain")["id"]).alias("__anc")) \
        .join(steps, "__anc").groupBy("__folder").agg(F.sum("__off").alias("__start"))
    folders = folders.join(kept.select(F.col("file_id").alias("__folder"), F.size("chain").alias("__depth"),
                                       F.array_join(F.reverse(F.col("chain")["name"]), "/").alias("__above")), "__folder")
    key = null_safe_key(F.col("__parent"), F.col("file_id"), "top")
    j = placed.withColumn("__up", key).join(folders, F.col("__up") == F.col("__folder"), "left")
    enter = F.coalesce("__start", F.lit(0)) + F.col("__off")
    return j.select("file_id", enter.cast("bigint").alias("enter"), (enter + F.col("__size") - 1).cast("bigint").alias("exit"),
                    F.coalesce("__depth", F.lit(0)).cast("bigint").alias("depth"),
                    F.concat(F.lit("/"), F.concat_ws("/", "__above", "name")).alias("remote_path"))


def with_labels(remote: DataFrame) -> DataFrame:
    """The listing with the columns of :data:`LABELS`."""
    return remote.join(interval_labels(remote), "file_id").select(*remote.columns, *LABELS)


def write_labelled(remote: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """The labelled listing as Parquet in the order of ``enter`` (a subtree is a range of few files), read back."""
    spark = remote.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_labels(remote).repartitionByRange(n, "enter").sortWithinPartitions("enter") \
        .write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def is_ancestor_labelled(labelled: DataFrame, pairs: DataFrame, folder_col: str = "folder_id",
                         file_col: str = "file_id") -> DataFrame:
    """J14 on a labelled listing: ``pairs`` with ``is_ancestor``; false for ids that are not listed or NULL."""
    at = labelled.select("file_id", "enter", "exit")
    f = at.select(F.col("file_id").alias("__f"), F.col("enter").alias("__from"), F.col("exit").alias("__to"))
    x = at.select(F.col("file_id").alias("__x"), F.col("enter").alias("__at"))
    j = pairs.join(f, F.col(folder_col) == F.col("__f"), "left").join(x, F.col(file_col) == F.col("__x"), "left")
    inside = F.coalesce(F.col("__at").between(F.col("__from"), F.col("__to")), F.lit(False))
    return j.select(*pairs.columns, inside.alias("is_ancestor"))


def subtree(labelled: DataFrame, folder_id: str) -> DataFrame:
    """All nodes at or below ``folder_id``, trashed ones too: one range of the stored listing. An id that is not listed
    gives no rows."""
    at = labelled.filter(F.col("file_id") == folder_id).select("enter", "exit").limit(1).collect()
    if not at:
        return labelled.limit(0)
    return labelled.filter(F.col("enter").between(at[0]["enter"], at[0]["exit"]))


def walk_labelled(labelled: DataFrame, folder_id: str, folder_mime: str = FOLDER_MIME) -> DataFrame:
    """H4 on a labelled listing, the rows of :func:`~syncledger.operators.hierarchy.walk` without a level by level walk.

    The range of the folder is read once. A trashed node, or one that is no
    folder, hides what is below it: a node is hidden where the highest ``exit``
    of such nodes before it reaches it."""
    below = subtree(labelled, folder_id)
    is_root = F.col("file_id") == folder_id
    hides = F.coalesce((F.col("trashed") & ~is_root) | (F.col("mime_type") != folder_mime), F.lit(True))
    seen = running(below.withColumn("__hides", F.when(hides, F.col("exit"))), [], ["enter"], "__hides", "max", "__hidden")
    seen = seen.filter(is_root | (~F.col("trashed") & (F.col("__hidden").isNull() | (F.col("__hidden") < F.col("enter")))))
    top = labelled.filter(is_root).select(F.col("name").alias("__name"), F.col("remote_path").alias("__top"),
                                          F.col("depth").alias("__level")).limit(1)
    path = F.concat("__name", F.substring("remote_path", F.length("__top") + 1, F.length("remote_path")))
    return seen.join(F.broadcast(top), F.lit(True)).select(
        *[c for c in labelled.columns if c not in LABELS], path.alias("path"),
        (F.col("depth") - F.col("__level")).alias("depth"),
        F.when(F.col("mime_type") == folder_mime, "#folder").otherwise("#file").alias("type"), is_root.alias("is_root"))
