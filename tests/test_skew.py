"""A folder holding a third of all files: the walk stays correct, and with
broadcasts off the level join is split by AQE (skew join) rather than sent
to one task."""
from pyspark.sql import functions as F

from syncledger.operators import hierarchy as H

FOLDER = "application/vnd.folder"
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def listing(spark, n_files=30000, n_dirs=200):
    folders = spark.range(n_dirs).select(F.format_string("d%d", "id").alias("file_id"),
                                         F.format_string("d%d", "id").alias("name"), F.lit("top").alias("parent_id"),
                                         F.lit(FOLDER).alias("mime_type"))
    parent = F.when(F.col("id") % 3 == 0, F.lit("d0")).otherwise(F.format_string("d%d", F.col("id") % n_dirs))
    files = spark.range(n_files).select(F.format_string("f%d", "id").alias("file_id"),
                                        F.format_string("f%d", "id").alias("name"), parent.alias("parent_id"),
                                        F.lit("text/plain").alias("mime_type"))
    top = spark.range(1).select(F.lit("top").alias("file_id"), F.lit("top").alias("name"),
                                F.lit(None).cast("string").alias("parent_id"), F.lit(FOLDER).alias("mime_type"))
    return top.unionByName(folders).unionByName(files).select(
        "*", F.lit(None).cast("string").alias("md5sum"), F.lit(None).cast("timestamp_ntz").alias("modified_time"),
        F.lit(1).cast("bigint").alias("size"), F.lit(False).alias("trashed"))


def test_hot_folder_walk_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        nodes = listing(spark)
        w = H.walk(nodes, "top")
        assert w.count() == 30201
        # d0 gets every third file plus its share of the others
        want = nodes.filter(F.col("parent_id") == "d0").count()
        assert w.filter(F.col("path").startswith("top/d0/")).count() == want > 10000
        # the level join of the walk, as the walk plans it, ends up as a skew join
        front = nodes.filter((F.col("parent_id") == "top")).select(F.col("file_id").alias("__pid"))
        j = nodes.join(front, F.col("parent_id") == F.col("__pid"))
        j.collect()
        assert "SortMergeJoin(skew=true)" in j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_parent_of_chains_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        nodes = listing(spark)
        files = nodes.filter(F.col("mime_type") != FOLDER).select("file_id")
        anc = H.id_ancestors(nodes, files)
        assert anc.count() == 30000 * 3
        assert anc.filter((F.col("depth") == 1) & (F.col("ancestor_id") == "d0")).count() == \
            nodes.filter(F.col("parent_id") == "d0").count()
        # ids that share one parent: the left side of the left outer join with the parents' chains is hot
        state = files.join(nodes.select("file_id", "parent_id"), "file_id").select(
            F.col("file_id").alias("start_id"), F.array(F.col("file_id")).alias("chain"),
            F.col("parent_id").alias("__cur")).checkpoint(eager=True)
        j = state.join(nodes.select("file_id", "parent_id"), F.col("__cur") == F.col("file_id"), "left")
        j.collect()
        assert "SortMergeJoin(skew=true)" in j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
