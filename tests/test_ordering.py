import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from syncledger.operators.ordering import assign_batches, free_name, group_row_number, resolve_conflicts


def test_group_row_number_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", f"id{rnd.randrange(10**9):09d}-{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id string")
    ours = group_row_number(df, ["g"], ["id"], out="rn")
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    joined = ours.join(ref, ["g", "id"])
    assert joined.count() == 3000 and joined.filter("rn <> ref").count() == 0


def test_batches_at_most_32(spark):
    df = spark.range(1000).select(F.format_string("d%04d", "id").alias("drive_id"))
    b = assign_batches(df)
    sizes = [r["n"] for r in b.groupBy("batch").count().withColumnRenamed("count", "n").collect()]
    assert max(sizes) == 32 and sum(sizes) == 1000 and len(sizes) == 32


def test_sticky_answers(spark):
    conflicts = spark.createDataFrame([(i,) for i in range(1, 7)], "seq bigint")
    answers = spark.createDataFrame([(1, "y"), (2, "n"), (3, "x"), (4, "c"), (5, "n"), (6, "a")],
                                    "seq bigint, answer string")
    got = [r["answer"] for r in resolve_conflicts(conflicts, answers).orderBy("seq").collect()]
    assert got == ["y", "n", "n", "o", "o", "o"]
    grouped = conflicts.withColumn("root", F.when(F.col("seq") <= 3, "A").otherwise("B"))
    ans2 = spark.createDataFrame([(1, "r"), (4, "y"), (5, "a"), (6, "n")], "seq bigint, answer string")
    got2 = [r["answer"] for r in resolve_conflicts(grouped, ans2, by=["root"]).orderBy("seq").collect()]
    assert got2 == ["n", "n", "n", "y", "y", "y"]


def test_free_name(spark):
    local = spark.createDataFrame([("/d/a.txt",), ("/d/a (2).txt",), ("/d/b",)], "path string")
    plan = spark.createDataFrame([(1, "/d/a.txt"), (2, "/d/a.txt"), (3, "/d/b"), (4, "/e/c.tar.gz")],
                                 "seq bigint, dest_path string")
    got = {r["seq"]: r["free_path"] for r in free_name(plan, local).collect()}
    assert got == {1: "/d/a (3).txt", 2: "/d/a (4).txt", 3: "/d/b (1)", 4: "/e/c.tar (1).gz"}
