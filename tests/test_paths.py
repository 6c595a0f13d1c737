from pyspark.sql import functions as F

from syncledger.functions import paths as P
from syncledger.functions.times import format_remote_time, parse_remote_time


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first()["o"]


def test_normalize(spark):
    cases = {"/a//b/./c": "/a/b/c", "/a/../../b": "/b", "/": "/", "/a/b/..": "/a", "x/./y": "/base/x/y"}
    for raw, want in cases.items():
        assert one(spark, lambda c: P.normalize_path(c, base="/base"), raw) == want
    assert one(spark, lambda c: P.normalize_path(c, fold_case=True), "/A/B") == "/a/b"


def test_basename_parent_depth_ancestors(spark):
    assert one(spark, P.basename, "/a/b.txt") == "b.txt"
    assert one(spark, P.basename, "/") == ""
    assert one(spark, P.parent_dir, "/a/b") == "/a"
    assert one(spark, P.parent_dir, "/a") == "/"
    assert one(spark, P.parent_dir, "/") == "/"
    assert one(spark, P.path_depth, "/") == 0
    assert one(spark, P.path_depth, "/a/b") == 2
    assert one(spark, P.ancestors, "/a/b") == ["/", "/a", "/a/b"]
    assert one(spark, P.ancestors, "/") == ["/"]


def test_join_strip_replace(spark):
    row = spark.createDataFrame([("/base/", "/mid/", "name")], "a string, b string, c string").select(
        P.join_path(F.col("a"), F.col("b"), F.col("c")).alias("j"),
        P.join_path(F.col("a"), F.lit(""), F.col("c")).alias("k")).first()
    assert row["j"] == "/base/mid/name" and row["k"] == "/base/name"
    assert one(spark, P.strip_first_segment, "ASIA/x/y") == "x/y"
    assert one(spark, P.strip_first_segment, "ASIA") == ""
    assert one(spark, lambda c: P.replace_prefix(c, "/a/b", "/z"), "/a/bc/d") == "/zc/d"
    row = spark.createDataFrame([("/a/bc", "/a/b"), ("/a/b/c", "/a/b")], "p string, q string") \
        .select(P.is_descendant_or_self(F.col("p"), F.col("q")).alias("d")).collect()
    assert [r["d"] for r in row] == [False, True]


def test_remote_time_round_trip(spark):
    row = spark.createDataFrame([("2024-01-01T10:00:07.179Z",), ("2024-01-01T10:00:07",)], "t string") \
        .select(parse_remote_time(F.col("t")).alias("ts")).collect()
    assert [str(r["ts"]) for r in row] == ["2024-01-01 10:00:07", "2024-01-01 10:00:07"]
    txt = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05.123456' AS ts").select(
        format_remote_time(F.col("ts")).alias("t")).first()["t"]
    assert txt == "2024-01-02T03:04:05.123456Z"
