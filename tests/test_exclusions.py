"""Ancestor exclusion tests: listed paths and a table of paths give the same
flags, and the number of paths changes nothing."""
import fnmatch

import pytest
from pyspark.sql import functions as F

from syncledger import fixtures as fx
from syncledger.operators import exclude as X


def variants(spark, paths, rules):
    listed = X.Exclusions(tuple(sorted(paths)), tuple(rules))
    table = X.Exclusions((), tuple(rules), spark.createDataFrame([(p,) for p in paths], "path string"))
    return listed, table


def flags(df, col):
    return {r["path"]: r[col] for r in df.collect()}


def plain_up(path, paths, rules, stops):
    """Walk up from the path to the nearest stop, which is not tested."""
    while path not in stops:
        if path in paths or any(fnmatch.fnmatchcase(path.rsplit("/", 1)[1], r) for r in rules):
            return True
        if path == "/":
            break
        path = path.rsplit("/", 1)[0] or "/"
    return False


@pytest.mark.parametrize("extra_rule", [None, "~$*"])
def test_up_flags_agree(spark, inv, extra_rule):
    rules = list(fx.EXCLUDED_RULES) + ([extra_rule] if extra_rule else [])
    paths = list(fx.EXCLUDED_PATHS) + ["/data/EUROPE"]
    listed, table = variants(spark, paths, rules)
    local = inv.L.select("path")
    up = flags(X.is_excluded_up(local, "path", listed, fx.ROOT_PATHS), "excluded")
    pruned = flags(X.prune_excluded(local, "path", listed, fx.ROOT_PATHS), "pruned")
    assert up == flags(X.is_excluded_up(local, "path", table, fx.ROOT_PATHS), "excluded")
    assert pruned == flags(X.prune_excluded(local, "path", table, fx.ROOT_PATHS), "pruned")
    assert up == {p: plain_up(p, set(paths), rules, set(fx.ROOT_PATHS)) for p in up}
    assert any(up.values()) and not all(up.values())


@pytest.mark.parametrize("more", [0, 65])
@pytest.mark.parametrize("rule", ["x[+-9]y", "*", "*.pyc"])
def test_the_number_of_paths_changes_nothing(spark, more, rule):
    others = [f"/other/p{i}" for i in range(more)]
    ex = X.Exclusions(tuple(others), (rule,))
    rows = ["/r", "/r/x/y", "/r/x5y", "/r/a.pyc/b", "/r/s", "/r/s/t"]
    df = spark.createDataFrame([(p,) for p in rows], "path string")
    got = flags(X.is_excluded_up(df, "path", ex, stops=["/r", "/r/s"]), "excluded")
    assert got == {p: plain_up(p, set(others), [rule], {"/r", "/r/s"}) for p in rows}
    pruned = flags(X.prune_excluded(df, "path", ex, roots=["/r"]), "pruned")
    assert pruned["/r/x/y"] is (rule == "*") and pruned["/r/a.pyc/b"] is (rule in ("*", "*.pyc"))


def test_no_stop_tests_root(spark):
    df = spark.createDataFrame([("/",), ("/a",), ("/a/x.pyc/b",), ("/keep/y",)], "path string")
    ex = X.Exclusions(("/a",), ("*.pyc",))
    got = flags(X.is_excluded_up(df, "path", ex), "excluded")
    assert got == {"/": False, "/a": True, "/a/x.pyc/b": True, "/keep/y": False}


def test_stop_path_is_not_tested(spark):
    # the stop path itself is never tested, even when it is excluded
    df = spark.createDataFrame([("/s",), ("/s/a",), ("/s.pyc",), ("/s.pyc/b",)], "path string")
    ex = X.Exclusions(("/s",), ("*.pyc",))
    got = flags(X.is_excluded_up(df, "path", ex, stops=["/s", "/s.pyc"]), "excluded")
    assert got == {"/s": False, "/s/a": False, "/s.pyc": False, "/s.pyc/b": False}
    pruned = flags(X.prune_excluded(df, "path", ex, roots=["/s"]), "pruned")
    assert pruned == {"/s": True, "/s/a": True, "/s.pyc": None, "/s.pyc/b": None}


def test_rule_with_separator_uses_general_path(spark):
    df = spark.createDataFrame([("/a/b",), ("/c",)], "path string")
    ex = X.Exclusions((), ("a/b",))
    # a basename never contains '/', so such a rule matches nothing
    assert not any(flags(X.is_excluded_up(df, "path", ex), "excluded").values())


def test_empty_rules_match_nothing(spark):
    df = spark.createDataFrame([("/",), ("/x",)], "path string")
    assert not any(flags(X.is_excluded(df, "path", X.Exclusions()), "excluded").values())
    assert not any(flags(df.withColumn("m", F.lit(False)), "m").values())


SHAPES = ["name", "n\u00e4me.b", "*.pyc", "*\u00e9", "tmp*", "  ~$*  ", "x?z", "[ab]c", "**.two", "a*b", "", "  ", "*", "a/b"]
PATHS = ["/", "/name", "/name/x", "/r/n\u00e4me.b/k", "/r/a.pyc", "/r/.pyc", "/r/pyc", "/r/caf\u00e9/x/y", "/r/tmp", "/r/tmp1/q",
         "/r/xtmp", "/r/~$doc", "/r/xyz", "/r/xyyz", "/r/ac", "/r/abc", "/r/q.two", "/r/a1b", "/r/ab", "/r/s", "/r/s/name", "/r/n"]


@pytest.mark.parametrize("rules", [*[[r] for r in SHAPES], SHAPES[:-2], []])
def test_a_table_of_rules_matches_as_the_list(spark, rules):
    rows = [("rule", r) for r in rules] + [("path", "/r/n")]
    ex = X.Exclusions.from_table(spark.createDataFrame(rows, "kind string, value string"))
    known = [r.strip() for r in rules if r.strip()]
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    plain = {p: p == "/r/n" or any(fnmatch.fnmatchcase(p.rsplit("/", 1)[1], r) for r in known) for p in PATHS}
    assert flags(X.is_excluded(df, "path", ex), "excluded") == plain
    assert flags(X.is_excluded_up(df, "path", ex, ["/r", "/r/s"]), "excluded") == \
        {p: plain_up(p, {"/r/n"}, known, {"/r", "/r/s"}) for p in PATHS}
    assert set(ex.rules) == set(known) & {"x?z", "[ab]c", "**.two", "a*b", "*"}


def test_rows_without_a_path_and_repeated_rows_stay(spark):
    ex = X.Exclusions.from_table(spark.createDataFrame([("rule", "a"), ("rule", "a"), ("path", "/a")], "kind string, value string"))
    df = spark.createDataFrame([(None,), (None,), ("/a",), ("/a",), ("/b",)], "path string")
    assert sorted((r["path"] or "", r["excluded"]) for r in X.is_excluded(df, "path", ex).collect()) == \
        [("", False), ("", False), ("/a", True), ("/a", True), ("/b", False)]


def test_a_hundred_thousand_rules_stay_on_the_executors(spark):
    rules = spark.range(100_000).select(F.lit("rule").alias("kind"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("f"), "id"))
                                        .when(F.col("id") % 3 == 1, F.concat(F.lit("*."), "id"))
                                        .otherwise(F.concat(F.lit("d"), "id", F.lit("-*"))).alias("value"))
    ex = X.Exclusions.from_table(rules)
    assert ex.rules == ()
    df = spark.range(90_000, 110_000).select(F.explode(F.array(
        F.concat(F.lit("/x/f"), "id"), F.concat(F.lit("/x/q."), "id"), F.concat(F.lit("/x/d"), "id", F.lit("-1/y")))).alias("path"))
    assert X.is_excluded_up(df, "path", ex).filter("excluded").count() == 10_000
