import fnmatch
import re

from pyspark.sql import functions as F

from syncledger.functions.globs import (DEFAULT_RULES, glob_to_regex, match_rules,
                                        rules_regex)

NAMES = ["x.pyc", "a.b.pyc", "pyc", "Thumbs.db", "thumbs.db", "~$doc", "__pycache__", "x.tmp", "x.pyc\n", "",
         "[x]", "a?b", "ab", "x.vs", "file.vc.db"]
GLOBS = DEFAULT_RULES + ["*.tmp", "[!a]b", "a?b", "[x]", "*", "[a-c]*"]


def py(pattern: str) -> re.Pattern:
    # The JVM/RE2 end anchor \z is spelled \Z in Python.
    return re.compile(pattern.replace("\\z", "\\Z"))


def test_glob_matches_fnmatch():
    for g in GLOBS:
        rx = py(r"\A" + glob_to_regex(g) + r"\z")
        for n in NAMES:
            assert bool(rx.match(n)) == fnmatch.fnmatchcase(n, g), (g, n)


def test_combined_and_empty():
    assert rules_regex([]) is None
    rx = py(rules_regex(["*.pyc", "*.tmp"]))
    assert rx.match("a.pyc") and rx.match("b.tmp") and not rx.match("a.csv")


def test_trailing_newline_rejected_on_jvm(spark):
    rows = spark.createDataFrame([("/d/x.pyc",), ("/d/x.pyc\n",)], "p string") \
        .select(match_rules(F.col("p"), ["*.pyc"]).alias("m")).collect()
    assert [r["m"] for r in rows] == [True, False]
