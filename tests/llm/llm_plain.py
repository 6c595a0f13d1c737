"""Plain computations that the llm operators are held against, and tables of odd rows."""

import re
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Extra columns have names that the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n long, h long, row string, spans string, rep long"


def docs(spark, rows):
    """(doc_id, text[, lang[, source]]) as a table with clashing extra columns."""
    full = [tuple(list(r) + [None] * (4 - len(r)) + [1, 2, "x", "y", 3]) for r in rows]
    return spark.createDataFrame(full, DOCS)


#: Names that clash with columns of the operators, or need quoting.
ODD_NAMES = ("__rate", "__copy", "a.b", "A B", "`tick`", "c0", "C1", "__gone", "n", "d1", "part", "Source size")


def oddly_named(spark, rows):
    """(doc_id, text, lang, source) rows with a column of each odd name."""
    kinds = "doc_id long, text string, lang string, source string"
    table = spark.createDataFrame([tuple(list(r) + [None] * (4 - len(r))) for r in rows], kinds)
    for k, name in enumerate(ODD_NAMES):
        table = table.toDF(*[f"x{i}" for i in range(len(table.columns))]).selectExpr("*", f"{k} as y") \
            .toDF(*table.columns, name)
    return table


def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"w{i % 7919}" for i in range(150_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b c d"), (6, "A b C d"), (7, long_text),
            (8, "one two three four five six"), (8, "one two three four five six"), (None, "no id here at all today"),
            (9, "é ü ñ 日本 🙂 one two three"), (10, "x" * 300_000), (11, "<|endoftext|> and 'tis"),
            (12, "one two three four five six")]


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def components(rows, percent=75):
    """Smallest linked id by id, from all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = Counter()
    for ids in holders.values():
        common.update(combinations(sorted(ids), 2))
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}
