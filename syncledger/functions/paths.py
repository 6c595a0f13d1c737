"""Path helpers as native Column expressions (no Python UDFs).

Paths are POSIX-style, absolute, ``/``-separated strings. All helpers stay
inside Catalyst so they are code-generated and can be pushed around freely.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "/"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_path(col, base: str = "/", fold_case: bool = False) -> Column:
    """Absolute path with ``.``, ``..`` and repeated separators collapsed.

    ``/a//b/./c`` -> ``/a/b/c``; ``/a/../../b`` -> ``/b``; ``/`` -> ``/``.
    Relative input is resolved against ``base``. ``fold_case`` lowers the
    result (case-insensitive file systems).
    """
    c = _c(col)
    absolute = F.when(c.startswith(SEP), c).otherwise(F.concat(F.lit(base.rstrip(SEP) + SEP), c))
    parts = F.filter(F.split(absolute, SEP), lambda x: (x != "") & (x != "."))
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        parts,
        empty,
        lambda acc, x: F.when(x == "..", F.filter(acc, lambda _y, i: i < F.size(acc) - 1))
        .otherwise(F.concat(acc, F.array(x))),
    )
    out = F.concat(F.lit(SEP), F.array_join(folded, SEP))
    return F.lower(out) if fold_case else out


def basename(col) -> Column:
    """Last component; ``''`` for ``/`` or a trailing separator.

    ``substring_index`` is a linear scan; an end-anchored regex such as
    ``([^/]*)$`` backtracks quadratically on every call."""
    return F.substring_index(_c(col), SEP, -1)


def parent_dir(col) -> Column:
    """Parent folder; the parent of ``/`` and of ``/x`` is ``/``."""
    c = _c(col)
    keep = F.length(c) - F.length(F.substring_index(c, SEP, -1)) - 1
    return F.when(keep <= 0, F.lit(SEP)).otherwise(c.substr(F.lit(1), keep))


def path_parts(col) -> Column:
    """Non-empty components of a path, top first."""
    return F.filter(F.split(_c(col), SEP), lambda x: x != "")


def path_depth(col) -> Column:
    """Number of components of a normalised absolute path: ``/`` is 0, ``/a`` is 1."""
    c = _c(col)
    return F.when(c == SEP, F.lit(0)).otherwise(F.size(F.split(c, SEP)) - 1).cast("bigint")


def ancestors(col) -> Column:
    """Ancestors-or-self of a path, top first, ``/`` included (H1 as an array).

    ``/a/b`` -> ``['/', '/a', '/a/b']``; element ``i`` (0-based) has depth ``i``.
    The path must be normalised (:func:`normalize_path`): each ancestor is one
    ``substring_index`` cut, no regex and no re-splitting.
    """
    c = _c(col)
    n = F.size(F.split(c, SEP)) - 1  # components of a normalised absolute path
    below_root = F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(1)) + 1),
                             lambda k: F.call_function("substring_index", c, F.lit(SEP), k))
    return F.when((c == SEP) | (n <= 0), F.array(F.lit(SEP))).otherwise(
        F.concat(F.array(F.lit(SEP)), below_root))


def explode_ancestors(df, path_col: str, out: str, like, like_col: str):
    """``df`` with one row per ancestor-or-self of ``path_col`` (as ``out``) whose depth
    occurs among the paths ``like[like_col]``.

    Keeping only the depths a join can match keeps the universal ancestors (``/``,
    top folders) out of the shuffle, where they would be hot keys. The depths are
    a scalar subquery of the same plan: no driver read, no bound on their number."""
    depths = like.agg(F.collect_set(path_depth(F.col(like_col))).alias("d")).scalar()
    return df.select("*", F.posexplode(ancestors(F.col(path_col))).alias("__depth", out)) \
        .filter(F.array_contains(depths, F.col("__depth").cast("bigint"))).drop("__depth")


def join_path(*cols) -> Column:
    """Base + middle parts + name; separators between parts are normalised.

    Empty or NULL middle parts are skipped, like ``os.path.join`` with ``''``.
    """
    cleaned = [F.regexp_replace(_c(c), r"^/+|/+$", "") for c in cols[1:]]
    first = F.regexp_replace(_c(cols[0]), r"/+$", "")
    pieces = F.filter(F.array(*cleaned), lambda x: x.isNotNull() & (x != ""))
    tail = F.array_join(pieces, SEP)
    return F.when(F.size(pieces) == 0, F.when(first == "", F.lit(SEP)).otherwise(first)).otherwise(
        F.concat(first, F.lit(SEP), tail))


def strip_first_segment(col) -> Column:
    """Drop the leading folder name; no separator -> ``''`` (T4)."""
    c = _c(col)
    return F.when(F.instr(c, SEP) > 0, F.regexp_replace(c, r"^[^/]*/", "")).otherwise(F.lit(""))


def replace_prefix(col, old: str, new: str) -> Column:
    """Swap a leading ``old`` for ``new`` (T7); rows not starting with ``old`` are kept."""
    c = _c(col)
    return F.when(c.startswith(old), F.concat(F.lit(new), F.substring(c, len(old) + 1, 1 << 30))).otherwise(c)


def is_descendant_or_self(col, prefix_col) -> Column:
    """Separator-aware containment: ``/a/b`` is under ``/a`` but ``/ab`` is not."""
    c, p = _c(col), _c(prefix_col)
    return (c == p) | c.startswith(F.concat(F.regexp_replace(p, r"/+$", ""), F.lit(SEP)))
