"""Exclusion rules: exact paths and basename globs.

The rules are configuration, a list that becomes one regular expression, or a
table of any size (:meth:`Exclusions.from_table`): rules of the shapes ``name``,
``*end`` and ``start*`` then meet the distinct names in one equi-join, and only
rules of other shapes become the expression. Exact paths are always a table and always joined, whatever their number: ancestors in
scope are exploded, matched by a left semi join, and the few hits are joined
back by path. While the set is small, both joins broadcast it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.globs import match_rules, rules_regex
from ..functions.paths import SEP, ancestors, basename, parent_dir, path_depth
from .semijoin import broadcast_if_few, null_safe_key

#: Excluded paths of so many depths are looked for depth by depth.
MOST_DEPTHS = 16
#: A table of so many excluded paths is sent to rows that are looked up by their own path.
FEW_PATHS = 1000


@dataclass(frozen=True)
class Exclusions:
    """Exact excluded paths (listed, or a table ``path``) plus shell-style rules on basenames."""

    paths: tuple[str, ...] = ()
    rules: tuple[str, ...] = ()
    paths_df: DataFrame | None = field(default=None, compare=False)
    #: (kind, text) as :func:`rule_index` gives them: rules that are joined.
    rules_df: DataFrame | None = field(default=None, compare=False)

    @classmethod
    def from_df(cls, df: DataFrame) -> "Exclusions":
        """From a ``(kind, value)`` table; ``kind`` is ``path`` or ``rule``. Only the rules (configuration, one
        regular expression) are read by the driver; the paths stay a table."""
        rules = [r["value"] for r in df.filter(F.col("kind") == "rule").select("value").distinct().collect()]
        paths = df.filter(F.col("kind") == "path").select(F.col("value").alias("path")).distinct()
        return cls((), tuple(sorted(rules)), paths)

    @classmethod
    def from_table(cls, df: DataFrame) -> "Exclusions":
        """As :meth:`from_df` for any number of rules: they stay a table too. The driver reads those that are neither a
        name nor a name with one ``*`` at its start or end; they are one regular expression."""
        index = rule_index(df.filter(F.col("kind") == "rule").select("value"))
        other = [r["text"] for r in index.filter(F.col("kind") == "other").select("text").distinct().collect()]
        paths = df.filter(F.col("kind") == "path").select(F.col("value").alias("path")).distinct()
        return cls((), tuple(sorted(other)), paths, index.filter(F.col("kind") != "other"))

    def path_table(self, like: DataFrame) -> DataFrame | None:
        """All exact paths as ``path``, each once, or None if there are none to look for."""
        listed = like.sparkSession.createDataFrame([(x,) for x in sorted(set(self.paths))], "path string") \
            if self.paths else None
        if self.paths_df is None:
            return listed
        table = self.paths_df.select("path").filter("path IS NOT NULL")
        return (table if listed is None else table.unionByName(listed)).distinct()

    @property
    def regex(self) -> str | None:
        return rules_regex(self.rules)


def rule_index(rules: DataFrame) -> DataFrame:
    """Rules (``value``) by shape: ``kind`` is ``name``, ``end`` (``*`` and a text), ``start`` (a text and ``*``) or
    ``other``; ``text`` is what a name has to equal, end or start with, or the rule itself. Blank rules are none."""
    rule = F.regexp_replace("value", r"(?U)\A\s+|\s+\z", "")
    plain, wild = r"[^*?\[]+", rule.substr(F.lit(2), F.length(rule) - 1)
    kind = F.when(rule.rlike(rf"\A{plain}\z"), "name").when(rule.rlike(rf"\A\*{plain}\z"), "end") \
        .when(rule.rlike(rf"\A{plain}\*\z"), "start").otherwise("other")
    text = F.when(kind == "end", wild).when(kind == "start", rule.substr(F.lit(1), F.length(rule) - 1)).otherwise(rule)
    return rules.filter(F.length(rule) > 0).select(kind.alias("kind"), text.alias("text"))


def names_matched(names: DataFrame, index: DataFrame) -> DataFrame:
    """The distinct ``name`` that match a rule of the ``index`` (no ``other``). A name meets the rules by itself and by
    its ends and starts of the lengths that rules have."""
    name = F.col("name")

    def sizes(kind: str):
        return index.filter(F.col("kind") == kind).agg(F.collect_set(F.length("text"))).scalar()

    def parts(kind: str, lengths: str, cut):
        return F.transform(F.filter(lengths, lambda n: n <= F.length(name)),
                           lambda n: F.struct(F.lit(kind).alias("kind"), cut(n).alias("text")))

    own = F.array(F.struct(F.lit("name").alias("kind"), name.alias("text")))
    ends = parts("end", "__ends", lambda n: name.substr(F.length(name) - n + 1, n))
    starts = parts("start", "__starts", lambda n: name.substr(F.lit(1), n))
    return names.filter("name IS NOT NULL").distinct() \
        .select("name", sizes("end").alias("__ends"), sizes("start").alias("__starts")) \
        .select("name", F.explode(F.concat(own, ends, starts)).alias("__p")) \
        .select("name", "__p.*").join(index, ["kind", "text"], "left_semi").select("name").distinct()


def is_excluded(df: DataFrame, path_col: str, ex: Exclusions, out: str = "excluded",
                row_id: str | None = None) -> DataFrame:
    """the path itself is an excluded path or its basename matches a rule.

    Ancestors are not tested (see :func:`is_excluded_up`). A NULL path is not
    excluded; such rows are spread over the tasks of the join by ``row_id`` (or
    a hash of their values).
    """
    by_rule = F.coalesce(match_rules(F.col(path_col), ex.rules), F.lit(False))
    table = ex.path_table(df)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.col(row_id) if row_id else F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    if ex.rules_df is not None:
        name = basename(F.col(path_col))
        hits = names_matched(df.select(name.alias("name")), ex.rules_df).select(F.col("name").alias("__xname"))
        named = df.withColumn("__xkey", null_safe_key(name, row, "noname")) \
            .join(hits, F.col("__xkey") == F.col("__xname"), "left").withColumn(out, by_rule | F.col("__xname").isNotNull())
        if table is None:
            return named.drop("__xname", "__xkey")
        df, by_rule = named.drop("__xname", "__xkey"), F.col(out)
    if table is None:
        return df.withColumn(out, by_rule)
    key = null_safe_key(F.col(path_col), row, "nopath")
    sent, few = broadcast_if_few(table, FEW_PATHS)
    hits = (sent if few else table).select(F.col("path").alias("__xp"), F.lit(True).alias("__xhit"))
    joined = df.withColumn("__xkey", key).join(hits, F.col("__xkey") == F.col("__xp"), "left")
    return joined.withColumn(out, F.col("__xhit").isNotNull() | by_rule).drop("__xp", "__xhit", "__xkey")


def _stop_depth(path: Column, stops) -> Column:
    """Depth of the deepest stop path among a path's ancestors-or-self (``/`` is 0), or -1."""
    depth = F.lit(-1)
    for stop in sorted({s.rstrip(SEP) for s in stops}, key=lambda s: s.count(SEP)):
        under = path.startswith(stop + SEP) | (path == (stop or SEP))
        depth = F.when(under, F.lit(stop.count(SEP))).otherwise(depth)
    return depth


def _at_depths(df: DataFrame, path: Column, table: DataFrame, depths: list[int], out: str) -> DataFrame:
    """``out`` is true as well where an ancestor-or-self in scope (from ``__from`` on) is in the ``table`` of few paths:
    one broadcast join for each depth that its paths have, so the rows are not exchanged."""
    chain = ancestors(path)
    for d in depths:
        at = table.filter(path_depth(F.col("path")) == d).select(F.col("path").alias("__xp"))
        here = F.when(F.col("__from") <= d + 1, F.get(chain, F.lit(d)))
        df = df.withColumn("__xa", here).join(F.broadcast(at), F.col("__xa") == F.col("__xp"), "left") \
            .withColumn(out, F.col(out) | F.col("__xp").isNotNull()).drop("__xa", "__xp")
    return df


def _any_excluded(df: DataFrame, path_col: str, ex: Exclusions, stops, include_stop: bool, out: str) -> DataFrame:
    """Some ancestor-or-self of the path in scope is an excluded path or has a name that matches a rule. The scope
    begins below (or at) the deepest stop path; it is one slice, by depth, of the names and of the ancestors."""
    path, regex, table = F.col(path_col), ex.regex, ex.path_table(df)
    first = _stop_depth(path, stops) + F.lit(0 if include_stop else 1)
    scoped = df.withColumn("__from", F.greatest(first, F.lit(0)) + 1)  # 1-based; the ancestor of depth d is at d + 1
    names = F.when(path == SEP, F.array(F.lit(""))).otherwise(F.split(path, SEP))
    below = F.slice(names, F.col("__from"), F.greatest(F.size(names) - F.col("__from") + 1, F.lit(0)))
    if regex:
        by_rule = F.coalesce(F.exists(below, lambda n: n.rlike(regex)), F.lit(False))
    else:
        by_rule = F.lit(False)
    flagged = scoped.withColumn(out, by_rule)
    if table is not None:
        table, few = broadcast_if_few(table)
        depths = [r[0] for r in table.select(path_depth(F.col("path"))).distinct().limit(MOST_DEPTHS + 1).collect()]
        if few and len(depths) <= MOST_DEPTHS:
            flagged = _at_depths(flagged, path, table, sorted(depths), out)
            table = None
    if table is None and ex.rules_df is None:
        return flagged.drop("__from")
    found = []
    if table is not None:
        chain = ancestors(path)
        scope = F.slice(chain, F.col("__from"), F.greatest(F.size(chain) - F.col("__from") + 1, F.lit(0)))
        found.append(scoped.select(path.alias("__hit"), F.explode(scope).alias("path"))
                     .join(table, "path", "left_semi").select("__hit"))
    if ex.rules_df is not None:
        each = scoped.select(path.alias("__hit"), F.explode(below).alias("name"))
        found.append(each.join(names_matched(each.select("name"), ex.rules_df), "name", "left_semi").select("__hit"))
    hits = (found[0] if len(found) == 1 else found[0].unionByName(found[1])).distinct()
    return flagged.join(hits, path == F.col("__hit"), "left") \
        .withColumn(out, F.col(out) | F.col("__hit").isNotNull()).drop("__hit", "__from")


def is_excluded_up(df: DataFrame, path_col: str, ex: Exclusions, stops=(), out: str = "excluded") -> DataFrame:
    """F8: the path or any ancestor is excluded, walking up and stopping at
    (without testing) the nearest stop path; ``/`` is tested when no stop is met."""
    return _any_excluded(df, path_col, ex, tuple(stops), include_stop=False, out=out)


def prune_excluded(df: DataFrame, path_col: str, ex: Exclusions, roots, out: str = "pruned") -> DataFrame:
    """F9 flag with walk semantics: a node under a walk root is pruned when it,
    or any folder from the root (inclusive) down to it, is excluded.

    Nodes under no root get ``NULL`` for ``out`` and ``root`` (a walk never sees them).
    The walk root of a node is its deepest root ancestor-or-self.
    """
    roots = tuple(roots)
    path, root = F.col(path_col), F.lit(None).cast("string")
    for r in sorted(set(roots), key=lambda r: r.rstrip(SEP).count(SEP)):  # the deepest one wins
        root = F.when((path == r) | path.startswith(r.rstrip(SEP) + SEP), F.lit(r)).otherwise(root)
    rooted = df.withColumn("root", root)
    flagged = _any_excluded(rooted, path_col, ex, roots, include_stop=True, out=out)
    return flagged.withColumn(out, F.when(F.col("root").isNotNull(), F.col(out)))


def merge_exclusions(x1: DataFrame, x2: DataFrame) -> DataFrame:
    """Union of stored and user exclusion rows, duplicates removed."""
    return x1.select("kind", "value").unionByName(x2.select("kind", "value")).distinct()


def minimal_exclusions(ex: Exclusions, local: DataFrame, roots) -> DataFrame:
    """Keep excluded paths that exist locally and whose parent is not itself
    excluded (F8 with the roots as stops). Returns ``path``."""
    table = ex.path_table(local)
    paths = local.select("path").filter(F.lit(False)) if table is None else \
        local.select("path").join(table, "path", "left_semi")
    flagged = is_excluded_up(paths.withColumn("__parent", parent_dir(F.col("path"))), "__parent", ex, roots,
                             out="__parent_excl")
    return flagged.filter(~F.col("__parent_excl")).select("path").distinct()


def add_exclusions(ex: Exclusions, new_paths: DataFrame, local: DataFrame, roots) -> DataFrame:
    """E3 (order-free): candidate paths that exist locally and are not already
    excluded under F8 are added; among the added, only the topmost are kept
    (a later child of an added folder is covered by it). Returns ``path``."""
    from .hierarchy import topmost

    cand = new_paths.select("path").distinct().join(local.select("path"), "path", "left_semi")
    flagged = is_excluded_up(cand, "path", ex, roots, out="__covered")
    return topmost(flagged.filter(~F.col("__covered")).select("path"), "path")


__all__ = ["Exclusions", "rule_index", "names_matched", "is_excluded", "is_excluded_up", "prune_excluded", "merge_exclusions", "minimal_exclusions",
           "add_exclusions"]
