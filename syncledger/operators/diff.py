"""Set differences between the inventories.

All of them are hash joins on unique keys (file id, path) or ancestor
equi-joins; prefix/substring matching is never planned as a nested loop over
the big side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import SEP, ancestors, basename, explode_ancestors, parent_dir, path_depth
from .exclude import Exclusions, is_excluded, is_excluded_up
from .semijoin import broadcast_if_few, matching


def lookup(keys: DataFrame, archive: DataFrame, key_col: str, field: str = "path",
           value: str = "drive_id", fallback=None, out: str | None = None) -> DataFrame:
    """Batched lookup of ``archive[value]`` by ``archive[field] = keys[key_col]``,
    ``fallback`` when absent. One left join, never per-row lookups."""
    out = out or value
    a = archive.select(F.col(field).alias("__k"), F.col(value).alias("__v"))
    j = keys.join(a, F.col(key_col) == F.col("__k"), "left")
    v = F.coalesce(F.col("__v"), F.lit(fallback)) if fallback is not None else F.col("__v")
    return j.withColumn(out, v).drop("__k", "__v")


def remote_exists(ids: DataFrame, remote: DataFrame, id_col: str = "drive_id", out: str = "exists") -> DataFrame:
    """Id present remotely and not trashed."""
    r = remote.select(F.col("file_id").alias("__rid"), F.col("trashed").alias("__tr"))
    j = ids.join(r, F.col(id_col) == F.col("__rid"), "left")
    return j.withColumn(out, F.coalesce(~F.col("__tr"), F.lit(False))).drop("__rid", "__tr")


def removed_locally(archive: DataFrame, local: DataFrame, under: str | None = None,
                    mode: str = "descendant") -> DataFrame:
    """Archive rows whose path no longer exists locally, optionally only at
    or below ``under`` (``descendant``: separator-aware, ``prefix``: plain
    ``startswith`` as the original tool does)."""
    a = archive
    if under is not None:
        if mode == "prefix":
            a = a.filter(F.col("path").startswith(under))
        else:
            u = under.rstrip("/") or "/"
            a = a.filter((F.col("path") == u) | F.col("path").startswith(u.rstrip("/") + "/"))
    return a.join(local.select("path"), "path", "left_anti")


def removed_remotely(changes: DataFrame, archive: DataFrame, start_seq: int | None = None) -> DataFrame:
    """Archive rows named by a removed or trashed change event (one row per
    event: duplicates kept)."""
    c = changes
    if start_seq is not None:
        c = c.filter(F.col("seq") >= start_seq)
    c = c.filter(F.col("removed") | F.coalesce(F.col("trashed"), F.lit(False)))
    return c.select("seq", F.col("file_id").alias("drive_id")).join(archive, "drive_id")


def archive_gc(archive: DataFrame, remote: DataFrame, local: DataFrame, ex: Exclusions) -> DataFrame:
    """Archive rows to forget: missing or trashed remotely, and missing
    locally or excluded (F7)."""
    a = remote_exists(archive, remote, "drive_id", out="__rexists")
    a = a.join(local.select(F.col("path").alias("__lp"), F.lit(True).alias("__lexists")),
               F.col("path") == F.col("__lp"), "left")
    a = is_excluded(a, "path", ex, out="__excl")
    keep = ~F.col("__rexists") & (F.col("__lexists").isNull() | F.col("__excl"))
    return a.filter(keep).select(*archive.columns)


def excluded_archived(archive: DataFrame, ex: Exclusions, roots) -> DataFrame:
    """Archive rows excluded under F8 with the sync roots as stop paths."""
    return is_excluded_up(archive, "path", ex, roots, out="__x").filter(F.col("__x")).drop("__x")


def descendants_join(archive: DataFrame, paths: DataFrame, path_col: str = "path",
                     mode: str = "descendant") -> DataFrame:
    """Archive rows at or below any of ``paths``; adds ``matched_path``.

    * ``descendant``: separator-aware. Each archive path is exploded into its
      ancestors-or-self and equi-joined with the given paths.
    * ``prefix``: plain ``startswith`` (``/a/b`` also takes ``/a/bc``): the
      beginnings of a path that are as long as a pattern of the same folder are
      equi-joined with the patterns.
    * ``contains``: plain substring. A pattern that starts with a separator can
      only begin at one of the path's separators, so it is a prefix match of the
      path's tails; any other pattern meets the paths that hold its rarest gram
      (:func:`_containing`).

    An archive row matched by several paths appears once per match.
    """
    p = paths.select(F.col(path_col).alias("matched_path")).filter("matched_path IS NOT NULL").distinct()
    if mode == "descendant":
        ex = explode_ancestors(archive, "path", "__anc", p, "matched_path")
        return ex.join(p, F.col("__anc") == F.col("matched_path")).select(*archive.columns, "matched_path")
    if mode == "prefix":
        return _starting_with(archive.withColumn("__at", F.lit(1)), p).select(*archive.columns, "matched_path")
    if mode == "contains":
        p, _few = broadcast_if_few(p)  # once: the patterns are read several times below
        rooted, loose = p.filter(F.col("matched_path").startswith(SEP)), p.filter(~F.col("matched_path").startswith(SEP))
        steps = F.sequence(F.lit(1), path_depth(F.col("path")).cast("int"))
        starts = F.when(F.col("path") == SEP, F.array(F.lit(1))).otherwise(F.transform(
            steps, lambda k: F.length("path") - F.length(F.call_function("substring_index", F.col("path"), F.lit(SEP), -k))))
        out = _starting_with(archive.withColumn("__at", F.explode(starts)), rooted).select(*archive.columns, "matched_path")
        if not loose.isEmpty():
            out = out.unionByName(_containing(archive, loose).select(*archive.columns, "matched_path"))
        return out.distinct()
    raise ValueError(f"unknown mode {mode!r}")


def _starting_with(df: DataFrame, patterns: DataFrame) -> DataFrame:
    """``df`` joined with the ``patterns`` (``matched_path``) that ``path`` holds from the character ``__at`` on, by
    equi-joins alone: that part of it meets the distinct pattern lengths of each folder on its way, and its beginnings of
    those lengths meet the patterns. The rows between depend on how many lengths a folder has, not on how many patterns.
    Folders and beginnings are exchanged as hashes and cut again from the path; a match is made by the texts."""
    pp = patterns.withColumn("__folder", parent_dir(F.col("matched_path"))) \
        .withColumn("__n", F.length("matched_path"))
    lengths = pp.select(F.xxhash64("__folder").alias("__hash"), "__n").distinct()
    depths = pp.agg(F.collect_set(path_depth(F.col("__folder"))).alias("d")).scalar()
    # no pattern of a folder is as short as the folder, but for the top one
    tail = F.col("__tail")
    deep = df.withColumn("__tail", F.expr("substring(path, __at)")) \
        .filter((tail == SEP) | (path_depth(tail) > F.array_min(depths)))
    above = deep.select("*", F.posexplode(ancestors(tail)).alias("__depth", "__folder")) \
        .filter(F.array_contains(depths, F.col("__depth").cast("bigint")) & ((F.col("__folder") != tail) | (tail == SEP))) \
        .withColumn("__hash", F.xxhash64("__folder")).drop("__folder", "__tail")
    start = F.expr("substring(path, __at, __n)")
    cut = above.join(lengths, "__hash").filter(F.length("path") - F.col("__at") + 1 >= F.col("__n")) \
        .filter(path_depth(parent_dir(start)) == F.col("__depth")).drop("__hash", "__depth") \
        .withColumn("__start", F.xxhash64(start))
    return cut.join(pp.select("matched_path", F.xxhash64("matched_path").alias("__start")), "__start") \
        .filter(start == F.col("matched_path")).drop("__start", "__at", "__n")


GRAM = 3


def _grams(col: str, sizes, whole: bool):
    """The distinct substrings of a column of ``GRAM`` characters and, for those sizes, of less. ``whole``: only of the
    size that the column itself has if it is shorter."""
    def cut(size: int):
        n = F.length(col) - size + 1
        parts = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                            lambda i: F.substring(F.col(col), i, F.lit(size)))
        wanted = (F.least(F.length(col), F.lit(GRAM)) == size) if whole else F.array_contains(sizes, size)
        return F.when((n >= 1) & wanted, parts).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.array(*[cut(size) for size in range(GRAM + 1)])))


def _containing(df: DataFrame, patterns: DataFrame) -> DataFrame:
    """``df`` joined with the ``patterns`` (``matched_path``) that ``path`` contains, by equi-joins on grams: a pattern
    takes the gram (three characters, or itself if it is shorter) that the fewest paths hold, meets those paths, and is
    then looked for in them. Gram sizes that no pattern has are not cut (a scalar subquery of the same plan). The grams
    of a path are many times its size: only those that a pattern has are counted, and only chosen ones are exchanged,
    if the patterns are too many to be sent."""
    sizes = patterns.agg(F.collect_set(F.least(F.length("matched_path"), F.lit(GRAM))).alias("s")).scalar()
    asked, _few = broadcast_if_few(patterns.select("matched_path", F.explode(_grams("matched_path", None, True)).alias("__gram")))
    held = df.select("*", F.explode(_grams("path", sizes, False)).alias("__gram"))
    often = matching(df.select(F.explode(_grams("path", sizes, False)).alias("__gram")), "__gram", asked) \
        .groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = asked.join(often, "__gram", "left").groupBy("matched_path") \
        .agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__gram")).alias("g"))
    chosen, few = broadcast_if_few(rarest.filter("g.n > 0").select("matched_path", F.col("g.__gram").alias("__gram")))
    if not few:
        held = matching(held, "__gram", chosen)
    return held.join(chosen, "__gram").filter(F.col("path").contains(F.col("matched_path"))).drop("__gram")


def path_match(df: DataFrame, patterns: DataFrame, mode: str = "descendant", path_col: str = "path") -> DataFrame:
    """rows of ``df`` whose path matches one of ``patterns`` (``path``)
    by ``descendant`` (separator-aware), ``prefix`` or ``contains``."""
    return descendants_join(df, patterns, mode=mode) if path_col == "path" else \
        descendants_join(df.withColumnRenamed(path_col, "path"), patterns, mode=mode).withColumnRenamed("path", path_col)


def resolve_parent(df: DataFrame, archive: DataFrame, path_col: str = "path", fallback: str | None = "root",
                   out: str = "parent_id") -> DataFrame:
    """Remote id of the parent folder of ``path_col`` from the archive,
    ``fallback`` when the parent is not archived."""
    keyed = df.withColumn("__parent", parent_dir(F.col(path_col)))
    return lookup(keyed, archive, "__parent", "path", "drive_id", fallback, out).drop("__parent")


def tracked_roots(roots: DataFrame, archive: DataFrame, extra: tuple[str, str] | None = None) -> DataFrame:
    """``drive_id -> base_path`` for sync roots present in the archive;
    ``extra = (root_id, default_path)`` adds (and overrides) one untracked root."""
    paths, _ = broadcast_if_few(roots.select("path"))  # one row per configured root
    tracked = archive.select("path", "drive_id").join(paths, "path") \
        .select("drive_id", F.col("path").alias("base_path"))
    if extra is None:
        return tracked
    spark = roots.sparkSession
    add = spark.createDataFrame([extra], "drive_id string, base_path string")
    return tracked.join(add.select("drive_id"), "drive_id", "left_anti").unionByName(add)


def unarchived_nodes(nodes: DataFrame, archive: DataFrame) -> DataFrame:
    """Nodes (e.g. a walk) whose id is not in the archive (J3 after H4)."""
    return nodes.join(archive.select(F.col("drive_id").alias("file_id")), "file_id", "left_anti")


def diff_state(remote: DataFrame, archive: DataFrame, local: DataFrame) -> DataFrame:
    """``side, key`` for remote-only ids (live and not archived), local-only
    paths (not archived), archive-only rows (gone remotely and locally), and
    archived rows that are still there: on ``both`` sides, or ``archive_remote``
    or ``archive_local`` where one side is gone. Every archived row has one side."""
    live = remote.filter(~F.col("trashed")).select(F.col("file_id").alias("key"))
    r_only = live.join(archive.select(F.col("drive_id").alias("key")), "key", "left_anti") \
        .withColumn("side", F.lit("remote_only"))
    l_only = local.select(F.col("path").alias("key")).join(archive.select(F.col("path").alias("key")), "key",
                                                            "left_anti").withColumn("side", F.lit("local_only"))
    here = local.select(F.col("path").alias("__lp")).distinct()
    archived = remote_exists(archive, remote, "drive_id", out="__rx") \
        .join(here, F.col("path") == F.col("__lp"), "left") \
        .select(F.col("drive_id").alias("key"), F.when(F.col("__rx") & F.col("__lp").isNotNull(), "both")
                .when(F.col("__rx"), "archive_remote").when(F.col("__lp").isNotNull(), "archive_local")
                .otherwise("archive_only").alias("side"))
    return r_only.unionByName(l_only).unionByName(archived)


__all__ = ["lookup", "remote_exists", "removed_locally", "removed_remotely", "archive_gc", "excluded_archived",
           "descendants_join", "path_match", "resolve_parent", "tracked_roots", "unarchived_nodes", "diff_state", "basename"]
