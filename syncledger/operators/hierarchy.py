"""Hierarchy operators over path-encoded and parent-pointer trees (H1-H8,
J8, J10, J14).

Path-encoded trees (local listing, archive) need no loop: ancestors are
computed from the string. Parent-pointer trees (remote listing) are walked
level by level with joins:

* :func:`descend` goes top-down from seed nodes. Each level joins only the
  current frontier with the children table, so every node is touched once;
  AQE broadcasts the frontier while it is small and splits a hot parent
  (one folder holding a large share of all rows) on the children side.
* :func:`lineage` gives the chain of ancestors of every node that is somebody's
  parent, by pointer doubling: a round reaches twice as far as the one before
  (ten rounds for a depth of 1,000). :func:`chains` attaches given ids, change
  events or a few ids to resolve, to their parents' chains by one join; a
  lineage kept for a listing serves any number of batches.

Every round is cut from its plan with a reliable ``checkpoint()`` into the
shared checkpoint folder, so a lost executor recomputes one round, not the
whole loop, and plans do not grow with depth. There is no limit on the depth:
a parent cycle is known by an id that is met again, and raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import ancestors, basename, parent_dir, path_depth, path_parts
from ..session import checkpoint_dir
from .scan import running
from .semijoin import matching, null_safe_key


class TreeTooDeep(RuntimeError):
    """A walk met a parent cycle, or did not end within the ``max_depth`` levels its caller allows."""


class TreeCycle(TreeTooDeep):
    """Nodes that are their own ancestors."""


def _cut(df: DataFrame, **conditions: Column) -> tuple[DataFrame, dict]:
    """Checkpoint ``df`` and, in the same job, count the rows that meet each condition (an ``Observation`` read after
    the eager checkpoint)."""
    checkpoint_dir(df.sparkSession)
    obs = Observation()
    cut = df.observe(obs, *[F.count(F.when(c, F.lit(1))).alias(name) for name, c in conditions.items()]) \
        .checkpoint(eager=True)
    return cut, obs.get


def _cut_count(df: DataFrame, open_rows: Column, depth: int = 0, max_depth: int | None = None,
               cycle: Column | None = None) -> tuple[DataFrame, int]:
    """Checkpoint a level and, in the same job, count its rows that still
    need another step.
    A row of a parent cycle (``cycle`` true) raises :class:`TreeCycle`, a
    non-empty level deeper than ``max_depth`` :class:`TreeTooDeep`."""
    cut, metrics = _cut(df, n_open=open_rows, n_rows=F.lit(True), n_cycle=F.lit(False) if cycle is None else cycle)
    if metrics["n_cycle"]:
        raise TreeCycle(f"{metrics['n_cycle']} nodes met themselves again {depth} levels away (parent cycle)")
    if max_depth is not None and depth > max_depth and metrics["n_rows"]:
        raise TreeTooDeep(f"tree walk did not end within {max_depth} levels")
    return cut, int(metrics["n_open"])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --------------------------------------------------------------------------- path-encoded trees

def path_ancestors(df: DataFrame, path_col: str = "path", proper: bool = False) -> DataFrame:
    """H1: one row per (path, ancestor) with the ancestor's depth (``/`` = 0).

    ``proper`` drops the path itself.
    """
    exploded = df.select("*", F.posexplode(ancestors(F.col(path_col))).alias("depth", "ancestor")) \
        .withColumn("depth", F.col("depth").cast("bigint"))
    if proper:
        exploded = exploded.filter(F.col("ancestor") != F.col(path_col))
    return exploded


def topmost(paths: DataFrame, path_col: str = "path", mode: str = "descendant") -> DataFrame:
    """H6: keep the paths that have no other listed path above them (an antichain
    that covers the input). ``mode='prefix'``: no other listed path as a proper
    string prefix.

    One ordered scan: with the separator below every other byte, the paths at or
    below a path follow it up to an end of its own, so a path is covered where
    the highest end before it lies beyond it. Each path is exchanged as one row,
    however deep it is."""
    if mode == "descendant":
        key = F.when(F.col(path_col) == "/", F.lit("")).otherwise(F.replace(F.col(path_col), F.lit("/"), F.lit("\0"))).cast("binary")
        end = F.concat("__key", F.lit(bytes([1])))
    else:
        key = F.col(path_col).cast("binary")
        end = F.concat("__key", F.lit(bytes([255])))  # no byte of UTF-8
    p = paths.select(path_col).distinct().withColumn("__key", key).withColumn("__end", end)
    seen = running(p, [], ["__key"], "__end", "max", "__reach")
    return seen.filter(F.col("__reach").isNull() | (F.col("__reach") <= F.col("__key"))).select(path_col)


def tree_listing(local: DataFrame, root, files: bool = True) -> DataFrame:
    """H7: the tree of ``root`` as rows: ``root, path, rel_depth, name, is_dir,
    line`` where ``line`` is the name indented two spaces per level. Sorting by
    ``sort_key`` (the array of path parts) gives the listing order. ``root`` may
    be a list (configuration): one scan for all, a row for every root a path is
    under."""
    roots = [r.rstrip("/") or "/" for r in ([root] if isinstance(root, str) else root)]
    df = local if files else local.filter(F.col("is_dir"))
    path, none = F.col("path"), F.lit(None).cast("string")
    over = [F.when((path == r) | path.startswith(r.rstrip("/") + "/"), F.lit(r)).otherwise(none) for r in roots]
    df = df.withColumn("root", F.explode(F.filter(F.array(*over), lambda r: r.isNotNull())))
    rel = path_depth(path) - path_depth(F.col("root"))
    return df.select(
        "root", "path", rel.alias("rel_depth"), basename(path).alias("name"), "is_dir",
        F.concat(F.repeat(F.lit("  "), rel.cast("int")), basename(path)).alias("line"),
        path_parts(path).alias("sort_key"))


def subtree_rollup(local: DataFrame) -> DataFrame:
    """H8: per folder, number of files and bytes at or below it.

    Two aggregations: files are first summed per parent folder (partial,
    map-side combined, no arrays), then only the much smaller folder table is
    exploded into ancestors and summed again. Hot top folders never see one
    row per file.
    """
    files = local.filter(~F.col("is_dir")).select(parent_dir(F.col("path")).alias("parent"), "size")
    direct = files.groupBy("parent").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.coalesce(F.col("size"), F.lit(0))).alias("b"))
    up = direct.select(F.explode(ancestors(F.col("parent"))).alias("folder"), "n", "b")
    return up.groupBy("folder").agg(F.sum("n").alias("n_files"), F.sum("b").alias("bytes"))


# --------------------------------------------------------------------------- parent-pointer trees

NODE_COLS = ["file_id", "name", "parent_id", "mime_type", "md5sum", "modified_time", "size", "trashed"]


def descend(children: DataFrame, seeds: DataFrame, path_col: str = "path", expand: Column | None = None,
            max_depth: int | None = None, folder_mime: str = "application/vnd.folder",
            extra=()) -> DataFrame:
    """Top-down BFS over the folders; all other nodes are attached by one join at the end.

    ``children``: nodes that may be reached (``NODE_COLS``), e.g. the
    non-trashed listing. ``seeds``: the level-0 rows, with ``NODE_COLS`` plus
    ``path_col``. Every reached node gets ``path = parent path + '/' + name``,
    ``depth`` and ``seed_id``. Only folders are expanded, and only those for
    which ``expand`` (evaluated on the reached row) is true. ``extra`` names
    further columns of both tables to carry.
    """
    cols = [*[c for c in NODE_COLS if c in children.columns], *extra]
    front_cols = [F.col("file_id").alias("__pid"), F.col(path_col).alias("__ppath"), F.col("seed_id"),
                  F.col("depth").alias("__pdepth")]
    opens = F.col("mime_type") == folder_mime
    if expand is not None:
        opens = opens & expand

    def below(kids: DataFrame, front: DataFrame) -> DataFrame:
        return kids.join(front.select(*front_cols), F.col("parent_id") == F.col("__pid")).select(
            *cols, F.concat(F.col("__ppath"), F.lit("/"), F.col("name")).alias(path_col),
            (F.col("__pdepth") + 1).alias("depth"), F.col("seed_id"))

    is_folder = F.coalesce(F.col("mime_type") == folder_mime, F.lit(False))
    folders, files = children.select(*cols).filter(is_folder), children.select(*cols).filter(~is_folder)
    checkpoint_dir(children.sparkSession)
    level, n_open = _cut_count(seeds.select(*cols, path_col, F.lit(0).alias("depth"),
                                            F.col("file_id").alias("seed_id")), opens)
    levels, depth = [level], 0
    if n_open:
        folders = folders.checkpoint(eager=True)  # each level joins the folders only
    while n_open:
        depth += 1
        # every node has one parent, so a walk can only come back to its seed
        level, n_open = _cut_count(below(folders, level.filter(opens)), opens, depth, max_depth,
                                   F.col("file_id") == F.col("seed_id"))
        levels.append(level)
    reached = _union(levels)
    if not depth:
        return reached
    leaves = below(files, reached.filter(opens))
    if max_depth is not None:
        leaves, _ = _cut_count(leaves, F.lit(False))
        if not leaves.filter(F.col("depth") > max_depth).isEmpty():
            raise TreeTooDeep(f"tree walk did not end within {max_depth} levels")
    return reached.unionByName(leaves)


def lineage(remote: DataFrame, carry=("name",)) -> DataFrame:
    """``file_id, chain, cyclic`` of every node that is somebody's parent: ``chain`` = array of structs (``id`` +
    ``carry`` columns) from the node up to the last known ancestor, ``cyclic`` = it runs into a parent cycle.

    Pointer doubling over these nodes: an open row points at the node that
    continues its chain; each round it takes that node's chain and pointer. Rows
    that are done are not written again. Ids must be unique."""
    elem = F.struct(F.col("file_id").alias("id"), *[F.col(c) for c in carry])
    parents = remote.select(F.col("parent_id").alias("file_id")).filter("file_id IS NOT NULL").distinct()
    rows = remote.join(parents, "file_id", "left_semi").select(
        "file_id", F.array(elem).alias("chain"), F.col("parent_id").alias("next"), F.lit(False).alias("cyclic"))
    is_open = F.col("next").isNotNull()
    rows, n_open = _cut_count(rows, is_open)
    done = [rows.filter(~is_open)]
    while n_open:
        up = _union([*done, rows.filter(is_open)]).select(
            F.col("file_id").alias("__up"), F.col("chain").alias("__chain"), F.col("next").alias("__next"),
            F.col("cyclic").alias("__cyclic"))
        met = F.coalesce(F.arrays_overlap(F.col("chain")["id"], F.col("__chain")["id"]), F.lit(False))
        step = rows.filter(is_open).join(up, F.col("next") == F.col("__up"), "left").select(
            "file_id", F.when(F.col("__up").isNull() | met, F.col("chain"))
            .otherwise(F.concat("chain", "__chain")).alias("chain"),
            F.when(~met, F.col("__next")).alias("next"), (met | F.coalesce("__cyclic", F.lit(False))).alias("cyclic"))
        rows, n_open = _cut_count(step, is_open)
        done.append(rows.filter(~is_open))
    return _union(done).select("file_id", "chain", "cyclic")


def chains(remote: DataFrame, ids: DataFrame, id_col: str = "file_id", carry=("name",),
           max_depth: int | None = None, kept: DataFrame | None = None) -> DataFrame:
    """One row per distinct id: ``start_id``, ``chain`` (self first; empty for an unknown id) and ``found``, written
    once. ``kept`` is the :func:`lineage` of the same listing and ``carry``, where there is one already. An id on or
    below a parent cycle raises :class:`TreeCycle`, one below more than ``max_depth`` ancestors :class:`TreeTooDeep`.

    An id that is somebody's parent has its chain in the lineage; the listing is read for the other ids only."""
    kept = lineage(remote, carry) if kept is None else kept
    starts = ids.select(F.col(id_col).alias("start_id")).distinct()
    own = kept.select(F.col("file_id").alias("__f"), "chain", "cyclic")
    cut, n = _cut(starts.join(own, F.col("start_id") == F.col("__f"), "left"), cyclic=F.col("cyclic"),
                  left=F.col("__f").isNull() & F.col("start_id").isNotNull())
    if n["cyclic"]:
        raise TreeCycle(f"{n['cyclic']} nodes on or below a parent cycle")
    known = cut.filter("__f IS NOT NULL").select("start_id", "chain", F.lit(True).alias("found"))
    left = cut.filter("__f IS NULL").select("start_id")
    if n["left"]:
        out = known.unionByName(_leaf_chains(remote, left, carry, kept))
    else:
        none = F.array().cast(_type(remote, carry))
        out = known.unionByName(left.select("start_id", none.alias("chain"), F.lit(False).alias("found")))
    if max_depth is not None:
        n_deep = out.filter(F.size("chain") > max_depth + 1).count()
        if n_deep:
            raise TreeTooDeep(f"{n_deep} nodes have more than {max_depth} ancestors")
    return out


def _leaf_chains(remote: DataFrame, starts: DataFrame, carry, kept: DataFrame) -> DataFrame:
    """:func:`chains` of ids that are nobody's parent (or not in the listing): themselves and their parents' chains."""
    elem = F.struct(F.col("file_id").alias("id"), *[F.col(c) for c in carry])
    own = matching(remote, "file_id", starts, "start_id").select(
        F.col("file_id"), F.col("parent_id").alias("__parent"), F.array(elem).alias("__own"))
    above = kept.select(F.col("file_id").alias("__f"), F.col("chain").alias("__above"), "cyclic")
    j = starts.join(own, F.col("start_id") == F.col("file_id"), "left")
    key = null_safe_key(F.col("__parent"), F.coalesce("start_id", F.lit("")), "noparent")  # tops and unknown ids spread
    j = j.withColumn("__key", key).join(above, F.col("__key") == F.col("__f"), "left")
    none = F.slice("__own", 1, 0)
    met = F.coalesce(F.col("cyclic") | F.array_contains(F.col("__above")["id"], F.col("start_id")), F.lit(False))
    out = j.select("start_id", F.when(F.col("file_id").isNull(), F.array().cast(_type(remote, carry)))
                   .otherwise(F.concat("__own", F.coalesce("__above", none))).alias("chain"),
                   F.col("file_id").isNotNull().alias("found"), met.alias("__cyclic"))
    cut, _ = _cut_count(out, F.lit(False), cycle=F.col("__cyclic"))
    return cut.drop("__cyclic")


def _type(remote: DataFrame, carry) -> T.ArrayType:
    fields = [T.StructField("id", remote.schema["file_id"].dataType), *[T.StructField(c, remote.schema[c].dataType) for c in carry]]
    return T.ArrayType(T.StructType(fields))


def closure(remote: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Every node with its root-first chain of ids (``chain``), its absolute
    remote path (``/top/.../name``) and depth. Nodes on or below a parent cycle
    have no root: they raise :class:`TreeCycle`."""
    kept = lineage(remote)
    rootless = kept.filter("cyclic").select("file_id")
    lost = [r["file_id"] for r in rootless.limit(5).collect()]
    if lost:
        raise TreeCycle(f"nodes without a root, such as {lost} (parent cycle)")
    above = kept.select(F.col("file_id").alias("__f"), F.reverse("chain").alias("__above"))
    key = null_safe_key(F.col("parent_id"), F.col("file_id"), "noparent")
    j = remote.select(*NODE_COLS).withColumn("__key", key).join(above, F.col("__key") == F.col("__f"), "left")
    names = F.concat(F.coalesce(F.col("__above")["name"], F.array().cast("array<string>")), F.array("name"))
    ids = F.concat(F.coalesce(F.col("__above")["id"], F.array().cast("array<string>")), F.array("file_id"))
    out = j.select(*NODE_COLS, F.concat(F.lit("/"), F.array_join(names, "/")).alias("path"),
                   (F.size(ids) - 1).alias("depth"), ids.alias("chain"))
    if max_depth is not None and not out.filter(F.col("depth") > max_depth).isEmpty():
        raise TreeTooDeep(f"the tree has more than {max_depth} levels")
    return out


def id_ancestors_all(remote: DataFrame, max_depth: int | None = None) -> DataFrame:
    """H2 for the whole listing: ``(file_id, ancestor_id, depth)``, depth 0 = self."""
    c = closure(remote, max_depth)
    return c.select("file_id", F.posexplode(F.reverse(F.col("chain"))).alias("depth", "ancestor_id"))


def id_ancestors(remote: DataFrame, ids: DataFrame, id_col: str = "file_id",
                 max_depth: int | None = None) -> DataFrame:
    """H2 for given ids: the chain from the node to the top, self first."""
    ch = chains(remote, ids, id_col, carry=(), max_depth=max_depth)
    return ch.select(F.col("start_id").alias("file_id"),
                     F.posexplode(F.col("chain")["id"]).alias("depth", "ancestor_id"))


def remote_path(remote: DataFrame, ids: DataFrame, id_col: str = "file_id", stop_id: str | None = None,
                max_depth: int | None = None) -> DataFrame:
    """H3: ``/`` + names from just below ``stop_id`` down to the node; ``/`` for
    the stop itself; from the top when the stop is not an ancestor. Unknown ids
    give NULL."""
    ch = chains(remote, ids, id_col, max_depth=max_depth)
    below = F.col("chain")["name"]
    if stop_id is not None:
        at = F.array_position(F.col("chain")["id"], stop_id).cast("int")  # 1-based, 0 if it is not an ancestor
        below = F.when(at > 0, F.slice(below, 1, F.greatest(at - 1, F.lit(0)))).otherwise(below)
    names = F.reverse(below)
    path = F.when(F.col("found"), F.when(F.size(names) == 0, F.lit("/"))
                  .otherwise(F.concat(F.lit("/"), F.array_join(names, "/"))))
    return ch.select(F.col("start_id").alias(id_col), path.alias("remote_path"))


def is_ancestor(remote: DataFrame, pairs: DataFrame, folder_col: str = "folder_id", file_col: str = "file_id",
                max_depth: int | None = None) -> DataFrame:
    """Is ``folder_col`` an ancestor-or-self of ``file_col``."""
    ch = chains(remote, pairs.select(file_col), file_col, carry=(), max_depth=max_depth)
    ch = ch.select(F.col("start_id").alias("__fid"), F.col("chain")["id"].alias("__ids"))
    j = pairs.join(ch, F.col(file_col) == F.col("__fid"), "left")
    return j.withColumn("is_ancestor", F.coalesce(F.array_contains(F.col("__ids"), F.col(folder_col)), F.lit(False))) \
        .drop("__fid", "__ids")


def tag_archived(remote: DataFrame, archive: DataFrame) -> DataFrame:
    """Remote nodes with ``archived`` (id present in the archive) and ``archive_path``."""
    a = archive.select(F.col("drive_id").alias("__aid"), F.col("path").alias("archive_path"))
    return remote.join(a, F.col("file_id") == F.col("__aid"), "left") \
        .withColumn("archived", F.col("__aid").isNotNull()).drop("__aid")


def _archived_among(ch: DataFrame, archive: DataFrame) -> DataFrame:
    """``id, archive_path`` of the archived nodes that occur in the chains: every node is looked up once, however many
    chains hold it."""
    nodes = ch.select(F.explode(F.col("chain")["id"]).alias("id")).distinct()
    a = matching(archive, "drive_id", nodes, "id").select(F.col("drive_id").alias("id"),
                                                          F.col("path").alias("archive_path"))
    return nodes.join(a, "id")


def nearest_tracked_ancestor(changes: DataFrame, remote: DataFrame, archive: DataFrame, root_ids,
                             ignored_ids=(), max_depth: int | None = None, kept: DataFrame | None = None) -> DataFrame:
    """For each changed id, the first ancestor starting at its parent (taken
    from the change row) that is a root or archived. NULL when an ignored id is
    met first, when the id itself is a root or ignored, or when there is no
    parent. Returns ``file_id, parent_id, tracked_id, mid_path`` per distinct
    (file_id, parent_id); ``mid_path`` joins the names strictly below the
    tracked ancestor down to the parent (``''`` when the parent is tracked).
    ``kept``: the listing's :func:`lineage`, if it is there already."""
    root_ids, ignored_ids = list(root_ids), list(ignored_ids)
    pairs = changes.select("file_id", "parent_id").distinct()
    ch, _ = tracked_parents(pairs, remote, archive, root_ids, ignored_ids, max_depth, kept)
    key = null_safe_key(F.col("parent_id"), F.coalesce("file_id", F.lit("")), "noparent")
    out = pairs.withColumn("__key", key).join(ch, F.col("__key") == F.col("__p"), "left")
    self_block = (F.col("file_id").isin(root_ids + ignored_ids)) if (root_ids or ignored_ids) else F.lit(False)
    tracked = F.when(self_block | F.col("parent_id").isNull(), F.lit(None).cast("string")).otherwise(F.col("__tracked"))
    return out.select("file_id", "parent_id", tracked.alias("tracked_id"),
                      F.when(tracked.isNotNull(), F.col("__mid")).alias("mid_path"))


def tracked_parents(changes: DataFrame, remote: DataFrame, archive: DataFrame, root_ids: list, ignored_ids: list,
                    max_depth: int | None = None, kept: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """J8 by parent, which is all it depends on but for the changed id's own test: ``__p`` (a parent of ``changes``),
    ``__tracked`` and ``__mid``, without parents that meet neither a tracked nor an ignored node. With it the archived
    nodes on their way, ``id, archive_path``, written once."""
    ch = chains(remote.select("file_id", "parent_id", "name"), changes.filter(F.col("parent_id").isNotNull()),
                "parent_id", max_depth=max_depth, kept=kept)
    archived = _archived_among(ch, archive).checkpoint(eager=True)
    hits = archived.select("id", F.lit(True).alias("archived"))
    steps = ch.select("start_id", F.posexplode(F.col("chain")["id"]).alias("depth", "id")).join(hits, "id", "left")
    is_root = F.col("id").isin(root_ids) if root_ids else F.lit(False)
    is_ign = F.col("id").isin(ignored_ids) if ignored_ids else F.lit(False)
    tag = F.when(is_ign, "ignored").when(is_root | F.col("archived"), "tracked")
    first = steps.withColumn("tag", tag).filter("tag IS NOT NULL").groupBy("start_id") \
        .agg(F.min(F.struct("depth", "tag", "id")).alias("hit"))
    names = F.slice(F.col("chain")["name"], 1, F.col("hit.depth"))
    ch = ch.join(first, "start_id").select(
        F.col("start_id").alias("__p"), F.when(F.col("hit.tag") == "tracked", F.col("hit.id")).alias("__tracked"),
        F.array_join(F.reverse(names), "/").alias("__mid"))
    return ch, archived


def parent_archive(remote: DataFrame, archive: DataFrame, ids: DataFrame, id_col: str = "file_id",
                   max_depth: int | None = None) -> DataFrame:
    """First archived ancestor-or-self of each id (``archive_id``, ``archive_path``)."""
    ch = chains(remote.select("file_id", "parent_id"), ids, id_col, carry=(), max_depth=max_depth)
    steps = ch.select("start_id", F.posexplode(F.col("chain")["id"]).alias("depth", "id"))
    first = steps.join(_archived_among(ch, archive), "id").groupBy("start_id") \
        .agg(F.min(F.struct("depth", "id", "archive_path")).alias("hit"))
    return ch.select("start_id").join(first, "start_id", "left").select(
        F.col("start_id").alias(id_col), F.col("hit.id").alias("archive_id"),
        F.col("hit.archive_path").alias("archive_path"))


def walk(remote: DataFrame, folder_id: str, where: Column | None = None, where_files_only: bool = False,
         max_depth: int | None = None, folder_mime: str = "application/vnd.folder",
         root_name: str | None = None) -> DataFrame:
    """H4: the non-trashed subtree of ``folder_id``, root included, one row per
    node with ``path`` starting at the root's name, ``depth`` and ``type``.

    ``where`` filters listed children; like the listing it is applied to
    folders too and so cuts subtrees, unless ``where_files_only``. A missing
    root gives no rows.
    """
    kids = remote.filter(~F.col("trashed"))
    if where is not None:
        cond = where if not where_files_only else ((F.col("mime_type") == folder_mime) | where)
        kids = kids.filter(cond)
    root_path = F.lit(root_name) if root_name is not None else F.col("name")
    seeds = remote.filter(F.col("file_id") == folder_id).select(*NODE_COLS, root_path.alias("path"))
    out = descend(kids, seeds, expand=None, max_depth=max_depth, folder_mime=folder_mime)
    return out.withColumn("type", F.when(F.col("mime_type") == folder_mime, "#folder").otherwise("#file")) \
        .withColumn("is_root", F.col("depth") == 0).drop("seed_id")


def walk_pruned(nodes: DataFrame, folder_id, flag_col: str, max_depth: int | None = None,
                folder_mime: str = "application/vnd.folder") -> DataFrame:
    """H5: walk where a folder whose ``flag_col`` is true is reported but not
    entered. ``nodes`` is the listing with the flag already computed.
    ``folder_id`` may be a list: one walk per id, told apart by ``seed_id``."""
    kids = nodes.filter(~F.col("trashed"))
    extra = [c for c in nodes.columns if c not in NODE_COLS and c != "seed_id"]
    ids = [folder_id] if isinstance(folder_id, str) else list(folder_id)
    seeds = nodes.filter(F.col("file_id").isin(ids)).withColumn("path", F.col("name"))
    out = descend(kids, seeds, expand=~F.coalesce(F.col(flag_col), F.lit(False)), max_depth=max_depth,
                  folder_mime=folder_mime, extra=extra)
    return out.withColumn("type", F.when(F.col("mime_type") == folder_mime, "#folder").otherwise("#file")) \
        .withColumn("is_root", F.col("depth") == 0)
