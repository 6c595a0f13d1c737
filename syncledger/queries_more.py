"""Registered queries for what the others do not run on their own: snapshots and
reports written and read back, path helpers, filters as arguments, orders as
ranks, and the forms of P3 and P8 that a sync takes."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from . import fixtures as fx
from .functions.paths import join_path, replace_prefix, strip_first_segment
from .operators import catalog as U
from .operators import diff as D
from .operators import exclude as X
from .operators import hierarchy as H
from .operators import intervals as I
from .oracles import excluded_sql
from .operators.ordering import group_row_number, parents_first
from .plans import download as PD
from .plans import upload as PU
from .operators.reconcile import needs_upload
from .queries import FOLDER, IGNORED_IDS, LAST_SYNC, ROOT_IDS_SQL, WALK_FOLDER, WALK_LOCAL, WALK_SQL, excl, inv, register
from .queries_plans import (ONE_ROOT, P2_SQL, P3_COLS, RESTORE, link_sql, p1_sql, p3_sql)
from .session import scratch_path
from .sources import bucketed as B
from .sources import listing as S
from .sources import store
from .sources.directory import open_tree
from .sources.sinks import write_tree_report
from .streaming import jobs as V
from .streaming.feed import changed_since


def _new_folder(spark, name: str) -> str:
    return scratch_path(spark, "written", f"{name}-{uuid.uuid4().hex[:12]}")


# --------------------------------------------------------------------------- written and read back

@register("s6_read_archive", oracle="SELECT path, drive_id, date_modified_on_disk, md5sum FROM archive")
def q_s6(spark, sf_dir):
    """S9 then S6: an older snapshot, then the archive; the latest is read."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "archive")
    store.write_archive(i.A.filter(F.col("md5sum") == ""), base)
    store.write_archive(i.A, base)
    return store.read_archive(spark, base)


@register("s9_delta_snapshots", oracle="""
SELECT a.path, a.drive_id, CASE WHEN a.md5sum <> l.md5sum THEN l.mtime ELSE a.date_modified_on_disk END AS date_modified_on_disk,
  CASE WHEN a.md5sum <> l.md5sum THEN l.md5sum ELSE a.md5sum END AS md5sum
FROM archive a JOIN local_files l ON l.path = a.path
UNION ALL SELECT path, 'new:' || path, mtime, coalesce(md5sum, '') FROM local_files
WHERE path NOT IN (SELECT path FROM archive)""")
def q_s9_delta(spark, sf_dir):
    """The archive, then three deltas: U3 of what left the disk, U1 by path of what changed there, U5 of what is new."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "archive")
    store.write_archive(i.A, base)
    store.write_delta(U.delete_changes(i.A, D.removed_locally(i.A, i.L)), base)
    a = store.read_archive(spark, base)
    newer = i.L.alias("l").join(a.alias("a"), "path").filter("a.md5sum <> l.md5sum").select(
        "path", F.lit(None).cast("string").alias("drive_id"), F.col("l.mtime").alias("date_modified_on_disk"),
        F.col("l.md5sum").alias("md5sum"), F.lit(1).alias("seq"))
    store.write_delta(U.upsert_changes(a, newer), base)
    a = store.read_archive(spark, base)
    new = i.L.join(i.A.select("path"), "path", "left_anti").select(
        "path", F.concat(F.lit("new:"), "path").alias("drive_id"), F.col("mtime").alias("date_modified_on_disk"),
        F.coalesce("md5sum", F.lit("")).alias("md5sum"), F.lit(1).alias("seq"))
    store.write_delta(U.upsert_changes(a, new), base)
    return store.read_archive(spark, base)


@register("s10_tree_report", oracle=" UNION ALL ".join(f"""
SELECT '{r}' AS root, repeat('  ', len(string_split(path, '/')) - 1 - 2) || regexp_extract(path, '([^/]*)$', 1) AS line
FROM local_files WHERE path = '{r}' OR starts_with(path, '{r}/')""" for r in fx.ROOT_PATHS).strip())
def q_s10(spark, sf_dir):
    out = _new_folder(spark, "trees")
    write_tree_report(inv(spark, sf_dir).L, fx.ROOT_PATHS, True, out)
    return spark.read.schema("value string, root string").text(out).select("root", F.col("value").alias("line"))


# --------------------------------------------------------------------------- rules as a table

def _rule_table(spark, sf_dir):
    """The fixture's exclusions, and as rules the names of all customers with a negative balance, and some with a ``*``."""
    i = inv(spark, sf_dir)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_acctbal < 0").select("c_name")
    rules = customers.select(F.col("c_name").alias("value")).unionByName(customers.select(
        F.concat(F.lit("*_"), F.substring_index("c_name", "#", -1).cast("bigint"), F.lit(".csv")).alias("value"))) \
        .unionByName(customers.select(F.concat(F.lit("Order_"), F.substring_index("c_name", "#", -1).cast("bigint"),
                                               F.lit("*")).alias("value")))
    return X.Exclusions.from_table(i.exclusions.unionByName(rules.select(F.lit("rule").alias("kind"), "value")))


RULE_TABLE_SQL = """
minus AS (SELECT c_name, CAST(CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS VARCHAR) AS num FROM customer WHERE c_acctbal < 0),
starts AS (SELECT DISTINCT num, length(num) AS n FROM minus),
sizes AS (SELECT DISTINCT n FROM starts),
bad_name AS (
  SELECT name FROM (SELECT DISTINCT unnest(string_split(path, '/')) AS name FROM (SELECT path FROM local_files UNION ALL SELECT path FROM archive))
  WHERE name IN (SELECT c_name FROM minus)
    OR regexp_extract(name, '_([0-9]+)\\.csv$', 1) IN (SELECT num FROM minus)
    OR EXISTS (SELECT 1 FROM sizes z WHERE starts_with(name, 'Order_')
               AND substr(name, 7, CAST(z.n AS INT)) IN (SELECT num FROM starts s WHERE s.n = z.n)))"""


@register("f7_rule_table", oracle=f"""
{RULE_TABLE_SQL.strip()}
SELECT path, ({excluded_sql('path')}) OR regexp_extract(path, '([^/]*)$', 1) IN (SELECT name FROM bad_name) AS excluded
FROM archive""")
def q_f7_table(spark, sf_dir):
    return X.is_excluded(inv(spark, sf_dir).A.select("path"), "path", _rule_table(spark, sf_dir))


# --------------------------------------------------------------------------- interval labels, ordered scans, buckets

_IDS_SQL = """RECURSIVE ids(file_id, name, chain, path) AS (
  SELECT file_id, name, [file_id], '/' || name FROM remote_files WHERE parent_id IS NULL
  UNION ALL SELECT r.file_id, r.name, list_append(i.chain, r.file_id), i.path || '/' || r.name
  FROM ids i JOIN remote_files r ON r.parent_id = i.file_id)"""


@register("h2_interval_labels", oracle=f"""
{_IDS_SQL},
sizes AS (SELECT a, count(*) AS n FROM (SELECT unnest(chain) AS a FROM ids) GROUP BY a),
placed AS (SELECT *, row_number() OVER (ORDER BY chain) - 1 AS enter FROM ids)
SELECT p.file_id, CAST(p.enter AS BIGINT) AS enter, CAST(p.enter + s.n - 1 AS BIGINT) AS exit,
  CAST(len(p.chain) - 1 AS BIGINT) AS depth, p.path AS remote_path
FROM placed p JOIN sizes s ON s.a = p.file_id""")
def q_labels(spark, sf_dir):
    return I.interval_labels(inv(spark, sf_dir).R)


def _labelled(spark, sf_dir):
    return I.write_labelled(inv(spark, sf_dir).R, _new_folder(spark, "labelled"))


@register("j14_is_ancestor_labels", oracle=f"""
{_IDS_SQL},
folder AS (SELECT DISTINCT parent_id AS folder_id FROM remote_files WHERE parent_id LIKE 'n%'),
pairs AS (SELECT DISTINCT f.folder_id, c.file_id FROM changes c JOIN folder f
  ON f.folder_id = 'n' || CAST(c.seq % 25 AS VARCHAR))
SELECT p.folder_id, p.file_id, coalesce(list_contains(i.chain, p.folder_id), FALSE) AS is_ancestor
FROM pairs p LEFT JOIN ids i ON i.file_id = p.file_id""")
def q_j14_labels(spark, sf_dir):
    """Is a changed file below the nation its event's number names: many folders, many files, no chains."""
    i = inv(spark, sf_dir)
    folders = i.R.filter(F.col("parent_id").like("n%")).select(F.col("parent_id").alias("folder_id")).distinct()
    pairs = i.C.select(F.concat(F.lit("n"), F.col("seq") % 25).alias("folder_id"), "file_id").distinct() \
        .join(folders, "folder_id", "left_semi")
    return I.is_ancestor_labelled(_labelled(spark, sf_dir), pairs)


@register("h4_walk_labels", oracle=f"""
RECURSIVE {WALK_SQL}
SELECT file_id, path, CAST(depth AS BIGINT) AS depth, CASE WHEN mime_type = {FOLDER} THEN '#folder' ELSE '#file' END AS type,
  depth = 0 AS is_root FROM w""")
def q_h4_labels(spark, sf_dir):
    return I.walk_labelled(_labelled(spark, sf_dir), WALK_FOLDER).select("file_id", "path", "depth", "type", "is_root")


@register("h6_topmost_prefix", oracle="""
files AS (SELECT path, drive_id, regexp_replace(path, '[^/]*$', '') AS dir FROM archive WHERE md5sum <> ''),
x AS (SELECT path, dir FROM files UNION SELECT substr(path, 1, length(path) - 5), dir FROM files WHERE drive_id LIKE '%1')
SELECT path FROM x WHERE path NOT IN (
  SELECT a.path FROM x a JOIN x o ON o.dir = a.dir AND starts_with(a.path, o.path) AND a.path <> o.path)""")
def q_h6_prefix(spark, sf_dir):
    """Paths of files, and some cut short, that no other of them is a string prefix of."""
    files = inv(spark, sf_dir).A.filter(F.col("md5sum") != "")
    cut = files.filter(F.col("drive_id").like("%1")).select(F.expr("substr(path, 1, length(path) - 5)").alias("path"))
    return H.topmost(files.select("path").unionByName(cut), mode="prefix")


@register("j1_bucketed", oracle="""
SELECT l.path, CASE WHEN a.path IS NULL THEN 'NEW' ELSE 'UPDATE' END AS op, a.drive_id
FROM local_files l LEFT JOIN archive a ON a.path = l.path
WHERE a.path IS NULL OR (NOT l.is_dir AND l.mtime > a.date_modified_on_disk)""")
def q_j1_bucketed(spark, sf_dir):
    """J1 between stored tables: neither side is exchanged."""
    i = inv(spark, sf_dir)
    c = B.write_catalog(i.L, i.A, i.R, _new_folder(spark, "bucketed"))
    return needs_upload(c.local, c.archive_by_path).select("path", "op", "drive_id")


# --------------------------------------------------------------------------- path helpers

@register("t3_join_path", oracle=f"""
SELECT path, '{RESTORE}/' || substr(path, 2) || '/copy' AS joined FROM archive""")
def q_t3(spark, sf_dir):
    joined = join_path(F.lit(RESTORE + "/"), F.col("path"), F.lit(None).cast("string"), F.lit(""), F.lit("/copy"))
    return inv(spark, sf_dir).A.select("path", joined.alias("joined"))


@register("t4_strip_first_segment", oracle="""
x AS (SELECT path, substr(path, 2) AS rel FROM archive)
SELECT path, CASE WHEN contains(rel, '/') THEN substr(rel, strpos(rel, '/') + 1) ELSE '' END AS rest FROM x""")
def q_t4(spark, sf_dir):
    rel = F.substring("path", 2, 1 << 30)
    return inv(spark, sf_dir).A.select("path", strip_first_segment(rel).alias("rest"))


@register("t7_replace_prefix", oracle=f"""
SELECT path, CASE WHEN starts_with(path, '{WALK_LOCAL}') THEN '/moved' || substr(path, {len(WALK_LOCAL) + 1}) ELSE path END
  AS moved FROM archive""")
def q_t7(spark, sf_dir):
    return inv(spark, sf_dir).A.select("path", replace_prefix("path", WALK_LOCAL, "/moved").alias("moved"))


# --------------------------------------------------------------------------- filters and orders

@register("f10_path_match", oracle="""
SELECT l.path, x.path AS matched_path FROM local_files l JOIN excl_paths x ON l.path = x.path OR starts_with(l.path, x.path || '/')
""")
def q_f10(spark, sf_dir):
    i = inv(spark, sf_dir)
    patterns = i.exclusions.filter("kind = 'path'").select(F.col("value").alias("path"))
    return D.path_match(i.L.select("path"), patterns)


@register("f11_children_where", oracle=f"""
SELECT file_id, name FROM remote_files WHERE parent_id = 'n7' AND NOT trashed AND ends_with(name, '1')""")
def q_f11_children(spark, sf_dir):
    return S.list_children(inv(spark, sf_dir).R, "n7", "all", F.col("name").endswith("1")).select("file_id", "name")


@register("f11_walk_where", oracle=f"""
RECURSIVE w(file_id, mime_type, path, depth) AS (
  SELECT file_id, mime_type, name, 0 FROM remote_files WHERE file_id = '{WALK_FOLDER}'
  UNION ALL SELECT r.file_id, r.mime_type, w.path || '/' || r.name, w.depth + 1
  FROM w JOIN remote_files r ON r.parent_id = w.file_id
  WHERE NOT r.trashed AND w.mime_type = {FOLDER} AND (r.mime_type = {FOLDER} OR ends_with(r.name, '.csv')))
SELECT file_id, path, depth FROM w""")
def q_f11_walk(spark, sf_dir):
    out = H.walk(inv(spark, sf_dir).R, WALK_FOLDER, where=F.col("name").endswith(".csv"), where_files_only=True)
    return out.select("file_id", "path", "depth")


@register("o1_parents_first_rank", oracle=f"""
{p1_sql('m', 'archive', 'sync_roots', "'root'")}
SELECT path, row_number() OVER (ORDER BY stage, depth, path) AS rank FROM m_plan""")
def q_o1_rank(spark, sf_dir):
    i = inv(spark, sf_dir)
    plan = PU.upload_plan(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS).select("path", "type")
    return group_row_number(parents_first(plan), [], ["stage", "depth", "path"], out="rank").select("path", "rank")


@register("h7_tree_listing_rank", oracle=f"""
SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) AS rank
FROM local_files WHERE path = '{WALK_LOCAL}' OR starts_with(path, '{WALK_LOCAL}/')""")
def q_h7_rank(spark, sf_dir):
    """Files and folders of one tree in the order of the listing."""
    rows = H.tree_listing(inv(spark, sf_dir).L, WALK_LOCAL, files=True)
    return group_row_number(rows, [], ["sort_key"], out="rank").select("path", "rank")


# --------------------------------------------------------------------------- what a sync takes

def _written_feed(spark, name: str, *parts) -> str:
    """Change events as a feed of their own: a file for each of ``parts``, in that order."""
    feed = _new_folder(spark, name)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(feed)
    return feed


def _run_to_end(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


@register("v5_peek_changes", oracle="SELECT seq, file_id FROM changes WHERE NOT (seq % 3 = 0 AND seq < 500)")
def q_v5(spark, sf_dir):
    """A dry run after a job that has finished part of the feed, on both sides of what is left."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "peek")
    feed = _written_feed(spark, "feed", i.C.filter("seq % 3 = 0 AND seq < 500"))
    _run_to_end(V._run(V.stream_changes(spark, feed), lambda b, _id: b.select("seq"), f"{base}/out", f"{base}/checkpoint"))
    return V.peek_changes(spark, i.C, f"{base}/out").select("seq", "file_id")


@register("v5_peek_feed", oracle="SELECT seq, file_id FROM changes WHERE seq > 500")
def q_v5_feed(spark, sf_dir):
    """A dry run of the feed by seq, whose later files hold earlier events."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "peek")
    feed = _written_feed(spark, "feed", i.C.filter("seq % 5 = 1"), i.C.filter("seq % 5 <> 1 AND seq > 400"),
                         i.C.filter("seq % 5 <> 1 AND seq <= 400"))
    _run_to_end(V._run(V.stream_feed(spark, feed, until_seq=500), lambda b, _id: b.select("seq"), f"{base}/out",
                       f"{base}/checkpoint"))
    return V.peek_changes(spark, V.read_feed(spark, feed), f"{base}/out").select("seq", "file_id")


@register("v1_stream_feed", oracle="SELECT * FROM changes")
def q_v1_feed(spark, sf_dir):
    """The feed as a stream by seq, in two runs of one job."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "feed")
    for until in (700, None):
        _run_to_end(V._run(V.stream_feed(spark, i.paths["changes"], until_seq=until), lambda b, _id: b, f"{base}/out",
                           f"{base}/checkpoint"))
    return V.read_output(spark, f"{base}/out").drop("batch_id")


@register("v4_late_events", oracle=f"""
SELECT seq, file_id, modified_time FROM changes WHERE date_trunc('second', modified_time) >= TIMESTAMP '{LAST_SYNC}'""")
def q_v4(spark, sf_dir):
    """Events older than the last sync are dropped from the stream, and so are events that are delivered again."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "late")
    feed = _written_feed(spark, "feed", i.C.filter("seq % 2 = 0"), i.C.filter("seq % 3 <> 0"), i.C.filter("seq % 6 <> 1"),
                         i.C.filter("seq % 6 = 3 OR seq % 5 = 0"))
    _run_to_end(V._run(V.stream_changes(spark, feed, max_files_per_trigger=1),
                       lambda b, _id: changed_since(b, LAST_SYNC), f"{base}/out", f"{base}/checkpoint"))
    return V.read_output(spark, f"{base}/out").select("seq", "file_id", "modified_time")


@register("v2_clashes_across_batches", oracle=f"""
RECURSIVE {p3_sql()},
bt AS (SELECT *, CASE WHEN seq <= (SELECT max(seq) // 3 FROM changes) THEN 0
  WHEN seq <= (SELECT 2 * max(seq) // 3 FROM changes) THEN 1 ELSE 2 END AS b FROM p3_plan)
SELECT seq, file_id, decision, why, dest_path, conflict, EXISTS (SELECT 1 FROM bt o WHERE o.dest_path = bt.dest_path
  AND (o.b < bt.b OR (o.b = bt.b AND o.seq <> bt.seq))) AS dup_dest FROM bt""")
def q_v2_clashes(spark, sf_dir):
    """The download plan as a stream in three batches: a destination of an earlier batch is a clash in a later one."""
    i = inv(spark, sf_dir)
    base = _new_folder(spark, "clashes")
    top = i.C.agg(F.max("seq")).first()[0]
    kept = H.lineage(i.R.select("file_id", "parent_id", "name"))  # one listing, three runs
    for until in (top // 3, 2 * top // 3, None):
        _run_to_end(V.stream_download_plan(V.stream_feed(spark, i.paths["changes"], until_seq=until), i.R, i.A, i.L,
                                           excl(spark, sf_dir), i.roots, LAST_SYNC, f"{base}/out", f"{base}/checkpoint",
                                           ignored_ids=IGNORED_IDS, kept=kept))
    return V.read_output(spark, f"{base}/out").select("seq", "file_id", "decision", "why", "dest_path", "conflict",
                                                      "dup_dest")


# --------------------------------------------------------------------------- a directory tree

_TREE_SQL = """
t AS (SELECT '/' || r_name AS path, TRUE AS is_dir, NULL AS content FROM region
  UNION ALL SELECT '/' || r_name || '/' || n_name, TRUE, NULL FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT '/' || r_name || '/' || n_name || '/empty', TRUE, NULL FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT '/' || r_name || '/' || n_name || '/' || s_name, FALSE, repeat(s_name || chr(10), 1 + s_suppkey % 7)
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def _written_tree(spark, sf_dir) -> str:
    """The suppliers as files in folders by region and nation, with an empty folder in each nation's."""
    base = _new_folder(spark, "tree")
    t = fx.read_tables(spark, sf_dir, ["supplier", "nation", "region"])
    nations = t["nation"].join(t["region"], F.col("r_regionkey") == F.col("n_regionkey")) \
        .withColumn("folder", F.concat_ws("/", "r_name", "n_name"))
    files = nations.join(t["supplier"], F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat_ws("/", "folder", "s_name").alias("path"),
        F.expr("repeat(concat(s_name, chr(10)), cast(1 + s_suppkey % 7 as int))").alias("content"))
    rows = files.unionByName(nations.select(F.concat("folder", F.lit("/empty")).alias("path"),
                                            F.lit(None).cast("string").alias("content")))

    def write(batches):
        system, at = open_tree(base)
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{at}/{row['path']}"
                system.create_dir(target if row["content"] is None else target.rsplit("/", 1)[0], recursive=True)
                if row["content"] is not None:
                    with system.open_output_stream(target) as out:
                        out.write(row["content"].encode())
            yield batch.select(["path"])

    rows.mapInArrow(write, "path string").count()
    return base


def _listed(spark, base: str, tree):
    """The listing with paths below ``base``, without ``base`` itself."""
    at = open_tree(base)[1].rstrip("/")
    return tree.withColumn("path", F.substring("path", len(at) + 1, 1 << 30)).filter("path <> ''")


@register("s1_scan_local", oracle=f"""{_TREE_SQL}
SELECT path, is_dir, CAST(coalesce(strlen(content), 0) AS BIGINT) AS size FROM t""")
def q_s1(spark, sf_dir):
    base = _written_tree(spark, sf_dir)
    return _listed(spark, base, S.scan_local(spark, base)).select("path", "is_dir", "size")


@register("t6_md5", oracle=f"""{_TREE_SQL}
SELECT path, md5(content) AS md5sum FROM t WHERE NOT is_dir""")
def q_t6(spark, sf_dir):
    base = _written_tree(spark, sf_dir)
    return _listed(spark, base, S.scan_local(spark, base, with_md5=True, with_dirs=False)).select("path", "md5sum")


@register("j9_contains_anywhere", oracle="""
pats AS (SELECT DISTINCT substr(path, 7, 6) AS p FROM archive WHERE drive_id LIKE 'o%7' AND length(path) > 12
  UNION SELECT 'IA' UNION SELECT 'x_nowhere_y' UNION SELECT '/NATION_1/'),
hits AS (SELECT a.path, a.drive_id, p AS matched_path FROM archive a JOIN pats ON contains(a.path, p))
SELECT * FROM hits""")
def q_j9_anywhere(spark, sf_dir):
    """Substrings that begin anywhere in a path, short and absent ones among them."""
    a = inv(spark, sf_dir).A
    cut = a.filter(F.col("drive_id").like("o%7") & (F.length("path") > 12)).select(F.substring("path", 7, 6).alias("path"))
    fixed = spark.createDataFrame([("IA",), ("x_nowhere_y",), ("/NATION_1/",)], "path string")
    return D.descendants_join(a.select("path", "drive_id"), cut.unionByName(fixed), mode="contains")


EXTRA_ROOT = ("root", "/untracked")
_P3_EXTRA = p3_sql().replace(ROOT_IDS_SQL, ROOT_IDS_SQL[:-1] + f" UNION ALL SELECT '{EXTRA_ROOT[0]}')") \
    .replace("ta.path", f"coalesce(ta.path, CASE rc.tracked_id WHEN '{EXTRA_ROOT[0]}' THEN '{EXTRA_ROOT[1]}' END)")


@register("p3_download_untracked_root", oracle=f"""
RECURSIVE {_P3_EXTRA}
SELECT {P3_COLS} FROM p3_plan""")
def q_p3_extra(spark, sf_dir):
    """P3 that also takes changes below the untracked top folder, to a folder of their own."""
    i = inv(spark, sf_dir)
    plan = PD.download_changes_plan(i.C, i.R, i.A, i.L, excl(spark, sf_dir), i.roots, LAST_SYNC,
                                    extra_root=EXTRA_ROOT, ignored_ids=IGNORED_IDS)
    return plan.select(*[c.strip() for c in P3_COLS.split(",")])


_P2_AFTER = re.sub(r"\bremote_files\b", "remote2", re.sub(r"\barchive\b", "archive2", P2_SQL))


@register("p8_folder_sync_applied", oracle=f"""
RECURSIVE {ONE_ROOT},
{link_sql('linked', 'archive', f"'{WALK_FOLDER}'", WALK_LOCAL)},
{p1_sql('m', 'linked', 'one_root', f"'{WALK_FOLDER}'")},
res AS (SELECT p.path, coalesce(p.drive_id, 'u-' || md5(p.path)) AS drive_id, l.is_dir, l.mtime,
  CASE WHEN l.is_dir THEN '' ELSE l.md5sum END AS md5sum, l.size FROM m_plan p JOIN local_files l ON l.path = p.path),
archive2 AS (SELECT * FROM linked WHERE drive_id NOT IN (SELECT drive_id FROM res)
  UNION ALL SELECT path, drive_id, mtime, md5sum FROM res),
remote2 AS (SELECT r.file_id, r.name, r.parent_id, r.mime_type,
    CASE WHEN u.drive_id IS NOT NULL AND r.mime_type <> {FOLDER} THEN u.md5sum ELSE r.md5sum END AS md5sum,
    coalesce(u.mtime, r.modified_time) AS modified_time,
    CASE WHEN u.drive_id IS NOT NULL AND r.mime_type <> {FOLDER} THEN u.size ELSE r.size END AS size, r.trashed
  FROM remote_files r LEFT JOIN res u ON u.drive_id = r.file_id
  UNION ALL SELECT u.drive_id, regexp_extract(u.path, '([^/]*)$', 1), p.drive_id,
    CASE WHEN u.is_dir THEN {FOLDER} ELSE 'application/octet-stream' END, CASE WHEN NOT u.is_dir THEN u.md5sum END,
    u.mtime, u.size, FALSE
  FROM res u LEFT JOIN archive2 p ON p.path = regexp_replace(u.path, '/[^/]*$', '')
  WHERE u.drive_id NOT IN (SELECT file_id FROM remote_files)),
{_P2_AFTER}
SELECT 'up' AS direction, type, path AS local_path, drive_id AS file_id,
  CASE WHEN op = 'NEW' THEN 'upload_new' ELSE 'upload_update' END AS action FROM m_plan
UNION ALL SELECT 'down', type, dest_path, file_id, CASE WHEN conflict THEN 'conflict' ELSE 'download' END FROM p2_plan""")
def q_p8_applied(spark, sf_dir):
    """P8 as a sync: the download is planned on the state after the uploads, which get ids from their paths."""
    i = inv(spark, sf_dir)
    ex = excl(spark, sf_dir)
    linked = PU.link_root(i.L, i.A, WALK_FOLDER, WALK_LOCAL)
    up = PD._once(PU.upload_sync_plan(i.L, i.A, ex, WALK_FOLDER, WALK_LOCAL))
    rows = i.L.select("path", "is_dir", "mtime", F.when(F.col("is_dir"), "").otherwise(F.col("md5sum")).alias("md5sum"))
    results = up.select("path", F.coalesce("drive_id", F.concat(F.lit("u-"), F.md5("path"))).alias("drive_id"), "size") \
        .join(rows, "path")
    remote, archive = PD.apply_uploads(i.R, linked, results)
    down = PD.download_folder_plan(remote, archive, i.L, ex, WALK_FOLDER, WALK_LOCAL)
    return PD.folder_sync_plan(up, down)
