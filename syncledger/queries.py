"""Registered queries: each reads the test tables of one scale factor, builds
the inventories and runs one operator or plan. Every query has a DuckDB
oracle (``ORACLES``) unless the operator is not expressible in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .operators.exclude import Exclusions
from .operators.reconcile import reconcile
from .oracles import excluded_sql, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_fixtures(oracle)
        return fn
    return deco


def inv(spark: SparkSession, sf_dir: str) -> fx.Inventories:
    return fx.load(spark, sf_dir)


_EXCL: dict = {}


def excl(spark: SparkSession, sf_dir: str) -> Exclusions:
    """Exclusions of the fixture set-up, read once per session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _EXCL:
        _EXCL[key] = Exclusions.from_df(inv(spark, sf_dir).exclusions)
    return _EXCL[key]


FOLDER = "'application/vnd.folder'"

# --------------------------------------------------------------------------- J2

RECONCILE_CASE = f"""
  CASE WHEN a_id IS NULL THEN 'new'
       WHEN {excluded_sql('archive_path')} THEN 'excluded'
       WHEN l_path IS NULL THEN 'gone'
       WHEN rmd5 IS NOT DISTINCT FROM a_md5 THEN 'p'
       WHEN rmd5 IS NOT DISTINCT FROM l_md5 THEN 'q'
       WHEN l_md5 IS NOT DISTINCT FROM a_md5 THEN 'r'
       WHEN rtime IS NOT NULL AND (rtime < a_time OR rtime < l_time) THEN 'older'
       ELSE 'conflict' END"""

DECISION_OF_WHY = ("CASE WHEN why IN ('new', 'r') THEN 1 WHEN why IN ('gone', 'conflict') THEN -1 "
                   "ELSE 0 END")


def reconcile_sql(nodes_cte: str, folder_time: bool) -> str:
    """CTEs ``rj`` (joined) and ``rc`` (with why/decision) over ``nodes_cte``."""
    rtime = ("date_trunc('second', n.modified_time)" if folder_time else
             f"CASE WHEN n.mime_type = {FOLDER} THEN NULL ELSE date_trunc('second', n.modified_time) END")
    return f"""
rj AS (
  SELECT n.*, CASE WHEN n.mime_type = {FOLDER} THEN '#folder' ELSE '#file' END AS type,
    coalesce(n.md5sum, '') AS rmd5, {rtime} AS rtime,
    a.drive_id AS a_id, a.path AS archive_path, a.date_modified_on_disk AS a_time, a.md5sum AS a_md5,
    l.path AS l_path, l.mtime AS l_time, l.md5sum AS l_md5
  FROM {nodes_cte} n LEFT JOIN archive a ON a.drive_id = n.file_id LEFT JOIN local_files l ON l.path = a.path),
rw AS (SELECT *, {RECONCILE_CASE} AS why FROM rj),
rc AS (SELECT *, {DECISION_OF_WHY} AS decision FROM rw)"""


@register("j2_reconcile", oracle=f"""
nodes AS (SELECT * FROM remote_files WHERE NOT trashed),
{reconcile_sql('nodes', False)}
SELECT file_id, type, archive_path, why, decision FROM rc""")
def q_j2_reconcile(spark, sf_dir):
    i = inv(spark, sf_dir)
    nodes = i.R.filter(~F.col("trashed"))
    return reconcile(nodes, i.A, i.L, excl(spark, sf_dir)).select("file_id", "type", "archive_path", "why", "decision")


# --------------------------------------------------------------------------- shared constants
from .functions.fields import select_fields  # noqa: E402
from .functions.globs import match_rules  # noqa: E402
from .operators import diff as D  # noqa: E402
from .operators import exclude as X  # noqa: E402
from .operators import hierarchy as H  # noqa: E402
from .operators.reconcile import collides, needs_upload  # noqa: E402
from .oracles import ancestors_sql, excluded_up_sql  # noqa: E402
from .sources import listing as S  # noqa: E402

WALK_FOLDER = "r2"          # the ASIA region folder
WALK_LOCAL = "/data/ASIA"
IGNORED_IDS = ["n12"]       # stands in for the tree-log folder the change feed ignores
DEFAULT_DOWNLOAD = "/downloads"
LAST_SYNC = fx.LAST_SYNC_TIME


def roots(spark, sf_dir):
    return fx.ROOT_PATHS


def start_seq(i: fx.Inventories) -> int:
    """Half of the highest offset (a scalar read on the driver)."""
    return int(i.C.agg(F.max("seq")).first()[0]) // 2


START_SEQ_SQL = "(SELECT max(seq) FROM changes) // 2"


def root_ids_of(i: fx.Inventories):
    """Remote ids of the sync roots (bounded: one per configured root)."""
    rows = D.tracked_roots(i.roots, i.A).select("drive_id").collect()
    return sorted(r[0] for r in rows)


ROOT_IDS_SQL = "(SELECT a.drive_id FROM archive a JOIN sync_roots s ON s.path = a.path)"

# --------------------------------------------------------------------------- sources


@register("s2_list_children", oracle=f"""
SELECT file_id, name, parent_id, CASE WHEN mime_type = {FOLDER} THEN '#folder' ELSE '#file' END AS type
FROM remote_files WHERE parent_id = 'n7' AND NOT trashed AND mime_type = {FOLDER}""")
def q_s2(spark, sf_dir):
    return S.list_children(inv(spark, sf_dir).R, "n7", "folders").select("file_id", "name", "parent_id", "type")


@register("s2_list_files_where", oracle=f"""
SELECT file_id, name, modified_time FROM remote_files
WHERE parent_id IN (SELECT file_id FROM remote_files WHERE parent_id = 'n3') AND NOT trashed
  AND mime_type <> {FOLDER} AND modified_time > TIMESTAMP '{LAST_SYNC}'""")
def q_s2_where(spark, sf_dir):
    i = inv(spark, sf_dir)
    custs = i.R.filter(F.col("parent_id") == "n3").select(F.col("file_id").alias("pid"))
    kids = i.R.join(custs, F.col("parent_id") == F.col("pid"), "left_semi")
    where = F.col("modified_time") > F.expr(f"TIMESTAMP_NTZ'{LAST_SYNC}'")
    out = kids.filter(~F.col("trashed") & (F.col("mime_type") != fx.FOLDER_MIME) & where)
    return out.select("file_id", "name", "modified_time")


@register("s3_list_all", oracle=f"""
SELECT file_id, name, parent_id, trashed FROM remote_files WHERE modified_time > TIMESTAMP '{LAST_SYNC}'""")
def q_s3(spark, sf_dir):
    where = F.col("modified_time") > F.expr(f"TIMESTAMP_NTZ'{LAST_SYNC}'")
    return S.list_all(inv(spark, sf_dir).R, where).select("file_id", "name", "parent_id", "trashed")


@register("s4_find_by_name", oracle="SELECT file_id, name, parent_id FROM remote_files WHERE name = 'ASIA'")
def q_s4(spark, sf_dir):
    return S.find_by_name(inv(spark, sf_dir).R, "ASIA").select("file_id", "name", "parent_id")


@register("o2_first_match", oracle=f"""
SELECT file_id, name FROM remote_files WHERE mime_type = {FOLDER} AND name LIKE 'NATION_1%'
ORDER BY file_id LIMIT 1""")
def q_o2(spark, sf_dir):
    r = inv(spark, sf_dir).R.filter((F.col("mime_type") == fx.FOLDER_MIME) & F.col("name").startswith("NATION_1"))
    return r.orderBy("file_id").limit(1).select("file_id", "name")


@register("s5_read_changes", oracle=f"""
SELECT seq, file_id, removed, trashed FROM changes WHERE seq >= {START_SEQ_SQL} AND NOT removed""")
def q_s5(spark, sf_dir):
    i = inv(spark, sf_dir)
    return S.read_changes(i.C, start_seq(i), include_removed=False).select("seq", "file_id", "removed", "trashed")


@register("s7_lookup", oracle="""
SELECT c.seq, c.file_id, coalesce(a.path, '?') AS path FROM changes c LEFT JOIN archive a ON a.drive_id = c.file_id""")
def q_s7(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.lookup(i.C.select("seq", "file_id"), i.A, "file_id", field="drive_id", value="path", fallback="?")


@register("s8_remote_exists", oracle="""
SELECT a.drive_id, coalesce(NOT r.trashed, FALSE) AS "exists" FROM archive a LEFT JOIN remote_files r ON r.file_id = a.drive_id""")
def q_s8(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.remote_exists(i.A.select("drive_id"), i.R)


@register("f1_select_fields", oracle="""
SELECT seq, file_id AS id, name, md5sum AS md5Checksum FROM changes""")
def q_f1(spark, sf_dir):
    nested = S.nest_changes(inv(spark, sf_dir).C)
    sel = select_fields(nested, "seq, file(id, name, md5Checksum)")
    return sel.select("seq", "file.id", "file.name", "file.md5Checksum")


@register("f2_merge_fields", oracle="""
SELECT seq, file_id AS id, name, parent_id AS parent, removed FROM changes""")
def q_f2(spark, sf_dir):
    nested = S.nest_changes(inv(spark, sf_dir).C)
    sel = select_fields(nested, "seq, file/id, removed", "file(name, parents)")
    return sel.select("seq", "file.id", "file.name", F.col("file.parents")[0].alias("parent"), "removed")


@register("f3_not_trashed", oracle="SELECT file_id FROM remote_files WHERE NOT trashed")
def q_f3(spark, sf_dir):
    return inv(spark, sf_dir).R.filter(~F.col("trashed")).select("file_id")


@register("f4_classify_type", oracle=f"""
SELECT file_id, CASE WHEN mime_type = {FOLDER} THEN '#folder' ELSE '#file' END AS type FROM remote_files""")
def q_f4(spark, sf_dir):
    from .operators.reconcile import classify_type
    return classify_type(inv(spark, sf_dir).R).select("file_id", "type")


@register("f5_changed_since", oracle=f"""
SELECT seq, file_id, modified_time FROM changes
WHERE NOT trashed AND date_trunc('second', modified_time) >= TIMESTAMP '{LAST_SYNC}'""")
def q_f5(spark, sf_dir):
    from .streaming.feed import changed_since
    c = inv(spark, sf_dir).C.filter(~F.col("trashed"))
    return changed_since(c, LAST_SYNC).select("seq", "file_id", "modified_time")


@register("f6_match_rules", oracle="""
SELECT path, regexp_matches(regexp_extract(path, '([^/]*)$', 1), (SELECT rules_re FROM params)) AS matched
FROM local_files""")
def q_f6(spark, sf_dir):
    return inv(spark, sf_dir).L.select("path", match_rules(F.col("path"), fx.EXCLUDED_RULES).alias("matched"))


@register("f7_is_excluded", oracle=f"""
SELECT path, {excluded_sql('path')} AS excluded FROM archive""")
def q_f7(spark, sf_dir):
    return X.is_excluded(inv(spark, sf_dir).A.select("path"), "path", excl(spark, sf_dir))


@register("f8_is_excluded_up", oracle=f"""
{excluded_up_sql('u', 'local_files')}
SELECT l.path, l.path IN (SELECT path FROM u_hit) AS excluded FROM local_files l""")
def q_f8(spark, sf_dir):
    return X.is_excluded_up(inv(spark, sf_dir).L.select("path"), "path", excl(spark, sf_dir), fx.ROOT_PATHS)


@register("f9_prune_excluded", oracle=f"""
{excluded_up_sql('u', 'local_files', include_stop=True)},
rooted AS (SELECT l.path, max_by(s.path, length(s.path)) AS root FROM local_files l JOIN sync_roots s
  ON l.path = s.path OR starts_with(l.path, s.path || '/') GROUP BY l.path)
SELECT l.path, r.root, CASE WHEN r.root IS NULL THEN NULL ELSE l.path IN (SELECT path FROM u_hit) END AS pruned
FROM local_files l LEFT JOIN rooted r ON r.path = l.path""")
def q_f9(spark, sf_dir):
    return X.prune_excluded(inv(spark, sf_dir).L.select("path"), "path", excl(spark, sf_dir), fx.ROOT_PATHS)


# --------------------------------------------------------------------------- joins

@register("j1_needs_upload", oracle="""
SELECT l.path, CASE WHEN a.path IS NULL THEN 'NEW' ELSE 'UPDATE' END AS op, a.drive_id
FROM local_files l LEFT JOIN archive a ON a.path = l.path
WHERE a.path IS NULL OR (NOT l.is_dir AND l.mtime > a.date_modified_on_disk)""")
def q_j1(spark, sf_dir):
    i = inv(spark, sf_dir)
    return needs_upload(i.L, i.A).select("path", "op", "drive_id")


@register("j4_removed_locally", oracle="""
SELECT path, drive_id FROM archive a WHERE NOT EXISTS (SELECT 1 FROM local_files l WHERE l.path = a.path)""")
def q_j4(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.removed_locally(i.A, i.L).select("path", "drive_id")


@register("j4_removed_locally_under", oracle=f"""
SELECT path, drive_id FROM archive a WHERE (path = '{WALK_LOCAL}' OR starts_with(path, '{WALK_LOCAL}/'))
AND NOT EXISTS (SELECT 1 FROM local_files l WHERE l.path = a.path)""")
def q_j4u(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.removed_locally(i.A, i.L, under=WALK_LOCAL).select("path", "drive_id")


@register("j5_removed_remotely", oracle="""
SELECT c.seq, a.drive_id, a.path FROM changes c JOIN archive a ON a.drive_id = c.file_id
WHERE c.removed OR coalesce(c.trashed, FALSE)""")
def q_j5(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.removed_remotely(i.C, i.A).select("seq", "drive_id", "path")


@register("j6_archive_gc", oracle=f"""
SELECT a.path, a.drive_id FROM archive a LEFT JOIN remote_files r ON r.file_id = a.drive_id
LEFT JOIN local_files l ON l.path = a.path
WHERE NOT coalesce(NOT r.trashed, FALSE) AND (l.path IS NULL OR {excluded_sql('a.path')})""")
def q_j6(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.archive_gc(i.A, i.R, i.L, excl(spark, sf_dir)).select("path", "drive_id")


@register("j7_excluded_archived", oracle=f"""
{excluded_up_sql('u', 'archive')}
SELECT path, drive_id FROM archive WHERE path IN (SELECT path FROM u_hit)""")
def q_j7(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.excluded_archived(i.A, excl(spark, sf_dir), fx.ROOT_PATHS).select("path", "drive_id")


GONE_SQL = "gone AS (SELECT path FROM archive a WHERE NOT EXISTS (SELECT 1 FROM local_files l WHERE l.path = a.path))"
REMOVED_SQL = """removed AS (SELECT DISTINCT a.path FROM changes c JOIN archive a ON a.drive_id = c.file_id
  WHERE c.removed OR coalesce(c.trashed, FALSE))"""


@register("j9_descendants", oracle=f"""
{GONE_SQL}
SELECT a.path, a.drive_id, g.path AS matched_path FROM archive a JOIN gone g
  ON a.path = g.path OR starts_with(a.path, g.path || '/')""")
def q_j9(spark, sf_dir):
    i = inv(spark, sf_dir)
    gone = D.removed_locally(i.A, i.L).select("path")
    return D.descendants_join(i.A, gone).select("path", "drive_id", "matched_path")


@register("j9_prefix", oracle=f"""
{GONE_SQL}
SELECT a.path, a.drive_id, g.path AS matched_path FROM archive a JOIN gone g ON starts_with(a.path, g.path)""")
def q_j9p(spark, sf_dir):
    i = inv(spark, sf_dir)
    gone = D.removed_locally(i.A, i.L).select("path")
    return D.descendants_join(i.A, gone, mode="prefix").select("path", "drive_id", "matched_path")


@register("j9_contains", oracle=f"""
{REMOVED_SQL}
SELECT a.path, a.drive_id, r.path AS matched_path FROM archive a JOIN removed r ON contains(a.path, r.path)""")
def q_j9c(spark, sf_dir):
    i = inv(spark, sf_dir)
    removed = D.removed_remotely(i.C, i.A).select("path")
    return D.descendants_join(i.A, removed, mode="contains").select("path", "drive_id", "matched_path")


@register("j11_resolve_parent", oracle="""
up AS (SELECT l.path FROM local_files l LEFT JOIN archive a ON a.path = l.path
  WHERE a.path IS NULL OR (NOT l.is_dir AND l.mtime > a.date_modified_on_disk))
SELECT up.path, coalesce(p.drive_id, 'root') AS parent_id FROM up
LEFT JOIN archive p ON p.path = CASE WHEN regexp_replace(up.path, '/[^/]*$', '') = '' THEN '/'
                                     ELSE regexp_replace(up.path, '/[^/]*$', '') END""")
def q_j11(spark, sf_dir):
    i = inv(spark, sf_dir)
    up = needs_upload(i.L, i.A).select("path")
    return D.resolve_parent(up, i.A, "path", fallback="root")


@register("j12_tracked_roots", oracle=f"""
t AS (SELECT a.drive_id, a.path AS base_path FROM sync_roots s JOIN archive a ON a.path = s.path)
SELECT drive_id, base_path FROM t WHERE drive_id <> 'root'
UNION ALL SELECT 'root', '{DEFAULT_DOWNLOAD}'""")
def q_j12(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.tracked_roots(i.roots, i.A, extra=(fx.TOP_ID, DEFAULT_DOWNLOAD))


# --------------------------------------------------------------------------- path hierarchy

@register("h1_path_ancestors", oracle=f"""
x AS (SELECT path, {ancestors_sql('path')} AS anc FROM local_files)
SELECT path, unnest(anc) AS ancestor, generate_subscripts(anc, 1) - 1 AS depth FROM x""")
def q_h1(spark, sf_dir):
    return H.path_ancestors(inv(spark, sf_dir).L.select("path")).select("path", "ancestor", "depth")


@register("h6_topmost", oracle=f"""
{GONE_SQL}
SELECT g.path FROM gone g WHERE NOT EXISTS (SELECT 1 FROM gone o WHERE starts_with(g.path, o.path || '/'))""")
def q_h6(spark, sf_dir):
    i = inv(spark, sf_dir)
    return H.topmost(D.removed_locally(i.A, i.L).select("path"))


@register("h7_tree_listing", oracle=f"""
SELECT '{WALK_LOCAL}' AS root, path, len(string_split(path, '/')) - 1 - 2 AS rel_depth,
  regexp_extract(path, '([^/]*)$', 1) AS name, is_dir,
  repeat('  ', len(string_split(path, '/')) - 1 - 2) || regexp_extract(path, '([^/]*)$', 1) AS line
FROM local_files WHERE is_dir AND (path = '{WALK_LOCAL}' OR starts_with(path, '{WALK_LOCAL}/'))""")
def q_h7(spark, sf_dir):
    out = H.tree_listing(inv(spark, sf_dir).L, WALK_LOCAL, files=False)
    return out.select("root", "path", "rel_depth", "name", "is_dir", "line")


@register("h8_subtree_rollup", oracle=f"""
x AS (SELECT path, size, {ancestors_sql('path')} AS anc FROM local_files WHERE NOT is_dir),
u AS (SELECT path, size, unnest(anc) AS folder FROM x)
SELECT folder, count(*) AS n_files, CAST(sum(coalesce(size, 0)) AS BIGINT) AS bytes FROM u WHERE folder <> path
GROUP BY folder""")
def q_h8(spark, sf_dir):
    return H.subtree_rollup(inv(spark, sf_dir).L)


# --------------------------------------------------------------------------- exclusion sets

@register("e1_merge_exclusions", oracle=f"""
{REMOVED_SQL}
SELECT 'path' AS kind, path AS value FROM excl_paths
UNION SELECT 'rule', unnest(['*.pyc', '*.tmp'])
UNION SELECT 'path', path FROM removed""")
def q_e1(spark, sf_dir):
    i = inv(spark, sf_dir)
    user = D.removed_remotely(i.C, i.A).select(F.lit("path").alias("kind"), F.col("path").alias("value"))
    return X.merge_exclusions(i.exclusions, user)


def _merged_ex(spark, sf_dir) -> X.Exclusions:
    i = inv(spark, sf_dir)
    user = D.removed_remotely(i.C, i.A).select(F.lit("path").alias("kind"), F.col("path").alias("value"))
    return X.Exclusions.from_df(X.merge_exclusions(i.exclusions, user))


MERGED_EXCL_SQL = f"""{REMOVED_SQL},
mx AS (SELECT path FROM excl_paths UNION SELECT path FROM removed)"""


@register("e2_minimal_exclusions", oracle=f"""
{MERGED_EXCL_SQL},
cand AS (SELECT path, CASE WHEN regexp_replace(path, '/[^/]*$', '') = '' THEN '/'
                      ELSE regexp_replace(path, '/[^/]*$', '') END AS parent
         FROM local_files WHERE path IN (SELECT path FROM mx)),
ua AS (SELECT c.path, unnest({ancestors_sql('c.parent')}) AS a, generate_subscripts({ancestors_sql('c.parent')}, 1) AS i FROM cand c),
st AS (SELECT path, max(i) AS si FROM ua WHERE a IN (SELECT path FROM sync_roots) GROUP BY path),
hit AS (SELECT DISTINCT u.path FROM ua u LEFT JOIN st ON st.path = u.path WHERE u.i > coalesce(st.si, 0)
  AND (u.a IN (SELECT path FROM mx) OR regexp_matches(regexp_extract(u.a, '([^/]*)$', 1), (SELECT rules_re FROM params))))
SELECT DISTINCT path FROM cand WHERE path NOT IN (SELECT path FROM hit)""")
def q_e2(spark, sf_dir):
    i = inv(spark, sf_dir)
    return X.minimal_exclusions(_merged_ex(spark, sf_dir), i.L, fx.ROOT_PATHS)


@register("e3_add_exclusions", oracle=f"""
{REMOVED_SQL},
cand AS (SELECT DISTINCT path FROM removed WHERE path IN (SELECT path FROM local_files)),
{excluded_up_sql('u', 'cand')[1:]},
added AS (SELECT path FROM cand WHERE path NOT IN (SELECT path FROM u_hit))
SELECT a.path FROM added a WHERE NOT EXISTS (SELECT 1 FROM added o WHERE starts_with(a.path, o.path || '/'))""")
def q_e3(spark, sf_dir):
    i = inv(spark, sf_dir)
    new = D.removed_remotely(i.C, i.A).select("path")
    return X.add_exclusions(excl(spark, sf_dir), new, i.L, fx.ROOT_PATHS)


@register("e4_diff_state", oracle="""
SELECT 'remote_only' AS side, r.file_id AS key FROM remote_files r
  WHERE NOT r.trashed AND r.file_id NOT IN (SELECT drive_id FROM archive)
UNION ALL SELECT 'local_only', l.path FROM local_files l WHERE l.path NOT IN (SELECT path FROM archive)
UNION ALL SELECT CASE WHEN coalesce(NOT r.trashed, FALSE) THEN CASE WHEN l.path IS NULL THEN 'archive_remote' ELSE 'both' END
    WHEN l.path IS NULL THEN 'archive_only' ELSE 'archive_local' END, a.drive_id
  FROM archive a LEFT JOIN remote_files r ON r.file_id = a.drive_id LEFT JOIN local_files l ON l.path = a.path""")
def q_e4(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.diff_state(i.R, i.A, i.L)


# --------------------------------------------------------------------------- remote tree

@register("h2_id_ancestors", oracle="""
RECURSIVE anc(file_id, ancestor_id, next_id, depth) AS (
  SELECT file_id, file_id, parent_id, 0 FROM remote_files
  UNION ALL SELECT a.file_id, r.file_id, r.parent_id, a.depth + 1 FROM anc a JOIN remote_files r ON r.file_id = a.next_id)
SELECT file_id, ancestor_id, depth FROM anc""")
def q_h2(spark, sf_dir):
    return H.id_ancestors_all(inv(spark, sf_dir).R)


@register("h2_id_ancestors_of_changes", oracle="""
RECURSIVE s AS (SELECT DISTINCT file_id FROM changes),
anc(file_id, ancestor_id, next_id, depth) AS (
  SELECT s.file_id, r.file_id, r.parent_id, 0 FROM s JOIN remote_files r ON r.file_id = s.file_id
  UNION ALL SELECT a.file_id, r.file_id, r.parent_id, a.depth + 1 FROM anc a JOIN remote_files r ON r.file_id = a.next_id)
SELECT file_id, ancestor_id, depth FROM anc""")
def q_h2c(spark, sf_dir):
    i = inv(spark, sf_dir)
    return H.id_ancestors(i.R, i.C.select("file_id"))


@register("h3_remote_path", oracle="""
RECURSIVE s AS (SELECT DISTINCT file_id AS start_id FROM changes),
w(start_id, cur, path, d) AS (
  SELECT start_id, start_id, '', 0 FROM s
  UNION ALL SELECT w.start_id, r.parent_id, '/' || r.name || w.path, w.d + 1
  FROM w JOIN remote_files r ON r.file_id = w.cur WHERE w.cur <> 'root')
SELECT start_id AS file_id,
  CASE WHEN start_id NOT IN (SELECT file_id FROM remote_files) THEN NULL
       WHEN max_by(path, d) = '' THEN '/' ELSE max_by(path, d) END AS remote_path
FROM w GROUP BY start_id""")
def q_h3(spark, sf_dir):
    i = inv(spark, sf_dir)
    return H.remote_path(i.R, i.C.select("file_id"), stop_id=fx.TOP_ID)


WALK_SQL = f"""w(file_id, name, mime_type, path, depth) AS (
  SELECT file_id, name, mime_type, name, 0 FROM remote_files WHERE file_id = '{WALK_FOLDER}'
  UNION ALL SELECT r.file_id, r.name, r.mime_type, w.path || '/' || r.name, w.depth + 1
  FROM w JOIN remote_files r ON r.parent_id = w.file_id WHERE NOT r.trashed AND w.mime_type = {FOLDER})"""


@register("h4_walk", oracle=f"""
RECURSIVE {WALK_SQL}
SELECT file_id, path, depth, CASE WHEN mime_type = {FOLDER} THEN '#folder' ELSE '#file' END AS type,
  depth = 0 AS is_root FROM w""")
def q_h4(spark, sf_dir):
    return H.walk(inv(spark, sf_dir).R, WALK_FOLDER).select("file_id", "path", "depth", "type", "is_root")


FLAGGED_SQL = """flagged AS (SELECT r.*, (a.drive_id IS NULL OR l.path IS NULL) AS flag FROM remote_files r
  LEFT JOIN archive a ON a.drive_id = r.file_id LEFT JOIN local_files l ON l.path = a.path)"""

PRUNED_WALK_SQL = f"""{FLAGGED_SQL},
pw(file_id, name, mime_type, flag, path, depth) AS (
  SELECT file_id, name, mime_type, flag, name, 0 FROM flagged WHERE file_id = '{WALK_FOLDER}'
  UNION ALL SELECT f.file_id, f.name, f.mime_type, f.flag, pw.path || '/' || f.name, pw.depth + 1
  FROM pw JOIN flagged f ON f.parent_id = pw.file_id
  WHERE NOT f.trashed AND pw.mime_type = {FOLDER} AND NOT pw.flag)"""


def flag_nodes(i: fx.Inventories):
    """Remote nodes flagged when unarchived, or archived but gone locally."""
    from .plans.mirror import flag_removed

    return flag_removed(i.R, i.A, i.L)


@register("h5_walk_pruned", oracle=f"""
RECURSIVE {PRUNED_WALK_SQL}
SELECT file_id, path, depth, flag FROM pw""")
def q_h5(spark, sf_dir):
    i = inv(spark, sf_dir)
    return H.walk_pruned(flag_nodes(i), WALK_FOLDER, "flag").select("file_id", "path", "depth", "flag")


@register("j3_unarchived_remote", oracle=f"""
RECURSIVE {WALK_SQL}
SELECT file_id, path FROM w WHERE file_id NOT IN (SELECT drive_id FROM archive)""")
def q_j3(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.unarchived_nodes(H.walk(i.R, WALK_FOLDER), i.A).select("file_id", "path")


def _j8_sql(pairs_sql: str) -> str:
    return f"""tagged AS (SELECT r.file_id, r.parent_id, r.name,
    CASE WHEN r.file_id IN ('{"','".join(IGNORED_IDS)}') THEN 'ignored'
         WHEN r.file_id IN {ROOT_IDS_SQL} OR a.drive_id IS NOT NULL THEN 'tracked' END AS tag
  FROM remote_files r LEFT JOIN archive a ON a.drive_id = r.file_id),
pairs AS ({pairs_sql}),
cl(start_id, node_id, parent_id, tag, d, mid) AS (
  SELECT p.parent_id, t.file_id, t.parent_id, t.tag, 0, CASE WHEN t.tag IS NULL THEN t.name ELSE '' END
  FROM (SELECT DISTINCT parent_id FROM pairs WHERE parent_id IS NOT NULL) p JOIN tagged t ON t.file_id = p.parent_id
  UNION ALL SELECT cl.start_id, t.file_id, t.parent_id, t.tag, cl.d + 1,
    CASE WHEN t.tag IS NULL THEN t.name || '/' || cl.mid ELSE cl.mid END
  FROM cl JOIN tagged t ON t.file_id = cl.parent_id WHERE cl.tag IS NULL),
hit AS (SELECT start_id, node_id, tag, mid FROM cl WHERE tag IS NOT NULL),
j8 AS (SELECT p.file_id, p.parent_id,
  CASE WHEN p.file_id IN {ROOT_IDS_SQL} OR p.file_id IN ('{"','".join(IGNORED_IDS)}') OR p.parent_id IS NULL THEN NULL
       WHEN h.tag = 'tracked' THEN h.node_id END AS tracked_id, h.mid
  FROM pairs p LEFT JOIN hit h ON h.start_id = p.parent_id)"""


@register("j8_nearest_tracked", oracle=f"""
RECURSIVE {_j8_sql("SELECT DISTINCT file_id, parent_id FROM changes")}
SELECT file_id, parent_id, tracked_id, CASE WHEN tracked_id IS NOT NULL THEN mid END AS mid_path FROM j8""")
def q_j8(spark, sf_dir):
    i = inv(spark, sf_dir)
    return H.nearest_tracked_ancestor(i.C, i.R, i.A, root_ids_of(i), IGNORED_IDS).select(
        "file_id", "parent_id", "tracked_id", "mid_path")


@register("j10_parent_archive", oracle="""
RECURSIVE t AS (SELECT r.file_id, r.parent_id, a.drive_id IS NOT NULL AS archived, a.path AS apath
  FROM remote_files r LEFT JOIN archive a ON a.drive_id = r.file_id),
s AS (SELECT DISTINCT file_id FROM changes),
cl(start_id, node_id, parent_id, archived, apath) AS (
  SELECT s.file_id, t.file_id, t.parent_id, t.archived, t.apath FROM s JOIN t ON t.file_id = s.file_id
  UNION ALL SELECT cl.start_id, t.file_id, t.parent_id, t.archived, t.apath FROM cl JOIN t ON t.file_id = cl.parent_id
  WHERE NOT cl.archived)
SELECT s.file_id, h.node_id AS archive_id, h.apath AS archive_path FROM s
LEFT JOIN (SELECT * FROM cl WHERE archived) h ON h.start_id = s.file_id""")
def q_j10(spark, sf_dir):
    i = inv(spark, sf_dir)
    return H.parent_archive(i.R, i.A, i.C.select("file_id").distinct())


@register("j14_is_ancestor", oracle=f"""
RECURSIVE s AS (SELECT DISTINCT file_id FROM changes),
anc(start_id, node_id, next_id) AS (
  SELECT s.file_id, r.file_id, r.parent_id FROM s JOIN remote_files r ON r.file_id = s.file_id
  UNION ALL SELECT a.start_id, r.file_id, r.parent_id FROM anc a JOIN remote_files r ON r.file_id = a.next_id)
SELECT '{WALK_FOLDER}' AS folder_id, s.file_id,
  EXISTS (SELECT 1 FROM anc WHERE anc.start_id = s.file_id AND anc.node_id = '{WALK_FOLDER}') AS is_ancestor
FROM s""")
def q_j14(spark, sf_dir):
    i = inv(spark, sf_dir)
    pairs = i.C.select(F.lit(WALK_FOLDER).alias("folder_id"), "file_id").distinct()
    return H.is_ancestor(i.R, pairs)


# --------------------------------------------------------------------------- aggregations

@register("a2_distinct_ids", oracle=f"""
{GONE_SQL}
SELECT DISTINCT a.drive_id FROM archive a JOIN gone g ON g.path = a.path""")
def q_a2(spark, sf_dir):
    i = inv(spark, sf_dir)
    return D.removed_locally(i.A, i.L).select("drive_id").distinct()


@register("a3_decision_counts", oracle=f"""
nodes AS (SELECT * FROM remote_files WHERE NOT trashed),
{reconcile_sql('nodes', False)}
SELECT decision, why, count(*) AS n FROM rc GROUP BY decision, why""")
def q_a3(spark, sf_dir):
    from .operators.aggregate import decision_counts
    i = inv(spark, sf_dir)
    return decision_counts(reconcile(i.R.filter(~F.col("trashed")), i.A, i.L, excl(spark, sf_dir)))


_ = collides  # used by the plan queries below


from . import queries_plans  # noqa: E402,F401  (registers the plan queries)
from . import queries_more  # noqa: E402,F401
