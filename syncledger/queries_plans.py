"""Registered queries for the composed plans, catalog updates, orderings,
reports and scalar helpers (continuation of :mod:`syncledger.queries`)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from .functions.mime import guess_mime
from .functions.paths import basename, normalize_path, parent_dir
from .functions.times import format_remote_time, parse_remote_time
from .operators import catalog as U
from .operators import diff as D
from .operators.aggregate import result_outcomes, transfer_summary
from .operators.ordering import free_name, parents_first, resolve_conflicts
from .oracles import excluded_up_sql
from .plans import download as PD
from .plans import maintenance as PM
from .plans import mirror as PMI
from .plans import upload as PU
from .queries import (DEFAULT_DOWNLOAD, FOLDER, IGNORED_IDS, LAST_SYNC, ROOT_IDS_SQL, WALK_FOLDER, WALK_LOCAL,
                      excl, inv, reconcile_sql, register)
from .sources.sinks import transfer_log

PARENT = "CASE WHEN regexp_replace({c}, '/[^/]*$', '') = '' THEN '/' ELSE regexp_replace({c}, '/[^/]*$', '') END"
DEPTH = "CAST(len(list_filter(string_split({c}, '/'), lambda x: x <> '')) AS BIGINT)"
FID_SQL = f"coalesce((SELECT drive_id FROM archive WHERE path = '{WALK_LOCAL}'), '?UNKNOWN?')"
RESTORE = "/restore"


def parent_sql(c: str) -> str:
    return PARENT.format(c=c)


def depth_sql(c: str) -> str:
    return DEPTH.format(c=c)


def p1_sql(pre: str, archive_cte: str, roots_cte: str, root_id_sql: str) -> str:
    """CTEs ending in ``{pre}_plan``: the P1 upload plan over ``archive_cte``."""
    return f"""{excluded_up_sql(pre + 'u', 'local_files', include_stop=True, stops=roots_cte).strip()},
{pre}_rooted AS (SELECT l.path, max_by(s.path, length(s.path)) AS root FROM local_files l JOIN {roots_cte} s
  ON l.path = s.path OR starts_with(l.path, s.path || '/') GROUP BY l.path),
{pre}_walked AS (SELECT l.*, r.root FROM local_files l JOIN {pre}_rooted r ON r.path = l.path
  WHERE l.path NOT IN (SELECT path FROM {pre}u_hit)),
{pre}_cand AS (SELECT w.path, w.is_dir, w.size, w.root, a.drive_id,
    CASE WHEN a.path IS NULL THEN 'NEW' ELSE 'UPDATE' END AS op
  FROM {pre}_walked w LEFT JOIN {archive_cte} a ON a.path = w.path
  WHERE a.path IS NULL OR (NOT w.is_dir AND w.mtime > a.date_modified_on_disk)),
{pre}_plan AS (SELECT c.root, c.op, CASE WHEN c.is_dir THEN '#folder' ELSE '#file' END AS type, c.path, c.drive_id,
    {parent_sql('c.path')} AS parent_path,
    CASE WHEN p.drive_id IS NOT NULL THEN p.drive_id WHEN c.path = c.root THEN {root_id_sql} END AS parent_id,
    CASE WHEN c.is_dir THEN 0 ELSE 1 END AS stage, {depth_sql('c.path')} AS depth, c.size
  FROM {pre}_cand c LEFT JOIN {archive_cte} p ON p.path = {parent_sql('c.path')})"""


def link_sql(name: str, archive_cte: str, fid: str, root: str) -> str:
    return f"""{name} AS (SELECT * FROM {archive_cte} WHERE drive_id <> {fid}
    OR NOT EXISTS (SELECT 1 FROM local_files WHERE path = '{root}')
  UNION ALL SELECT path, {fid}, mtime, '' FROM local_files WHERE path = '{root}')"""


PLAN_COLS = "root, op, type, path, drive_id, parent_path, parent_id, stage, depth, size"


def collides_sql(src: str, name: str = "cl") -> str:
    return f"""{name} AS (SELECT s.*, l.path IS NOT NULL AS exists_locally, coalesce(cnt.n, 1) > 1 AS dup_dest
  FROM {src} s LEFT JOIN local_files l ON l.path = s.dest_path
  LEFT JOIN (SELECT dest_path, count(*) AS n FROM {src} GROUP BY dest_path) cnt
    ON cnt.dest_path IS NOT DISTINCT FROM s.dest_path)"""


# --------------------------------------------------------------------------- upload plans

@register("p1_upload_plan", oracle=f"""
{p1_sql('m', 'archive', 'sync_roots', "'root'")}
SELECT {PLAN_COLS} FROM m_plan""")
def q_p1(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PU.upload_plan(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS, root_id=fx.TOP_ID)


@register("o1_parents_first", oracle=f"""
{p1_sql('m', 'archive', 'sync_roots', "'root'")}
SELECT path, type, stage, depth FROM m_plan""")
def q_o1(spark, sf_dir):
    i = inv(spark, sf_dir)
    plan = PU.upload_plan(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS).select("path", "type")
    return parents_first(plan).select("path", "type", "stage", "depth")


ONE_ROOT = f"one_root AS (SELECT '{WALK_LOCAL}' AS path)"


@register("p7_upload_sync_plan", oracle=f"""
{ONE_ROOT},
{link_sql('linked', 'archive', f"'{WALK_FOLDER}'", WALK_LOCAL)},
{p1_sql('m', 'linked', 'one_root', f"'{WALK_FOLDER}'")}
SELECT {PLAN_COLS} FROM m_plan""")
def q_p7(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PU.upload_sync_plan(i.L, i.A, excl(spark, sf_dir), WALK_FOLDER, WALK_LOCAL)


@register("p15_copy_up_plan", oracle=f"""
SELECT '{WALK_LOCAL}' AS root, 'NEW' AS op, CASE WHEN is_dir THEN '#folder' ELSE '#file' END AS type, path,
  CAST(NULL AS VARCHAR) AS drive_id, {parent_sql('path')} AS parent_path,
  CASE WHEN path = '{WALK_LOCAL}' THEN 'root' END AS parent_id, CASE WHEN is_dir THEN 0 ELSE 1 END AS stage,
  {depth_sql('path')} AS depth, size
FROM local_files WHERE path = '{WALK_LOCAL}' OR starts_with(path, '{WALK_LOCAL}/')""")
def q_p15(spark, sf_dir):
    return PU.copy_up_plan(inv(spark, sf_dir).L, WALK_LOCAL, "root")


# --------------------------------------------------------------------------- download plans

WALK_FULL_SQL = f"""w(file_id, name, mime_type, md5sum, modified_time, size, path, depth) AS (
  SELECT file_id, name, mime_type, md5sum, modified_time, size, name, 0 FROM remote_files WHERE file_id = '{WALK_FOLDER}'
  UNION ALL SELECT r.file_id, r.name, r.mime_type, r.md5sum, r.modified_time, r.size, w.path || '/' || r.name, w.depth + 1
  FROM w JOIN remote_files r ON r.parent_id = w.file_id WHERE NOT r.trashed AND w.mime_type = {FOLDER})"""

P2_SQL = f"""{WALK_FULL_SQL},
nodes AS (SELECT file_id, CASE WHEN mime_type = {FOLDER} THEN '' ELSE coalesce(md5sum, '') END AS md5sum,
  mime_type, modified_time, size, path FROM w),
{reconcile_sql('nodes', False).strip()},
pl AS (SELECT decision, why, type, file_id, path AS remote_path,
    CASE WHEN strip = '' THEN '{WALK_LOCAL}' ELSE '{WALK_LOCAL}/' || strip END AS dest_path, md5sum, size
  FROM (SELECT *, CASE WHEN contains(path, '/') THEN regexp_replace(path, '^[^/]*/', '') ELSE '' END AS strip FROM rc)
  WHERE decision <> 0),
{collides_sql('pl', 'p2')},
p2_plan AS (SELECT *, (decision = -1 OR exists_locally) AS conflict FROM p2)"""

P2_COLS = "decision, why, type, file_id, remote_path, dest_path, md5sum, size, exists_locally, dup_dest, conflict"


@register("p2_download_folder_plan", oracle=f"""
RECURSIVE {P2_SQL}
SELECT {P2_COLS} FROM p2_plan""")
def q_p2(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PD.download_folder_plan(i.R, i.A, i.L, excl(spark, sf_dir), WALK_FOLDER, WALK_LOCAL).select(
        *[c.strip() for c in P2_COLS.split(",")])


def p3_sql(ignored=IGNORED_IDS) -> str:
    ign = "'" + "','".join(ignored) + "'"
    return f"""tagged AS (SELECT r.file_id, r.parent_id, r.name,
    CASE WHEN r.file_id IN ({ign}) THEN 'ignored'
         WHEN r.file_id IN {ROOT_IDS_SQL} OR a.drive_id IS NOT NULL THEN 'tracked' END AS tag
  FROM remote_files r LEFT JOIN archive a ON a.drive_id = r.file_id),
ev AS (SELECT * FROM changes WHERE NOT removed AND NOT coalesce(trashed, FALSE)
  AND date_trunc('second', modified_time) >= TIMESTAMP '{LAST_SYNC}'),
pairs AS (SELECT DISTINCT file_id, parent_id FROM ev),
cl(start_id, node_id, parent_id, tag, names) AS (
  SELECT p.parent_id, t.file_id, t.parent_id, t.tag, [t.name]
  FROM (SELECT DISTINCT parent_id FROM pairs WHERE parent_id IS NOT NULL) p JOIN tagged t ON t.file_id = p.parent_id
  UNION ALL SELECT cl.start_id, t.file_id, t.parent_id, t.tag, list_append(cl.names, t.name)
  FROM cl JOIN tagged t ON t.file_id = cl.parent_id WHERE cl.tag IS NULL),
hit AS (SELECT start_id, node_id, tag, array_to_string(list_reverse(names[1:len(names) - 1]), '/') AS mid
  FROM cl WHERE tag IS NOT NULL),
j8 AS (SELECT p.file_id, p.parent_id,
    CASE WHEN p.file_id IN {ROOT_IDS_SQL} OR p.file_id IN ({ign}) OR p.parent_id IS NULL THEN NULL
         WHEN h.tag = 'tracked' THEN h.node_id END AS tracked_id, h.mid
  FROM pairs p LEFT JOIN hit h ON h.start_id = p.parent_id),
nodes AS (SELECT ev.*, j8.tracked_id, j8.mid FROM ev JOIN j8 ON j8.file_id = ev.file_id AND j8.parent_id = ev.parent_id
  WHERE j8.tracked_id IS NOT NULL),
{reconcile_sql('nodes', True).strip()},
pl AS (SELECT rc.seq, rc.file_id, rc.type, rc.decision, rc.why, rc.tracked_id AS root_parent_id,
    CASE WHEN rc.mid = '' THEN ta.path || '/' || rc.name ELSE ta.path || '/' || rc.mid || '/' || rc.name END AS dest_path,
    coalesce(rc.md5sum, '') AS md5sum
  FROM rc LEFT JOIN archive ta ON ta.drive_id = rc.tracked_id WHERE rc.decision <> 0),
{collides_sql('pl', 'p3')},
p3_plan AS (SELECT *, (decision = -1 OR exists_locally) AS conflict FROM p3)"""


P3_COLS = "seq, file_id, type, decision, why, root_parent_id, dest_path, md5sum, exists_locally, dup_dest, conflict"


def p3_spark(spark, sf_dir, changes=None):
    i = inv(spark, sf_dir)
    return PD.download_changes_plan(i.C if changes is None else changes, i.R, i.A, i.L, excl(spark, sf_dir),
                                    i.roots, LAST_SYNC, ignored_ids=IGNORED_IDS)


@register("p3_download_changes_plan", oracle=f"""
RECURSIVE {p3_sql()}
SELECT {P3_COLS} FROM p3_plan""")
def q_p3(spark, sf_dir):
    return p3_spark(spark, sf_dir).select(*[c.strip() for c in P3_COLS.split(",")])


@register("p14_copy_down_plan", oracle=f"""
RECURSIVE {WALK_FULL_SQL}
SELECT 'DOWNLOAD' AS op, CASE WHEN mime_type = {FOLDER} THEN '#folder' ELSE '#file' END AS type, file_id,
  path AS remote_path, '{RESTORE}/' || path AS dest_path,
  CASE WHEN mime_type <> {FOLDER} THEN md5sum END AS md5sum, CASE WHEN mime_type <> {FOLDER} THEN size ELSE 0 END AS size
FROM w""")
def q_p14(spark, sf_dir):
    return PD.copy_down_plan(inv(spark, sf_dir).R, WALK_FOLDER, RESTORE)


@register("p8_folder_sync_plan", oracle=f"""
RECURSIVE {ONE_ROOT},
{link_sql('linked', 'archive', f"'{WALK_FOLDER}'", WALK_LOCAL)},
{p1_sql('m', 'linked', 'one_root', f"'{WALK_FOLDER}'")},
{P2_SQL}
SELECT 'up' AS direction, type, path AS local_path, drive_id AS file_id,
  CASE WHEN op = 'NEW' THEN 'upload_new' ELSE 'upload_update' END AS action FROM m_plan
UNION ALL SELECT 'down', type, dest_path, file_id, CASE WHEN conflict THEN 'conflict' ELSE 'download' END FROM p2_plan""")
def q_p8(spark, sf_dir):
    i = inv(spark, sf_dir)
    ex = excl(spark, sf_dir)
    up = PU.upload_sync_plan(i.L, i.A, ex, WALK_FOLDER, WALK_LOCAL)
    down = PD.download_folder_plan(i.R, i.A, i.L, ex, WALK_FOLDER, WALK_LOCAL)
    return PD.folder_sync_plan(up, down)


# --------------------------------------------------------------------------- mirror plans

MIRROR_OUT = "root, action, op, type, path, drive_id, parent_id"


def _mirror_rows(src: str, root_sql: str, action: str) -> str:
    return (f"SELECT {root_sql} AS root, '{action}' AS action, CAST(NULL AS VARCHAR) AS op, "
            f"CASE WHEN md5sum = '' THEN '#folder' ELSE '#file' END AS type, path, drive_id, "
            f"CAST(NULL AS VARCHAR) AS parent_id FROM {src}")


@register("p4_mirror_fast_plan", oracle=f"""
gone AS (SELECT * FROM archive a WHERE (a.path = '{WALK_LOCAL}' OR starts_with(a.path, '{WALK_LOCAL}/'))
  AND a.path NOT IN (SELECT path FROM local_files)),
tops AS (SELECT g.* FROM gone g WHERE NOT EXISTS (SELECT 1 FROM gone o WHERE starts_with(g.path, o.path || '/'))),
fgt AS (SELECT DISTINCT a.* FROM archive a JOIN tops t ON a.path = t.path OR starts_with(a.path, t.path || '/')),
remaining AS (SELECT * FROM archive WHERE drive_id NOT IN (SELECT drive_id FROM fgt)),
{ONE_ROOT},
{link_sql('linked', 'remaining', FID_SQL, WALK_LOCAL)},
{p1_sql('m', 'linked', 'one_root', FID_SQL)},
mo AS ({_mirror_rows('tops', f"'{WALK_LOCAL}'", 'delete')}
  UNION ALL {_mirror_rows('fgt', f"'{WALK_LOCAL}'", 'forget')}
  UNION ALL SELECT root, 'upload', op, type, path, drive_id, parent_id FROM m_plan)
SELECT *, (path = root OR coalesce(drive_id = {FID_SQL}, FALSE)) AS is_root FROM mo""")
def q_p4(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PMI.mirror_fast_plan(i.L, i.A, excl(spark, sf_dir), WALK_LOCAL)


@register("p5_mirror_full_plan", oracle=f"""
RECURSIVE flagged AS (SELECT r.*, a.drive_id IS NOT NULL AS archived, a.path AS archive_path,
    (a.drive_id IS NULL OR l.path IS NULL) AS flag
  FROM remote_files r LEFT JOIN archive a ON a.drive_id = r.file_id LEFT JOIN local_files l ON l.path = a.path),
pw(file_id, mime_type, flag, archived, archive_path, path) AS (
  SELECT file_id, mime_type, flag, archived, archive_path, name FROM flagged WHERE file_id = '{WALK_FOLDER}'
  UNION ALL SELECT f.file_id, f.mime_type, f.flag, f.archived, f.archive_path, pw.path || '/' || f.name
  FROM pw JOIN flagged f ON f.parent_id = pw.file_id WHERE NOT f.trashed AND pw.mime_type = {FOLDER} AND NOT pw.flag),
removed AS (SELECT * FROM pw WHERE flag),
dels AS (SELECT coalesce(archive_path, path) AS path, file_id AS drive_id,
  CASE WHEN mime_type = {FOLDER} THEN '' ELSE 'x' END AS md5sum FROM removed),
fgt AS (SELECT DISTINCT a.* FROM archive a JOIN (SELECT archive_path AS p FROM removed WHERE archived) t
  ON a.path = t.p OR starts_with(a.path, t.p || '/')),
remaining AS (SELECT * FROM archive WHERE drive_id NOT IN (SELECT drive_id FROM fgt)),
{ONE_ROOT},
{link_sql('linked', 'remaining', f"'{WALK_FOLDER}'", WALK_LOCAL)},
{p1_sql('m', 'linked', 'one_root', f"'{WALK_FOLDER}'")},
mo AS ({_mirror_rows('dels', f"'{WALK_LOCAL}'", 'delete')}
  UNION ALL {_mirror_rows('fgt', f"'{WALK_LOCAL}'", 'forget')}
  UNION ALL SELECT root, 'upload', op, type, path, drive_id, parent_id FROM m_plan)
SELECT *, (path = root OR coalesce(drive_id = '{WALK_FOLDER}', FALSE)) AS is_root FROM mo""")
def q_p5(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PMI.mirror_full_plan(i.R, i.L, i.A, excl(spark, sf_dir), WALK_FOLDER, WALK_LOCAL)


@register("p6_mirror_all", oracle=f"""
gone AS (SELECT * FROM archive WHERE path NOT IN (SELECT path FROM local_files)),
rooted AS (SELECT s.path AS root, g.* FROM gone g JOIN sync_roots s ON g.path = s.path OR starts_with(g.path, s.path || '/')),
tops AS (SELECT r.* FROM rooted r WHERE NOT EXISTS (SELECT 1 FROM rooted o WHERE o.root = r.root
  AND starts_with(r.path, o.path || '/'))),
fgt AS (SELECT DISTINCT t.root, a.* FROM archive a JOIN tops t ON a.path = t.path OR starts_with(a.path, t.path || '/')),
remaining AS (SELECT * FROM archive WHERE drive_id NOT IN (SELECT drive_id FROM fgt)),
{p1_sql('m', 'remaining', 'sync_roots', "coalesce((SELECT x.drive_id FROM archive x WHERE x.path = c.root), 'root')")},
mo AS ({_mirror_rows('tops', 'root', 'delete')}
  UNION ALL {_mirror_rows('fgt', 'root', 'forget')}
  UNION ALL SELECT root, 'upload', op, type, path, drive_id, parent_id FROM m_plan)
SELECT mo.*, (mo.path = mo.root OR coalesce(mo.drive_id = (SELECT x.drive_id FROM archive x WHERE x.path = mo.root),
  FALSE)) AS is_root FROM mo""")
def q_p6(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PMI.mirror_all(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS, fast=True)


@register("p6_mirror_all_full", oracle=f"""
RECURSIVE flagged AS (SELECT r.*, a.drive_id IS NOT NULL AS archived, a.path AS archive_path,
    (a.drive_id IS NULL OR l.path IS NULL) AS flag
  FROM remote_files r LEFT JOIN archive a ON a.drive_id = r.file_id LEFT JOIN local_files l ON l.path = a.path),
seeds AS (SELECT a.drive_id, a.path AS root FROM archive a JOIN sync_roots s ON s.path = a.path),
pw(root, file_id, mime_type, flag, archived, archive_path, path) AS (
  SELECT s.root, f.file_id, f.mime_type, f.flag, f.archived, f.archive_path, f.name FROM flagged f
  JOIN seeds s ON s.drive_id = f.file_id
  UNION ALL SELECT pw.root, f.file_id, f.mime_type, f.flag, f.archived, f.archive_path, pw.path || '/' || f.name
  FROM pw JOIN flagged f ON f.parent_id = pw.file_id WHERE NOT f.trashed AND pw.mime_type = {FOLDER} AND NOT pw.flag),
removed AS (SELECT * FROM pw WHERE flag),
dels AS (SELECT root, coalesce(archive_path, path) AS path, file_id AS drive_id,
  CASE WHEN mime_type = {FOLDER} THEN '' ELSE 'x' END AS md5sum FROM removed),
fgt AS (SELECT DISTINCT t.root, a.* FROM archive a JOIN (SELECT root, archive_path AS p FROM removed WHERE archived) t
  ON a.path = t.p OR starts_with(a.path, t.p || '/')),
remaining AS (SELECT * FROM archive WHERE drive_id NOT IN (SELECT drive_id FROM fgt)),
{p1_sql('m', 'remaining', 'sync_roots', "coalesce((SELECT x.drive_id FROM archive x WHERE x.path = c.root), 'root')")},
mo AS ({_mirror_rows('dels', 'root', 'delete')}
  UNION ALL {_mirror_rows('fgt', 'root', 'forget')}
  UNION ALL SELECT root, 'upload', op, type, path, drive_id, parent_id FROM m_plan)
SELECT mo.*, (mo.path = mo.root OR coalesce(mo.drive_id = (SELECT x.drive_id FROM archive x WHERE x.path = mo.root),
  FALSE)) AS is_root FROM mo""")
def q_p6_full(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PMI.mirror_all(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS, fast=False, remote=i.R)


# --------------------------------------------------------------------------- maintenance plans

REMOVED_PATHS = """removed AS (SELECT DISTINCT a.path FROM changes c JOIN archive a ON a.drive_id = c.file_id
  WHERE c.removed OR coalesce(c.trashed, FALSE))"""


@register("p9_forget_removed", oracle=f"""
{REMOVED_PATHS}
SELECT * FROM archive a WHERE NOT EXISTS (SELECT 1 FROM removed r WHERE a.path = r.path
  OR starts_with(a.path, r.path || '/'))""")
def q_p9(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PM.forget_removed(i.C, i.A)


@register("p9_forget_removed_contains", oracle=f"""
{REMOVED_PATHS}
SELECT * FROM archive a WHERE NOT EXISTS (SELECT 1 FROM removed r WHERE contains(a.path, r.path))""")
def q_p9c(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PM.forget_removed(i.C, i.A, mode="contains")


@register("p10_exclude_removed", oracle=f"""
{REMOVED_PATHS},
cand AS (SELECT DISTINCT path FROM removed WHERE path IN (SELECT path FROM local_files)),
{excluded_up_sql('u', 'cand').strip()},
added0 AS (SELECT path FROM cand WHERE path NOT IN (SELECT path FROM u_hit)),
added AS (SELECT a.path FROM added0 a WHERE NOT EXISTS (SELECT 1 FROM added0 o WHERE starts_with(a.path, o.path || '/'))),
mx AS (SELECT path FROM excl_paths UNION SELECT path FROM added),
ecand AS (SELECT path, {parent_sql('path')} AS parent FROM local_files WHERE path IN (SELECT path FROM mx)),
ua AS (SELECT c.path, unnest(anc) AS a, generate_subscripts(anc, 1) AS i FROM (SELECT path,
  list_concat(['/'], list_transform(range(1, len(list_filter(string_split(parent, '/'), lambda x: x <> '')) + 1),
  lambda i: '/' || array_to_string(list_filter(string_split(parent, '/'), lambda x: x <> '')[1:i], '/'))) AS anc
  FROM ecand) c),
st AS (SELECT path, max(i) AS si FROM ua WHERE a IN (SELECT path FROM sync_roots) GROUP BY path),
hit AS (SELECT DISTINCT u.path FROM ua u LEFT JOIN st ON st.path = u.path WHERE u.i > coalesce(st.si, 0)
  AND (u.a IN (SELECT path FROM mx) OR regexp_matches(regexp_extract(u.a, '([^/]*)$', 1), (SELECT rules_re FROM params))))
SELECT DISTINCT path FROM ecand WHERE path NOT IN (SELECT path FROM hit)""")
def q_p10(spark, sf_dir):
    i = inv(spark, sf_dir)
    _archive, paths = PM.exclude_removed(i.C, i.A, i.L, excl(spark, sf_dir), fx.ROOT_PATHS)
    return paths


@register("p10_exclude_removed_archive", oracle=f"""
{REMOVED_PATHS}
SELECT * FROM archive a WHERE NOT EXISTS (SELECT 1 FROM removed r WHERE a.path = r.path
  OR starts_with(a.path, r.path || '/'))""")
def q_p10_archive(spark, sf_dir):
    """The other half of P10: the archive that is left."""
    i = inv(spark, sf_dir)
    left, _paths = PM.exclude_removed(i.C, i.A, i.L, excl(spark, sf_dir), fx.ROOT_PATHS)
    return left


@register("p11_purge_unarchived", oracle=f"""
RECURSIVE w(file_id, name, mime_type, path) AS (
  SELECT file_id, name, mime_type, name FROM remote_files WHERE file_id = '{WALK_FOLDER}'
  UNION ALL SELECT r.file_id, r.name, r.mime_type, w.path || '/' || r.name
  FROM w JOIN remote_files r ON r.parent_id = w.file_id WHERE NOT r.trashed AND w.mime_type = {FOLDER}),
un AS (SELECT file_id, path FROM w WHERE file_id NOT IN (SELECT drive_id FROM archive))
SELECT file_id, path, (row_number() OVER (ORDER BY file_id) - 1) // 32 AS batch FROM un""")
def q_p11(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PM.purge_unarchived(i.R, i.A, WALK_FOLDER)


GONE_BATCH_SQL = """gone AS (SELECT drive_id, path FROM archive a WHERE a.path NOT IN (SELECT path FROM local_files)),
p12 AS (SELECT drive_id, path, (row_number() OVER (ORDER BY drive_id) - 1) // 32 AS batch FROM gone)"""


@register("p12_purge_removed_local", oracle=f"""
{GONE_BATCH_SQL}
SELECT drive_id, path, batch FROM p12""")
def q_p12(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PM.purge_removed_local(i.A, i.L)


@register("p13_purge_excluded", oracle=f"""
{excluded_up_sql('u', 'archive').strip()}
SELECT drive_id, path FROM archive WHERE path IN (SELECT path FROM u_hit)""")
def q_p13(spark, sf_dir):
    i = inv(spark, sf_dir)
    return PM.purge_excluded(i.A, excl(spark, sf_dir), fx.ROOT_PATHS)


STATUS_SQL = "CASE length(drive_id) % 4 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 ELSE 500 END"


def _results(plan):
    n = F.length("drive_id") % 4
    status = F.when(n == 0, 200).when(n == 1, 404).when(n == 2, 403).otherwise(500)
    return plan.select("drive_id", status.alias("status"))


@register("a4_result_outcomes", oracle=f"""
{GONE_BATCH_SQL},
res AS (SELECT drive_id, {STATUS_SQL} AS status FROM p12)
SELECT drive_id, status, CASE WHEN status IS NULL OR (status >= 200 AND status < 300) OR status = 404 THEN 'deleted'
  WHEN status = 403 THEN 'retry' ELSE 'failed' END AS outcome,
  (status IS NULL OR (status >= 200 AND status < 300) OR status = 404) AS forget FROM res""")
def q_a4(spark, sf_dir):
    i = inv(spark, sf_dir)
    return result_outcomes(_results(PM.purge_removed_local(i.A, i.L)))


@register("p12_apply_delete_results", oracle=f"""
{GONE_BATCH_SQL},
res AS (SELECT drive_id, {STATUS_SQL} AS status FROM p12)
SELECT * FROM archive WHERE drive_id NOT IN (SELECT drive_id FROM res WHERE status = 404
  OR (status >= 200 AND status < 300))""")
def q_p12_apply(spark, sf_dir):
    i = inv(spark, sf_dir)
    new_archive, _retry = PM.apply_delete_results(i.A, _results(PM.purge_removed_local(i.A, i.L)))
    return new_archive


@register("p12_retry_deletes", oracle=f"""
{GONE_BATCH_SQL},
res AS (SELECT drive_id, {STATUS_SQL} AS status FROM p12)
SELECT drive_id, status FROM res WHERE status = 403""")
def q_p12_retry(spark, sf_dir):
    """The other half of P12's results: what the next attempt has to delete."""
    i = inv(spark, sf_dir)
    _archive, retry = PM.apply_delete_results(i.A, _results(PM.purge_removed_local(i.A, i.L)))
    return retry.select("drive_id", "status")


# --------------------------------------------------------------------------- catalog updates

UPLOAD_RESULTS_SQL = f"""{p1_sql('m', 'archive', 'sync_roots', "'root'")},
res AS (SELECT p.path, coalesce(p.drive_id, 'u-' || md5(p.path)) AS drive_id, l.mtime,
  CASE WHEN l.is_dir THEN '' ELSE l.md5sum END AS md5sum FROM m_plan p JOIN local_files l ON l.path = p.path)"""


def _upload_results(spark, sf_dir):
    i = inv(spark, sf_dir)
    plan = PU.upload_plan(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS)
    loc = i.L.select("path", "mtime", F.when(F.col("is_dir"), F.lit("")).otherwise(F.col("md5sum")).alias("md5sum"))
    return plan.select("path", F.coalesce(F.col("drive_id"), F.concat(F.lit("u-"), F.md5(F.col("path"))))
                       .alias("drive_id")).join(loc, "path")


@register("u5_record_uploads", oracle=f"""
{UPLOAD_RESULTS_SQL}
SELECT coalesce(u.path, a.path) AS path, coalesce(u.drive_id, a.drive_id) AS drive_id,
  CASE WHEN u.drive_id IS NOT NULL THEN u.mtime ELSE a.date_modified_on_disk END AS date_modified_on_disk,
  CASE WHEN u.drive_id IS NOT NULL THEN u.md5sum ELSE a.md5sum END AS md5sum
FROM archive a FULL OUTER JOIN res u ON u.drive_id = a.drive_id""")
def q_u5(spark, sf_dir):
    i = inv(spark, sf_dir)
    return U.record_uploads(i.A, _upload_results(spark, sf_dir))


@register("u2_insert_archive", oracle=f"""
{UPLOAD_RESULTS_SQL}
SELECT * FROM archive UNION ALL
SELECT path, drive_id, mtime, md5sum FROM res WHERE drive_id NOT IN (SELECT drive_id FROM archive)
  AND path NOT IN (SELECT path FROM archive)""")
def q_u2(spark, sf_dir):
    i = inv(spark, sf_dir)
    res = _upload_results(spark, sf_dir)
    new = res.join(i.A.select("drive_id"), "drive_id", "left_anti").join(i.A.select("path"), "path", "left_anti")
    return U.insert_archive(i.A, new.select("path", "drive_id", F.col("mtime").alias("date_modified_on_disk"),
                                            "md5sum"))


@register("u7_check_unique", oracle=f"""
{UPLOAD_RESULTS_SQL},
al AS (SELECT path, drive_id FROM archive UNION ALL SELECT path, drive_id FROM res)
SELECT 'path' AS "column", path AS key, count(*) AS n FROM al GROUP BY path HAVING count(*) > 1
UNION ALL SELECT 'drive_id', drive_id, count(*) FROM al GROUP BY drive_id HAVING count(*) > 1""")
def q_u7(spark, sf_dir):
    i = inv(spark, sf_dir)
    res = _upload_results(spark, sf_dir)
    return U.check_unique(i.A.select("path", "drive_id").unionByName(res.select("path", "drive_id")))


@register("u1_upsert_archive", oracle=f"""
RECURSIVE {p3_sql()},
upd AS (SELECT dest_path AS path, file_id AS drive_id, seq FROM p3_plan WHERE NOT conflict),
evu AS (SELECT u.*, c.modified_time, coalesce(c.md5sum, '') AS md5sum FROM upd u JOIN changes c ON c.seq = u.seq),
latest AS (SELECT * FROM evu QUALIFY row_number() OVER (PARTITION BY drive_id ORDER BY seq DESC) = 1)
SELECT coalesce(u.path, a.path) AS path, coalesce(u.drive_id, a.drive_id) AS drive_id,
  CASE WHEN u.drive_id IS NOT NULL THEN u.modified_time ELSE a.date_modified_on_disk END AS date_modified_on_disk,
  CASE WHEN u.drive_id IS NOT NULL THEN u.md5sum ELSE a.md5sum END AS md5sum
FROM archive a FULL OUTER JOIN latest u ON u.drive_id = a.drive_id""")
def q_u1(spark, sf_dir):
    i = inv(spark, sf_dir)
    plan = p3_spark(spark, sf_dir).filter(~F.col("conflict"))
    ev = plan.select("seq", F.col("dest_path").alias("path"), F.col("file_id").alias("drive_id")).join(
        i.C.select("seq", F.col("modified_time").alias("date_modified_on_disk"),
                   F.coalesce(F.col("md5sum"), F.lit("")).alias("md5sum")), "seq")
    return U.upsert_archive(i.A, ev, "seq")


@register("u6_record_downloads", oracle=f"""
RECURSIVE {P2_SQL},
res AS (SELECT p.dest_path AS path, p.file_id AS drive_id, r.modified_time AS mtime, p.md5sum
  FROM p2_plan p JOIN remote_files r ON r.file_id = p.file_id WHERE NOT p.conflict)
SELECT coalesce(u.path, a.path) AS path, coalesce(u.drive_id, a.drive_id) AS drive_id,
  CASE WHEN u.drive_id IS NOT NULL THEN u.mtime ELSE a.date_modified_on_disk END AS date_modified_on_disk,
  CASE WHEN u.drive_id IS NOT NULL THEN u.md5sum ELSE a.md5sum END AS md5sum
FROM archive a FULL OUTER JOIN res u ON u.drive_id = a.drive_id""")
def q_u6(spark, sf_dir):
    i = inv(spark, sf_dir)
    plan = PD.download_folder_plan(i.R, i.A, i.L, excl(spark, sf_dir), WALK_FOLDER, WALK_LOCAL)
    res = plan.filter(~F.col("conflict")).select(F.col("dest_path").alias("path"), F.col("file_id").alias("drive_id"),
                                                  "md5sum") \
        .join(i.R.select(F.col("file_id").alias("drive_id"), F.col("modified_time").alias("mtime")), "drive_id")
    return U.record_downloads(i.A, res)


@register("u3_delete_archive", oracle="""
SELECT * FROM archive WHERE drive_id NOT IN (SELECT drive_id FROM archive a
  WHERE a.path NOT IN (SELECT path FROM local_files))""")
def q_u3(spark, sf_dir):
    i = inv(spark, sf_dir)
    return U.delete_archive(i.A, D.removed_locally(i.A, i.L), "drive_id")


RENAME_OLD, RENAME_NEW = "/data/ASIA/NATION_2", "/moved/NATION_2"


@register("u4_rename_paths", oracle=f"""
SELECT CASE WHEN path = '{RENAME_OLD}' OR starts_with(path, '{RENAME_OLD}/')
  THEN '{RENAME_NEW}' || substring(path, {len(RENAME_OLD) + 1}) ELSE path END AS path,
  drive_id, date_modified_on_disk, md5sum FROM archive""")
def q_u4(spark, sf_dir):
    return U.rename_paths(inv(spark, sf_dir).A, RENAME_OLD, RENAME_NEW)


@register("u4_rename_paths_prefix", oracle=f"""
SELECT CASE WHEN starts_with(path, '{RENAME_OLD}')
  THEN '{RENAME_NEW}' || substring(path, {len(RENAME_OLD) + 1}) ELSE path END AS path,
  drive_id, date_modified_on_disk, md5sum FROM archive""")
def q_u4p(spark, sf_dir):
    return U.rename_paths(inv(spark, sf_dir).A, RENAME_OLD, RENAME_NEW, mode="prefix")


# --------------------------------------------------------------------------- conflicts and names

ANSWER_SQL = "CASE seq % 11 WHEN 0 THEN 'o' WHEN 1 THEN 'n' WHEN 10 THEN 'c' ELSE 'y' END"


def _answers(i):
    s = F.col("seq") % 11
    ans = F.when(s == 0, "o").when(s == 1, "n").when(s == 10, "c").otherwise("y")
    return i.C.select("seq", ans.alias("answer"))


@register("w1_resolve_conflicts", oracle=f"""
RECURSIVE {p3_sql()},
cf AS (SELECT seq, file_id, dest_path FROM p3_plan WHERE conflict),
j AS (SELECT cf.*, a.answer AS ans FROM cf LEFT JOIN (SELECT seq, {ANSWER_SQL} AS answer FROM changes) a
  ON a.seq = cf.seq),
st AS (SELECT min(seq) AS s_from, arg_min(ans, seq) AS s_ans FROM j WHERE ans IN ('a', 'r', 'c')),
eff AS (SELECT j.seq, j.file_id, j.dest_path,
  CASE WHEN st.s_from IS NOT NULL AND j.seq >= st.s_from
         THEN CASE st.s_ans WHEN 'a' THEN 'y' WHEN 'r' THEN 'n' ELSE 'o' END
       WHEN j.ans IN ('y', 'n', 'o') THEN j.ans ELSE 'n' END AS answer FROM j, st)
SELECT seq, file_id, dest_path, answer,
  CASE answer WHEN 'y' THEN 'accept' WHEN 'n' THEN 'reject' ELSE 'accept_renamed' END AS resolution FROM eff""")
def q_w1(spark, sf_dir):
    i = inv(spark, sf_dir)
    cf = p3_spark(spark, sf_dir).filter(F.col("conflict")).select("seq", "file_id", "dest_path")
    return resolve_conflicts(cf, _answers(i)).select("seq", "file_id", "dest_path", "answer", "resolution")


NAME_RE = r"^(.*?)( \((\d+)\))?(\.[^./]*)?$"


@register("t8_free_name", oracle=f"""
RECURSIVE {p3_sql()},
cf AS (SELECT seq, dest_path, {parent_sql('dest_path')} AS d,
  regexp_extract(regexp_extract(dest_path, '([^/]*)$', 1), '{NAME_RE}', 1) AS stem,
  regexp_extract(regexp_extract(dest_path, '([^/]*)$', 1), '{NAME_RE}', 4) AS ext FROM p3_plan WHERE conflict),
lp AS (SELECT {parent_sql('path')} AS d, regexp_extract(regexp_extract(path, '([^/]*)$', 1), '{NAME_RE}', 1) AS stem,
  regexp_extract(regexp_extract(path, '([^/]*)$', 1), '{NAME_RE}', 3) AS num,
  regexp_extract(regexp_extract(path, '([^/]*)$', 1), '{NAME_RE}', 4) AS ext FROM local_files),
used AS (SELECT d, stem, ext, max(CASE WHEN num <> '' THEN CAST(num AS BIGINT) ELSE 0 END) AS mx FROM lp
  GROUP BY d, stem, ext)
SELECT seq, dest_path, CASE WHEN cf.d = '/' THEN '/' ELSE cf.d || '/' END || cf.stem || ' ('
  || CAST(coalesce(used.mx, 0) + row_number() OVER (PARTITION BY dest_path ORDER BY seq) AS VARCHAR) || ')' || cf.ext
  AS free_path
FROM cf LEFT JOIN used ON used.d = cf.d AND used.stem = cf.stem AND used.ext = cf.ext""")
def q_t8(spark, sf_dir):
    i = inv(spark, sf_dir)
    cf = p3_spark(spark, sf_dir).filter(F.col("conflict")).select("seq", "dest_path")
    return free_name(cf, i.L, "dest_path", "seq").select("seq", "dest_path", "free_path")


# --------------------------------------------------------------------------- reports

@register("a1_transfer_summary", oracle=f"""
RECURSIVE {p1_sql('m', 'archive', 'sync_roots', "'root'")},
{GONE_BATCH_SQL},
{P2_SQL},
lg AS (SELECT op, size FROM m_plan UNION ALL SELECT 'DELETE', NULL FROM p12
  UNION ALL SELECT 'DOWNLOAD', size FROM p2_plan WHERE NOT conflict),
lab AS (SELECT CASE op WHEN 'NEW' THEN 'NEWER' WHEN 'UPDATE' THEN 'UPDATED' WHEN 'DELETE' THEN 'DELETED'
  WHEN 'DOWNLOAD' THEN 'DOWNLOADED' END AS operation, coalesce(size, 0) AS size FROM lg),
agg AS (SELECT operation, count(*) AS cnt, sum(size) AS bytes FROM lab GROUP BY operation),
ops AS (SELECT * FROM (VALUES ('NEWER', 0), ('UPDATED', 1), ('DELETED', 2), ('DOWNLOADED', 3)) t(operation, ord))
SELECT ops.operation, ops.ord, CAST(coalesce(agg.cnt, 0) AS BIGINT) AS count,
  CASE WHEN ops.operation = 'DELETED' THEN NULL ELSE CAST(coalesce(agg.bytes, 0) AS BIGINT) END AS bytes
FROM ops LEFT JOIN agg ON agg.operation = ops.operation""")
def q_a1(spark, sf_dir):
    i = inv(spark, sf_dir)
    ex = excl(spark, sf_dir)
    up = PU.upload_plan(i.L, i.A, ex, fx.ROOT_PATHS).select("op", "size")
    dele = PM.purge_removed_local(i.A, i.L).select(F.lit("DELETE").alias("op"), F.lit(None).cast("bigint").alias("size"))
    down = PD.download_folder_plan(i.R, i.A, i.L, ex, WALK_FOLDER, WALK_LOCAL).filter(~F.col("conflict")) \
        .select(F.lit("DOWNLOAD").alias("op"), "size")
    return transfer_summary(up.unionByName(dele).unionByName(down))


@register("s11_transfer_log", oracle=f"""
{p1_sql('m', 'archive', 'sync_roots', "'root'")}
SELECT op AS operation, coalesce(drive_id, '---') AS file_id, '---' AS remote_path, path AS local_path FROM m_plan""")
def q_s11(spark, sf_dir):
    i = inv(spark, sf_dir)
    plan = PU.upload_plan(i.L, i.A, excl(spark, sf_dir), fx.ROOT_PATHS)
    return transfer_log(plan.select("op", F.col("drive_id").alias("file_id"), F.col("path").alias("local_path")))


# --------------------------------------------------------------------------- scalar helpers

@register("t1_normalize_path", oracle="""
SELECT replace(path, '/', '//') || '/./x/../' AS raw, path AS normalized FROM local_files""")
def q_t1(spark, sf_dir):
    raw = F.concat(F.regexp_replace(F.col("path"), "/", "//"), F.lit("/./x/../"))
    return inv(spark, sf_dir).L.select(raw.alias("raw")).select("raw", normalize_path(F.col("raw")).alias("normalized"))


@register("t2_basename_parent", oracle="""
SELECT path, string_split(path, '/')[-1] AS name,
  '/' || array_to_string(string_split(path, '/')[2:-2], '/') AS parent FROM archive""")
def q_t2(spark, sf_dir):
    a = inv(spark, sf_dir).A
    return a.select("path", basename(F.col("path")).alias("name"), parent_dir(F.col("path")).alias("parent"))


@register("t5_remote_time", oracle="""
x AS (SELECT seq, strftime(modified_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS text FROM changes WHERE modified_time IS NOT NULL)
SELECT seq, text, strptime(regexp_replace(text, '\\.[^.]*$', ''), '%Y-%m-%dT%H:%M:%S') AS parsed FROM x""")
def q_t5(spark, sf_dir):
    c = inv(spark, sf_dir).C.filter(F.col("modified_time").isNotNull())
    x = c.select("seq", format_remote_time(F.col("modified_time")).alias("text"))
    return x.select("seq", "text", parse_remote_time(F.col("text")).alias("parsed"))


def _mime_values() -> str:
    """The standard registry as SQL rows, read here on its own."""
    import mimetypes

    return ", ".join(f"('{e}', '{m}')" for e, m in sorted(mimetypes.MimeTypes().types_map[True].items()))


@register("t10_guess_mime", oracle=f"""
mt AS (SELECT * FROM (VALUES {_mime_values()}) t(ext, mime)),
x AS (SELECT path, lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), '[^.](\\.[^./]*)$', 1)) AS ext
  FROM local_files WHERE NOT is_dir)
SELECT x.path, coalesce(mt.mime, 'application/octet-stream') AS mime_type FROM x LEFT JOIN mt ON mt.ext = x.ext""")
def q_t10(spark, sf_dir):
    files = inv(spark, sf_dir).L.filter(~F.col("is_dir")).select("path")
    return guess_mime(files, "path").select("path", "mime_type")


_ = (DEFAULT_DOWNLOAD,)


# --------------------------------------------------------------------------- streaming twins

def _stream_dirs(spark, name):
    import uuid

    from .session import scratch_path
    base = scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")
    return f"{base}/out", f"{base}/checkpoint"


def _run_stream(spark, sf_dir, name, job):
    from .streaming import jobs as V
    i = inv(spark, sf_dir)
    out, ckpt = _stream_dirs(spark, name)
    stream = V.stream_changes(spark, i.paths["changes"])
    q = job(i, stream, out, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return V.read_output(spark, out)


@register("v1_stream_changes", oracle="SELECT seq, file_id, removed FROM changes")
def q_v1(spark, sf_dir):
    from .streaming import jobs as V

    def job(i, stream, out, ckpt):
        return V._run(stream, lambda b, _id: b.select("seq", "file_id", "removed"), out, ckpt)
    return _run_stream(spark, sf_dir, "v1", job).select("seq", "file_id", "removed")


P3_STREAM_COLS = P3_COLS  # one batch here: clashes of destinations are those of the whole plan


@register("v2_stream_download_plan", oracle=f"""
RECURSIVE {p3_sql()}
SELECT {P3_STREAM_COLS} FROM p3_plan""")
def q_v2(spark, sf_dir):
    from .streaming import jobs as V
    ex = excl(spark, sf_dir)

    def job(i, stream, out, ckpt):
        return V.stream_download_plan(stream, i.R, lambda: inv(spark, sf_dir).A, i.L, ex, i.roots, LAST_SYNC, out,
                                      ckpt, ignored_ids=IGNORED_IDS)
    return _run_stream(spark, sf_dir, "v2", job).select(*[c.strip() for c in P3_STREAM_COLS.split(",")])


@register("v3_stream_removed", oracle="""
SELECT c.seq, a.drive_id, a.path FROM changes c JOIN archive a ON a.drive_id = c.file_id
WHERE c.removed OR coalesce(c.trashed, FALSE)""")
def q_v3(spark, sf_dir):
    from .streaming import jobs as V

    def job(i, stream, out, ckpt):
        return V.stream_removed(stream, i.A, out, ckpt)
    return _run_stream(spark, sf_dir, "v3", job).select("seq", "drive_id", "path")


@register("v6_init_offset", oracle="SELECT CAST(-1 AS BIGINT) AS batch_id, max(seq) AS max_seq FROM changes")
def q_v6(spark, sf_dir):
    from .streaming import jobs as V
    i = inv(spark, sf_dir)
    out, _ckpt = _stream_dirs(spark, "v6")
    V.init_offset(spark, i.C, out)
    return spark.read.parquet(f"{out}/_offsets").select("batch_id", "max_seq")


@register("j13_collides", oracle=f"""
RECURSIVE {P2_SQL},
two_plans AS (SELECT file_id, '/data/' || path AS dest_path FROM w UNION ALL SELECT file_id, dest_path FROM p2_plan),
{collides_sql('two_plans', 'jc')}
SELECT file_id, dest_path, exists_locally, dup_dest FROM jc""")
def q_j13(spark, sf_dir):
    """J13 on two plans at once: a full copy of the ASIA folder to /data and the
    ASIA download plan. Copies land on existing files, and both plans write
    some of the same paths."""
    from .operators.reconcile import collides
    i = inv(spark, sf_dir)
    copy = PD.copy_down_plan(i.R, WALK_FOLDER, "/data").select("file_id", "dest_path")
    down = PD.download_folder_plan(i.R, i.A, i.L, excl(spark, sf_dir), WALK_FOLDER, WALK_LOCAL) \
        .select("file_id", "dest_path")
    return collides(copy.unionByName(down), i.L, "dest_path").select("file_id", "dest_path", "exists_locally",
                                                                      "dup_dest")


@register("w2_assign_batches", oracle="""
x AS (SELECT file_id, CASE WHEN mime_type = 'application/vnd.folder' THEN 'folder' ELSE 'file' END AS kind
  FROM remote_files WHERE trashed)
SELECT file_id, kind, (row_number() OVER (PARTITION BY kind ORDER BY file_id) - 1) // 32 AS batch FROM x""")
def q_w2(spark, sf_dir):
    """Trashed nodes cut into delete batches of 32 per kind (one hot group)."""
    from .operators.ordering import assign_batches
    r = inv(spark, sf_dir).R.filter(F.col("trashed"))
    x = r.select("file_id", F.when(F.col("mime_type") == fx.FOLDER_MIME, "folder").otherwise("file").alias("kind"))
    return assign_batches(x, by=["kind"], order="file_id")
