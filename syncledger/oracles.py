"""DuckDB oracle SQL for the registered queries.

Each oracle inlines the fixture definitions as CTEs in front of the query, so
it runs against nothing but the pre-registered base tables. Nothing here is
built by the code it checks.
"""

from __future__ import annotations

from .fixtures import EXCLUDED_PATHS, EXCLUDED_RULES, LAST_SYNC_TIME, ROOT_PATHS

#: The fixture's rules ``*.pyc`` and ``*.tmp``, written out by hand.
RULES_RE = r"\.(pyc|tmp)\z"
assert EXCLUDED_RULES == ["*.pyc", "*.tmp"]


def _values(rows, cols: str) -> str:
    body = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({cols})"


FIXTURE_CTES = f"""
fx_file AS (
  SELECT o.o_orderkey AS k, concat('o', o.o_orderkey) AS file_id, concat('c', o.o_custkey) AS parent_id,
    concat('Order_', o.o_orderkey, CASE o.o_orderkey % 7 WHEN 0 THEN '.pyc' WHEN 1 THEN '.tmp' ELSE '.csv' END) AS name,
    concat('/data/', r.r_name, '/', n.n_name, '/', c.c_name) AS dir_path,
    CASE WHEN o.o_orderkey % 16 = 7 THEN 'X' WHEN o.o_orderkey % 4 IN (1, 3) THEN 'R' ELSE 'A' END AS remote_ver,
    CASE WHEN o.o_orderkey % 16 = 7 THEN 'X' WHEN o.o_orderkey % 4 IN (2, 3) THEN 'L' ELSE 'A' END AS local_ver,
    CASE o.o_orderkey % 3 WHEN 0 THEN o.o_orderdate WHEN 1 THEN o.o_orderdate + INTERVAL 1 DAY ELSE o.o_orderdate + INTERVAL 4 DAY END AS remote_time,
    CASE o.o_orderkey % 2 WHEN 0 THEN o.o_orderdate ELSE o.o_orderdate + INTERVAL 2 DAY END AS local_time,
    o.o_orderdate + INTERVAL 1 DAY AS archive_time,
    CAST(1 + o.o_orderkey % 1000 AS BIGINT) AS size
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey),
fx_dir AS (
  SELECT 'root' AS file_id, CAST(NULL AS VARCHAR) AS parent_id, 'data' AS name, '/data' AS path, CAST(-1 AS BIGINT) AS k
  UNION ALL SELECT concat('r', r_regionkey), 'root', r_name, concat('/data/', r_name), CAST(-1 AS BIGINT) FROM region
  UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), n_name, concat('/data/', r_name, '/', n_name), CAST(-1 AS BIGINT)
    FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey), c_name, concat('/data/', r_name, '/', n_name, '/', c_name), CAST(c_custkey AS BIGINT)
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
remote_files AS (
  SELECT file_id, name, parent_id, 'application/vnd.folder' AS mime_type, CAST(NULL AS VARCHAR) AS md5sum,
    TIMESTAMP '1995-01-01 00:00:00' AS modified_time, CAST(0 AS BIGINT) AS size, k % 23 = 4 AS trashed FROM fx_dir
  UNION ALL SELECT file_id, name, parent_id, 'text/csv', md5(concat(file_id, remote_ver)), remote_time, size, k % 13 = 5
    FROM fx_file WHERE k % 11 <> 3),
local_files AS (
  SELECT path, TRUE AS is_dir, TIMESTAMP '1995-01-01 00:00:00' AS mtime, CAST(NULL AS VARCHAR) AS md5sum, CAST(0 AS BIGINT) AS size
    FROM fx_dir WHERE k = -1 OR k % 17 <> 0
  UNION ALL SELECT concat(f.dir_path, '/', f.name), FALSE, f.local_time, md5(concat(f.file_id, f.local_ver)), f.size
    FROM fx_file f WHERE f.k % 6 <> 5 AND CAST(substring(f.parent_id, 2) AS BIGINT) % 17 <> 0),
archive AS (
  SELECT path, file_id AS drive_id, TIMESTAMP '1995-01-01 00:00:00' AS date_modified_on_disk, '' AS md5sum
    FROM fx_dir WHERE k = -1 OR k % 19 <> 0
  UNION ALL SELECT concat(dir_path, '/', name), file_id, archive_time, CASE WHEN k % 97 = 0 THEN NULL ELSE md5(concat(file_id, 'A')) END
    FROM fx_file WHERE k % 5 <> 4),
changes AS (
  SELECT e.seq, e.file_id, e.removed, e.trashed, f.name, f.mime_type, f.md5sum, f.parent_id,
    CASE WHEN e.seq % 2 = 0 THEN e.ts ELSE f.modified_time END AS modified_time
  FROM (SELECT event_id AS seq, ts, event_type = 'error' AS removed, event_type = 'signup' AS trashed,
    CASE WHEN event_id % 50 = 0 THEN concat('zzz', event_id) WHEN event_id % 40 = 1 THEN concat('c', user_id)
         ELSE concat('o', user_id * 10 + event_id % 10) END AS file_id FROM events) e
  LEFT JOIN remote_files f ON f.file_id = e.file_id),
excl_paths AS ({_values([(p,) for p in EXCLUDED_PATHS], "path")}),
sync_roots AS ({_values([(p,) for p in ROOT_PATHS], "path")}),
params AS (SELECT '{RULES_RE}' AS rules_re, TIMESTAMP '{LAST_SYNC_TIME}' AS last_sync)
"""


def with_fixtures(body: str) -> str:
    """``body`` is either ``SELECT ...`` or ``name AS (...), ... SELECT ...``
    (more CTEs followed by the final select). A body that defines a recursive
    CTE starts with the word ``RECURSIVE``."""
    body = body.strip()
    head = "WITH "
    if body.upper().startswith("RECURSIVE"):
        head, body = "WITH RECURSIVE ", body[len("RECURSIVE"):].strip()
    if body.upper().startswith("SELECT"):
        return head + FIXTURE_CTES.strip() + "\n" + body
    return head + FIXTURE_CTES.strip() + ",\n" + body


# Reusable SQL fragments ---------------------------------------------------

def basename_sql(col: str) -> str:
    return f"regexp_extract({col}, '([^/]*)$', 1)"


def excluded_sql(col: str) -> str:
    """F7 in SQL: exact path in the list or basename matches a rule."""
    return (f"(({col}) IN (SELECT path FROM excl_paths) OR "
            f"regexp_matches({basename_sql(col)}, (SELECT rules_re FROM params)))")


def ancestors_sql(col: str) -> str:
    """Ancestors-or-self list of a path, top first, '/' included (H1)."""
    return (f"list_concat(['/'], list_transform(range(1, len(list_filter(string_split({col}, '/'), lambda x: x <> '')) + 1), "
            f"lambda i: '/' || array_to_string(list_filter(string_split({col}, '/'), lambda x: x <> '')[1:i], '/')))")


def excluded_up_sql(name: str, src: str, path_col: str = "path", include_stop: bool = False,
                    stops: str | None = "sync_roots") -> str:
    """CTEs ``{name}_hit(path)``: paths of ``src`` excluded under F8
    (``include_stop`` False) or F9 (True), by unnesting ancestors relationally."""
    stop_cte = (f"{name}_stop AS (SELECT p, max(i) AS si FROM {name}_ua WHERE a IN (SELECT path FROM {stops}) GROUP BY p)"
                if stops else f"{name}_stop AS (SELECT NULL::VARCHAR AS p, 0 AS si WHERE FALSE)")
    cmp = ">=" if include_stop else ">"
    return f"""
{name}_src AS (SELECT DISTINCT {path_col} AS p FROM {src}),
{name}_ua AS (SELECT p, unnest({ancestors_sql('p')}) AS a, generate_subscripts({ancestors_sql('p')}, 1) AS i FROM {name}_src),
{stop_cte},
{name}_hit AS (SELECT DISTINCT u.p AS path FROM {name}_ua u LEFT JOIN {name}_stop s ON s.p = u.p
  WHERE u.i {cmp} coalesce(s.si, {'1' if include_stop else '0'}) AND {excluded_sql('u.a')})"""
