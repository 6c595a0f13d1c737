"""Compare a Spark result with a DuckDB oracle the way the correctness gate does:
same column names, same row count, same multiset of values (order-free)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_SPARK_TO_ARROW = {"int": "int32", "bigint": "int64", "string": "string", "boolean": "bool",
                   "timestamp_ntz": "timestamp[us]", "double": "double", "float": "float", "smallint": "int16",
                   "tinyint": "int8", "date": "date32[day]"}


def type_mismatches(spark_df, arrow_schema) -> list[str]:
    """Columns whose Spark type and DuckDB (Arrow) type differ."""
    out = []
    arrow = {f.name: str(f.type) for f in arrow_schema}
    for f in spark_df.schema.fields:
        st = f.dataType.simpleString()
        want = _SPARK_TO_ARROW.get(st)
        got = arrow.get(f.name)
        if want is not None and got is not None and want != got and not (want == "string" and got == "large_string"):
            out.append(f"{f.name}: spark={st} duck={got}")
    return out


def compare(spark_df, con, sql: str, check_types: bool = True):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    tbl = rel.to_arrow_table() if hasattr(rel, "to_arrow_table") else rel.arrow()
    tbl = tbl.read_all() if hasattr(tbl, "read_all") else tbl
    d_cols = list(tbl.column_names)
    d_rows = list(zip(*[c.to_pylist() for c in tbl.columns])) if d_cols else []
    if check_types:
        tm = type_mismatches(spark_df, tbl.schema)
        if tm:
            return False, f"type mismatch: {tm}"
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        return False, f"values differ ({len(a)} rows): spark-only={diff_a} duck-only={diff_b} cols={sorted(s_cols)}"
    return True, f"{len(a)} rows"
