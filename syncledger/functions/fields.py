"""Field masks (F1, F2): ``a,b/c`` or ``a(b,c/d)`` select nested fields.

A mask is a few bytes of configuration: it is turned on the driver into a
``select`` of nested ``struct`` expressions, and Catalyst prunes the unused
nested fields from the scan. Whitespace is ignored; ``*`` keeps every field
of the level it stands on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Mask = dict  # name -> 0 (leaf) or a nested Mask, insertion ordered


def parse_mask(text: str) -> Mask:
    """``a/b/c`` -> {a: {b: {c: 0}}}; ``a(b,c/d),e`` -> {a: {b: 0, c: {d: 0}}, e: 0}."""
    s = "".join(ch for ch in text if not ch.isspace())
    pos = 0

    def name() -> str:
        nonlocal pos
        start = pos
        while pos < len(s) and s[pos] not in ",/()":
            pos += 1
        return s[start:pos]

    def term(into: Mask) -> None:
        nonlocal pos
        key = name()
        if pos < len(s) and s[pos] == "/":
            pos += 1
            child: Mask = {}
            term(child)
            into[key] = merge_masks(into.get(key, 0), child)
        elif pos < len(s) and s[pos] == "(":
            pos += 1
            child = seq(")")
            into[key] = merge_masks(into.get(key, 0), child)
        else:
            into[key] = merge_masks(into.get(key, 0), 0) if key in into else 0

    def seq(closer: str | None) -> Mask:
        nonlocal pos
        out: Mask = {}
        while pos < len(s):
            term(out)
            if pos < len(s) and s[pos] == ",":
                pos += 1
                continue
            if pos < len(s) and s[pos] == ")":
                if closer == ")":
                    pos += 1
                    return out
                pos += 1  # stray ')' ends nothing; skip it
                continue
        return out

    if not s:
        return {}
    return seq(None)


def merge_masks(m1, m2):
    """union of two masks. A nested entry beats a bare leaf; order is that
    of the first mask, then new names of the second."""
    nested1 = isinstance(m1, dict) and bool(m1)
    nested2 = isinstance(m2, dict) and bool(m2)
    if nested1 and nested2:
        out = dict(m1)
        for k, v in m2.items():
            out[k] = merge_masks(out[k], v) if k in out else v
        return out
    if nested1:
        return m1
    if nested2:
        return m2
    return 0


def format_mask(m: Mask) -> str:
    """Back to text: one child -> ``a/b``, several -> ``a(b,c)``."""
    parts = []
    for k, v in m.items():
        if isinstance(v, dict) and v:
            inner = format_mask(v)
            parts.append(f"{k}/{inner}" if len(v) == 1 else f"{k}({inner})")
        else:
            parts.append(k)
    return ",".join(parts)


def _project(col: Column, dtype: T.DataType, m) -> Column:
    if not isinstance(m, dict) or not m:
        return col
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _project(x, dtype.elementType, m))
    if not isinstance(dtype, T.StructType):
        return col
    fields = {f.name: f for f in dtype.fields}
    picked = []
    for k, sub in m.items():
        if k == "*":
            for f in dtype.fields:
                if f.name not in m:
                    picked.append(_project(col[f.name], f.dataType, sub).alias(f.name))
        elif k in fields:
            picked.append(_project(col[k], fields[k].dataType, sub).alias(k))
    return F.struct(*picked)


def select_fields(df: DataFrame, *masks: str) -> DataFrame:
    """F1 (+F2 for several masks): keep only the masked (nested) fields.

    Unknown names are ignored, as an API ignores fields it does not return.
    An empty mask keeps everything.
    """
    m: Mask = {}
    for text in masks:
        m = merge_masks(m, parse_mask(text)) or {}
    m = {k: v for k, v in (m or {}).items() if k != ""}
    if not m:
        return df
    fields = {f.name: f for f in df.schema.fields}
    cols = []
    for k, sub in m.items():
        if k == "*":
            cols.extend(F.col(f.name) for f in df.schema.fields if f.name not in m)
        elif k in fields:
            cols.append(_project(F.col(k), fields[k].dataType, sub).alias(k))
    return df.select(*cols)
