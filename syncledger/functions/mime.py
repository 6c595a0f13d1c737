"""Mime type from the file name (T10), with the standard registry of Python's
``mimetypes`` (its own tables, whatever the host has installed)."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .paths import basename

DEFAULT_MIME = "application/octet-stream"
_REGISTRY = mimetypes.MimeTypes()


def extension(name: Column) -> Column:
    """Last extension including the dot, as written; ``''`` when none. Leading dots begin no extension."""
    return F.regexp_extract(name, r"[^.](\.[^./]*)$", 1)


def _without(name: Column, ext: Column) -> Column:
    return F.left(name, F.length(name) - F.length(ext))


def guess_mime(df: DataFrame, path_col: str = "path", out: str = "mime_type",
               table: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add ``out`` from the name in ``path_col``. A name like ``a.tgz`` is
    read as ``a.tar.gz``, and an encoding (``.gz``) is taken off before the type
    is looked up; a type that is not known is ``DEFAULT_MIME``. ``table`` is a
    short list of (extension, type) in place of the registry."""
    types = table or sorted(_REGISTRY.types_map[True].items())
    name = basename(F.col(path_col))
    ext = extension(name)
    short = F.create_map(*[F.lit(x) for pair in sorted(_REGISTRY.suffix_map.items()) for x in pair])
    name = F.when(short[F.lower(ext)].isNotNull(), F.concat(_without(name, ext), short[F.lower(ext)])).otherwise(name)
    name = F.when(extension(name).isin(sorted(_REGISTRY.encodings_map)), _without(name, extension(name))).otherwise(name)
    t = df.sparkSession.createDataFrame(types, "__ext string, __mime string")  # bounded by the registry
    return df.withColumn("__ext", F.lower(extension(name))).join(F.broadcast(t), "__ext", "left") \
        .withColumn(out, F.coalesce(F.col("__mime"), F.lit(DEFAULT_MIME))).drop("__ext", "__mime")
