"""Cutting a large table down to what a batch of keys needs, and keys that may be NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Keys that may be broadcast (some tens of MB); beyond it the join that follows shuffles both sides.
BATCH_KEYS = 1_000_000


def null_safe_key(key: Column, row_id: Column, tag: str) -> Column:
    """Join key that never matches when ``key`` is NULL and spreads NULL rows
    over all partitions instead of piling them into one."""
    return F.coalesce(key, F.concat(F.lit(f"\u0000{tag}:"), row_id.cast("string")))


def matching(table: DataFrame, key: str, batch: DataFrame, batch_key: str | None = None,
             bound: int = BATCH_KEYS) -> DataFrame:
    """The rows of ``table`` whose ``key`` occurs in ``batch``: a broadcast semi
    join, so the table is scanned but not exchanged. The distinct keys are
    written once and counted; with more than ``bound`` of them the table comes
    back as it is. A table cut down so gives the same rows in any inner, left
    (from the batch) or semi join on that key."""
    checkpoint_dir(batch.sparkSession)
    keys = batch.select(F.col(batch_key or key).alias("__key")).filter("__key IS NOT NULL").distinct() \
        .checkpoint(eager=True)
    if keys.count() > bound:
        return table
    return table.join(F.broadcast(keys), F.col(key) == F.col("__key"), "left_semi")


def broadcast_if_few(keys: DataFrame, bound: int = BATCH_KEYS) -> tuple[DataFrame, bool]:
    """``keys`` written once, with a broadcast hint where they are at most ``bound``, and whether they are. A table made
    on the driver has no size that the planner knows, and would have the other side exchanged."""
    checkpoint_dir(keys.sparkSession)
    keys = keys.checkpoint(eager=True)
    few = keys.count() <= bound
    return (F.broadcast(keys) if few else keys), few
