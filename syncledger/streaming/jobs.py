"""Structured Streaming twins of the change-feed plans (V1-V6).

The feed is an append-only folder of Parquet files (one row per change
event, each with a ``seq`` of its own). Jobs read it as a stream, by ``seq``
(:mod:`.feed_source`) or by files (:func:`stream_changes`), and run the batch
plan on every micro-batch inside ``foreachBatch``:

* output goes to ``<out>/batch_id=<n>`` with overwrite, so a retried batch
  replaces its own output (idempotent sink);
* the events a batch has finished are state of the job, ``<out>/_seen``, also
  by batch and overwritten. An event that is delivered again, in any later
  batch, is dropped; a dry run (V5) shows exactly the events that are not in it,
  whatever the order of the files. A batch reads no state of its own or of
  later batches, so a retry sees what the first attempt saw;
* the destinations of earlier batches are state as well (their output): a
  destination planned before is a clash (``dup_dest``);
* the offset of the source lives in the query checkpoint; the highest ``seq``
  of every finished batch is also appended to ``<out>/_offsets``;
* the download plan and the removed-item plan keep separate checkpoints, so
  their positions move independently (two tokens, as in the original tool);
* the archive is read again in every batch, so a batch sees the catalog as
  updated by the batches before it.

State is read by broadcast semi joins on the batch's own keys (``_seen`` within
the batch's range of ``seq``, which skips the files of other ranges), so it is
scanned but never exchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.diff import removed_remotely
from ..operators.exclude import Exclusions
from ..operators.hierarchy import lineage
from ..operators.semijoin import matching
from ..sources.store import exists
from .feed_source import CHANGES_SCHEMA, read_feed, stream_feed

def stream_changes(spark: SparkSession, path: str, schema: T.StructType = CHANGES_SCHEMA,
                   max_files_per_trigger: int | None = None, start_seq: int | None = None) -> DataFrame:
    """V1: the change feed as a stream (file source, fixed schema). With
    ``start_seq`` only events at or after that offset are kept (V6)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    s = reader.parquet(path)
    return s if start_seq is None else s.filter(F.col("seq") >= start_seq)


def dedupe_events(stream: DataFrame, delay: str = "1 hour", time_col: str = "modified_time") -> DataFrame:
    """V4 option: drop replayed copies of an event (same ``seq``) that arrive
    within ``delay`` of each other; state is bounded by the watermark.
    (Watermarks need a zoned timestamp, so a cast copy of the time is used.)"""
    ev = stream.withColumn("__event_time", F.col(time_col).cast("timestamp"))
    return ev.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark(["seq"]).drop("__event_time")


def _offsets_path(out: str) -> str:
    return f"{out.rstrip('/')}/_offsets"


def committed_seq(spark: SparkSession, out: str) -> int | None:
    """Highest ``seq`` a job writing to ``out`` has finished (or initialised)."""
    if not exists(spark, _offsets_path(out)):
        return None  # a first run; any other trouble with the offsets is an error
    v = spark.read.parquet(_offsets_path(out)).agg(F.max("max_seq")).first()[0]
    return None if v is None else int(v)


def init_offset(spark: SparkSession, source: DataFrame, out: str) -> int:
    """V6: on a first run (no offset yet) record "now" = the highest ``seq`` in
    the feed, so the job starts after it; later runs keep their position.
    Returns the recorded or existing offset."""
    cur = committed_seq(spark, out)
    if cur is not None:
        return cur
    now = source.agg(F.max("seq")).first()[0]
    now = -1 if now is None else int(now)
    spark.createDataFrame([(-1, now)], "batch_id bigint, max_seq bigint").write.mode("append") \
        .parquet(_offsets_path(out))
    return now


def _seen(spark: SparkSession, out: str, before: int | None = None) -> DataFrame | None:
    """``seq`` of the events that the batches of a job (``before`` one of them) have finished."""
    path = f"{out.rstrip('/')}/_seen"
    if not exists(spark, path):
        return None
    seen = spark.read.schema("seq bigint, batch_id bigint").parquet(path)
    return (seen if before is None else seen.filter(F.col("batch_id") < before)).select("seq")


def peek_changes(spark: SparkSession, source: DataFrame, out: str) -> DataFrame:
    """V5: events the job writing to ``out`` has not processed yet, read as a
    batch; nothing is written and no offset moves (dry run). They are the
    events after the job's first position (V6) that no batch has finished."""
    seen = _seen(spark, out)
    first = None
    if exists(spark, _offsets_path(out)):
        first = spark.read.parquet(_offsets_path(out)).filter("batch_id = -1").agg(F.max("max_seq")).first()[0]
    left = source if first is None else source.filter(F.col("seq") > int(first))
    return left if seen is None else left.join(seen, "seq", "left_anti")


def _new_events(spark: SparkSession, batch_df: DataFrame, out: str, batch_id: int) -> tuple[DataFrame, int | None]:
    """The batch without events that earlier batches have finished, and its highest ``seq``."""
    low, top = batch_df.agg(F.min("seq"), F.max("seq")).first()
    events = batch_df
    seen = None if low is None else _seen(spark, out, batch_id)
    seen = None if seen is None else seen.filter(F.col("seq").between(low, top))
    if seen is not None and not seen.isEmpty():  # a feed by seq never comes back to a range
        events = events.join(matching(seen, "seq", events), "seq", "left_anti").select(*batch_df.columns)
    return events, None if top is None else int(top)


def _run(stream: DataFrame, per_batch: Callable[[DataFrame, int], DataFrame], out: str, checkpoint: str,
         available_now: bool = True, processing_time: str | None = None):
    spark = stream.sparkSession
    base = out.rstrip("/")

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        # exchanged first: no task sorts a whole file. The feed is read, and its events told apart, once a batch
        once = batch_df.repartition("seq").dropDuplicates(["seq"]).persist()
        try:
            events, top = _new_events(spark, once, out, batch_id)
            per_batch(events, batch_id).write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")
            if top is not None:
                # as many tasks as the batch has; every file lies within the batch's range of seq
                events.select("seq").sortWithinPartitions("seq").write.mode("overwrite") \
                    .parquet(f"{base}/_seen/batch_id={batch_id}")
                spark.createDataFrame([(int(batch_id), top)], "batch_id bigint, max_seq bigint") \
                    .write.mode("append").parquet(_offsets_path(out))
        finally:
            once.unpersist()

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def _clashes_before(spark: SparkSession, plan: DataFrame, out: str, batch_id: int) -> DataFrame:
    """``dup_dest`` is true as well where an earlier batch has planned the destination."""
    if batch_id == 0 or not exists(spark, f"{out.rstrip('/')}/batch_id=0"):
        return plan
    taken = read_output(spark, out).filter(F.col("batch_id") < batch_id).select("dest_path")
    taken = matching(taken, "dest_path", plan).select(F.col("dest_path").alias("__taken")).distinct()
    return plan.join(taken, F.col("dest_path") == F.col("__taken"), "left") \
        .withColumn("dup_dest", F.col("dup_dest") | F.col("__taken").isNotNull()).drop("__taken")


def read_output(spark: SparkSession, out: str, schema: T.StructType | None = None) -> DataFrame:
    """All batch outputs of a streaming job (partition column ``batch_id``)."""
    reader = spark.read.option("basePath", out)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{out.rstrip('/')}/batch_id=*")  # state folders begin with _ and are not output


def stream_download_plan(stream: DataFrame, remote: DataFrame, archive: DataFrame | Callable[[], DataFrame],
                         local: DataFrame, ex: Exclusions, roots: DataFrame, last_sync, out: str, checkpoint: str,
                         ignored_ids=(), extra_root=None, available_now: bool = True, kept: DataFrame | None = None):
    """V2: per micro-batch, the download plan of the new events (P3 with the
    feed filters F3 and F5 and the ancestor test J8). ``archive`` may be a
    function returning the current snapshot, called once per batch. The remote
    listing's chains of ancestors are worked out once, before the first batch;
    runs on the same listing may share them (``kept``, its ``lineage``)."""
    from ..plans.download import download_changes_plan

    kept = lineage(remote.select("file_id", "parent_id", "name")) if kept is None else kept

    def per_batch(batch_df: DataFrame, batch_id: int) -> DataFrame:
        a = archive() if callable(archive) else archive
        plan = download_changes_plan(batch_df, remote, a, local, ex, roots, last_sync, extra_root=extra_root,
                                     ignored_ids=ignored_ids, kept=kept)
        return _clashes_before(batch_df.sparkSession, plan, out, batch_id)

    return _run(stream, per_batch, out, checkpoint, available_now)


def stream_removed(stream: DataFrame, archive: DataFrame | Callable[[], DataFrame], out: str, checkpoint: str,
                   available_now: bool = True):
    """V3: per micro-batch, archive rows named by removed or trashed events
    (J5). Runs with its own checkpoint, independent of V2."""
    def per_batch(batch_df: DataFrame, batch_id: int) -> DataFrame:
        a = archive() if callable(archive) else archive
        return removed_remotely(batch_df, a)

    return _run(stream, per_batch, out, checkpoint, available_now)


__all__ = ["CHANGES_SCHEMA", "committed_seq", "dedupe_events", "init_offset", "peek_changes", "read_feed", "read_output",
           "stream_changes", "stream_download_plan", "stream_feed", "stream_removed"]
