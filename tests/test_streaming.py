from pyspark.sql import functions as F

from syncledger.operators.diff import removed_remotely
from syncledger.streaming import jobs as V
from syncledger.streaming.feed import changed_since


def test_stream_equals_batch_and_offsets(spark, inv, tmp_path):
    feed = str(tmp_path / "feed")
    top = inv.C.agg(F.max("seq")).first()[0]
    inv.C.filter(F.col("seq") <= top // 2).coalesce(1).write.parquet(feed, mode="append")
    inv.C.filter((F.col("seq") > top // 2) & (F.col("seq") <= top - 100)).coalesce(1).write.parquet(feed, mode="append")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = V.stream_removed(V.stream_changes(spark, feed, max_files_per_trigger=1), inv.A, out, ckpt)
    q.awaitTermination()
    got = V.read_output(spark, out).select("seq", "drive_id", "path")
    want = removed_remotely(inv.C.filter(F.col("seq") <= top - 100), inv.A).select("seq", "drive_id", "path")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert V.read_output(spark, out).select("batch_id").distinct().count() == 2
    # dry run: nothing new yet; after new events arrive, only they are shown
    source = spark.read.parquet(feed)
    assert V.peek_changes(spark, source, out).count() == 0
    inv.C.filter(F.col("seq") > top - 100).coalesce(1).write.parquet(feed, mode="append")
    assert V.peek_changes(spark, spark.read.parquet(feed), out).count() == 100
    # the second run picks up only the new file, with its own checkpoint position
    q = V.stream_removed(V.stream_changes(spark, feed), inv.A, out, ckpt)
    q.awaitTermination()
    assert V.read_output(spark, out).select("batch_id").distinct().count() == 3
    assert V.peek_changes(spark, spark.read.parquet(feed), out).count() == 0


def test_init_offset_starts_from_now(spark, inv, tmp_path):
    out = str(tmp_path / "o")
    now = V.init_offset(spark, inv.C, out)
    assert now == inv.C.agg(F.max("seq")).first()[0]
    assert V.init_offset(spark, inv.C, out) == now
    assert V.peek_changes(spark, inv.C, out).count() == 0


def test_late_events_dropped(spark, inv):
    kept = changed_since(inv.C, "1998-01-01T00:00:00.999Z")
    assert kept.filter(F.col("modified_time") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")).count() == 0
    assert kept.count() == inv.C.filter("modified_time >= TIMESTAMP_NTZ'1998-01-01 00:00:00'").count()


def test_dedupe_replayed_events(spark, inv, tmp_path):
    feed = str(tmp_path / "dup")
    some = inv.C.filter(F.col("modified_time").isNotNull()).limit(200)
    some.write.parquet(feed)
    some.write.parquet(feed, mode="append")  # the same events delivered twice
    seen = []
    s = V.dedupe_events(V.stream_changes(spark, feed), "1 hour")
    q = s.writeStream.foreachBatch(lambda b, _i: seen.append(b.count())) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(seen) == 200


def test_download_plan_stream_matches_batch(spark, inv, tmp_path):
    from syncledger import fixtures as fx
    from syncledger.operators.exclude import Exclusions
    from syncledger.plans.download import download_changes_plan

    ex = Exclusions.from_df(inv.exclusions)
    feed = str(tmp_path / "feed")
    top = inv.C.agg(F.max("seq")).first()[0]
    for lo, hi in [(-1, top // 3), (top // 3, 2 * top // 3), (2 * top // 3, top)]:
        inv.C.filter((F.col("seq") > lo) & (F.col("seq") <= hi)).coalesce(1).write.parquet(feed, mode="append")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = V.stream_download_plan(V.stream_changes(spark, feed, max_files_per_trigger=1), inv.R, lambda: inv.A, inv.L, ex,
                               inv.roots, fx.LAST_SYNC_TIME, out, ckpt, ignored_ids=["n12"])
    q.awaitTermination()
    cols = ["seq", "file_id", "type", "decision", "why", "root_parent_id", "dest_path", "md5sum", "exists_locally"]
    got = V.read_output(spark, out)
    assert got.select("batch_id").distinct().count() == 3
    want = download_changes_plan(inv.C, inv.R, inv.A, inv.L, ex, inv.roots, fx.LAST_SYNC_TIME, ignored_ids=["n12"])
    got, want = got.select(*cols), want.select(*cols)
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_the_seen_events_of_a_batch_are_written_by_many_tasks(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    spark.range(20_000).select((F.col("id") % 10_000).alias("seq"), F.lit("f").alias("file_id")) \
        .coalesce(1).write.parquet(feed)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        V._run(V.stream_changes(spark, feed), lambda b, _id: b.select("seq"), out, str(tmp_path / "ckpt")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    seen = spark.read.parquet(f"{out}/_seen/batch_id=0")
    assert len(seen.inputFiles()) > 1
    assert sorted(r[0] for r in seen.collect()) == list(range(10_000))
    assert V.read_output(spark, out).count() == 10_000


def test_the_events_of_a_batch_are_told_apart_once(spark, tmp_path):
    """What a batch reads are kept rows, not exchanged again, nor joined with events that are no part of its range."""
    feed, plans = str(tmp_path / "feed"), []

    def per_batch(b, _id):
        plans.append(b._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0])
        return b.select("seq")

    for low in (0, 100, 50):
        spark.range(low, low + 100).select(F.col("id").alias("seq"), F.lit("f").alias("file_id")).coalesce(1) \
            .write.parquet(feed, mode="append")
        V._run(V.stream_changes(spark, feed), per_batch, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    assert ["Join" in p for p in plans] == [False, False, True]
    assert not any(word in p for p in plans[:2] for word in ("Aggregate", "Deduplicate", "Repartition"))
    assert sorted(r["seq"] for r in V.read_output(spark, str(tmp_path / "out")).collect()) == list(range(200))


def test_runs_on_one_listing_share_its_lineage(spark, inv, tmp_path, monkeypatch):
    from syncledger import fixtures as fx
    from syncledger.operators.exclude import Exclusions
    from syncledger.plans.download import download_changes_plan

    kept, ex = V.lineage(inv.R.select("file_id", "parent_id", "name")), Exclusions.from_df(inv.exclusions)
    monkeypatch.setattr(V, "lineage", None)  # not worked out again
    top = inv.C.agg(F.max("seq")).first()[0]
    for until in (top // 2, None):
        q = V.stream_download_plan(V.stream_feed(spark, inv.paths["changes"], until_seq=until), inv.R, inv.A, inv.L, ex,
                                   inv.roots, fx.LAST_SYNC_TIME, str(tmp_path / "out"), str(tmp_path / "ckpt"), kept=kept)
        q.awaitTermination()
        assert q.exception() is None
    want = download_changes_plan(inv.C, inv.R, inv.A, inv.L, ex, inv.roots, fx.LAST_SYNC_TIME).select("seq", "dest_path")
    got = V.read_output(spark, str(tmp_path / "out")).select("seq", "dest_path")
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
