"""The feed as a stream by seq, dry runs against its position, and state across batches."""

import datetime

import pytest
from pyspark.sql import functions as F

from syncledger.operators.exclude import Exclusions
from syncledger.streaming import jobs as V
from syncledger.streaming.feed_source import CHANGES_SCHEMA, FeedStream

NOON = datetime.datetime(2024, 1, 1, 12)
FOLDER = "application/vnd.folder"


def event(seq, file_id=None, name=None, parent="d", md5="new"):
    return seq, file_id or f"f{seq}", False, False, name or f"n{seq}", "text/plain", md5, parent, NOON


def append(spark, feed, seqs, **more):
    rows = [s if isinstance(s, tuple) else event(s) for s in seqs]
    spark.createDataFrame(rows, CHANGES_SCHEMA).coalesce(1).write.mode("append").parquet(feed, **more)


def keep(spark, stream, base):
    """Runs a job that keeps the events' numbers."""
    q = V._run(stream, lambda b, _i: b.select("seq"), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    assert q.exception() is None
    return sorted(r["seq"] for r in V.read_output(spark, f"{base}/out").collect())


def left(spark, feed, base):
    return sorted(r["seq"] for r in V.peek_changes(spark, V.read_feed(spark, feed), f"{base}/out").collect())


def test_events_out_of_file_order(spark, tmp_path):
    """Later files hold earlier numbers: the run and the dry run share every event out between them."""
    feed, base = str(tmp_path / "feed"), str(tmp_path)
    append(spark, feed, range(60, 80))
    append(spark, feed, [s for s in range(1, 60) if s % 3 == 0])
    append(spark, feed, [s for s in range(1, 60) if s % 3])
    assert left(spark, feed, base) == list(range(1, 80))
    assert keep(spark, V.stream_feed(spark, feed, until_seq=30), base) == list(range(1, 31))
    assert left(spark, feed, base) == list(range(31, 80))
    append(spark, feed, [85, 83])
    append(spark, feed, [80, 81, 82, 84])
    assert left(spark, feed, base) == list(range(31, 86))
    assert keep(spark, V.stream_feed(spark, feed), base) == list(range(1, 86))
    assert left(spark, feed, base) == []
    assert V.committed_seq(spark, f"{base}/out") == 85


def test_by_files_the_dry_run_shows_what_no_batch_had(spark, tmp_path):
    """The stream by files has finished numbers on both sides of those that are left."""
    feed, base = str(tmp_path / "feed"), str(tmp_path)
    append(spark, feed, [s for s in range(100) if s % 3 == 0])
    assert keep(spark, V.stream_changes(spark, feed), base) == list(range(0, 100, 3))
    append(spark, feed, [s for s in range(100) if s % 3])
    assert left(spark, feed, base) == [s for s in range(100) if s % 3]


def test_a_late_event_holds_back_a_gapless_feed(spark, tmp_path):
    feed, base = str(tmp_path / "feed"), str(tmp_path)
    append(spark, feed, [1, 2, 3, 6, 7])
    assert keep(spark, V.stream_feed(spark, feed, gapless=True), base) == [1, 2, 3]
    append(spark, feed, [5, 9])
    assert keep(spark, V.stream_feed(spark, feed, gapless=True), base) == [1, 2, 3]
    append(spark, feed, [4, 10, 12])
    assert keep(spark, V.stream_feed(spark, feed, gapless=True), base) == [1, 2, 3, 4, 5, 6, 7]
    append(spark, feed, [8, 11])
    assert keep(spark, V.stream_feed(spark, feed, gapless=True), base) == list(range(1, 13))


def test_first_position(spark, tmp_path):
    feed, base = str(tmp_path / "feed"), str(tmp_path)
    append(spark, feed, range(50))
    first = V.init_offset(spark, V.read_feed(spark, feed), f"{base}/out")
    assert first == 49 and left(spark, feed, base) == []
    append(spark, feed, [52, 50])
    assert left(spark, feed, base) == [50, 52]
    assert keep(spark, V.stream_feed(spark, feed, start_seq=first + 1), base) == [50, 52]
    assert left(spark, feed, base) == []


def test_an_event_delivered_again_is_dropped(spark, tmp_path):
    feed, base = str(tmp_path / "feed"), str(tmp_path)
    append(spark, feed, [1, 2, 2, 3])
    append(spark, feed, [3, 4])
    append(spark, feed, [1, 5])
    assert keep(spark, V.stream_changes(spark, feed, max_files_per_trigger=1), base) == [1, 2, 3, 4, 5]
    assert V.read_output(spark, f"{base}/out").select("batch_id").distinct().count() == 3


def test_a_batch_done_again_sees_what_it_saw(spark, tmp_path):
    """The sink run twice with one batch, as after a lost commit: the same output."""
    base = str(tmp_path)
    one = spark.createDataFrame([event(1), event(2)], CHANGES_SCHEMA)
    for _ in range(2):
        events, top = V._new_events(spark, one, f"{base}/out", 0)
        assert top == 2 and events.count() == 2
        events.select("seq").write.mode("overwrite").parquet(f"{base}/out/_seen/batch_id=0")
    assert V._new_events(spark, one, f"{base}/out", 1)[0].count() == 0


def test_destinations_of_earlier_batches_clash(spark, tmp_path):
    """Two batches with one destination, and the second run again: dup_dest in the later batch alone."""
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    remote = spark.createDataFrame([("d", "d", None, FOLDER, None, None, 0, False)],
                                   "file_id string, name string, parent_id string, mime_type string, md5sum string, "
                                   "modified_time timestamp_ntz, size bigint, trashed boolean")
    archive = spark.createDataFrame([("/base", "d", NOON, "")], "path string, drive_id string, "
                                    "date_modified_on_disk timestamp_ntz, md5sum string")
    local = spark.createDataFrame([("/base", True, NOON, None, 0)], "path string, is_dir boolean, mtime timestamp_ntz, "
                                  "md5sum string, size bigint")
    roots = spark.createDataFrame([("/base", "d")], "path string, drive_id string")
    append(spark, feed, [event(1, "a", "x.txt"), event(2, "b", "y.txt"), event(3, "c", "z.txt"), event(4, "e", "z.txt")])
    append(spark, feed, [event(5, "g", "x.txt"), event(6, "h", "w.txt"), event(2, "b", "y.txt")])

    def run(until):
        q = V.stream_download_plan(V.stream_feed(spark, feed, until_seq=until), remote, archive, local, Exclusions(), roots,
                                   datetime.datetime(2020, 1, 1), out, str(tmp_path / "ck"))
        q.awaitTermination()
        assert q.exception() is None
        return {r["seq"]: (r["dest_path"], r["dup_dest"]) for r in V.read_output(spark, out).collect()}

    assert run(4) == {1: ("/base/x.txt", False), 2: ("/base/y.txt", False), 3: ("/base/z.txt", True),
                      4: ("/base/z.txt", True)}
    assert run(None) == {1: ("/base/x.txt", False), 2: ("/base/y.txt", False), 3: ("/base/z.txt", True),
                         4: ("/base/z.txt", True), 5: ("/base/x.txt", True), 6: ("/base/w.txt", False)}


def test_offsets_and_partitions(spark, tmp_path):
    feed = str(tmp_path / "feed")
    empty = FeedStream(CHANGES_SCHEMA, {"path": feed})
    assert empty.initialOffset() == empty.latestOffset() == {"seq": -1} and empty.partitions({"seq": -1}, {"seq": -1}) == []
    append(spark, feed, range(10, 20))
    append(spark, feed, range(40, 50))
    (tmp_path / "feed" / "_ignored").write_text("no event")
    reader = FeedStream(CHANGES_SCHEMA, {"path": feed})
    assert reader.initialOffset() == {"seq": 9} and reader.latestOffset() == {"seq": 49}
    parts = reader.partitions({"seq": 14}, {"seq": 30})
    assert len(parts) == 1  # the other file's range does not meet the trigger's
    assert [s for b in reader.read(parts[0]) for s in b.column(0).to_pylist()] == [15, 16, 17, 18, 19]


@pytest.mark.parametrize("columns", [["seq", "file_id"], CHANGES_SCHEMA.fieldNames()[::-1]])
def test_missing_and_reordered_columns(spark, tmp_path, columns):
    feed = str(tmp_path / "feed")
    spark.createDataFrame([event(1), event(2)], CHANGES_SCHEMA).select(*columns, F.lit(1).alias("more")).write.parquet(feed)
    rows = V.read_feed(spark, feed).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == [1, 2] and [r["file_id"] for r in rows] == ["f1", "f2"]
    assert rows[0]["modified_time"] == (NOON if len(columns) > 2 else None)
