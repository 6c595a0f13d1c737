"""Delta snapshots: reading, compaction, size and plan, against the archive rewritten whole at every step."""
import os

import pytest
from pyspark.sql import functions as F

from syncledger.operators import catalog as U
from syncledger.sources import store

COLS = U.ARCHIVE_COLS
ARCHIVE = "path string, drive_id string, date_modified_on_disk timestamp_ntz, md5sum string"


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def updates(spark, values):
    return spark.createDataFrame(values, "path string, drive_id string, date_modified_on_disk string, md5sum string, seq int") \
        .withColumn("date_modified_on_disk", F.to_timestamp_ntz("date_modified_on_disk"))


def big(spark, n=200_000):
    return spark.range(n).select(F.concat(F.lit("/d/"), "id").alias("path"), F.concat(F.lit("f"), "id").alias("drive_id"),
                                 F.expr("timestamp_ntz'2024-01-01'").alias("date_modified_on_disk"),
                                 F.md5(F.col("id").cast("string")).alias("md5sum"))


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


T = "2025-02-03 04:05:06"


def steps(spark):
    """Two rows of one id, a row by path, a new id; an id gone; the same id back elsewhere and gone again."""
    return [
        ("upsert", updates(spark, [("/d/1", "f1", T, "x", 1), ("/m/1", "f1", T, "y", 2), ("/d/2", None, T, "z", 1),
                                   ("/new", "g1", T, "", 1), ("/nowhere", None, T, "q", 1)])),
        ("delete", spark.createDataFrame([("f3",), ("g1",), ("absent",), (None,)], "drive_id string")),
        ("upsert", updates(spark, [("/back", "f3", T, "b", 1), ("/d/1", "f9", T, None, 1)])),
        ("delete", spark.createDataFrame([("f3",)], "drive_id string")),
    ]


def test_deltas_read_as_the_archive_rewritten(spark, tmp_path):
    base = str(tmp_path / "archive")
    state = big(spark, 50)
    store.write_archive(state, base)
    seen = {0: rows(state)}
    for kind, batch in steps(spark):
        now = store.read_archive(spark, base)
        change, whole = (U.upsert_changes, U.upsert_archive) if kind == "upsert" else (U.delete_changes, U.delete_archive)
        v = store.write_delta(change(now, batch), base)
        seen[v] = rows(whole(spark.createDataFrame(seen[v - 1], ARCHIVE), batch.dropna(subset=["drive_id"])
                             if kind == "delete" else batch))
        assert rows(store.read_archive(spark, base)) == seen[v]
    v = store.compact_archive(spark, base)
    assert v == 5 and "removed" not in spark.read.parquet(f"{base}/version=5").columns
    assert store.compact_archive(spark, base) == 5  # nothing to fold
    seen[5] = seen[4]
    store.write_delta(U.delete_changes(store.read_archive(spark, base), spark.createDataFrame([("f7",)], "drive_id string")),
                      base)
    seen[6] = [r for r in seen[5] if r[1] != "f7"]
    for version, expected in seen.items():  # every version still reads as it was
        assert rows(store.read_archive(spark, base, version)) == expected


def test_a_delta_that_was_not_published_is_not_read(spark, tmp_path):
    base = str(tmp_path / "archive")
    with pytest.raises(FileNotFoundError):
        store.write_delta(big(spark, 1).withColumn("removed", F.lit(True)), base)
    store.write_archive(big(spark, 5), base)
    big(spark, 5).withColumn("removed", F.lit(True)).withColumn("version", F.lit(1)).write.parquet(f"{base}/version=1")
    assert len(rows(store.read_archive(spark, base))) == 5
    with pytest.raises(FileNotFoundError):
        store.read_archive(spark, base, 1)
    assert store.write_delta(U.delete_changes(big(spark, 5), spark.createDataFrame([("/d/4",)], "path string"), "path"),
                             base) == 2
    assert len(rows(store.read_archive(spark, base))) == 4


def test_a_log_without_kinds_is_one_of_whole_archives(spark, tmp_path):
    base = str(tmp_path / "archive")
    big(spark, 3).write.parquet(f"{base}/version=0")
    spark.sql("SELECT 0L AS version, timestamp_ntz'2024-01-01' AS written_at").write.parquet(f"{base}/_versions")
    assert len(rows(store.read_archive(spark, base))) == 3
    assert store.compact_archive(spark, base) == 0


def test_a_clash_is_an_error(spark):
    with pytest.raises(U.UniquenessError):
        U.upsert_changes(big(spark, 9), updates(spark, [("/d/5", "f1", T, "x", 1)]))


def test_a_small_change_is_written_and_read_without_the_archive_moving(spark, tmp_path):
    base = str(tmp_path / "archive")
    store.write_archive(big(spark), base)
    batch = updates(spark, [(f"/d/{i}", f"f{i}", T, "x", 1) for i in range(100)])
    v = store.write_delta(U.upsert_changes(store.read_archive(spark, base), batch), base)
    assert size(f"{base}/version={v}") < 0.01 * size(f"{base}/version=0")
    now = store.read_archive(spark, base)
    plan = now._jdf.queryExecution().executedPlan().toString()
    left = plan.split("Union")[1].split("Aggregate")[0]  # the branch of the whole archive
    assert "BroadcastHashJoin" in left and "LeftAnti" in left and "hashpartitioning" not in left
    assert now.filter("md5sum = 'x'").count() == 100 and now.count() == 200_000


def test_no_updates_and_an_empty_archive(spark):
    none = updates(spark, [])
    assert U.upsert_changes(big(spark, 5), none).count() == 0
    assert U.delete_changes(big(spark, 5), spark.createDataFrame([], "drive_id string")).count() == 0
    first = U.upsert_changes(big(spark, 0), updates(spark, [("/a", "f1", T, "x", 1)]))
    assert rows(first) == [("/a", "f1", first.first()["date_modified_on_disk"], "x")]
