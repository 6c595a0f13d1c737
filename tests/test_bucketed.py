"""Inventories stored by their join keys: joins without an exchange, the same rows."""
import pytest

from syncledger.fixtures import EXCLUDED_PATHS, EXCLUDED_RULES
from syncledger.operators import diff as D
from syncledger.operators.exclude import Exclusions
from syncledger.operators.reconcile import needs_upload, reconcile
from syncledger.sources import bucketed as B


@pytest.fixture
def catalog(spark, inv, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    c = B.write_catalog(inv.L, inv.A, inv.R, str(tmp_path / "catalog"), 6)
    yield c
    c.drop()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_j1_and_j4_of_stored_tables_exchange_nothing(inv, catalog):
    up, plain = needs_upload(catalog.local, catalog.archive_by_path), needs_upload(inv.L, inv.A)
    assert "Exchange" not in plan(up) and "Exchange" in plan(plain)
    assert rows(up, "path", "op", "drive_id") == rows(plain, "path", "op", "drive_id")
    gone, plain = D.removed_locally(catalog.archive_by_path, catalog.local), D.removed_locally(inv.A, inv.L)
    assert "Exchange" not in plan(gone)
    assert rows(gone, "path", "drive_id") == rows(plain, "path", "drive_id")


def test_j2_of_stored_tables_moves_no_listing(inv, catalog):
    """The remote side meets the archive by id in place, and only the joined rows travel to the local side's buckets."""
    ex = Exclusions(paths=(), rules=tuple(EXCLUDED_RULES))
    stored = reconcile(catalog.remote, catalog.archive_by_id, catalog.local, ex)
    assert plan(stored).count("Exchange hashpartitioning") == 1
    ex = Exclusions(paths=tuple(EXCLUDED_PATHS), rules=tuple(EXCLUDED_RULES))
    stored, plain = (reconcile(r, a, loc, ex) for r, a, loc in
                     ((catalog.remote, catalog.archive_by_id, catalog.local), (inv.R, inv.A, inv.L)))
    assert rows(stored, "file_id", "why", "decision") == rows(plain, "file_id", "why", "decision")


def test_a_bucket_is_one_file_and_tables_are_never_overwritten(spark, inv, tmp_path):
    folder = str(tmp_path / "t")
    t = B.write_bucketed(inv.A, "path", folder, 4)
    files = spark.table(t).inputFiles()
    assert 1 <= len(files) <= 4 and spark.table(t).count() == inv.A.count()
    with pytest.raises(Exception, match="exist"):
        B.write_bucketed(inv.A, "path", folder, 4, t)
    empty = B.write_bucketed(inv.A.limit(0), "path", str(tmp_path / "e"), 4)
    assert spark.table(empty).count() == 0 and needs_upload(inv.L, spark.table(empty)).count() == inv.L.count()
    with pytest.raises(ValueError):
        B.write_bucketed(inv.A, "path", str(tmp_path / "z"), 0)
    for name in (t, empty):
        spark.sql(f"DROP TABLE {name}")
