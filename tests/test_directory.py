"""The directory source: empty folders, true folder times, chunked digests, and any dealing of folders to tasks."""

import datetime
import hashlib
import os
import random
import subprocess
import sys

import pytest

from syncledger.sources import directory
from syncledger.sources.directory import read_tree
from syncledger.sources.listing import scan_local

WHEN = datetime.datetime(2021, 3, 4, 5, 6, 7, 123456)


def seconds(t):
    return t.replace(tzinfo=datetime.timezone.utc).timestamp()


@pytest.fixture
def tree(tmp_path):
    """Files and folders by path, as os.walk sees them, with times of their own."""
    rnd = random.Random(8)
    root = tmp_path / "tree"
    folders = [root]
    for i in range(60):
        folder = rnd.choice(folders) / f"d{i} é"
        folder.mkdir(parents=True)
        folders.append(folder)
    for i in range(150):
        (rnd.choice(folders[:30]) / f"f{i}.bin").write_bytes(rnd.randbytes(rnd.randint(0, 9000)))
    (root / ".hidden").write_text("h")
    (root / "_under").mkdir()
    (root / "_under" / "a=b").write_text("not a partition")
    for i, (folder, _, files) in enumerate(os.walk(root, topdown=False)):
        for name in files:
            os.utime(os.path.join(folder, name), (seconds(WHEN) + i, seconds(WHEN) + i))
        os.utime(folder, (seconds(WHEN) - i, seconds(WHEN) - i))
    return root


def plain(root):
    out = {str(root): (True, os.stat(root).st_mtime_ns // 1000, None, 0)}
    for folder, folders, files in os.walk(root):
        for name in folders:
            p = os.path.join(folder, name)
            out[p] = (True, os.stat(p).st_mtime_ns // 1000, None, 0)
        for name in files:
            p = os.path.join(folder, name)
            with open(p, "rb") as f:
                data = f.read()
            out[p] = (False, os.stat(p).st_mtime_ns // 1000, hashlib.md5(data).hexdigest(), len(data))
    return out


def rows(df):
    epoch = datetime.datetime(1970, 1, 1)
    got = df.collect()
    out = {r["path"]: (r["is_dir"], (r["mtime"] - epoch) // datetime.timedelta(microseconds=1), r["md5sum"], r["size"])
           for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("planned, group", [(1, 1), (5, 2), (40, 3), (4096, 16)])
def test_every_file_and_folder_once(spark, tree, planned, group):
    assert rows(read_tree(spark, str(tree), digest=True, planned=planned, group=group, chunk=1000)) == plain(tree)


def test_scan_has_empty_folders_and_their_own_times(spark, tree):
    listed, want = rows(scan_local(spark, str(tree), with_md5=True)), plain(tree)
    assert listed == want
    empty = [p for p, v in want.items() if v[0] and not os.listdir(p)]
    assert empty and all(p in listed for p in empty)
    newest = {os.path.dirname(p): 0 for p in want}
    for p, v in want.items():
        newest[os.path.dirname(p)] = max(newest[os.path.dirname(p)], v[1])
    assert any(listed[p][1] != t for p, t in newest.items() if p in listed)


def test_one_file_an_empty_folder_and_nothing(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "f").write_bytes(b"")
    assert [r["path"] for r in read_tree(spark, str(tmp_path / "e")).collect()] == [str(tmp_path / "e")]
    one = read_tree(spark, str(tmp_path / "f"), digest=True).collect()
    assert [(r["is_dir"], r["size"], r["md5sum"]) for r in one] == [(False, 0, hashlib.md5(b"").hexdigest())]
    with pytest.raises(Exception, match="no such folder"):
        read_tree(spark, str(tmp_path / "none")).collect()


def test_partitions_deal_out_folders_and_hold_few_rows(tree):
    reader = directory.TreeReader({"path": str(tree), "planned": "8", "group": "2"})
    parts = reader.partitions()
    deep = [f for p in parts for f in p.deep]
    assert len(deep) >= 8 and len(set(deep)) == len(deep)
    assert max(len(p.deep) for p in parts) == 2 and all(len(p.rows) <= directory.ROWS for p in parts)


def test_what_vanishes_and_links(spark, tree):
    reader = directory.TreeReader({"path": str(tree), "planned": "2", "group": "1"})
    parts = [*reader.partitions(), directory.Folders([str(tree / "never")], [])]
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == len(plain(tree))
    listed = read_tree(spark, str(tree)).persist()
    assert listed.count() == len(plain(tree))
    before = plain(tree)
    gone = next(p for p, v in before.items() if not v[0])
    os.unlink(gone)
    os.symlink(tree, tree / "_under" / "loop")
    os.symlink(tree / "nothing", tree / "broken")
    digested = {r["path"]: r["md5sum"] for r in directory.with_digests(listed, str(tree)).collect()}
    assert digested[gone] is None and {p for p, m in digested.items() if m is None} == \
        {gone} | {p for p, v in before.items() if v[0]}
    listed.unpersist()
    again = {r["path"]: r["is_dir"] for r in read_tree(spark, str(tree)).collect()}
    assert again[str(tree / "_under" / "loop")] and str(tree / "broken") not in again
    assert not any(p.startswith(str(tree / "_under" / "loop") + "/") for p in again)


def test_a_large_file_is_digested_in_blocks(tmp_path):
    """A sparse file of 3 GB: the md5 of hashlib, in a process that may hold a few blocks but no tenth of the file."""
    path = tmp_path / "sparse"
    with open(path, "wb") as f:
        f.truncate(3 << 30)
        f.seek(1 << 30)
        f.write(b"some data in the middle")
    code = ("import resource, sys; sys.path.insert(0, sys.argv[2])\n"
            "from syncledger.sources.directory import digest_file, open_tree\n"
            "system, at = open_tree(sys.argv[1])\n"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "print(digest_file(system, at), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)")
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, str(path), top], capture_output=True, text=True, check=True)
    got, grown_kb = out.stdout.split()
    with open(path, "rb") as f:
        want = hashlib.file_digest(f, "md5").hexdigest()
    assert got == want and int(grown_kb) < 100_000
