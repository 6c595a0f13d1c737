"""A streaming data source over the change feed whose offset is ``seq`` (V1, V5, V6).

``spark.readStream.format("change_feed").load(path)`` reads a folder of Parquet
files of events. The position is one number, the last ``seq`` taken: a trigger
takes the events in (start, end], whichever files they lie in and whenever those
came, so the order of files does not matter. The offset comes from the files'
footers (the highest ``seq`` there is); event data are read by the tasks alone,
a file's row groups at a time, and only those whose range of ``seq`` meets the
trigger's. Options:

* ``start_seq``: the first event to take (V6); without it, the feed's first;
* ``until_seq``: the last event to take, for a run up to a known point;
* ``gapless``: events are numbered without gaps, and the offset stops before
  the first number that is missing, so an event that comes late holds back the
  ones behind it instead of being passed over.

The folder may be on any file system that pyarrow opens, and must be visible to
the executors. Files that begin with ``_`` or ``.`` are not read. A feed that is
empty, or not there yet, has no events.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..sources.directory import open_tree

FORMAT = "change_feed"

CHANGES_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("file_id", T.StringType()),
    T.StructField("removed", T.BooleanType()),
    T.StructField("trashed", T.BooleanType()),
    T.StructField("name", T.StringType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("md5sum", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("modified_time", T.TimestampNTZType()),
])


@dataclass
class Events(InputPartition):
    """The events of a row group of a file with ``after`` < seq <= ``last``."""

    path: str
    group: int
    after: int
    last: int


@dataclass
class Group:
    """A row group of a file, by its footer: its range of ``seq``, and how many events it has."""

    path: str
    index: int
    low: int
    high: int
    rows: int


class _Feed:
    """What the footers of a folder say. Footers are read once a file."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.start = int(options["start_seq"]) if options.get("start_seq") else None
        self.until = int(options["until_seq"]) if options.get("until_seq") else None
        self.gapless = str(options.get("gapless", "false")).lower() == "true"
        self.footers: dict[tuple, list[Group]] = {}

    def files(self) -> tuple:
        from pyarrow import fs

        system, root = open_tree(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) \
            if system.get_file_info(root).type != fs.FileType.File else [system.get_file_info(root)]
        base = len(root.rstrip("/").split("/"))
        return system, [f for f in found if f.type == fs.FileType.File
                        and not any(part[:1] in "_." for part in f.path.split("/")[base:])]

    def groups(self) -> list[Group]:
        import pyarrow.parquet as pq

        system, files = self.files()
        known = {}
        for f in files:
            key = f.path, f.size, f.mtime_ns
            if key not in self.footers:
                with system.open_input_file(f.path) as handle:
                    self.footers[key] = [g for g in _ranges(f.path, pq.ParquetFile(handle)) if g.rows]
            known[key] = self.footers[key]
        self.footers = known
        return [g for groups in known.values() for g in groups]

    def first(self, groups: list[Group]) -> int:
        """The offset before the first event to take."""
        return self.start - 1 if self.start is not None else min((g.low for g in groups), default=0) - 1

    def last(self) -> int:
        """The last event there is to take."""
        groups = self.groups()
        first = self.first(groups)
        top = max((g.high for g in groups), default=first)
        if self.gapless:
            top = self._before_a_gap(first, groups)
        return max(first, top if self.until is None else min(top, self.until))

    def _before_a_gap(self, at: int, groups: list[Group]) -> int:
        """The last of the numbers that follow ``at`` without a gap. Numbers are read only of groups with holes."""
        runs = []
        for g in groups:
            if g.high <= at:
                continue
            if g.high - g.low + 1 == g.rows:
                runs.append((g.low, g.high))
            else:
                seqs = sorted(set(_seqs(self.path, g)))
                low = seqs[0]
                for a, b in zip(seqs, [*seqs[1:], None], strict=True):
                    if b != a + 1:
                        runs.append((low, a))
                        low = b
        for low, high in sorted(runs):
            if low > at + 1:
                break
            at = max(at, high)
        return at

    def events(self, after: int, last: int) -> list[Events]:
        return [Events(g.path, g.index, after, last) for g in self.groups() if g.low <= last and g.high > after]


def _ranges(path: str, file) -> Iterator[Group]:
    at = file.schema_arrow.names.index("seq")
    column = next(k for k in range(file.metadata.num_columns) if file.metadata.schema.column(k).path == "seq")
    for i in range(file.metadata.num_row_groups):
        group = file.metadata.row_group(i)
        stats = group.column(column).statistics
        if stats is not None and stats.has_min_max:
            yield Group(path, i, stats.min, stats.max, group.num_rows - (stats.null_count or 0))
        else:  # no statistics: the numbers themselves
            seqs = [s for s in file.read_row_group(i, columns=[file.schema_arrow.names[at]])["seq"].to_pylist()
                    if s is not None]
            if seqs:
                yield Group(path, i, min(seqs), max(seqs), len(seqs))


def _seqs(path: str, group: Group) -> list[int]:
    import pyarrow.parquet as pq

    system, _ = open_tree(path)
    with system.open_input_file(group.path) as handle:
        return [s for s in pq.ParquetFile(handle).read_row_group(group.index, columns=["seq"])["seq"].to_pylist()
                if s is not None]


def _read(path: str, part: Events, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    system, _ = open_tree(path)
    with system.open_input_file(part.path) as handle:
        file = pq.ParquetFile(handle)
        names = [n for n in schema.names if n in file.schema_arrow.names]
        for batch in file.iter_batches(batch_size=10_000, row_groups=[part.group], columns=names):
            table = pa.Table.from_batches([batch])
            table = table.filter(pc.and_(pc.greater(table["seq"], part.after), pc.less_equal(table["seq"], part.last)))
            if table.num_rows:
                columns = [table[n].cast(schema.field(n).type) if n in names else pa.nulls(table.num_rows, schema.field(n).type)
                           for n in schema.names]
                yield from pa.table(columns, schema=schema).to_batches()


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class FeedStream(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.feed, self.path = _arrow(schema), _Feed(options), options["path"]

    def initialOffset(self) -> dict:  # noqa: N802 - the interface's name
        return {"seq": self.feed.first(self.feed.groups())}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"seq": self.feed.last()}

    def partitions(self, start: dict, end: dict) -> list[Events]:
        return self.feed.events(start["seq"], end["seq"])

    def read(self, partition: Events) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition, self.schema)

    def commit(self, end: dict) -> None:
        """Nothing to give back: the feed keeps its events, the checkpoint keeps the position."""


class FeedBatch(DataSourceReader):
    """The same events as a batch: from ``start_seq`` to the last one."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.feed, self.path = _arrow(schema), _Feed(options), options["path"]

    def partitions(self) -> list[Events]:
        return self.feed.events(self.feed.first(self.feed.groups()), self.feed.last())

    def read(self, partition: Events) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition, self.schema)


class ChangeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return CHANGES_SCHEMA

    def streamReader(self, schema: T.StructType) -> FeedStream:  # noqa: N802
        return FeedStream(schema, dict(self.options))

    def reader(self, schema: T.StructType) -> FeedBatch:
        return FeedBatch(schema, dict(self.options))


def _loaded(spark: SparkSession, reader, path: str, options: dict) -> DataFrame:
    spark.dataSource.register(ChangeFeed)
    reader = reader.format(FORMAT)
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, str(value).lower() if isinstance(value, bool) else str(value))
    return reader.load(path)


def stream_feed(spark: SparkSession, path: str, start_seq: int | None = None, until_seq: int | None = None,
                gapless: bool = False) -> DataFrame:
    """V1: the change feed as a stream by ``seq``."""
    return _loaded(spark, spark.readStream, path, {"start_seq": start_seq, "until_seq": until_seq, "gapless": gapless})


def read_feed(spark: SparkSession, path: str, start_seq: int | None = None, until_seq: int | None = None,
              gapless: bool = False) -> DataFrame:
    """The events from ``start_seq`` on as a batch; no position moves (V5)."""
    return _loaded(spark, spark.read, path, {"start_seq": start_seq, "until_seq": until_seq, "gapless": gapless})
