"""Captured logs as a data source of their own, for batch and stream.

    read_log(spark, "wal/", kinds=["B", "C"], after=position)
    stream_log(spark, "wal/", groups_per_batch=64, progress="state/progress.json")

The log is a folder of Parquet files with the columns of a captured message table,
whose names ascend as the log goes on. A task reads some row groups of one file.

* Bounds on the position and lists of sources and message kinds are options of the
  source. Its tasks leave out row groups by their statistics, and the rest of the rows
  before they reach Spark. (They are no pushed filters: Spark 4.1.2 keeps the filters
  pushed to a Python source with the loaded table, so that two queries on one
  DataFrame, or one with a union, answer with each other's filters.)
* A stream's offset is the last row group taken (file name and number). It starts after
  what is there when it starts first (``starting`` = ``latest``), or with everything
  (``earliest``); a restarted stream goes on from its checkpoint. A file that comes
  later must have a greater name. ``groups_per_batch`` admits so many row groups to a
  batch; Spark does not tell a Python source where its checkpoint stands, so what was
  planned is also kept in the file ``progress``, written before it is promised, and no
  offset ever goes back. Trigger ``availableNow`` then ends after one such batch.

Cases: an empty or missing folder has no rows; a null source, position or payload
stays unless a bound or list asks for it; a file without statistics is read; files whose
names begin with ``.`` or ``_`` are no log.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

LOG_FORMAT = "changefeed_log"
LOG_SCHEMA = "source string, lsn bigint, seq bigint, captured_at bigint, kind string, payload binary"

_STORED = ["source", "lsn", "seq", "captured_at", "payload"]
_TYPES = pa.schema([
    ("source", pa.string()), ("lsn", pa.int64()), ("seq", pa.int64()), ("captured_at", pa.int64()),
    ("kind", pa.string()), ("payload", pa.binary()),
])
# Bytes of a file for each task that reads it in a batch.
TASK_BYTES = 64 * 1024 * 1024


class _Groups(InputPartition):
    """Row groups of one file: those listed, or share ``part`` of ``parts`` of all."""

    def __init__(self, file: str, groups: list[int] | None = None, part: int = 0, parts: int = 1):
        self.file, self.groups, self.part, self.parts = file, groups, part, parts

    def of(self, total: int) -> list[int]:
        if self.groups is not None:
            return self.groups
        return list(range(self.part * total // self.parts, (self.part + 1) * total // self.parts))


class _Bounds:
    """What of a log is wanted: positions in (after, up_to], and lists of sources and kinds."""

    def __init__(self, options):
        self.after, self.up_to = (int(options[c]) if options.get(c) else None for c in ("after", "upTo"))
        self.lists = {c: json.loads(options[o]) for c, o in (("source", "sources"), ("kind", "kinds")) if options.get(o)}

    def may_hold(self, footer: pq.FileMetaData, group: int) -> bool:
        span = _span(footer, group, "lsn")
        if span is not None and (
            (self.after is not None and span[1] <= self.after) or (self.up_to is not None and span[0] > self.up_to)
        ):
            return False
        span = _span(footer, group, "source")
        return span is None or "source" not in self.lists or any(span[0] <= s <= span[1] for s in self.lists["source"])

    def rows(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        if self.after is not None:
            batch = batch.filter(pc.greater(batch.column("lsn"), self.after))
        if self.up_to is not None:
            batch = batch.filter(pc.less_equal(batch.column("lsn"), self.up_to))
        for column, values in self.lists.items():
            batch = batch.filter(pc.is_in(batch.column(column), value_set=pa.array(values, pa.string())))
        return batch


def _system(path: str):
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class _Log:
    """The files of a log in order, and reading row groups of them."""

    def __init__(self, options):
        self.path, self.bounds = options["path"], _Bounds(options)

    def sizes(self) -> list[tuple[str, int]]:
        """(name, bytes) of the log's files, in order."""
        system, root = _system(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(
            (f.base_name, f.size) for f in found
            if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and f.base_name[0] not in "._"
        )

    def files(self, after: str = "") -> list[str]:
        """Names of the log's files from ``after`` on, itself included."""
        return [name for name, _ in self.sizes() if name >= after]

    def footer(self, file: str) -> pq.FileMetaData:
        system, root = _system(self.path)
        with system.open_input_file(f"{root}/{file}") as source:
            return pq.ParquetFile(source).metadata

    def rows(self, part: _Groups):
        system, root = _system(self.path)
        with system.open_input_file(f"{root}/{part.file}") as source:
            opened = pq.ParquetFile(source)
            groups = [g for g in part.of(opened.num_row_groups) if self.bounds.may_hold(opened.metadata, g)]
            stored = [c for c in _STORED if c in opened.schema_arrow.names]
            for batch in opened.iter_batches(batch_size=8192, row_groups=groups, columns=stored):
                columns = {name: batch.column(name) for name in stored}
                columns["kind"] = pc.binary_slice(columns["payload"].cast(pa.binary()), 0, 1).cast(pa.string(), safe=False)
                whole = pa.RecordBatch.from_arrays(
                    [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(batch.num_rows, f.type) for f in _TYPES],
                    schema=_TYPES,
                )
                yield self.bounds.rows(whole)


def _span(footer: pq.FileMetaData, group: int, column: str):
    """(least, largest) of a column in a row group, or None if not stated."""
    for i in range(footer.num_columns):
        held = footer.row_group(group).column(i)
        if held.path_in_schema == column and held.statistics is not None and held.statistics.has_min_max:
            return held.statistics.min, held.statistics.max
    return None


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.log = _Log(options)

    def partitions(self):
        # footers are read in the tasks; only sizes are asked for here
        parts = [(file, -(-size // TASK_BYTES) or 1) for file, size in self.log.sizes()]
        found = [_Groups(file, None, i, n) for file, n in parts for i in range(n)]
        return found or [_Groups("")]  # no rows still need a task

    def read(self, partition):
        if partition.file:
            yield from self.log.rows(partition)


_NOTHING = {"file": "", "group": -1}


def _place(offset: dict) -> tuple[str, int]:
    return offset["file"], offset["group"]


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.log = _Log(options)
        self.starting = options.get("starting", "latest")
        if self.starting not in ("latest", "earliest"):
            raise ValueError(f"unknown start: {self.starting!r}")
        self.most = int(options["groupsPerBatch"]) if options.get("groupsPerBatch") else None
        self.progress = options.get("progress")
        if self.most and not self.progress:
            raise ValueError("groupsPerBatch needs a progress file")

    def _after(self, offset: dict) -> list[tuple[str, int]]:
        """Row groups that follow an offset, in order."""
        found = []
        for file in self.log.files(after=offset["file"]):
            first = offset["group"] + 1 if file == offset["file"] else 0
            found.extend((file, g) for g in range(first, self.log.footer(file).num_row_groups))
        return found

    def _end(self) -> dict:
        names = self.log.files()
        return {"file": names[-1], "group": self.log.footer(names[-1]).num_row_groups - 1} if names else _NOTHING

    def _kept(self) -> dict | None:
        """Where this stream began, and what was promised last."""
        system, file = _system(self.progress)
        if system.get_file_info(file).type != fs.FileType.File:
            return None
        with system.open_input_stream(file) as source:
            return json.loads(source.read())

    def _keep(self, first: dict, planned: dict) -> None:
        system, file = _system(self.progress)
        system.create_dir(file.rsplit("/", 1)[0])
        with system.open_output_stream(f"{file}.new") as target:
            target.write(json.dumps({"first": first, "planned": planned}).encode())
        system.move(f"{file}.new", file)

    def initialOffset(self):
        kept = self._kept() if self.most else None
        if kept:
            return kept["first"]
        return self._end() if self.starting == "latest" else _NOTHING

    def latestOffset(self):
        if not self.most:
            return self._end()
        first = self.initialOffset()
        kept = self._kept() or {"planned": first}
        ahead = self._after(kept["planned"])[: self.most]
        end = dict(zip(("file", "group"), ahead[-1])) if ahead else kept["planned"]
        self._keep(first, end)
        return end

    def partitions(self, start, end):
        by_file: dict[str, list[int]] = {}
        for file, group in self._after(start):
            if (file, group) <= _place(end):
                by_file.setdefault(file, []).append(group)
        return [_Groups(file, [g]) for file, groups in by_file.items() for g in groups]

    def read(self, partition):
        yield from self.log.rows(partition)


class CapturedLog(DataSource):
    """Format ``changefeed_log``."""

    @classmethod
    def name(cls) -> str:
        return LOG_FORMAT

    def schema(self):
        return LOG_SCHEMA

    def reader(self, schema):
        return _BatchReader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def _options(kinds, sources) -> dict[str, str]:
    lists = {"kinds": kinds, "sources": sources}
    return {name: json.dumps(list(values)) for name, values in lists.items() if values is not None}


def read_log(
    spark: SparkSession, path: str, kinds: Iterable[str] | None = None, sources: Iterable[str] | None = None,
    after: int | None = None, up_to: int | None = None,
) -> DataFrame:
    """The messages of a log with ``kind``, their type byte: some kinds and sources, positions in (after, up_to]."""
    spark.dataSource.register(CapturedLog)
    reader = spark.read.format(LOG_FORMAT).options(**_options(kinds, sources))
    for name, value in (("after", after), ("upTo", up_to)):
        reader = reader if value is None else reader.option(name, str(value))
    return reader.load(path)


def stream_log(
    spark: SparkSession, path: str, kinds: Iterable[str] | None = None, sources: Iterable[str] | None = None,
    starting: str = "latest", groups_per_batch: int | None = None, progress: str | None = None,
) -> DataFrame:
    """The same as a stream, from the log's end on unless ``starting`` is ``earliest``."""
    if groups_per_batch is not None and progress is None:
        raise ValueError("groups_per_batch needs a progress file")
    spark.dataSource.register(CapturedLog)
    reader = spark.readStream.format(LOG_FORMAT).options(**_options(kinds, sources)).option("starting", starting)
    if groups_per_batch is not None:
        reader = reader.option("groupsPerBatch", str(groups_per_batch)).option("progress", progress)
    return reader.load(path)
