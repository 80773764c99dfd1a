"""Topics as folders: messages with positions, written batch by batch, for sessions without a broker.

A topic is a folder. ``data`` holds Parquet files of messages, ``commits`` one small JSON
record per committed batch, numbered from 0: its files, the offset of each file's first
message, and the last batch number of every writer. Only what a record names is in the
topic. So a batch that failed leaves nothing, and a stream's batch that is repeated finds
its number and adds nothing.

Offsets run through a topic without gaps, in the order of records, of the writer's tasks
and of their rows; the partition is always 0. A topic takes one writer at a time: a second
one that wants the same number fails where the store can create files exclusively (local
folders), and must be kept away elsewhere. Readers need no lock.

``head.json`` names a recent record, so that neither side lists the folder. Anything that
``pyarrow.fs`` opens from the path will do.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pfs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "tidegauge_topics"
MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
STARTS = ("earliest", "latest")
_NAME = re.compile(r"[A-Za-z0-9._-]+")
_ROWS = 64 * 1024
#: Rows of a file that one task reads, as near as its row groups allow.
TASK_ROWS = 256 * 1024


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicSource)


def open_path(path: str) -> tuple[pfs.FileSystem, str]:
    """File system and path within it; a path without scheme is a local one."""
    if re.match(r"file:/[^/]", path):
        path = path[len("file:") :]
    return pfs.FileSystem.from_uri(path.rstrip("/"))


def topic_name(name: str | None) -> str:
    if name is None or not _NAME.fullmatch(name) or name.strip(".") == "":
        raise ValueError(f"not a topic: {name!r}")
    return name


class TopicLog:
    """The records of one topic."""

    def __init__(self, path: str):
        self.fs, self.path = open_path(path)

    def _record_path(self, number: int) -> str:
        return f"{self.path}/commits/{number:020d}.json"

    def _json(self, path: str) -> dict | None:
        try:
            with self.fs.open_input_stream(path) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def record(self, number: int) -> dict:
        found = self._json(self._record_path(number))
        if found is None:
            raise FileNotFoundError(f"topic {self.path} has lost record {number}")
        return found

    def size(self) -> int:
        """Number of records, counted on from the one that ``head.json`` names."""
        head = self._json(f"{self.path}/head.json")
        number = head["record"] + 1 if head else 0
        while self.fs.get_file_info(self._record_path(number)).type == pfs.FileType.File:
            number += 1
        return number

    def append(self, files: Sequence[tuple[str, int]], writer: str = "", batch: int | None = None) -> bool:
        """Commit ``(file, rows)`` in this order; false if the writer's batch is there already."""
        number = self.size()
        last = self.record(number - 1) if number else {"end": 0, "writers": {}}
        if batch is not None and last["writers"].get(writer, -1) >= batch:
            return False
        at, listed = last["end"], []
        for name, rows in files:
            listed.append([name, rows, at])
            at += rows
        writers = last["writers"] if batch is None else {**last["writers"], writer: batch}
        self._create(number, {"files": listed, "end": at, "writers": writers})
        with self.fs.open_output_stream(f"{self.path}/head.json") as f:
            f.write(json.dumps({"record": number}).encode())
        return True

    def _create(self, number: int, record: dict) -> None:
        path, text = self._record_path(number), json.dumps(record).encode()
        self.fs.create_dir(f"{self.path}/commits", recursive=True)
        part = f"{self.path}/commits/.{uuid.uuid4().hex}"
        if isinstance(self.fs, pfs.LocalFileSystem):
            # A link appears whole, and only where nothing is.
            with open(part, "wb") as f:
                f.write(text)
            try:
                os.link(part, path)
            except FileExistsError:
                raise RuntimeError(f"topic {self.path} has a second writer: record {number} is taken") from None
            finally:
                os.remove(part)
        else:
            with self.fs.open_output_stream(path) as f:
                f.write(text)


class _Files(WriterCommitMessage):
    """What one task wrote: topic -> file name and rows."""

    def __init__(self, task: int, files: dict[str, tuple[str, int]]):
        self.task, self.files = task, files


class _Writing:
    """Shared by the batch and the stream writer."""

    def __init__(self, root: str):
        self.root = root

    def _write(self, batches: Iterator[pa.RecordBatch]) -> _Files:
        from pyspark import TaskContext

        fs, root = open_path(self.root)
        writers: dict[str, pq.ParquetWriter] = {}
        files: dict[str, tuple[str, int]] = {}
        try:
            for batch in batches:
                topics = batch.column("topic")
                for name in pc.unique(topics).to_pylist():
                    topic_name(name)
                    values = batch.column("value").filter(pc.equal(topics, name))
                    table = pa.table({"value": values.cast(pa.string())})
                    if name not in writers:
                        file = f"{uuid.uuid4().hex}.parquet"
                        fs.create_dir(f"{root}/{name}/data", recursive=True)
                        writers[name] = pq.ParquetWriter(fs.open_output_stream(f"{root}/{name}/data/{file}"), table.schema, compression="zstd")
                        files[name] = (file, 0)
                    writers[name].write_table(table, row_group_size=_ROWS)
                    files[name] = (files[name][0], files[name][1] + len(table))
            for w in writers.values():
                w.close()
        except BaseException:
            self._delete([_Files(0, files)])
            raise
        context = TaskContext.get()
        return _Files(context.partitionId() if context else 0, files)

    def _delete(self, messages: Sequence[_Files | None]) -> None:
        fs, root = open_path(self.root)
        for message in messages:
            for topic, (file, _) in (message.files if message else {}).items():
                path = f"{root}/{topic}/data/{file}"
                if fs.get_file_info(path).type == pfs.FileType.File:
                    fs.delete_file(path)

    def _commit(self, messages: Sequence[_Files | None], writer: str = "", batch: int | None = None) -> None:
        done = sorted((m for m in messages if m), key=lambda m: m.task)
        for topic in sorted({t for m in done for t in m.files}):
            files = [m.files[topic] for m in done if topic in m.files]
            if not TopicLog(f"{self.root}/{topic}").append(files, writer, batch):
                self._delete([_Files(0, {topic: f}) for f in files])


class _BatchWriter(_Writing, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        return self._write(iterator)

    def commit(self, messages: list) -> None:
        self._commit(messages)

    def abort(self, messages: list) -> None:
        self._delete(messages)


class _StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def __init__(self, root: str, writer: str):
        super().__init__(root)
        self.writer = writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        return self._write(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self._commit(messages, self.writer, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._delete(messages)


class _File(InputPartition):
    """One of ``parts`` shares of a file whose first message has ``offset``."""

    def __init__(self, topic: str, path: str, offset: int, part: int = 0, parts: int = 1):
        super().__init__((topic, path, offset, part, parts))


def _planned(path: str, start: int, end: int) -> list[_File]:
    log, name = TopicLog(path), path.rstrip("/").rsplit("/", 1)[-1]
    out = []
    for n in range(start, end):
        for file, rows, at in log.record(n)["files"]:
            parts = max(1, -(-rows // TASK_ROWS))
            out += [_File(name, f"{path.rstrip('/')}/data/{file}", at, p, parts) for p in range(parts)]
    return out


def _read(part: InputPartition | None) -> Iterator[pa.RecordBatch]:
    if part is None:
        # What Spark asks for where nothing is planned.
        return
    topic, path, offset, number, parts = part.value
    fs, inner = open_path(path)
    with fs.open_input_file(inner) as f:
        file = pq.ParquetFile(f)
        sizes = [file.metadata.row_group(g).num_rows for g in range(file.num_row_groups)]
        # A row group belongs to the share in which it starts.
        starts = [0, *itertools.accumulate(sizes)]
        mine = [g for g in range(len(sizes)) if starts[g] * parts // max(1, starts[-1]) == number]
        offset += starts[mine[0]] if mine else 0
        for batch in file.iter_batches(_ROWS, row_groups=mine, columns=["value"]) if mine else ():
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(topic, n), pa.repeat(pa.scalar(0, pa.int32()), n), pa.array(range(offset, offset + n), pa.int64()), batch.column(0)],
                names=MESSAGE.fieldNames(),
            )
            offset += n


class _BatchReader(DataSourceReader):
    def __init__(self, paths: Sequence[str]):
        self.paths = paths

    def partitions(self) -> list[_File]:
        return [f for p in self.paths for f in _planned(p, 0, TopicLog(p).size())]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are records by topic path: a batch takes whole records."""

    def __init__(self, paths: Sequence[str], starting: str, most: int | None):
        self.paths, self.starting, self.most, self.at = paths, starting, most, None

    def initialOffset(self) -> dict:
        self.at = {p: TopicLog(p).size() if self.starting == "latest" else 0 for p in self.paths}
        return self.at

    def latestOffset(self) -> dict:
        if self.at is None:
            # A new stream that is asked for its end first: it begins here.
            self.initialOffset()
        end = {}
        for p in self.paths:
            log, n = TopicLog(p), self.at.get(p, 0)
            size = log.size()
            if self.most is None:
                n = size
            # Every topic gets its share, so that none waits for another.
            left = self.most and -(-self.most // len(self.paths))
            while left is not None and n < size and left > 0:
                left -= sum(rows for _, rows, _ in log.record(n)["files"])
                n += 1
            end[p] = n
        return end

    def partitions(self, start: dict, end: dict) -> list[_File]:
        # Also called with start = end, after a restart: that tells where the stream stands.
        self.at = end
        return [f for p in end for f in _planned(p, start.get(p, 0), end[p])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class TopicSource(DataSource):
    """Options of a reader: ``paths`` (a JSON list of topic folders), ``starting`` (earliest
    or latest), ``max_rows`` per batch of a stream (whole records, at least one). Of a
    writer of ``(topic, value)``: ``path``, the folder of the topics, and ``writer``, a
    name that the stream keeps over its restarts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return MESSAGE

    def _paths(self) -> list[str]:
        paths = json.loads(self.options["paths"])
        for p in paths:
            topic_name(p.rstrip("/").rsplit("/", 1)[-1])
        return paths

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BatchReader(self._paths())

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        most = self.options.get("max_rows")
        return _StreamReader(self._paths(), self.options.get("starting", "earliest"), int(most) if most else None)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("topics are appended to")
        return _BatchWriter(self.options["path"])

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options["path"], self.options["writer"])
