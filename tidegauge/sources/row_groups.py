"""Parquet files as a stream of bounded batches, also out of one large file.

Spark's file source hands a file over whole. Here an offset names a place between two row
groups: the modification time and name of a file, and the row groups taken of it. A batch
takes whole row groups, at least one, up to about ``max_rows`` rows; neighbours of one file
share a task, of up to ``TASK_ROWS`` rows unless a single one has more. A restart goes on at
the row group where the stream stood.

Files are taken by modification time, then name. They must appear whole, and later ones
with a later time, as writers that rename finished files do; a file that appears with an
earlier time than one already taken is not seen. A trigger lists the folder, and reads the
footers of the files that it takes from, each once (the last ``FOOTERS`` are kept). Anything
that ``pyarrow.fs`` opens will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pfs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.sources.topics import open_path

FORMAT = "tidegauge_row_groups"
_ROWS = 64 * 1024
#: Rows of a task, and files whose row groups' sizes the driver keeps.
TASK_ROWS, FOOTERS = 128 * 1024, 64


def stream_row_groups(spark: SparkSession, path: str, schema: T.StructType, max_rows: int) -> DataFrame:
    """The rows of the Parquet files under ``path``, in batches of about ``max_rows``."""
    if max_rows <= 0:
        raise ValueError("max_rows must be > 0")
    spark.dataSource.register(RowGroupSource)
    reader = spark.readStream.format(FORMAT).schema(schema)
    return reader.option("path", path).option("max_rows", max_rows).load()


class _Groups(InputPartition):
    """Row groups of one file, from the first to before the last."""

    def __init__(self, path: str, first: int, last: int):
        super().__init__((path, first, last))


def _shared(path: str, rows: list[int], low: int, high: int) -> list[_Groups]:
    """The row groups from ``low`` to before ``high``, dealt to tasks in order."""
    out, first, held = [], low, 0
    for g in range(low, high):
        if held and held + rows[g] > TASK_ROWS:
            out.append(_Groups(path, first, g))
            first, held = g, 0
        held += rows[g]
    return [*out, _Groups(path, first, high)] if first < high else out


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, most: int, schema: T.StructType):
        self.path, self.most, self.schema, self.at = path, most, schema, None
        self.sizes: dict[tuple[int, str], list[int]] = {}

    def _files(self) -> list[tuple[int, str]]:
        fs, inner = open_path(self.path)
        info = fs.get_file_info(inner)
        found = [info] if info.type == pfs.FileType.File else fs.get_file_info(pfs.FileSelector(inner, recursive=True, allow_not_found=True))
        hidden = lambda f: any(p[:1] in "._" for p in f.path[len(inner) :].split("/") if p)
        return sorted((f.mtime_ns or 0, f.path) for f in found if f.type == pfs.FileType.File and f.path.endswith(".parquet") and not hidden(f))

    def _groups(self, time: int, path: str) -> list[int]:
        """Rows of each row group."""
        if (time, path) not in self.sizes:
            with open_path(self.path)[0].open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
                self.sizes[time, path] = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
            while len(self.sizes) > FOOTERS:
                del self.sizes[next(iter(self.sizes))]
        return self.sizes[time, path]

    def initialOffset(self) -> dict:
        self.at = {"time": 0, "name": "", "groups": 0}
        return self.at

    def latestOffset(self) -> dict:
        if self.at is None:
            self.initialOffset()
        end, left = dict(self.at), self.most
        for time, name in self._files():
            if left <= 0:
                break
            if (time, name) < (end["time"], end["name"]):
                continue
            done = end["groups"] if (time, name) == (end["time"], end["name"]) else 0
            for rows in self._groups(time, name)[done:]:
                if left <= 0:
                    break
                done, left = done + 1, left - rows
            end = {"time": time, "name": name, "groups": done}
        return end

    def partitions(self, start: dict, end: dict) -> list[_Groups]:
        self.at = end
        first, last, out = (start["time"], start["name"]), (end["time"], end["name"]), []
        for time, name in self._files() if start != end else ():
            if first <= (time, name) <= last:
                rows = self._groups(time, name)
                low = start["groups"] if (time, name) == first else 0
                high = end["groups"] if (time, name) == last else len(rows)
                out += _shared(name, rows, low, high)
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        name, first, last = partition.value
        wanted = to_arrow_schema(self.schema)
        with open_path(self.path)[0].open_input_file(name) as f:
            file = pq.ParquetFile(f)
            there = [c for c in wanted.names if c in file.schema_arrow.names]
            for batch in file.iter_batches(_ROWS, row_groups=list(range(first, last)), columns=there):
                # A column that the file lacks is null.
                columns = [batch.column(n).cast(wanted.field(n).type) if n in there else pa.nulls(len(batch), wanted.field(n).type) for n in wanted.names]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class RowGroupSource(DataSource):
    """Options: ``path`` and ``max_rows``; the schema must be given."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("give a schema")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options["max_rows"]), schema)
