"""Tables that a stream keeps up to date by parts, at a level cost per batch.

Each batch writes what it changes into a folder of its own, ``v=<batch>``, split by part (an
hour or a day of arrival), and then a small state file that names, for every part, the
folders that are its current content. The next batch and readers go by the state; no
folder is listed, and rows of untouched parts are not read.

A batch starts from the state of the batch before it, so one that is repeated after a
failure does the same work again. Folders that a state no longer names are kept for one
more batch, as a repeat may need them, and deleted then. A new checkpoint begins a new table.

The state has one entry per part. Batches and readers hold it on the driver: some hundred
kilobytes for a year of hours.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegauge import storage
from tidegauge.sources.sinks import write_partitions

PART_COL = "arrival_part"
VERSION_COL = "v"
# How long a span of time shares one part.
PART_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}
#: So many runs of one level become one of the next: a row is written again once per level.
RUNS = 8


def part_format(part: str) -> str:
    if part not in PART_FORMATS:
        raise ValueError(f"part must be one of {', '.join(PART_FORMATS)}")
    return PART_FORMATS[part]


class PartTable:
    """The state: ``{"parts": {part: [[version, level], ...]}, "gone": [[version, part], ...]}``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _state_path(self, batch: int) -> str:
        return f"{self.path}/state/{batch:020d}.json"

    def state(self, batch: int | None = None) -> dict:
        """The state after ``batch`` (default: the last one)."""
        if batch is None:
            names = [n for n in storage.file_names(self.spark, f"{self.path}/state") if n.endswith(".json")]
            batch = int(names[-1][: -len(".json")]) if names else -1
        text = storage.read_text(self.spark, self._state_path(batch)) if batch >= 0 else None
        if text is None and batch >= 0:
            raise FileNotFoundError(f"{self.path} has lost the state of batch {batch}")
        return json.loads(text) if text else {"parts": {}, "gone": []}

    def _folder(self, version: int, part: str) -> str:
        return f"{self.path}/{VERSION_COL}={version}/{PART_COL}={part}"

    def rows(self, runs: dict[str, list], schema: T.StructType | None = None) -> DataFrame:
        """The rows of the given runs, with their part."""
        schema = schema or self.schema
        folders = [self._folder(version, part) for part, of_part in runs.items() for version, _ in of_part]
        if not folders:
            if schema is None:
                raise ValueError(f"{self.path} is empty")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.path)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(VERSION_COL, T.LongType())]))
        return reader.parquet(*folders).withColumn(PART_COL, F.col(PART_COL).cast("string")).drop(VERSION_COL)

    def current(self) -> DataFrame:
        """All rows of the table as it is now, with their part."""
        return self.rows(self.state()["parts"])

    def _commit(self, batch: int, parts: dict, gone: list) -> None:
        before = self.state(batch - 1) if batch else {"gone": []}
        storage.write_text(self.spark, self._state_path(batch), json.dumps({"parts": parts, "gone": gone}))
        # What the batch before gave up is needed by no repeat any more.
        for version, part in before["gone"]:
            storage.delete(self.spark, self._folder(version, part))
        for old in (batch - 2, batch - 3):
            if old >= 0:
                storage.delete(self.spark, self._state_path(old))

    def _write(self, rows: DataFrame, batch: int, sort_cols: Sequence[str]) -> None:
        write_partitions(rows, f"{self.path}/{VERSION_COL}={batch}", [PART_COL], sort_cols)

    def _touched(self, rows: DataFrame) -> list[str]:
        # Names of parts: as many as hours or days that the batch has rows of.
        return sorted(r[0] for r in rows.select(PART_COL).distinct().collect())

    def merge(
        self, batch: int, fresh: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame], sort_cols: Sequence[str]
    ) -> None:
        """Replace the parts of ``fresh`` by ``merged(their rows, fresh)``; the others stay."""
        before = self.state(batch - 1)["parts"] if batch else {}
        touched = self._touched(fresh)
        old = {p: before[p] for p in touched if p in before}
        self._write(merged(self.rows(old, fresh.schema), fresh), batch, sort_cols)
        gone = [[version, p] for p, runs in old.items() for version, _ in runs]
        self._commit(batch, {**before, **{p: [[batch, 0]] for p in touched}}, gone)

    def append(self, batch: int, fresh: DataFrame, sort_cols: Sequence[str]) -> None:
        """Add rows; a part's runs of one level are written together when they are ``RUNS``."""
        before = self.state(batch - 1)["parts"] if batch else {}
        touched = self._touched(fresh)
        after, joined = dict(before), {}
        for p in touched:
            runs = [*before.get(p, []), [batch, 0]]
            while len(runs) >= RUNS and len({level for _, level in runs[-RUNS:]}) == 1:
                joined.setdefault(p, []).extend(r for r in runs[-RUNS:] if r[0] != batch)
                runs = [*runs[:-RUNS], [batch, runs[-1][1] + 1]]
            after[p] = runs
        rows = fresh if not joined else fresh.unionByName(self.rows(joined, fresh.schema))
        self._write(rows, batch, sort_cols)
        self._commit(batch, after, [[version, p] for p, runs in joined.items() for version, _ in runs])
