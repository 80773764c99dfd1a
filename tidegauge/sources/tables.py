"""Parquet sources, batch and stream."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegauge.operators.ordered import total_order
from tidegauge.sources.row_groups import stream_row_groups

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _identifier(name: str) -> str:
    name = name.strip()
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a column name: {name!r}")
    return name


def scan_event_time_order(df: DataFrame, event_time_col: str = "arrival_timestamp") -> DataFrame:
    """Rows by event time, those without one last."""
    return df.orderBy(F.col(event_time_col).asc_nulls_last())


def scan_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    event_time_col: str = "arrival_timestamp",
    ordered: bool = True,
) -> DataFrame:
    """Rows of Parquet files, on request some columns only, and in time order.

    Ordering adds the event time to ``columns`` when it is missing. Leave it
    off unless the order itself is wanted: it costs a shuffle.
    """
    if not path or (isinstance(path, str) and not path.strip()):
        raise ValueError("path is required")
    event_time_col = _identifier(event_time_col)
    df = spark.read.parquet(*([path.strip()] if isinstance(path, str) else path))
    if columns:
        wanted = [_identifier(c) for c in columns if c and c.strip()]
        if ordered and event_time_col not in wanted:
            wanted.insert(0, event_time_col)
        df = df.select(*dict.fromkeys(wanted)) if wanted else df
    return scan_event_time_order(df, event_time_col) if ordered else df


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int = 1,
    max_rows: int | None = None,
) -> DataFrame:
    """The same rows as a stream of bounded batches.

    A batch takes some files whole. With ``max_rows`` it takes row groups instead, up to
    about as many rows, so that one large file makes several batches; then ``path`` is a
    file or folder, not a pattern, and a trigger that takes what is available once takes
    one batch (see ``row_groups``).
    """
    if max_files_per_trigger <= 0:
        raise ValueError("max_files_per_trigger must be > 0")
    schema = schema or spark.read.parquet(path).schema
    if max_rows is not None:
        return stream_row_groups(spark, path, schema, max_rows)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def limit_events(df: DataFrame, max_events: int | None) -> DataFrame:
    """The first ``max_events`` rows by arrival and query id, in that order; all when None.

    One plan for every number: a top-k up to ``spark.sql.execution.topKSortFallbackThreshold``
    rows, beyond it Spark's sort by ranges with a limit.
    """
    if max_events is None:
        return df
    if max_events <= 0:
        raise ValueError("max_events must be > 0")
    return df.orderBy(*total_order(df, ["arrival_timestamp", "query_id"])).limit(max_events)


def union_typed_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One table out of several, each row marked with its source's name as
    ``dataset_type``; columns that a source lacks are null."""
    if not sources:
        raise ValueError("at least one source is required")
    typed = [df.withColumn("dataset_type", F.lit(name)) for name, df in sources.items()]
    out = typed[0]
    for df in typed[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
