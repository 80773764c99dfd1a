"""Work that follows one global order of all rows.

A window without PARTITION BY, or one over two or three keys, runs in as many
tasks as there are keys. Here the order is cut into ranges, which spreads even
one hot key or hot minute over all tasks; each task scans its range once; and
what a range needs from the ranges before it is worked out from one summary row
per range.

The borders of the ranges are taken from a sample once, when the query is built,
and are constants of the plan. So every pass, and every repeated task, deals the
rows out alike, and nothing has to be written in between.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

RANGE_COL = "_range"
ORDER_COL = "_order"
#: Sampled rows per range; the borders come to the driver, and this many rows for each.
SAMPLED = 20

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def total_order(df: DataFrame, by: Sequence[str]) -> list[Column]:
    """Order by the columns ``by``, nulls last; rows equal there follow a hash
    of their other columns, so that only exact copies are interchangeable."""
    return [*[F.col(c).asc_nulls_last() for c in by], *tie_break(df, by)]


def tie_break(df: DataFrame, by: Sequence[str]) -> list[Column]:
    """What else to sort by after the columns ``by``: a hash of the other columns."""
    rest = [c for c in df.columns if c not in by]
    return [F.xxhash64(*rest)] if rest else []


@dataclass(frozen=True)
class Ranges:
    """A cut of the order by ``by``, then ``ties``, into ``len(borders) + 1`` ranges."""

    by: tuple[str, ...]
    ties: tuple[str, ...]
    borders: tuple[tuple, ...]

    def number(self, df: DataFrame) -> DataFrame:
        """``df`` with ``ORDER_COL``, the sort key, and ``RANGE_COL``, the range's number."""
        keyed = df.withColumn(ORDER_COL, _order(df, self.by, self.ties))
        return keyed.withColumn(RANGE_COL, self._range(keyed.schema[ORDER_COL].dataType))

    def deal(self, df: DataFrame) -> DataFrame:
        """The same with a range per partition, each sorted; the last ties by all columns."""
        dealt = self.number(df).repartitionById(len(self.borders) + 1, F.col(RANGE_COL))
        return dealt.sortWithinPartitions(ORDER_COL, *tie_break(df, [*self.by, *self.ties]))

    def _range(self, kind: T.StructType) -> Column:
        """Number of borders at or below a row: bisection in one constant sorted array."""
        n = len(self.borders)
        if not n:
            return F.lit(0)
        names = kind.fieldNames()
        # As one text, so that the plan is built at once however many borders there are.
        text = json.dumps([dict(zip(names, b)) for b in self.borders], default=str)
        borders = F.from_json(F.lit(text), T.ArrayType(kind))
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])

        def step(found: Column, width: Column) -> Column:
            at = found + width
            return F.when((at <= n) & (F.get(borders, at - 1) <= F.col(ORDER_COL)), at).otherwise(found)

        # Never null, and seen to be: else a join on it would test it for null, down at the scan.
        return F.coalesce(F.aggregate(steps, F.lit(0), step), F.lit(0))


def _order(df: DataFrame, by: Sequence[str], ties: Sequence[str]) -> Column:
    """The sort key as one comparable value; nulls sort last."""
    parts = []
    for i, name in enumerate(by):
        value = F.col(name)
        if isinstance(df.schema[name].dataType, T.TimestampType):
            value = F.unix_micros(value)
        parts += [value.isNull().alias(f"n{i}"), value.alias(f"v{i}")]
    if ties:
        parts.append(F.xxhash64(*ties).alias("ties"))
    return F.struct(*parts)


def cut_ranges(df: DataFrame, by: Sequence[str], ties: Sequence[str] | None = None, per_partition: int = 1) -> Ranges:
    """Ranges of about equal size, ``per_partition`` of them for each shuffle partition.

    Rows equal in ``by`` are ordered by a hash of the columns ``ties`` (default: all
    others). Reads ``by`` and ``ties`` once, for a sample from every input partition.
    """
    ties = [c for c in df.columns if c not in by] if ties is None else list(ties)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = partitions * per_partition
    if partitions <= 1:
        return Ranges(tuple(by), tuple(ties), ())
    keys = df.select(_order(df, by, ties).alias(ORDER_COL))
    # Partitions differ in size, so each gives some more rows than its share, and its weight.
    each = max(SAMPLED, -(-3 * SAMPLED * parts // _partitions(keys, partitions)))
    schema = T.StructType([*keys.schema.fields, T.StructField("weight", T.DoubleType())])
    sample = [(tuple(r[0]), r[1]) for r in keys.mapInArrow(_sampled(each), schema).collect()]
    sample.sort(key=lambda r: _sortable(r[0]))
    ends = np.cumsum([w for _, w in sample])
    at = np.searchsorted(ends, ends[-1] * np.arange(1, parts) / parts) if sample else []
    return Ranges(tuple(by), tuple(ties), tuple(dict.fromkeys(sample[i][0] for i in at)))


def _partitions(df: DataFrame, shuffled: int) -> int:
    """Input partitions at least; those behind a shuffle are known only when it has run."""
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return max(1, shuffled // 4)
    return max(1, df.rdd.getNumPartitions())


def _sampled(most: int) -> Step:
    """``most`` rows of a partition, drawn evenly, each with the number of rows that it stands for."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, seen, kept, lots = np.random.default_rng(0), 0, None, np.zeros(0)
        for batch in batches:
            seen += batch.num_rows
            lot = draw.random(batch.num_rows)
            # Rows that cannot be among the least lots are dropped before they are copied.
            low = np.flatnonzero(lot < lots.max()) if len(lots) >= most else np.arange(len(lot))
            rows = pa.Table.from_batches([batch.take(pa.array(low))])
            kept, lots = (rows if kept is None else pa.concat_tables([kept, rows])), np.concatenate([lots, lot[low]])
            if len(lots) > most:
                least = np.argpartition(lots, most)[:most]
                kept, lots = kept.take(pa.array(least)), lots[least]
        if seen:
            kept = kept.append_column("weight", pa.array(np.full(len(lots), seen / len(lots))))
            yield from kept.combine_chunks().to_batches()

    return step


def _sortable(order: tuple) -> tuple:
    # A null value is told apart by the flag before it.
    return tuple((v is not None, v) if v is not None else (False,) for v in order)


def scan_ranges(df: DataFrame, ranges: Ranges, step: Step, added: Sequence[T.StructField]) -> DataFrame:
    """Run ``step`` over each sorted range; it appends the ``added`` columns."""
    dealt = ranges.deal(df).drop(ORDER_COL)
    return dealt.mapInArrow(step, T.StructType([*dealt.schema.fields, *added]))
