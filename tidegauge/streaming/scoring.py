"""Running baselines and scores as a stateful operator, which other stream operators can follow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.baselines import BASELINE_COLS, DEFAULT_ALPHA, baseline_scores, default_measures, smoothed
from tidegauge.streaming.holding import held_baselines

KEY, TIME = "dataset_type", "arrival_timestamp"
#: Events from here on would take the watermark past all that follow.
FAR_FUTURE = "2262-01-01 00:00:00"
#: Waiting rows that are dealt to hours together, and rows of a frame that goes out.
PIECE_ROWS, OUT_ROWS = 500_000, 50_000
HOUR_MS = 3_600_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State variables need the RocksDB state store; a stream keeps the store that it began with."""
    spark.conf.set(_PROVIDER, _ROCKSDB)


class _Baselines(StatefulProcessor):
    """Per key the baselines after the last scored row, and rows that wait for the watermark.

    Streams that hold rows take ``holding._Held``, which gets them packed; this form gets them one by one.
    Waiting rows are pieces by the hour of their time, each packed, so that an hour's rows are
    held when it is due and no others.
    """

    def __init__(self, alpha: float, hold: bool, names: list[str], out: list[str]):
        self.alpha, self.hold, self.names, self.out = alpha, hold, names, out
        texts = [(KEY, pa.string()), (TIME, pa.timestamp("ns")), ("at", pa.int64()), ("query_id", pa.string()), ("rest", pa.string())]
        self.schema = pa.schema([*texts, *[(f"x_{n}", pa.float64()) for n in names], ("tie", pa.int64())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("baselines", ", ".join(f"{n} double" for n in self.names))
        if self.hold:
            self.held = handle.getMapState("held", "hour long, piece long", "rows binary")
            self.pieces = handle.getValueState("pieces", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tables, n = [], 0
        for frame in rows:
            # Arrow holds the texts in a fraction of what pandas takes.
            tables.append(pa.Table.from_pandas(frame, schema=self.schema, preserve_index=False))
            n += len(frame)
            if self.hold and n >= PIECE_ROWS:
                self._keep(pa.concat_tables(tables))
                tables, n = [], 0
        if not n:
            return
        if self.hold:
            self._keep(pa.concat_tables(tables))
        else:
            yield from self._scored(pa.concat_tables(tables))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held: dict[int, list[int]] = {}
        for hour, piece in self.held.keys() if self.held.exists() else ():
            held.setdefault(hour, []).append(piece)
        for hour in sorted(held):
            if hour * HOUR_MS > mark:
                self.handle.registerTimer(hour * HOUR_MS)
                return
            rows = pa.concat_tables([_unpacked(self.held.getValue((hour, p))[0]) for p in held[hour]])
            due = pc.less_equal(rows.column("at"), mark * 1000)
            rest = rows.filter(pc.invert(due))
            if len(rest) < len(rows):
                for piece in held[hour]:
                    self.held.removeKey((hour, piece))
                yield from self._scored(rows.filter(due))
                self._keep(rest)
            elif len(rest):
                self._wake(rest)

    def _keep(self, rows: pa.Table) -> None:
        if not len(rows):
            return
        hours = _due_ms(rows) // HOUR_MS
        order = np.argsort(hours, kind="stable")
        starts = np.flatnonzero(np.diff(hours[order], prepend=hours[order[0]] - 1))
        piece = self.pieces.get()[0] if self.pieces.exists() else 0
        for low, high in zip(starts, [*starts[1:], len(order)]):
            self.held.updateValue((int(hours[order[low]]), piece), (_packed(rows.take(order[low:high])),))
            piece += 1
        self.pieces.update((piece,))
        self._wake(rows)

    def _wake(self, rows: pa.Table) -> None:
        # A timer set twice fires once.
        self.handle.registerTimer(int(_due_ms(rows).min()))

    def _scored(self, rows: pa.Table) -> Iterator[pd.DataFrame]:
        order = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("at", "query_id", "tie")])
        before = self.last.get() if self.last.exists() else None
        for low in range(0, len(rows), OUT_ROWS):
            some = rows.take(order.slice(low, OUT_ROWS))
            values = np.column_stack([some.column(f"x_{n}").to_numpy() for n in self.names])
            # Without a value before start at the first x: a x + (1 - a) x = x.
            seed = values[0] if before is None else np.array(before, dtype=float)
            smooth = smoothed(values, np.array([0]), np.array([len(values)]), seed[None], self.alpha)
            before = tuple(float(v) for v in smooth[-1])
            self.last.update(before)
            frame = some.select([c for c in self.out if c in self.schema.names]).to_pandas()
            for i, name in enumerate(self.names):
                frame[f"{name}_baseline"] = smooth[:, i]
            yield frame[self.out]


def _due_ms(rows: pa.Table) -> np.ndarray:
    """When the watermark, which is in whole milliseconds, has passed the rows."""
    return -(-rows.column("at").to_numpy() // 1000)


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.BufferReader(bytes(data))) as stream:
        return stream.read_all()


def _as_text(name: str, kind: T.DataType) -> Column:
    """A value as text that gives the same value back, whatever pandas makes of its type."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("string")
    if not isinstance(kind, T.AtomicType):
        raise ValueError(f"column {name} cannot be carried through the state: {kind.simpleString()}")
    return F.col(name).cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(text.cast("bigint")) if isinstance(kind, T.TimestampType) else text.cast(kind)


def stream_scored(df: DataFrame, alpha: float = DEFAULT_ALPHA, hold: str | None = None) -> DataFrame:
    """Score a stream of canonical events with ``dataset_type`` against running baselines.

    A stateful operator: its result is a stream again, for ``stream_rollup``,
    ``route_topics`` or any sink. The state is five numbers per dataset type, and survives
    restarts with the checkpoint; a batch that is repeated starts from the state before it.

    Without ``hold`` a batch's rows are scored at once, in order of arrival time and query
    id within the batch; across batches the order is that of the stream. With ``hold``, a
    duration, a row waits until the watermark, so far behind the newest arrival, has passed
    it: then the order is that of ``scored_events`` over all rows, however the stream was
    cut. Rows behind the watermark are dropped, as are those from 2262 on, which would end
    it; ``arrival_timestamp`` has the watermark then, so what follows must not set one.

    One task scores all rows of a dataset type, batch by batch. With ``hold`` it gets them packed
    by the hour and unpacks only the numbers of the hours that are due (see ``holding``). Without,
    all other columns go through it as one text, and it holds a batch's rows. The scored rows
    are dealt to all tasks again. Bound batches by the source (``max_per_trigger``). For many rows at once the range scan
    (``scored_events``, ``tables.stream_baselines``) spreads one type over all tasks.
    """
    if not 0.0 < alpha <= 1.0:
        raise ValueError("alpha must be above 0 and at most 1")
    use_rocksdb(df.sparkSession)
    if hold is not None:
        due = df.filter(F.col(TIME) < F.lit(FAR_FUTURE).cast("timestamp"))
        return baseline_scores(held_baselines(due, KEY, TIME, alpha, hold))
    kinds = {f.name: f.dataType for f in df.schema}
    measures = default_measures()
    names = list(measures)
    # Spark hands rows over as named tuples, so names must be plain ones.
    carried = {c: f"c{i}" for i, c in enumerate(c for c in df.columns if c not in (KEY, TIME, "query_id"))}
    xs = {f"x_{n}": m.cast("double") for n, m in measures.items()}
    # Without a watermark the time is not needed as such; pandas ends in 2262.
    time = F.lit(None).cast("timestamp").alias(TIME)
    texts = [_as_text(c, kinds[c]).alias(n) for c, n in carried.items()]
    rest = F.to_json(F.struct(*texts), {"ignoreNullFields": "false"}) if texts else F.lit("{}")
    rows = df.select(
        KEY, time, F.unix_micros(TIME).alias("at"), "query_id", rest.alias("rest"),
        *[x.alias(n) for n, x in xs.items()], F.xxhash64(*xs.values()).alias("tie"),
    )
    out = T.StructType(
        [
            T.StructField(KEY, kinds[KEY]),
            T.StructField(TIME, T.TimestampType()),
            T.StructField("at", T.LongType()),
            T.StructField("query_id", T.StringType()),
            T.StructField("rest", T.StringType()),
            *[T.StructField(c, T.DoubleType()) for c in BASELINE_COLS],
        ]
    )
    processor = _Baselines(alpha, False, names, out.fieldNames())
    scored = rows.groupBy(KEY).transformWithStateInPandas(processor, out, "Append", "None")
    # What follows is the work of all tasks, not of one for each dataset type.
    scored = scored.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fields = T.StructType([T.StructField(n, T.StringType()) for n in carried.values()])
    if carried:
        scored = scored.withColumn("rest", F.from_json("rest", fields))
    back = {
        KEY: F.col(KEY),
        TIME: F.timestamp_micros("at").alias(TIME),
        "query_id": F.col("query_id"),
        **{c: _from_text(F.col(f"rest.{n}"), kinds[c]).alias(c) for c, n in carried.items()},
    }
    return baseline_scores(scored.select(*[back[c] for c in df.columns], *BASELINE_COLS))
