"""Running baselines of rows that wait for the watermark, as pieces packed by all tasks.

A dataset type's rows are scored one after another, so one task does that. It gets no rows,
but pieces: the rows of a type and hour that a task before it has packed, the few numbers
that baselines need apart from the rest. Waiting pieces are kept as they come; when the
watermark has passed an hour, only its numbers are unpacked. The rest goes on as it is,
beside its baselines, and all tasks unpack it again.

Rows behind the watermark are dropped one by one, as Spark drops those of its own operators:
by the watermark of the batch before. Spark tells a batch's own watermark alone, so every
group of types (``SLOTS`` of them, whether they have rows or not) notes it from the first
batch on; a timer wakes the group whenever the watermark moves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.baselines import BASELINE_COLS, default_measures, smoothed

#: Groups of dataset types; a stream keeps their number.
SLOTS = 64
#: Rows, or bytes, that are packed together, and rows that are scored together at least, unless fewer are due.
PIECE_ROWS, PIECE_BYTES, OUT_ROWS = 500_000, 256 << 20, 50_000
#: Bytes of pieces that go out together.
OUT_BYTES = 8 << 20
HOUR_MS = 3_600_000
_NEVER = 1 << 62
_PIECE = "slot int, of string, hour long, first long, time timestamp, keyed binary, rest binary"


def due_ms(at: np.ndarray) -> np.ndarray:
    """When the watermark, which is in whole milliseconds, has passed times in microseconds."""
    return -(-at // 1000)


def pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.BufferReader(bytes(data))) as stream:
        return stream.read_all()


def _part(data: bytes, mask: np.ndarray) -> bytes:
    return pack(unpack(data).filter(pa.array(mask)))


def _pieces(batches: list[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of a type and hour each; ``batches`` have the structs ``keyed`` and ``rest``."""
    keyed, rest = (pa.Table.from_batches([pa.RecordBatch.from_struct_array(b.column(i)) for b in batches]) for i in (0, 1))
    types = keyed.column("of").combine_chunks().dictionary_encode()
    codes, hours = types.indices.to_numpy(), due_ms(keyed.column("at").to_numpy()) // HOUR_MS
    order = np.lexsort((hours, codes))
    codes, hours = codes[order], hours[order]
    keyed, rest = keyed.drop_columns(["of"]).take(order), rest.take(order)
    starts = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (hours[1:] != hours[:-1])]))
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        some, of = keyed.slice(low, high - low), types.dictionary[int(codes[low])].as_py()
        ends = pc.min_max(some.column("at")).as_py()
        yield zlib.crc32(of.encode()) % SLOTS, of, int(hours[low]), ends["min"], ends["max"], pack(some), pack(rest.slice(low, high - low))


def _to_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def together(pieces: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.timestamp("us", "UTC"), pa.binary(), pa.binary())
        names = ["slot", "of", "hour", "first", "time", "keyed", "rest"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), kinds)], names=names)

    def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, size = [], 0
        for piece in _pieces(held):
            pieces.append(piece)
            size += len(piece[-1]) + len(piece[-2])
            if size >= OUT_BYTES:
                yield together(pieces)
                pieces, size = [], 0
        if pieces:
            yield together(pieces)

    # Every slot is there from the first batch on; what has no rows has no time.
    yield together([(slot, "", 0, 0, None, b"", b"") for slot in range(SLOTS)])
    held, n, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        size += batch.nbytes
        if n >= PIECE_ROWS or size >= PIECE_BYTES:
            yield from dealt(held)
            held, n, size = [], 0, 0
    if held:
        yield from dealt(held)


class _Held(StatefulProcessor):
    """Per slot the pieces that wait, the baselines of its types after their last scored rows, and the clock.

    ``mark`` is the watermark of the last batch that it moved in, ``due`` a time before
    which no row is due, ``piece`` the number of the next piece.
    """

    def __init__(self, alpha: float, names: list[str]):
        self.alpha, self.names = alpha, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getMapState("baselines", "of string", ", ".join(f"{n} double" for n in self.names))
        self.held = handle.getMapState("held", "hour long, piece long", "of string, keyed binary, rest binary")
        self.clock = handle.getValueState("clock", "mark long, due long, piece long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        begun = self.clock.exists()
        mark, due, piece = self.clock.get() if begun else (0, _NEVER, 0)
        before = piece
        for frame in rows:
            for of, hour, first, keyed, rest in zip(*(frame[c] for c in ("of", "hour", "first", "keyed", "rest"))):
                if not len(keyed):
                    continue
                hour, first, keyed, rest = int(hour), int(first), bytes(keyed), bytes(rest)
                if first <= mark * 1000:
                    at = unpack(keyed).column("at").to_numpy()
                    in_time = at > mark * 1000
                    if not in_time.any():
                        continue
                    first, keyed, rest = int(at[in_time].min()), _part(keyed, in_time), _part(rest, in_time)
                self.held.updateValue((hour, piece), (of, keyed, rest))
                piece, due = piece + 1, min(due, int(due_ms(first)))
        if piece > before or not begun:
            self.clock.update((mark, due, piece))
        if not begun:
            self.handle.registerTimer(mark + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        _, due, piece = self.clock.get()
        # Fires as soon as the watermark moves on.
        self.handle.registerTimer(mark + 1)
        if due <= mark:
            hours: dict[int, list[int]] = {}
            due = _NEVER
            for hour, number in self.held.keys():
                if hour * HOUR_MS <= mark:
                    hours.setdefault(hour, []).append(number)
                else:
                    due = min(due, hour * HOUR_MS)
            some, n = [], 0
            for hour in sorted(hours):
                for number in sorted(hours[hour]):
                    of, keyed, rest = self.held.getValue((hour, number))
                    keyed, rest = unpack(keyed), bytes(rest)
                    at = keyed.column("at").to_numpy()
                    now = at <= mark * 1000
                    if now.all():
                        self.held.removeKey((hour, number))
                    else:
                        due = min(due, int(due_ms(at[~now].min())))
                        if not now.any():
                            continue
                        self.held.updateValue((hour, number), (of, pack(keyed.filter(pa.array(~now))), _part(rest, ~now)))
                        keyed, rest = keyed.filter(pa.array(now)), _part(rest, now)
                    some.append((of, keyed, rest))
                    n += len(keyed)
                if n >= OUT_ROWS:
                    yield self._scored(some)
                    some, n = [], 0
            if some:
                yield self._scored(some)
        self.clock.update((mark, due, piece))

    def _scored(self, some: list[tuple[str, pa.Table, bytes]]) -> pd.DataFrame:
        """Pieces, all rows of their hours, with the baselines of their rows beside them."""
        types: dict[str, list[tuple[pa.Table, bytes]]] = {}
        for of, keyed, rest in some:
            types.setdefault(of, []).append((keyed, rest))
        out = []
        for of, pieces in types.items():
            rows = pa.concat_tables([keyed for keyed, _ in pieces])
            order = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("at", "query_id", "tie")]).to_numpy()
            values = np.column_stack([rows.column(f"x_{n}").to_numpy() for n in self.names])[order]
            # Without a value before start at the first x: a x + (1 - a) x = x.
            seed = np.array(self.last.getValue((of,)), dtype=float) if self.last.containsKey((of,)) else values[0]
            smooth = smoothed(values, np.array([0]), np.array([len(values)]), seed[None], self.alpha)
            self.last.updateValue((of,), tuple(float(v) for v in smooth[-1]))
            placed = np.empty_like(smooth)
            placed[order] = smooth
            low = 0
            for keyed, rest in pieces:
                high = low + len(keyed)
                baselines = pa.table({c: placed[low:high, i] for i, c in enumerate(BASELINE_COLS)})
                out.append((pc.min(keyed.column("at")).as_py(), rest, pack(baselines)))
                low = high
        first, rests, baselines = zip(*out)
        return pd.DataFrame({"time": pd.to_datetime(list(first), unit="us"), "rest": rests, "baselines": baselines})


def _to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rest, baselines in zip(batch.column(1), batch.column(2)):
            rows, more = unpack(rest.as_py()), unpack(baselines.as_py())
            yield from pa.Table.from_arrays([*rows.columns, *more.columns], names=[*rows.column_names, *more.column_names]).to_batches(OUT_ROWS)


def held_baselines(df: DataFrame, key: str, time: str, alpha: float, hold: str) -> DataFrame:
    """``df`` with its running baselines, each row once the watermark, ``hold`` behind the newest ``time``, has passed it."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    xs = {f"x_{n}": m.cast("double") for n, m in default_measures().items()}
    numbers = [x.alias(n) for n, x in xs.items()]
    # A type's text, also where it is null.
    of = F.to_json(F.struct(F.col(key).cast("string").alias("of")))
    keyed = F.struct(of.alias("of"), F.unix_micros(time).alias("at"), F.col("query_id").alias("query_id"), *numbers, F.xxhash64(*xs.values()).alias("tie"))
    rows = df.select(keyed.alias("keyed"), F.struct(*df.columns).alias("rest"))
    # An hour's rows of a type make one piece of a batch.
    rows = rows.repartition(tasks, F.col("keyed.of"), F.expr(f"keyed.at div {HOUR_MS * 1000}"))
    pieces = rows.mapInArrow(_to_pieces, _PIECE).withWatermark("time", hold)
    scored = pieces.groupBy("slot").transformWithStateInPandas(
        _Held(alpha, list(default_measures())), "time timestamp, rest binary, baselines binary", "Append", "EventTime", eventTimeColumnName="time"
    )
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in BASELINE_COLS]])
    back = scored.repartition(tasks).mapInArrow(_to_rows, schema)
    # What follows knows the watermark's column by its metadata, which unpacked columns lack.
    marked = F.col(time).alias(time, metadata=scored.schema["time"].metadata)
    return back.select(*[marked if c == time else F.col(c) for c in back.columns])
