"""Chat formatting: fold logged events into messages, then render them.

``fold_events`` rebuilds conversations from an event log (conv_id, seq, turn,
kind, role, text). Sorted by ``seq`` within a conversation the kinds mean:

* ``message``: the turn's text so far is replaced, and the role set;
* ``delta``: the text is appended (a streamed piece);
* ``edit``: the text is replaced, the role stays;
* ``regenerate``: the turn's text is dropped, and with it every later turn logged
  so far; what follows streams in anew;
* ``retract``: the turn is dropped as it stands.

``render`` writes each turn between control strings, with control strings inside
texts escaped, and gives the span of the text that a loss is computed on.
``read_back`` inverts one rendered turn exactly.

Null texts are empty. A turn has the role of its last ``message`` that names one, else the
last role that any of its events names, as later pieces of a streamed turn often name
none; without any, the empty role. Null conversation ids are one conversation. A turn of
any length is put together by one task, which holds its pieces. Events of equal ``seq`` are taken in the order of kind, role and
text. Turns whose events are all dropped do not appear; an empty log gives no row.
Repeated delta events append twice: a log that repeats deliveries must be
de-duplicated first. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The control strings of the template.
BEGIN, END = "<s>", "</s>"
MARKS = {"user": "[INST] ", "assistant": "[/INST] ", "system": "[SYS] "}
OTHER, OTHER_END = "[ROLE] ", "[/ROLE] "
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[/ROLE]")

RESETS = ("message", "edit", "regenerate", "retract")
SAYING = ("message", "edit", "delta")
LOSS_ROLES = ("assistant",)

_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    r"<s>(?:(\[INST\]|\[/INST\]|\[SYS\]) |\[ROLE\] ((?:(?!\[/ROLE\]).)*)\[/ROLE\] )(.*)</s>", re.DOTALL
)
_ROLE_OF = {mark.strip(): role for role, mark in MARKS.items()}


def escape(text: Column) -> Column:
    """A backslash doubled; one put after the first character of each control string."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"(<)(?=/?s>)|(\[)(?=/?INST\]|SYS\]|/?ROLE\])", r"$1$2\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``turn``, ``role``, ``text``."""
    e = events.select(
        "conv_id", "seq", "turn", "kind", F.coalesce("role", F.lit("")).alias("role"), F.col("role").isNotNull().alias("names"),
        F.when(F.col("kind").isin(*SAYING), F.coalesce("text", F.lit(""))).otherwise("").alias("text"),
    )
    place = F.struct("seq", "kind", "role", "text")
    again = F.when(F.col("kind") == "regenerate", F.col("seq"))
    up_to = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"))
    turns = e.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("kind").isin(*RESETS), place)).alias("reset"),
        F.max(again).alias("again"),
        F.max(F.when(F.col("names") & (F.col("kind") == "message"), F.struct("seq", "role"))).alias("named"),
        F.max(F.when(F.col("names"), F.struct("seq", "role"))).alias("any"),
    )
    turns = turns.withColumn("floor", F.max("again").over(up_to.rowsBetween(Window.unboundedPreceding, -1)))
    turns = turns.select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), "reset", "floor", F.coalesce("named.role", "any.role", F.lit("")).alias("by")
    )
    live = e.join(turns, e.conv_id.eqNullSafe(turns.c) & e.turn.eqNullSafe(turns.t)).filter(
        (F.col("reset").isNull() | (place >= F.col("reset"))) & (F.col("floor").isNull() | (F.col("seq") > F.col("floor")))
    )
    parts = live.groupBy("conv_id", "turn").agg(
        F.first("by").alias("role"),
        F.max(F.col("kind").isin(*SAYING)).alias("said"),
        F.array_sort(F.collect_list(place)).alias("pieces"),
    )
    text = F.concat_ws("", F.transform("pieces", lambda p: p["text"]))
    return parts.filter("said").select("conv_id", "turn", "role", text.alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Each message as ``formatted``, with ``loss_start`` and ``loss_end`` in it.

    The span is that of the escaped text of a turn whose role is in
    ``loss_roles``; other turns have an empty span at their end. A conversation's
    rendering is its turns' one after another, in order of ``turn``.
    """
    mark = F.concat(F.lit(OTHER), escape(F.col("role")), F.lit(OTHER_END))
    for role, m in MARKS.items():
        mark = F.when(F.col("role") == role, F.lit(m)).otherwise(mark)
    head = F.concat(F.lit(BEGIN), mark)
    body = escape(F.col("text"))
    whole = F.concat(head, body, F.lit(END))
    learned = F.col("role").isin(*loss_roles)
    size = F.char_length(whole)
    return messages.select(
        "conv_id",
        "turn",
        whole.alias("formatted"),
        F.when(learned, F.char_length(head)).otherwise(size).alias("loss_start"),
        F.when(learned, size - len(END)).otherwise(size).alias("loss_end"),
    )


def read_back(formatted: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a rendered turn")
    mark, role, text = found.groups()
    return (_ROLE_OF[mark] if mark else unescape(role)), unescape(text)


def digest(rendered: DataFrame) -> DataFrame:
    """What the rendered turns hold, read back turn by turn, per conversation.

    Conversations are dealt out by id and sorted, and a task keeps only running
    hashes, so a conversation of any length takes constant memory.
    """
    id_field = rendered.schema["conv_id"]
    schema = T.StructType(
        [
            T.StructField("conv_id", id_field.dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    names = schema.fieldNames()

    def run(batches):
        now, state, done = None, None, []

        def close():
            done.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if now != (conv,):
                    if now is not None:
                        close()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_back(text)
                learned = unescape(text[a:b])
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema=arrow)
                done = []
        if now is not None:
            close()
            yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema=arrow)

    arrow = to_arrow_schema(schema)
    return (
        rendered.repartition("conv_id")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"))
        .mapInArrow(run, schema)
    )
