"""Structure repair of conversations: the cheapest edits to legal turns, with their audit.

A conversation is legal if its role initials are ``(s?(ua)+)?``. Each row may be kept (0),
given the role user or assistant (2) or deleted (3), and empty user or assistant turns may
be inserted anywhere (2); a truncated row that stays costs 1 more, a blank or a duplicate
one must go. The audit is the edits' initials (K, R, D, I) in order; of the cheapest ones
the least in ASCII order. What an edit does follows from the turns before it, so the audit
alone rebuilds the conversation.

The edits are found by a dynamic program over rows and the four states of the pattern.
Audits are not copied: each is a node of a tree (``Audits``) that shares its prefix with
others and has a rolling hash and jump pointers, binary lifting with two ancestors a node.
Of two audits of equal cost the lesser is found by searching their longest common prefix;
prefixes of equal hash on different nodes are compared for good.

A conversation of any length spreads over tasks. Rows are sorted into ranges of
(conversation, turn), and each range gives for every conversation in it, per stretch of
at most ``STRETCH`` rows, the cheapest audit from each state to each state. Such tables
are put together in order by the task that reads the conversation's texts once more,
in constant memory, to write the repaired turns; only the audit itself is held whole.

Rows follow their turn, nulls first; rows of one turn follow role, a hash of the text, and
text. A null role or text is one space; null ids are one conversation. Equal rows are
duplicates from the second on. Texts are taken whole. A conversation without rows left has
an empty audit, an empty table gives none, and other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.llm.common import stored, type_of

# Costs, and what counts as a blank, a word's sign and an end of a sentence.
RELABEL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
INK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
#: States: nothing yet, a system turn, a user turn, an assistant turn behind.
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL_ENDS = (START, ASSISTANT)
#: Rows of one stretch at most: what a task holds as a tree of audits.
STRETCH = 20_000

_PRIME, _BASE = (1 << 61) - 1, 0x5BD1E9955BD1E995 % ((1 << 61) - 1)
#: The range that a row of ``sorted_rows`` is in: the number of the task that wrote it.
_RANGE = "row >> 33"
_NONE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)


class Audits:
    """Sequences of labels that share their prefixes; node 0 is the empty one."""

    def __init__(self, hashed=lambda label: hash(label) & _PRIME):
        self.parent, self.jump, self.depth, self.hash, self.label = [0], [0], [0], [0], [""]
        self._hashed = hashed

    def add(self, node: int, label: str) -> int:
        parent, jump, depth = self.parent, self.jump, self.depth
        far = jump[node]
        # The jumps of a node and its ancestor are of equal length: join them.
        jump.append(jump[far] if depth[node] - depth[far] == depth[far] - depth[jump[far]] else node)
        parent.append(node)
        depth.append(depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + self._hashed(label) + 1) % _PRIME)
        self.label.append(label)
        return len(parent) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            far = self.jump[node]
            node = far if self.depth[far] >= depth else self.parent[node]
        return node

    def labels(self, node: int, above: int = 0) -> list[str]:
        """The labels from below ``above``, an ancestor, through ``node``."""
        out = []
        while node != above:
            out.append(self.label[node])
            node = self.parent[node]
        return out[::-1]

    def text(self, node: int) -> str:
        return "".join(self.labels(node))

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` is below that of ``b``."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] != self.hash[y]:
            # The last nodes above which all is equal, as far as hashes tell.
            while self.hash[self.parent[x]] != self.hash[self.parent[y]]:
                if self.hash[self.jump[x]] != self.hash[self.jump[y]]:
                    x, y = self.jump[x], self.jump[y]
                else:
                    x, y = self.parent[x], self.parent[y]
            p, q = self.label[x], self.label[y]
            x, y = self.parent[x], self.parent[y]
        else:
            p = q = ""
        if not self._same(x, y):
            return self.text(a) < self.text(b)
        if p and q and not p.startswith(q) and not q.startswith(p):
            return p < q
        return "".join(self.labels(a, x)) < "".join(self.labels(b, y))

    def _same(self, x: int, y: int) -> bool:
        while x != y:
            if self.label[x] != self.label[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True


def _node(audits: Audits, node: int, label: str) -> int:
    return audits.add(node, label) if label else node


def _better(audits: Audits, best: tuple | None, cost: int, node: int, label: str) -> tuple:
    """The cheaper of ``best`` and ``node`` prolonged by ``label``; of equals the lesser."""
    if best is None or cost < best[0]:
        return cost, node, label
    if cost > best[0] or (node == best[1] and label >= best[2]):
        return best
    if node != best[1] and not audits.less(_node(audits, node, label), _node(audits, best[1], best[2])):
        return best
    return cost, node, label


def _grown(audits: Audits, best: list[tuple | None]) -> list[tuple[int, int] | None]:
    """The chosen prolongations as nodes."""
    return [None if b is None else (b[0], _node(audits, b[1], b[2])) for b in best]


def _with_inserts(audits: Audits, now: list[tuple[int, int] | None]) -> list[tuple[int, int] | None]:
    """What empty turns put in at this place reach, at no more than two of them."""
    for to, froms in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        best = None if now[to] is None else (*now[to], "")
        for s in froms:
            if now[s] is not None:
                best = _better(audits, best, now[s][0] + INSERT, now[s][1], "I")
        now = [*now[:to], *_grown(audits, [best]), *now[to + 1 :]]
    return now


def _after_row(audits: Audits, now: list[tuple[int, int] | None], initial: str, fault: int) -> list[tuple[int, int] | None]:
    best: list[tuple | None] = [None] * 4
    more = TRUNCATED if fault == _TRUNCATED else 0
    for s, at in enumerate(now):
        if at is None:
            continue
        cost, node = at
        best[s] = _better(audits, best[s], cost + DELETE, node, "D")
        if fault in (_BLANK, _DUPLICATE):
            continue
        to, wanted = (ASSISTANT, "a") if s == USER else (USER, "u")
        if initial == wanted:
            best[to] = _better(audits, best[to], cost + more, node, "K")
        else:
            best[to] = _better(audits, best[to], cost + more + RELABEL, node, "R")
            if initial == "s" and s == START:
                best[SYSTEM] = _better(audits, best[SYSTEM], cost + more, node, "K")
    return _with_inserts(audits, _grown(audits, best))


class _Stretch:
    """The counts of consecutive rows of one conversation, and their cheapest audits."""

    def __init__(self, conv, first_row: int, starts: tuple[int, ...]):
        self.conv, self.row, self.audits, self.rows = conv, first_row, Audits(ord), 0
        self.now = {s: _with_inserts(self.audits, [(0, 0) if s == t else None for t in range(4)]) for s in starts}
        self.faults, self.illegal, self.first, self.last = [0] * 4, 0, None, None
        self.low = self.high = None
        self.turns = 0

    def take(self, turn: int | None, initial: str, fault: int) -> None:
        self.rows += 1
        self.faults[fault] += 1
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        for s, now in self.now.items():
            self.now[s] = _after_row(self.audits, now, initial, fault)

    def record(self) -> dict:
        paths = [
            {"source": s, "target": t, "cost": at[0], "audit": self.audits.text(at[1])}
            for s, now in self.now.items()
            for t, at in enumerate(now)
            if at is not None
        ]
        return {
            "conv_id": self.conv, "row": self.row, "rows": self.rows, "low": self.low, "high": self.high, "turns": self.turns,
            "blank": self.faults[_BLANK], "duplicate": self.faults[_DUPLICATE], "truncated": self.faults[_TRUNCATED],
            "illegal": self.illegal, "first": self.first, "last": self.last, "paths": paths,
        }


class _Report:
    """What the stretches of one conversation, in order, come to."""

    def __init__(self, conv):
        self.conv, self.audits = conv, Audits()
        self.now: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last = self.low = self.high = None
        self.turns = 0

    def take(self, stretch: dict) -> None:
        best: list[tuple | None] = [None] * 4
        for p in stretch["paths"]:
            if (at := self.now[p["source"]]) is not None:
                best[p["target"]] = _better(self.audits, best[p["target"]], at[0] + p["cost"], at[1], p["audit"])
        self.now = _grown(self.audits, best)
        for c in self.counts:
            self.counts[c] += stretch[c]
        if stretch["rows"]:
            if self.last is not None:
                self.counts["illegal"] += self.last + stretch["first"] not in ("su", "ua", "au")
            self.last = stretch["last"]
        if stretch["turns"]:
            self.turns += stretch["turns"] - (stretch["low"] == self.high)
            self.low, self.high = stretch["low"] if self.low is None else self.low, stretch["high"]

    def result(self) -> dict:
        best = None
        for s in LEGAL_ENDS:
            if self.now[s] is not None:
                best = _better(self.audits, best, *self.now[s], "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, **self.counts, "cost": best[0], "audit": self.audits.text(best[1])}


def sorted_rows(messages: DataFrame) -> DataFrame:
    """The rows in one order, stored: ``row`` (rising), ``conv_id``, ``turn``, ``kept``, ``role``, ``text``.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``text``, and maybe ``kept``:
    rows where it is false only stand for their conversation.
    """
    kept = F.coalesce(F.col("kept"), F.lit(False)) if "kept" in messages.columns else F.lit(True)
    rows = messages.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), kept.alias("kept"),
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    # Copies from different files may lie in different ranges, however many there are.
    keyed = rows.withColumns({"_hash": F.xxhash64("text"), "_from": F.spark_partition_id()})
    by = ["conv_id", "turn", "role", "_hash"]
    dealt = keyed.repartitionByRange(*by, "_from").sortWithinPartitions(*by, "text", "_from")
    return stored(dealt.select(F.monotonically_increasing_id().alias("row"), *rows.columns), "conversation-rows")


def _stretches(rows: DataFrame, most: int) -> DataFrame:
    """One row per stretch: counts, and the cheapest audits from state to state."""
    alive = rows.filter("kept").withColumn("_said", F.sha2("text", 256))
    # Of equal messages of a conversation the first by order; the others are duplicates.
    firsts = alive.groupBy("conv_id", "role", "_said").agg(F.min("row").alias("row"))
    place = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    blank = ~F.col("text").rlike(INK)
    narrow = rows.select(
        F.expr(_RANGE).alias("range"), "row", "conv_id", "kept", "turn", F.substring("role", 1, 1).alias("initial"),
        F.when(blank, _BLANK).when(~F.col("text").rlike(ENDED), _TRUNCATED).otherwise(_NONE).alias("fault"), F.lit(False).alias("is_first"),
    )
    marks = firsts.select(F.expr(_RANGE).alias("range"), "row", F.lit(True).alias("is_first"))
    # A mark goes just ahead of its row.
    both = narrow.unionByName(marks, allowMissingColumns=True).repartition(int(place), "range")
    both = both.sortWithinPartitions("range", "row", F.desc("is_first"))

    path = T.StructType(
        [T.StructField("source", T.IntegerType()), T.StructField("target", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]
    )
    longs = ("row", "rows", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
    schema = T.StructType(
        [
            T.StructField("conv_id", type_of(rows, "conv_id")),
            *[T.StructField(c, T.LongType()) for c in longs],
            *[T.StructField(c, T.StringType()) for c in ("first", "last")],
            T.StructField("paths", T.ArrayType(path)),
        ]
    )
    arrow = to_arrow_schema(schema)
    columns = ("range", "row", "is_first", "conv_id", "kept", "turn", "initial", "fault")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, marked, done = None, None, None, []
        for batch in batches:
            for number, row, is_first, conv, kept, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in columns)):
                if is_first:
                    marked = row
                    continue
                if at is None or number != part or conv != at.conv or at.rows >= most:
                    # Only what may go on from rows before it needs all states to begin in.
                    whole = at is not None and number == part and conv != at.conv
                    if at is not None:
                        done.append(at.record())
                    at, part = _Stretch(conv, row, (START,) if whole else (START, SYSTEM, USER, ASSISTANT)), number
                if kept:
                    at.take(turn, initial, _DUPLICATE if fault != _BLANK and row != marked else fault)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if at is not None:
            done.append(at.record())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return both.select(*columns).mapInArrow(run, schema)


class _Turns:
    """Rebuilds a conversation along its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _next(self) -> str:
        self.state, role = (ASSISTANT, "assistant") if self.state == USER else (USER, "user")
        return role

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._next(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The turns up to and with this row, as edit, role and text."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = self._next()
        elif edit == "K":
            if role[:1] == "s":
                self.state = SYSTEM
            else:
                self._next()
        yield edit, role, text


def _walk(rows: DataFrame, most: int, schema: T.StructType, begin, turn, end) -> DataFrame:
    """Report each conversation's stretches, then go through its rows in order, in one task each.

    ``begin(report)`` makes a state, ``turn(state, edit, role, text)`` and ``end(state)``
    give result rows.
    """
    told = _stretches(rows, most)
    kind = lambda n: F.lit(n).alias("kind")
    texts = rows.filter("kept").select(kind(1), "row", "conv_id", "role", "text")
    both = told.select(kind(0), *told.columns).unionByName(texts, allowMissingColumns=True)
    both = both.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "conv_id")
    both = both.sortWithinPartitions("conv_id", "kind", "row")
    arrow = to_arrow_schema(schema)
    parts = [c for c in told.columns if c not in ("conv_id", "row")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report = turns = state = None
        done: list[dict] = []

        def opened():
            nonlocal turns, state
            if turns is None:
                result = report.result()
                turns, state = _Turns(result["audit"]), begin(result)

        def closed():
            if report is not None:
                opened()
                for t in turns.inserted():
                    done.extend(turn(state, *t))
                done.extend(end(state))

        for batch in batches:
            told = [batch.column(c).to_pylist() for c in ("kind", "conv_id", "role", "text")]
            records = None
            for i, (k, conv, role, text) in enumerate(zip(*told)):
                if report is None or conv != report.conv:
                    closed()
                    report, turns = _Report(conv), None
                if k == 0:
                    records = records or batch.select(parts).to_pylist()
                    report.take(records[i])
                    continue
                opened()
                for t in turns.row(role, text):
                    done.extend(turn(state, *t))
                if len(done) >= 1000:
                    yield pa.RecordBatch.from_pylist(done, schema=arrow)
                    done = []
        closed()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return both.mapInArrow(run, schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(messages: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Per conversation its faults, the cost and audit of its repair, and a digest of the repaired turns.

    ``repaired_sha256`` is the SHA-256 of the repaired ``role:text``, joined by line feeds.
    """
    schema = T.StructType(
        [
            T.StructField("conv_id", type_of(messages, "conv_id")),
            *[T.StructField(c, T.LongType()) for c in _COUNTS],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )

    def begin(report: dict) -> list:
        return [report, hashlib.sha256(), ""]

    def turn(state: list, edit: str, role: str, text: str) -> tuple:
        if edit != "D":
            state[1].update(f"{state[2]}{role}:{text}".encode())
            state[2] = "\n"
        return ()

    def end(state: list) -> tuple:
        return ({**state[0], "repaired_sha256": state[1].hexdigest()},)

    return _walk(sorted_rows(messages), stretch, schema, begin, turn, end)


def repaired_messages(messages: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``, ``edit`` (K, R or I)."""
    schema = T.StructType(
        [
            T.StructField("conv_id", type_of(messages, "conv_id")),
            T.StructField("place", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("role", "text", "edit")],
        ]
    )

    def begin(report: dict) -> list:
        return [report["conv_id"], 0]

    def turn(state: list, edit: str, role: str, text: str) -> tuple:
        if edit == "D":
            return ()
        state[1] += 1
        return ({"conv_id": state[0], "place": state[1] - 1, "role": role, "text": text, "edit": edit},)

    return _walk(sorted_rows(messages), stretch, schema, begin, turn, lambda state: ())


def damaged(messages: DataFrame, rate: int = 20) -> DataFrame:
    """``messages`` with planted faults, by the CRC-32 of ``conv_id:turn`` modulo ``rate``.

    0 drops the row (``kept`` is false), 1 empties its text, 2 takes out ``.!?``, 3 doubles
    the row, 4 makes it the user's. Nulls are one space.
    """
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    lot = F.pmod(F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"])), F.lit(rate))
    text: Column = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(filled["text"], "[.!?]", "")).otherwise(filled["text"])
    rows = messages.select(
        "conv_id", "turn", F.when(lot == 4, "user").otherwise(filled["role"]).alias("role"), text.alias("text"),
        (lot != 0).alias("kept"), F.explode(F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")
