"""Packing documents into token sequences along a space-filling curve.

A document is its token ids and one end id. Its ids are also a hashed vector, which
random signs project to ``DIMENSIONS`` numbers; these are cut into a grid, and the
cell's place on the Hilbert curve through the grid is the document's key. Documents are
range-sorted by key (then id and a row number, so a hot key spreads over ranges), and
the sorted stream of ids is cut every ``SEQUENCE`` ids, so neighbours on the curve
share sequences and only the very last sequence is not full.

Two stored tables carry the work: the ids with keys, written where the texts are read,
and the narrow sorted order, whose ranges must not be drawn twice. Each range's total
gives the next range's first position, so no task sees the whole order. The ids are
shuffled once, to meet their positions.

Null and empty texts are the end id alone. Rows with equal ids or texts are packed
each; null ids sort first. An empty table gives no piece. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidegauge.llm.common import stored, type_of

SEQUENCE = 2048
END_ID = 1
DIMENSIONS, BITS = 4, 8


# --- tokens ------------------------------------------------------------------

#: Texts of other characters go to the library as a whole.
_PLAIN = r"\t-\r\x20-\x7e¡-ÿ"
# Fixed value: how the vocabulary's own tokenizer splits.
_PIECE = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"
#: Ends a piece while it is merged; no plain text has it.
_MARK = "\0"
#: Texts are encoded together up to about this many bytes, a longer one alone.
GROUP = 1 << 24


class WordTokenizer:
    """The library's ids for a word-based vocabulary, of many texts at once.

    Such a tokenizer splits at white space first, so the ids of a text are those of
    its words, one after another, and a word's are those of its pieces. Each distinct
    word of a group is split once and each distinct piece merged once, up to ``keep``
    pieces in a call. For texts with characters whose splitting or lower case may
    differ the library is asked.
    """

    def __init__(self, path: str, keep: int = 250_000):
        import tiktoken

        self.path, self.keep = path, keep
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.other = "|".join([f"[^{_PLAIN}]", *map(re.escape, self.special)])
        # The same merges over bytes, where the mark is the end of a word.
        byte_of = _byte_alphabet()
        ranks, self.last = {}, np.zeros(self.size, bool)
        for token, rank in spec["model"]["vocab"].items():
            if token not in self.special:
                word = token.removesuffix("</w>")
                self.last[rank] = word != token
                ranks[bytes(byte_of[c] for c in word) + (_MARK.encode() if word != token else b"")] = rank
        self.merge = tiktoken.Encoding("words", pat_str=f"[^{_MARK}]*{_MARK}", mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        """The library's tokenizer, loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _merged(self, pieces: pa.Array) -> pa.Array:
        """Ids of each piece; none of an empty one."""
        some = pc.not_equal(pieces, "")
        found = pieces.filter(some)
        ids = [np.zeros(0, "<u2")]
        for first in range(0, len(found), self.keep):
            marked = pc.binary_join_element_wise(found[first : first + self.keep], _MARK, "")
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(marked)], pa.int32()), marked), "")
            ids.append(np.array(self.merge.encode_ordinary(joined[0].as_py()), "<u2"))
        ids = np.concatenate(ids)
        # A piece's last id, and no other, is of a token at the end of a word.
        ends = np.flatnonzero(self.last[ids]) + 1
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])]
        buffers = [None, pa.py_buffer((2 * offsets).astype(np.int32)), pa.py_buffer(ids)]
        return pa.Array.from_buffers(pa.binary(), len(pieces), buffers)

    def encoded(self, texts: pa.Array) -> pa.Array:
        """Ids of each text (null: empty) as little-endian 16-bit numbers."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        other = pc.match_substring_regex(texts, self.other)
        words = pc.ascii_split_whitespace(pc.utf8_lower(pc.if_else(other, "", texts)))
        ids = _of_parts(words, lambda found: _of_parts(_pieces(found), self._merged))
        asked = [self.library.encode(t, add_special_tokens=False).ids for t in texts.filter(other).to_pylist()]
        return pc.replace_with_mask(ids, other, pa.array([np.array(x, "<u2").tobytes() for x in asked], pa.binary()))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoded(pa.array([text], pa.string()))[0].as_py(), "<u2")


def _of_parts(lists: pa.ListArray, values: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """The joined values of each list's parts, with ``values`` asked once for the distinct ones."""
    found = lists.flatten().dictionary_encode()
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, values(found.dictionary).take(found.indices)), b"")


def _pieces(words: pa.Array) -> pa.ListArray:
    """The pieces of each lower-case word."""
    # Most words are letters, or letters and one other character: these need no pattern.
    whole, stems = pc.utf8_is_alpha(words), pc.utf8_slice_codeunits(words, 0, -1)
    split = pc.and_not(pc.utf8_is_alpha(stems), whole)
    spaced = pc.if_else(split, pc.binary_join_element_wise(stems, pc.utf8_slice_codeunits(words, -1), " "), words)
    others = pc.invert(pc.or_(whole, split))
    spaced = pc.replace_with_mask(spaced, others, pc.replace_substring_regex(words.filter(others), _PIECE, r"\1 "))
    return pc.ascii_split_whitespace(spaced)


def _groups(texts: pa.Array, size: int = GROUP) -> list[slice]:
    """Neighbouring rows of about ``size`` bytes of text, or with one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), len(ends)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


@cache
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


# --- the curve ---------------------------------------------------------------


@cache
def _signs(size: int, dimensions: int) -> np.ndarray:
    draw = np.random.default_rng(7)
    return (draw.integers(0, 2, (size, dimensions)) * 2 - 1).astype(np.float32)


def grid_cells(ids: list[np.ndarray], vocabulary: int, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Grid cell of each document: random projection of its id counts, squashed to [0, 2**bits)."""
    signs = _signs(vocabulary, dimensions)
    means = np.array([signs[x].mean(0) if len(x) else np.zeros(dimensions) for x in ids]).reshape(-1, dimensions)
    # Common ids dominate a mean, which lies well within (-0.5, 0.5) for longer texts.
    squashed = 0.5 * (1 + np.tanh(4.0 * means))
    return np.minimum((squashed * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (one row each), by Skilling's transform."""
    x = cells.T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            inside = (x[i] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    keys = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            keys = (keys << 1) | ((x[i] >> b) & 1)
    return keys


# --- packing -----------------------------------------------------------------


def tokenized(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """``id_col``, ``key``, ``n_tokens`` and ``ids`` (little-endian 16-bit numbers) of every row."""

    def run(batches):
        tok = tokenizer(vocabulary_path)
        if tok.size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for rows in _groups(batch.column(1)):
                encoded = tok.encoded(batch.column(1)[rows])
                ids = [np.frombuffer(x, "<u2") for x in encoded.to_pylist()]
                keys = hilbert_keys(grid_cells(ids, tok.size))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows],
                        pa.array(keys, pa.int64()),
                        pa.array([len(x) + 1 for x in ids], pa.int64()),
                        pc.binary_join_element_wise(encoded, end, b""),
                    ],
                    names=[id_col, "key", "n_tokens", "ids"],
                )

    schema = T.StructType(
        [
            T.StructField(id_col, type_of(docs, id_col)),
            T.StructField("key", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return docs.select(id_col, "text").mapInArrow(run, schema)


def curve_positions(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``row`` and ``at``, the number of ids before the row's along the curve."""

    def run(batches):
        total = 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = total + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends - n), pa.array(n), batch.column(2)], names=["row", "local", "n_tokens", "part"]
            )
            total = int(ends[-1]) if len(ends) else total

    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = tokens.select("row", "n_tokens", "key", id_col).repartitionByRange(parts, "key", id_col, "row")
    order = order.sortWithinPartitions("key", id_col, "row").select("row", "n_tokens", F.spark_partition_id().alias("part"))
    order = stored(order.mapInArrow(run, "row long, local long, n_tokens long, part int"), "curve-order")
    # One row per range.
    totals = order.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select(F.col("part").alias("p"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    return order.join(F.broadcast(firsts), F.col("part") == F.col("p")).select("row", (F.col("first") + F.col("local")).alias("at"))


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents: where each lies in its document and in which sequence, and its ids.

    Columns: ``id_col``, ``start``, ``length``, ``ids`` (little-endian 32-bit numbers),
    ``doc_tokens``, ``sequence_id``, ``offset``.
    """
    tokens = tokenized(docs, vocabulary_path, id_col, end_id).withColumn("row", F.monotonically_increasing_id())
    tokens = stored(tokens, "tokens")
    # A position for every document: never a side to broadcast.
    places = curve_positions(tokens, id_col).hint("merge")
    placed = tokens.select(id_col, "ids", "row").join(places, "row").select(id_col, "ids", "at")

    def run(batches):
        for batch in batches:
            out = []
            for doc, raw, at in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                n, start = len(ids), 0
                while start < n:
                    where, offset = divmod(at + start, sequence)
                    length = min(n - start, sequence - offset)
                    out.append((doc, start, length, ids[start : start + length].tobytes(), n, where, offset))
                    start += length
                if len(out) >= 4096:
                    yield _pieces_batch(out, batch.schema.field(0).type, names)
                    out = []
            if out:
                yield _pieces_batch(out, batch.schema.field(0).type, names)

    longs = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType(
        [
            T.StructField(id_col, type_of(docs, id_col)),
            *[T.StructField(c, T.BinaryType() if c == "ids" else T.LongType()) for c in longs],
        ]
    )
    names = schema.fieldNames()
    return placed.mapInArrow(run, schema)


def _pieces_batch(rows: list[tuple], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
