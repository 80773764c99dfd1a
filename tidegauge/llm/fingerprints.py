"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph hashes to a vector of ``DENSE + SKETCH`` numbers modulo 2**16, and a
document's fingerprint is the sum of its paragraphs' vectors. So it does not depend on
their order, and paragraphs are added or removed without reading the rest.

* The dense part is a 256-bit BLAKE2 hash of the paragraph. Fingerprints of different
  multisets agree on it with negligible probability.
* The sketch part counts the paragraph's windows of 24 bytes in hashed places with
  hashed signs. Sums of sketches keep inner products, so two fingerprints tell how much
  two documents have in common: :func:`likeness` is twice the common part over the sum
  of both. Its standard error is about 0.1.

Paragraphs are the pieces between line feeds, empty ones too; a null or empty text has
none and the zero fingerprint. Counts beyond 2**15 in one place wrap, which only the
likeness of very long monotonous texts can feel. Ids are whole numbers or null, nulls
first; rows of one id follow a hash of their texts, and repeated rows are rows of their
own. An empty table gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidegauge.llm.common import type_of

DENSE, SKETCH = 16, 128
_WINDOW = 24
_GAP = b"\0" * _WINDOW
# Odd multipliers for hashing windows.
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def paragraphs(text: str) -> list[bytes]:
    return text.encode().split(b"\n") if text else []


def vector(pieces: list[bytes]) -> np.ndarray:
    """Sum of the paragraphs' vectors."""
    out = np.zeros(DENSE + SKETCH, np.int64)
    if not pieces:
        return out.astype(np.uint16)
    digests = b"".join([hashlib.blake2b(p, digest_size=2 * DENSE).digest() for p in pieces])
    out[:DENSE] = np.frombuffer(digests, "<u2").reshape(-1, DENSE).sum(0, dtype=np.int64)
    data = _GAP.join([*pieces, b""])  # windows that leave a paragraph read zeros
    n = len(data) - _WINDOW
    parts = [np.ndarray((n,), "<u8", data, offset=8 * i, strides=(1,)) * _M[i] for i in range(3)]
    h = parts[0] + parts[1] + parts[2]
    h = h[np.frombuffer(data, np.uint8, n) != 0]
    h ^= h >> np.uint64(32)
    h *= _M[3]
    counts = np.bincount((h >> np.uint64(56)).astype(np.int64), minlength=2 * SKETCH)
    out[DENSE:] = counts[0::2] - counts[1::2]
    return out.astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common share of two documents from their vectors: 1 for equal ones, about 0 for unrelated ones."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a[DENSE:].view(np.int16).astype(float), b[DENSE:].view(np.int16).astype(float)
    both = x @ x + y @ y
    return float(min(1.0, max(0.0, 2 * (x @ y) / both))) if both else 0.0


def edited(vec: np.ndarray, old: str, new: str, kept: int) -> np.ndarray:
    """The vector of ``new``, given that of ``old``, whose first ``kept`` characters are ``new``'s too.

    Only paragraphs from the last line break in the common part on are hashed.
    """
    cut = old.rfind("\n", 0, kept) + 1
    gone = old[cut:].encode().split(b"\n") if old else []
    come = new[cut:].encode().split(b"\n") if new else []
    return vec - vector(gone) + vector(come)


@F.arrow_udf(T.BinaryType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """Fingerprint of a text column, as bytes."""
    return pa.array([vector(paragraphs(t.as_py() or "")).tobytes() for t in texts], pa.binary())


@F.arrow_udf(T.BinaryType())
def combined(a: pa.Array, b: pa.Array) -> pa.Array:
    """Fingerprint of the union of two multisets; null counts as empty."""
    zero = bytes(2 * (DENSE + SKETCH))
    sums = [
        (np.frombuffer(x.as_py() or zero, np.uint16) + np.frombuffer(y.as_py() or zero, np.uint16)).tobytes()
        for x, y in zip(a, b)
    ]
    return pa.array(sums, pa.binary())


@F.arrow_udf(T.BinaryType())
def without(a: pa.Array, b: pa.Array) -> pa.Array:
    """Fingerprint of the first multiset after removing the second from it."""
    zero = bytes(2 * (DENSE + SKETCH))
    sums = [
        (np.frombuffer(x.as_py() or zero, np.uint16) - np.frombuffer(y.as_py() or zero, np.uint16)).tobytes()
        for x, y in zip(a, b)
    ]
    return pa.array(sums, pa.binary())


def with_next(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows dealt to partitions and sorted so that each row's successor by id follows it.

    Adds ``bucket`` and ``guest``: buckets are ranges of ids, and a bucket's last row is
    a guest, the first of the next bucket (of the first bucket after the last one). The
    ranges' borders are ids of the table, taken once, so the dealing is repeatable. Null
    ids come first; rows of equal id follow each other in order of a hash of the text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)] or [0.5]
    known = docs.agg(
        F.min(id_col).alias("first"),
        F.count(F.when(F.col(id_col).isNull(), 1)).alias("nulls"),
        F.percentile_approx(id_col, cuts, 10000).alias("borders"),
    ).first()
    first, nulls = known["first"], known["nulls"] > 0
    borders = np.array(sorted({b for b in known["borders"] or () if b != first}), dtype=np.int64)
    last = len(borders)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def places(ids: pa.Array) -> pa.Array:
        out = []
        for i in ids.to_pylist():
            if i is None:
                out.append([0, 2 * last + 1])
                continue
            b = int(np.searchsorted(borders, i, side="right"))
            own = [2 * b]
            if b and borders[b - 1] == i:
                own.append(2 * b - 1)
            if i == first and not nulls:
                own.append(2 * last + 1)
            out.append(own)
        return pa.array(out, pa.list_(pa.int32()))

    dealt = docs.select(id_col, "text", F.explode(places(F.col(id_col))).alias("place"))
    dealt = dealt.select(id_col, "text", F.expr("place div 2").cast("int").alias("bucket"), (F.col("place") % 2).alias("guest"))
    return dealt.repartitionById(last + 1, F.col("bucket")).sortWithinPartitions(
        "bucket", "guest", F.asc_nulls_first(id_col), F.xxhash64("text")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", share: int = 4) -> DataFrame:
    """Each document's fingerprint beside that of an edited copy and of the next document.

    The copy's last ``n_chars // share`` characters are replaced by as many first ones
    of the next document by id. Its fingerprint is made from the document's own by
    removing and adding the paragraphs that differ.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, type_of(docs, id_col)),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    names = schema.fieldNames()

    def row(id_, text, vec, after, after_vec):
        n = len(text)
        kept = n - n // share
        new = text[:kept] + after[: n - kept]
        new_vec = edited(vec, text, new, kept)
        digest = hashlib.sha256(new.encode()).hexdigest()
        return (id_, n, digest, vec.tobytes().hex(), new_vec.tobytes().hex(), likeness(vec, new_vec), likeness(vec, after_vec))

    def run(batches):
        held, bucket = None, None
        for batch in batches:
            out = []
            for id_, text, b, guest in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(i).to_pylist() for i in (2, 3))):
                if guest and held is None:
                    continue  # the bucket's last row has its successor already
                text = text.as_py() or ""
                vec = vector(paragraphs(text))
                if held is not None and b == bucket:
                    out.append(row(*held, text, vec))
                held, bucket = (None if guest else (id_, text, vec)), b
            if out:
                kinds = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return with_next(docs, id_col).mapInArrow(run, schema)
