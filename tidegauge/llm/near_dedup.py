"""Near-duplicates by SimHash: pigeonhole blocks, Hamming check, components.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles. Fingerprints that differ in at most ``radius`` bits are linked,
and a component of linked fingerprints is a group.

How links are found, without losing one and without all pairs of a group:

* Equal fingerprints are one node, so copies cost nothing.
* The 64 bits are cut into ``blocks`` blocks. Two fingerprints within the radius
  agree on at least ``blocks - radius`` of them, so they share a bucket for some
  choice of that many blocks. With 7 blocks and radius 4 a bucket fixes 27 or 28
  bits, so unrelated fingerprints rarely meet.
* In a bucket each node is compared with the smallest one; nodes that are both
  linked to it need no link of their own. Other pairs are joined, and a pair is
  reported only in the first bucket it shares.
* A bucket with over ``crowd`` nodes is not joined with itself. Its nodes are
  spread over all points within half the radius instead: two nodes are linked
  exactly if they have such a point in common. This is linear in the nodes.

Null and empty texts have fingerprint zero, like texts of white space. Repeated
rows give one row each. A null id never names a component; a component without
any id has a null one. Texts of any length are hashed whole, in time linear in them. An
empty table gives none. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegauge.llm.common import fresh_name, remove, stored, type_of

SHINGLE = 4
RADIUS = 4
BLOCKS = 7
CROWD = 512
SEED = 42
#: Up to this many rows that go (a number each) are broadcast when duplicates are dropped.
BROADCAST_ROWS = 1_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACES = (np.arange(8, dtype=np.int64) * 256)[None, :]


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text: bit set if set in over half of the shingles' hashes."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)])
    values = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.bincount((values + _PLACES).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(values)).tobytes(), "big")


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``id_col`` and ``fingerprint`` (bigint) of every row's whole ``text``."""
    schema = T.StructType([T.StructField(id_col, type_of(docs, id_col)), T.StructField("fingerprint", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            values = np.fromiter((simhash(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=[id_col, "fingerprint"]
            )

    return docs.select(id_col, "text").mapInArrow(run, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _block_masks(blocks: int) -> list[int]:
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]


def _ball(radius: int) -> Column:
    """A constant array of all changes of at most ``radius`` bits."""
    ball = "array(0L)"
    for _ in range(radius):
        wider = f"flatten(transform({ball}, c -> transform(sequence(0, 63), i -> c ^ shiftleft(1L, i))))"
        ball = f"array_union({ball}, {wider})"
    return F.expr(ball)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hamming_links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """Links ``a``, ``b`` between the distinct values of ``fingerprint``.

    Fingerprints within the radius are connected by these links, if not always
    directly; all links join fingerprints within the radius.
    """
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    masks = _block_masks(blocks)
    chosen = list(combinations(range(blocks), blocks - radius))
    keys = F.array(
        *[
            F.struct(
                F.lit(sum(1 << j for j in c)).alias("choice"),
                F.col("fingerprint").bitwiseAND(F.lit(_signed(sum(masks[j] for j in c)))).alias("bits"),
            )
            for c in chosen
        ]
    )
    rows = nodes.select("fingerprint", F.explode(keys).alias("k")).select("k.choice", "k.bits", "fingerprint")
    buckets = rows.groupBy("choice", "bits").agg(F.count("*").alias("n"), F.min("fingerprint").alias("least"))
    # Copies with small changes share many buckets, so these grow with the documents: no side to broadcast.
    shared = rows.join(buckets.filter("n > 1").hint("merge"), ["choice", "bits"])
    shared = stored(
        shared.withColumn("near", _distance(F.col("fingerprint"), F.col("least")) <= radius), "simhash-buckets"
    )

    stars = shared.filter("near and fingerprint != least").select(F.col("least").alias("a"), F.col("fingerprint").alias("b"))

    small = shared.filter(F.col("n") <= crowd)
    x, y = small.alias("x"), small.alias("y")
    differ = F.col("x.fingerprint").bitwiseXOR(F.col("y.fingerprint"))
    same = F.lit(0)
    for j, mask in enumerate(masks):
        same = same + F.when(differ.bitwiseAND(F.lit(_signed(mask))) == 0, 1 << j).otherwise(0)
    rest = same
    for _ in range(blocks - radius):
        rest = rest.bitwiseAND(rest - 1)
    pairs = x.join(
        y,
        (F.col("x.choice") == F.col("y.choice"))
        & (F.col("x.bits") == F.col("y.bits"))
        & (F.col("x.fingerprint") < F.col("y.fingerprint"))
        & ~(F.col("x.near") & F.col("y.near"))
        & (F.bit_count(differ) <= radius)
        & (F.col("x.choice") == same - rest),
    ).select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"))

    crowded = shared.filter(F.col("n") > crowd).select("fingerprint").distinct()
    points = crowded.select("fingerprint", F.explode(_ball(radius // 2)).alias("change")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("change")).alias("point")
    )
    met = points.join(points.groupBy("point").agg(F.min("fingerprint").alias("least")), "point").filter(
        "least != fingerprint"
    )
    met = met.select(F.col("least").alias("a"), F.col("fingerprint").alias("b"))
    return stars.unionByName(pairs).unionByName(met).distinct()


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (``a``, ``b``): columns ``node`` and ``root``.

    ``root`` is the least node of the component; nodes without a link are not
    listed. Rounds of "link every larger neighbour to the least neighbour",
    then the same for smaller ones, end in stars; the number of rounds grows with
    the logarithm of the longest path. Each round is a stored table.
    """
    edges = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components",
    )
    last = None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.sum(F.xxhash64("b", "a") % 999983)).first()
        if found == last or not found[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = found
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        down = large.filter("a > b").groupBy("a").agg(F.min("b").alias("root"))
        small = large.filter("a > b").join(down, "a")
        small = small.select(F.col("b").alias("a"), F.col("root").alias("b")).union(down.select("a", "root"))
        new = stored(small.filter("a != b").distinct(), "components")
        remove(edges)
        edges = new


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` and ``component_id``.

    ``component_id`` is the least id among the rows whose fingerprints are
    reachable over links. See the module for the method and the edge cases.
    """
    if radius % 2 or not 0 < radius < blocks:
        raise ValueError("radius must be even, positive and below blocks")
    prints = stored(document_fingerprints(docs, id_col, shingle), "simhash")
    nodes = prints.groupBy("fingerprint").agg(F.min(id_col).alias("least_id"))
    roots = components(hamming_links(nodes, radius, blocks, crowd))
    rooted = nodes.join(roots, nodes.fingerprint == roots.node, "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least_id"
    )
    rooted = stored(rooted, "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(names, "root").select("fingerprint", "component_id")
    # There is a class for nearly every document: never a side to broadcast.
    return prints.join(classes.hint("merge"), "fingerprint").select(id_col, "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group: that of the least id.

    Rows with an id go before rows without; among rows of one id any may stay, but
    exactly one row of a group does. All columns are kept.
    """
    row, component = fresh_name(docs, "row_key"), fresh_name(docs, "component")
    # Ids can repeat, so rows are numbered; storing them fixes the numbers.
    keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "near-dedup-input")
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    groups = near_groups(keyed.select(key.alias("key"), "text"), id_col="key", **options)
    gone = stored(groups.filter("key.row != component_id.row").select(F.col("key.row").alias(component)), "near-dedup-gone")
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)  # the texts then stay where they are read
    return keyed.join(gone, keyed[row] == gone[component], "left_anti").drop(row)
