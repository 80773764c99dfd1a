"""Benchmark decontamination: which documents hold a benchmark item, exactly or nearly.

Texts are lower-cased words between white space, and shingles of five words (texts of
fewer words: all of them as one shingle). An item with ``n`` shingles is compared with
windows of ``n`` consecutive shingles of a document. Shingles are weighted by how
often they occur, so the similarity of window and item is the sum of the lesser
over the sum of the greater counts, and 0.8 or more is a match.

1. Shingles of documents that are no item's shingle are dropped. A window needs one of
   the item's shingles to be similar to it, so nothing is lost.
2. Each remaining shingle says where a window of the item would begin: its place less
   the shingle's place in the item. Windows are the distinct beginnings; those that
   reach over the document's ends are moved back into it.
3. Window and item have 64-bit SimHash fingerprints. These are cut into
   ``RADIUS + 1`` blocks; window and item within the radius agree on a block and meet
   in a join on it, and the Hamming distance is checked. At similarity 0.8 the cosine
   is 0.89, for which 9.7 differing bits are expected with a deviation of 2.9; a radius
   of 22 lies over four deviations off.
4. The similarity of what is left is computed exactly, on the shingles themselves.

All of it is DataFrame functions. The table of item shingles is broadcast only while
its counted size is below ``BROADCAST_ROWS``; beyond it Spark joins by shuffle.

Null and empty texts have no shingle, and such items match nothing. Items of fewer than
five words match only documents that consist of exactly these words. Rows that repeat
id and text are reported once; null ids are kept; items with equal texts are all
reported. Texts of any length are searched whole. Empty tables give no match. Columns
are read by name, so others do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 22
BROADCAST_ROWS = 500_000

_SPACE = " \t\n\x0b\x0c\r"
_KEY = ["key_a", "key_b"]


def _keys(id_col: str) -> list[Column]:
    """Two hashes that stand for a row's id and whole text."""
    return [F.xxhash64(id_col, "text").alias("key_a"), F.xxhash64("text", id_col, F.lit("b")).alias("key_b")]


def with_shingles(rows: DataFrame, *keep: Column | str, size: int = SHINGLE) -> DataFrame:
    """``keep`` and ``shingles``, the 64-bit hashes of the text's shingles in order.

    Each word is hashed once, and a shingle is the hash of its words' hashes.
    """
    text = F.btrim(F.lower(F.coalesce("text", F.lit(""))), F.lit(_SPACE))
    words = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "[ \\t-\\r]+"))
    hashed = rows.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("_h"))
    h, n = F.col("_h"), F.size("_h")
    full = F.transform(
        F.slice(h, 1, F.greatest(n - size + 1, F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)]),
    )
    few = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(h)))
    names = [c if isinstance(c, str) else hashed.columns[j] for j, c in enumerate(keep)]
    return hashed.select(*names, F.when(n >= size, full).otherwise(few).alias("shingles"))


def simhashes(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``n`` and ``fingerprint``: bits set in over half of the column ``s`` of a key's rows."""
    ones = [F.sum(F.shiftrightunsigned("s", b).bitwiseAND(F.lit(1))).alias(f"_{b}") for b in range(64)]
    counted = shingles.groupBy(*keys).agg(F.count("*").alias("n"), *ones)
    bits = [F.when(F.col(f"_{b}") * 2 > F.col("n"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(0) for b in range(64)]
    value = bits[0]
    for bit in bits[1:]:
        value = value.bitwiseOR(bit)
    return counted.select(*keys, "n", value.cast("bigint").alias("fingerprint"))


def hamming_pairs(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Windows whose fingerprint is within the radius of their item's.

    Both sides are split into ``radius + 1`` blocks, one of which must agree.
    """
    cuts = [round(64 * i / (radius + 1)) for i in range(radius + 2)]

    def blocks(fingerprint: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(j).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
                for j, (a, b) in enumerate(zip(cuts, cuts[1:]))
            ]
        )

    left = windows.select("*", F.explode(blocks(F.col("fingerprint"))).alias("k")).select("*", "k.block", "k.bits").drop("k")
    right = items.select(
        F.col("item").alias("other"), F.col("fingerprint").alias("item_fingerprint"), F.explode(blocks(F.col("fingerprint"))).alias("k")
    ).select("other", "item_fingerprint", F.col("k.block").alias("block"), F.col("k.bits").alias("bits"))
    met = left.join(right, ["block", "bits"]).filter(F.col("item") == F.col("other"))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    return met.filter(distance <= radius).select(*windows.columns, distance.alias("hamming")).distinct()


def _small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``BROADCAST_ROWS`` rows of a few numbers."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """Matches of documents and items: ids, ``similarity``, ``hamming`` and the best window.

    Columns: ``id_col``, ``item_col``, ``similarity``, ``hamming``, ``first_shingle``,
    ``shingles`` (the window's place and size), ``key_a``, ``key_b`` (the row).
    """
    named = benchmark.select(F.col(item_col), F.col("text"), F.xxhash64(item_col, "text").alias("item"))
    items = with_shingles(named.dropDuplicates(["item"]), item_col, "item")
    items = items.select(item_col, "item", F.size("shingles").alias("size"), F.posexplode_outer("shingles").alias("place", "s"))
    items = items.filter("s IS NOT NULL")
    items = stored(items, "benchmark-shingles")
    places = items.select("item", "size", "place", "s")

    # The outer form implies no filter on the array, which would be computed once more.
    spread = with_shingles(docs, *_keys(id_col))
    spread = spread.select(*_KEY, F.size("shingles").alias("total"), F.posexplode_outer("shingles").alias("at", "s"))
    begin = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.col("total") - F.col("size")))
    windows = spread.join(_small(places), "s").select(
        *_KEY, "item", begin.alias("begin"), F.least("size", "total").alias("length")
    )
    windows = stored(windows.distinct(), "benchmark-windows")

    hit = _small(windows.select(*_KEY).distinct())
    texts = docs.select(id_col, "text", *_keys(id_col)).join(hit, _KEY, "left_semi").dropDuplicates(_KEY)
    rows = with_shingles(texts, id_col, *_KEY)
    cut = rows.join(windows, _KEY).select(
        id_col, *_KEY, "item", "begin", F.explode_outer(F.slice("shingles", F.col("begin") + 1, F.col("length"))).alias("s")
    )
    cut = stored(cut, "benchmark-cuts")
    window = [id_col, *_KEY, "item", "begin"]
    near = hamming_pairs(simhashes(cut, window), simhashes(items, ["item"]), radius)

    # Weights are counts: the common weight over the sum of both less the common.
    own = cut.groupBy(*window, "s").agg(F.count("*").alias("c"))
    theirs = items.groupBy("item", "s", "size").agg(F.count("*").alias("d"))
    common = own.join(theirs, ["item", "s"]).groupBy(*window, "size").agg(F.sum(F.least("c", "d")).alias("common"))
    near = near.select(*[F.col(c).alias(f"_{c}") for c in window], "hamming", F.col("n").alias("shingles"))
    same = F.lit(True)
    for c in window:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    value = F.col("common") / (F.col("shingles") + F.col("size") - F.col("common"))
    found = common.join(near, same).withColumn("similarity", value).filter(F.col("similarity") >= similarity)
    rank = F.struct("similarity", (-F.col("hamming")).alias("near"), (-F.col("begin")).alias("first"), "shingles")
    best = found.groupBy(id_col, *_KEY, "item").agg(F.max(rank).alias("b"))
    names = items.select(item_col, "item").distinct()
    return best.join(names, "item").select(
        id_col,
        item_col,
        F.col("b.similarity").alias("similarity"),
        (-F.col("b.near")).alias("hamming"),
        (-F.col("b.first")).alias("first_shingle"),
        F.col("b.shingles").alias("shingles"),
        *_KEY,
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without a match, all columns kept."""
    bad = stored(contaminated(docs, benchmark, id_col, **options).select(*_KEY).distinct(), "contaminated")
    bad = _small(bad.toDF("_bad_a", "_bad_b"))
    a, b = _keys(id_col)
    return docs.join(bad, (a == F.col("_bad_a")) & (b == F.col("_bad_b")), "left_anti")
