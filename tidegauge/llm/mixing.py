"""Mixing sources to target weights by systematic sampling.

Every source gets a target size (``source_targets``), every document of it the same
expected number of copies, target over source size. The documents of a source stand in
one order; their expected copies are summed along it, one random offset in [0, 1) per
source is added, and a document is emitted once for each whole number that its stretch of
the sum crosses. So a document comes out ``floor`` or ``ceil`` of its expected copies
times, and a source's copies differ from their expectation by less than one.

The order is by size, then by a hash of id and text. Along a rising size the error of
copies, below one everywhere, costs at most twice the largest document: a source's taken
words lie that near to its target.

Expected copies are whole hundred-millionths, so the sums are exact, and neither layout
nor reruns change them. A sum over one source would be one task for a hot source. Here a
source is cut by size and the first 12 bits of the hash; counts of these cells are summed
over their sizes (per source) and bits (per size), and only the documents of a cell are
numbered together. All of it is joins, windows and aggregates.

Null texts have size 0; null sources are one source. A source without words has target 0
and takes none. Rows that repeat are rows of their own; equal rows may swap their copies.
An empty table gives none. Texts count whole, whatever their length. Added columns replace
those of the same name; all others are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidegauge.functions.times import int_div

# What a word is, and the weights of the sources in turn.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Parts of a copy that expected copies are counted in.
PARTS = 100_000_000
#: Hash digits (of 4 bits each) that part the documents of one source and size.
DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def weights_in_turn(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (a row per source) with ``weight``: the weights in turn, by source, null last.

    The list of sources is that of a mix's configuration: one task orders it.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    return sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (``source``, ``source_size``, ``weight``) with ``target``.

    ``share`` times all sizes is dealt by weight; a target stops at ``most`` times its
    source's size, and what is left is dealt among the others by weight until none is
    above. That ends where every target is the lesser of its limit and one number times
    its weight; taken by limit over weight, the limited sources come first.
    """
    if not 0 < share <= most:
        raise ValueError("share must be above 0 and at most the limit of copies")
    limit = F.col("source_size") * F.lit(float(most))
    order = Window.orderBy(limit / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumns(
        {
            "_left": F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum(limit).over(before), F.lit(0.0)),
            "_weights": F.sum("weight").over(after),
            "_place": F.row_number().over(order),
        }
    )
    free = F.col("_left") * F.col("weight") / F.col("_weights") < limit
    # The first source below its limit has the level of all after it.
    level = F.min(F.when(free, F.struct("_place", "_left", "_weights"))).over(every)
    dealt = level["_left"] * F.col("weight") / level["_weights"]
    target = F.when(level.isNull() | (F.col("_place") < level["_place"]), limit).otherwise(dealt)
    return ranked.withColumn("target", target).select(*sizes.columns, "target")


def key_of(source: Column) -> Column:
    """A source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """``docs`` with ``size``, its words, and ``order_key``, a hash of seed, id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
    return docs.withColumns({"size": word_count(F.col(text_col)), "order_key": F.sha2(whole, 256)})


def _offset(key: Column, seed: int) -> Column:
    """A number in [0, PARTS), from the hash of seed and source."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") % PARTS


def mix_sources(
    rows: DataFrame,
    weights: Callable[[DataFrame], DataFrame] = weights_in_turn,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``copies``.

    ``rows`` has ``source``, ``size`` and ``order_key`` (see ``sized``); it is read twice, so
    store it where it is costly. ``weights`` adds ``weight`` (above 0) to a row per source.
    """
    rows = rows.drop("source_size", "target", "copies")
    cell = ["_key", "size", "_cell"]
    # The row in one column, so that no name of its own meets one of these.
    celled = rows.select(
        F.struct("*").alias("_row"), key_of(F.col("source")).alias("_key"), "size", F.substring("order_key", 1, DIGITS).alias("_cell")
    )
    counts = celled.groupBy(*cell).agg(F.count("*").alias("_n"), F.min("_row.source").alias("_source"))
    sizes = counts.groupBy("_key", "size").agg(F.sum("_n").alias("_of_size"), F.min("_source").alias("source"))
    sources = sizes.groupBy("_key").agg(F.min("source").alias("source"), F.sum(F.col("size") * F.col("_of_size")).alias("source_size"))
    targets = source_targets(weights(sources), share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets.select("_key", "source_size", "target", F.floor(rate * PARTS + 0.5).cast("bigint").alias("_parts"))

    # Documents of the source before a cell: those of smaller sizes, and of lower cells of its size.
    def before(window: WindowSpec, n: str) -> Column:
        return F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))

    smaller = before(Window.partitionBy("_key").orderBy("size"), "_of_size")
    sizes = sizes.select("_key", "size", smaller.alias("_smaller")).join(rates, "_key")
    lower = before(Window.partitionBy("_key", "size").orderBy("_cell"), "_n")
    cells = counts.select(*cell, lower.alias("_lower")).join(sizes, ["_key", "size"])

    # A row per cell: never small for certain, so it is not broadcast.
    placed = celled.join(cells.hint("merge"), cell)
    in_cell = F.row_number().over(Window.partitionBy(*cell).orderBy("_row.order_key", F.xxhash64("_row")))
    placed = placed.withColumn("_place", F.col("_smaller") + F.col("_lower") + in_cell)
    crossed = [int_div(place * F.col("_parts") + _offset(F.col("_key"), seed), PARTS) for place in (F.col("_place"), F.col("_place") - 1)]
    return placed.select("_row.*", "source_size", "target", (crossed[0] - crossed[1]).alias("copies"))


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says, numbered from 1 by ``copy``."""
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.filter("copies > 0").withColumn("copy", F.explode(times)).drop("copies")
