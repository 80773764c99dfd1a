"""Fill-in-the-middle: documents cut at two line borders, the middle moved to the end.

A document is cut into ``n`` units (lines, each with its line feed), counted by
``regexp_count``. Two cuts ``a <= b`` are drawn from a hash of the seed and the id, and
one match of a pattern made for the row takes the document apart: a possessive group of
``unit{a}``, one of ``unit{b-a}``, and the rest. A possessive counted group is matched in
a loop and never tried again, so the stack stays flat and the time linear in the text.

Forms: ``psm`` is prefix, suffix, middle, each behind its mark; ``spm`` is suffix, prefix,
middle; ``plain`` is the text as it is. ``restore`` gives back the text exactly: a text
that holds a mark is left plain, and a cut cannot make one, since marks begin with ``<``
and end with ``>``.

Null texts are empty, empty texts are plain. A null id is hashed as an empty one; rows of
one id are cut by the same hash, each within its own text. Texts of any length are matched
whole; the units of one text are held by its task only. An empty table gives none, and all
columns are kept beside the one added.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# A unit is a line with its line feed, or a last line without one.
UNIT = r"[^\n]*\n|[^\n]+"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Infill:
    """Marks, seed, and the percentages of documents cut and, of these, written as ``spm``."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 7
    rate: int = 100
    spm: int = 50

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or not all(re.fullmatch(r"<[^<>\n]+>", m) for m in marks):
            raise ValueError("marks must be three different names in angle brackets")
        if not (0 <= self.rate <= 100 and 0 <= self.spm <= 100):
            raise ValueError("rate and spm are percentages")


def _draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers, from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def _quoted(mark: str) -> str:
    """A mark as it must stand in a replacement."""
    return re.sub(r"([\\$])", r"\\\1", mark)


def fill_in_middle(docs: DataFrame, rules: Infill = Infill(), id_col: str = "doc_id", text_col: str = "text", name: str = "infill") -> DataFrame:
    """``docs`` with a struct ``name``: ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    A column of the same name is replaced.
    """
    h = _draws(F.col(id_col), rules.seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = (rules.prefix, rules.suffix, rules.middle)
    held = F.lit(False)
    for mark in marks:
        held = held | F.col("_text").contains(mark)
    form = (
        F.when((F.col("_text") == "") | held | (F.col("_h")[2] % 100 >= rules.rate), PLAIN)
        .when(F.col("_h")[3] % 100 < rules.spm, SPM)
        .otherwise(PSM)
    )
    docs = docs.drop(name)
    # The row in one column, so that no name of its own meets one of these.
    drawn = docs.select(F.struct("*").alias("_row"), text.alias("_text"), F.array(*h).alias("_h"))
    drawn = drawn.withColumns({"_n": F.regexp_count("_text", F.lit(UNIT)).cast("bigint"), "_form": form})
    cuts = [F.col("_h")[k] % (F.col("_n") + 1) for k in (0, 1)]
    low, high = F.least(*cuts), F.greatest(*cuts)
    # {a}+ and {b-a}+ are possessive: what they took is never given back.
    pattern = F.concat(
        F.lit(rf"(?s)\A((?:{UNIT}){{"), low.cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"), (high - low).cast("string"), F.lit(r"}+)(.*)\z")
    )
    p, s, m = map(_quoted, marks)
    order = F.when(F.col("_form") == SPM, f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    cut = drawn.withColumn("_out", F.when(F.col("_form") == PLAIN, F.col("_text")).otherwise(F.regexp_replace("_text", pattern, order)))
    at = {mark: F.instr("_out", mark) for mark in marks}
    p, s, m = marks
    prefix = F.when(F.col("_form") == PSM, at[s] - 1 - len(p)).when(F.col("_form") == SPM, at[m] - at[p] - len(p))
    middle = F.when(F.col("_form") != PLAIN, F.char_length("_out") - at[m] - len(m) + 1)
    made = F.struct(
        F.col("_n").alias("n"), F.col("_form").alias("form"), prefix.cast("bigint").alias("prefix_chars"), middle.cast("bigint").alias("middle_chars"), F.col("_out").alias("output")
    )
    return cut.select("_row.*", made.alias(name))


def restore(output: Column, form: Column, rules: Infill = Infill()) -> Column:
    """The text that ``fill_in_middle`` was given (empty for null)."""
    p, s, m = (rf"\Q{mark}\E" for mark in (rules.prefix, rules.suffix, rules.middle))
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z"), F.lit("$2$3$1"))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
