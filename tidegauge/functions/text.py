"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character that counts as white space at the ends of a
# text (SQL ``trim`` alone removes only the blank).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def normalize_string(c: Column, lower: bool = True) -> Column:
    """Text without outer white space; blank becomes null."""
    text = F.nullif(strip(c.cast("string")), F.lit(""))
    return F.lower(text) if lower else text


def normalize_deployment(c: Column, allowed: tuple[str, ...]) -> Column:
    """The deployment type in lower case, ``unknown`` when not allowed or missing."""
    name = F.lower(strip(c.cast("string")))
    return F.when(name.isin(*allowed), name).otherwise(F.lit("unknown"))


def derive_dataset_type(dataset: Column, deployment: Column) -> Column:
    """The first of the two that is not empty, as written, else ``unknown``."""
    return F.coalesce(
        F.nullif(dataset.cast("string"), F.lit("")),
        F.nullif(deployment.cast("string"), F.lit("")),
        F.lit("unknown"),
    )
