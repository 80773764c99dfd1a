"""Decode messages and hold rows against the canonical contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegauge.functions.text import normalize_deployment
from tidegauge.schema import (
    ALIASES,
    CANONICAL,
    CANONICAL_COLS,
    DEPLOYMENT_TYPES,
    DURATION_COLS,
    LEGACY,
    UI_COLS,
    WAREHOUSE_COLS,
)

KEYS_COL = "_keys"


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# All names a raw message may use; values stay text and are coerced later,
# so "5" and 5 read alike.
RAW_MESSAGE = text_schema(
    list(dict.fromkeys(["dataset_type", *[n for names in ALIASES.values() for n in names]]))
)


def computed_once(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """``select``, but a later filter is not moved below it.

    Catalyst writes a selected expression into every condition that a filter
    sets on it, and so would decode and convert a message once per condition.
    A generator's output is computed once; all columns are, so this is for
    rows that come from messages, where no column can be left unread anyway.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def decode_json(
    df: DataFrame, schema: T.StructType = RAW_MESSAGE, value_col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per message whose payload is a JSON object, other payloads none.

    ``_keys`` lists the names the message really had, which tells an explicit
    null from an absent field.
    """
    text = F.col(value_col).cast("string")
    objects = df.filter(text.rlike(r"^\s*\{")).select(
        *keep, text.alias("_value"), F.json_object_keys(text).alias(KEYS_COL)
    )
    # An object reads as an array of one row; see ``computed_once``.
    rows = T.ArrayType(T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    decoded = objects.select(*keep, KEYS_COL, F.inline(F.from_json("_value", rows, options)))
    return decoded.filter(F.col("_corrupt").isNull()).select(*keep, *schema.fieldNames(), KEYS_COL)


def forbid_extra(
    df: DataFrame, allowed: Sequence[str] = tuple(CANONICAL_COLS), value_col: str = "value"
) -> DataFrame:
    """Messages that have no field outside ``allowed``."""
    keys = F.json_object_keys(F.col(value_col).cast("string"))
    extra = F.array_except(keys, F.array(*[F.lit(a) for a in allowed]))
    return df.filter(F.size(extra) == 0)


def typed_message(df: DataFrame, keep: Sequence[str] = (), more: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical columns out of a message decoded as text.

    Text that is no value of its type becomes null and so fails validation;
    a whole number may be written as ``5`` or ``5.0``. ``keep`` names columns to
    carry along, ``more`` further columns with their types.
    """
    added = [F.col(name).try_cast(kind).alias(name) for name, kind in (more or {}).items()]
    return computed_once(df, [*keep, *[_typed(field).alias(field.name) for field in CANONICAL], *added])


def _typed(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, T.LongType):
        as_double = c.try_cast("double")
        whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
        return F.coalesce(c.try_cast("bigint"), whole)
    return c.try_cast(field.dataType)


def _problems() -> dict[str, Column]:
    """Reason -> is the row broken in this way. Null input counts as broken."""
    c = F.col
    checks = {"query_id": F.length("query_id") == 0}
    checks |= {n: c(n) < 0 for n in DURATION_COLS}
    # NaN sorts above every number in Spark, so it needs a test of its own.
    checks |= {
        n: (c(n) < 0) | F.isnan(n) for n in ("scanned_mb", "spilled_mb", "duration_seconds", "spill_pressure")
    }
    checks |= {"queued": c("queued").isNull()}
    checks |= {
        "end_before_start": c("execution_end_time") < c("execution_start_time"),
        "arrival_after_end": c("arrival_timestamp") > c("execution_end_time"),
    }
    return {reason: F.coalesce(broken, F.lit(True)) for reason, broken in checks.items()}


def _with_known_deployment(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "deployment_type",
        F.when(
            F.col("deployment_type").isNotNull(),
            normalize_deployment(F.col("deployment_type"), DEPLOYMENT_TYPES),
        ),
    )


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for cond in conditions[1:]:
        out = out | cond
    return out


def validate_canonical(df: DataFrame) -> DataFrame:
    """Rows that meet the canonical contract.

    A deployment type outside the accepted ones becomes ``unknown``; a missing
    one is an error.
    """
    broken = {"deployment_type": F.col("deployment_type").isNull(), **_problems()}
    return _with_known_deployment(df).filter(~_any(list(broken.values())))


def rejected_rows(df: DataFrame) -> DataFrame:
    """The rows ``validate_canonical`` drops, with ``reject_reason``."""
    broken = {"deployment_type": F.col("deployment_type").isNull(), **_problems()}
    reasons = F.concat_ws(",", *[F.when(cond, F.lit(reason)) for reason, cond in broken.items()])
    return df.filter(_any(list(broken.values()))).withColumn("reject_reason", reasons)


def project_ui(df: DataFrame) -> DataFrame:
    return df.select(*UI_COLS)


def project_warehouse(df: DataFrame) -> DataFrame:
    return df.select(*WAREHOUSE_COLS)


def project_legacy_events(df: DataFrame) -> DataFrame:
    """The 14 legacy columns; those the input lacks are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in LEGACY
        ]
    )


def evolve_add_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns added to a table later read as 0.0 in its older rows."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(0.0)) if n in df.columns else F.lit(0.0) for n in names}
    )
