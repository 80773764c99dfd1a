"""Number coercion. Anything that is no number becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Spark's text-to-double cast also takes Java suffixes such as ``1d``; these
# patterns keep them out. They also spare the casts text that is no number,
# on which they are slow.
_INTEGER = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NOT_FINITE = r"^\s*[+-]?(?i:inf|infinity|nan)\s*$"


def coerce_float(c: Column, dtype: T.DataType) -> Column:
    """Double; NaN and junk are null, infinity stays."""
    if isinstance(dtype, T.StringType):
        c = F.when(c.rlike(_DECIMAL) | c.rlike(_NOT_FINITE), c)
    elif not isinstance(dtype, (T.NumericType, T.BooleanType, T.NullType)):
        return F.lit(None).cast("double")
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def coerce_int(c: Column, dtype: T.DataType) -> Column:
    """Bigint; a fraction is cut off, NaN, infinity and junk are null.

    Values beyond 64 bits are null as well.
    """
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(dtype, T.StringType):
        whole = F.when(c.rlike(_INTEGER), c.try_cast("bigint"))
        return F.coalesce(whole, F.when(c.rlike(_DECIMAL), c.try_cast("double").try_cast("bigint")))
    if isinstance(dtype, T.NumericType):
        return c.try_cast("bigint")
    return F.lit(None).cast("bigint")


def fill_numeric(c: Column, fill: float | int) -> Column:
    return F.coalesce(c, F.lit(fill))


def clip_non_negative(c: Column, zero: float | int) -> Column:
    """Negative values become zero. NaN must be gone already (``coerce_float``)."""
    return F.greatest(c, F.lit(zero))
