"""Registry of the queries and of the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, decimals: int) -> DataFrame:
    """Rounded doubles, timestamps without zone, as in the SQL results."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, decimals)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, decimals: int = 6) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir), decimals)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
