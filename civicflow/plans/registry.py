"""Query registry: a Spark plan and its independent SQL oracle per name.

Every entry reads the whole fixture tables of ``sf_dir`` (through a binding)
and runs one operator of the library over all of it.  ``SQL`` holds the
DuckDB statement computing the same result; entries without SQL get the
weaker row-count check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..sources.bindings import requests_ev, requests_ord
from . import oracle_sql as O

Query = Callable[[SparkSession, str], DataFrame]

SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def ev_clean(spark: SparkSession, d: str, max_days: float = 90) -> DataFrame:
    return C.clean_pipeline(requests_ev(spark, d), max_days)


def ord_clean(spark: SparkSession, d: str, max_days: float = 90) -> DataFrame:
    return C.clean_pipeline(requests_ord(spark, d), max_days)


R = O.DAYS
CK = O.CLOSED_KNOWN


def cont(sql: str) -> str:
    """Join a body that starts with more CTEs (``, name AS (...)``) onto the prefix."""
    return sql.replace("\n, ", ",\n", 1)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (comparison precision of the oracle check)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def sql_round(inner: str, cols: list[str], digits: int = 6) -> str:
    """``SELECT * REPLACE (ROUND(c, d) AS c, ...) FROM (inner)``."""
    quoted = [f'"{c}"' for c in cols]
    rep = ", ".join(f"{O.rnd(q, digits)} AS {q}" for q in quoted)
    return f"SELECT * REPLACE ({rep}) FROM (\n{inner}\n) AS _r"
