"""Registry of named queries: Spark plan + optional DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables.
Output doubles are rounded to 6 places on both sides so that engines that sum
in a different order still agree; every computed column is aliased to the
same name in the plan and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def _utc(fn: QueryFn) -> QueryFn:
    """Bar timestamps are UTC instants: pin the session time zone before the
    plan is built, whatever session the caller hands in."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from barlab.session import ship_package
        if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, _utc(fn), sql, headline)
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (result presentation only), half away from
    zero on the binary value -- the same arithmetic as SQL ``round(x, p)`` on
    a double in the oracle engine."""
    from barlab.functions.scalar import round_half_away
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_away(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sql_final(inner: str, cols: Sequence[str], doubles: Sequence[str], places: int = 6,
              order: str | None = None) -> str:
    """Wrap an oracle query, rounding the listed double columns."""
    sel = ", ".join(f"round({c}, {places}) AS {c}" if c in doubles else c for c in cols)
    tail = f" ORDER BY {order}" if order else ""
    return f"SELECT {sel} FROM (\n{inner}\n) q{tail}"
