"""Bronze -> silver -> gold bar cleaning and enrichment.

Each step is one ``DataFrame -> DataFrame`` function over all days at once;
the reference's per-file loop becomes the ``(symbol, dt)`` key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab import SESSION_KEYS
from barlab.functions import indicators as ind
from barlab.functions import scalar
from barlab.schemas import FIELD_MAP, GOLD_COLUMNS, SILVER_RENAMES, TS_ALIASES

CANONICAL = ["ts", "open", "high", "low", "close", "volume"]


def to_ts(c: Column, dtype: T.DataType) -> Column:
    """Timestamp from a text or timestamp column; bad text gives NULL."""
    if isinstance(dtype, T.StringType):
        return scalar.parse_ts(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c.cast("timestamp")
    return c


def normalize_ts(df: DataFrame, out: str = "ts", drop_aliases: bool = True) -> DataFrame:
    """``ts`` from the first present of ``ts, utc_timestamp, timestamp,
    datetime``; with several present (a union by name) they are coalesced in
    that order (P2, X3)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in TS_ALIASES if c in types]
    if not present:
        raise ValueError(f"no time column among {TS_ALIASES}")
    ts = F.coalesce(*[to_ts(F.col(c), types[c]) for c in present]) if len(present) > 1 \
        else to_ts(F.col(present[0]), types[present[0]])
    others = [c for c in present if c != out] if drop_aliases else []
    return df.withColumn(out, ts).drop(*others)


def keep_present(df: DataFrame, keep: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Keep-list projection in the given order, skipping absent columns."""
    return df.select(*[c for c in [*keep, *extra] if c in df.columns])


def canonical_bars(df: DataFrame, extra: Sequence[str] = ("symbol", "dt")) -> DataFrame:
    """Vendor short names ``t,o,h,l,c,v`` -> ``ts,open,high,low,close,volume``;
    other vendor fields dropped (S3, P1)."""
    renames = {k: v for k, v in FIELD_MAP.items() if k in df.columns}
    out = df.withColumnsRenamed(renames)
    if "ts" in out.columns:
        out = out.withColumn("ts", to_ts(F.col("ts"), out.schema["ts"].dataType))
    return keep_present(out, CANONICAL, extra)


def series_keys(df: DataFrame) -> tuple[str, ...]:
    """``symbol, dt`` and, where the bars carry it, ``resolution``: bars of two
    resolutions are never one series."""
    return ("symbol", "resolution", "dt") if "resolution" in df.columns else SESSION_KEYS


def dedup_keep_first(df: DataFrame, keys: Sequence[str] = ("symbol", "dt", "ts"),
                     order: str = "ingest_seq") -> DataFrame:
    """One row per key, and per ``resolution`` if there is one: the earliest in
    ``order`` (P6).

    ``min(struct(order, *rest))`` is a partial aggregate, so duplicates are
    collapsed map-side before the shuffle (a hot key is pre-combined)."""
    keys = [*keys, *(["resolution"] if "resolution" in df.columns and "resolution" not in keys else [])]
    rest = [c for c in df.columns if c not in keys and c != order]
    first = F.min(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_f")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_f.{c}").alias(c) for c in rest])


def bronze_to_silver(bronze: DataFrame, resolution: str = "1h") -> DataFrame:
    """Parse ``t``, keep the first-ingested row per timestamp, drop rows with
    any NULL, rename to long names (P19: X6, O1, P6, P4, P1 in that order).
    Bronze rows that carry a ``resolution`` keep theirs."""
    df = bronze.withColumn("ts", to_ts(F.col("t"), bronze.schema["t"].dataType)).drop("t")
    df = dedup_keep_first(df, ("symbol", "dt", "ts"), "ingest_seq")
    df = df.dropna(how="any")
    df = df.withColumnsRenamed({k: v for k, v in SILVER_RENAMES.items() if k in df.columns})
    return df.select("ts", "open", "high", "low", "close", "volume", "num_trades", "vwap", "symbol",
                     F.col("resolution") if "resolution" in df.columns else F.lit(resolution).alias("resolution"), "dt")


def silver_to_gold(silver: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``utc_timestamp, et, session, open..vwap, return_1m`` (+ partition
    columns): New York wall time, RTH/AH label, one-bar return restarting
    each day, for each resolution (P20: X8, P10, W12, P3)."""
    df = ind.pct_return(silver, "close", "return_1m", keys=keys or series_keys(silver))
    df = (df.withColumnRenamed("ts", "utc_timestamp")
            .withColumn("et", scalar.eastern(F.col("utc_timestamp"))))
    df = df.withColumn("session", scalar.session_label(F.col("et")))
    part = [c for c in ("symbol", "resolution", "dt") if c in df.columns]
    return df.select(*GOLD_COLUMNS, *part)


def load_session(df: DataFrame, symbol: str | None = None, day: str | None = None,
                 resolution: str | None = None) -> DataFrame:
    """One session as the signal code wants it: optional symbol/day filter
    (partition pruning on a lake scan), normalised ``ts``, the six canonical
    columns, NULL ts dropped, ts rounded to the millisecond (S10, P5, X7)."""
    if resolution is not None:
        df = df.filter(F.col("resolution") == resolution)
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    if day is not None:
        df = df.filter(F.col("dt") == F.lit(day).cast("date"))
    df = normalize_ts(df)
    df = keep_present(df, CANONICAL, series_keys(df) if resolution is None else ("symbol", "dt"))
    df = df.dropna(subset=["ts"])
    return df.withColumn("ts", scalar.round_ms(F.col("ts")))


REQUIRED = ["open", "high", "low", "close", "volume"]


def load_session_strict(df: DataFrame, helpers: Sequence[str] = ("filename",)) -> DataFrame:
    """As :func:`load_session`, but a missing required column raises
    ``ValueError``; helper columns are dropped (S11, P7, P18)."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return load_session(df.drop(*[h for h in helpers if h in df.columns]))
