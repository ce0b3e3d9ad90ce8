"""Test scaffolding: OHLCV bars and lake inputs derived from the driver tables.

The given tables hold no price bars, so bars are a tumbling-window
aggregate of ``events`` (one symbol per ``event_type``).  Everything here
is a Spark plan over the given tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_from_events(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Tumbling-window OHLCV bars: ``symbol, ts, dt, open..vwap``.

    open/close are the values at the first/last ``(ts, event_id)`` of the
    window; volume is the ``k`` field of ``props``.  One partial
    aggregate per input split, then one shuffle on ``(symbol, ts)``.
    """
    ev = events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ets"),
        "event_id", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    # one number that orders by (time, event): min_by/max_by on it aggregate by hash, without sorting the events
    order = F.unix_micros("ets").cast("decimal(20,0)") * F.lit(10 ** 12).cast("decimal(13,0)") + F.col("event_id")
    bars = (ev.groupBy("symbol", F.date_trunc(unit, "ets").alias("ts"))
              .agg(F.min_by("value", order).alias("open"),
                   F.max("value").alias("high"),
                   F.min("value").alias("low"),
                   F.max_by("value", order).alias("close"),
                   F.sum("k").alias("volume"),
                   F.count(F.lit(1)).alias("num_trades"),
                   (F.sum(F.col("value") * F.col("k"))
                    / F.nullif(F.sum("k"), F.lit(0.0))).alias("vwap")))
    return bars.withColumn("dt", F.to_date("ts"))


def bars(spark: SparkSession, sf_dir: str, unit: str = "hour") -> DataFrame:
    return bars_from_events(table(spark, sf_dir, "events"), unit)


def _hour_number(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / 3600)


def quotes_from_events(events: DataFrame) -> DataFrame:
    """Quotes ``symbol, ts, bid, ask, seq``: an event is a quote around its value,
    ``k`` cents wide on either side; every 11th has no ask and every 13th is crossed."""
    k = F.get_json_object("props", "$.k").cast("double") / 100
    side = F.when(F.col("event_id") % 13 == 0, -k - 0.01).otherwise(k)
    return events.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), (F.col("value") - side).alias("bid"),
                         F.when(F.col("event_id") % 11 != 0, F.col("value") + side).alias("ask"), F.col("event_id").alias("seq"))


def bronze_bars(b: DataFrame, with_duplicates: bool = True, with_nulls: bool = True) -> DataFrame:
    """Vendor-named bronze rows ``t,o,h,l,c,v,n,vw`` plus ``symbol, dt`` and an
    ingest sequence.  Duplicates: a later-ingested copy with a shifted close.
    Nulls: close is null on bars whose epoch hour number is divisible by 17."""
    base = b.select(
        "symbol", "dt",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"),
        F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
        F.col("close").alias("c"), F.col("volume").alias("v"),
        F.col("num_trades").alias("n"), F.col("vwap").alias("vw"),
        F.lit(0).alias("ingest_seq"),
        _hour_number(F.col("ts")).alias("_hn"),
    )
    out = base
    if with_duplicates:
        dup = base.withColumn("c", F.col("c") + F.lit(0.5)).withColumn("ingest_seq", F.lit(1))
        out = out.unionByName(dup)
    if with_nulls:
        out = out.withColumn("c", F.when(F.col("_hn") % 17 == 0, F.lit(None).cast("double"))
                             .otherwise(F.col("c")))
    return out.drop("_hn")


def bars_json_pages(b: DataFrame) -> DataFrame:
    """Landed vendor pages: per symbol and day, one page for the first half of
    the day (with a next-page token) and one for the rest.  Each page is a JSON
    document ``{"bars": [...], "next_page_token": ...}``; one extra page per
    symbol carries ``bars: null`` (an empty answer)."""
    item = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"),
        F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
        F.col("close").alias("c"), F.col("volume").alias("v"),
        F.col("num_trades").alias("n"), F.col("vwap").alias("vw"))
    page_no = F.when(F.hour("ts") < 12, F.lit(0)).otherwise(F.lit(1))
    pages = (b.groupBy("symbol", "dt", page_no.alias("page"))
              .agg(F.sort_array(F.collect_list(F.struct(F.col("ts").alias("_k"), item.alias("b"))))
                   .alias("items")))
    pages = pages.select(
        "symbol", "dt", "page",
        F.to_json(F.struct(
            F.transform("items", lambda x: x["b"]).alias("bars"),
            F.when(F.col("page") == 0, F.concat(F.lit("tok-"), F.col("dt").cast("string")))
             .alias("next_page_token"))).alias("body"))
    empty = (b.groupBy("symbol").agg(F.min("dt").alias("dt"))
              .select("symbol", "dt", F.lit(9).alias("page"),
                      F.lit('{"bars": null, "next_page_token": null}').alias("body")))
    return pages.unionByName(empty)


def drift_frames(b: DataFrame) -> list[DataFrame]:
    """Four frames split by day, each naming its time column differently."""
    names = ["ts", "utc_timestamp", "timestamp", "datetime"]
    cols = ["open", "high", "low", "close", "volume", "symbol", "dt"]
    out = []
    for i, name in enumerate(names):
        part = b.filter(F.dayofmonth("dt") % 4 == i)
        out.append(part.select(F.col("ts").alias(name), *cols))
    return out


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dt, pnl``: sum of order prices per order date (a daily P&L series)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("dt"))
             .agg(F.sum("o_totalprice").alias("pnl")))
