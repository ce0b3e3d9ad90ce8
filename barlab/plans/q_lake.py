"""Registered queries: ingest, medallion, lake scans, SQL views and scalar
helpers (SURVEY 2.1, 2.2, 2.4 A1-A4/A14, 2.7 O7, 2.8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barlab import fixtures
from barlab.functions import indicators as ind
from barlab.functions import scalar
from barlab.operators import backtest as bt
from barlab.operators import fib, medallion
from barlab.plans.oracle import with_bars
from barlab.plans.registry import register, rounded, sql_final
from barlab.sources import ingest, lake
from barlab.session import exists, scratch_dir

BAR6 = ["symbol", "ts", "open", "high", "low", "close", "volume"]
BAR6_D = ["open", "high", "low", "close", "volume"]
SILVER_COLS = ["ts", "open", "high", "low", "close", "volume", "num_trades", "vwap", "symbol", "resolution", "dt"]
SILVER_D = ["open", "high", "low", "close", "volume", "vwap"]
DAY = "2024-01-15"

_SILVER_CTE = ("silver AS (SELECT ts, open, high, low, close, volume, num_trades, vwap, symbol, '1h' AS resolution, dt "
               "FROM bars WHERE floor(epoch(ts) / 3600) % 17 <> 0 AND open IS NOT NULL AND high IS NOT NULL "
               "AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL AND num_trades IS NOT NULL "
               "AND vwap IS NOT NULL)")
_ET = "timezone('America/New_York', ts AT TIME ZONE 'UTC')"
_GOLD_CTE = (f"gold AS (SELECT ts AS utc_timestamp, {_ET} AS et, CASE WHEN (hour({_ET}) > 9 OR (hour({_ET}) = 9 "
             f"AND minute({_ET}) >= 30)) AND (hour({_ET}) < 16 OR (hour({_ET}) = 16 AND minute({_ET}) = 0)) "
             "THEN 'RTH' ELSE 'AH' END AS session, open, high, low, close, volume, num_trades, vwap, "
             "close / nullif(lag(close) OVER (PARTITION BY symbol, dt ORDER BY ts), 0.0) - 1.0 AS return_1m, symbol, resolution, dt "
             "FROM silver)")
GOLD_COLS = ["utc_timestamp", "et", "session", "open", "high", "low", "close", "volume", "num_trades", "vwap",
             "return_1m", "symbol", "resolution", "dt"]
GOLD_D = ["open", "high", "low", "close", "volume", "vwap", "return_1m"]

_LAKES: dict[tuple, str] = {}


def _silver(spark, sf):
    return medallion.bronze_to_silver(fixtures.bronze_bars(fixtures.bars(spark, sf)))


def _lake(spark, sf, kind: str = "silver") -> str:
    """A lake written once per session and input folder under the shared
    checkpoint folder (the written table doubles as a lineage cut)."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _LAKES or not exists(spark, _LAKES[key]):  # scratch folders may have been cleaned since
        path = scratch_dir(spark, f"lake-{kind}")
        if kind == "silver":
            lake.write_lake(_silver(spark, sf), path)
        elif kind == "gold":
            lake.write_lake(medallion.silver_to_gold(_silver(spark, sf)), path)
        elif kind == "drift":
            for frame in fixtures.drift_frames(fixtures.bars(spark, sf)):
                lake.write_lake(frame.withColumn("resolution", F.lit("1h")), path, mode="append")
        _LAKES[key] = path
    return _LAKES[key]


# ---------------------------------------------------------------- S1/S3 ingest
def _landed(spark, pages, name: str):
    return ingest.read_landed(spark, ingest.land_pages(pages, scratch_dir(spark, name)), "part-*")


def q_ingest_bars_json(spark, sf):
    pages = fixtures.bars_json_pages(fixtures.bars(spark, sf))
    return rounded(ingest.ingest_bars_json(pages).select(*BAR6))


def q_ingest_landed(spark, sf):
    """Pages landed as files, one a page, read back whole and flattened to bars."""
    landed = _landed(spark, fixtures.bars_json_pages(fixtures.bars(spark, sf)), "pages")
    return rounded(ingest.ingest_bars_json(landed).select(*BAR6))


register("ingest_bars_json", sql=sql_final(with_bars() + " SELECT symbol, ts, open, high, low, close, volume FROM bars",
                                           BAR6, BAR6_D))(q_ingest_bars_json)


register("ingest_landed", sql=sql_final(with_bars() + " SELECT symbol, ts, open, high, low, close, volume FROM bars",
                                        BAR6, BAR6_D))(q_ingest_landed)


def q_canonical_bars(spark, sf):
    bronze = fixtures.bronze_bars(fixtures.bars(spark, sf), with_duplicates=False, with_nulls=False)
    return rounded(medallion.canonical_bars(bronze, extra=("symbol",)).select(*BAR6))


register("canonical_bars", sql=sql_final(with_bars() + " SELECT symbol, ts, open, high, low, close, volume FROM bars",
                                         BAR6, BAR6_D))(q_canonical_bars)


def q_ingest_day_range(spark, sf):
    """Requested days (each symbol's range widened by two days on each side)
    with bars landed per day; days without data report ``empty`` (S2, X10)."""
    pages = fixtures.bars_json_pages(fixtures.bars(spark, sf))
    return ingest.ingest_day_range(ingest.ingest_bars_json(pages), widen=2)


def q_ingest_day_status(spark, sf):
    """Landed days with their files; on every seventh day of a month the second
    page was cut off: those days report ``failed`` with the bars of the first, and
    the run goes on (S2)."""
    pages = fixtures.bars_json_pages(fixtures.bars(spark, sf))
    cut = (F.dayofmonth("dt") % 7 == 0) & (F.col("page") == 1)
    pages = pages.withColumn("body", F.when(cut, F.expr("substring(body, 1, length(body) - 3)")).otherwise(F.col("body")))
    return ingest.day_status(_landed(spark, pages, "cut-pages"), widen=2)


register("ingest_day_status", sql=with_bars(
    "r AS (SELECT symbol, min(dt) AS s, max(dt) AS e FROM bars GROUP BY symbol)",
    "d AS (SELECT symbol, s, CAST(unnest(generate_series(CAST(s - 2 AS TIMESTAMP), CAST(e + 2 AS TIMESTAMP), INTERVAL 1 DAY)) "
    "AS DATE) AS dt FROM r)",
    "p AS (SELECT symbol, dt, CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END AS page, count(*) AS n FROM bars GROUP BY ALL)",
    "q AS (SELECT *, day(dt) % 7 = 0 AND page = 1 AS cut FROM p)",
    "c AS (SELECT symbol, dt, count(*) AS files, count(*) FILTER (cut) AS failed, coalesce(sum(n) FILTER (NOT cut), 0) AS n "
    "FROM q GROUP BY symbol, dt)")
    + " SELECT d.symbol, d.dt, coalesce(files, 0) + CASE WHEN d.dt = d.s THEN 1 ELSE 0 END AS n_files, coalesce(failed, 0) AS n_failed, "
    "CAST(coalesce(n, 0) AS BIGINT) AS n_bars, CASE WHEN coalesce(failed, 0) > 0 THEN 'failed' WHEN coalesce(n, 0) > 0 THEN 'ok' "
    "ELSE 'empty' END AS status FROM d LEFT JOIN c ON c.symbol = d.symbol AND c.dt = d.dt")(q_ingest_day_status)


def q_corrupt_pages(spark, sf):
    """Pages cut off in the middle, per symbol: counted aside, never lost."""
    pages = fixtures.bars_json_pages(fixtures.bars(spark, sf))
    broken = pages.filter("page = 0").withColumn("body", F.expr("substring(body, 1, length(body) - 3)"))
    return ingest.corrupt_pages(pages.unionByName(broken)).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_corrupt"))


register("corrupt_pages", sql=with_bars() + " SELECT symbol, count(DISTINCT dt) AS n_corrupt FROM bars WHERE hour(ts) < 12 "
         "GROUP BY symbol")(q_corrupt_pages)


register("ingest_day_range", sql=with_bars(
    "r AS (SELECT symbol, min(dt) - 2 AS s, max(dt) + 2 AS e FROM bars GROUP BY symbol)",
    "d AS (SELECT symbol, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) "
    "AS DATE) AS dt FROM r)",
    "c AS (SELECT symbol, dt, count(*) AS n_bars FROM bars GROUP BY symbol, dt)")
    + " SELECT d.symbol, d.dt, coalesce(c.n_bars, 0) AS n_bars, CASE WHEN coalesce(c.n_bars, 0) > 0 THEN 'ok' "
    "ELSE 'empty' END AS status FROM d LEFT JOIN c ON c.symbol = d.symbol AND c.dt = d.dt")(q_ingest_day_range)


# ---------------------------------------------------------------- P19 / P6 / P20
def q_bronze_to_silver(spark, sf):
    return rounded(_silver(spark, sf))


register("bronze_to_silver", sql=sql_final(with_bars(_SILVER_CTE) + " SELECT * FROM silver",
                                           SILVER_COLS, SILVER_D))(q_bronze_to_silver)


def q_dedup_keep_first(spark, sf):
    """Duplicated bronze rows (a later copy with another close) reduced to the
    first-ingested row per (symbol, ts) (P6)."""
    bronze = fixtures.bronze_bars(fixtures.bars(spark, sf), with_duplicates=True, with_nulls=False)
    d = medallion.dedup_keep_first(bronze, ("symbol", "dt", "t"), "ingest_seq")
    return rounded(d.select("symbol", "t", F.col("c").alias("close"), F.col("o").alias("open")))


register("dedup_keep_first", sql=sql_final(with_bars()
         + " SELECT symbol, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS t, close, open FROM bars",
         ["symbol", "t", "close", "open"], ["close", "open"]))(q_dedup_keep_first)


def q_silver_to_gold(spark, sf):
    return rounded(medallion.silver_to_gold(_silver(spark, sf)))


register("silver_to_gold", sql=sql_final(with_bars(_SILVER_CTE, _GOLD_CTE) + " SELECT * FROM gold",
                                         GOLD_COLS, GOLD_D))(q_silver_to_gold)


def q_session_label(spark, sf):
    b = fixtures.bars(spark, sf).withColumn("et", scalar.eastern(F.col("ts")))
    return b.select("symbol", "ts", "et", scalar.session_label(F.col("et")).alias("session"),
                    scalar.eod_flag(F.col("et")).alias("eod"))


register("session_label", sql=with_bars() + f" SELECT symbol, ts, {_ET} AS et, CASE WHEN (hour({_ET}) > 9 OR "
         f"(hour({_ET}) = 9 AND minute({_ET}) >= 30)) AND (hour({_ET}) < 16 OR (hour({_ET}) = 16 AND "
         f"minute({_ET}) = 0)) THEN 'RTH' ELSE 'AH' END AS session, hour({_ET}) = 15 AND minute({_ET}) >= 55 AS eod "
         "FROM bars")(q_session_label)


def q_eod_flag(spark, sf):
    """Flatten-time flag on minute bars, New York wall clock."""
    b = fixtures.bars(spark, sf, unit="minute").withColumn("et", scalar.eastern(F.col("ts")))
    return b.select("symbol", "ts", scalar.eod_flag(F.col("et")).alias("eod"))


register("eod_flag", sql="WITH m AS (SELECT DISTINCT event_type AS symbol, date_trunc('minute', ts) AS ts FROM events) "
         f"SELECT symbol, ts, hour({_ET}) = 15 AND minute({_ET}) >= 55 AS eod FROM m")(q_eod_flag)


# ---------------------------------------------------------------- lake scans
def q_scan_bars(spark, sf):
    return rounded(lake.scan(spark, _lake(spark, sf)).select(*SILVER_COLS))


register("scan_bars", sql=sql_final(with_bars(_SILVER_CTE) + " SELECT * FROM silver", SILVER_COLS, SILVER_D))(q_scan_bars)


def q_write_lake_roundtrip(spark, sf):
    """Gold written partitioned by symbol/resolution/day and read back."""
    return rounded(lake.scan(spark, _lake(spark, sf, "gold")).select(*GOLD_COLS))


register("write_lake_roundtrip", sql=sql_final(with_bars(_SILVER_CTE, _GOLD_CTE) + " SELECT * FROM gold",
                                               GOLD_COLS, GOLD_D))(q_write_lake_roundtrip)


def q_scan_union_by_name(spark, sf):
    """Day files written under four time-column names, read as one table with
    the schemas merged by name and ``ts`` coalesced (S5, O8, P2)."""
    df = lake.scan(spark, _lake(spark, sf, "drift"), merge_schema=True)
    return rounded(medallion.normalize_ts(df).select(*BAR6, "dt"))


register("scan_union_by_name", sql=sql_final(with_bars() + " SELECT symbol, ts, open, high, low, close, volume, dt "
                                             "FROM bars", [*BAR6, "dt"], BAR6_D))(q_scan_union_by_name)


def q_normalize_ts(spark, sf):
    """The four drifted frames unioned in memory by name, then ``ts`` from the
    first alias present (P2, O8, X3)."""
    u = lake.union_by_name(fixtures.drift_frames(fixtures.bars(spark, sf)))
    return rounded(medallion.normalize_ts(u).select(*BAR6))


register("normalize_ts", sql=sql_final(with_bars() + " SELECT symbol, ts, open, high, low, close, volume FROM bars",
                                       BAR6, BAR6_D))(q_normalize_ts)


def q_scan_partitioned(spark, sf):
    """Partition-pruned scan: one symbol, second half of the month."""
    df = lake.scan(spark, _lake(spark, sf))
    df = df.filter((F.col("symbol") == "click") & (F.col("dt") >= F.lit("2024-01-16").cast("date")))
    return rounded(df.select(*SILVER_COLS))


register("scan_partitioned", sql=sql_final(with_bars(_SILVER_CTE)
         + " SELECT * FROM silver WHERE symbol = 'click' AND dt >= DATE '2024-01-16'", SILVER_COLS, SILVER_D))(
    q_scan_partitioned)


def q_scan_with_filename(spark, sf):
    """Every row with the folder of the file it came from (S7); file names
    themselves are the writer's choice."""
    df = lake.scan(spark, _lake(spark, sf), with_filename=True)
    return df.select("symbol", "dt", "ts", F.regexp_extract("filename", "(dt=.*)/[^/]+[.]parquet$", 1).alias("folder"))


register("scan_with_filename", sql=with_bars(_SILVER_CTE) + " SELECT symbol, dt, ts, 'dt=' || dt AS folder FROM silver")(q_scan_with_filename)


def q_filename_parts(spark, sf):
    """symbol and day parsed back from every file path."""
    df = lake.filename_parts(lake.scan(spark, _lake(spark, sf), with_filename=True))
    return df.select(F.col("path_symbol").alias("symbol"), F.col("path_dt").alias("dt"),
                     (F.col("path_symbol") == F.col("symbol")).alias("symbol_ok"),
                     (F.col("path_dt") == F.col("dt")).alias("dt_ok")).distinct()


register("filename_parts", sql=with_bars(_SILVER_CTE) + " SELECT DISTINCT symbol, dt, true AS symbol_ok, "
         "true AS dt_ok FROM silver")(q_filename_parts)


def q_load_day_by_filename(spark, sf):
    """Rows of the files whose name carries one date."""
    df = lake.filter_by_filename_date(lake.scan(spark, _lake(spark, sf), with_filename=True), DAY)
    return rounded(df.select(*SILVER_COLS))


register("load_day_by_filename", sql=sql_final(with_bars(_SILVER_CTE) + f" SELECT * FROM silver WHERE dt = DATE '{DAY}'",
                                               SILVER_COLS, SILVER_D))(q_load_day_by_filename)


def q_load_session(spark, sf):
    return rounded(medallion.load_session(lake.scan(spark, _lake(spark, sf))).select(*BAR6, "dt"))


register("load_session", sql=sql_final(with_bars(_SILVER_CTE)
         + " SELECT symbol, ts, open, high, low, close, volume, dt FROM silver", [*BAR6, "dt"], BAR6_D))(q_load_session)


def q_load_session_strict(spark, sf):
    df = lake.scan(spark, _lake(spark, sf), with_filename=True)
    return rounded(medallion.load_session_strict(df).select(*BAR6, "dt"))


register("load_session_strict", sql=sql_final(with_bars(_SILVER_CTE)
         + " SELECT symbol, ts, open, high, low, close, volume, dt FROM silver", [*BAR6, "dt"], BAR6_D))(
    q_load_session_strict)


def q_lake_row_count(spark, sf):
    """Rows of the silver lake, from the footers of its files."""
    return lake.row_count(spark, _lake(spark, sf))


register("lake_row_count", sql=with_bars(_SILVER_CTE) + " SELECT count(*) AS n_rows FROM silver")(q_lake_row_count)


def q_lake_inventory(spark, sf):
    """Files, rows and days per symbol; no column is read."""
    return lake.footer_inventory(spark, _lake(spark, sf))


register("lake_inventory", sql=with_bars(_SILVER_CTE) + " SELECT symbol, count(DISTINCT dt) AS n_files, "
         "count(*) AS n_rows, min(dt) AS min_dt, max(dt) AS max_dt FROM silver GROUP BY symbol")(q_lake_inventory)


def q_available_dates(spark, sf):
    return lake.scan(spark, _lake(spark, sf)).select("dt").distinct()


register("available_dates", sql=with_bars(_SILVER_CTE) + " SELECT DISTINCT dt FROM silver")(q_available_dates)


def q_sql_view_query(spark, sf):
    """Canonical view over the drifted lake, queried with SQL."""
    name = lake.register_bar_view(spark, _lake(spark, sf, "drift"), "bars_view")
    return rounded(spark.sql(f"SELECT symbol, dt, ts, open, high, low, close, volume FROM {name} "
                             "ORDER BY ts ASC NULLS LAST"))


register("sql_view_query", sql=sql_final(with_bars() + " SELECT symbol, dt, ts, open, high, low, close, volume "
                                         "FROM bars", ["symbol", "dt", "ts", *BAR6_D], BAR6_D))(q_sql_view_query)


def q_sql_param_query(spark, sf):
    """Named-parameter SQL over the silver lake."""
    silver = lake.scan(spark, _lake(spark, sf))
    silver.createOrReplaceTempView("silver_lake")
    first, last = silver.agg(F.min("dt"), F.max("dt")).first()
    return rounded(spark.sql(
        "SELECT symbol, dt, count(*) AS n, max(high) AS high, min(low) AS low FROM silver_lake "
        "WHERE dt BETWEEN :start AND :end AND volume >= :min_volume GROUP BY symbol, dt",
        args={"start": first, "end": last, "min_volume": 0.0}))


register("sql_param_query", sql=sql_final(with_bars(_SILVER_CTE)
         + " SELECT symbol, dt, count(*) AS n, max(high) AS high, min(low) AS low FROM silver "
         "WHERE volume >= 0 GROUP BY symbol, dt",
         ["symbol", "dt", "n", "high", "low"], ["high", "low"]))(q_sql_param_query)


def q_union_days(spark, sf):
    """Per-day frames concatenated by name."""
    frames = [fixtures.bars(spark, sf).filter(F.dayofmonth("dt") % 3 == i) for i in range(3)]
    return rounded(lake.union_by_name(frames).select(*BAR6))


register("union_days", sql=sql_final(with_bars() + " SELECT symbol, ts, open, high, low, close, volume FROM bars",
                                     BAR6, BAR6_D))(q_union_days)


# ---------------------------------------------------------------- filters, labels
def q_filter_day(spark, sf):
    b = fixtures.bars(spark, sf)
    return rounded(b.filter(F.to_date("ts") == F.lit(DAY).cast("date")).select(*BAR6))


register("filter_day", sql=sql_final(with_bars() + f" SELECT symbol, ts, open, high, low, close, volume FROM bars "
                                     f"WHERE CAST(ts AS DATE) = DATE '{DAY}'", BAR6, BAR6_D))(q_filter_day)


_WINDOWS = ("09:35", "11:00", "14:00", "15:45")


def q_session_window_filter(spark, sf):
    """Bars inside any of the closed time-of-day windows (P9, X9; UTC clock
    as in the reference)."""
    b = fixtures.bars(spark, sf).filter(scalar.in_time_windows(F.col("ts"), _WINDOWS))
    return rounded(b.select(*BAR6, F.date_format("ts", "HH:mm").alias("hhmm")))


register("session_window_filter", sql=sql_final(
    with_bars() + " SELECT symbol, ts, open, high, low, close, volume, strftime(ts, '%H:%M') AS hhmm FROM bars WHERE "
    "(CAST(ts AS TIME) BETWEEN TIME '09:35' AND TIME '11:00') OR (CAST(ts AS TIME) BETWEEN TIME '14:00' AND TIME '15:45')",
    [*BAR6, "hhmm"], BAR6_D))(q_session_window_filter)


def q_bar_direction(spark, sf):
    b = fixtures.bars(spark, sf)
    return rounded(b.select("symbol", "ts", "open", "close", (F.col("close") >= F.col("open")).alias("up_bar")))


register("bar_direction", sql=sql_final(with_bars() + " SELECT symbol, ts, open, close, close >= open AS up_bar FROM bars",
                                        ["symbol", "ts", "open", "close", "up_bar"], ["open", "close"]))(q_bar_direction)


def q_rsi_zone(spark, sf):
    """RSI 70/30 reference lines as a zone label."""
    b = ind.rsi(ind.with_index(fixtures.bars(spark, sf)), "close", 14, "rsi", variant="eps")
    z = F.when(F.col("rsi") >= 70, "overbought").when(F.col("rsi") <= 30, "oversold").otherwise("neutral")
    return rounded(b.select("symbol", "ts", "rsi", z.alias("zone")))


def _rsi_zone_sql():
    from barlab.plans.oracle import wilder_sql
    S = "PARTITION BY symbol, dt ORDER BY ts"
    return sql_final(with_bars(
        f"b AS (SELECT *, CAST(row_number() OVER ({S}) - 1 AS INTEGER) AS idx FROM bars)",
        f"d AS (SELECT *, close - lag(close) OVER ({S}) AS dlt FROM b)",
        "g AS (SELECT *, CASE WHEN dlt > 0 THEN dlt ELSE 0.0 END AS up, CASE WHEN dlt < 0 THEN -dlt ELSE 0.0 END AS dn FROM d)",
        f"s AS (SELECT *, 100.0 - 100.0 / (1.0 + ({wilder_sql('up', 14)}) / (({wilder_sql('dn', 14)}) + 1e-9)) AS rsi FROM g)")
        + " SELECT symbol, ts, rsi, CASE WHEN rsi >= 70 THEN 'overbought' WHEN rsi <= 30 THEN 'oversold' "
        "ELSE 'neutral' END AS zone FROM s", ["symbol", "ts", "rsi", "zone"], ["rsi"])


register("rsi_zone", sql=_rsi_zone_sql())(q_rsi_zone)


# ---------------------------------------------------------------- A2-A4, A14
def q_session_counts(spark, sf):
    """Bars per RTH/AH label per symbol (A2); the labels seen are the groups (A3)."""
    g = medallion.silver_to_gold(_silver(spark, sf))
    return g.groupBy("symbol", "session").agg(F.count(F.lit(1)).alias("n"))


register("session_counts", sql=with_bars(_SILVER_CTE, _GOLD_CTE)
         + " SELECT symbol, session, count(*) AS n FROM gold GROUP BY symbol, session")(q_session_counts)


def q_return_stats(spark, sf):
    """mean / sample std / min / max of the one-bar return per symbol (A4)."""
    g = medallion.silver_to_gold(_silver(spark, sf))
    return rounded(g.groupBy("symbol").agg(
        F.avg("return_1m").alias("mean"), F.stddev_samp("return_1m").alias("std"),
        F.min("return_1m").alias("min"), F.max("return_1m").alias("max")))


register("return_stats", sql=sql_final(with_bars(_SILVER_CTE, _GOLD_CTE)
         + " SELECT symbol, avg(return_1m) AS mean, stddev_samp(return_1m) AS std, min(return_1m) AS min, "
         "max(return_1m) AS max FROM gold GROUP BY symbol", ["symbol", "mean", "std", "min", "max"],
         ["mean", "std", "min", "max"]))(q_return_stats)


def q_signal_counts(spark, sf):
    """Per session: any long / any short signal and their counts."""
    s = bt.dashboard_signals(fixtures.bars(spark, sf))
    return s.groupBy("symbol", "dt").agg(
        F.bool_or("long_entry").alias("any_long"), F.bool_or("short_entry").alias("any_short"),
        F.count_if("long_entry").alias("n_long"), F.count_if("short_entry").alias("n_short"))


def _signal_counts_sql():
    from barlab.plans.q_backtest import _dash_ctes
    return (_dash_ctes() + " SELECT symbol, dt, bool_or(long_entry) AS any_long, bool_or(short_entry) AS any_short, "
            "count(*) FILTER (WHERE long_entry) AS n_long, count(*) FILTER (WHERE short_entry) AS n_short "
            "FROM sg GROUP BY symbol, dt")


register("signal_counts", sql=_signal_counts_sql())(q_signal_counts)


# ---------------------------------------------------------------- S24 backfill
def q_backfill_last_n(spark, sf, n: int = 300):
    """The last ``n`` bars of each symbol, as the live loop seeds its state."""
    b = fixtures.bars(spark, sf)
    w = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
    return rounded(b.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= n).select(*BAR6))


register("backfill_last_n", sql=sql_final(with_bars(
    "r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rk FROM bars)")
    + " SELECT symbol, ts, open, high, low, close, volume FROM r WHERE rk <= 300", BAR6, BAR6_D))(q_backfill_last_n)


# ---------------------------------------------------------------- S25 option chain
def q_explode_option_chain(spark, sf):
    """Landed option-chain documents (one per symbol and day, strikes around
    the day's close) -> the first three contracts of each (S25, S26)."""
    d = fixtures.bars(spark, sf).groupBy("symbol", "dt").agg(F.max_by("close", "ts").alias("last"))
    strikes = F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda k: F.struct(
        F.concat_ws("-", F.col("symbol"), F.col("dt").cast("string"), k.cast("string")).alias("symbol"),
        (F.round(F.col("last"), 0) + k).alias("strike"),
        F.when(k < 0, F.lit("put")).otherwise(F.lit("call")).alias("type"),
        F.date_add(F.col("dt"), 7).cast("string").alias("expiration")))
    docs = d.select(F.col("symbol").alias("underlying"), "dt",
                    F.to_json(F.struct(strikes.alias("option_chain"))).alias("body"))
    # landed as raw text, one document a file, and read from there
    landed = _landed(spark, docs.select(F.col("underlying").alias("symbol"), "dt", F.lit(0).alias("page"), "body"), "chains")
    parsed = ingest.explode_option_chain(landed.withColumnRenamed("symbol", "underlying"), keep=("underlying", "dt"))
    return rounded(parsed.select("underlying", "dt", "pos", F.col("symbol").alias("contract"), "strike", "type",
                                 "expiration"))


register("explode_option_chain", sql=sql_final(with_bars(
    "d AS (SELECT symbol, dt, arg_max(close, ts) AS last FROM bars GROUP BY symbol, dt)",
    "k AS (SELECT unnest([-2, -1, 0, 1, 2]) AS k, generate_subscripts([-2, -1, 0, 1, 2], 1) - 1 AS pos)")
    + " SELECT symbol AS underlying, dt, CAST(pos AS INTEGER) AS pos, symbol || '-' || CAST(dt AS VARCHAR) || '-' || "
    "CAST(k AS VARCHAR) AS contract, round(last, 0) + k AS strike, CASE WHEN k < 0 THEN 'put' ELSE 'call' END AS type, "
    "CAST(dt + 7 AS VARCHAR) AS expiration FROM d, k WHERE pos < 3",
    ["underlying", "dt", "pos", "contract", "strike", "type", "expiration"], ["strike"]))(q_explode_option_chain)


# ---------------------------------------------------------------- X6 / X7 / X15
def q_parse_ts(spark, sf):
    """ISO text -> timestamp with malformed text -> NULL (X6): every fifth
    event's text is corrupted."""
    e = fixtures.table(spark, sf, "events")
    txt = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    txt = F.when(F.col("event_id") % 5 == 0, F.regexp_replace(txt, "T", "X")).otherwise(txt)
    return e.select("event_id", txt.alias("text"), scalar.parse_ts(txt).alias("ts"))


register("parse_ts", sql="WITH t AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN replace(strftime(ts, "
         "'%Y-%m-%dT%H:%M:%S'), 'T', 'X') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS text FROM events) "
         "SELECT event_id, text, TRY_CAST(text AS TIMESTAMP) AS ts FROM t")(q_parse_ts)


def q_round_ms(spark, sf):
    """Event timestamps rounded to the millisecond, ties to even."""
    e = fixtures.table(spark, sf, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                    scalar.round_ms(F.col("ts").cast("timestamp")).alias("ts_ms"))


register("round_ms", sql="SELECT event_id, ts, make_timestamp(CAST(round_even(epoch_us(ts) / 1000.0, 0) AS BIGINT) "
         "* 1000) AS ts_ms FROM events")(q_round_ms)


def q_fib_level_lookup(spark, sf):
    """Named levels looked up from the (name, level) pairs."""
    s = fib.session_swings(fixtures.bars(spark, sf))
    m = F.map_from_entries(fib.level_array(F.col("lo"), F.col("hi"), F.col("direction")))
    return rounded(s.select("symbol", "dt", F.element_at(m, F.lit("50%")).alias("l50"),
                            F.element_at(m, F.lit("61.8%")).alias("l618"),
                            F.element_at(m, F.lit("78.6%")).alias("l786")))


def _fib_lookup_sql():
    from barlab.plans.q_backtest import _X
    lv = lambda r: f"CASE WHEN direction = 'up' THEN lo + (hi - lo) * {r} ELSE hi - (hi - lo) * {r} END"
    return sql_final(with_bars(*_X, "s AS (SELECT DISTINCT symbol, dt, direction, lo, hi FROM x3)")
                     + f" SELECT symbol, dt, {lv(0.5)} AS l50, {lv(0.618)} AS l618, {lv(0.786)} AS l786 FROM s",
                     ["symbol", "dt", "l50", "l618", "l786"], ["l50", "l618", "l786"])


register("fib_level_lookup", sql=_fib_lookup_sql())(q_fib_level_lookup)


def q_date_range(spark, sf):
    """Inclusive calendar days from each symbol's first to last bar day."""
    b = fixtures.bars(spark, sf).groupBy("symbol").agg(F.min("dt").alias("start"), F.max("dt").alias("end"))
    return ingest.day_range(b)


register("date_range", sql=with_bars(
    "r AS (SELECT symbol, min(dt) AS s, max(dt) AS e FROM bars GROUP BY symbol)")
    + " SELECT symbol, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) "
    "AS DATE) AS dt FROM r")(q_date_range)


def q_write_lake_clustered(spark, sf):
    """Lake with folders by resolution and day, clustered by symbol, read back."""
    path = lake.write_lake_clustered(_silver(spark, sf), scratch_dir(spark, "lake-clustered"))
    return rounded(lake.scan(spark, path).select(*SILVER_COLS))


register("write_lake_clustered", sql=sql_final(with_bars(_SILVER_CTE) + " SELECT * FROM silver",
                                               SILVER_COLS, SILVER_D))(q_write_lake_clustered)
