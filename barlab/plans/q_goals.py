"""Registered queries: goals named in the reference's project notes without
code there (SURVEY 2.11: G2-G4, G6-G8; G5 is ``perf_metrics``).  G1 (bid-ask
spread) needs a quote table that no input provides, so it is not built."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barlab import fixtures
from barlab.functions import indicators as ind
from barlab.operators import unbroken
from barlab.plans.oracle import BARS_CTE, SESSION, with_bars
from barlab.plans.registry import register, rounded, sql_final


# ---------------------------------------------------------------- G2
def q_rolling_volume(spark, sf, n: int = 20):
    """Rolling mean / sample std of volume and of the one-bar return."""
    b = ind.pct_return(fixtures.bars(spark, sf), "close", "ret")
    w = ind.series_window().rowsBetween(-(n - 1), 0)
    return rounded(b.select("symbol", "ts", F.avg("volume").over(w).alias("vol_mean"),
                            F.stddev_samp("volume").over(w).alias("vol_std"),
                            F.stddev_samp("ret").over(w).alias("ret_vol")))


_FR = f"OVER ({SESSION} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
register("rolling_volume", sql=sql_final(with_bars(
    f"r AS (SELECT *, close / nullif(lag(close) OVER ({SESSION}), 0.0) - 1.0 AS ret FROM bars)")
    + f" SELECT symbol, ts, avg(volume) {_FR} AS vol_mean, stddev_samp(volume) {_FR} AS vol_std, "
    f"stddev_samp(ret) {_FR} AS ret_vol FROM r", ["symbol", "ts", "vol_mean", "vol_std", "ret_vol"],
    ["vol_mean", "vol_std", "ret_vol"]))(q_rolling_volume)


# ---------------------------------------------------------------- G3
def q_open_close_tags(spark, sf):
    """First and last bar of each session tagged."""
    b = fixtures.bars(spark, sf)
    w = ind.series_window()
    wd = Window.partitionBy("symbol", "dt").orderBy(F.col("ts").desc())
    return b.select("symbol", "dt", "ts", (F.row_number().over(w) == 1).alias("is_open"),
                    (F.row_number().over(wd) == 1).alias("is_close"))


register("open_close_tags", sql=with_bars() + f" SELECT symbol, dt, ts, row_number() OVER ({SESSION}) = 1 AS is_open, "
         "row_number() OVER (PARTITION BY symbol, dt ORDER BY ts DESC) = 1 AS is_close FROM bars")(q_open_close_tags)


# ---------------------------------------------------------------- G4
def q_sma_cross(spark, sf, fast: int = 10, slow: int = 30):
    """SMA10/SMA30 crossings of full means over a symbol's unbroken series: entry
    when the fast mean crosses above, exit when it crosses below (G4)."""
    b = unbroken.sma_cross(fixtures.bars(spark, sf), fast, slow)
    return rounded(b.filter(F.col("signal").isNotNull()).select("symbol", "ts", "sma_f", "sma_s", "signal"))


_U = "PARTITION BY symbol ORDER BY ts"
register("sma_cross", sql=sql_final(with_bars(
    f"n AS (SELECT *, row_number() OVER ({_U}) AS rn FROM bars)",
    f"s AS (SELECT *, CASE WHEN rn >= 10 THEN avg(close) OVER ({_U} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END AS sma_f, "
    f"CASE WHEN rn >= 30 THEN avg(close) OVER ({_U} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) END AS sma_s FROM n)",
    f"d AS (SELECT *, sma_f - sma_s AS d, lag(sma_f - sma_s) OVER ({_U}) AS pd FROM s)",
    "g AS (SELECT *, CASE WHEN pd <= 0 AND d > 0 THEN 'entry' WHEN pd >= 0 AND d < 0 THEN 'exit' END AS signal FROM d)")
    + " SELECT symbol, ts, sma_f, sma_s, signal FROM g WHERE signal IS NOT NULL",
    ["symbol", "ts", "sma_f", "sma_s", "signal"], ["sma_f", "sma_s"]))(q_sma_cross)


# ---------------------------------------------------------------- G1
_SPREAD = ["symbol", "ts", "close", "bid", "ask", "quote_ts", "spread", "mid", "spread_bps", "quote_age", "spread_avg"]
_SPREAD_D = ["close", "bid", "ask", "spread", "mid", "spread_bps", "spread_avg"]


def q_spread_features(spark, sf):
    """Quote in force at the end of each minute bar, spread and its mean (G1)."""
    quotes = fixtures.quotes_from_events(fixtures.table(spark, sf, "events"))
    b = unbroken.spread_features(fixtures.bars(spark, sf, unit="minute"), quotes, bar_seconds=60)
    return rounded(b.select(*_SPREAD))


register("spread_features", sql=sql_final(
    "WITH " + BARS_CTE.strip().replace("'hour'", "'minute'") + ", "
    "v AS (SELECT event_type AS symbol, ts, event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS k FROM events), "
    "s AS (SELECT *, CASE WHEN event_id % 13 = 0 THEN -k - 0.01 ELSE k END AS side FROM v), "
    "p AS (SELECT symbol, ts, event_id, value - side AS bid, CASE WHEN event_id % 11 <> 0 THEN value + side END AS ask FROM s), "
    "q AS (SELECT symbol, CAST(ts AS TIMESTAMP) AS quote_ts, arg_max(bid, event_id) AS bid, arg_max(ask, event_id) AS ask FROM p "
    "WHERE ask >= bid GROUP BY symbol, ts), "
    "e AS (SELECT symbol, ts, dt, close, CAST(ts AS TIMESTAMP) + INTERVAL 1 MINUTE AS bar_end FROM bars), "
    "j AS (SELECT e.*, q.bid, q.ask, q.quote_ts FROM e ASOF LEFT JOIN q ON e.symbol = q.symbol AND q.quote_ts <= e.bar_end) "
    "SELECT symbol, ts, close, bid, ask, quote_ts, ask - bid AS spread, (bid + ask) / 2 AS mid, "
    "(ask - bid) / nullif((bid + ask) / 2, 0) * 10000 AS spread_bps, "
    "CAST(floor(epoch(bar_end)) - floor(epoch(quote_ts)) AS BIGINT) AS quote_age, "
    f"avg(ask - bid) OVER ({SESSION} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS spread_avg FROM j", _SPREAD, _SPREAD_D))(q_spread_features)


# ---------------------------------------------------------------- G6
def q_breakout(spark, sf, n: int = 20):
    """Close above the highest high of the previous ``n`` bars."""
    b = fixtures.bars(spark, sf)
    prev_hi = F.max("high").over(ind.series_window().rowsBetween(-n, -1))
    b = b.withColumn("prev_high", prev_hi)
    return rounded(b.select("symbol", "ts", "close", "prev_high",
                            F.coalesce(F.col("close") > F.col("prev_high"), F.lit(False)).alias("breakout")))


register("breakout", sql=sql_final(with_bars(
    f"p AS (SELECT *, max(high) OVER ({SESSION} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS prev_high FROM bars)")
    + " SELECT symbol, ts, close, prev_high, coalesce(close > prev_high, false) AS breakout FROM p",
    ["symbol", "ts", "close", "prev_high", "breakout"], ["close", "prev_high"]))(q_breakout)


# ---------------------------------------------------------------- G7
def q_top_symbols(spark, sf, k: int = 3):
    """Symbols ranked by total traded volume and bar count; the top ``k``."""
    b = fixtures.bars(spark, sf)
    g = b.groupBy("symbol").agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("bars"),
                                F.avg("close").alias("avg_close"))
    return rounded(g.orderBy(F.col("volume").desc(), "symbol").limit(k))


register("top_symbols", sql=sql_final(with_bars() + " SELECT symbol, sum(volume) AS volume, count(*) AS bars, "
         "avg(close) AS avg_close FROM bars GROUP BY symbol ORDER BY volume DESC, symbol LIMIT 3",
         ["symbol", "volume", "bars", "avg_close"], ["volume", "avg_close"]))(q_top_symbols)


def q_time_frames(spark, sf):
    """Each symbol's return spread and volume on hour, day and week bars.

    Coarser bars are folded from the hour bars (first open, last close), so the
    events are aggregated once; one shuffle carries all frames."""
    b = fixtures.bars(spark, sf)
    frames = F.array(*[F.struct(F.lit(u).alias("frame"), F.date_trunc(u, "ts").alias("start")) for u in ("hour", "day", "week")])
    f = b.withColumn("f", F.explode(frames)).groupBy("symbol", "f.frame", "f.start").agg(
        F.min_by("open", "ts").alias("open"), F.max_by("close", "ts").alias("close"), F.sum("volume").alias("volume"))
    ret = F.try_divide(F.col("close"), F.col("open")) - 1
    return rounded(f.groupBy("symbol", "frame").agg(F.count(F.lit(1)).alias("bars"), F.avg(ret).alias("mean_ret"),
                                                    F.stddev_samp(ret).alias("std_ret"), F.avg("volume").alias("mean_volume")))


register("time_frames", sql=sql_final(with_bars(
    "u AS (SELECT unnest(['hour', 'day', 'week']) AS frame)",
    "f AS (SELECT symbol, frame, date_trunc(frame, ts) AS start, arg_min(open, ts) AS open, arg_max(close, ts) AS close, "
    "sum(volume) AS volume FROM bars, u GROUP BY ALL)")
    + " SELECT symbol, frame, count(*) AS bars, avg(close / nullif(open, 0.0) - 1) AS mean_ret, "
    "stddev_samp(close / nullif(open, 0.0) - 1) AS std_ret, avg(volume) AS mean_volume FROM f GROUP BY symbol, frame",
    ["symbol", "frame", "bars", "mean_ret", "std_ret", "mean_volume"], ["mean_ret", "std_ret", "mean_volume"]))(q_time_frames)


# ---------------------------------------------------------------- G8
def q_bar_gaps(spark, sf):
    """Missing bars: every hour between a session's first and last bar that
    has no bar (data-quality report, G8): the hours between a bar and its next."""
    b = fixtures.bars(spark, sf).select("symbol", "dt", "ts")
    hour = F.expr("INTERVAL 1 HOUR")
    b = b.withColumn("next", F.lead("ts").over(ind.series_window())).filter(F.col("next") > F.col("ts") + hour)
    return b.select("symbol", "dt", F.explode(F.sequence(F.col("ts") + hour, F.col("next") - hour, hour)).alias("ts"))


register("bar_gaps", sql=with_bars(
    "s AS (SELECT symbol, dt, min(ts) AS t0, max(ts) AS t1 FROM bars GROUP BY symbol, dt)",
    "e AS (SELECT symbol, dt, unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS ts FROM s)")
    + " SELECT symbol, dt, ts FROM e ANTI JOIN bars USING (symbol, dt, ts)")(q_bar_gaps)


def q_rolling_vol(spark, sf, n: int = 20):
    """Rolling volatility: sample std of the one-bar return over the last ``n``
    bars, and the same scaled by sqrt(n) (G2)."""
    b = ind.pct_return(fixtures.bars(spark, sf), "close", "ret")
    sd = F.stddev_samp("ret").over(ind.series_window().rowsBetween(-(n - 1), 0))
    return rounded(b.select("symbol", "ts", "ret", sd.alias("vol"), (sd * F.lit(n ** 0.5)).alias("vol_scaled")))


register("rolling_vol", sql=sql_final(with_bars(
    f"r AS (SELECT *, close / nullif(lag(close) OVER ({SESSION}), 0.0) - 1.0 AS ret FROM bars)")
    + f" SELECT symbol, ts, ret, stddev_samp(ret) {_FR} AS vol, stddev_samp(ret) {_FR} * sqrt(20) AS vol_scaled FROM r",
    ["symbol", "ts", "ret", "vol", "vol_scaled"], ["ret", "vol", "vol_scaled"]))(q_rolling_vol)
