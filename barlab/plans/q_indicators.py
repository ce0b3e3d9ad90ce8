"""Registered queries: indicators over session series."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab import fixtures
from barlab.functions import indicators as ind
from barlab.operators import order_stats, unbroken
from barlab.plans.oracle import BARS_CTE, SESSION, ema_sql, unbroken_ctes, wilder_sql, with_bars
from barlab.plans.registry import register, rounded, sql_final

IDX_CTE = "b AS (SELECT *, CAST(row_number() OVER (PARTITION BY symbol, dt ORDER BY ts) - 1 AS INTEGER) AS idx FROM bars)"


def _bars(spark, sf):
    return ind.with_index(fixtures.bars(spark, sf))


# ---------------------------------------------------------------- EMA trend
def ema_trend(spark, sf):
    """Which bars have EMA9 > EMA21 (session-reset EMAs over hourly bars)."""
    b = ind.emas(_bars(spark, sf), "close", [9, 21])
    return rounded(b.select("symbol", "ts", "dt", "close", "ema_9", "ema_21",
                            (F.col("ema_9") > F.col("ema_21")).alias("trend_up")))


register("ema_trend", headline=True, sql=sql_final(with_bars(
    IDX_CTE,
    f"e AS (SELECT symbol, ts, dt, close, {ema_sql('close', 9)} AS ema_9, "
    f"{ema_sql('close', 21)} AS ema_21 FROM b)")
    + " SELECT *, ema_9 > ema_21 AS trend_up FROM e",
    ["symbol", "ts", "dt", "close", "ema_9", "ema_21", "trend_up"],
    ["close", "ema_9", "ema_21"]))(ema_trend)


# ---------------------------------------------------------------- EMA / SMA
def q_ema(spark, sf):
    b = _bars(spark, sf)
    for span in (9, 21, 50):
        b = ind.ema(b, "close", span)
    return rounded(b.select("symbol", "ts", "close", "ema_9", "ema_21", "ema_50"))


register("ema", sql=sql_final(with_bars(IDX_CTE) + " SELECT symbol, ts, close, "
         + ", ".join(f"{ema_sql('close', s)} AS ema_{s}" for s in (9, 21, 50)) + " FROM b",
         ["symbol", "ts", "close", "ema_9", "ema_21", "ema_50"],
         ["close", "ema_9", "ema_21", "ema_50"]))(q_ema)


def q_sma(spark, sf):
    b = fixtures.bars(spark, sf)
    for n in (9, 21, 50):
        b = ind.sma(b, "close", n)
    return rounded(b.select("symbol", "ts", "close", "sma_9", "sma_21", "sma_50"))


register("sma", sql=sql_final(with_bars() + " SELECT symbol, ts, close, "
         + ", ".join(f"avg(close) OVER ({SESSION} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sma_{n}"
                     for n in (9, 21, 50)) + " FROM bars",
         ["symbol", "ts", "close", "sma_9", "sma_21", "sma_50"],
         ["close", "sma_9", "sma_21", "sma_50"]))(q_sma)


# ---------------------------------------------------------------- ATR
def q_atr(spark, sf):
    b = ind.atr(ind.atr(_bars(spark, sf), 14), 21)
    return rounded(b.select("symbol", "ts", "high", "low", "close", "atr_14", "atr_21"))


_TR_CTE = ("t AS (SELECT *, greatest(abs(high - low), abs(high - lag(close) OVER (" + SESSION + ")), "
           "abs(low - lag(close) OVER (" + SESSION + "))) AS tr FROM b)")

register("atr", sql=sql_final(with_bars(IDX_CTE, _TR_CTE)
         + f" SELECT symbol, ts, high, low, close, {wilder_sql('tr', 14)} AS atr_14, "
         f"{wilder_sql('tr', 21)} AS atr_21 FROM t",
         ["symbol", "ts", "high", "low", "close", "atr_14", "atr_21"],
         ["high", "low", "close", "atr_14", "atr_21"]))(q_atr)


# ---------------------------------------------------------------- RSI x3
def _rsi_query(variant):
    def fn(spark, sf):
        b = ind.rsi(_bars(spark, sf), "close", 14, "rsi", variant=variant)
        return rounded(b.select("symbol", "ts", "close", "rsi"))
    return fn


_D_CTE = f"d AS (SELECT *, close - lag(close) OVER ({SESSION}) AS dlt FROM b)"


def _rsi_sql(variant):
    if variant == "eps":
        g = ("g AS (SELECT *, CASE WHEN dlt > 0 THEN dlt ELSE 0.0 END AS up, "
             "CASE WHEN dlt < 0 THEN -dlt ELSE 0.0 END AS dn FROM d)")
        s = (f"s AS (SELECT *, {wilder_sql('up', 14)} AS au, {wilder_sql('dn', 14)} AS ad FROM g)")
        val = "100.0 - 100.0 / (1.0 + au / (ad + 1e-9))"
    else:
        g = "g AS (SELECT *, greatest(dlt, 0.0) AS up, greatest(-dlt, 0.0) AS dn FROM d)"
        s = (f"s AS (SELECT *, {wilder_sql('up', 14, start=1)} AS au, "
             f"{wilder_sql('dn', 14, start=1)} AS ad FROM g)")
        val = "100.0 - 100.0 / (1.0 + au / nullif(ad, 0.0))"
        if variant == "fill50":
            val = f"coalesce({val}, 50.0)"
    return sql_final(with_bars(IDX_CTE, _D_CTE, g, s) + f" SELECT symbol, ts, close, {val} AS rsi FROM s",
                     ["symbol", "ts", "close", "rsi"], ["close", "rsi"])


for _key, _v in (("rsi_null", "null"), ("rsi_fill50", "fill50"), ("rsi_eps", "eps")):
    register(_key, sql=_rsi_sql(_v))(_rsi_query(_v))


# ---------------------------------------------------------------- Bollinger x2
def q_bollinger_pop(spark, sf):
    b = ind.bollinger(fixtures.bars(spark, sf), "close", 20, 2.0, ddof=0)
    return rounded(b.select("symbol", "ts", "close", "bb_mid", "bb_upper", "bb_lower"))


def q_bollinger_sample(spark, sf):
    b = ind.bollinger(fixtures.bars(spark, sf), "close", 20, 2.0, ddof=1, min_periods=1)
    return rounded(b.select("symbol", "ts", "close", "bb_mid", "bb_upper", "bb_lower"))


def _boll_sql(sd_fn, min_periods):
    fr = f"OVER ({SESSION} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    inner = (with_bars(f"w AS (SELECT symbol, ts, close, count(close) {fr} AS cnt, avg(close) {fr} AS m, "
                       f"{sd_fn}(close) {fr} AS sd FROM bars)")
             + f" SELECT symbol, ts, close, CASE WHEN cnt >= {min_periods} THEN m END AS bb_mid, "
             f"CASE WHEN cnt >= {min_periods} THEN m + 2.0 * sd END AS bb_upper, "
             f"CASE WHEN cnt >= {min_periods} THEN m - 2.0 * sd END AS bb_lower FROM w")
    cols = ["symbol", "ts", "close", "bb_mid", "bb_upper", "bb_lower"]
    return sql_final(inner, cols, cols[2:])


register("bollinger_pop", sql=_boll_sql("stddev_pop", 20))(q_bollinger_pop)
register("bollinger_sample", sql=_boll_sql("stddev_samp", 1))(q_bollinger_sample)


# ---------------------------------------------------------------- MACD
def q_macd(spark, sf):
    b = ind.macd(_bars(spark, sf))
    return rounded(b.select("symbol", "ts", "close", "macd", "macd_signal", "macd_hist"))


register("macd", sql=sql_final(with_bars(
    IDX_CTE,
    f"m AS (SELECT *, {ema_sql('close', 12)} - {ema_sql('close', 26)} AS macd FROM b)",
    f"s AS (SELECT *, {ema_sql('macd', 9)} AS macd_signal FROM m)")
    + " SELECT symbol, ts, close, macd, macd_signal, macd - macd_signal AS macd_hist FROM s",
    ["symbol", "ts", "close", "macd", "macd_signal", "macd_hist"],
    ["close", "macd", "macd_signal", "macd_hist"]))(q_macd)


# ---------------------------------------------------------------- VWAP, returns
def q_vwap(spark, sf):
    b = ind.session_vwap(fixtures.bars(spark, sf))
    return rounded(b.select("symbol", "ts", "close", "volume", "vwap_intraday"))


_RUN = f"OVER ({SESSION} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
register("vwap", sql=sql_final(with_bars()
         + f" SELECT symbol, ts, close, volume, sum((high + low + close) / 3.0 * volume) {_RUN} "
         f"/ nullif(sum(volume) {_RUN}, 0.0) AS vwap_intraday FROM bars",
         ["symbol", "ts", "close", "volume", "vwap_intraday"],
         ["close", "volume", "vwap_intraday"]))(q_vwap)


def q_return_1m(spark, sf):
    b = ind.pct_return(fixtures.bars(spark, sf))
    return rounded(b.select("symbol", "ts", "close", "return_1m"))


register("return_1m", sql=sql_final(with_bars()
         + f" SELECT symbol, ts, close, close / nullif(lag(close) OVER ({SESSION}), 0.0) - 1.0 AS return_1m FROM bars",
         ["symbol", "ts", "close", "return_1m"], ["close", "return_1m"]))(q_return_1m)


# ---------------------------------------------------------------- lag / slope, index, fresh touch
def q_slope_trend(spark, sf):
    """Trend = EMA9 > EMA21 OR 3-bar slope of EMA9 > 0."""
    b = ind.emas(_bars(spark, sf), "close", [9, 21])
    w = ind.series_window()
    b = b.withColumn("slope_3", F.col("ema_9") - F.lag("ema_9", 3).over(w))
    b = b.withColumn("trend_up", F.coalesce((F.col("ema_9") > F.col("ema_21")) | (F.col("slope_3") > 0), F.lit(False)))
    b = b.withColumn("trend_dn", F.coalesce((F.col("ema_9") < F.col("ema_21")) | (F.col("slope_3") < 0), F.lit(False)))
    return rounded(b.select("symbol", "ts", "ema_9", "slope_3", "trend_up", "trend_dn"))


register("slope_trend", sql=sql_final(with_bars(
    IDX_CTE,
    f"e AS (SELECT *, {ema_sql('close', 9)} AS ema_9, {ema_sql('close', 21)} AS ema_21 FROM b)",
    f"s AS (SELECT *, ema_9 - lag(ema_9, 3) OVER ({SESSION}) AS slope_3 FROM e)")
    + " SELECT symbol, ts, ema_9, slope_3, coalesce(ema_9 > ema_21 OR slope_3 > 0, false) AS trend_up, "
    "coalesce(ema_9 < ema_21 OR slope_3 < 0, false) AS trend_dn FROM s",
    ["symbol", "ts", "ema_9", "slope_3", "trend_up", "trend_dn"], ["ema_9", "slope_3"]))(q_slope_trend)


def q_session_index(spark, sf):
    b = _bars(spark, sf)
    return b.select("symbol", "dt", "ts", "idx")


register("session_index", sql=with_bars(IDX_CTE) + " SELECT symbol, dt, ts, idx FROM b")(q_session_index)


# ---------------------------------------------------------------- volatility gates, fills
def q_vol_gate(spark, sf):
    """ATR >= 0.60-quantile of all ATR of the symbol so far, over the unbroken
    series of hourly bars (W18, A7)."""
    b = unbroken.atr(fixtures.bars(spark, sf))
    b = order_stats.quantile_so_far(b, "atr", 0.6, "atr_q60")
    b = b.withColumn("vol_ok", F.coalesce(F.col("atr") >= F.col("atr_q60"), F.lit(False)))
    return rounded(b.select("symbol", "ts", "atr", "atr_q60", "vol_ok"))


def q_vol_gate_median(spark, sf):
    """ATR >= 1.2 x median of all ATR of the symbol so far, over the unbroken
    series of minute bars (W19, A8)."""
    b = unbroken.atr(fixtures.bars(spark, sf, unit="minute"))
    b = order_stats.quantile_so_far(b, "atr", 0.5, "atr_med")
    b = b.withColumn("vol_ok", F.coalesce(F.col("atr") >= F.lit(1.2) * F.col("atr_med"), F.lit(False)))
    return rounded(b.select("symbol", "ts", "atr", "atr_med", "vol_ok"))


_HOURS = "WITH RECURSIVE " + ", ".join([BARS_CTE.strip(), *unbroken_ctes("bars")])
_MINUTES = "WITH RECURSIVE " + ", ".join([BARS_CTE.strip().replace("'hour'", "'minute'"), *unbroken_ctes("bars")])
_SO_FAR = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
register("vol_gate", sql=sql_final(
    _HOURS + f", q AS (SELECT *, quantile_cont(atr, 0.6) {_SO_FAR} AS atr_q60 FROM ind)"
    " SELECT symbol, ts, atr, atr_q60, coalesce(atr >= atr_q60, false) AS vol_ok FROM q",
    ["symbol", "ts", "atr", "atr_q60", "vol_ok"], ["atr", "atr_q60"]))(q_vol_gate)
register("vol_gate_median", sql=sql_final(
    _MINUTES + f", q AS (SELECT *, quantile_cont(atr, 0.5) {_SO_FAR} AS atr_med FROM ind)"
    " SELECT symbol, ts, atr, atr_med, coalesce(atr >= 1.2 * atr_med, false) AS vol_ok FROM q",
    ["symbol", "ts", "atr", "atr_med", "vol_ok"], ["atr", "atr_med"]))(q_vol_gate_median)


# ---------------------------------------------------------------- quantiles of groups of any size
def q_value_quantiles(spark, sf):
    """Exact 60 % quantile and median of all event values per symbol."""
    ev = fixtures.table(spark, sf, "events").select(F.col("event_type").alias("symbol"), "value")
    return rounded(order_stats.group_quantiles(ev, "value", {"q60": 0.6, "median": 0.5}, ["symbol"]))


register("value_quantiles", sql=sql_final(
    "SELECT event_type AS symbol, count(value) AS n, quantile_cont(value, 0.6) AS q60, quantile_cont(value, 0.5) AS median "
    "FROM events WHERE value IS NOT NULL GROUP BY event_type", ["symbol", "n", "q60", "median"],
    ["q60", "median"]))(q_value_quantiles)


_NULLED = ("n AS (SELECT *, CASE WHEN floor(epoch(ts) / 3600) % 17 = 0 OR floor(epoch(ts) / 3600) % 7 = 0 "
           "THEN NULL ELSE close END AS c FROM bars)")


def _nulled(spark, sf):
    b = fixtures.bars(spark, sf)
    hn = F.floor(F.unix_seconds("ts") / 3600)
    return b.withColumn("c", F.when((hn % 17 == 0) | (hn % 7 == 0), F.lit(None).cast("double"))
                        .otherwise(F.col("close")))


def q_fill_gaps(spark, sf):
    """Back-fill then forward-fill gaps inside each session."""
    b = ind.fill_back_then_forward(_nulled(spark, sf), "c", "c_filled")
    return rounded(b.select("symbol", "ts", "c", "c_filled"))


register("fill_gaps", sql=sql_final(with_bars(_NULLED)
         + f" SELECT symbol, ts, c, coalesce(c, first_value(c IGNORE NULLS) OVER ({SESSION} ROWS BETWEEN "
         f"CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(c IGNORE NULLS) OVER ({SESSION} ROWS BETWEEN "
         "UNBOUNDED PRECEDING AND CURRENT ROW)) AS c_filled FROM n",
         ["symbol", "ts", "c", "c_filled"], ["c", "c_filled"]))(q_fill_gaps)


def q_fill_median(spark, sf):
    """Gaps replaced by the session median."""
    b = ind.fill_median(_nulled(spark, sf), "c", "c_filled")
    return rounded(b.select("symbol", "ts", "c", "c_filled"))


register("fill_median", sql=sql_final(with_bars(_NULLED)
         + " SELECT symbol, ts, c, coalesce(c, quantile_cont(c, 0.5) OVER (PARTITION BY symbol, dt)) AS c_filled FROM n",
         ["symbol", "ts", "c", "c_filled"], ["c", "c_filled"]))(q_fill_median)


def q_fill_median_symbol(spark, sf):
    """Gaps replaced by the median of the symbol's whole series (W21 over a group of any size)."""
    b = order_stats.fill_with_median(_nulled(spark, sf), "c", "c_filled", ["symbol"])
    return rounded(b.select("symbol", "ts", "c", "c_filled"))


register("fill_median_symbol", sql=sql_final(with_bars(_NULLED)
         + " SELECT symbol, ts, c, coalesce(c, quantile_cont(c, 0.5) OVER (PARTITION BY symbol)) AS c_filled FROM n",
         ["symbol", "ts", "c", "c_filled"], ["c", "c_filled"]))(q_fill_median_symbol)


# ---------------------------------------------------------------- the unbroken series, in day chunks
LIVE_COLS = ["symbol", "ts", "close", "ema9", "ema21", "rsi", "atr"]


def q_live_indicators(spark, sf):
    """EMA 9 and 21, RSI 14, ATR 14 of a symbol's unbroken series of minute bars
    (T1 in batch form): smoothed day by day, carried on by one row a day."""
    return rounded(unbroken.live_indicators(fixtures.bars(spark, sf, unit="minute")).select(*LIVE_COLS))


register("live_indicators", sql=sql_final(
    _MINUTES + " SELECT symbol, ts, close, ema9, ema21, rsi, atr FROM ind", LIVE_COLS, LIVE_COLS[2:]))(q_live_indicators)


# ---------------------------------------------------------------- smoothing over gaps
def q_ema_gaps(spark, sf):
    """EMA 9 and RSI 14 over bars whose close is NULL every 17th hour (W2, W3, W6):
    a gap carries the value on and weighs on the next step."""
    b = fixtures.bars(spark, sf).withColumn(
        "close", F.when(F.floor(F.unix_seconds("ts") / 3600) % 17 != 0, F.col("close")))
    b = unbroken.with_previous(b, ["close"], ["pc"])
    step = F.col("close") - F.col("pc")
    b = b.withColumns({"up": F.when(step.isNotNull(), F.greatest(step, F.lit(0.0))),
                       "dn": F.when(step.isNotNull(), F.greatest(-step, F.lit(0.0)))})
    b = ind.smooth_unbroken(b, [ind.Smoothing("close", "ema9", 0.2), *ind.rsi_smoothings("up", "dn", 14, "up", "dn")])
    return rounded(b.select("symbol", "ts", "close", "ema9", ind.rsi_of(F.col("up"), F.col("dn"), "fill50").alias("rsi")))


def _recursive(src: str, alpha: float, name: str) -> str:
    """The recurrence itself, row by row: value and rows since the last input."""
    q = 1.0 - alpha
    step = f"(pow({q!r}, r.gap + 1) * r.y + {alpha!r} * p.x) / (pow({q!r}, r.gap + 1) + {alpha!r})"
    return (f"{name} AS (SELECT symbol, idx, {src} AS y, 0 AS gap FROM d WHERE idx = 0 UNION ALL "
            f"SELECT p.symbol, p.idx, CASE WHEN p.x IS NULL THEN r.y WHEN r.y IS NULL THEN p.x ELSE {step} END, "
            f"CASE WHEN p.x IS NULL THEN r.gap + 1 ELSE 0 END FROM {name} r JOIN (SELECT symbol, idx, {src} AS x FROM d) p "
            "ON p.symbol = r.symbol AND p.idx = r.idx + 1)")


register("ema_gaps", sql=sql_final(
    "WITH RECURSIVE " + with_bars()[len("WITH "):] + ", "
    "n AS (SELECT symbol, ts, CASE WHEN floor(epoch(ts) / 3600) % 17 <> 0 THEN close END AS close, "
    "CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS INTEGER) AS idx FROM bars), "
    "d AS MATERIALIZED (SELECT *, CASE WHEN dl IS NOT NULL THEN greatest(dl, 0.0) END AS up, "
    "CASE WHEN dl IS NOT NULL THEN greatest(-dl, 0.0) END AS dn FROM (SELECT *, close - lag(close) "
    "OVER (PARTITION BY symbol ORDER BY ts) AS dl FROM n) z), "
    + ", ".join([_recursive("close", 0.2, "ye"), _recursive("up", 1 / 14, "yu"), _recursive("dn", 1 / 14, "yd")])
    + " SELECT d.symbol, d.ts, d.close, ye.y AS ema9, coalesce(100.0 - 100.0 / (1.0 + yu.y / nullif(yd.y, 0.0)), 50.0) AS rsi "
    "FROM d JOIN ye USING (symbol, idx) JOIN yu USING (symbol, idx) JOIN yd USING (symbol, idx)",
    ["symbol", "ts", "close", "ema9", "rsi"], ["close", "ema9", "rsi"]))(q_ema_gaps)
