"""Registered queries: trade metrics, equity curves, drawdown and the
parameter sweep (SURVEY A9-A13, W13, W14, J1, O3-O6, S21, G5)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barlab import fixtures
from barlab.functions import indicators as ind
from barlab.operators import backtest as bt
from barlab.operators import metrics, sweep
from barlab.plans import oracle_walk
from barlab.plans.q_backtest import RULE_A_DAY
from barlab.plans.registry import register, rounded
from barlab.session import scratch_dir


def _trades(spark, sf):
    return bt.trade_columns(bt.run(fixtures.bars(spark, sf), RULE_A_DAY))


def _r(c: str) -> str:
    return f"round({c}, 6) AS {c}"


_SUMMARY_SQL = (
    "count(*) AS n, count(*) FILTER (WHERE pnl_R > 0) AS wins, "
    "count(*) - count(*) FILTER (WHERE pnl_R > 0) AS losses, sum(pnl_R) AS netR, "
    "CASE WHEN -coalesce(sum(pnl_R) FILTER (WHERE pnl_R <= 0), 0.0) > 0 "
    "THEN coalesce(sum(pnl_R) FILTER (WHERE pnl_R > 0), 0.0) / -coalesce(sum(pnl_R) FILTER (WHERE pnl_R <= 0), 0.0) "
    "ELSE CAST('inf' AS DOUBLE) END AS pf, avg(pnl_R) AS expectancy, "
    "avg(CASE WHEN pnl_R > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100.0 AS win_pct")
_SUMMARY_OUT = ["n", "wins", "losses", "netR", "pf", "expectancy", "win_pct", "maxDD"]
_SUMMARY_D = ["netR", "pf", "expectancy", "win_pct", "maxDD"]


def _dd_cte(group: str, order: str = "dt, ts_in", src: str = "trades", name: str = "dd") -> str:
    w = f"OVER (PARTITION BY {group} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (f", {name}0 AS (SELECT *, sum(pnl_R) {w} AS equity FROM {src}), "
            f"{name} AS (SELECT *, equity - max(equity) {w} AS dd FROM {name}0)")


def _sel(cols, doubles):
    return ", ".join(_r(c) if c in doubles else c for c in cols)


# ---------------------------------------------------------------- A9/A10 trade summary
def q_trade_summary(spark, sf):
    return rounded(metrics.trade_summary(_trades(spark, sf), ["symbol"]))


register("trade_summary", sql=oracle_walk.trades_sql(
    RULE_A_DAY, _dd_cte("symbol")
    + f", s AS (SELECT symbol, {_SUMMARY_SQL}, min(dd) AS maxDD FROM dd GROUP BY symbol) "
    f"SELECT symbol, {_sel(_SUMMARY_OUT, _SUMMARY_D)} FROM s"))(q_trade_summary)


# ---------------------------------------------------------------- A11 per day + total
def q_summary_by_day_total(spark, sf):
    s = metrics.summary_by_day_total(_trades(spark, sf))
    return rounded(s.withColumn("is_total", F.col("is_total").cast("int")))


_W_DAY = "OVER (PARTITION BY symbol, dt ORDER BY ts_in ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_W_ALL = "OVER (PARTITION BY symbol ORDER BY dt, ts_in ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
register("summary_by_day_total", sql=oracle_walk.trades_sql(
    RULE_A_DAY,
    f", d AS (SELECT *, sum(pnl_R) {_W_DAY} AS d_eq, sum(pnl_R) {_W_ALL} AS a_eq FROM trades), "
    f"d2 AS (SELECT *, d_eq - max(d_eq) {_W_DAY} AS d_dd, a_eq - max(a_eq) {_W_ALL} AS a_dd FROM d), "
    f"s AS (SELECT symbol, dt, {_SUMMARY_SQL}, CASE WHEN grouping(dt) = 1 THEN min(a_dd) ELSE min(d_dd) END "
    "AS maxDD, CAST(grouping(dt) AS INTEGER) AS is_total FROM d2 GROUP BY GROUPING SETS ((symbol, dt), (symbol))) "
    f"SELECT symbol, dt, {_sel(_SUMMARY_OUT, _SUMMARY_D)}, is_total FROM s"))(q_summary_by_day_total)


# ---------------------------------------------------------------- A12/W14 equity
def q_equity_daily(spark, sf):
    return rounded(metrics.equity_daily(_trades(spark, sf)))


_EQ_DAILY = (", dl AS (SELECT symbol, dt, sum(pnl_R) AS day_R FROM trades GROUP BY symbol, dt), "
             "eq AS (SELECT *, sum(day_R) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED "
             "PRECEDING AND CURRENT ROW) AS cum_R FROM dl)")
register("equity_daily", sql=oracle_walk.trades_sql(
    RULE_A_DAY, _EQ_DAILY + " SELECT symbol, dt, round(day_R, 6) AS day_R, round(cum_R, 6) AS cum_R FROM eq"))(
    q_equity_daily)


def q_equity_trades(spark, sf):
    e = metrics.equity_trades(_trades(spark, sf), ["symbol"])
    return rounded(e.select("symbol", "dt", "ts_in", "pnl_R", "cum_R"))


register("equity_trades", sql=oracle_walk.trades_sql(
    RULE_A_DAY, " SELECT symbol, dt, ts_in, round(pnl_R, 6) AS pnl_R, round(sum(pnl_R) OVER (PARTITION BY symbol "
    "ORDER BY dt, ts_in ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_R FROM trades"))(q_equity_trades)


def q_equity_tail(spark, sf):
    """Last five daily equity rows per symbol."""
    return rounded(metrics.tail_rows(metrics.equity_daily(_trades(spark, sf)), 5, ["symbol"], "dt"))


register("equity_tail", sql=oracle_walk.trades_sql(
    RULE_A_DAY, _EQ_DAILY + ", t AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) AS rk "
    "FROM eq) SELECT symbol, dt, round(day_R, 6) AS day_R, round(cum_R, 6) AS cum_R FROM t WHERE rk <= 5"))(
    q_equity_tail)


# ---------------------------------------------------------------- A13 run summary
def q_run_summary(spark, sf):
    return rounded(metrics.run_summary(_trades(spark, sf)))


register("run_summary", sql=oracle_walk.trades_sql(
    RULE_A_DAY, _dd_cte("symbol") + " SELECT symbol, count(DISTINCT dt) AS days_tested, count(*) AS trades, "
    "round(sum(pnl_R), 6) AS netR_total, round(avg(pnl_R), 6) AS avg_R_per_trade, "
    "round(min(dd), 6) AS max_drawdown_R FROM dd GROUP BY symbol"))(q_run_summary)


# ---------------------------------------------------------------- W13 drawdown of a daily series
def q_drawdown(spark, sf):
    """Equity, peak and drawdown of the daily order-value series.

    The series has one row per calendar day, so its single ordered window is
    bounded by the calendar, not by the order volume."""
    d = fixtures.daily_series(spark, sf).withColumn("series", F.lit("orders"))
    d = d.withColumn("pnl_R", F.col("pnl") / F.lit(1e3))  # thousands: at most 5 decimals
    d = ind.drawdown_cols(d, "pnl_R", keys=["series"], order=["dt"])
    d = d.withColumn("max_dd", F.min("dd").over(Window.partitionBy("series")))
    return rounded(d.select("dt", "pnl_R", "equity", "peak", "dd", "max_dd"))


_W_DD = "OVER (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
register("drawdown", sql=(
    "WITH d AS (SELECT CAST(o_orderdate AS DATE) AS dt, sum(o_totalprice) / 1e3 AS pnl_R FROM orders GROUP BY 1), "
    f"e AS (SELECT *, sum(pnl_R) {_W_DD} AS equity FROM d), p AS (SELECT *, max(equity) {_W_DD} AS peak FROM e), "
    "q AS (SELECT *, equity - peak AS dd FROM p) "
    "SELECT dt, round(pnl_R, 6) AS pnl_R, round(equity, 6) AS equity, round(peak, 6) AS peak, round(dd, 6) AS dd, "
    "round(min(dd) OVER (), 6) AS max_dd FROM q"))(q_drawdown)


# ---------------------------------------------------------------- G5 performance metrics
def q_perf_metrics(spark, sf):
    return rounded(metrics.perf_metrics(metrics.equity_daily(_trades(spark, sf)), ["symbol"]))


register("perf_metrics", sql=oracle_walk.trades_sql(
    RULE_A_DAY, ", dl AS (SELECT symbol, dt, sum(pnl_R) AS day_R FROM trades GROUP BY symbol, dt), "
    "pe AS (SELECT *, sum(day_R) OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND "
    "CURRENT ROW) AS equity FROM dl), pp AS (SELECT *, equity - max(equity) OVER (PARTITION BY symbol ORDER BY dt "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dd FROM pe), "
    "g AS (SELECT symbol, avg(CASE WHEN day_R > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100.0 AS win_pct, "
    "avg(day_R) / nullif(stddev_samp(day_R), 0.0) * sqrt(252) AS sharpe, min(dd) AS max_dd, "
    "1.0 + sum(day_R) / 100.0 AS fin, greatest(date_diff('day', min(dt), max(dt)), 1) / 365.25 AS yrs "
    "FROM pp GROUP BY symbol) "
    "SELECT symbol, round(win_pct, 6) AS win_pct, round(sharpe, 6) AS sharpe, round(max_dd, 6) AS max_dd, "
    "round(CASE WHEN fin > 0 THEN pow(fin, 1.0 / yrs) - 1.0 END, 6) AS cagr FROM g"))(q_perf_metrics)


# ---------------------------------------------------------------- J1/4.4 sweep
def _sweep_results(spark, sf):
    return sweep.sweep_summary(fixtures.bars(spark, sf))


def q_param_sweep(spark, sf):
    return rounded(_sweep_results(spark, sf))


def q_sweep_ranking(spark, sf):
    return rounded(sweep.rank_results(_sweep_results(spark, sf)))


def q_sweep_top(spark, sf):
    """Best 15 combinations per symbol (O4: top-k is the report)."""
    r = sweep.rank_results(_sweep_results(spark, sf))
    return rounded(r.filter(F.col("rank") <= 15))


def q_best_combo_equity(spark, sf):
    """Equity curve by trade of each symbol's best combination (O6).  The sweep
    is evaluated once: its trades, one array per session and combination, are
    written, and both the ranking and the winners' trades are read from there."""
    bars = fixtures.bars(spark, sf)
    e = metrics.equity_trades(sweep.best_trades(bars, scratch_dir(spark, "sweep")), ["symbol"])
    return rounded(e.select("symbol", "dt", "ts_in", "side", "exit_reason", "pnl_R", "cum_R"))


def q_sweep_csv(spark, sf):
    """Full sweep table written as CSV with a header, read back."""
    path = scratch_dir(spark, "sweep_csv")
    res = rounded(sweep.rank_results(_sweep_results(spark, sf)))
    res.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.option("header", True).schema(res.schema).csv(path)


def _grid_values() -> str:
    g = sweep.GRID_A
    parts = []
    for k in ("ema_fast", "ema_slow", "rsi_len", "rsi_long", "rsi_short", "atr_len"):
        parts.append(f"(SELECT unnest([{', '.join(str(v) for v in g[k])}]) AS {k})")
    for k in ("atr_mult_stop", "retr_low", "retr_high"):
        parts.append(f"(SELECT unnest([{', '.join(repr(float(v)) + '::DOUBLE' for v in g[k])}]) AS {k})")
    ex = ", ".join(f"('{a}', '{b}')" for a, b in g["ext_pref"])
    parts.append(f"(VALUES {ex}) x(ext_first, ext_second)")
    return "grid AS (SELECT * FROM " + " CROSS JOIN ".join(parts) + " WHERE ema_fast < ema_slow)"


def _sweep_sql(tail: str) -> str:
    from barlab.plans.oracle import BARS_CTE, ema_sql, wilder_sql
    emas, rsis, atrs = sweep._lengths(sweep.GRID_A)
    S, P, PI = oracle_walk.S, oracle_walk.P, oracle_walk.PI
    keys = ("symbol", "dt", *sweep.PARAM_COLS)
    pick = lambda col, names: "CASE " + col + " " + " ".join(f"WHEN {n} THEN {pre}_{n}" for pre, n in names) + " END"
    ctes = [
        BARS_CTE.strip(),
        f"b AS (SELECT *, CAST(row_number() OVER ({S}) - 1 AS INTEGER) AS idx FROM bars)",
        f"e AS (SELECT *, close - lag(close) OVER ({S}) AS dlt, greatest(abs(high - low), "
        f"abs(high - lag(close) OVER ({S})), abs(low - lag(close) OVER ({S}))) AS tr FROM b)",
        "i1 AS (SELECT *, " + ", ".join(f"{ema_sql('close', n)} AS ema_{n}" for n in emas)
        + ", greatest(dlt, 0.0) AS up, greatest(-dlt, 0.0) AS dn FROM e)",
        "i2 AS (SELECT *, " + ", ".join(
            [f"{wilder_sql('up', n, start=1)} AS au_{n}, {wilder_sql('dn', n, start=1)} AS ad_{n}" for n in rsis]
            + [f"{wilder_sql('tr', n)} AS atr_{n}" for n in atrs]) + " FROM i1)",
        "i3 AS (SELECT *, " + ", ".join(f"100.0 - 100.0 / (1.0 + au_{n} / nullif(ad_{n}, 0.0)) AS rsi_{n}"
                                         for n in rsis) + " FROM i2)",
        f"f0 AS (SELECT * EXCLUDE (idx) FROM i3 WHERE {oracle_walk.tod_sql(sweep.SWEEP_WINDOWS)})",
        f"f AS (SELECT *, CAST(row_number() OVER ({S}) - 1 AS INTEGER) AS idx FROM f0)",
        f"x1 AS (SELECT *, min(low) OVER ({P}) AS lo, max(high) OVER ({P}) AS hi FROM f)",
        f"x2 AS (SELECT *, min(CASE WHEN low = lo THEN idx END) OVER ({P}) AS idx_low, "
        f"min(CASE WHEN high = hi THEN idx END) OVER ({P}) AS idx_high FROM x1)",
        "x3 AS (SELECT *, CASE WHEN idx_low < idx_high THEN 'up' ELSE 'down' END AS direction, "
        f"lead(idx) OVER ({PI}) IS NOT NULL AS has_next, lead(ts) OVER ({PI}) AS e_ts, "
        f"lead(open) OVER ({PI}) AS e_open, " + ", ".join(f"lead(atr_{n}) OVER ({PI}) AS e_atr_{n}" for n in atrs)
        + " FROM x2)",
        _grid_values(),
        "c0 AS (SELECT x3.*, grid.*, "
        f"{pick('ema_fast', [('ema', n) for n in emas])} AS ef, {pick('ema_slow', [('ema', n) for n in emas])} AS es, "
        f"{pick('rsi_len', [('rsi', n) for n in rsis])} AS rsi, {pick('atr_len', [('e_atr', n) for n in atrs])} AS e_atr, "
        "CASE WHEN direction = 'up' THEN lo + (hi - lo) * greatest(0.0, least(1.0, retr_low)) "
        "ELSE hi - (hi - lo) * greatest(0.0, least(1.0, retr_low)) END AS la, "
        "CASE WHEN direction = 'up' THEN lo + (hi - lo) * greatest(0.0, least(1.0, retr_high)) "
        "ELSE hi - (hi - lo) * greatest(0.0, least(1.0, retr_high)) END AS lb FROM x3, grid)",
        "c1 AS (SELECT *, CASE WHEN coalesce(direction = 'up' AND low <= greatest(la, lb) AND high >= least(la, lb) "
        "AND ef > es AND rsi >= rsi_long, false) THEN 1 WHEN coalesce(direction = 'down' AND low <= greatest(la, lb) "
        "AND high >= least(la, lb) AND ef < es AND rsi <= 100 - rsi_short, false) THEN -1 ELSE 0 END AS sig FROM c0)",
        "c2 AS (SELECT *, CASE WHEN sig = 1 THEN lo - atr_mult_stop * e_atr WHEN sig = -1 THEN hi + atr_mult_stop * e_atr "
        "END AS stop FROM c1)",
        "c3 AS (SELECT *, abs(e_open - stop) AS R FROM c2)",
        "pl AS (SELECT *, coalesce(R > 0, false) AS valid, e_open + sig * R AS tp1, "
        "CASE WHEN ext_first = '127' THEN (CASE WHEN direction = 'up' THEN hi + 0.272 * (hi - lo) ELSE lo - 0.272 * (hi - lo) END) "
        "ELSE (CASE WHEN direction = 'up' THEN hi + 0.618 * (hi - lo) ELSE lo - 0.618 * (hi - lo) END) END AS ext1, "
        "CASE WHEN ext_second = '127' THEN (CASE WHEN direction = 'up' THEN hi + 0.272 * (hi - lo) ELSE lo - 0.272 * (hi - lo) END) "
        "ELSE (CASE WHEN direction = 'up' THEN hi + 0.618 * (hi - lo) ELSE lo - 0.618 * (hi - lo) END) END AS ext2, "
        "ext_first AS n1, ext_second AS n2 FROM c3)",
        *oracle_walk.trades_cte(False, keys),
    ]
    grp = "symbol, " + ", ".join(sweep.PARAM_COLS)
    res = (_dd_cte(grp) + f", res AS (SELECT {grp}, {_SUMMARY_SQL}, min(dd) AS maxDD FROM dd GROUP BY {grp})")
    return "WITH RECURSIVE " + ",\n".join(ctes) + res + tail


_RES_COLS = ["symbol", *sweep.PARAM_COLS, *_SUMMARY_OUT]
_RES_D = [*_SUMMARY_D, "atr_mult_stop", "retr_low", "retr_high"]
_RANK = (", rk AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY round(netR, 6) DESC, round(pf, 6) DESC, "
         + ", ".join(f"{c} ASC" for c in sweep.PARAM_COLS) + ") AS rank FROM res)")

register("param_sweep", sql=_sweep_sql(f" SELECT {_sel(_RES_COLS, _RES_D)} FROM res"))(q_param_sweep)
register("sweep_ranking", sql=_sweep_sql(_RANK + f" SELECT {_sel(_RES_COLS, _RES_D)}, rank FROM rk"))(q_sweep_ranking)
register("sweep_top", sql=_sweep_sql(_RANK + f" SELECT {_sel(_RES_COLS, _RES_D)}, rank FROM rk WHERE rank <= 15"))(
    q_sweep_top)
register("best_combo_equity", sql=_sweep_sql(
    _RANK + ", bt AS (SELECT t.* FROM trades t SEMI JOIN (SELECT * FROM rk WHERE rank = 1) b ON "
    + " AND ".join(f"t.{c} = b.{c}" for c in ["symbol", *sweep.PARAM_COLS])
    + ") SELECT symbol, dt, ts_in, side, exit_reason, round(pnl_R, 6) AS pnl_R, round(sum(pnl_R) OVER (PARTITION BY "
    "symbol ORDER BY dt, ts_in ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_R FROM bt"))(
    q_best_combo_equity)
register("sweep_csv", sql=_sweep_sql(_RANK + f" SELECT {_sel(_RES_COLS, _RES_D)}, rank FROM rk"))(q_sweep_csv)
