"""Registered queries: ZigZag swings, rolling Fibonacci rules (set D), live
signals and order plans (SURVEY F5-F7, F12, F13, F19)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from barlab import fixtures
from barlab.operators import backtest as bt
from barlab.operators import legs, swings, unbroken
from barlab.plans import oracle_walk
from barlab.plans.oracle import BARS_CTE, unbroken_ctes
from barlab.plans.registry import register, rounded, sql_final

RULE_D_DAY = replace(bt.RULE_D, session_filter=None)
PI = oracle_walk.PI
S = oracle_walk.S


def _rolling(spark, sf, rs=RULE_D_DAY):
    return swings.rolling_signals(bt.session_bars(fixtures.bars(spark, sf), rs), rs)


# ---------------------------------------------------------------- F6 / F7 / F12
def q_zigzag_rolling(spark, sf):
    r = _rolling(spark, sf)
    return rounded(r.select("symbol", "dt", "ts", "close", "atr_filled", "zz_dir", "imp_lo", "imp_hi"))


_ZZ = oracle_walk.rolling_ctes(RULE_D_DAY)
_ZZ_HEAD = "WITH RECURSIVE " + ",\n".join(_ZZ)
register("zigzag_rolling", sql=sql_final(
    _ZZ_HEAD + " SELECT symbol, dt, ts, close, atr_filled, zz_dir, imp_lo, imp_hi FROM r0",
    ["symbol", "dt", "ts", "close", "atr_filled", "zz_dir", "imp_lo", "imp_hi"],
    ["close", "atr_filled", "imp_lo", "imp_hi"]))(q_zigzag_rolling)


def q_rolling_fib_levels(spark, sf):
    r = _rolling(spark, sf)
    return rounded(r.select("symbol", "dt", "ts", "zone_lo", "zone_hi", "ext_up127", "ext_up161",
                            "ext_dn127", "ext_dn161"))


register("rolling_fib_levels", sql=sql_final(
    _ZZ_HEAD + " SELECT symbol, dt, ts, zone_lo, zone_hi, imp_hi + 0.272 * rng AS ext_up127, "
    "imp_hi + 0.618 * rng AS ext_up161, imp_lo - 0.272 * rng AS ext_dn127, imp_lo - 0.618 * rng AS ext_dn161 FROM r1",
    ["symbol", "dt", "ts", "zone_lo", "zone_hi", "ext_up127", "ext_up161", "ext_dn127", "ext_dn161"],
    ["zone_lo", "zone_hi", "ext_up127", "ext_up161", "ext_dn127", "ext_dn161"]))(q_rolling_fib_levels)


def q_rolling_fib_signals(spark, sf):
    r = _rolling(spark, sf)
    return r.select("symbol", "dt", "ts", "in_zone", "fresh", "sig")


register("rolling_fib_signals", sql=_ZZ_HEAD + " SELECT symbol, dt, ts, in_zone, fresh, sig FROM sg")(
    q_rolling_fib_signals)


def _trades(rs):
    def fn(spark, sf):
        return rounded(bt.trade_columns(bt.run(fixtures.bars(spark, sf), rs)))
    return fn


register("rolling_fib_trades", sql=oracle_walk.rolling_trades_sql(RULE_D_DAY))(_trades(RULE_D_DAY))
register("backtest_rolling", sql=oracle_walk.rolling_trades_sql(bt.RULE_D))(_trades(bt.RULE_D))


# ---------------------------------------------------------------- F5 last leg
def q_zigzag_last_leg(spark, sf):
    leg = legs.last_leg(unbroken.atr(fixtures.bars(spark, sf)), swings.LIVE.zz_atr_mult)
    leg = leg.withColumn("leg_dir", F.when(F.col("leg_way") > 0, "up").when(F.col("leg_way") < 0, "down"))
    return rounded(leg.select("symbol", "dt", "ts", "leg_dir", "leg_low", "leg_high"))


def _last_leg_ctes(mult: float, src: str) -> list[str]:
    m = float(mult)
    c = "p.close"
    first = f"(s.up IS NULL AND abs({c} - s.ref) >= s.thr)"
    ext = f"(s.up IS NOT NULL AND ((s.up AND {c} >= s.ref) OR (NOT s.up AND {c} <= s.ref)))"
    rev = f"(s.up IS NOT NULL AND NOT {ext} AND abs({c} - s.ref) >= s.thr)"
    swing = f"({first} OR {rev})"
    moved = f"({first} OR {ext} OR {rev})"
    return [
        f"lg AS (SELECT symbol, idx, close AS ref, CAST(NULL AS BOOLEAN) AS up, atr * {m!r} AS thr, "
        f"CAST(NULL AS INTEGER) AS s_prev, 0 AS s_last FROM {src} WHERE idx = 0 "
        f"UNION ALL SELECT s.symbol, p.idx, CASE WHEN {moved} THEN {c} ELSE s.ref END, "
        f"CASE WHEN {first} THEN ({c} - s.ref) > 0 WHEN {rev} THEN NOT s.up ELSE s.up END, "
        f"CASE WHEN {moved} THEN p.atr * {m!r} ELSE s.thr END, "
        f"CASE WHEN {swing} THEN s.s_last ELSE s.s_prev END, CASE WHEN {swing} THEN p.idx ELSE s.s_last END "
        f"FROM lg s JOIN {src} p ON p.symbol = s.symbol AND p.idx = s.idx + 1)",
        f"lg2 AS (SELECT l.symbol, l.idx, l.s_prev, l.s_last, min(q.low) AS lo, max(q.high) AS hi FROM lg l "
        f"JOIN {src} q ON q.symbol = l.symbol AND q.idx BETWEEN l.s_prev AND l.s_last "
        "WHERE l.idx + 1 >= 5 AND l.s_prev IS NOT NULL GROUP BY ALL)",
        f"lg3 AS (SELECT g.symbol, g.idx, CASE WHEN g.hi - g.lo > 0 THEN g.lo END AS leg_low, "
        f"CASE WHEN g.hi - g.lo > 0 THEN g.hi END AS leg_high, CASE WHEN g.hi - g.lo > 0 THEN "
        f"(CASE WHEN b2.close >= a2.close THEN 'up' ELSE 'down' END) END AS leg_dir FROM lg2 g "
        f"JOIN {src} a2 ON a2.symbol = g.symbol AND a2.idx = g.s_prev "
        f"JOIN {src} b2 ON b2.symbol = g.symbol AND b2.idx = g.s_last)",
        f"legs AS (SELECT s.*, lg3.leg_dir, lg3.leg_low, lg3.leg_high FROM {src} s LEFT JOIN lg3 "
        "ON lg3.symbol = s.symbol AND lg3.idx = s.idx)",
    ]


U = "PARTITION BY symbol ORDER BY ts"


def _live_base(unit: str = "hour") -> list[str]:
    """Indicators over the unbroken series of each symbol."""
    return [BARS_CTE.strip().replace("'hour'", f"'{unit}'"), *unbroken_ctes("bars")]


register("zigzag_last_leg", sql=sql_final(
    "WITH RECURSIVE " + ",\n".join(_live_base() + _last_leg_ctes(1.7, "ind"))
    + " SELECT symbol, dt, ts, leg_dir, leg_low, leg_high FROM legs",
    ["symbol", "dt", "ts", "leg_dir", "leg_low", "leg_high"], ["leg_low", "leg_high"]))(q_zigzag_last_leg)


# ---------------------------------------------------------------- F13 / T4 / F19
_LIVE_COLS = ["symbol", "dt", "ts", "close", "ema9", "ema21", "rsi", "atr", "in_zone", "trend_up", "mom_ok",
              "vol_ok", "logged", "enter"]
_LIVE_D = ["close", "ema9", "ema21", "rsi", "atr"]


def q_live_signals(spark, sf):
    return rounded(swings.live_signals(fixtures.bars(spark, sf)).select(*_LIVE_COLS))


_ET = "timezone('America/New_York', ts AT TIME ZONE 'UTC')"


def _live_ctes(unit: str = "hour") -> list[str]:
    return _live_base(unit) + _last_leg_ctes(1.7, "ind") + [
        "v AS (SELECT *, quantile_cont(atr, 0.6) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND CURRENT ROW) AS gate, leg_high - leg_low AS rng FROM legs)",
        f"w AS (SELECT *, coalesce(hour({_ET}) = 15 AND minute({_ET}) >= 55, false) AS eod, "
        "coalesce(leg_dir = 'up', false) AS leg_up, "
        "coalesce(low <= greatest(leg_low + 0.5 * rng, leg_low + 0.618 * rng) + 0.012 * rng AND "
        "high >= least(leg_low + 0.5 * rng, leg_low + 0.618 * rng) - 0.012 * rng, false) AS in_zone, "
        "coalesce(ema9 > ema21, false) AS trend_up, coalesce(rsi >= 48, false) AS mom_ok, "
        "coalesce(atr >= gate, false) AS vol_ok FROM v)",
        "x AS (SELECT *, NOT eod AND leg_up AND in_zone AND trend_up AND mom_ok AND vol_ok "
        "AND close - (leg_low - 0.3 * atr) > 0 AS setup, "
        f"sum(CAST(eod AS INTEGER)) OVER ({U} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM w)",
        "y AS (SELECT *, min(CASE WHEN setup THEN idx END) OVER (PARTITION BY symbol, epoch) AS entry_idx FROM x)",
        "z AS (SELECT *, NOT eod AND leg_up AND (entry_idx IS NULL OR idx <= entry_idx) AS logged, "
        "coalesce(setup AND idx = entry_idx, false) AS enter FROM y)",
    ]


_LIVE_CTES = _live_ctes()


def q_live_signals_1m(spark, sf):
    """Minute bars: the flatten bar clears the position within a day."""
    return rounded(swings.live_signals(fixtures.bars(spark, sf, unit="minute")).select(*_LIVE_COLS))


register("live_signals_1m", sql=sql_final("WITH RECURSIVE " + ",\n".join(_live_ctes("minute")) + " SELECT * FROM z",
                                          _LIVE_COLS, _LIVE_D))(q_live_signals_1m)
register("live_signals", sql=sql_final("WITH RECURSIVE " + ",\n".join(_LIVE_CTES) + " SELECT * FROM z",
                                       _LIVE_COLS, _LIVE_D))(q_live_signals)


def q_order_plan(spark, sf):
    live = swings.live_signals(fixtures.bars(spark, sf))
    return rounded(swings.order_plan(live.filter(F.col("enter"))))


register("order_plan", sql=sql_final(
    "WITH RECURSIVE " + ",\n".join(_LIVE_CTES) + ", o AS (SELECT *, close - (leg_low - 0.3 * atr) AS R FROM z "
    "WHERE enter), q AS (SELECT *, CAST(greatest(1, least(CAST(floor(100.0 / R) AS BIGINT), 1000)) AS BIGINT) AS qty "
    "FROM o WHERE R > 0) SELECT symbol, dt, ts, close AS entry, round(close - R, 2) AS stop, R, "
    "qty, CAST(floor(qty / 2) AS BIGINT) AS qty1, CAST(qty - floor(qty / 2) AS BIGINT) AS qty2, "
    "round(close + R, 2) AS tp1, round(leg_high + 0.618 * (leg_high - leg_low), 2) AS t161 FROM q",
    ["symbol", "dt", "ts", "entry", "stop", "R", "qty", "qty1", "qty2", "tp1", "t161"],
    ["entry", "stop", "R", "tp1", "t161"]))(q_order_plan)


def q_fresh_touch(spark, sf):
    """In the rolling zone now and not on the previous bar; the first bar of a
    session counts as fresh when in the zone (W17)."""
    return _rolling(spark, sf).select("symbol", "dt", "ts", "in_zone", "fresh")


register("fresh_touch", sql=_ZZ_HEAD + " SELECT symbol, dt, ts, in_zone, fresh FROM r3")(q_fresh_touch)
