"""Registered queries: swings, Fibonacci levels, signals, entry plans and
backtests (SURVEY 2.6)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from barlab import fixtures
from barlab.functions import indicators as ind
from barlab.operators import backtest as bt
from barlab.operators import fib
from barlab.plans import oracle_walk
from barlab.plans.oracle import with_bars
from barlab.plans.registry import register, rounded, sql_final

P = "PARTITION BY symbol, dt"
_X = (f"x1 AS (SELECT *, CAST(row_number() OVER ({P} ORDER BY ts) - 1 AS INTEGER) AS idx, "
      f"min(low) OVER ({P}) AS lo, max(high) OVER ({P}) AS hi FROM bars)",
      f"x2 AS (SELECT *, min(CASE WHEN low = lo THEN idx END) OVER ({P}) AS idx_low, "
      f"min(CASE WHEN high = hi THEN idx END) OVER ({P}) AS idx_high FROM x1)",
      "x3 AS (SELECT *, CASE WHEN idx_low < idx_high THEN 'up' ELSE 'down' END AS direction FROM x2)")


# ---------------------------------------------------------------- A5/A6 session extremes
def q_session_extremes(spark, sf):
    return rounded(fib.session_swings(fixtures.bars(spark, sf), positions=True))


register("session_extremes", sql=sql_final(with_bars(*_X) +
         " SELECT DISTINCT symbol, dt, lo, hi, idx_low, idx_high, "
         "max(CASE WHEN idx = idx_low THEN ts END) OVER (PARTITION BY symbol, dt) AS ts_low, "
         "max(CASE WHEN idx = idx_high THEN ts END) OVER (PARTITION BY symbol, dt) AS ts_high, direction FROM x3",
         ["symbol", "dt", "lo", "hi", "idx_low", "idx_high", "ts_low", "ts_high", "direction"],
         ["lo", "hi"]))(q_session_extremes)


# ---------------------------------------------------------------- F1/F2 Fibonacci levels
def q_fib_levels(spark, sf):
    """Seven retracement levels and two extensions of each session swing."""
    s = fib.session_swings(fixtures.bars(spark, sf))
    e127, e161 = fib.extensions(F.col("lo"), F.col("hi"), F.col("direction") == "up")
    s = s.select("symbol", "dt", "direction", F.col("lo").alias("low"), F.col("hi").alias("high"),
                 e127.alias("ext127"), e161.alias("ext161"),
                 F.explode(fib.level_array(F.col("lo"), F.col("hi"), F.col("direction"))).alias("lv"))
    return rounded(s.select("symbol", "dt", "direction", "low", "high", "ext127", "ext161",
                            F.col("lv.name").alias("name"), F.col("lv.level").alias("level")))


_LEVELS_VALUES = ", ".join(f"({r!r}, '{n}')" for r, n in zip(fib.FIB_RATIOS, fib.FIB_NAMES))
register("fib_levels", sql=sql_final(with_bars(
    *_X, "s AS (SELECT DISTINCT symbol, dt, direction, lo, hi FROM x3)",
    f"r(ratio, name) AS (VALUES {_LEVELS_VALUES})") +
    " SELECT symbol, dt, direction, lo AS low, hi AS high, "
    "CASE WHEN direction = 'up' THEN hi + 0.272 * (hi - lo) ELSE lo - 0.272 * (hi - lo) END AS ext127, "
    "CASE WHEN direction = 'up' THEN hi + 0.618 * (hi - lo) ELSE lo - 0.618 * (hi - lo) END AS ext161, "
    "name, CASE WHEN direction = 'up' THEN lo + (hi - lo) * ratio ELSE hi - (hi - lo) * ratio END AS level "
    "FROM s, r",
    ["symbol", "dt", "direction", "low", "high", "ext127", "ext161", "name", "level"],
    ["low", "high", "ext127", "ext161", "level"]))(q_fib_levels)


# ---------------------------------------------------------------- F3/F4 zones
def q_fib_zone(spark, sf):
    s = fib.session_swings(fixtures.bars(spark, sf))
    lo, hi, d = F.col("lo"), F.col("hi"), F.col("direction")
    dz = fib.directional_zone(lo, hi, d, 0.5, 0.618)
    pz = fib.plain_zone(lo, hi, 0.382, 0.618)
    cz = fib.plain_zone(lo, hi, 0.382, 0.786, 0.02)
    return rounded(s.select("symbol", "dt", "direction",
                            dz[0].alias("dir_lo"), dz[1].alias("dir_hi"),
                            pz[0].alias("plain_lo"), pz[1].alias("plain_hi"),
                            cz[0].alias("pad_lo"), cz[1].alias("pad_hi")))


def _lv(r):
    return f"CASE WHEN direction = 'up' THEN lo + (hi - lo) * {r} ELSE hi - (hi - lo) * {r} END"


register("fib_zone", sql=sql_final(with_bars(*_X, "s AS (SELECT DISTINCT symbol, dt, direction, lo, hi FROM x3)") +
         f" SELECT symbol, dt, direction, least({_lv(0.5)}, {_lv(0.618)}) AS dir_lo, "
         f"greatest({_lv(0.5)}, {_lv(0.618)}) AS dir_hi, "
         "least(lo + 0.382 * (hi - lo), lo + 0.618 * (hi - lo)) AS plain_lo, "
         "greatest(lo + 0.382 * (hi - lo), lo + 0.618 * (hi - lo)) AS plain_hi, "
         "least(lo + 0.382 * (hi - lo), lo + 0.786 * (hi - lo)) - 0.02 * abs(hi - lo) AS pad_lo, "
         "greatest(lo + 0.382 * (hi - lo), lo + 0.786 * (hi - lo)) + 0.02 * abs(hi - lo) AS pad_hi FROM s",
         ["symbol", "dt", "direction", "dir_lo", "dir_hi", "plain_lo", "plain_hi", "pad_lo", "pad_hi"],
         ["dir_lo", "dir_hi", "plain_lo", "plain_hi", "pad_lo", "pad_hi"]))(q_fib_zone)


# ---------------------------------------------------------------- F8/F14 dashboard signals
def q_fib_signals(spark, sf):
    s = bt.dashboard_signals(fixtures.bars(spark, sf))
    return rounded(s.select("symbol", "ts", "close", "direction", "ema_fast", "ema_slow", "rsi",
                            "long_entry", "short_entry"))


_DASH = bt.RuleSet(kind="A", retr_low=0.5, retr_high=0.618)


def _dash_ctes():
    ctes = oracle_walk.prepared_ctes(_DASH)
    # prepared_ctes ends with zone + signals of rule A (clamped 0.5/0.618 zone,
    # rsi>=50); the dashboard uses the same zone with rsi > 45 / < 55.
    ctes = ctes[:-1]
    ctes.append("sg AS (SELECT *, coalesce(direction = 'up' AND low <= zhi AND high >= zlo AND "
                "ema_fast > ema_slow AND rsi > 45, false) AS long_entry, coalesce(direction = 'down' AND "
                "low <= zhi AND high >= zlo AND ema_fast < ema_slow AND rsi < 55, false) AS short_entry, "
                "CASE WHEN direction = 'up' THEN hi + 0.272 * (hi - lo) ELSE lo - 0.272 * (hi - lo) END "
                "AS ext127 FROM z)")
    return "WITH " + ",\n".join(ctes)


register("fib_signals", sql=sql_final(
    _dash_ctes() + " SELECT symbol, ts, close, direction, ema_fast, ema_slow, rsi, long_entry, short_entry FROM sg",
    ["symbol", "ts", "close", "direction", "ema_fast", "ema_slow", "rsi", "long_entry", "short_entry"],
    ["close", "ema_fast", "ema_slow", "rsi"]))(q_fib_signals)


def q_signal_table(spark, sf):
    return rounded(bt.signal_table(bt.dashboard_signals(fixtures.bars(spark, sf))))


register("signal_table", sql=sql_final(
    _dash_ctes() + ", st AS (SELECT symbol, dt, ts, CASE WHEN long_entry THEN 'LONG' ELSE 'SHORT' END AS side, "
    "close AS price, CASE WHEN long_entry THEN lo ELSE hi END AS stop_level, ext127 AS tgt_level, "
    "ema_fast, ema_slow, rsi, row_number() OVER (PARTITION BY symbol, dt ORDER BY ts) AS rn "
    "FROM sg WHERE long_entry OR short_entry) SELECT * EXCLUDE (rn) FROM st WHERE rn <= 20",
    ["symbol", "dt", "ts", "side", "price", "stop_level", "tgt_level", "ema_fast", "ema_slow", "rsi"],
    ["price", "stop_level", "tgt_level", "ema_fast", "ema_slow", "rsi"]))(q_signal_table)


# ---------------------------------------------------------------- F9-F11 rule-set signals
def _signals_query(rs):
    def fn(spark, sf):
        s = bt.add_signals(bt.session_bars(fixtures.bars(spark, sf), rs), rs)
        return rounded(s.select("symbol", "dt", "ts", "idx", "sig"))
    return fn


def _signals_sql(rs):
    return "WITH " + ",\n".join(oracle_walk.prepared_ctes(rs)) + " SELECT symbol, dt, ts, idx, sig FROM sg"


# Whole-day variants keep every bar of the session (no time-of-day filter).
RULE_A_DAY = bt.RULE_A
RULE_A_SWEEP = replace(bt.RULE_A, session_filter=("09:35", "11:00", "14:00", "15:45"))
RULE_B_DAY = replace(bt.RULE_B, session_filter=None)
RULE_C_DAY = replace(bt.RULE_C, session_filter=None)

for _k, _rs in (("sweep_signals", RULE_A_DAY), ("bidir_signals", RULE_B_DAY), ("padded_signals", RULE_C_DAY)):
    register(_k, sql=_signals_sql(_rs))(_signals_query(_rs))


# ---------------------------------------------------------------- F15 entry plan
def q_entry_plan(spark, sf):
    rs = RULE_A_DAY
    p = bt.add_entry_plan(bt.add_signals(bt.session_bars(fixtures.bars(spark, sf), rs), rs), rs)
    p = p.filter((F.col("sig") != 0) & F.col("has_next") & F.col("valid"))
    return rounded(p.select("symbol", "dt", "ts", "sig", "e_ts", "e_open", "stop", "R", "tp1", "ext1", "ext2"))


register("entry_plan", sql=sql_final(
    "WITH " + ",\n".join(oracle_walk.prepared_ctes(RULE_A_DAY) + oracle_walk.plan_ctes(RULE_A_DAY))
    + " SELECT symbol, dt, ts, sig, e_ts, e_open, stop, R, tp1, ext1, ext2 FROM pl "
    "WHERE sig <> 0 AND has_next AND valid",
    ["symbol", "dt", "ts", "sig", "e_ts", "e_open", "stop", "R", "tp1", "ext1", "ext2"],
    ["e_open", "stop", "R", "tp1", "ext1", "ext2"]))(q_entry_plan)


# ---------------------------------------------------------------- F16-F18 backtests
def _backtest_query(rs):
    def fn(spark, sf):
        return rounded(bt.trade_columns(bt.run(fixtures.bars(spark, sf), rs)))
    return fn


for _k, _rs, _head in (("bracket_outcome", RULE_A_DAY, True),
                       ("backtest_sweep_rules", RULE_A_SWEEP, False),
                       ("non_overlapping_trades", RULE_B_DAY, False),
                       ("backtest_bidir", bt.RULE_B, False),
                       ("backtest_trades", RULE_C_DAY, True),
                       ("backtest_padded", bt.RULE_C, False)):
    register(_k, sql=oracle_walk.trades_sql(_rs), headline=_head)(_backtest_query(_rs))
