"""Bracket outcomes: hand-made sessions with known outcomes, and a property
test against a plain bar-by-bar loop on random sessions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.operators import backtest as bt

PLAN_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("dt", T.DateType()),
    T.StructField("idx", T.IntegerType()), T.StructField("ts", T.TimestampType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("sig", T.IntegerType()),
])
T0 = dt.datetime(2024, 1, 2, 14, 0)


def _plan(spark, sessions, lo_hi, ext_pref=("161", "127"), mult=0.0, be_label=False):
    """sessions: {name: [(o, h, l, c, sig), ...]}; lo_hi: {name: (lo, hi)}.
    Plan like rule A with the session swing given and zero ATR buffer."""
    rows = []
    for name, bars in sessions.items():
        for i, (o, h, l, c, s) in enumerate(bars):
            rows.append((name, dt.date(2024, 1, 2), i, T0 + dt.timedelta(minutes=i), float(o), float(h),
                         float(l), float(c), int(s)))
    df = spark.createDataFrame(rows, PLAN_SCHEMA)
    lh = spark.createDataFrame([(k, float(v[0]), float(v[1])) for k, v in lo_hi.items()], "symbol string, lo double, hi double")
    df = df.join(lh, "symbol").withColumn("atr", F.lit(0.0)).withColumn(
        "direction", F.when(F.col("sig") >= 0, "up").otherwise("down"))
    # direction per session = side of its signals (tests use one side per session)
    side = df.groupBy("symbol").agg(F.min("sig").alias("mn"))
    df = df.join(side, "symbol").withColumn("direction", F.when(F.col("mn") < 0, "down").otherwise("up")).drop("mn")
    rs = bt.RuleSet(kind="A", atr_mult_stop=mult, ext_pref=ext_pref)
    return bt.add_entry_plan(df, rs)


def _trades(spark, sessions, lo_hi, **kw):
    be = kw.pop("be_label", False)
    out = bt.bracket_trades(_plan(spark, sessions, lo_hi, **kw), be_label=be).toPandas()
    return {k: g.sort_values("idx_in").to_dict("records") for k, g in out.groupby("symbol")}


def test_exit_rules(spark):
    # lo=90, hi=110 (range 20): long entry at next open 100 -> stop 90, R 10, tp1 110,
    # ext127 115.44, ext161 122.36
    S = {
        "stop_first": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 105, 89, 95, 0), (95, 112, 94, 110, 0)],
        "same_bar": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 111, 89, 100, 0)],
        "tp_then_be": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 111, 101, 108, 0), (108, 109, 99.5, 101, 0)],
        "tp_and_ext": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 116, 101, 114, 0)],
        "ext_161": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 111, 101, 110, 0), (110, 123, 109, 120, 0)],
        "eod_partial": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 111, 101, 106, 0), (106, 107, 105, 104, 0)],
        "eod_plain": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 104, 97, 103, 0)],
        "last_bar": [(100, 101, 99, 100, 0), (100, 101, 99, 100, 1)],
        "before_last": [(100, 101, 99, 100, 0), (100, 101, 99, 100, 1), (100, 104, 97, 102, 0)],
        "two_signals": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 1), (100, 104, 97, 102, 1), (102, 104, 97, 101, 0)],
    }
    lo_hi = {k: (90.0, 110.0) for k in S}
    t = _trades(spark, S, lo_hi)
    assert [x["exit_reason"] for x in t["stop_first"]] == ["STOP"] and t["stop_first"][0]["pnl_R"] == -1.0
    assert t["same_bar"][0]["exit_reason"] == "STOP"
    assert t["tp_then_be"][0]["exit_reason"] == "STOP" and t["tp_then_be"][0]["pnl_R"] == 0.0
    assert t["tp_then_be"][0]["exit_price"] == 100.0
    assert t["tp_and_ext"][0]["exit_reason"] == "TP127"  # 161 preferred but only 127 reached
    assert t["ext_161"][0]["exit_reason"] == "TP161"
    assert t["ext_161"][0]["pnl_R"] == pytest.approx(0.5 + 0.5 * (110 + 0.618 * 20 - 100) / 10)
    assert t["eod_partial"][0]["exit_reason"] == "EOD"
    assert t["eod_partial"][0]["pnl_R"] == pytest.approx(0.5 + 0.5 * 4 / 10)
    assert t["eod_plain"][0]["pnl_R"] == pytest.approx(3 / 10)
    assert "last_bar" not in t
    assert t["before_last"][0]["exit_reason"] == "EOD" and t["before_last"][0]["idx_in"] == 2
    assert len(t["two_signals"]) == 1  # the later signals fall inside the open trade


def test_ext_preference_and_be_label(spark):
    S = {"both": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 111, 101, 110, 0), (110, 125, 109, 120, 0)],
         "be": [(100, 101, 99, 100, 1), (100, 101, 99, 100, 0), (100, 111, 101, 108, 0), (108, 109, 99.5, 101, 0)]}
    lo_hi = {"both": (90.0, 110.0), "be": (90.0, 110.0)}
    assert _trades(spark, S, lo_hi, ext_pref=("161", "127"))["both"][0]["exit_reason"] == "TP161"
    assert _trades(spark, S, lo_hi, ext_pref=("127", "161"))["both"][0]["exit_reason"] == "TP127"
    assert _trades(spark, S, lo_hi, be_label=True)["be"][0]["exit_reason"] == "STOP_BE"


def _loop(bars, lo, hi, ext_pref):
    """Plain bar-by-bar walk of the bracket rules (rule A, zero ATR buffer)."""
    n = len(bars)
    out, i, last_exit = [], 0, -1
    up = any(s > 0 for *_, s in bars) or not any(s < 0 for *_, s in bars)
    while i < n:
        if i <= last_exit or bars[i][4] == 0:
            i += 1
            continue
        e = i + 1
        if e >= n:
            break
        side = 1 if bars[i][4] > 0 else -1
        entry = bars[e][0]
        stop = lo if side == 1 else hi
        r = abs(entry - stop)
        if not r > 0:
            i += 1
            continue
        tp1 = entry + side * r
        rng = hi - lo
        levels = {"127": hi + 0.272 * rng if up else lo - 0.272 * rng,
                  "161": hi + 0.618 * rng if up else lo - 0.618 * rng}
        x1, x2 = levels[ext_pref[0]], levels[ext_pref[1]]
        level, filled = stop, False
        res = None
        for j in range(e + 1, n):
            h, l = bars[j][1], bars[j][2]
            if (l <= level) if side == 1 else (h >= level):
                res = (j, "STOP", level, 0.0 if filled else -1.0)
                break
            if not filled and ((h >= tp1) if side == 1 else (l <= tp1)):
                filled, level = True, entry
            if filled:
                for x, nm in ((x1, ext_pref[0]), (x2, ext_pref[1])):
                    if (h >= x) if side == 1 else (l <= x):
                        res = (j, "TP" + nm, x, (0.5 * r + 0.5 * side * (x - entry)) / r)
                        break
                if res:
                    break
        if res is None:
            mv = side * (bars[-1][3] - entry)
            res = (n - 1, "EOD", bars[-1][3], (0.5 * r + 0.5 * mv) / r if filled else mv / r)
        out.append((e, res[0], res[1], round(res[3], 9)))
        last_exit = res[0]
        i = last_exit + 1
    return out


def test_matches_plain_loop_on_random_sessions(spark):
    rnd = random.Random(7)
    sessions, lo_hi, expected = {}, {}, {}
    for k in range(300):
        n = rnd.randint(2, 30)
        side = rnd.choice([1, -1])
        px, bars = 100.0, []
        for _ in range(n):
            o = px
            c = round(o + rnd.gauss(0, 1.5), 2)
            h = round(max(o, c) + abs(rnd.gauss(0, 1.0)), 2)
            l = round(min(o, c) - abs(rnd.gauss(0, 1.0)), 2)
            bars.append((o, h, l, c, side if rnd.random() < 0.3 else 0))
            px = c
        lo, hi = min(b[2] for b in bars), max(b[1] for b in bars)
        name = f"s{k}"
        sessions[name], lo_hi[name] = bars, (lo, hi)
        expected[name] = _loop(bars, lo, hi, ("161", "127"))
    got = _trades(spark, sessions, lo_hi)
    for name, exp in expected.items():
        g = [(x["idx_in"], x["exit_idx"], x["exit_reason"], round(x["pnl_R"], 9)) for x in got.get(name, [])]
        assert g == exp, name


def test_long_session_matches_plain_loop(spark):
    """10,000 bars in one session: the search index follows the session's size."""
    rnd = random.Random(11)
    px, bars = 1000.0, []
    for _ in range(10_000):
        o = px
        c = round(o + rnd.gauss(0, 1.5), 2)
        bars.append((o, round(max(o, c) + abs(rnd.gauss(0, 1.0)), 2), round(min(o, c) - abs(rnd.gauss(0, 1.0)), 2), c,
                     1 if rnd.random() < 0.01 else 0))
        px = c
    lo, hi = min(b[2] for b in bars), max(b[1] for b in bars)
    got = _trades(spark, {"long": bars}, {"long": (lo, hi)})["long"]
    want = _loop(bars, lo, hi, ("161", "127"))
    assert [(x["idx_in"], x["exit_idx"], x["exit_reason"], round(x["pnl_R"], 9)) for x in got] == want and want
