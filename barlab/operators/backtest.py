"""Entry signals, entry plan and bracket-trade outcomes.

A rule set turns session bars into per-bar signals and, for each signal bar,
the plan of a trade entered at the next bar's open (F15).  The outcome step
works on each session's ts-sorted bar array, in the JVM:

* outcome (F16): for a planned entry, first-hit searches after the entry
  bar -- stop vs +1R target (stop wins a tie), then break-even stop vs
  extensions (stop wins a tie) -- or end of day at the last close;
* choice (F17): a greedy ``aggregate`` over the signal bars takes a signal
  when it lies after the previous exit and its plan is valid.

A session is one ``(symbol, dt)`` group, bounded by the bar resolution, so a
hot symbol only adds sessions, never a bigger group.  No pairs of bars are
ever materialised as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab import SESSION_KEYS
from barlab.functions import indicators as ind
from barlab.functions import scalar
from barlab.operators import fib
from barlab.schemas import TRADE


@dataclass(frozen=True)
class RuleSet:
    """Parameters of one rule set.

    kind: ``A`` sweep rules (direction gate, clamped directional zone),
    ``B`` bidirectional (plain zone, no gate, 161 tried first),
    ``C`` direction-following with zone padding and EMA-slope trend,
    ``D`` rolling ATR-ZigZag impulse with fresh touch.
    """
    kind: str = "A"
    ema_fast: int = 9
    ema_slow: int = 21
    rsi_len: int = 14
    rsi_long: float = 50
    rsi_short: float = 50
    atr_len: int = 14
    atr_mult_stop: float = 0.5
    retr_low: float = 0.5
    retr_high: float = 0.618
    ext_pref: tuple[str, str] = ("161", "127")
    session_filter: tuple[str, ...] | None = None
    zone_pad_frac: float = 0.0
    allow_slope_or: bool = False
    zz_atr_mult: float = 1.5
    tz: str = "UTC"
    keys: tuple[str, ...] = field(default=SESSION_KEYS)


# Defaults of the reference's four rule sets (fixed values).
RULE_A = RuleSet()
RULE_B = RuleSet(kind="B", rsi_long=48, rsi_short=48, retr_low=0.382, retr_high=0.618,
                 session_filter=("09:35", "12:00", "13:00", "15:55"))
RULE_C = RuleSet(kind="C", rsi_long=45, rsi_short=55, atr_mult_stop=0.25, retr_low=0.382,
                 retr_high=0.786, zone_pad_frac=0.02, allow_slope_or=True,
                 session_filter=("09:35", "15:55"))
RULE_D = replace(RULE_C, kind="D", zz_atr_mult=1.5)


# --------------------------------------------------------------------------- prepare
def add_indicators(df: DataFrame, rs: RuleSet) -> DataFrame:
    """EMA fast/slow, RSI (NULL variant) and ATR over the full session."""
    up, dn = ind.rsi_inputs("close", "null", keys=rs.keys)
    df = df.withColumns({
        "idx": (F.row_number().over(ind.series_window(rs.keys)) - 1).cast("int"),
        "_up": up, "_dn": dn, "_tr": ind.true_range_expr(keys=rs.keys)})
    df = ind.smooth_all(df, [
        ind.Smoothing("close", "ema_fast", 2.0 / (rs.ema_fast + 1.0)),
        ind.Smoothing("close", "ema_slow", 2.0 / (rs.ema_slow + 1.0)),
        *ind.rsi_smoothings("_up", "_dn", rs.rsi_len, "_up", "_dn"),
        ind.Smoothing("_tr", "atr", 1.0 / rs.atr_len)], keys=rs.keys)
    return df.withColumn("rsi", ind.rsi_of(F.col("_up"), F.col("_dn"), "null")).drop("_up", "_dn", "_tr")


def session_bars(bars: DataFrame, rs: RuleSet) -> DataFrame:
    """Indicators on the whole day, then the time-of-day filter, then a fresh
    0-based ``idx`` over the kept bars (the reference's ``reset_index``)."""
    df = add_indicators(bars, rs)
    if rs.session_filter:
        df = df.filter(scalar.in_time_windows(F.col("ts"), rs.session_filter, rs.tz))
        df = ind.with_index(df.drop("idx"), rs.keys)
    return df


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def add_signals(df: DataFrame, rs: RuleSet) -> DataFrame:
    """Per-bar ``sig``: 1 long, -1 short, 0 none (long wins a tie), plus the
    session context the trade plan needs (rule sets A-C)."""
    df = fib.session_extremes(df, rs.keys)
    lo, hi, direction = F.col("lo"), F.col("hi"), F.col("direction")
    fast, slow = F.col("ema_fast"), F.col("ema_slow")
    up, dn = fast > slow, fast < slow
    if rs.allow_slope_or:
        slope = fast - F.lag("ema_fast", 3).over(ind.series_window(rs.keys, "idx"))
        up, dn = up | (slope > 0), dn | (slope < 0)
    if rs.kind == "A":
        zlo, zhi = fib.directional_zone(lo, hi, direction, rs.retr_low, rs.retr_high)
        long_ok = (direction == "up") & fib.touches(zlo, zhi) & up & (F.col("rsi") >= rs.rsi_long)
        short_ok = ((direction == "down") & fib.touches(zlo, zhi) & dn
                    & (F.col("rsi") <= 100 - rs.rsi_short))
    elif rs.kind == "B":
        zlo, zhi = fib.plain_zone(lo, hi, rs.retr_low, rs.retr_high)
        long_ok = fib.touches(zlo, zhi) & up & (F.col("rsi") >= rs.rsi_long)
        short_ok = fib.touches(zlo, zhi) & dn & (F.col("rsi") <= 100 - rs.rsi_short)
    elif rs.kind == "C":
        zlo, zhi = fib.plain_zone(lo, hi, rs.retr_low, rs.retr_high, rs.zone_pad_frac)
        long_ok = (direction == "up") & fib.touches(zlo, zhi) & up & (F.col("rsi") >= rs.rsi_long)
        short_ok = (direction == "down") & fib.touches(zlo, zhi) & dn & (F.col("rsi") <= rs.rsi_short)
    else:
        raise ValueError("rule set D uses barlab.operators.swings.rolling_signals")
    return df.withColumn("sig", F.when(_true(long_ok), 1).when(_true(short_ok), -1).otherwise(0))


def add_entry_plan(df: DataFrame, rs: RuleSet, lo: str = "lo", hi: str = "hi",
                   at_entry_levels: bool = False) -> DataFrame:
    """Plan of the trade a signal on this bar would open at the next bar.

    ``e_open``/``e_ts`` come from the next bar; the stop sits beyond the
    opposite extreme by ``atr_mult_stop`` x ATR of the entry bar; ``R`` is the
    distance to it and ``valid`` is false when R is missing or not positive.
    """
    w = ind.series_window(rs.keys, "idx")
    side = F.col("sig")
    e_atr = F.lead("atr").over(w)
    if rs.kind != "A":
        e_atr = F.coalesce(e_atr, F.lit(0.0))
    if at_entry_levels:
        lo_c, hi_c = F.lead(lo).over(w), F.lead(hi).over(w)
    else:
        lo_c, hi_c = F.col(lo), F.col(hi)
    df = df.withColumns({"has_next": F.lead("idx").over(w).isNotNull(), "e_ts": F.lead("ts").over(w),
                         "e_open": F.lead("open").over(w), "e_atr": e_atr, "e_lo": lo_c, "e_hi": hi_c})
    stop = F.when(side == 1, F.col("e_lo") - F.lit(rs.atr_mult_stop) * F.col("e_atr")) \
            .when(side == -1, F.col("e_hi") + F.lit(rs.atr_mult_stop) * F.col("e_atr"))
    r = F.abs(F.col("e_open") - stop)
    valid = r.isNotNull() & ~F.isnan(r) & (r > 0)
    if at_entry_levels:
        valid = valid & F.col("e_lo").isNotNull() & F.col("e_hi").isNotNull() & (F.col("e_lo") != F.col("e_hi"))
    up_cond = (F.col("direction") == "up") if rs.kind == "A" else (side == 1)
    e127, e161 = fib.extensions(F.col("e_lo"), F.col("e_hi"), up_cond)
    levels = {"127": e127, "161": e161}
    pref = ("161", "127") if rs.kind == "B" else tuple(rs.ext_pref)
    return df.withColumns({"stop": stop, "R": r, "valid": _true(valid), "tp1": F.col("e_open") + side * r,
                           "ext1": levels[pref[0]], "ext2": levels[pref[1]],
                           "n1": F.lit(pref[0]), "n2": F.lit(pref[1])})


# --------------------------------------------------------------------------- outcomes
_BAR_FIELDS = ["idx", "ts", "high", "low", "close", "sig", "has_next", "valid", "e_ts", "e_open",
               "R", "stop", "tp1", "ext1", "ext2", "n1", "n2"]

def add_search_arrays(per_session: DataFrame, bars: str = "bars") -> DataFrame:
    """Search index of each session row: ``mn[k][j]`` / ``mx[k][j]`` = lowest
    low / highest high of the ``2**k`` bars starting at position ``j`` (clipped
    at the session end).  Built by doubling inside the session array,
    ``m_k[j] = min(m_{k-1}[j], m_{k-1}[j + 2**(k-1)])``: O(bars x levels) per
    session, no window pass over the bar rows.  The number of levels follows
    each session's size, so that the blocks together span it."""
    top = F.greatest(F.lit(1), F.ceil(F.log2(F.size(bars) + F.lit(1))).cast("int"))

    def levels_of(field: str, pick) -> Column:
        def step(acc, k):
            prev = F.element_at(acc, k)
            width = F.pow(F.lit(2), k - 1).cast("int")
            return F.concat(acc, F.array(F.transform(prev, lambda v, j: pick(v, F.try_element_at(prev, j + 1 + width)))))
        base = F.array(F.transform(bars, lambda b: b[field]))
        return F.aggregate(F.filter(F.sequence(F.lit(0), top - 1), lambda k: k > 0), base, step)

    return per_session.withColumns({"mn": levels_of("low", F.least), "mx": levels_of("high", F.greatest)})


def _first_hit(mn_idx: Column, mx_idx: Column, n: Column, after: Column, side: Column, level: Column,
               kind: str) -> Column:
    """Position of the first bar after ``after`` that reaches ``level`` (NULL if
    none), by binary lifting over the search index: whole blocks without a
    hit are skipped, largest first -- O(levels) per search.

    ``kind="against"``: long low <= level / short high >= level (stops);
    ``kind="with"``: long high >= level / short low <= level (targets)."""
    long_ = side == 1

    def clear(pos, k):
        mn = F.element_at(F.element_at(mn_idx, k + 1), pos + 1)
        mx = F.element_at(F.element_at(mx_idx, k + 1), pos + 1)
        if kind == "against":
            return F.when(long_, mn > level).otherwise(mx < level)
        return F.when(long_, mx < level).otherwise(mn > level)

    def step(pos, k):
        jump = F.pow(F.lit(2), k).cast("int")
        return F.when((pos + jump <= n) & clear(pos, k), pos + jump).otherwise(pos)

    pos = F.aggregate(F.sequence(F.size(mn_idx) - 1, F.lit(0), F.lit(-1)), (after + 1).cast("int"), step)
    return F.when(pos < n, pos)


def outcomes(plans: Column, bars: Column, be_label: bool = False, mn: Column | None = None,
             mx: Column | None = None) -> Column:
    """Bracket outcomes of planned entries: ``array<struct<i, ok, trade>>``.

    ``plans`` holds entry plans (fields of :func:`add_entry_plan`, ``idx`` =
    signal bar); ``bars`` is the session's ts-sorted array (``idx`` =
    position).  First hits are searched only after the entry bar: stop ``s``
    vs +1R target ``t`` (the stop wins a tie); after ``t`` the break-even
    stop ``b`` (bars after ``t``) vs the extensions ``x`` (from ``t`` on; ``b``
    wins a tie); else end of day at the last bar's close.  The work is staged
    through ``transform`` so each search runs once per plan.
    """
    n = F.size(bars)
    mn = F.col("mn") if mn is None else mn
    mx = F.col("mx") if mx is None else mx

    def first(p, after, level, kind):
        return _first_hit(mn, mx, n, after, p["sig"], level, kind)

    s1 = F.transform(plans, lambda p: F.struct(
        p.alias("p"),
        first(p, p["idx"] + 1, p["stop"], "against").alias("s"),
        first(p, p["idx"] + 1, p["tp1"], "with").alias("t")))
    # either extension: the nearer one decides whether the bar reaches one
    s2 = F.transform(s1, lambda q: F.struct(
        q["p"].alias("p"), q["s"].alias("s"), q["t"].alias("t"),
        (q["s"].isNotNull() & (q["t"].isNull() | (q["s"] <= q["t"]))).alias("stopped"),
        first(q["p"], q["t"], q["p"]["e_open"], "against").alias("b"),
        first(q["p"], q["t"] - 1, F.when(q["p"]["sig"] == 1, F.least(q["p"]["ext1"], q["p"]["ext2"]))
              .otherwise(F.greatest(q["p"]["ext1"], q["p"]["ext2"])), "with").alias("x")))
    s3 = F.transform(s2, lambda q: F.struct(
        q["p"].alias("p"), q["stopped"].alias("stopped"),
        (~q["stopped"] & q["t"].isNotNull()).alias("filled"),
        (~q["stopped"] & q["t"].isNotNull() & q["b"].isNotNull()
         & (q["x"].isNull() | (q["b"] <= q["x"]))).alias("be_stop"),
        F.when(q["stopped"], q["s"]).when(q["t"].isNotNull() & q["b"].isNotNull()
                                          & (q["x"].isNull() | (q["b"] <= q["x"])), q["b"])
         .when(q["t"].isNotNull(), q["x"]).alias("exit_hit")))

    def final(q):
        p = q["p"]
        long_ = p["sig"] == 1
        entry, r = p["e_open"], p["R"]
        last = F.element_at(bars, -1)
        tp = q["filled"] & ~q["be_stop"] & q["exit_hit"].isNotNull()
        exit_idx = F.coalesce(q["exit_hit"], last["idx"])
        xbar = F.element_at(bars, exit_idx + 1)
        hit1 = F.when(long_, xbar["high"] >= p["ext1"]).otherwise(xbar["low"] <= p["ext1"])
        target = F.when(hit1, p["ext1"]).otherwise(p["ext2"])
        half_r = F.lit(0.5) * r
        gain = F.when(long_, target - entry).otherwise(entry - target)
        move = F.when(long_, last["close"] - entry).otherwise(entry - last["close"])
        half = F.lit(0.5) * move
        reason = (F.when(q["stopped"], F.lit("STOP"))
                   .when(q["be_stop"], F.lit("STOP_BE" if be_label else "STOP"))
                   .when(tp, F.concat(F.lit("TP"), F.when(hit1, p["n1"]).otherwise(p["n2"])))
                   .otherwise(F.lit("EOD")))
        price = (F.when(q["stopped"], p["stop"]).when(q["be_stop"], entry).when(tp, target)
                  .otherwise(last["close"]))
        pnl = (F.when(q["stopped"], F.try_divide(-half_r - half_r, r))
                .when(q["be_stop"], F.try_divide(half_r - half_r, r))
                .when(tp, F.try_divide(half_r + F.lit(0.5) * gain, r))
                .when(q["filled"], F.try_divide(half_r + half, r))
                .otherwise(F.try_divide(half + half, r)))
        trade = F.struct(
            (p["idx"] + 1).cast("int").alias("idx_in"), p["e_ts"].alias("ts_in"),
            F.when(long_, F.lit("LONG")).otherwise(F.lit("SHORT")).alias("side"),
            entry.alias("entry"), r.alias("R"), exit_idx.cast("int").alias("exit_idx"),
            xbar["ts"].alias("exit_ts"), reason.alias("exit_reason"), price.alias("exit_price"),
            pnl.alias("pnl_R"))
        return F.struct(p["idx"].alias("i"), (p["has_next"] & p["valid"]).alias("ok"), trade.alias("trade"))

    return F.transform(s3, final)


def _empty_trades() -> Column:
    return F.array().cast(T.ArrayType(TRADE))


def take_non_overlapping(cands: Column, trade_of=lambda c: c) -> Column:
    """Greedy left-to-right choice (F17): a candidate signal on bar ``i`` is
    taken when ``i`` is after the last exit and its plan is valid; the trade's
    exit then blocks later candidates.  ``cands`` is in ascending bar order;
    ``trade_of(c)`` gives ``struct(i, ok, trade)`` for an element."""
    init = F.struct(F.lit(-1).alias("last_exit"), _empty_trades().alias("trades"))

    def step(acc, c):
        o = trade_of(c)
        take = (o["i"] > acc["last_exit"]) & o["ok"]
        return F.struct(F.when(take, o["trade"]["exit_idx"]).otherwise(acc["last_exit"]).alias("last_exit"),
                        F.when(take, F.concat(acc["trades"], F.array(o["trade"]))).otherwise(acc["trades"])
                        .alias("trades"))
    return F.aggregate(cands, init, step, lambda acc: acc["trades"])


def bracket_trades(plan: DataFrame, keys: Sequence[str] = SESSION_KEYS, be_label: bool = False,
             extra_keys: Sequence[str] = ()) -> DataFrame:
    """Trades of each session: one row per trade (F16 + F17).

    ``plan`` holds one row per kept bar with the columns of
    :func:`add_entry_plan`.  Per session: the outcome of every signal bar's
    plan (first-hit searches over the session's search index, O(log bars) each), then the greedy
    non-overlapping choice.  ``extra_keys`` are carried as group keys.
    """
    gk = [*extra_keys, *keys]
    item = F.struct(*[F.col(c) for c in _BAR_FIELDS])
    per_session = add_search_arrays(plan.groupBy(*gk).agg(F.sort_array(F.collect_list(item)).alias("bars")))
    outs = outcomes(F.filter("bars", lambda x: x["sig"] != 0), F.col("bars"), be_label)
    out = per_session.select(*gk, F.explode(take_non_overlapping(outs)).alias("t"))
    return out.select(*gk, "t.*")


# --------------------------------------------------------------------------- whole runs
def run(bars: DataFrame, rs: RuleSet) -> DataFrame:
    """Backtest of one rule set over every session."""
    if rs.kind == "D":
        from barlab.operators import swings
        plan = swings.rolling_plan(session_bars(bars, rs), rs)
    else:
        plan = add_entry_plan(add_signals(session_bars(bars, rs), rs), rs)
    return bracket_trades(plan, rs.keys, be_label=rs.kind in ("C", "D"))


def trade_columns(trades: DataFrame) -> DataFrame:
    return trades.select("symbol", "dt", "ts_in", "side", "entry", "R", "exit_ts", "exit_reason",
                         "exit_price", "pnl_R")


# --------------------------------------------------------------------------- dashboard rules
def dashboard_signals(bars: DataFrame, ema_fast: int = 9, ema_slow: int = 21,
                      keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """Rules of the signal view (F8): direction gate, 50-61.8 zone of the
    session swing, strict EMA trend, RSI > 45 long / < 55 short."""
    rs = RuleSet(ema_fast=ema_fast, ema_slow=ema_slow, keys=tuple(keys))
    df = fib.session_extremes(add_indicators(bars, rs), keys)
    lo, hi, d = F.col("lo"), F.col("hi"), F.col("direction")
    l50, l618 = fib.level(lo, hi, d, F.lit(0.5)), fib.level(lo, hi, d, F.lit(0.618))
    zone = fib.touches(F.least(l50, l618), F.greatest(l50, l618))
    e127, _ = fib.extensions(lo, hi, d == "up")
    fast, slow = F.col("ema_fast"), F.col("ema_slow")
    long_e = _true((d == "up") & zone & (fast > slow) & (F.col("rsi") > 45))
    short_e = _true((d == "down") & zone & (fast < slow) & (F.col("rsi") < 55))
    return df.withColumns({"long_entry": long_e, "short_entry": short_e, "ext127": e127})


def signal_table(sig: DataFrame, k: int = 20, keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """First ``k`` signal rows of each session with stop and target."""
    rows = sig.filter(F.col("long_entry") | F.col("short_entry"))
    side = F.when(F.col("long_entry"), F.lit("LONG")).otherwise(F.lit("SHORT"))
    rows = rows.select(
        *keys, "ts", side.alias("side"), F.col("close").alias("price"),
        F.when(side == "LONG", F.col("lo")).otherwise(F.col("hi")).alias("stop_level"),
        F.col("ext127").alias("tgt_level"), "ema_fast", "ema_slow", "rsi")
    w = Window.partitionBy(*keys).orderBy("ts")
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
