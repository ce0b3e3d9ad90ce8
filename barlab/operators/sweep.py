"""Parameter sweep of rule set A.

Factored plan:

1. indicators for every distinct length in the grid, once per bar (one
   exchange on the session key);
2. one sorted bar array per session (a session is bounded by the bar
   resolution, never by the data volume);
3. outcome axes (16 combinations): the bracket outcome of an entry on every
   bar of the session, computed once per (session, outcome combination);
4. signal axes (324 combinations): the candidate signal bars, as a
   ``filter`` of the session array;
5. every (signal, outcome) pair runs the greedy non-overlapping choice over
   its candidates inside the session row (a few steps each); only trades
   become rows, so no session array is copied per combination;
6. per (symbol, combination) metrics; drawdown windows hold the trades of
   one combination (days x trades/day).

The grid itself is a fixed, user-given parameter table expanded from literal
arrays on each session row: nothing is broadcast and no join is planned.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab import SESSION_KEYS
from barlab.functions import indicators as ind
from barlab.functions import scalar
from barlab.operators import backtest as bt
from barlab.operators import fib, metrics

# Grid of the reference's sweep (fixed values).
GRID_A = {
    "ema_fast": [8, 9, 12],
    "ema_slow": [21, 26, 34],
    "rsi_len": [14],
    "rsi_long": [48, 50, 52],
    "rsi_short": [48, 50, 52],
    "atr_len": [14, 21],
    "atr_mult_stop": [0.25, 0.5, 0.75, 1.0],
    "retr_low": [0.50, 0.382],
    "retr_high": [0.618, 0.62],
    "ext_pref": [("161", "127"), ("127", "161")],
}
SWEEP_WINDOWS = ("09:35", "11:00", "14:00", "15:45")
PARAM_COLS = ["ema_fast", "ema_slow", "rsi_len", "rsi_long", "rsi_short", "atr_len",
              "atr_mult_stop", "retr_low", "retr_high", "ext_first", "ext_second"]


def grid_size(grid: dict) -> int:
    """Number of combinations kept (``ema_fast < ema_slow``)."""
    pairs = sum(1 for f, s in itertools.product(grid["ema_fast"], grid["ema_slow"]) if f < s)
    rest = 1
    for k, v in grid.items():
        if k not in ("ema_fast", "ema_slow"):
            rest *= len(v)
    return pairs * rest


def _lengths(grid: dict) -> tuple[list[int], list[int], list[int]]:
    emas = sorted(set(grid["ema_fast"]) | set(grid["ema_slow"]))
    return emas, sorted(set(grid["rsi_len"])), sorted(set(grid["atr_len"]))


def sweep_bars(bars: DataFrame, grid: dict = GRID_A, windows: Sequence[str] | None = SWEEP_WINDOWS,
               tz: str = "UTC", keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """One row per session: ``lo, hi, direction`` and the sorted array of kept
    bars carrying every indicator length the grid needs."""
    emas, rsis, atrs = _lengths(grid)
    up, dn = ind.rsi_inputs("close", "null", keys=keys)
    df = ind.with_index(bars, keys).withColumns({"_up": up, "_dn": dn, "_tr": ind.true_range_expr(keys=keys)})
    specs = [ind.Smoothing("close", f"ema_{n}", 2.0 / (n + 1.0)) for n in emas]
    for n in rsis:
        specs += ind.rsi_smoothings("_up", "_dn", n, f"_up_{n}", f"_dn_{n}")
    specs += [ind.Smoothing("_tr", f"atr_{n}", 1.0 / n) for n in atrs]
    df = ind.smooth_all(df, specs, keys=keys)
    df = df.withColumns({f"rsi_{n}": ind.rsi_of(F.col(f"_up_{n}"), F.col(f"_dn_{n}"), "null") for n in rsis})
    if windows:
        df = df.filter(scalar.in_time_windows(F.col("ts"), windows, tz))
        df = ind.with_index(df.drop("idx"), keys)
    df = fib.session_extremes(df, keys)
    w = ind.series_window(keys, "idx")
    df = df.withColumns({"has_next": F.lead("idx").over(w).isNotNull(), "e_ts": F.lead("ts").over(w),
                         "e_open": F.lead("open").over(w),
                         **{f"e_atr_{n}": F.lead(f"atr_{n}").over(w) for n in atrs}})
    item = F.struct(
        "idx", "ts", "high", "low", "close", "has_next", "e_ts", "e_open",
        F.array(*[F.col(f"ema_{n}") for n in emas]).alias("emas"),
        F.array(*[F.col(f"rsi_{n}") for n in rsis]).alias("rsis"),
        F.array(*[F.col(f"e_atr_{n}") for n in atrs]).alias("e_atrs"))
    return df.groupBy(*keys, "lo", "hi", "direction").agg(F.sort_array(F.collect_list(item)).alias("bars"))


# Outcome axes of the grid (atr_len, atr_mult_stop, ext_pref) and signal axes
# (everything else) are expanded separately: outcomes of every possible entry
# are computed once per (session, outcome combination), signals once per
# (session, signal combination), and only signal combinations with at least
# one candidate meet the outcome combinations.
OUTCOME_AXES = ("atr_len", "atr_mult_stop", "ext_pref")


def _outcome_combos(grid: dict) -> list[dict]:
    out = []
    for a, m, e in itertools.product(grid["atr_len"], grid["atr_mult_stop"], grid["ext_pref"]):
        out.append({"atr_len": int(a), "atr_mult_stop": float(m), "ext_first": e[0], "ext_second": e[1]})
    return out


def _signal_combos(grid: dict) -> list[dict]:
    out = []
    for f, s, rl, lg, sh, lo, hi in itertools.product(grid["ema_fast"], grid["ema_slow"], grid["rsi_len"],
                                                      grid["rsi_long"], grid["rsi_short"], grid["retr_low"],
                                                      grid["retr_high"]):
        if f < s:
            out.append({"ema_fast": int(f), "ema_slow": int(s), "rsi_len": int(rl), "rsi_long": int(lg),
                        "rsi_short": int(sh), "retr_low": float(lo), "retr_high": float(hi)})
    return out


def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"{v!r}D"
    return "'" + str(v).replace("'", "''") + "'"


def _lit_structs(rows: list[dict]) -> Column:
    """A constant ``array<struct>`` from one SQL literal (one parse in the JVM,
    not one call per value)."""
    items = ", ".join("named_struct(" + ", ".join(f"'{k}', {_sql_lit(v)}" for k, v in r.items()) + ")"
                      for r in rows)
    return F.expr(f"array({items})")


def _entry_plan(x: Column, oc: Column, atr_pos: Column) -> Column:
    """Plan of an entry signalled on bar ``x`` under outcome combination ``oc``
    (rule A: the side follows the session direction)."""
    lo, hi, d = F.col("lo"), F.col("hi"), F.col("direction")
    side = F.when(d == "up", 1).otherwise(-1)
    e_atr = F.element_at(x["e_atrs"], atr_pos)
    m = oc["atr_mult_stop"]
    stop = F.when(side == 1, lo - m * e_atr).otherwise(hi + m * e_atr)
    r = F.abs(x["e_open"] - stop)
    valid = F.coalesce(r.isNotNull() & ~F.isnan(r) & (r > 0), F.lit(False))
    e127, e161 = fib.extensions(lo, hi, d == "up")
    ext1 = F.when(oc["ext_first"] == "127", e127).otherwise(e161)
    ext2 = F.when(oc["ext_second"] == "127", e127).otherwise(e161)
    return F.struct(
        x["idx"].alias("idx"), x["ts"].alias("ts"), side.alias("sig"), x["has_next"].alias("has_next"),
        valid.alias("valid"), x["e_ts"].alias("e_ts"), x["e_open"].alias("e_open"), r.alias("R"),
        stop.alias("stop"), (x["e_open"] + side * r).alias("tp1"), ext1.alias("ext1"), ext2.alias("ext2"),
        oc["ext_first"].alias("n1"), oc["ext_second"].alias("n2"))


def _signal(x: Column, sc: Column) -> Column:
    """Rule-A signal of bar ``x`` under signal combination ``sc`` (bool)."""
    lo, hi, d = F.col("lo"), F.col("hi"), F.col("direction")
    rl = F.greatest(F.lit(0.0), F.least(F.lit(1.0), sc["retr_low"]))
    rh = F.greatest(F.lit(0.0), F.least(F.lit(1.0), sc["retr_high"]))
    a, b = fib.level(lo, hi, d, rl), fib.level(lo, hi, d, rh)
    zlo, zhi = F.least(a, b), F.greatest(a, b)
    ef = F.element_at(x["emas"], sc["fi"])
    es = F.element_at(x["emas"], sc["si"])
    rsi = F.element_at(x["rsis"], sc["ri"])
    touch = (x["low"] <= zhi) & (x["high"] >= zlo)
    long_ok = (d == "up") & touch & (ef > es) & (rsi >= sc["rsi_long"])
    short_ok = (d == "down") & touch & (ef < es) & (rsi <= F.lit(100) - sc["rsi_short"])
    return F.coalesce(long_ok | short_ok, F.lit(False))


def _evaluated(bars: DataFrame, grid: dict, windows: Sequence[str] | None, keys: Sequence[str]):
    """One row per session: ``lists``, the distinct lists of signal bars over all
    signal combinations; ``pick``, each combination's list number; ``trades``,
    per list and outcome combination the trades taken.

    In an up session the short threshold plays no part (and the reverse), so many
    combinations share a list; each list is evaluated once, and outcomes are
    searched only for bars that are in some list."""
    emas, rsis, atrs = _lengths(grid)
    ocs, scs = _outcome_combos(grid), _signal_combos(grid)
    for o in ocs:
        o["ai"] = atrs.index(o["atr_len"]) + 1
    for s in scs:
        s["fi"] = emas.index(s["ema_fast"]) + 1
        s["si"] = emas.index(s["ema_slow"]) + 1
        s["ri"] = rsis.index(s["rsi_len"]) + 1
    oc_lit, sc_lit = _lit_structs(ocs), _lit_structs(scs)
    sessions = sweep_bars(bars, grid, windows, keys=keys)
    cands = F.transform(sc_lit, lambda sc: F.transform(F.filter("bars", lambda x: _signal(x, sc)), lambda x: x["idx"]))
    sessions = sessions.withColumn("cands", cands)
    sessions = sessions.withColumn("lists", F.array_distinct(F.filter("cands", lambda c: F.size(c) > 0)))
    sessions = sessions.filter(F.size("lists") > 0)
    sessions = sessions.withColumns({
        "pick": F.transform("cands", lambda c: F.array_position("lists", c)),
        "needed": F.array_distinct(F.flatten("lists"))}).drop("cands")
    sessions = bt.add_search_arrays(sessions)
    planned = F.transform("needed", lambda i: F.element_at("bars", i + 1))
    outs = F.transform(oc_lit, lambda oc: bt.outcomes(
        F.transform(planned, lambda x: _entry_plan(x, oc, oc["ai"])), F.col("bars")))
    sessions = sessions.withColumn("outs", outs).drop("mn", "mx", "bars")
    trades = F.transform("lists", lambda c: F.transform("outs", lambda o: bt.take_non_overlapping(
        c, lambda i: F.element_at(o, F.array_position("needed", i).cast("int")))))
    return sessions.select(*keys, "pick", trades.alias("trades")), sc_lit, oc_lit


def _params(sc: Column, oc: Column) -> list[Column]:
    return [*[sc[c].alias(c) for c in ("ema_fast", "ema_slow", "rsi_len", "rsi_long", "rsi_short")],
            oc["atr_len"].alias("atr_len"), oc["atr_mult_stop"].alias("atr_mult_stop"), sc["retr_low"].alias("retr_low"),
            sc["retr_high"].alias("retr_high"), oc["ext_first"].alias("ext_first"), oc["ext_second"].alias("ext_second")]


def _by_combination(sessions: DataFrame, keys: Sequence[str], value, name: str) -> DataFrame:
    """One row per session, signal and outcome combination with trades:
    ``si, oi`` (numbers in the grid) and ``value`` of the trades as ``name``."""
    found = sessions.withColumn("_v", F.transform("trades", lambda l: F.transform(l, value)))
    per = F.filter(F.transform("pick", lambda p, si: F.struct(si.alias("si"), p.alias("p"))), lambda x: x["p"] > 0)
    rows = found.select(*keys, F.explode(F.transform(per, lambda x: F.struct(
        x["si"].alias("si"), F.element_at(F.col("_v"), x["p"].cast("int")).alias("v")))).alias("r"))
    return rows.select(*keys, F.col("r.si").alias("si"), F.posexplode("r.v").alias("oi", name))


def sweep_trades(bars: DataFrame, grid: dict = GRID_A, windows: Sequence[str] | None = SWEEP_WINDOWS,
                 keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """Trades of every combination on every session."""
    sessions, sc_lit, oc_lit = _evaluated(bars, grid, windows, keys)
    rows = _by_combination(sessions, keys, lambda t: t, "ts_").select(*keys, "si", "oi", F.explode("ts_").alias("t"))
    rows = rows.select(*keys, F.element_at(sc_lit, F.col("si") + 1).alias("sc"),
                       F.element_at(oc_lit, F.col("oi") + 1).alias("oc"), "t")
    return rows.select(*keys, *_params(F.col("sc"), F.col("oc")), "t.*")


def _summarised(rows: DataFrame, sc_lit: Column, oc_lit: Column, instrument: Sequence[str]) -> DataFrame:
    """Metrics per instrument and combination from day metrics ``m``; keeps ``si, oi``."""
    days = rows.groupBy(*instrument, "si", "oi").agg(F.sort_array(F.collect_list(F.struct("dt", "m"))).alias("days"))
    total = days.select(*instrument, "si", "oi", metrics.merged_days(F.col("days")).alias("a"))
    total = total.select(*instrument, "si", "oi", F.element_at(sc_lit, F.col("si") + 1).alias("sc"),
                         F.element_at(oc_lit, F.col("oi") + 1).alias("oc"), "a")
    return total.select(*instrument, "si", "oi", *_params(F.col("sc"), F.col("oc")), *metrics.summary_of(F.col("a")))


def sweep_summary(bars: DataFrame, grid: dict = GRID_A, windows: Sequence[str] | None = SWEEP_WINDOWS,
                  instrument: Sequence[str] = ("symbol",)) -> DataFrame:
    """Metrics per instrument and combination (``sweep_results`` schema) straight
    from the bars: a session's trades are reduced inside its row, so one narrow
    row per session and combination is shuffled, under two integers; days merge
    in order, and the parameters are looked up at the end."""
    keys = (*instrument, "dt")
    sessions, sc_lit, oc_lit = _evaluated(bars, grid, windows, keys)
    rows = _by_combination(sessions, keys, lambda t: metrics.day_metrics(t), "m").filter("m.n > 0")
    return _summarised(rows, sc_lit, oc_lit, instrument).drop("si", "oi")


def best_trades(bars: DataFrame, path: str, grid: dict = GRID_A, windows: Sequence[str] | None = SWEEP_WINDOWS) -> DataFrame:
    """Trades of each symbol's best combination, from one evaluation: sessions
    with their lists' trades are written to ``path`` and read twice."""
    keys = SESSION_KEYS
    sessions, sc_lit, oc_lit = _evaluated(bars, grid, windows, keys)
    sessions.write.mode("overwrite").parquet(path)
    sessions = bars.sparkSession.read.schema(sessions.schema).parquet(path)
    rows = _by_combination(sessions, keys, lambda t: metrics.day_metrics(t), "m").filter("m.n > 0")
    best = rank_results(_summarised(rows, sc_lit, oc_lit, ("symbol",))).filter(F.col("rank") == 1)
    chosen = sessions.join(best.select("symbol", "si", "oi"), "symbol")  # one row per symbol: no row is multiplied
    of_list = F.try_element_at("trades", F.nullif(F.element_at("pick", F.col("si") + 1), F.lit(0)).cast("int"))
    return chosen.select(*keys, F.explode(F.element_at(of_list, F.col("oi") + 1)).alias("t")).select(*keys, "t.*")


def sweep_results(trades: DataFrame, instrument: Sequence[str] = ("symbol",)) -> DataFrame:
    """Metrics per instrument and combination of given trades."""
    return metrics.trade_summary(trades, [*instrument, *PARAM_COLS])


def rank_results(results: DataFrame, instrument: Sequence[str] = ("symbol",)) -> DataFrame:
    """``rank``: 1 = best by netR, then profit factor, both descending (on
    values rounded to 6 places); grid columns break the remaining ties (O3)."""
    from pyspark.sql import Window
    order = [F.round("netR", 6).desc(), F.round("pf", 6).desc(), *[F.col(c).asc() for c in PARAM_COLS]]
    w = Window.partitionBy(*instrument).orderBy(*order)
    return results.withColumn("rank", F.row_number().over(w))
