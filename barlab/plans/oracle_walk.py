"""DuckDB oracle for the backtests: indicators, session filter, signals and
entry plan as window SQL, then the trade walk as a recursive CTE that steps
through each session one bar at a time (a different formulation from the
Spark fold, so the two check each other)."""

from __future__ import annotations

from barlab.functions.scalar import hhmm_to_us
from barlab.operators.backtest import RuleSet
from barlab.plans.oracle import BARS_CTE, ema_sql, wilder_sql

S = "PARTITION BY symbol, dt ORDER BY ts"
P = "PARTITION BY symbol, dt"
PI = "PARTITION BY symbol, dt ORDER BY idx"

TRADE_COLS = ["symbol", "dt", "ts_in", "side", "entry", "R", "exit_ts", "exit_reason",
              "exit_price", "pnl_R"]
TRADE_DOUBLES = ["entry", "R", "exit_price", "pnl_R"]


def tod_sql(windows) -> str:
    if not windows:
        return "TRUE"
    tod = "(epoch_us(ts) % 86400000000)"
    return "(" + " OR ".join(f"{tod} BETWEEN {hhmm_to_us(s)} AND {hhmm_to_us(e)}"
                             for s, e in zip(windows[::2], windows[1::2])) + ")"


def prepared_ctes(rs: RuleSet) -> list[str]:
    """CTEs up to ``sg`` (per-bar signals on the kept bars)."""
    c = [BARS_CTE.strip(),
         f"b AS (SELECT *, CAST(row_number() OVER ({S}) - 1 AS INTEGER) AS idx FROM bars)",
         f"e AS (SELECT *, close - lag(close) OVER ({S}) AS dlt, greatest(abs(high - low), "
         f"abs(high - lag(close) OVER ({S})), abs(low - lag(close) OVER ({S}))) AS tr FROM b)",
         f"i1 AS (SELECT *, {ema_sql('close', rs.ema_fast)} AS ema_fast, "
         f"{ema_sql('close', rs.ema_slow)} AS ema_slow, greatest(dlt, 0.0) AS up, "
         f"greatest(-dlt, 0.0) AS dn FROM e)",
         f"i2 AS (SELECT *, {wilder_sql('up', rs.rsi_len, start=1)} AS au, "
         f"{wilder_sql('dn', rs.rsi_len, start=1)} AS ad, {wilder_sql('tr', rs.atr_len)} AS atr FROM i1)",
         "i3 AS (SELECT *, 100.0 - 100.0 / (1.0 + au / nullif(ad, 0.0)) AS rsi FROM i2)",
         f"f0 AS (SELECT * EXCLUDE (idx) FROM i3 WHERE {tod_sql(rs.session_filter)})",
         f"f AS (SELECT *, CAST(row_number() OVER ({S}) - 1 AS INTEGER) AS idx FROM f0)",
         f"x1 AS (SELECT *, min(low) OVER ({P}) AS lo, max(high) OVER ({P}) AS hi FROM f)",
         f"x2 AS (SELECT *, min(CASE WHEN low = lo THEN idx END) OVER ({P}) AS idx_low, "
         f"min(CASE WHEN high = hi THEN idx END) OVER ({P}) AS idx_high FROM x1)",
         f"x3 AS (SELECT *, CASE WHEN idx_low < idx_high THEN 'up' ELSE 'down' END AS direction, "
         f"ema_fast - lag(ema_fast, 3) OVER ({PI}) AS slope FROM x2)"]
    if rs.kind == "A":
        rl, rh = (max(0.0, min(1.0, float(r))) for r in (rs.retr_low, rs.retr_high))
        lvl = lambda r: f"CASE WHEN direction = 'up' THEN lo + (hi - lo) * {r!r} ELSE hi - (hi - lo) * {r!r} END"
        zone = (f"least({lvl(rl)}, {lvl(rh)}) AS zlo, greatest({lvl(rl)}, {lvl(rh)}) AS zhi")
    else:
        a, b = f"lo + {float(rs.retr_low)!r} * (hi - lo)", f"lo + {float(rs.retr_high)!r} * (hi - lo)"
        pad = f"{float(rs.zone_pad_frac)!r} * abs(hi - lo)"
        zone = f"least({a}, {b}) - {pad} AS zlo, greatest({a}, {b}) + {pad} AS zhi"
    c.append(f"z AS (SELECT *, {zone} FROM x3)")
    up = "ema_fast > ema_slow"
    dn = "ema_fast < ema_slow"
    if rs.allow_slope_or:
        up, dn = f"({up} OR slope > 0)", f"({dn} OR slope < 0)"
    touch = "(low <= zhi AND high >= zlo)"
    if rs.kind == "A":
        lc = f"direction = 'up' AND {touch} AND {up} AND rsi >= {rs.rsi_long}"
        sc = f"direction = 'down' AND {touch} AND {dn} AND rsi <= {100 - rs.rsi_short}"
    elif rs.kind == "B":
        lc = f"{touch} AND {up} AND rsi >= {rs.rsi_long}"
        sc = f"{touch} AND {dn} AND rsi <= {100 - rs.rsi_short}"
    else:
        lc = f"direction = 'up' AND {touch} AND {up} AND rsi >= {rs.rsi_long}"
        sc = f"direction = 'down' AND {touch} AND {dn} AND rsi <= {rs.rsi_short}"
    c.append(f"sg AS (SELECT *, CASE WHEN coalesce({lc}, false) THEN 1 WHEN coalesce({sc}, false) "
             "THEN -1 ELSE 0 END AS sig FROM z)")
    return c


def plan_ctes(rs: RuleSet) -> list[str]:
    e_atr = "lead(atr) OVER (" + PI + ")"
    if rs.kind != "A":
        e_atr = f"coalesce({e_atr}, 0.0)"
    m = float(rs.atr_mult_stop)
    up = "direction = 'up'" if rs.kind == "A" else "sig = 1"
    e127 = f"CASE WHEN {up} THEN hi + 0.272 * (hi - lo) ELSE lo - 0.272 * (hi - lo) END"
    e161 = f"CASE WHEN {up} THEN hi + 0.618 * (hi - lo) ELSE lo - 0.618 * (hi - lo) END"
    pref = ("161", "127") if rs.kind == "B" else tuple(rs.ext_pref)
    ext = {"127": e127, "161": e161}
    return [
        f"pl0 AS (SELECT *, lead(idx) OVER ({PI}) IS NOT NULL AS has_next, lead(ts) OVER ({PI}) AS e_ts, "
        f"lead(open) OVER ({PI}) AS e_open, {e_atr} AS e_atr FROM sg)",
        f"pl1 AS (SELECT *, CASE WHEN sig = 1 THEN lo - {m!r} * e_atr WHEN sig = -1 THEN hi + {m!r} * e_atr END "
        "AS stop FROM pl0)",
        "pl2 AS (SELECT *, abs(e_open - stop) AS R FROM pl1)",
        f"pl AS (SELECT *, coalesce(R > 0, false) AS valid, e_open + sig * R AS tp1, "
        f"{ext[pref[0]]} AS ext1, {ext[pref[1]]} AS ext2, '{pref[0]}' AS n1, '{pref[1]}' AS n2 FROM pl2)",
    ]


_STATE = ["open", "side", "e_idx", "e_ts", "entry", "R", "stop_lvl", "tp1", "ext1", "ext2", "n1", "n2",
          "filled", "last_exit", "last_ts", "last_close"]
_REC = ["emit", "r_idx_in", "r_ts_in", "r_side", "r_entry", "r_R", "r_exit_ts", "r_reason",
        "r_exit_price", "r_pnl"]


def sim_cte(be_label: bool, keys: tuple[str, ...] = ("symbol", "dt")) -> str:
    ks = ", ".join(keys)
    sk = ", ".join(f"s.{k}" for k in keys)
    zk = ", ".join(f"z.{k}" for k in keys)
    on = " AND ".join(f"p.{k} = s.{k}" for k in keys)
    anchor = (
        f"SELECT DISTINCT {ks}, -1 AS idx, false AS open, 0 AS side, -1 AS e_idx, "
        "CAST(NULL AS TIMESTAMP) AS e_ts, CAST(NULL AS DOUBLE) AS entry, CAST(NULL AS DOUBLE) AS R, "
        "CAST(NULL AS DOUBLE) AS stop_lvl, CAST(NULL AS DOUBLE) AS tp1, CAST(NULL AS DOUBLE) AS ext1, "
        "CAST(NULL AS DOUBLE) AS ext2, CAST(NULL AS VARCHAR) AS n1, CAST(NULL AS VARCHAR) AS n2, "
        "false AS filled, -1 AS last_exit, CAST(NULL AS TIMESTAMP) AS last_ts, "
        "CAST(NULL AS DOUBLE) AS last_close, false AS emit, CAST(NULL AS INTEGER) AS r_idx_in, "
        "CAST(NULL AS TIMESTAMP) AS r_ts_in, CAST(NULL AS INTEGER) AS r_side, CAST(NULL AS DOUBLE) AS r_entry, "
        "CAST(NULL AS DOUBLE) AS r_R, CAST(NULL AS TIMESTAMP) AS r_exit_ts, CAST(NULL AS VARCHAR) AS r_reason, "
        "CAST(NULL AS DOUBLE) AS r_exit_price, CAST(NULL AS DOUBLE) AS r_pnl FROM pl")
    t = (f"SELECT {sk}, s.open, s.side, s.e_idx, s.e_ts, s.entry, s.R, s.stop_lvl, s.tp1, "
         "s.ext1, s.ext2, s.n1, s.n2, s.filled, s.last_exit, p.idx AS x_idx, p.ts AS x_ts, p.high AS x_high, "
         "p.low AS x_low, p.close AS x_close, p.sig AS x_sig, p.has_next AS x_has_next, p.valid AS x_valid, "
         "p.e_ts AS x_e_ts, p.e_open AS x_e_open, p.R AS x_R, p.stop AS x_stop, p.tp1 AS x_tp1, "
         "p.ext1 AS x_ext1, p.ext2 AS x_ext2, p.n1 AS x_n1, p.n2 AS x_n2, "
         "(s.open AND p.idx > s.e_idx) AS active "
         f"FROM sim s JOIN pl p ON {on} AND p.idx = s.idx + 1")
    u = ("SELECT t.*, (t.active AND CASE WHEN t.side = 1 THEN t.x_low <= t.stop_lvl "
         f"ELSE t.x_high >= t.stop_lvl END) AS stop_hit FROM ({t}) t")
    v = ("SELECT u.*, (u.active AND NOT u.stop_hit AND NOT u.filled AND CASE WHEN u.side = 1 "
         f"THEN u.x_high >= u.tp1 ELSE u.x_low <= u.tp1 END) AS fill_now FROM ({u}) u")
    w = ("SELECT v.*, (v.filled OR v.fill_now) AS filled2, CASE WHEN v.fill_now THEN v.entry "
         f"ELSE v.stop_lvl END AS stop_lvl2 FROM ({v}) v")
    y = ("SELECT w.*, (w.active AND NOT w.stop_hit AND w.filled2 AND CASE WHEN w.side = 1 THEN "
         "w.x_high >= w.ext1 ELSE w.x_low <= w.ext1 END) AS hit1, (w.active AND NOT w.stop_hit AND "
         "w.filled2 AND CASE WHEN w.side = 1 THEN w.x_high >= w.ext2 ELSE w.x_low <= w.ext2 END) AS hit2, "
         "(NOT w.open AND w.x_idx > w.last_exit AND w.x_sig <> 0 AND w.x_has_next AND w.x_valid) AS open_new "
         f"FROM ({w}) w")
    zz = f"SELECT y.*, (y.stop_hit OR y.hit1 OR y.hit2) AS close_now FROM ({y}) y"
    be = "'STOP_BE'" if be_label else "'STOP'"
    tgt = "CASE WHEN z.hit1 THEN z.ext1 ELSE z.ext2 END"
    gain = f"CASE WHEN z.side = 1 THEN {tgt} - z.entry ELSE z.entry - {tgt} END"
    rec = (
        "z.close_now AS emit, z.e_idx AS r_idx_in, z.e_ts AS r_ts_in, z.side AS r_side, "
        "z.entry AS r_entry, z.R AS r_R, z.x_ts AS r_exit_ts, "
        f"CASE WHEN z.stop_hit THEN (CASE WHEN z.filled THEN {be} ELSE 'STOP' END) "
        "ELSE 'TP' || CASE WHEN z.hit1 THEN z.n1 ELSE z.n2 END END AS r_reason, "
        f"CASE WHEN z.stop_hit THEN z.stop_lvl ELSE {tgt} END AS r_exit_price, "
        "CASE WHEN z.stop_hit THEN (CASE WHEN z.filled THEN (0.5 * z.R - 0.5 * z.R) / z.R "
        "ELSE (-0.5 * z.R - 0.5 * z.R) / z.R END) "
        f"ELSE (0.5 * z.R + 0.5 * ({gain})) / z.R END AS r_pnl")
    pick = lambda new, old: f"CASE WHEN z.open_new THEN {new} ELSE {old} END"
    step = (
        f"SELECT {zk}, z.x_idx AS idx, "
        "CASE WHEN z.open THEN NOT z.close_now ELSE z.open_new END AS open, "
        f"{pick('z.x_sig', 'z.side')} AS side, {pick('z.x_idx + 1', 'z.e_idx')} AS e_idx, "
        f"{pick('z.x_e_ts', 'z.e_ts')} AS e_ts, {pick('z.x_e_open', 'z.entry')} AS entry, "
        f"{pick('z.x_R', 'z.R')} AS R, {pick('z.x_stop', 'z.stop_lvl2')} AS stop_lvl, "
        f"{pick('z.x_tp1', 'z.tp1')} AS tp1, {pick('z.x_ext1', 'z.ext1')} AS ext1, "
        f"{pick('z.x_ext2', 'z.ext2')} AS ext2, {pick('z.x_n1', 'z.n1')} AS n1, "
        f"{pick('z.x_n2', 'z.n2')} AS n2, "
        "CASE WHEN z.open_new THEN false ELSE (z.open AND NOT z.close_now AND z.filled2) END AS filled, "
        "CASE WHEN z.close_now THEN z.x_idx ELSE z.last_exit END AS last_exit, "
        "z.x_ts AS last_ts, z.x_close AS last_close, " + rec + f" FROM ({zz}) z")
    return f"sim AS ({anchor} UNION ALL {step})"


def trades_cte(be_label: bool, keys: tuple[str, ...] = ("symbol", "dt")) -> list[str]:
    """``sim`` and ``trades`` CTEs over a plan CTE ``pl`` keyed by ``keys``."""
    ks = ", ".join(keys)
    sk = ", ".join(f"s.{k}" for k in keys)
    on = " AND ".join(f"m.{k} = s.{k}" for k in keys)
    eod_move = "CASE WHEN side = 1 THEN last_close - entry ELSE entry - last_close END"
    trades = (
        "trades AS ("
        f"SELECT {ks}, r_ts_in AS ts_in, CASE WHEN r_side = 1 THEN 'LONG' ELSE 'SHORT' END AS side, "
        "r_entry AS entry, r_R AS R, r_exit_ts AS exit_ts, r_reason AS exit_reason, "
        "r_exit_price AS exit_price, r_pnl AS pnl_R FROM sim WHERE emit "
        "UNION ALL "
        f"SELECT {sk}, s.e_ts, CASE WHEN s.side = 1 THEN 'LONG' ELSE 'SHORT' END, s.entry, s.R, "
        "s.last_ts, 'EOD', s.last_close, "
        f"CASE WHEN s.filled THEN (0.5 * s.R + 0.5 * ({eod_move})) / s.R "
        f"ELSE (0.5 * ({eod_move}) + 0.5 * ({eod_move})) / s.R END "
        f"FROM sim s JOIN (SELECT {ks}, max(idx) AS mi FROM pl GROUP BY {ks}) m "
        f"ON {on} AND s.idx = m.mi WHERE s.open)")
    return [sim_cte(be_label, keys), trades]


def trades_sql(rs: RuleSet, tail: str | None = None) -> str:
    """Trade rows (``TRADE_COLS``) of one rule set; ``tail`` may add CTEs/selects
    over the CTE ``trades``."""
    ctes = prepared_ctes(rs) + plan_ctes(rs) + trades_cte(rs.kind in ("C", "D"))
    body = "WITH RECURSIVE " + ",\n".join(ctes)
    if tail is None:
        sel = ", ".join(f"round({c}, 6) AS {c}" if c in TRADE_DOUBLES else c for c in TRADE_COLS)
        return body + f"\nSELECT {sel} FROM trades"
    return body + "\n" + tail


def zigzag_ctes(mult: float, src: str = "zin") -> list[str]:
    """Recursive CTE ``zz`` stepping the rolling impulse through each session
    (``src`` has symbol, dt, idx, close, atr_filled)."""
    m = float(mult)
    thr = f"({m!r} * coalesce(p.atr_filled, 0.0))"
    c = "p.close"
    up_new = f"{c} >= s.piv + {thr}"
    dn_new = f"{c} <= s.piv - {thr}"
    d = (f"CASE WHEN s.d IS NULL THEN (CASE WHEN {up_new} THEN 'up' WHEN {dn_new} THEN 'down' END) "
         f"WHEN s.d = 'up' THEN (CASE WHEN {c} > s.last THEN 'up' WHEN s.last - {c} >= {thr} THEN 'down' ELSE 'up' END) "
         f"ELSE (CASE WHEN {c} < s.last THEN 'down' WHEN {c} - s.last >= {thr} THEN 'up' ELSE 'down' END) END")
    piv = (f"CASE WHEN s.d = 'up' AND NOT ({c} > s.last) AND s.last - {c} >= {thr} THEN {c} "
           f"WHEN s.d = 'down' AND NOT ({c} < s.last) AND {c} - s.last >= {thr} THEN {c} ELSE s.piv END")
    lo = (f"CASE WHEN s.d IS NULL THEN (CASE WHEN {up_new} THEN s.piv WHEN {dn_new} THEN {c} ELSE s.imp_lo END) "
          f"WHEN s.d = 'up' THEN (CASE WHEN {c} > s.last THEN s.imp_lo WHEN s.last - {c} >= {thr} THEN {c} "
          f"ELSE s.imp_lo END) ELSE (CASE WHEN {c} < s.last THEN {c} ELSE s.imp_lo END) END")
    hi = (f"CASE WHEN s.d IS NULL THEN (CASE WHEN {up_new} THEN {c} WHEN {dn_new} THEN s.piv ELSE s.imp_hi END) "
          f"WHEN s.d = 'up' THEN (CASE WHEN {c} > s.last THEN {c} ELSE s.imp_hi END) "
          f"ELSE (CASE WHEN {c} < s.last THEN s.imp_hi WHEN {c} - s.last >= {thr} THEN {c} ELSE s.imp_hi END) END")
    last = (f"CASE WHEN s.d IS NULL THEN (CASE WHEN {up_new} OR {dn_new} THEN {c} ELSE s.last END) "
            f"WHEN s.d = 'up' THEN (CASE WHEN {c} > s.last OR s.last - {c} >= {thr} THEN {c} ELSE s.last END) "
            f"ELSE (CASE WHEN {c} < s.last OR {c} - s.last >= {thr} THEN {c} ELSE s.last END) END")
    return [
        f"zz AS (SELECT symbol, dt, -1 AS idx, CAST(NULL AS VARCHAR) AS d, close AS piv, close AS imp_lo, "
        f"close AS imp_hi, close AS last FROM {src} WHERE idx = 0 "
        f"UNION ALL SELECT s.symbol, s.dt, p.idx, {d}, {piv}, {lo}, {hi}, {last} "
        f"FROM zz s JOIN {src} p ON p.symbol = s.symbol AND p.dt = s.dt AND p.idx = s.idx + 1)"]


def rolling_ctes(rs: RuleSet) -> list[str]:
    """Rule set D up to the plan CTE ``pl`` (levels read at the entry bar)."""
    base = prepared_ctes(replace_kind(rs, "C"))
    base = base[:base.index(next(c for c in base if c.startswith("x1 AS")))]
    m = float(rs.atr_mult_stop)
    pad = float(rs.zone_pad_frac)
    up = "ema_fast > ema_slow"
    dn = "ema_fast < ema_slow"
    if rs.allow_slope_or:
        up, dn = f"({up} OR slope > 0)", f"({dn} OR slope < 0)"
    c = base + [
        f"zin AS (SELECT *, coalesce(atr, first_value(atr IGNORE NULLS) OVER ({PI} ROWS BETWEEN CURRENT ROW AND "
        f"UNBOUNDED FOLLOWING), last_value(atr IGNORE NULLS) OVER ({PI} ROWS BETWEEN UNBOUNDED PRECEDING AND "
        f"CURRENT ROW)) AS atr_filled, ema_fast - lag(ema_fast, 3) OVER ({PI}) AS slope FROM f)",
        *zigzag_ctes(rs.zz_atr_mult),
        "r0 AS (SELECT zin.*, zz.d AS zz_dir, zz.imp_lo, zz.imp_hi, nullif(zz.imp_hi - zz.imp_lo, 0.0) AS rng "
        "FROM zin JOIN zz ON zz.symbol = zin.symbol "
        "AND zz.dt = zin.dt AND zz.idx = zin.idx)",
        f"r1 AS (SELECT *, least(imp_lo + {float(rs.retr_low)!r} * rng, imp_lo + {float(rs.retr_high)!r} * rng) "
        f"- abs(rng) * {pad!r} AS zone_lo, greatest(imp_lo + {float(rs.retr_low)!r} * rng, imp_lo + "
        f"{float(rs.retr_high)!r} * rng) + abs(rng) * {pad!r} AS zone_hi FROM r0)",
        "r2 AS (SELECT *, coalesce(low <= zone_hi AND high >= zone_lo, false) AS in_zone FROM r1)",
        f"r3 AS (SELECT *, in_zone AND NOT coalesce(lag(in_zone) OVER ({PI}), false) AS fresh FROM r2)",
        f"sg AS (SELECT *, CASE WHEN coalesce(zz_dir = 'up' AND fresh AND {up} AND rsi >= {rs.rsi_long}, false) "
        f"THEN 1 WHEN coalesce(zz_dir = 'down' AND fresh AND {dn} AND rsi <= {rs.rsi_short}, false) THEN -1 "
        "ELSE 0 END AS sig FROM r3)",
        f"pl0 AS (SELECT *, lead(idx) OVER ({PI}) IS NOT NULL AS has_next, lead(ts) OVER ({PI}) AS e_ts, "
        f"lead(open) OVER ({PI}) AS e_open, coalesce(lead(atr) OVER ({PI}), 0.0) AS e_atr, "
        f"lead(imp_lo) OVER ({PI}) AS e_lo, lead(imp_hi) OVER ({PI}) AS e_hi FROM sg)",
        f"pl1 AS (SELECT *, CASE WHEN sig = 1 THEN e_lo - {m!r} * e_atr WHEN sig = -1 THEN e_hi + {m!r} * e_atr END "
        "AS stop FROM pl0)",
        "pl2 AS (SELECT *, abs(e_open - stop) AS R FROM pl1)",
    ]
    e127 = "CASE WHEN sig = 1 THEN e_hi + 0.272 * (e_hi - e_lo) ELSE e_lo - 0.272 * (e_hi - e_lo) END"
    e161 = "CASE WHEN sig = 1 THEN e_hi + 0.618 * (e_hi - e_lo) ELSE e_lo - 0.618 * (e_hi - e_lo) END"
    ext = {"127": e127, "161": e161}
    p1, p2 = rs.ext_pref
    c.append(f"pl AS (SELECT *, coalesce(R > 0 AND e_lo IS NOT NULL AND e_hi IS NOT NULL AND e_lo <> e_hi, false) "
             f"AS valid, e_open + sig * R AS tp1, {ext[p1]} AS ext1, {ext[p2]} AS ext2, '{p1}' AS n1, '{p2}' AS n2 "
             "FROM pl2)")
    return c


def replace_kind(rs: RuleSet, kind: str) -> RuleSet:
    from dataclasses import replace
    return replace(rs, kind=kind)


def rolling_trades_sql(rs: RuleSet) -> str:
    ctes = rolling_ctes(rs) + trades_cte(True)
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in TRADE_DOUBLES else c for c in TRADE_COLS)
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"\nSELECT {sel} FROM trades"
