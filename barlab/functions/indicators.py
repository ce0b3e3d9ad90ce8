"""Technical indicators as window expressions over one series.

A series is the ts-ordered rows of one partition key (default one session,
``symbol, dt``).  All windows here share one ``partitionBy/orderBy``, so a
chain of indicators costs one exchange and one sort, and smoothing one sort more.

Exponential smoothing (recursive, seeded with the first value) has no built-in
window function.  A row takes the value ``y`` before it to ``a*y + b`` with
``a = q**g / (q**g + alpha)`` and ``b = alpha*x / (q**g + alpha)`` after a gap of
``g`` rows (``q = 1 - alpha``); a NULL row leaves it as it is.  Such maps are
composed to maps of the same kind, so

* inside a block of up to ``BLOCK_ROWS`` rows the composition is a running sum,
  ``y_i = sum_{k<=i} b_k * exp(L_k - L_i)`` with ``L`` the sum of ``-ln a`` from the
  block's start: few enough rows that exponents stay in double range;
* the maps of the blocks before, one each, are folded to the value that a block
  starts from;
* in a series of many chunks (:func:`smooth_unbroken`) each chunk is smoothed on
  its own, its one map goes to a table of a row per chunk, and the value carried
  into a chunk is added with the weight that the chunk's maps leave it.

Series of any length and any gaps are fine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlab import SESSION_KEYS

UNB = Window.unboundedPreceding
UNF = Window.unboundedFollowing
CUR = Window.currentRow


def series_window(keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(UNB, CUR)


def whole(keys: Sequence[str] = SESSION_KEYS) -> WindowSpec:
    return Window.partitionBy(*keys)


#: Rows of a block at most; fewer where a block's decay could leave double range.
BLOCK_ROWS = 512
_RANGE = 350.0  # of -ln a over the rows of a block
_FORGOTTEN = 300.0  # a gap from before the block counts at most so much: exp(-300) is below double precision


def with_index(df: DataFrame, keys: Sequence[str] = SESSION_KEYS, order: str = "ts",
               name: str = "idx") -> DataFrame:
    """0-based position of each row in its series (``reset_index`` equivalent)."""
    return df.withColumn(name, (F.row_number().over(series_window(keys, order)) - 1).cast("int"))


@dataclass(frozen=True)
class Smoothing:
    """``out``: smoothing of column ``src`` with ``alpha``.  ``gaps`` may name a
    column that is known exactly where ``src`` is (its gaps are then shared)."""

    src: str
    out: str
    alpha: float
    gaps: str | None = None


def _block_rows(specs: Sequence[Smoothing]) -> int:
    """A power of two; a row's ``-ln a`` is at most ``-ln q + ln 2`` per row of its gap."""
    most = max([-math.log(1.0 - s.alpha) for s in specs if s.alpha < 1.0], default=0.0) + math.log(2.0)
    return 1 << max(0, min(BLOCK_ROWS.bit_length() - 1, int(math.log2(_RANGE / most))))


def _q(*names: str) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _known(c: str) -> str:
    return f"(`{c}` IS NOT NULL AND NOT isnan(`{c}`))"


@dataclass(frozen=True)
class _Smoothed:
    """What one call has added: ``gap`` and ``weight`` columns by source and by
    (source, alpha); ``weight`` is what the value before the series' first input
    would still weigh."""

    df: DataFrame
    gap: dict[str, str]
    weight: dict[tuple[str, float], str]
    added: list[str]


def _smoothed(df: DataFrame, specs: Sequence[Smoothing], keys: Sequence[str], order: str, idx: str) -> _Smoothed:
    """One projection per stage, written as SQL text: a plan of many columns is
    built in a fraction of the time that as many Column objects take."""
    rows = _block_rows(specs)
    block = f"__block{rows}"
    if block not in df.columns:  # kept for a second call, which then needs no further sort
        df = df.selectExpr("*", f"`{idx}` div {rows} AS {block}")
    before = f"OVER (PARTITION BY {_q(*keys)} ORDER BY {_q(block, order)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    upto = before.replace("1 PRECEDING)", "CURRENT ROW)")
    # the same order: no sort of its own
    inside = f"OVER (PARTITION BY {_q(*keys, block)} ORDER BY {_q(order)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    curved = [s for s in specs if s.alpha < 1.0]
    source = {s: s.gaps or s.src for s in specs}
    gap = {c: f"__gap{k}" for k, c in enumerate(dict.fromkeys(source.values()))}
    decay = {d: f"__dec{k}" for k, d in enumerate(dict.fromkeys((source[s], s.alpha) for s in curved))}
    term = {s: f"__b{k}" for k, s in enumerate(curved)}
    log_q = {s: f"{math.log(1.0 - s.alpha)!r}D" for s in curved}
    mass = {s: f"(exp({gap[source[s]]} * {log_q[s]}) + {s.alpha!r}D)" for s in curved}  # q**g + alpha
    of = {s: decay[source[s], s.alpha] for s in curved}
    started = {s: f"({_known(s.src)} OR {gap[source[s]]} IS NOT NULL)" for s in specs}

    df = df.selectExpr("*", *[f"`{idx}` - last(CASE WHEN {_known(c)} THEN `{idx}` END, true) {before} AS {g}" for c, g in gap.items()])
    out = {s: f"last(CASE WHEN {_known(s.src)} THEN CAST(`{s.src}` AS DOUBLE) END, true) {upto}" for s in specs if s not in term}
    if curved:
        steps = {of[s]: f"CASE WHEN {_known(source[s])} AND {gap[source[s]]} IS NOT NULL THEN "
                        f"least(ln({mass[s]}) - {gap[source[s]]} * {log_q[s]}, {_FORGOTTEN!r}D) END" for s in curved}
        df = df.selectExpr(
            "*", *[f"coalesce(sum({step}) {inside}, 0D) AS {d}" for d, step in steps.items()],
            *[f"CASE WHEN {_known(s.src)} THEN CASE WHEN {gap[source[s]]} IS NULL THEN CAST(`{s.src}` AS DOUBLE) "
              f"ELSE {s.alpha!r}D * `{s.src}` / {mass[s]} END END AS {t}" for s, t in term.items()])
        kept = [c for c in df.columns if c not in (*decay.values(), *term.values())]
        df = df.selectExpr(*[f"`{c}`" for c in kept],
                           *[f"exp(-{of[s]}) * coalesce(sum({t} * exp({of[s]})) {inside}, 0D) AS {t}" for s, t in term.items()],
                           *[f"exp(-{d}) AS {d}" for d in decay.values()])
        ends = ", ".join([*decay.values(), *term.values()])
        df = df.selectExpr("*", f"collect_list(CASE WHEN `{idx}` % {rows} = {rows - 1} THEN struct({ends}) END) {before} AS __ends")
        start = ", ".join([*[f"'{d}', 1D" for d in decay.values()], *[f"'{t}', 0D" for t in term.values()]])
        moved = ", ".join([*[f"'{d}', y.{d} * e.{d}" for d in decay.values()],
                           *[f"'{t}', e.{of[s]} * y.{t} + e.{t}" for s, t in term.items()]])
        df = df.selectExpr("*", f"aggregate(__ends, named_struct({start}), (y, e) -> named_struct({moved})) AS __from")
        out |= {s: f"CASE WHEN {started[s]} THEN {t} + {of[s]} * __from.{t} END" for s, t in term.items()}
    weight = {d: f"__weight{k}" for k, d in enumerate(decay)}
    outs = {s.out for s in specs}
    kept = [c for c in df.columns if c not in (*decay.values(), *term.values(), "__ends", "__from") and c not in outs]
    df = df.selectExpr(*[f"`{c}`" for c in kept], *[f"{out[s]} AS `{s.out}`" for s in specs],
                       *[f"{decay[d]} * __from.{decay[d]} AS {name}" for d, name in weight.items()])
    return _Smoothed(df, gap, weight, [*gap.values(), *weight.values(), block])


def smooth_all(df: DataFrame, specs: Sequence[Smoothing], *, keys: Sequence[str] = SESSION_KEYS, order: str = "ts",
               idx: str = "idx", keep_block: bool = False) -> DataFrame:
    """Adds all smoothings in a few shared stages; needs ``idx`` from
    :func:`with_index`.  NULL and NaN inputs carry the last value on, rows before
    the first input are NULL.  Every stage is partitioned by ``keys`` and sorted by
    block and ``order``: one sort for all of them, no exchange.  With ``keep_block``
    the block column stays, and a further call on the result sorts nothing."""
    got = _smoothed(df, specs, keys, order, idx)
    made = got.added[:-1] if keep_block else got.added
    return got.df.drop(*made)


def smooth_unbroken(df: DataFrame, specs: Sequence[Smoothing], *, keys: Sequence[str] = ("symbol",), chunk: str = "dt",
                    order: str = "ts") -> DataFrame:
    """Smoothings of a series that goes on from chunk to chunk (``chunk`` ascends
    with ``order``); equal to :func:`smooth_all` over the whole series, yet no
    window, group or task holds more than a chunk's rows.

    A chunk is smoothed as if nothing were before it.  What it needs of the past is
    the value carried in and the rows since the last input, and what it hands on is
    one map: its first input and place, its last value, the weight that its first
    value still has in it, and the rows since its last input.  These rows, one a
    chunk, are folded in order per series; the difference that the carried value
    makes to a chunk's first value is added with its weight at each row."""
    of_chunk = [*keys, chunk]
    named = [s.out for s in specs]
    specs = [replace(s, out=f"__out{k}") for k, s in enumerate(specs)]  # inputs must stay as they are
    got = _smoothed(with_index(df, of_chunk, order, "__idx"), specs, of_chunk, order, "__idx")
    local = got.df
    source = {s: s.gaps or s.src for s in specs}
    known = {c: f"k{k}" for k, c in enumerate(got.gap)}
    value = {s: f"s{k}" for k, s in enumerate(specs)}
    weight = {s: got.weight[source[s], s.alpha] if s.alpha < 1.0 else "0D" for s in specs}
    ends = ["count(1) AS n"]
    for c, k in known.items():
        ends += [f"min(CASE WHEN {_known(c)} THEN __idx END) AS {k}_first", f"max(CASE WHEN {_known(c)} THEN __idx END) AS {k}_last"]
    for s, v in value.items():
        ends += [f"min(CASE WHEN {_known(s.src)} THEN struct(__idx, CAST(`{s.src}` AS DOUBLE) AS x) END).x AS {v}_x",
                 f"max_by({s.out}, __idx) AS {v}_y", f"max_by({weight[s]}, __idx) AS {v}_w"]
    maps = local.groupBy(*of_chunk).agg(*map(F.expr, ends))

    told = ", ".join(f"{v}_{p}:double" for v in value.values() for p in ("y", "d"))
    kind = f"array<struct<chunk:{df.schema[chunk].dataType.simpleString()}, {told}>>"
    start = ", ".join([f"'out', CAST(array() AS {kind})", *[f"'{k}_since', 0L" for k in known.values()],
                       *[f"'{v}', CAST(NULL AS DOUBLE)" for v in value.values()]])
    change = {}
    for s, v in value.items():
        k = known[source[s]]
        if s.alpha < 1.0:
            q_gap = f"exp((y.{k}_since + m.{k}_first + 1) * {math.log(1.0 - s.alpha)!r}D)"
            change[v] = f"coalesce({q_gap} * (y.{v} - m.{v}_x) / ({q_gap} + {s.alpha!r}D), 0D)"
        else:
            change[v] = "0D"
    row = ", ".join([f"'chunk', m.`{chunk}`", *[f"'{v}_y', y.{v}, '{v}_d', {change[v]}" for v in value.values()]])
    moved = ", ".join([
        f"'out', concat(y.out, CAST(array(named_struct({row})) AS {kind}))",
        *[f"'{k}_since', CASE WHEN m.{k}_first IS NULL THEN y.{k}_since + m.n ELSE m.n - 1 - m.{k}_last END" for k in known.values()],
        *[f"'{v}', CASE WHEN m.{known[source[s]]}_first IS NULL THEN y.{v} ELSE m.{v}_y + m.{v}_w * {change[v]} END" for s, v in value.items()]])
    parts = _q(chunk, *[c for c in maps.columns if c not in of_chunk])
    folded = (maps.groupBy(*keys).agg(F.expr(f"sort_array(collect_list(struct({parts})))").alias("maps"))
              .selectExpr(*[f"`{c}` AS __key{k}" for k, c in enumerate(keys)],
                          f"explode(aggregate(maps, named_struct({start}), (y, m) -> named_struct({moved}), y -> y.out)) AS __in"))
    same = F.col("__in.chunk").eqNullSafe(F.col(chunk))
    for k, c in enumerate(keys):
        same &= F.col(f"__key{k}").eqNullSafe(F.col(c))
    both = local.join(folded, same)
    out = [f"coalesce({s.out} + {weight[s]} * __in.{v}_d, __in.{v}_y) AS `{name}`" for (s, v), name in zip(value.items(), named)]
    return both.selectExpr(*[f"`{c}`" for c in df.columns if c not in named], *out)


def smooth(df: DataFrame, src: str, out: str, alpha: float, **kw) -> DataFrame:
    """Exponential smoothing of ``src``; requires ``idx`` from :func:`with_index`."""
    return smooth_all(df, [Smoothing(src, out, alpha)], **kw)


def ema(df: DataFrame, src: str, span: int, out: str | None = None, **kw) -> DataFrame:
    """EMA with ``alpha = 2/(span+1)``."""
    return smooth(df, src, out or f"ema_{span}", 2.0 / (span + 1.0), **kw)


def emas(df: DataFrame, src: str, spans: Sequence[int], names: Sequence[str] | None = None, **kw) -> DataFrame:
    """Several EMAs of one column in a single projection."""
    names = names or [f"ema_{n}" for n in spans]
    return smooth_all(df, [Smoothing(src, nm, 2.0 / (n + 1.0)) for nm, n in zip(names, spans)], **kw)


def wilder(df: DataFrame, src: str, n: int, out: str, **kw) -> DataFrame:
    """Wilder smoothing, ``alpha = 1/n``."""
    return smooth(df, src, out, 1.0 / n, **kw)


def sma(df: DataFrame, src: str, n: int, out: str | None = None, *,
        keys: Sequence[str] = SESSION_KEYS, order: str = "ts", min_periods: int = 1) -> DataFrame:
    """Rolling mean over the last ``n`` rows (W1); NULL until ``min_periods`` rows."""
    w = series_window(keys, order).rowsBetween(-(n - 1), CUR)
    m = F.avg(src).over(w)
    if min_periods > 1:
        m = F.when(F.count(src).over(w) >= min_periods, m)
    return df.withColumn(out or f"sma_{n}", m)


def bollinger(df: DataFrame, src: str = "close", n: int = 20, k: float = 2.0, *,
              ddof: int = 0, min_periods: int | None = None, prefix: str = "bb",
              keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> DataFrame:
    """Bollinger bands (W4: ddof=0, full windows; W5: ddof=1, min_periods=1)."""
    min_periods = n if min_periods is None else min_periods
    w = series_window(keys, order).rowsBetween(-(n - 1), CUR)
    ok = F.count(src).over(w) >= min_periods
    sd = (F.stddev_pop if ddof == 0 else F.stddev_samp)(src).over(w)
    mid = F.avg(src).over(w)
    return df.withColumns({f"{prefix}_mid": F.when(ok, mid),
                           f"{prefix}_upper": F.when(ok, mid + F.lit(k) * sd),
                           f"{prefix}_lower": F.when(ok, mid - F.lit(k) * sd)})


def diff(df: DataFrame, src: str, out: str, periods: int = 1, *,
         keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> DataFrame:
    return df.withColumn(out, F.col(src) - F.lag(src, periods).over(series_window(keys, order)))


def rsi_inputs(src: str = "close", variant: str = "null", *, keys: Sequence[str] = SESSION_KEYS,
               order: str = "ts") -> tuple[Column, Column]:
    """Per-bar gain and loss of ``src`` (lag inline)."""
    d = F.col(src) - F.lag(src).over(series_window(keys, order))
    if variant == "eps":
        return (F.when(d > 0, d).otherwise(F.lit(0.0)), F.when(d < 0, -d).otherwise(F.lit(0.0)))
    gain, loss = F.greatest(d, F.lit(0.0)), F.greatest(-d, F.lit(0.0))
    return F.when(d.isNotNull(), gain), F.when(d.isNotNull(), loss)  # greatest alone would turn an unknown step into 0


def rsi_smoothings(up: str, dn: str, n: int, out_up: str, out_dn: str) -> list[Smoothing]:
    return [Smoothing(up, out_up, 1.0 / n), Smoothing(dn, out_dn, 1.0 / n, gaps=up)]


def rsi_of(au: Column, ad: Column, variant: str = "null") -> Column:
    """RSI from the smoothed gain and loss."""
    if variant == "eps":
        return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + au / (ad + F.lit(1e-9)))
    val = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + au / F.nullif(ad, F.lit(0.0)))
    return F.coalesce(val, F.lit(50.0)) if variant == "fill50" else val


def rsi(df: DataFrame, src: str = "close", n: int = 14, out: str | None = None, *,
        variant: str = "null", keys: Sequence[str] = SESSION_KEYS, order: str = "ts",
        idx: str = "idx") -> DataFrame:
    """Wilder RSI in the three forms found in the reference.

    * ``"null"`` (W7): gains/losses from the diff (row 0 NULL), smoothing seeded
      at row 1; zero average loss gives NULL.
    * ``"fill50"`` (W6): as ``null`` but every NULL becomes 50.
    * ``"eps"`` (W8): row-0 gain = loss = 0 (seed at row 0); ``rs = up/(dn+1e-9)``.
    """
    out = out or f"rsi_{n}"
    up, dn = rsi_inputs(src, variant, keys=keys, order=order)
    tu, td = f"_{out}_up", f"_{out}_dn"
    df = smooth_all(df.withColumns({tu: up, td: dn}), rsi_smoothings(tu, td, n, tu, td), keys=keys, order=order, idx=idx)
    return df.withColumn(out, rsi_of(F.col(tu), F.col(td), variant)).drop(tu, td)


def true_range_expr(*, keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> Column:
    """max(|h-l|, |h-pc|, |l-pc|); a NULL previous close is skipped."""
    pc = F.lag("close").over(series_window(keys, order))
    h, l = F.col("high"), F.col("low")
    return F.greatest(F.abs(h - l), F.abs(h - pc), F.abs(l - pc))


def true_range(df: DataFrame, out: str = "tr", *, keys: Sequence[str] = SESSION_KEYS,
               order: str = "ts") -> DataFrame:
    return df.withColumn(out, true_range_expr(keys=keys, order=order))


def atr(df: DataFrame, n: int = 14, out: str | None = None, **kw) -> DataFrame:
    """Wilder ATR seeded with the first true range."""
    out = out or f"atr_{n}"
    tr = f"_{out}_tr"
    wkw = {k: v for k, v in kw.items() if k in ("keys", "order")}
    return smooth(df.withColumn(tr, true_range_expr(**wkw)), tr, out, 1.0 / n, **kw).drop(tr)


def macd(df: DataFrame, src: str = "close", fast: int = 12, slow: int = 26, signal: int = 9,
         **kw) -> DataFrame:
    """MACD line, signal (EMA of the line) and histogram."""
    df = emas(df, src, [fast, slow], ["_macd_fast", "_macd_slow"], keep_block=True, **kw)
    df = df.withColumn("macd", F.col("_macd_fast") - F.col("_macd_slow")).drop("_macd_fast", "_macd_slow")
    df = ema(df, "macd", signal, "macd_signal", keep_block=True, **kw)  # its blocks may be those of the line: no further sort
    df = df.drop(*[c for c in df.columns if c.startswith("__block")])
    return df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def study(df: DataFrame, src: str = "close", *, emas: Sequence[int] = (9, 21), rsi: int | None = 14, variant: str = "null",
          atr: int | None = 14, macd: tuple[int, int, int] | None = (12, 26, 9), bands: tuple[int, float] | None = (20, 2.0),
          keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> DataFrame:
    """All indicators of a chart at once: ``idx, ema_<n>, rsi_<n>, atr_<n>, macd,
    macd_signal, macd_hist, bb_mid, bb_upper, bb_lower``.  Inputs and bands share one
    sort, all smoothings a second one, whatever their number."""
    w = series_window(keys, order)
    first = {"idx": (F.row_number().over(w) - 1).cast("int")}
    if bands:
        n, k = bands
        last = w.rowsBetween(1 - n, CUR)
        full = F.count(src).over(last) >= n
        mid, wide = F.avg(src).over(last), F.lit(k) * F.stddev_pop(src).over(last)
        first |= {"bb_mid": F.when(full, mid), "bb_upper": F.when(full, mid + wide), "bb_lower": F.when(full, mid - wide)}
    specs = [Smoothing(src, f"ema_{n}", 2.0 / (n + 1.0)) for n in emas]
    if rsi:
        first["__up"], first["__dn"] = rsi_inputs(src, variant, keys=keys, order=order)
        specs += rsi_smoothings("__up", "__dn", rsi, "__up", "__dn")
    if atr:
        first["__tr"] = true_range_expr(keys=keys, order=order)
        specs.append(Smoothing("__tr", f"atr_{atr}", 1.0 / atr))
    if macd:
        specs += [Smoothing(src, name, 2.0 / (n + 1.0)) for name, n in zip(("__fast", "__slow"), macd)]
    df = smooth_all(df.withColumns(first), specs, keys=keys, order=order, keep_block=True)
    if macd:
        df = df.withColumn("macd", F.col("__fast") - F.col("__slow"))
        df = smooth_all(df, [Smoothing("macd", "macd_signal", 2.0 / (macd[2] + 1.0))], keys=keys, order=order, keep_block=True)
        df = df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    if rsi:
        df = df.withColumn(f"rsi_{rsi}", rsi_of(F.col("__up"), F.col("__dn"), variant))
    return df.drop("__up", "__dn", "__tr", "__fast", "__slow", *[c for c in df.columns if c.startswith("__block")])


def session_vwap(df: DataFrame, out: str = "vwap_intraday", *,
                 keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> DataFrame:
    """Cumulative typical-price VWAP; zero cumulative volume gives NULL."""
    w = running(series_window(keys, order))
    typical = (F.col("high") + F.col("low") + F.col("close")) / F.lit(3.0)
    return df.withColumn(out, F.sum(typical * F.col("volume")).over(w)
                         / F.nullif(F.sum("volume").over(w), F.lit(0.0)))


def pct_return(df: DataFrame, src: str = "close", out: str = "return_1m", *,
               keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> DataFrame:
    """One-bar simple return ``x/prev - 1``; first row of each series NULL.
    A zero previous value gives NULL (not an ANSI error, not infinity)."""
    return df.withColumn(out, F.try_divide(F.col(src), F.lag(src).over(series_window(keys, order))) - F.lit(1.0))


def fill_back_then_forward(df: DataFrame, src: str, out: str | None = None, *,
                           keys: Sequence[str] = SESSION_KEYS, order: str = "ts") -> DataFrame:
    """``bfill`` then ``ffill`` within the series."""
    w = series_window(keys, order)
    nxt = F.first(src, ignorenulls=True).over(w.rowsBetween(CUR, UNF))
    prv = F.last(src, ignorenulls=True).over(w.rowsBetween(UNB, CUR))
    return df.withColumn(out or src, F.coalesce(F.col(src), nxt, prv))


def fill_median(df: DataFrame, src: str, out: str | None = None, *,
                keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """NULLs replaced by the series median."""
    med = F.percentile(F.col(src), F.lit(0.5)).over(whole(keys))
    return df.withColumn(out or src, F.coalesce(F.col(src), med))


def drawdown_cols(df: DataFrame, src: str, *, keys: Sequence[str], order: Sequence[str] | str,
                  prefix: str = "", from_zero: bool = False) -> DataFrame:
    """Running sum (equity), running peak and drawdown ``eq - peak`` (W13/W14);
    the peak starts at the first row's equity, or at 0 with ``from_zero``."""
    w = running(Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order)))
    df = df.withColumn(f"{prefix}equity", F.sum(src).over(w))
    peak = F.max(f"{prefix}equity").over(w)
    peak = F.greatest(peak, F.lit(0.0)) if from_zero else peak
    return df.withColumns({f"{prefix}peak": peak, f"{prefix}dd": F.col(f"{prefix}equity") - peak})
