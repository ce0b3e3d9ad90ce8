"""The last ZigZag leg of an unbroken series, chunk by chunk.

A path turns where it has come back from its running extreme by the threshold that
the extreme's bar has set.  What a chunk makes of the path it is given depends on
the direction, extreme and threshold that come in, but only until its first event:
the first bar that carries the extreme on or turns the path is always one of the
chunk's own running highs or lows, and from such a bar on nothing before it
matters.  So each chunk is walked once for all its running highs and lows at the
same time, paths that meet going on as one, which gives where each ends; a fold over
one row per chunk then picks the first event of each chunk and hands the end on.

With the entry of each chunk known, its turns are found in it, its bars fall into
runs between turns, and a second fold over chunk rows carries what a leg needs of
the past: the low and high since the last swing, its close, and the finished leg.
All of it is JVM expressions on arrays of one chunk's bars.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.operators.order_stats import written

_PATH = "struct<way:int,ref:double,back:double,at:int,ids:array<int>>"
_ENTRY = "struct<chunk:{0},way:int,ref:double,back:double,from:int>"
_PAST = "struct<chunk:{0},lo:double,hi:double,close:double,leg_lo:double,leg_hi:double,leg_way:int,bars:bigint>"


def _let(value: str, name: str, then: str) -> str:
    """``then`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {then})[0]"


def _ends(bars: str, mult: float) -> str:
    """``named_struct(hi, lo, paths)`` of a chunk: its running highs and lows and,
    for each of them as the start of an up (id ``2 * at``) or down path (odd id),
    how the path stands at the chunk's end."""
    # a path's move at bar x: 1 / -1 when x is its new extreme or a turn to that side, else 0
    move = ("CASE WHEN g.way * (x.close - g.ref) >= 0 THEN g.way WHEN g.way * (g.ref - x.close) >= g.back THEN -g.way ELSE 0 END")
    paths = f"transform(y.paths, g -> named_struct('g', g, 'm', {move}))"
    ids = "flatten(transform(filter(p, s -> s.m = {0}), s -> s.g.ids))"
    new = ("CASE WHEN size({1}) > 0 THEN array(named_struct('way', {0}, 'ref', x.close, 'back', x.back, 'at', x.i, 'ids', {1})) "
           f"ELSE CAST(array() AS array<{_PATH}>) END")
    up = f"concat({ids.format(1)}, CASE WHEN f.hi THEN array(2 * x.i) ELSE CAST(array() AS array<int>) END)"
    down = f"concat({ids.format(-1)}, CASE WHEN f.lo THEN array(2 * x.i + 1) ELSE CAST(array() AS array<int>) END)"
    after = f"concat(transform(filter(p, s -> s.m = 0), s -> s.g), {_let(up, 'u', new.format(1, 'u'))}, {_let(down, 'u', new.format(-1, 'u'))})"
    grown = "CASE WHEN f.{0} THEN concat(y.{0}, array(named_struct('at', x.i, 'close', x.close))) ELSE y.{0} END"
    step = (f"named_struct('top', greatest(y.top, x.close), 'bottom', least(y.bottom, x.close), 'hi', {grown.format('hi')}, "
            f"'lo', {grown.format('lo')}, 'paths', CAST({_let(paths, 'p', after)} AS array<{_PATH}>))")
    # the series' second bar may turn without being a high or low of its own, when the first one's threshold is 0
    first = "named_struct('hi', y.top IS NULL OR x.close > y.top OR x.i = 1, 'lo', y.bottom IS NULL OR x.close < y.bottom OR x.i = 1)"
    record = "CAST(array() AS array<struct<at:int,close:double>>)"
    start = (f"named_struct('top', CAST(NULL AS DOUBLE), 'bottom', CAST(NULL AS DOUBLE), 'hi', {record}, 'lo', {record}, "
             f"'paths', CAST(array() AS array<{_PATH}>))")
    thin = f"transform({bars}, b -> named_struct('i', b.__i, 'close', CAST(b.close AS DOUBLE), 'back', {mult!r}D * b.__atr))"
    return f"aggregate({thin}, {start}, (y, x) -> {_let(first, 'f', step)}, y -> named_struct('hi', y.hi, 'lo', y.lo, 'paths', y.paths))"


def _entries(kind: str) -> str:
    """Per chunk of ``chunks`` (``chunk, hi, lo, paths, close, back`` of its first
    bar), in order, the path that comes in; ``from`` is 1 for the series' own first
    bar, which is no event."""
    entry = ("CASE WHEN y.way IS NULL THEN named_struct('way', 0, 'ref', m.close, 'back', m.back, 'from', 1) "
             "ELSE named_struct('way', y.way, 'ref', y.ref, 'back', y.back, 'from', 0) END")
    rises = "((e.way = 1 AND r.close >= e.ref) OR (e.way <= 0 AND r.close > e.ref AND r.close - e.ref >= e.back))"
    falls = ("((e.way = -1 AND r.close <= e.ref) OR (e.way = 0 AND r.close <= e.ref AND e.ref - r.close >= e.back) "
             "OR (e.way = 1 AND r.close < e.ref AND e.ref - r.close >= e.back))")
    at = "array_min(transform(filter(m.{0}, r -> r.at >= e.from AND {1}), r -> r.at))"
    events = f"named_struct('up', {at.format('hi', rises)}, 'down', {at.format('lo', falls)})"
    which = "CASE WHEN v.up IS NOT NULL AND (v.down IS NULL OR v.up < v.down) THEN 2 * v.up ELSE 2 * v.down + 1 END"
    path = _let(events, "v", _let(which, "id", "filter(m.paths, g -> array_contains(g.ids, id))"))
    told = f"named_struct('chunk', m.chunk, 'way', e.way, 'ref', e.ref, 'back', e.back, 'from', e.from)"
    stands = ("coalesce(try_element_at(p, 1), named_struct('way', e.way, 'ref', e.ref, 'back', e.back, 'at', -1, 'ids', CAST(array() AS array<int>)))")
    moved = _let(stands, "g", f"named_struct('way', g.way, 'ref', g.ref, 'back', g.back, 'out', concat(y.out, array(CAST({told} AS {kind}))))")
    start = f"named_struct('way', CAST(NULL AS INT), 'ref', CAST(NULL AS DOUBLE), 'back', CAST(NULL AS DOUBLE), 'out', CAST(array() AS array<{kind}>))"
    return f"aggregate(chunks, {start}, (y, m) -> {_let(entry, 'e', _let(path, 'p', moved))}, y -> y.out)"


def _turns(bars: str, mult: float) -> str:
    """Places of the bars of a chunk at which the path that came in (``entry``) turns."""
    ahead = "y.way * (x.close - y.ref) >= 0"
    kind = (f"CASE WHEN x.i < entry.from THEN 0 WHEN y.way = 0 THEN CASE WHEN abs(x.close - y.ref) >= y.back THEN 2 ELSE 0 END "
            f"WHEN {ahead} THEN 1 WHEN y.way * (y.ref - x.close) >= y.back THEN 2 ELSE 0 END")  # 1: new extreme, 2: turn
    way = "CASE WHEN k < 2 THEN y.way WHEN y.way <> 0 THEN -y.way WHEN x.close > y.ref THEN 1 ELSE -1 END"
    step = (f"named_struct('way', {way}, 'ref', CASE WHEN k > 0 THEN x.close ELSE y.ref END, 'back', CASE WHEN k > 0 THEN x.back ELSE y.back END, "
            "'turns', CASE WHEN k = 2 THEN concat(y.turns, array(x.i)) ELSE y.turns END)")
    start = "named_struct('way', entry.way, 'ref', entry.ref, 'back', entry.back, 'turns', CAST(array() AS array<int>))"
    thin = f"transform({bars}, b -> named_struct('i', b.__i, 'close', CAST(b.close AS DOUBLE), 'back', {mult!r}D * b.__atr))"
    return f"aggregate({thin}, {start}, (y, x) -> {_let(kind, 'k', step)}, y -> y.turns)"


#: Runs of a chunk: before its first turn (maybe no bar), and from each turn on; with the turn's own close, low and high.
_RUNS = ("transform(sequence(0, size(turns)), q -> "
         + _let("named_struct('a', CASE WHEN q = 0 THEN 0 ELSE turns[q - 1] END, 'b', CASE WHEN q = size(turns) THEN size(bars) ELSE turns[q] END)", "s",
                _let("slice(bars, s.a + 1, s.b - s.a)", "part",
                     "named_struct('lo', array_min(transform(part, x -> CAST(x.low AS DOUBLE))), 'hi', array_max(transform(part, x -> CAST(x.high AS DOUBLE))), "
                     "'close', CAST(bars[s.a].close AS DOUBLE), 'low', CAST(bars[s.a].low AS DOUBLE), 'high', CAST(bars[s.a].high AS DOUBLE))")) + ")")

#: The leg that each turn of a chunk finishes: from the swing before to the turn, both included.
_LEGS = ("transform(sequence(1, {0}size(runs)), k -> CASE WHEN k < size(runs) THEN named_struct("
         "'lo', least(runs[k].low, runs[k - 1].lo, CASE WHEN k = 1 THEN past.lo END), "
         "'hi', greatest(runs[k].high, runs[k - 1].hi, CASE WHEN k = 1 THEN past.hi END), "
         "'way', CASE WHEN runs[k].close >= (CASE WHEN k = 1 THEN coalesce(past.close, runs[0].close) ELSE runs[k - 1].close END) THEN 1 ELSE -1 END) END)")


def _pasts(kind: str) -> str:
    """Per chunk of ``chunks`` (``chunk, runs, n``), in order, what it needs of the past."""
    legs = _LEGS.format("").replace("runs", "m.runs").replace("past.", "y.")
    last = "m.runs[size(m.runs) - 1]"
    none = "size(m.runs) = 1"
    leg = "l[size(m.runs) - 2]"
    told = ("named_struct('chunk', m.chunk, 'lo', y.lo, 'hi', y.hi, 'close', y.close, 'leg_lo', y.leg_lo, 'leg_hi', y.leg_hi, "
            "'leg_way', y.leg_way, 'bars', y.bars)")
    moved = (f"named_struct('lo', CASE WHEN {none} THEN least(y.lo, {last}.lo) ELSE {last}.lo END, "
             f"'hi', CASE WHEN {none} THEN greatest(y.hi, {last}.hi) ELSE {last}.hi END, "
             f"'close', CASE WHEN {none} THEN coalesce(y.close, {last}.close) ELSE {last}.close END, "
             f"'leg_lo', CASE WHEN {none} THEN y.leg_lo ELSE {leg}.lo END, 'leg_hi', CASE WHEN {none} THEN y.leg_hi ELSE {leg}.hi END, "
             f"'leg_way', CASE WHEN {none} THEN y.leg_way ELSE {leg}.way END, 'bars', y.bars + m.n, "
             f"'out', concat(y.out, array(CAST({told} AS {kind}))))")
    start = ", ".join([*[f"'{c}', CAST(NULL AS DOUBLE)" for c in ("lo", "hi", "close", "leg_lo", "leg_hi")],
                       "'leg_way', 0, 'bars', 0L", f"'out', CAST(array() AS array<{kind}>)"])
    return f"aggregate(chunks, named_struct({start}), (y, m) -> {_let(legs, 'l', moved)}, y -> y.out)"


def last_leg(df: DataFrame, mult: float, atr: str = "atr", *, keys: Sequence[str] = ("symbol",), chunk: str = "dt",
             order: str = "ts", min_bars: int = 5) -> DataFrame:
    """Adds ``leg_way`` (1 up, -1 down, 0 none), ``leg_low``, ``leg_high``: the last
    finished leg as of each bar of the unbroken series.  The leg spans the last two
    swings, the series' first bar being one; none before the second swing, among the
    first ``min_bars - 1`` bars, or for a flat leg.  ``close``, ``high``, ``low`` must be
    known; an unknown ATR sets no threshold."""
    of_chunk = [*keys, chunk]
    others = [c for c in df.columns if c not in of_chunk]
    day = df.schema[chunk].dataType.simpleString()
    quoted = ", ".join(f"`{c}`" for c in others)
    bars = df.groupBy(*of_chunk).agg(F.expr(f"sort_array(collect_list(struct(`{order}` AS __o, {quoted}, CAST(`{atr}` AS DOUBLE) AS __atr)))").alias("bars"))
    bars = bars.selectExpr(*[f"`{c}`" for c in of_chunk], "transform(bars, (b, i) -> named_struct('__i', i, '__atr', "
                           "CASE WHEN NOT isnan(b.__atr) THEN b.__atr END, " + ", ".join(f"'{c}', b.`{c}`" for c in others) + ")) AS bars")
    bars = written(bars, "leg-chunks")

    def told(rows: DataFrame, columns: str, fold: str, name: str) -> DataFrame:
        """``fold`` over the chunk rows of a series, one row per chunk again, named ``__k_<key>``."""
        folded = (rows.groupBy(*keys).agg(F.expr(f"sort_array(collect_list(struct({columns})), true)").alias("chunks"))
                  .selectExpr(*[f"`{c}` AS `__k_{c}`" for c in keys], f"explode({fold}) AS {name}"))
        return folded

    def joined(rows: DataFrame, facts: DataFrame, name: str) -> DataFrame:
        same = F.col(f"{name}.chunk").eqNullSafe(F.col(chunk))
        for c in keys:
            same &= F.col(f"__k_{c}").eqNullSafe(F.col(c))
        return rows.join(facts, same).drop(*[f"__k_{c}" for c in keys])

    ends = bars.selectExpr(*[f"`{c}`" for c in of_chunk], f"{_ends('bars', mult)} AS ends", "CAST(bars[0].close AS DOUBLE) AS close",
                           f"{mult!r}D * bars[0].__atr AS back")
    entries = told(ends, f"`{chunk}` AS chunk, ends.hi, ends.lo, ends.paths, close, back", _entries(_ENTRY.format(day)), "entry")
    turned = joined(bars, entries, "entry").selectExpr(*[f"`{c}`" for c in of_chunk], "bars", f"{_turns('bars', mult)} AS turns")
    turned = turned.selectExpr("*", f"{_RUNS} AS runs")
    pasts = told(turned, f"`{chunk}` AS chunk, runs, size(bars) AS n", _pasts(_PAST.format(day)), "past")
    found = joined(turned, pasts, "past").selectExpr("*", f"{_LEGS.format('')} AS legs")
    rows = found.selectExpr(*[f"`{c}`" for c in of_chunk], "past", "turns", "legs", "explode(bars) AS b")
    rows = rows.selectExpr(*[f"`{c}`" for c in of_chunk], "b", "past", "legs", "size(filter(turns, t -> t <= b.__i)) AS run")
    leg = {p: f"CASE WHEN run > 0 THEN legs[run - 1].{p} ELSE past.leg_{p} END" for p in ("lo", "hi", "way")}
    rows = rows.selectExpr(*[f"`{c}`" for c in of_chunk], "b", "past.bars + b.__i + 1 AS __n", *[f"{e} AS __{p}" for p, e in leg.items()])
    some = f"(__n >= {min_bars} AND __hi - __lo > 0)"
    return rows.selectExpr(*[f"`{c}`" if c in of_chunk else f"b.`{c}` AS `{c}`" for c in df.columns],
                           f"CASE WHEN {some} THEN __way ELSE 0 END AS leg_way", f"CASE WHEN {some} THEN __lo END AS leg_low",
                           f"CASE WHEN {some} THEN __hi END AS leg_high")
