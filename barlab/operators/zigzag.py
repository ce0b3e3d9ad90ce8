"""Turning points of a price path, found by jumps, and live rules on top.

A path that runs one way only turns where it has come back from its running
extreme by a threshold.  So instead of testing every bar against a state, each
turn is searched for: over a stretch of bars the running extreme is one
``maximum.accumulate``, the threshold in force at each bar is looked up at the
bar that set the extreme, and the first bar beyond it is the turn.  Stretches
double in length until a turn is found, so a path of n bars costs O(n) array
work whatever the number of turns.  Downward runs are upward runs of the
mirrored path.

State between stretches is the extreme and its threshold only, so the same code
goes on where an earlier arrival of bars has ended: batch and streaming share it.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import astuple, dataclass, field

import numpy as np

FIRST_STRETCH = 64


def _stretches(start: int, end: int):
    size = FIRST_STRETCH
    while start < end:
        yield start, min(end, start + size)
        start, size = start + size, 2 * size


# --------------------------------------------------------------------------- rolling impulse
def rolling_zigzag_states(close: np.ndarray, atr: np.ndarray, mult: float):
    """Per bar ``(dir, imp_lo, imp_hi)`` of the rolling impulse.

    The path has no direction until it is ``mult*ATR`` of the bar at hand away
    from the first close.  A run then ends at the first bar that is so far back
    from the run's extreme; that bar's close opens the opposite side of the next
    impulse, the finished extreme stays.  An unknown ATR counts as 0."""
    close = np.asarray(close, float)
    back = mult * np.nan_to_num(np.asarray(atr, float), nan=0.0, posinf=0.0, neginf=0.0)
    n = len(close)
    side = np.zeros(n, int)
    lo, hi = np.empty(n), np.empty(n)
    if not n:
        return [], lo, hi
    away = (close >= close[0] + back) | (close <= close[0] - back)
    at = int(away.argmax()) if away.any() else n
    lo[:at] = hi[:at] = close[0]
    if at < n:
        sign = 1 if close[at] >= close[0] + back[at] else -1
        fixed = close[0]
        while at < n:
            turn, extreme = _run(sign * close, back, at)
            run_lo, run_hi = (fixed, extreme) if sign > 0 else (-extreme, fixed)
            lo[at:turn], hi[at:turn] = run_lo, run_hi
            side[at:turn] = sign
            fixed, at, sign = sign * extreme[-1], turn, -sign
    return [("down", None, "up")[s + 1] for s in side], lo, hi


def _run(path: np.ndarray, back: np.ndarray, at: int) -> tuple[int, np.ndarray]:
    """An upward run that is at bar ``at``: the bar that ends it (or the end of
    the path) and the running extreme of the bars before that."""
    parts, top = [path[at:at + 1]], path[at]
    for a, b in _stretches(at + 1, len(path)):
        tops = np.maximum.accumulate(np.concatenate([[top], path[a:b]]))
        ended = (path[a:b] <= tops[:-1]) & (tops[:-1] - path[a:b] >= back[a:b])
        if ended.any():
            turn = a + int(ended.argmax())
            return turn, np.concatenate([*parts, tops[1:turn - a + 1]])
        parts.append(tops[1:])
        top = tops[-1]
    return len(path), np.concatenate(parts)


# --------------------------------------------------------------------------- last leg
@dataclass
class LegState:
    """Where the path is: bars so far; direction (0: none yet, else 1/-1), running
    extreme and the threshold its bar set; close of the last swing, and the low
    and high since then; the finished leg (NaN before the second swing)."""

    bars: int = 0
    way: int = 0
    extreme: float = math.nan
    back: float = math.nan
    swing_close: float = math.nan
    since_lo: float = math.nan
    since_hi: float = math.nan
    leg_lo: float = math.nan
    leg_hi: float = math.nan
    leg_way: int = 0


def _next_turn(s: LegState, close: np.ndarray, back: np.ndarray, at: int) -> int | None:
    """First swing from bar ``at`` on; moves the extreme and its threshold there."""
    if s.way == 0:
        away = np.abs(close[at:] - s.extreme) >= s.back
        if not away.any():
            return None
        turn = at + int(away.argmax())
        s.way = 1 if close[turn] > s.extreme else -1
    else:
        turn = None
        for a, b in _stretches(at, len(close)):
            path = s.way * close[a:b]
            tops = np.maximum.accumulate(np.concatenate([[s.way * s.extreme], path]))
            sets = path >= tops[:-1]  # a bar that reaches the extreme sets the threshold anew
            setter = np.maximum.accumulate(np.where(sets, np.arange(len(path)), -1))
            in_force = np.where(setter >= 0, back[a:b][setter], s.back)
            ended = ~sets & (tops[:-1] - path >= in_force)
            if ended.any():
                turn = a + int(ended.argmax())
                break
            s.extreme, s.back = s.way * tops[-1], float(in_force[-1])
        if turn is None:
            return None
        s.way = -s.way
    s.extreme, s.back = float(close[turn]), float(back[turn])
    return turn


def advance_legs(s: LegState, close: np.ndarray, high: np.ndarray, low: np.ndarray, atr: np.ndarray, mult: float,
                 min_bars: int = 5):
    """Per bar, the last finished leg as ``(way, lo, hi)``; ``s`` moves on.

    Swings are the first bar and each turn; the leg spans the last two swings.
    Way 0 and NaN: no leg yet, fewer than ``min_bars`` bars, or a flat leg."""
    n = len(close)
    way, lo, hi = np.zeros(n, int), np.full(n, math.nan), np.full(n, math.nan)
    back = mult * np.asarray(atr, float)
    at, begun = 0, s.bars
    if n and not s.bars:
        s.extreme, s.back, s.swing_close = float(close[0]), float(back[0]), float(close[0])
        s.since_lo, s.since_hi = float(low[0]), float(high[0])
        at = 1
    since = 0  # bars from here on are not in since_lo / since_hi yet, but for a first bar, which may count twice
    start = 0
    while True:
        turn = _next_turn(s, close, back, at) if at < n else None
        end = n if turn is None else turn
        way[start:end], lo[start:end], hi[start:end] = s.leg_way, s.leg_lo, s.leg_hi
        upto = n if turn is None else turn + 1
        if upto > since:
            s.since_lo = float(np.fmin(s.since_lo, np.fmin.reduce(low[since:upto])))
            s.since_hi = float(np.fmax(s.since_hi, np.fmax.reduce(high[since:upto])))
        if turn is None:
            break
        s.leg_lo, s.leg_hi = s.since_lo, s.since_hi
        s.leg_way = 1 if close[turn] >= s.swing_close else -1
        s.swing_close, s.since_lo, s.since_hi = float(close[turn]), float(low[turn]), float(high[turn])
        since, start, at = turn + 1, turn, turn + 1
    s.bars += n
    none = (np.arange(n) + begun + 1 < min_bars) | ~(hi - lo > 0)
    way[none], lo[none], hi[none] = 0, math.nan, math.nan
    return way, lo, hi


def last_leg_states(close, high, low, atr, mult: float, min_bars: int = 5):
    """Per bar ``(dir, leg_lo, leg_hi)`` of one whole series."""
    way, lo, hi = advance_legs(LegState(), *(np.asarray(x, float) for x in (close, high, low, atr)), mult, min_bars)
    return [("down", None, "up")[w + 1] for w in way], lo, hi


# --------------------------------------------------------------------------- running statistics
def quantiles_so_far(seen: list[float], x: np.ndarray, q: float) -> np.ndarray:
    """Exact quantile (linear) of ``seen`` and the values up to each place; NaN
    values are skipped.  ``seen`` is kept sorted and takes the new values in."""
    out = np.full(len(x), math.nan)
    for i, v in enumerate(np.asarray(x, float).tolist()):
        if v == v:
            bisect.insort(seen, v)
        if seen:
            place = q * (len(seen) - 1)
            below = int(place)
            above = min(below + 1, len(seen) - 1)
            out[i] = seen[below] + (seen[above] - seen[below]) * (place - below)
    return out


def ranks_needed(q: float, before: int, new: int) -> tuple[int, int]:
    """First and last place (from 0) among ``before`` sorted values that the
    quantiles ``q`` after each of ``new`` further values can ask for: with ``j`` of
    them below, the k-th of all is one of the places ``k - j`` to ``k``."""
    return max(0, int(q * max(before - 1, 0)) - new - 1), min(before - 1, int(q * max(before + new - 1, 0)) + 1)


def quantiles_from(part: list[float], below: int, before: int, x: np.ndarray, q: float) -> np.ndarray:
    """:func:`quantiles_so_far` where of the ``before`` values seen only ``part`` is at
    hand: sorted, without the ``below`` smallest ones, and with the places of
    :func:`ranks_needed`."""
    out = np.full(len(x), math.nan)
    part, total = list(part), before
    under, over = below > 0, below + len(part) < before
    for i, v in enumerate(np.asarray(x, float).tolist()):
        if v == v:
            total += 1
            if under and v <= part[0]:
                below += 1
            elif not (over and v >= part[-1]):
                bisect.insort(part, v)
        if total:
            place = q * (total - 1)
            k = int(place)
            a, b = part[k - below], part[min(k + 1, total - 1) - below]
            out[i] = a + (b - a) * (place - k)
    return out


def smooth_on(last: float, x: np.ndarray, alpha: float) -> np.ndarray:
    """Exponential smoothing that goes on from ``last`` (NaN: seeded by the first
    value), in blocks within which the weights stay in double range."""
    x = np.asarray(x, float)
    out = np.empty(len(x))
    at = 0
    if len(x) and math.isnan(last):
        out[0] = last = x[0]
        at = 1
    q = 1.0 - alpha
    block = max(1, int(200.0 / -math.log(q)))
    while at < len(x):
        part = x[at:at + block]
        scale = q ** np.arange(1, len(part) + 1)
        out[at:at + len(part)] = last + scale * np.cumsum(alpha * (part - last) / scale)
        last = out[at + len(part) - 1]
        at += len(part)
    return out


# --------------------------------------------------------------------------- live rules
@dataclass(frozen=True)
class LiveRules:
    """Fixed values of the live loop's configuration."""

    rsi_long: float = 48
    atr_mult_stop: float = 0.30
    zz_atr_mult: float = 1.7
    zone_pad_frac: float = 0.012
    atr_pct_q: float = 0.60
    atr_med_mult: float = 1.20
    risk_usd: float = 100.0
    max_shares: int = 1000


@dataclass
class LiveState:
    """All that the live rules know of a series: smoothed values, last close, the
    leg, the sorted ATR values so far (what an exact quantile needs) and whether
    a position is open."""

    ema9: float = math.nan
    ema21: float = math.nan
    gain: float = math.nan
    loss: float = math.nan
    atr: float = math.nan
    close: float = math.nan
    in_position: bool = False
    leg: LegState = field(default_factory=LegState)
    atrs: list[float] = field(default_factory=list)

    def flat(self) -> tuple:
        values = (self.ema9, self.ema21, self.gain, self.loss, self.atr, self.close)
        return ([float(v) for v in values], bool(self.in_position), [float(v) for v in astuple(self.leg)], self.atrs)

    @classmethod
    def of(cls, values, in_position, leg, atrs) -> LiveState:
        bars, way, *rest, leg_way = leg
        return cls(*map(float, values), bool(in_position), LegState(int(bars), int(way), *map(float, rest), int(leg_way)),
                   [float(v) for v in atrs])


LIVE_COLUMNS = ("ema9", "ema21", "rsi", "atr", "leg_low", "leg_high", "leg_up", "in_zone", "trend_up", "mom_ok", "vol_ok",
                "logged", "enter")


def advance_indicators(s: LiveState, close: np.ndarray, high: np.ndarray, low: np.ndarray):
    """EMA9, EMA21, RSI(14) with 50 where there is no loss, and ATR(14) of the
    next bars; ``s`` moves on."""
    before = np.concatenate([[s.close], close[:-1]])[:len(close)]
    step = close - before
    spans = np.fmax(np.abs(high - low), np.fmax(np.abs(high - before), np.abs(low - before)))
    first = 1 if len(close) and math.isnan(s.close) else 0  # the first bar of a series has no step
    gain, loss = np.full(len(close), math.nan), np.full(len(close), math.nan)
    gain[first:] = smooth_on(s.gain, np.maximum(step[first:], 0.0), 1 / 14)
    loss[first:] = smooth_on(s.loss, np.maximum(-step[first:], 0.0), 1 / 14)
    ema9, ema21 = smooth_on(s.ema9, close, 2 / 10), smooth_on(s.ema21, close, 2 / 22)
    atr = smooth_on(s.atr, spans, 1 / 14)
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = np.where(loss > 0, 100 - 100 / (1 + gain / loss), 50.0)
    if len(close):
        s.ema9, s.ema21, s.atr, s.close = (float(v[-1]) for v in (ema9, ema21, atr, close))
        s.gain, s.loss = float(gain[-1]), float(loss[-1])
    return ema9, ema21, rsi, atr


def advance_live(s: LiveState, close, high, low, eod, rules: LiveRules = LiveRules(), style: str = "pct",
                 quantiles=None) -> dict:
    """The next bars of one series, in time order, prices known: indicators,
    diagnostics, log and entry flags per bar; ``s`` moves on.  ``quantiles(x, q)``
    gives the quantile of all ATR values up to each of ``x``, for callers that keep
    those values elsewhere than in ``s.atrs``.

    One position at a time: an entry (all conditions hold and the stop is below
    the close) closes the slot until the next flatten bar, which is never logged
    and never enters; a setup with a stop at or above the close leaves it open."""
    close, high, low = (np.asarray(x, float) for x in (close, high, low))
    eod = np.asarray(eod, bool)
    n = len(close)
    ema9, ema21, rsi, atr = advance_indicators(s, close, high, low)
    way, leg_lo, leg_hi = advance_legs(s.leg, close, high, low, atr, rules.zz_atr_mult)
    share = rules.atr_pct_q if style == "pct" else 0.5
    gate = quantiles(atr, share) if quantiles else quantiles_so_far(s.atrs, atr, share)
    vol_ok = atr >= (gate if style == "pct" else rules.atr_med_mult * gate)
    size = leg_hi - leg_lo
    mid, deep = leg_lo + 0.5 * size, leg_lo + 0.618 * size
    pad = rules.zone_pad_frac * size
    in_zone = (low <= np.maximum(mid, deep) + pad) & (high >= np.minimum(mid, deep) - pad)
    trend_up, mom_ok, leg_up = ema9 > ema21, rsi >= rules.rsi_long, way > 0
    setup = ~eod & leg_up & in_zone & trend_up & mom_ok & vol_ok
    setup &= close - (leg_lo - rules.atr_mult_stop * atr) > 0
    enter, taken = np.zeros(n, bool), np.zeros(n, bool)
    setups, ends = np.flatnonzero(setup), np.flatnonzero(eod)
    at = 0
    while at < n:
        if not s.in_position:
            k = np.searchsorted(setups, at)
            if k == len(setups):
                break
            at = int(setups[k])
            enter[at] = s.in_position = True
            at += 1
        k = np.searchsorted(ends, at)
        upto = int(ends[k]) if k < len(ends) else n
        taken[at:upto] = True
        at = upto
        if k < len(ends):
            s.in_position = False
    logged = ~eod & leg_up & ~taken
    return dict(zip(LIVE_COLUMNS, (ema9, ema21, rsi, atr, leg_lo, leg_hi, leg_up, in_zone, trend_up, mom_ok, vol_ok,
                                   logged, enter)))
