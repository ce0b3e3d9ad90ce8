"""Scalar column helpers: parsing, time of day, labels, file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def parse_ts(c: Column | str) -> Column:
    """ISO-8601 text to timestamp; unparsable text gives NULL."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def round_ms(ts: Column) -> Column:
    """Round a timestamp to milliseconds, ties to even."""
    ms = F.bround(F.unix_micros(ts) / F.lit(1000.0), 0)
    return F.timestamp_micros((ms * 1000).cast("long"))


def hhmm_to_us(s: str) -> int:
    parts = [int(p) for p in s.split(":")]
    h, m = parts[0], parts[1]
    sec = parts[2] if len(parts) > 2 else 0
    return ((h * 60 + m) * 60 + sec) * 1_000_000


def time_of_day_us(ts: Column, tz: str = "UTC") -> Column:
    """Microseconds since midnight of the wall clock in ``tz``."""
    local = ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)
    return F.pmod(F.unix_micros(local), F.lit(DAY_US))


def in_time_windows(ts: Column, windows: Sequence[str], tz: str = "UTC") -> Column:
    """Any of the closed ``[start, end]`` time-of-day intervals given as a flat
    ``("09:35", "11:00", "14:00", "15:45")`` tuple (P9)."""
    tod = time_of_day_us(ts, tz)
    cond = F.lit(False)
    for s, e in zip(windows[::2], windows[1::2]):
        cond = cond | tod.between(hhmm_to_us(s), hhmm_to_us(e))
    return cond


def eastern(ts: Column) -> Column:
    """UTC instant to New York wall time (TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), ts.cast("timestamp_ntz"))


def session_label(et: Column) -> Column:
    """``RTH`` for 09:30-16:00 New York time, both ends included (16:00 only at
    minute 0), else ``AH`` (P10)."""
    h, m = F.hour(et), F.minute(et)
    after_open = (h > 9) | ((h == 9) & (m >= 30))
    before_close = (h < 16) | ((h == 16) & (m == 0))
    return F.when(after_open & before_close, F.lit("RTH")).otherwise(F.lit("AH"))


def eod_flag(et: Column, hour: int = 15, minute: int = 55) -> Column:
    """Flatten time reached: the hour equals ``hour`` and the minute is at
    least ``minute`` (F20)."""
    return (F.hour(et) == hour) & (F.minute(et) >= minute)


def round_half_away(c: Column, places: int) -> Column:
    """Round half away from zero on the binary value: ``sign(x) *
    floor(|x| * 10^p + 0.5) / 10^p``.  Deterministic for a given double, so
    two engines that compute the same double round it the same way
    (``round`` on a double rounds its shortest decimal text instead, which
    splits exact decimal ties differently).  A double beyond 9e18 / 10^p has no
    digits after place ``p`` (doubles hold 53 bits), so rounding would change
    nothing, while ``floor`` would leave the range of a long: it stays as it is."""
    scale = float(10 ** places)
    return F.when(F.abs(c) < F.lit(9.0e18 / scale),
                  F.signum(c) * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).otherwise(c)


def safe_div(a: Column, b: Column) -> Column:
    """Division with a zero denominator giving NULL."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def path_symbol(path: Column) -> Column:
    return F.regexp_extract(path, r"symbol=([^/]+)", 1)


def path_dt(path: Column) -> Column:
    return F.try_to_date(F.nullif(F.regexp_extract(path, r"dt=([0-9\-]+)", 1), F.lit("")))


def path_date(path: Column) -> Column:
    return F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1)
