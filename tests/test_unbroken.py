"""Chunked operators over unbroken series against plain walks over the whole series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlab.operators import unbroken
from barlab.operators import zigzag as zz

SCHEMA = "symbol string, dt int, ts int, close double, high double, low double"


def series(seed, n, cuts, decimals=None):
    rng = np.random.default_rng(seed)
    close = 100 + rng.normal(size=n).cumsum()
    if decimals is not None:
        close = np.round(close, decimals)
    high, low = close + rng.random(n), close - rng.random(n)
    chunk = np.searchsorted(np.sort(rng.choice(n, min(cuts, n), replace=False)), np.arange(n), side="right")
    return chunk, close, high, low


def frame(spark, many):
    rows = [(name, int(c), i, float(p), float(h), float(l)) for name, (chunk, close, high, low) in many.items()
            for i, (c, p, h, l) in enumerate(zip(chunk, close, high, low))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def many():
    return {"a": series(1, 700, 30), "b": series(2, 300, 299), "c": series(3, 400, 0), "d": series(4, 1, 0), None: series(5, 90, 7)}


def by_symbol(df, many):
    got = df.toPandas().sort_values("ts")
    for name, s in many.items():
        yield got[got["symbol"].isna() if name is None else got["symbol"] == name], s


def test_live_indicators(spark, many):
    for got, (_, close, high, low) in by_symbol(unbroken.live_indicators(frame(spark, many)), many):
        want = zz.advance_indicators(zz.LiveState(), close, high, low)
        for name, w in zip(("ema9", "ema21", "rsi", "atr"), want):
            assert np.allclose(got[name], w, rtol=1e-9), name


def test_previous_and_halo(spark, many):
    df = frame(spark, many)
    for got, (_, close, *_) in by_symbol(unbroken.with_previous(df, ["close", "ts"], ["pc", "pt"]), many):
        assert np.allclose(got["pc"].to_numpy(float), np.concatenate([[np.nan], close[:-1]]), equal_nan=True)
    for rows in (1, 5, 40):
        halo = unbroken.with_halo(df, rows, ["close"])
        assert halo.filter("not halo").count() == df.count()
        for got, (chunk, close, *_) in by_symbol(halo.filter("halo"), many):
            for c, part in got.groupby("dt"):
                start = int(np.flatnonzero(chunk == c)[0])
                assert part["close"].tolist() == close[max(0, start - rows):start].tolist()


def test_sma_cross(spark, many):
    for got, (_, close, *_) in by_symbol(unbroken.sma_cross(frame(spark, many), 3, 11), many):
        s = pd.Series(close)
        f, w = s.rolling(3).mean(), s.rolling(11).mean()
        d, p = f - w, (f - w).shift(1)
        want = np.where((p <= 0) & (d > 0), "entry", np.where((p >= 0) & (d < 0), "exit", None))
        assert np.allclose(got["sma_s"].to_numpy(float), w, equal_nan=True)
        assert [x if isinstance(x, str) else None for x in got["signal"]] == want.tolist()


@pytest.mark.parametrize("decimals,scale", [(None, 1.0), (0, 1.0), (1, 0.0), (None, 3.0)])
def test_last_leg_whatever_the_chunks(spark, decimals, scale):
    """Ties, thresholds of 0, wildly changing thresholds, chunks of one bar."""
    from barlab.operators import legs
    many = {f"s{k}": series(100 + k, n, cuts, decimals) for k, (n, cuts) in enumerate([(400, 0), (400, 20), (150, 149), (1, 0), (2, 1), (6, 3), (300, 60)])}
    rng = np.random.default_rng(17)
    atr = {g: rng.random(len(s[1])) * scale * (1 + 9 * (rng.random(len(s[1])) < 0.1)) * (rng.random(len(s[1])) < 0.9) for g, s in many.items()}
    rows = [(g, int(s[0][i]), i, float(s[1][i]), float(s[2][i]), float(s[3][i]), float(atr[g][i])) for g, s in many.items() for i in range(len(s[1]))]
    df = spark.createDataFrame(rows, SCHEMA + ", atr double").repartition(4)
    out = legs.last_leg(df, 1.7)
    assert out.columns == [*df.columns, "leg_way", "leg_low", "leg_high"]
    for got, name in ((g, n) for (g, _), n in zip(by_symbol(out, many), many)):
        way, lo, hi = zz.advance_legs(zz.LegState(), many[name][1], many[name][2], many[name][3], atr[name], 1.7)
        assert got["leg_way"].tolist() == way.tolist(), name
        np.testing.assert_array_equal(got["leg_low"].to_numpy(float), lo)
        np.testing.assert_array_equal(got["leg_high"].to_numpy(float), hi)


def test_as_of_join(spark):
    """Ties, days without quotes, symbols without quotes, rows without a time."""
    import datetime as dt
    rng = np.random.default_rng(21)
    t0 = dt.datetime(2024, 3, 1)
    at = lambda h: t0 + dt.timedelta(hours=int(h))
    quotes = [(s, at(h), float(k), k) for s in ("a", "b", None) for k, h in enumerate(np.sort(rng.integers(30, 300, 40)))]
    quotes += [("a", None, -1.0, 99)]
    bars = [(s, at(h), k) for s in ("a", "b", "c", None) for k, h in enumerate(rng.permutation(400)[:150])] + [("a", None, 7)]
    left = spark.createDataFrame(bars, "symbol string, ts timestamp, n int").repartition(3)
    right = spark.createDataFrame(quotes, "symbol string, qt timestamp, bid double, seq int").repartition(3)
    got = {(r["symbol"], r["ts"], r["n"]): (r["bid"], r["qt"]) for r in
           unbroken.as_of_join(left, right, ["bid", "qt"], right_on="qt", tie=["seq"]).collect()}
    assert len(got) == len(bars)
    for s, t, n in bars:
        seen = [(q, k, b) for g, q, b, k in quotes if g == s and q is not None and t is not None and q <= t]
        want = max(seen) if seen else None
        assert got[s, t, n] == ((want[2], want[0]) if want else (None, None)), (s, t)
