"""ZigZag step functions on hand-made series, and their Spark wrappers."""

import datetime as dt

import numpy as np

from barlab.operators import swings
from barlab.operators import zigzag as zz


def test_rolling_zigzag_two_reversals():
    close = np.array([100, 101, 103, 106, 104, 101, 99, 100, 103, 106], float)
    atr = np.full(len(close), 1.0)
    d, lo, hi = zz.rolling_zigzag_states(close, atr, 2.0)
    assert d[:3] == [None, None, "up"]          # +3 >= 2 at bar 2
    assert (lo[2], hi[2]) == (100.0, 103.0)
    assert hi[3] == 106.0                        # extension
    assert d[4] == "down" and lo[4] == 104 and hi[4] == 106   # drop of 2 from 106
    assert lo[6] == 99.0
    assert d[8] == "up" and hi[8] == 103.0 and lo[8] == 99.0  # rise of 4 from 99


def test_last_leg_needs_five_bars_and_two_swings():
    close = np.array([100, 103, 101], float)
    d, lo, hi = zz.last_leg_states(close, close + 0.5, close - 0.5, np.ones(3), 1.7)
    assert d == [None, None, None]
    close = np.array([100, 100.5, 103, 104, 104.5], float)
    d, lo, hi = zz.last_leg_states(close, close + 0.5, close - 0.5, np.ones(5), 1.7)
    assert d[3] is None                  # only four bars so far
    assert d[4] == "up"                  # swings 0 -> 2 (+3 >= 1.7): leg spans bars 0..2
    assert lo[4] == 99.5 and hi[4] == 103.5
    close = np.array([100, 100.5, 103, 104, 101, 100], float)
    d, lo, hi = zz.last_leg_states(close, close + 0.5, close - 0.5, np.ones(6), 1.7)
    assert d[4] == "down"                # reversal at bar 4 (104 -> 101): leg spans bars 2..4
    assert lo[4] == 100.5 and hi[4] == 104.5
    assert d[5] == "down" and lo[5] == 100.5   # 100 extends the swing, the leg is unchanged


def test_rolling_zigzag_in_spark_matches_step(spark):
    rows = [("x", dt.date(2024, 1, 2), i, float(c), 1.0)
            for i, c in enumerate([100, 101, 103, 106, 104, 101, 99, 100, 103, 106])]
    df = spark.createDataFrame(rows, "symbol string, dt date, idx int, close double, atr_filled double")
    out = swings.rolling_zigzag(df, 2.0).orderBy("idx").toPandas()
    d, lo, hi = zz.rolling_zigzag_states(out["close"].to_numpy(), out["atr_filled"].to_numpy(), 2.0)
    assert list(out["zz_dir"]) == d
    assert np.allclose(out["imp_lo"], lo) and np.allclose(out["imp_hi"], hi)


def test_expanding_quantile_matches_pandas():
    import pandas as pd
    rng = np.random.default_rng(3)
    x = rng.normal(size=200)
    x[[5, 50]] = np.nan
    got = zz.quantiles_so_far([], x, 0.6)
    exp = pd.Series(x).expanding().quantile(0.6).to_numpy()
    assert np.allclose(got, exp, equal_nan=True)


def test_folded_turns_equal_the_array_search(spark):
    """Native turning points and runs against the array search, ties and unknown ATR included."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        n = int(rng.integers(1, 120))
        close = np.round(100 + rng.normal(size=n).cumsum(), int(rng.integers(0, 3)))
        atr = np.where(rng.random(n) < 0.1, None, np.round(rng.random(n) * (k % 3), 2))
        rows += [(f"s{k}", dt.date(2024, 1, 2), i, float(close[i]), None if atr[i] is None else float(atr[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, dt date, idx int, close double, atr_filled double")
    out = swings.rolling_zigzag(df, 1.5).toPandas().sort_values(["symbol", "idx"])
    for _, g in out.groupby("symbol"):
        d, lo, hi = zz.rolling_zigzag_states(g["close"].to_numpy(), g["atr_filled"].to_numpy(float), 1.5)
        assert [x if isinstance(x, str) else None for x in g["zz_dir"]] == d
        assert np.allclose(g["imp_lo"], lo) and np.allclose(g["imp_hi"], hi)
