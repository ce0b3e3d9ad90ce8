"""Live rules in batch and streaming: arrivals, order, late bars, positions."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab import fixtures
from barlab.operators import swings
from barlab.operators import zigzag as zz
from barlab.session import scratch_dir
from barlab.streaming import live
from tests.conftest import SF_SMOKE


def _rows(df, cols):
    return sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def _many(spark, symbols):
    """Bars of ``symbols`` symbols over ten days, and the bars themselves."""
    days = [dt.datetime(2024, 3, 1) + dt.timedelta(days=d) for d in range(10)]
    rows = [(f"s{s:04d}", d + dt.timedelta(hours=10 + h), 1.0 * s, 2.0 + s + h, 0.5 + s, 1.0 + s + h % 2, 10.0)
            for s in range(symbols) for d in days for h in range(2)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, open double, high double, low double, close double, volume double")


@pytest.fixture(scope="module")
def shuffled(spark):
    """A folder of 1,300 files, days in mixed order."""
    bars = _many(spark, 130)
    src = scratch_dir(spark, "many-src")
    days = [r[0] for r in bars.select(F.to_date("ts")).distinct().collect()]
    rng = np.random.default_rng(5)
    for d in rng.permutation(len(days)):
        part = bars.filter(F.to_date("ts") == F.lit(days[d])).withColumn("dt", F.to_date("ts"))
        cols = [F.col(f.name) if f.name in part.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in live.BAR_SCHEMA.fields]
        out = part.select(*cols).repartitionByRange(130, "symbol").write.mode("append")
        out.partitionBy("dt").parquet(src)
    return bars, src


def test_no_bar_is_lost_whatever_the_number_and_order_of_files(spark, shuffled):
    bars, src = shuffled
    files = spark.read.parquet(src).select(F.input_file_name()).distinct().count()
    assert files > 1_000
    for n, df in enumerate((live.read_bars(spark, src), live.stream_indicators(live.read_bars(spark, src, watermark=None)))):
        sink, ckpt = scratch_dir(spark, f"many-sink{n}"), scratch_dir(spark, f"many-ckpt{n}")
        live.run_available_now(df, sink, ckpt)
        got = spark.read.parquet(sink)
        assert got.count() == bars.count()
        if "late" in got.columns:
            assert got.filter("late").count() == 0


def test_a_cap_must_not_meet_a_watermark(spark):
    with pytest.raises(ValueError, match="watermark"):
        live.read_bars(spark, "/tmp", max_files=7)


@pytest.mark.parametrize("build,cols", [
    (live.stream_indicators, ["symbol", "ts", "close", "ema9", "ema21", "rsi", "atr"]),
    (live.stream_signals, ["symbol", "ts", "ema9", "atr", "in_zone", "vol_ok", "logged", "enter"])])
def test_capped_arrivals_give_the_same_rows(spark, build, cols):
    bars = fixtures.bars(spark, SF_SMOKE)
    src = scratch_dir(spark, "cap-src")
    live.land(bars, src)
    got = []
    for cap in (7, 1_000, None):
        sink, ckpt = scratch_dir(spark, "cap-sink"), scratch_dir(spark, "cap-ckpt")
        live.run_available_now(build(live.read_bars(spark, src, watermark=None, max_files=cap)), sink, ckpt)
        out = spark.read.parquet(sink)
        assert out.filter("late").count() == 0
        got.append(_rows(out, cols))
    assert got[0] == got[1] == got[2] and len(got[0]) == bars.count()


def test_late_bars_come_out_flagged(spark):
    bars = _many(spark, 2)
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("late-src", "late-sink", "late-ckpt"))
    for part in (bars.filter("ts >= '2024-03-05'"), bars.filter("ts < '2024-03-07'")):
        live.land(part, src)
        live.run_available_now(live.stream_indicators(live.read_bars(spark, src, watermark=None)), sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.filter("not late").count() == bars.filter("ts >= '2024-03-05'").count()
    late = out.filter("late")
    assert late.count() == bars.filter("ts < '2024-03-07'").count() and late.filter("ema9 IS NOT NULL").count() == 0


def test_short_names_fill_in(spark):
    bars = _many(spark, 2)
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("alias-src", "alias-sink", "alias-ckpt"))
    old = bars.withColumnsRenamed({"ts": "t", "open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"})
    live.land(old.filter("symbol = 's0000'"), src)
    live.land(bars.filter("symbol = 's0001'"), src)
    live.run_available_now(live.read_bars(spark, src), sink, ckpt)
    cols = ["symbol", "ts", "open", "high", "low", "close", "volume"]
    assert _rows(spark.read.parquet(sink), cols) == _rows(bars, cols)


def test_stream_equals_batch_on_minute_bars(spark):
    bars = fixtures.bars(spark, SF_SMOKE, unit="minute")
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("min-src", "min-sink", "min-ckpt"))
    cols = ["symbol", "ts", "ema9", "ema21", "rsi", "atr", "leg_up", "in_zone", "trend_up", "mom_ok", "vol_ok", "logged", "enter"]
    for lo, hi in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-12"), ("2024-01-12", "2025-01-01")):
        live.land(bars.filter((F.col("ts") >= lo) & (F.col("ts") < hi)), src)
        live.run_available_now(live.stream_signals(live.read_bars(spark, src, watermark=None)), sink, ckpt)
    assert _rows(spark.read.parquet(sink), cols) == _rows(swings.live_signals(bars), cols)


def test_reset_by_session_starts_anew(spark):
    bars = fixtures.bars(spark, SF_SMOKE)
    got = swings.live_signals(bars, reset="session")
    first = got.groupBy("symbol", "dt").agg(F.min_by("ema9", "ts").alias("e"), F.min_by("close", "ts").alias("c"))
    assert first.filter("abs(e - c) > 1e-9").count() == 0
    unbroken = swings.live_signals(bars)
    first = unbroken.groupBy("symbol", "dt").agg(F.min_by("ema9", "ts").alias("e"), F.min_by("close", "ts").alias("c"))
    assert first.filter("abs(e - c) > 1e-9").count() > 0


def _path(n, seed):
    rng = np.random.default_rng(seed)
    close = 100 + rng.normal(size=n).cumsum()
    return close, close + rng.random(n), close - rng.random(n)


def test_positions_one_at_a_time():
    """Against a plain walk over the bars; some setups have their stop above the close."""
    refused = 0
    for seed in range(30):
        close, high, low = _path(400, seed)
        eod = np.arange(400) % 90 >= 88
        rules = zz.LiveRules(atr_mult_stop=-6.0 if seed % 2 else 0.3, rsi_long=30, zone_pad_frac=0.5)
        got = zz.advance_live(zz.LiveState(), close, high, low, eod, rules)
        held = False
        for i in range(400):
            free = not held
            if eod[i]:
                held, free = False, False
            ok = all(got[k][i] for k in ("leg_up", "in_zone", "trend_up", "mom_ok", "vol_ok"))
            r = close[i] - (got["leg_low"][i] - rules.atr_mult_stop * got["atr"][i])
            enter = bool(free and ok and r > 0)
            refused += bool(free and ok and not r > 0)
            assert bool(got["logged"][i]) == bool(free and got["leg_up"][i])
            assert bool(got["enter"][i]) == enter
            held = held or enter
    assert refused > 0


def test_legs_carry_over_any_cut():
    close, high, low = _path(500, 9)
    atr = np.full(500, 1.0)
    whole = zz.advance_legs(zz.LegState(), close, high, low, atr, 1.7)
    for size in (1, 3, 50, 499):
        s, parts = zz.LegState(), []
        for k in range(0, 500, size):
            parts.append(zz.advance_legs(s, close[k:k + size], high[k:k + size], low[k:k + size], atr[k:k + size], 1.7))
        for w, p in zip(whole, zip(*parts)):
            np.testing.assert_allclose(np.concatenate(p), w)


def test_state_survives_its_flat_form():
    s = zz.LiveState()
    close, high, low = _path(60, 2)
    zz.advance_live(s, close, high, low, np.zeros(60, bool))
    again = zz.LiveState.of(*s.flat())
    assert again == s and not math.isnan(again.ema9)


class _Map:
    """A map state in memory that counts what is written."""

    def __init__(self):
        self.held, self.written = {}, 0

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value
        self.written += sum(len(v) if isinstance(v, list) else 1 for v in value)

    def iterator(self):
        return iter(self.held.items())


def test_quantiles_of_paged_values_are_exact_and_writes_do_not_grow():
    rng = np.random.default_rng(4)
    x = np.concatenate([np.round(rng.gamma(4, 0.3, 6_000), 3), np.full(1_500, 1.25), -rng.random(20), np.zeros(30)])
    x[rng.random(len(x)) < 0.02] = np.nan
    rng.shuffle(x)
    want = [zz.quantiles_so_far([], x, q) for q in (0.5, 0.6)]
    for size in (1, 10, 4_000):
        seen, before, got, writes = live.Seen(_Map(), _Map()), 0, [[], []], []
        stop = 400 if size == 1 else len(x)
        for a in range(0, stop, size):
            part = x[a:a + size]
            for k, q in enumerate((0.5, 0.6)):
                got[k].append(seen.quantiles(before, part, q))
            at = seen.pages.written + seen.counts.written
            before += seen.add(part)
            writes.append(seen.pages.written + seen.counts.written - at)
        for w, g in zip(want, got):
            np.testing.assert_allclose(np.concatenate(g), w[:stop], equal_nan=True)
        if size == 10:  # a page or two for each value at most, early and late
            assert max(writes) <= 10 * (live.PAGE + 1) and sum(writes[-100:]) < 100 * 10 * (live.PAGE + 1)
            assert len(max(seen.pages.held.values(), key=lambda v: len(v[0]))[0]) <= live.PAGE


def test_buckets_ascend_with_the_value():
    x = sorted([0.0, -0.0, 1e-300, -1e-300, 1.0, 1.0000001, -1.0, 2.5, 1e9, -1e9, 0.3])
    b = [live.bucket_of(v) for v in x]
    assert b == sorted(b) and live.bucket_of(0.0) == live.bucket_of(-0.0)


def test_seed_moves_the_state_and_gives_no_rows(spark):
    """Signals from a seeded start are those of the unbroken run; the seed may
    hold symbols that never come, and late bars before its end are flagged."""
    bars = fixtures.bars(spark, SF_SMOKE)
    cols = ["symbol", "ts", "ema9", "atr", "leg_up", "in_zone", "vol_ok", "logged", "enter"]
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("init-src", "init-sink", "init-ckpt"))
    cut = "2024-01-15"
    live.land(bars.filter((F.col("ts") >= cut) & (F.col("symbol") != "click") | (F.col("ts") < "2024-01-02")), src)
    live.run_available_now(live.stream_signals(live.read_bars(spark, src, watermark=None), seed=bars.filter(F.col("ts") < cut)), sink, ckpt)
    out = spark.read.parquet(sink)
    want = swings.live_signals(bars).filter((F.col("ts") >= cut) & (F.col("symbol") != "click"))
    assert want.count() > 0 and _rows(out.filter("not late"), cols) == _rows(want, cols)
    assert out.filter("late").count() == bars.filter("ts < '2024-01-02'").count() > 0


def test_the_sessions_own_state_store_setting_stays(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("conf-src", "conf-sink", "conf-ckpt"))
    live.land(_many(spark, 1), src)
    live.run_available_now(live.stream_indicators(live.read_bars(spark, src, watermark=None)), sink, ckpt)
    assert spark.conf.get(name, None) == before
