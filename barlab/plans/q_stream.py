"""Registered queries: Structured Streaming.

Each query lands the bars derived from ``events`` as Parquet files in two
arrivals (first half of the days, then the rest), runs the streaming query
with ``availableNow`` after each arrival against one checkpoint, and
returns the sink read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab import fixtures
from barlab.plans import q_swings
from barlab.plans.oracle import BARS_CTE, unbroken_ctes
from barlab.plans.registry import register, rounded, sql_final
from barlab.session import scratch_dir
from barlab.streaming import live

#: The day in the middle of the bars: earlier days are the first arrival.
SPLIT_SQL = "(SELECT min(dt) + CAST(floor((max(dt) - min(dt)) / 2) AS INTEGER) FROM bars)"
BAR6 = ["symbol", "ts", "open", "high", "low", "close", "volume"]


def split_day(bars):
    return bars.agg(F.expr("date_add(min(dt), cast(floor(datediff(max(dt), min(dt)) / 2) AS INT))")).first()[0]


def _two_arrivals(spark, sf, build, max_files: int | None = None):
    bars = fixtures.bars(spark, sf)
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    split = F.lit(split_day(bars))
    for part in (bars.filter(F.col("dt") < split), bars.filter(F.col("dt") >= split)):
        live.land(part, src)
        live.run_available_now(build(live.read_bars(spark, src, watermark=None, max_files=max_files)), sink, ckpt)
    return spark.read.parquet(sink).filter(~F.col("late"))


# ---------------------------------------------------------------- T5 / S23
def q_stream_bars(spark, sf):
    """Bars, then a replay of every bar with another close: the replay is
    dropped by the watermark and ``dropDuplicatesWithinWatermark``."""
    bars = fixtures.bars(spark, sf)
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("bars-src", "bars-sink", "bars-ckpt"))
    live.land(bars, src)
    live.run_available_now(live.read_bars(spark, src).select(*BAR6), sink, ckpt)
    live.land(bars.withColumn("close", F.col("close") + F.lit(0.5)), src)
    live.run_available_now(live.read_bars(spark, src).select(*BAR6), sink, ckpt)
    return rounded(spark.read.parquet(sink))


register("stream_bars", sql=sql_final("WITH " + BARS_CTE.strip() + " SELECT symbol, ts, open, high, low, close, "
                                      "volume FROM bars", BAR6, BAR6[2:]))(q_stream_bars)


# ---------------------------------------------------------------- T1
IND_COLS = ["symbol", "ts", "close", "ema9", "ema21", "rsi", "atr"]
IND_D = ["close", "ema9", "ema21", "rsi", "atr"]


def q_stream_indicators(spark, sf):
    return rounded(_two_arrivals(spark, sf, live.stream_indicators).select(*IND_COLS))


def _unbroken_sql(src: str, where: str = "TRUE") -> str:
    return sql_final("WITH RECURSIVE " + ", ".join([BARS_CTE.strip(), f"u AS (SELECT * FROM {src})", *unbroken_ctes("u")])
                     + f" SELECT symbol, ts, close, ema9, ema21, rsi, atr FROM ind WHERE {where}", IND_COLS, IND_D)


register("stream_indicators", sql=_unbroken_sql("bars"))(q_stream_indicators)


# ---------------------------------------------------------------- T2 seeded
def q_stream_seeded(spark, sf, n: int = 300):
    """The last ``n`` bars before the split are the stream's initial state (no
    output); the rest stream live (T2, S24)."""
    from pyspark.sql import Window
    bars = fixtures.bars(spark, sf)
    split = F.lit(split_day(bars))
    before = bars.filter(F.col("dt") < split)
    w = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
    seed = before.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")
    after = bars.filter(F.col("dt") >= split)
    src, sink, ckpt = (scratch_dir(spark, x) for x in ("seed-src", "seed-sink", "seed-ckpt"))
    live.land(after, src)
    live.run_available_now(live.stream_indicators(live.read_bars(spark, src, watermark=None), seed=seed), sink, ckpt)
    return rounded(spark.read.parquet(sink).filter(~F.col("late")).select(*IND_COLS))


register("stream_seeded", sql=_unbroken_sql(
    f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rk FROM bars "
    f"WHERE dt < {SPLIT_SQL}) s WHERE rk <= 300 UNION ALL SELECT *, 0 FROM bars WHERE dt >= {SPLIT_SQL})",
    f"dt >= {SPLIT_SQL}"))(q_stream_seeded)


# ---------------------------------------------------------------- T3 / T4 / S22
def q_stream_signals(spark, sf):
    return rounded(_two_arrivals(spark, sf, live.stream_signals).select(*q_swings._LIVE_COLS))


_LIVE_SQL = "WITH RECURSIVE " + ",\n".join(q_swings._LIVE_CTES)
register("stream_signals", sql=sql_final(_LIVE_SQL + " SELECT * FROM z", q_swings._LIVE_COLS,
                                         q_swings._LIVE_D))(q_stream_signals)

LOG_COLS = ["symbol", "ts", "close", "ema9", "ema21", "rsi", "atr", "in_zone", "trend_up", "mom_ok", "vol_ok"]


def q_stream_signal_log(spark, sf):
    """Append-only diagnostics log: bars with an up leg and no open position."""
    return rounded(_two_arrivals(spark, sf, lambda b: live.stream_signals(b)
                                 .filter(F.col("logged") | F.col("late"))).select(*LOG_COLS))


register("stream_signal_log", sql=sql_final(_LIVE_SQL + " SELECT * FROM z WHERE logged", LOG_COLS,
                                            ["close", "ema9", "ema21", "rsi", "atr"]))(q_stream_signal_log)
