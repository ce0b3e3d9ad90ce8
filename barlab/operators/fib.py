"""Session swing extremes and Fibonacci levels.

All per-session values are window aggregates over the session partition, so
they ride on the exchange the indicators already paid for (no join back).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab import SESSION_KEYS

# Retracement ratios and their labels, extension ratios.
FIB_RATIOS = [0.0, 0.236, 0.382, 0.5, 0.618, 0.786, 1.0]
FIB_NAMES = ["0%", "23.6%", "38.2%", "50%", "61.8%", "78.6%", "100%"]
EXT_127 = 0.272
EXT_161 = 0.618


def session_extremes(df: DataFrame, keys: Sequence[str] = SESSION_KEYS, idx: str = "idx",
                     direction: str = "auto") -> DataFrame:
    """Adds ``lo, hi, idx_low, idx_high, ts_low, ts_high, direction``.

    First occurrence wins on ties (``min(struct(low, idx))`` /
    ``max(struct(high, -idx))``); direction is ``up`` when the low came first.
    """
    w = Window.partitionBy(*keys)
    mn = F.min(F.struct(F.col("low"), F.col(idx), F.col("ts"))).over(w)
    mx = F.max(F.struct(F.col("high"), (-F.col(idx)).alias("nidx"), F.col("ts"))).over(w)
    df = df.withColumns({"_mn": mn, "_mx": mx})
    if direction == "auto":
        d = F.when(F.col(f"_mn.{idx}") < -F.col("_mx.nidx"), F.lit("up")).otherwise(F.lit("down"))
    else:
        d = F.lit(direction)
    return df.withColumns({
        "lo": F.col("_mn.low"), "idx_low": F.col(f"_mn.{idx}"), "ts_low": F.col("_mn.ts"),
        "hi": F.col("_mx.high"), "idx_high": -F.col("_mx.nidx"), "ts_high": F.col("_mx.ts"),
        "direction": d}).drop("_mn", "_mx")


def session_swings(bars: DataFrame, keys: Sequence[str] = SESSION_KEYS, positions: bool = False) -> DataFrame:
    """One row per session: ``lo, hi, ts_low, ts_high, direction`` as in
    :func:`session_extremes` (and ``idx_low, idx_high`` with ``positions``), by
    one partially aggregated ``groupBy`` instead of a window over every bar."""
    aggs = [F.min(F.struct("low", "ts")).alias("_mn"), F.min(F.struct((-F.col("high")).alias("nh"), "ts")).alias("_mx")]
    if positions:
        aggs.append(F.sort_array(F.collect_list("ts")).alias("_ts"))
    s = bars.groupBy(*keys).agg(*aggs)
    at = lambda c: (F.array_position("_ts", F.col(c)) - 1).cast("int")
    return s.select(*keys, F.col("_mn.low").alias("lo"), (-F.col("_mx.nh")).alias("hi"), F.col("_mn.ts").alias("ts_low"),
                    F.col("_mx.ts").alias("ts_high"),
                    *([at("_mn.ts").alias("idx_low"), at("_mx.ts").alias("idx_high")] if positions else []),
                    F.when(F.col("_mn.ts") < F.col("_mx.ts"), F.lit("up")).otherwise(F.lit("down")).alias("direction"))


def level(lo, hi, direction, ratio):
    """Retracement level: from ``lo`` upward for ``up``, from ``hi`` downward for ``down``."""
    rng = hi - lo
    return F.when(direction == "up", lo + rng * ratio).otherwise(hi - rng * ratio)


def extensions(lo, hi, up_cond):
    """(ext127, ext161) above ``hi`` when ``up_cond`` else below ``lo`` (F2)."""
    rng = hi - lo
    e127 = F.when(up_cond, hi + F.lit(EXT_127) * rng).otherwise(lo - F.lit(EXT_127) * rng)
    e161 = F.when(up_cond, hi + F.lit(EXT_161) * rng).otherwise(lo - F.lit(EXT_161) * rng)
    return e127, e161


def level_array(lo, hi, direction):
    """``array<struct<name, level>>`` of the seven retracement levels (F1)."""
    return F.array(*[F.struct(F.lit(n).alias("name"), level(lo, hi, direction, F.lit(r)).alias("level"))
                     for r, n in zip(FIB_RATIOS, FIB_NAMES)])


def directional_zone(lo, hi, direction, r_low: float, r_high: float):
    """Custom retracement zone (F3): ratios clamped to [0, 1]; returns (zone_lo, zone_hi)."""
    rl = max(0.0, min(1.0, float(r_low)))
    rh = max(0.0, min(1.0, float(r_high)))
    a, b = level(lo, hi, direction, F.lit(rl)), level(lo, hi, direction, F.lit(rh))
    return F.least(a, b), F.greatest(a, b)


def plain_zone(lo, hi, r_low: float, r_high: float, pad_frac: float = 0.0):
    """Non-directional zone from ``lo`` (F4), optionally widened by ``pad_frac*|range|``."""
    rng = hi - lo
    a, b = lo + F.lit(float(r_low)) * rng, lo + F.lit(float(r_high)) * rng
    pad = F.lit(float(pad_frac)) * F.abs(rng)
    return F.least(a, b) - pad, F.greatest(a, b) + pad


def touches(zone_lo, zone_hi):
    """Bar range overlaps the zone."""
    return (F.col("low") <= zone_hi) & (F.col("high") >= zone_lo)
