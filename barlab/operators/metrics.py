"""Trade metrics, equity curves and drawdown.

Drawdown follows the reference: equity is the running sum of ``pnl_R`` in
``(dt, ts_in)`` order, the peak starts at the first trade (not at 0), and
maxDD is ``min(equity - running max)``.  Summaries reduce a day's trades to a
few numbers first and merge the days in order, so that a group's rows are days,
not trades.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions import indicators as ind

INF = float("inf")


def summary_aggs(src: str = "pnl_R", with_dd: bool = True) -> list[Column]:
    p = F.col(src)
    gross_win = F.coalesce(F.sum(F.when(p > 0, p)), F.lit(0.0))
    gross_loss = -F.coalesce(F.sum(F.when(p <= 0, p)), F.lit(0.0))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(p > 0).alias("wins"),
        (F.count(F.lit(1)) - F.count_if(p > 0)).alias("losses"),
        F.sum(p).alias("netR"),
        F.when(gross_loss > 0, gross_win / gross_loss).otherwise(F.lit(INF)).alias("pf"),
        F.avg(p).alias("expectancy"),
        (F.avg(F.when(p > 0, 1.0).otherwise(0.0)) * 100.0).alias("win_pct"),
    ]
    if with_dd:
        aggs.append(F.min("dd").alias("maxDD"))
    return aggs


def day_metrics(trades: Column, src: str = "pnl_R") -> Column:
    """Of one day's trades, in order: what merges to the whole's metrics.
    ``top`` and ``bottom`` are the extremes of the running sum, ``dd`` its worst
    fall from an earlier trade."""
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    start = F.struct(none.alias("n"), none.alias("wins"), zero.alias("net"), zero.alias("won"), zero.alias("lost"),
                     F.lit(-INF).alias("top"), F.lit(INF).alias("bottom"), zero.alias("dd"))

    def step(a, t):
        p = t[src]
        net = a["net"] + p
        top = F.greatest(a["top"], net)
        return F.struct((a["n"] + 1).alias("n"), (a["wins"] + F.when(p > 0, 1).otherwise(0)).alias("wins"), net.alias("net"),
                        (a["won"] + F.when(p > 0, p).otherwise(0.0)).alias("won"),
                        (a["lost"] - F.when(p > 0, 0.0).otherwise(p)).alias("lost"), top.alias("top"),
                        F.least(a["bottom"], net).alias("bottom"), F.least(a["dd"], net - top).alias("dd"))

    return F.aggregate(trades, start, step)


def merged_days(days: Column) -> Column:
    """Day metrics ``m`` of sorted ``array<struct<dt, m>>`` merged in order: a
    fall may start at an earlier day's peak."""
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    start = F.struct(none.alias("n"), none.alias("wins"), zero.alias("net"), zero.alias("won"), zero.alias("lost"),
                     F.lit(-INF).alias("top"), zero.alias("dd"), none.alias("days"))

    def merge(a, d):
        m = d["m"]
        return F.struct((a["n"] + m["n"]).alias("n"), (a["wins"] + m["wins"]).alias("wins"), (a["net"] + m["net"]).alias("net"),
                        (a["won"] + m["won"]).alias("won"), (a["lost"] + m["lost"]).alias("lost"),
                        F.greatest(a["top"], a["net"] + m["top"]).alias("top"),
                        F.least(a["dd"], m["dd"], a["net"] + m["bottom"] - a["top"]).alias("dd"),
                        (a["days"] + 1).alias("days"))

    return F.aggregate(days, start, merge)


def summary_of(a: Column) -> list[Column]:
    """The summary columns of merged metrics."""
    return [a["n"].alias("n"), a["wins"].alias("wins"), (a["n"] - a["wins"]).alias("losses"), a["net"].alias("netR"),
            F.when(a["lost"] > 0, a["won"] / a["lost"]).otherwise(F.lit(INF)).alias("pf"),
            (a["net"] / a["n"]).alias("expectancy"), (a["wins"] / a["n"] * 100.0).alias("win_pct"), a["dd"].alias("maxDD")]


def _day_rows(trades: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group, dt`` and the metrics ``m`` of the day's trades."""
    day = trades.groupBy(*group, "dt").agg(F.sort_array(F.collect_list(F.struct("ts_in", "pnl_R"))).alias("t"))
    return day.select(*group, "dt", day_metrics(F.col("t")).alias("m"))


def _merged_days(days: DataFrame, group: Sequence[str]) -> DataFrame:
    days = days.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("dt", "m"))).alias("days"))
    return days.select(*group, merged_days(F.col("days")).alias("a"))


def _merged(trades: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group`` and the merged metrics ``a`` of its trades."""
    return _merged_days(_day_rows(trades, group), group)


def trade_summary(trades: DataFrame, group: Sequence[str]) -> DataFrame:
    """n, wins, losses, netR, profit factor (inf without losses), maxDD,
    expectancy and win % per group (A9, A10)."""
    return _merged(trades, group).select(*group, *summary_of(F.col("a")))


def summary_by_day_total(trades: DataFrame, instrument: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per-day rows and a total row per instrument.

    Each day is reduced once; day rows read its metrics (drawdown inside the day),
    total rows merge the days in (dt, ts_in) order.  The largest group is a day's
    trades or an instrument's days."""
    inst = list(instrument)
    days = _day_rows(trades, inst)
    per_day = days.select(*inst, "dt", *summary_of(F.col("m")), F.lit(0).cast("tinyint").alias("is_total"))
    total = _merged_days(days, inst).select(*inst, F.lit(None).cast(trades.schema["dt"].dataType).alias("dt"), *summary_of(F.col("a")),
                                            F.lit(1).cast("tinyint").alias("is_total"))
    return per_day.unionByName(total)


def equity_daily(trades: DataFrame, instrument: Sequence[str] = ("symbol",)) -> DataFrame:
    """Daily R and its running total per instrument."""
    d = trades.groupBy(*instrument, "dt").agg(F.sum("pnl_R").alias("day_R"))
    w = Window.partitionBy(*instrument).orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("cum_R", F.sum("day_R").over(w))


def equity_trades(trades: DataFrame, group: Sequence[str]) -> DataFrame:
    """Cumulative R by trade in (dt, ts_in) order (W14): the sum of the days
    before, from a table of one row a day, and the running sum inside the day."""
    days = trades.groupBy(*group, "dt").agg(F.sum("pnl_R").alias("__day"))
    past = Window.partitionBy(*group).orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(*[F.col(c).alias(f"__d_{c}") for c in (*group, "dt")],
                       F.coalesce(F.sum("__day").over(past), F.lit(0.0)).alias("__before"))
    same = F.lit(True)
    for c in (*group, "dt"):
        same &= F.col(c).eqNullSafe(F.col(f"__d_{c}"))
    inside = Window.partitionBy(*group, "dt").orderBy("ts_in").rowsBetween(Window.unboundedPreceding, 0)
    out = trades.join(days, same).withColumn("cum_R", F.col("__before") + F.sum("pnl_R").over(inside))
    return out.drop("__before", *[f"__d_{c}" for c in (*group, "dt")])


def run_summary(trades: DataFrame, instrument: Sequence[str] = ("symbol",)) -> DataFrame:
    """days_tested (days with trades), trades, netR_total, avg_R_per_trade,
    max_drawdown_R per instrument (A13)."""
    a = F.col("a")
    return _merged(trades, instrument).select(
        *instrument, a["days"].alias("days_tested"), a["n"].alias("trades"), a["net"].alias("netR_total"),
        (a["net"] / a["n"]).alias("avg_R_per_trade"), a["dd"].alias("max_drawdown_R"))


def tail_rows(df: DataFrame, k: int, group: Sequence[str], order: str) -> DataFrame:
    """Last ``k`` rows of each group in ``order``."""
    w = Window.partitionBy(*group).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k).drop("_rk")


def perf_metrics(daily: DataFrame, instrument: Sequence[str], src: str = "day_R",
                 periods_per_year: int = 252) -> DataFrame:
    """Win %, Sharpe, max drawdown and CAGR of a daily R series.

    Sharpe = mean/sample std of daily R x sqrt(periods_per_year); CAGR of the
    equity ``1 + cumulative R / 100`` over the calendar span."""
    d = ind.drawdown_cols(daily, src, keys=list(instrument), order=["dt"])
    span_years = F.greatest(F.datediff(F.max("dt"), F.min("dt")), F.lit(1)) / F.lit(365.25)
    final = F.lit(1.0) + F.sum(src) / F.lit(100.0)
    return d.groupBy(*instrument).agg(
        (F.avg(F.when(F.col(src) > 0, 1.0).otherwise(0.0)) * 100.0).alias("win_pct"),
        (F.try_divide(F.avg(src), F.stddev_samp(src)) * F.lit(periods_per_year ** 0.5)).alias("sharpe"),
        F.min("dd").alias("max_dd"),
        F.when(final > 0, F.pow(final, F.lit(1.0) / span_years) - F.lit(1.0)).alias("cagr"))
