"""Series that go on from day to day, worked on in chunks.

The live loop knows one series per symbol since its start.  Here such a series is
cut into chunks, ``(symbol, dt)``: every window and group below holds one chunk's
rows, and what a chunk must know of the past comes from a table of one row per
chunk.  A symbol that holds a third of all bars is as many chunks as it has days.

* :func:`with_previous`, :func:`with_halo`: the rows before a chunk's first one;
* :func:`atr`, :func:`live_indicators`: smoothed indicators of the unbroken series.

* :func:`as_of_join`, :func:`spread_features`: the last quote at or before a time.

Order statistics of all values so far are in :mod:`barlab.operators.order_stats`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions import indicators as ind

SERIES = ("symbol",)


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` and the columns named with ``prefix``."""
    out = F.lit(True)
    for c in keys:
        out &= F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in keys})


def with_previous(df: DataFrame, cols: Sequence[str], names: Sequence[str], *, keys: Sequence[str] = SERIES,
                  chunk: str = "dt", order: str = "ts") -> DataFrame:
    """``lag`` over the unbroken series: a chunk's first row gets the last row of
    the chunk before it (W15)."""
    of_chunk = [*keys, chunk]
    last = df.groupBy(*of_chunk).agg(F.max_by(F.struct(*cols), order).alias("__last"))
    before = F.lag("__last").over(Window.partitionBy(*keys).orderBy(chunk))  # one row a chunk
    before = _renamed(last.select(*of_chunk, before.alias("__before")), of_chunk, "__p_")
    w = ind.series_window(of_chunk, order)
    first = F.row_number().over(w) == 1
    df = df.join(before, _same(of_chunk, "__p_"))
    return df.withColumns({n: F.when(first, F.col("__before")[c]).otherwise(F.lag(c).over(w)) for c, n in zip(cols, names)}) \
             .drop("__before", *[f"__p_{c}" for c in of_chunk])


def with_halo(df: DataFrame, rows: int, cols: Sequence[str], *, keys: Sequence[str] = SERIES, chunk: str = "dt",
              order: str = "ts", flag: str = "halo") -> DataFrame:
    """The rows of ``df`` and, flagged, copies of the ``rows`` rows before each
    chunk's first one (``order`` and ``cols`` only): frames of up to ``rows``
    preceding rows are then whole within a chunk.  Filter the copies out again."""
    of_chunk = [*keys, chunk]
    item = F.struct(order, *cols)
    back = F.row_number().over(Window.partitionBy(*of_chunk).orderBy(F.col(order).desc()))
    tails = (df.withColumn("__back", back).filter(F.col("__back") <= rows).groupBy(*of_chunk)
             .agg(F.sort_array(F.collect_list(item)).alias("__tail")))
    # a chunk has a row at least, so the last `rows` chunks hold what is needed
    w = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(-rows, -1)
    held = tails.select(*of_chunk, F.flatten(F.collect_list("__tail").over(w)).alias("__held"))
    first = F.greatest(F.size("__held") - rows + 1, F.lit(1))
    tails = held.select(*of_chunk, F.explode(F.slice("__held", first, rows)).alias("__row"))
    copies = tails.select(*of_chunk, *[F.col("__row")[c].alias(c) for c in (order, *cols)], F.lit(True).alias(flag))
    return df.withColumn(flag, F.lit(False)).unionByName(copies, allowMissingColumns=True)


def sma_cross(df: DataFrame, fast: int, slow: int, src: str = "close", *, keys: Sequence[str] = SERIES, chunk: str = "dt",
              order: str = "ts") -> DataFrame:
    """Adds full rolling means ``sma_f``, ``sma_s`` over the unbroken series and
    ``signal``: entry where the fast one crosses above, exit where it crosses
    below the slow one (G4)."""
    halo = with_halo(df, slow, [src], keys=keys, chunk=chunk, order=order, flag="__halo")  # the bar before has full means too
    w = ind.series_window([*keys, chunk], order)
    full = lambda n: F.when(F.count(src).over(w.rowsBetween(1 - n, 0)) >= n, F.avg(src).over(w.rowsBetween(1 - n, 0)))
    out = halo.withColumns({"sma_f": full(fast), "sma_s": full(slow)})
    out = out.withColumn("__d", F.col("sma_f") - F.col("sma_s")).withColumn("__pd", F.lag("__d").over(w))
    d, pd = F.col("__d"), F.col("__pd")
    out = out.withColumn("signal", F.when((pd <= 0) & (d > 0), "entry").when((pd >= 0) & (d < 0), "exit"))
    return out.filter(~F.col("__halo")).drop("__halo", "__d", "__pd")


def _true_range(pc: Column) -> Column:
    return F.greatest(F.abs(F.col("high") - F.col("low")), F.abs(F.col("high") - pc), F.abs(F.col("low") - pc))


def atr(bars: DataFrame, n: int = 14, out: str = "atr", *, keys: Sequence[str] = SERIES, chunk: str = "dt",
        order: str = "ts") -> DataFrame:
    """Wilder ATR of the unbroken series."""
    df = with_previous(bars, ["close"], ["__pc"], keys=keys, chunk=chunk, order=order)
    df = df.withColumn("__tr", _true_range(F.col("__pc")))
    df = ind.smooth_unbroken(df, [ind.Smoothing("__tr", out, 1 / n)], keys=keys, chunk=chunk, order=order)
    return df.drop("__pc", "__tr")


def live_indicators(bars: DataFrame, *, keys: Sequence[str] = SERIES, chunk: str = "dt", order: str = "ts") -> DataFrame:
    """Adds ``ema9, ema21, rsi, atr`` of the unbroken series: RSI is 50 where there
    is no loss, the first true range is the bar's own (T1 in batch form)."""
    df = with_previous(bars, ["close"], ["__pc"], keys=keys, chunk=chunk, order=order)
    step = F.col("close") - F.col("__pc")
    df = df.withColumns({
        "__up": F.when(step.isNotNull(), F.greatest(step, F.lit(0.0))), "__dn": F.when(step.isNotNull(), F.greatest(-step, F.lit(0.0))),
        "__tr": _true_range(F.col("__pc"))})
    df = ind.smooth_unbroken(df, [
        ind.Smoothing("close", "ema9", 2 / 10), ind.Smoothing("close", "ema21", 2 / 22),
        *ind.rsi_smoothings("__up", "__dn", 14, "__au", "__ad"), ind.Smoothing("__tr", "atr", 1 / 14)],
        keys=keys, chunk=chunk, order=order)
    return df.withColumn("rsi", ind.rsi_of(F.col("__au"), F.col("__ad"), "fill50")).drop("__pc", "__up", "__dn", "__tr", "__au", "__ad")


def as_of_join(left: DataFrame, right: DataFrame, cols: Sequence[str], *, on: str = "ts", right_on: str = "ts",
               keys: Sequence[str] = SERIES, tie: Sequence[str] = ()) -> DataFrame:
    """``left`` with ``cols`` of the last row of ``right`` of the same ``keys`` at or
    before its time ``on``; NULL if there is none.  Of rows of ``right`` at one time
    the last by ``tie`` counts; rows without a time are no rows of ``right``.

    Both sides are dealt by key and day and swept in time order: inside a day the
    last row seen so far is a running ``last``; what the days before leave behind
    comes from a table of one row per key and day.  No join by range, and no window
    over more than a key's day."""
    of_day = [*keys, "__day"]
    value = F.struct(*[F.col(c) for c in cols])
    r = right.filter(F.col(right_on).isNotNull()).select(
        *keys, F.to_date(right_on).alias("__day"), F.col(right_on).alias("__t"), F.lit(0).alias("__side"),
        (F.struct(*tie) if tie else F.lit(0)).alias("__tie"), value.alias("__r"))
    l = left.select(*keys, F.to_date(on).alias("__day"), F.col(on).alias("__t"), F.lit(1).alias("__side"),
                    F.struct(*left.columns).alias("__l"))
    last = r.groupBy(*of_day).agg(F.max_by("__r", F.struct("__t", "__tie")).alias("__last"))
    days = last.unionByName(l.select(*of_day).distinct(), allowMissingColumns=True).groupBy(*of_day).agg(
        F.max("__last").alias("__last"))  # one row a key and day, of either side
    before = F.last("__last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1))
    days = _renamed(days.select(*of_day, before.alias("__before")), of_day, "__b_")
    both = r.unionByName(l, allowMissingColumns=True)
    w = Window.partitionBy(*of_day).orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("__seen", F.last("__r", ignorenulls=True).over(w)).filter(F.col("__side") == 1)
    out = swept.join(days, _same(of_day, "__b_")).withColumn(
        "__found", F.when(F.col("__t").isNotNull(), F.coalesce("__seen", "__before")))
    return out.select("__l.*", *[F.col("__found")[c].alias(c) for c in cols])


def spread_features(bars: DataFrame, quotes: DataFrame, bar_seconds: int, n: int = 20) -> DataFrame:
    """Adds the quote in force at each bar's end and what it says of trading costs
    (G1): ``bid, ask, quote_ts, spread, mid, spread_bps`` (of the mid price),
    ``quote_age`` in seconds, and ``spread_avg``, the mean spread of the session's
    last ``n`` bars.  Quotes: ``symbol, ts, bid, ask`` and ``seq``, which orders
    quotes of one time; a quote with a missing or crossed side is no quote."""
    good = quotes.filter(F.col("bid").isNotNull() & F.col("ask").isNotNull() & (F.col("ask") >= F.col("bid")))
    ends = bars.withColumn("__end", F.timestamp_seconds(F.unix_seconds("ts") + bar_seconds))
    df = as_of_join(ends, good.withColumnRenamed("ts", "quote_ts"), ["bid", "ask", "quote_ts"], on="__end", right_on="quote_ts", tie=["seq"])
    mid = (F.col("bid") + F.col("ask")) / 2
    df = df.withColumns({"spread": F.col("ask") - F.col("bid"), "mid": mid,
                         "spread_bps": F.try_divide(F.col("ask") - F.col("bid"), mid) * F.lit(10_000.0),
                         "quote_age": F.unix_seconds("__end") - F.unix_seconds("quote_ts")})
    last = ind.series_window().rowsBetween(1 - n, 0)
    return df.withColumn("spread_avg", F.avg("spread").over(last)).drop("__end")
