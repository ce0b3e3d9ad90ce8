"""Structured Streaming form of the live loop.

Bars land as Parquet files; ``readStream`` picks them up and a stateful processor
(``transformWithState``, RocksDB) carries the rules of
:mod:`barlab.operators.zigzag` on from one arrival to the next, so stream and
batch are one piece of code:

* ``stream_indicators``: EMA9/EMA21, RSI, ATR over the unbroken series;
* ``stream_signals``: these, the last ZigZag leg, gates and the one-position rule.

State.  One value of fixed size per series (smoothed values, leg, position).  The
exact volatility gate needs all ATR values so far: they lie in pages of up to
``PAGE`` values under the leading bits of the value, with a count per such bucket.
An arrival writes the pages that its own values go to and reads those around the
quantile; what it writes does not grow with the series.

Seed.  ``seed`` bars come as the processor's initial state: they move it before
the first arrival and give no rows (T2, S24).

Order.  What is there when a micro-batch starts is one arrival: it is admitted
whole (no file cap by default), so results depend neither on the number of files
nor on the order in which they were written.  With a cap, a series' files must
come in time order, as ``land`` writes them.  A bar at or before a series' last
one is never dropped in silence: it comes out with ``late`` set and no values.

Sinks are checkpointed Parquet folders under the shared checkpoint folder,
so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import astuple, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barlab.operators import swings
from barlab.operators import zigzag as zz
from barlab.session import ship_package, state_store

_D = T.DoubleType()
#: Canonical names, and the vendor's short ones that fill in for them.
SHORT_NAMES = {"ts": "t", "open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("ts", T.TimestampType()),
    *[T.StructField(n, _D) for n in ("open", "high", "low", "close", "volume")],
    T.StructField("t", T.TimestampType()), *[T.StructField(n, _D) for n in ("o", "h", "l", "c", "v")],
    T.StructField("dt", T.DateType()),
])


def land(bars: DataFrame, path: str) -> None:
    """Append bars, under canonical or short names, to the landing folder: a
    folder per day, a symbol's days written one after the other (by one task, so
    that a capped reader meets them in time order)."""
    cols = [F.col(f.name) if f.name in bars.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in BAR_SCHEMA.fields if f.name != "dt"]
    out = bars.select(*cols).withColumn("dt", F.to_date(F.coalesce("ts", "t")))
    (out.repartition("symbol").sortWithinPartitions("dt", "symbol", "ts")
        .write.mode("append").partitionBy("dt").parquet(path))


def read_bars(spark: SparkSession, path: str, watermark: str | None = "2 hours", max_files: int | None = None) -> DataFrame:
    """Streaming bars; short vendor names fill in for missing ones.

    With a ``watermark`` replayed bars are dropped (T5).  A watermark moves with
    the newest bar of a micro-batch and drops what is older without a trace, so
    it needs whole arrivals: it can't be combined with ``max_files``."""
    if watermark and max_files:
        raise ValueError("a file cap would let the watermark drop bars: cap files only with watermark=None")
    reader = spark.readStream.schema(BAR_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(path)
    df = df.withColumns({name: F.coalesce(name, short) for name, short in SHORT_NAMES.items()}).drop(*SHORT_NAMES.values())
    return df.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["symbol", "ts"]) if watermark else df


def run_available_now(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything landed so far, then stop (checkpointed)."""
    with state_store(df.sparkSession):  # a query keeps the settings that it started with
        q = (df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
               .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# --------------------------------------------------------------------------- keyed state
_SMOOTHED = ("ema9", "ema21", "gain", "loss", "atr", "close")
_LEG = tuple(f.name for f in fields(zz.LegState))
#: Everything of fixed size that is known of a series.
STATE = T.StructType([
    T.StructField("last_ts", T.TimestampType()), *[T.StructField(n, _D) for n in _SMOOTHED],
    T.StructField("in_position", T.BooleanType()), T.StructField("seen", T.LongType()),
    *[T.StructField(f"leg_{n}", T.LongType() if n in ("bars", "way", "leg_way") else _D) for n in _LEG],
])
PAGE = 256
_LOW_BITS = 44  # 12 bits of sign and exponent and 8 of the mantissa name a bucket: values within 0.4 %


def bucket_of(value: float) -> int:
    """Leading bits of a double as a number that ascends with the value."""
    bits = struct.unpack("<q", struct.pack("<d", value + 0.0))[0]
    return (bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF) - 1) >> _LOW_BITS


class Seen:
    """All ATR values of one series, in two map states."""

    def __init__(self, counts, pages):
        self.counts, self.pages = counts, pages

    def values(self, bucket: int, n: int) -> list[float]:
        """The values of a bucket, unsorted."""
        out: list[float] = []
        for page in range(-(-n // PAGE)):
            out += self.pages.getValue((bucket, page))[0]
        return out

    def quantiles(self, before: int, x: np.ndarray, q: float) -> np.ndarray:
        """Quantiles of the ``before`` values held and the new ones up to each place."""
        if not before:
            return zz.quantiles_so_far([], x, q)
        first, last = zz.ranks_needed(q, before, len(x))
        below, at, part = 0, 0, []
        for bucket, n in sorted((k[0], v[0]) for k, v in self.counts.iterator()):
            if at + n <= first:
                below += n
            elif at <= last:
                part += self.values(bucket, n)
            at += n
        return zz.quantiles_from(sorted(part), below, before, x, q)

    def add(self, x: np.ndarray) -> int:
        """Takes the values in and says how many there were."""
        new = defaultdict(list)
        for v in x[~np.isnan(x)].tolist():
            new[bucket_of(v)].append(v)
        for bucket, values in new.items():
            n = self.counts.getValue((bucket,))[0] if self.counts.containsKey((bucket,)) else 0
            self.counts.updateValue((bucket,), (n + len(values),))
            while values:
                page, room = n // PAGE, PAGE - n % PAGE
                held = self.pages.getValue((bucket, page))[0] if n % PAGE else []
                self.pages.updateValue((bucket, page), ([*held, *values[:room]],))
                n, values = n + len(values[:room]), values[room:]
        return sum(map(len, new.values())) if new else 0


def _arrived(pdfs: Iterator[pd.DataFrame], last) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Bars in time order, first come first kept, and the late ones."""
    got = pd.concat(list(pdfs), ignore_index=True).sort_values("ts", kind="stable", ignore_index=True)
    late = got["ts"].duplicated()
    if last is not None:
        late |= got["ts"] <= pd.Timestamp(last)
    return got[~late].reset_index(drop=True), got[late].reset_index(drop=True)


class LiveProcessor(StatefulProcessor):
    """New bars of a symbol with what the live rules say of them; late rows come
    out flagged, seed bars move the state only."""

    def __init__(self, columns: list[str], signals: bool, rules: zz.LiveRules = swings.LIVE):
        self.columns, self.signals, self.rules = columns, signals, rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.series = handle.getValueState("series", STATE)
        if self.signals:
            self.seen = Seen(handle.getMapState("atr_counts", "bucket long", "n long"),
                             handle.getMapState("atr_pages", "bucket long, page long", "x array<double>"))

    def _advance(self, bars: pd.DataFrame, held: tuple | None) -> dict:
        """Columns for ``bars`` (new ones, in order); moves the state on."""
        state, seen = zz.LiveState(), 0
        if held:
            named = dict(zip(STATE.names, held))
            state = zz.LiveState(*[named[n] for n in _SMOOTHED], named["in_position"], zz.LegState(*[named[f"leg_{n}"] for n in _LEG]))
            seen = named["seen"]
        close, high, low = (bars[c].to_numpy(float) for c in ("close", "high", "low"))
        if self.signals:
            atrs: list[np.ndarray] = []

            def quantiles(x: np.ndarray, q: float) -> np.ndarray:
                atrs.append(x)
                return self.seen.quantiles(seen, x, q)

            found = zz.advance_live(state, close, high, low, np.asarray(bars["eod"], bool), self.rules, quantiles=quantiles)
            seen += self.seen.add(atrs[0])
        else:
            found = dict(zip(("ema9", "ema21", "rsi", "atr"), zz.advance_indicators(state, close, high, low)))
        self.series.update((bars["ts"].iloc[-1].to_pydatetime(), *[float(getattr(state, n)) for n in _SMOOTHED],
                            bool(state.in_position), seen,
                            *[int(v) if n in ("bars", "way", "leg_way") else float(v) for n, v in zip(_LEG, astuple(state.leg))]))
        return found

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = self.series.get() if self.series.exists() else None
        bars, _ = _arrived(iter([initialState]), held[0] if held else None)
        if len(bars):
            self._advance(bars, held)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.series.get() if self.series.exists() else None
        bars, late = _arrived(rows, held[0] if held else None)
        found = bars.assign(**self._advance(bars, held), late=False) if len(bars) else bars.assign(late=False)
        parts = [p.reindex(columns=self.columns) for p in (found, late.assign(late=True)) if len(p)]
        for part in parts:
            yield part


def _keyed(bars: DataFrame, outputs: T.StructType, signals: bool, seed: DataFrame | None) -> DataFrame:
    ship_package(bars.sparkSession)
    bars = swings.with_flatten(bars)
    start = swings.with_flatten(seed).select("symbol", "ts", "close", "high", "low", "eod").groupBy("symbol") if seed is not None else None
    return bars.groupBy("symbol").transformWithStateInPandas(LiveProcessor(outputs.names, signals), outputs, "Append", "None", start)


def _output(types: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField("symbol", T.StringType()), T.StructField("dt", T.DateType()),
                         T.StructField("ts", T.TimestampType()), T.StructField("close", _D),
                         *[T.StructField(n, swings.TYPES[t]) for n, t in types.items()],
                         T.StructField("late", T.BooleanType())])


def stream_indicators(bars: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Keyed streaming indicators over the unbroken per-symbol series (T1), on
    from the bars of a batch frame ``seed`` if given (T2)."""
    return _keyed(bars, _output({n: "double" for n in ("ema9", "ema21", "rsi", "atr")}), False, seed)


def stream_signals(bars: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Keyed streaming live signals (T3); ``logged`` rows form the log (T4)."""
    return _keyed(bars, _output(swings.LIVE_TYPES), True, seed)
