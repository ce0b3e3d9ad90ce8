"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (sum of per-query seconds), "unit",
"queries": {name: sec}, "sf", ...}.  Each query is executed end to end with
the ``noop`` sink (every column computed, nothing collected to the driver);
one warm-up pass (JIT, file listing), then the best of ``$BENCH_REPS`` runs.

Besides registered queries on hourly bars, ``*_1m`` entries run the same
operators on minute bars (about 30x more bars per session), which is where
per-session work shows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["ema_trend", "macd", "rsi_null", "atr", "vol_gate", "bronze_to_silver", "silver_to_gold",
            "ingest_bars_json", "fib_signals", "bracket_outcome", "backtest_trades", "rolling_fib_trades",
            "live_signals", "trade_summary", "param_sweep"]


def _minute_queries():
    from dataclasses import replace

    from barlab import fixtures
    from barlab.functions import indicators as ind
    from barlab.operators import backtest as bt
    from barlab.operators import medallion, metrics, swings

    def bars_1m(spark, sf):
        return fixtures.bars(spark, sf, unit="minute")

    def indicators_1m(spark, sf):
        return ind.study(bars_1m(spark, sf))

    def medallion_1m(spark, sf):
        silver = medallion.bronze_to_silver(fixtures.bronze_bars(bars_1m(spark, sf)), "1min")
        return medallion.silver_to_gold(silver)

    def backtest_a_1m(spark, sf):
        return bt.run(bars_1m(spark, sf), replace(bt.RULE_A, session_filter=None))

    def backtest_c_1m(spark, sf):
        return metrics.trade_summary(bt.trade_columns(bt.run(bars_1m(spark, sf), replace(bt.RULE_C, session_filter=None))),
                                     ["symbol"])

    def backtest_d_1m(spark, sf):
        return bt.run(bars_1m(spark, sf), replace(bt.RULE_D, session_filter=None))

    def live_signals_1m(spark, sf):
        return swings.live_signals(bars_1m(spark, sf))

    def sweep_1m(spark, sf):
        from barlab.operators import sweep
        return sweep.sweep_results(sweep.sweep_trades(bars_1m(spark, sf)))

    return {"indicators_1m": indicators_1m, "medallion_1m": medallion_1m, "backtest_a_1m": backtest_a_1m,
            "backtest_c_1m": backtest_c_1m, "backtest_d_1m": backtest_d_1m, "live_signals_1m": live_signals_1m,
            "sweep_1m": sweep_1m}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from barlab.plans import catalog
    from barlab.session import clean_scratch, get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app_name="barlab-bench")
    reg = catalog.all_queries()
    qs = {k: reg[k].fn for k in HEADLINE}
    qs.update(_minute_queries())
    if only:
        qs = {k: v for k, v in qs.items() if k in only}
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in qs.items():
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            best = None
            for _ in range(reps):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - report, keep benchmarking
            errors[name] = repr(e)[:300]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus), "reps": reps}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
