"""SQL text shared by the DuckDB oracle queries.

``BARS_CTE`` repeats the bar fixture (``barlab.fixtures.bars_from_events``)
in SQL, so every oracle starts from the same given tables as Spark does.
Helpers here only build SQL strings; nothing executes.
"""

from __future__ import annotations

BARS_CTE = """
bars AS (
  SELECT event_type AS symbol,
         date_trunc('hour', ts) AS ts,
         CAST(date_trunc('hour', ts) AS DATE) AS dt,
         arg_min(value, (ts, event_id)) AS open,
         max(value) AS high,
         min(value) AS low,
         arg_max(value, (ts, event_id)) AS close,
         sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS volume,
         count(*) AS num_trades,
         sum(value * CAST(json_extract_string(props, '$.k') AS DOUBLE))
           / nullif(sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 0) AS vwap
  FROM events
  GROUP BY event_type, date_trunc('hour', ts)
)"""

SESSION = "PARTITION BY symbol, dt ORDER BY ts"


def smooth_sql(src: str, alpha: float, idx: str = "idx", start: int = 0,
               part: str = SESSION) -> str:
    """Closed-form exponential smoothing, same formula as the Spark side."""
    q = 1.0 - alpha
    i = f"({idx} - {start})"
    return (f"CASE WHEN {i} >= 0 THEN pow({q!r}, {i}) * sum(CASE WHEN {i} = 0 THEN {src} "
            f"WHEN {i} > 0 THEN {alpha!r} * pow({q!r}, -{i}) * {src} END) "
            f"OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END")


def ema_sql(src: str, span: int, **kw) -> str:
    return smooth_sql(src, 2.0 / (span + 1.0), **kw)


def wilder_sql(src: str, n: int, **kw) -> str:
    return smooth_sql(src, 1.0 / n, **kw)


def unbroken_ctes(source: str, name: str = "ind") -> list[str]:
    """EMA 9 and 21, RSI 14 and ATR 14 over the unbroken series of each symbol in
    ``source``: the recurrences themselves, row by row, right for any length.
    ``name`` has the columns of ``source`` and ``idx, ema9, ema21, rsi, atr``."""
    w = "PARTITION BY symbol ORDER BY ts"
    w14 = "r.{0} * (13.0 / 14.0) + p.{1} / 14.0"
    return [
        f"{name}_b AS (SELECT *, CAST(row_number() OVER ({w}) - 1 AS INTEGER) AS idx, close - lag(close) OVER ({w}) AS dlt, "
        f"greatest(abs(high - low), abs(high - lag(close) OVER ({w})), abs(low - lag(close) OVER ({w}))) AS tr FROM {source})",
        f"{name}_e AS MATERIALIZED (SELECT *, greatest(dlt, 0.0) AS up, greatest(-dlt, 0.0) AS dn FROM {name}_b)",
        f"{name}_r AS (SELECT symbol, idx, close AS ema9, close AS ema21, CAST(NULL AS DOUBLE) AS au, CAST(NULL AS DOUBLE) AS ad, "
        f"tr AS atr FROM {name}_e WHERE idx = 0 UNION ALL SELECT p.symbol, p.idx, r.ema9 * 0.8 + p.close * 0.2, "
        "r.ema21 * (10.0 / 11.0) + p.close / 11.0, "
        f"CASE WHEN r.au IS NULL THEN p.up ELSE {w14.format('au', 'up')} END, "
        f"CASE WHEN r.ad IS NULL THEN p.dn ELSE {w14.format('ad', 'dn')} END, {w14.format('atr', 'tr')} "
        f"FROM {name}_r r JOIN {name}_e p ON p.symbol = r.symbol AND p.idx = r.idx + 1)",
        f"{name} AS MATERIALIZED (SELECT e.*, r.ema9, r.ema21, r.atr, "
        "coalesce(100.0 - 100.0 / (1.0 + r.au / nullif(r.ad, 0.0)), 50.0) AS rsi "
        f"FROM {name}_e e JOIN {name}_r r USING (symbol, idx))",
    ]


def with_bars(*ctes: str) -> str:
    return "WITH " + ",\n".join([BARS_CTE, *ctes])
