"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark builders: plain window functions over one
partition per symbol (no blocks), and ``WITH RECURSIVE`` loops for recurrences.
Tables ``events``, ``orders`` … are views over the same parquet files.
"""

from __future__ import annotations


def r(expr: str, d: int) -> str:
    """Round and turn −0.0 into 0.0, as :func:`barloom.plans.queries.rnd`."""
    return f"(round({expr}, {d}) + 0.0)"


BARS_HOURLY = """
SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS ts,
       min_by(value, event_id) AS open, max(value) AS high, min(value) AS low,
       max_by(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(value) AS turnover
FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)
"""

BARS_DAILY = """
SELECT o_orderpriority AS symbol, o_orderdate AS ts,
       min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
       max_by(o_totalprice, o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM orders GROUP BY o_orderpriority, o_orderdate
"""

# gap-filled hourly bars with a row number (CTE body list; ends with `hf`)
HOURLY_FILLED_CTES = f"""
hb AS ({BARS_HOURLY}),
hrng AS (SELECT symbol, min(ts) AS t0, max(ts) AS t1 FROM hb GROUP BY symbol),
hgrid AS (SELECT symbol, unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS ts FROM hrng),
hj AS (SELECT g.symbol, g.ts, b.open, b.high, b.low, b.close, b.volume, b.turnover,
              b.close IS NULL AS filled
       FROM hgrid g LEFT JOIN hb b ON b.symbol = g.symbol AND b.ts = g.ts),
hl AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lc FROM hj),
hf AS (SELECT symbol, ts, coalesce(open, lc) AS open, coalesce(high, lc) AS high,
              coalesce(low, lc) AS low, coalesce(close, lc) AS close,
              coalesce(volume, 0.0) AS volume, coalesce(turnover, 0.0) AS turnover, filled,
              row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn
       FROM hl)
"""

DAILY_CTES = f"""
bd0 AS ({BARS_DAILY}),
bd AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bd0)
"""

FLAGSHIP = f"""
WITH {HOURLY_FILLED_CTES},
f AS (
  SELECT *,
    CASE WHEN rn > 7 THEN close - lag(close, 7) OVER w END AS mom7,
    CASE WHEN rn > 6 THEN avg(close) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS sma7,
    CASE WHEN rn > 6 THEN regr_slope(close, rn) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS slope7,
    CASE WHEN close > 0 AND lead(close, 10) OVER w > 0 THEN ln(lead(close, 10) OVER w / close) END AS fwd10
  FROM hf WINDOW w AS (PARTITION BY symbol ORDER BY rn)),
s AS (SELECT *, CASE WHEN slope7 > 1e-9 THEN 10.0 WHEN slope7 < -1e-9 THEN 0.0 END AS sig FROM f),
p AS (SELECT *, coalesce(last_value(sig IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY rn
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS position FROM s),
q AS (SELECT *, coalesce(lag(position) OVER (PARTITION BY symbol ORDER BY rn), 0.0) * (close - open) AS pnl FROM p),
c AS (SELECT *, sum(pnl) OVER (PARTITION BY symbol ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pnl FROM q)
SELECT symbol,
  CAST(count(*) AS BIGINT) AS n_bars,
  CAST(sum(CAST(filled AS BIGINT)) AS BIGINT) AS n_filled,
  {r('sum(mom7)', 4)} AS sum_mom7,
  {r('avg(sma7)', 4)} AS avg_sma7,
  {r('avg(fwd10)', 6)} AS avg_fwd10,
  {r('sum(pnl)', 4)} AS total_pnl,
  {r('max_by(cum_pnl, rn)', 4)} AS final_cum_pnl,
  CAST(sum(CASE WHEN position > 0 THEN 1 ELSE 0 END) AS BIGINT) AS bars_long
FROM c GROUP BY symbol
"""

ORACLE = {
    "flagship_hourly_latch_pnl": FLAGSHIP,
}
