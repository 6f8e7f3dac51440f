"""DuckDB SQL pieces for the registered queries."""

from __future__ import annotations

from tapeflow.functions.times import DAY_MS, HOUR_MS

MS = "epoch_us({0}) // 1000"

TRADES = f"""trades AS (
  SELECT event_id AS trade_id, upper(event_type) AS symbol, {MS.format("ts")} AS event_time,
         CAST(value AS DECIMAL(18,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS quantity
  FROM events)"""

LINE_TRADES = f"""line_trades AS (
  SELECT l_orderkey * 10 + l_linenumber AS trade_id, l_returnflag || l_linestatus AS symbol,
         {MS.format("l_shipdate")} AS event_time,
         l_extendedprice / l_quantity AS price, l_quantity AS quantity
  FROM lineitem)"""

# A trade message as the encoder writes it.
WIRE = """'{"e":"trade","E":' || event_time || ',"s":"' || symbol || '","t":' || trade_id
  || ',"p":"' || CAST(price AS VARCHAR) || '","q":"' || CAST(quantity AS VARCHAR)
  || '","T":' || event_time || ',"m":' || CASE WHEN trade_id % 2 = 0 THEN 'true' ELSE 'false' END
  || ',"M":true}'"""

MESSAGES = f"""{TRADES}, messages AS (
  SELECT 'binance.trades' AS topic, symbol, make_timestamp(event_time * 1000) AS ts,
         {WIRE} AS value
  FROM trades)"""


def seconds(ms: str) -> str:
    return f"make_timestamp({ms} // 1000 * 1000000)"


_DERIVED = """
       last_price - open_price AS price_change,
       100.0 * (last_price - open_price) / nullif(open_price, 0) AS price_change_percent,
       last_price, last_quantity, open_price, high_price, low_price, volume, quote_volume,
       quote_volume / nullif(volume, 0) AS vwap, total_trades"""

_NOTIONAL = "CAST(price AS DECIMAL(19,8)) * CAST(quantity AS DECIMAL(19,8))"


def rolling(period_ms: int, name: str = "ticker", source: str = "trades") -> str:
    """The rolling ticker as one RANGE frame; peers carry the same figures."""
    return f"""{name}_parts AS (
  SELECT DISTINCT event_time, symbol,
         CAST(arg_min(price, (event_time, trade_id)) OVER w AS DOUBLE) AS open_price,
         CAST(arg_max(price, (event_time, trade_id)) OVER w AS DOUBLE) AS last_price,
         CAST(arg_max(quantity, (event_time, trade_id)) OVER w AS DOUBLE) AS last_quantity,
         CAST(max(price) OVER w AS DOUBLE) AS high_price,
         CAST(min(price) OVER w AS DOUBLE) AS low_price,
         CAST(sum(quantity) OVER w AS DOUBLE) AS volume,
         CAST(sum({_NOTIONAL}) OVER w AS DOUBLE) AS quote_volume,
         count(*) OVER w AS total_trades
  FROM {source}
  WINDOW w AS (PARTITION BY symbol ORDER BY event_time
               RANGE BETWEEN {period_ms} PRECEDING AND CURRENT ROW)),
{name} AS (SELECT event_time, symbol,{_DERIVED} FROM {name}_parts)"""


TICKER_1H = f"{TRADES}, {rolling(HOUR_MS)}"
TICKER_1D = f"{TRADES}, {rolling(DAY_MS)}"


def hopping(period_ms: int, slide_ms: int) -> str:
    steps = period_ms // slide_ms
    return f"""WITH {TRADES}, copies AS (
  SELECT *, unnest(range(event_time // {slide_ms} - {steps - 1},
                         event_time // {slide_ms} + 1)) AS start
  FROM trades), parts AS (
  SELECT start, symbol,
         CAST(arg_min(price, (event_time, trade_id)) AS DOUBLE) AS open_price,
         CAST(arg_max(price, (event_time, trade_id)) AS DOUBLE) AS last_price,
         CAST(arg_max(quantity, (event_time, trade_id)) AS DOUBLE) AS last_quantity,
         CAST(max(price) AS DOUBLE) AS high_price, CAST(min(price) AS DOUBLE) AS low_price,
         CAST(sum(quantity) AS DOUBLE) AS volume,
         CAST(sum({_NOTIONAL}) AS DOUBLE) AS quote_volume, count(*) AS total_trades
  FROM copies GROUP BY start, symbol)
SELECT make_timestamp(start * {slide_ms * 1000}) AS window_start,
       make_timestamp((start * {slide_ms} + {period_ms}) * 1000) AS window_end, symbol,{_DERIVED}
FROM parts"""


def first_write(source: str) -> str:
    return f"""SELECT trade_id, symbol, event_time, price, quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY trade_id, symbol
                               ORDER BY event_time, price, quantity) AS place
  FROM {source}) WHERE place = 1"""


LOGS = """logs AS (
  SELECT make_timestamp((1746093600 + doc_id) * 1000000 + 123456) AS ts, text AS line,
         'containerlogs' AS job, 'stdout' AS stream, substr(md5(source), 1, 12) AS container_id,
         lang AS tag, 'market' AS compose_project, source AS compose_service,
         CAST(NULL AS VARCHAR) AS stack_name, CAST(NULL AS VARCHAR) AS swarm_service_name,
         CAST(NULL AS VARCHAR) AS swarm_task_name
  FROM documents)"""
