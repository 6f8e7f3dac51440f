"""Registered queries: name, Spark function, DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapeflow.contracts import TICKER_1D, TICKER_1H, TRADES, check_schema
from tapeflow.functions.decode import read_messages, to_table_types
from tapeflow.functions.display import change_class, or_no_data, plain_decimal, shown
from tapeflow.functions.times import DAY_MS, HOUR_MS, LAST_MS, millis_time
from tapeflow.operators import latest as L
from tapeflow.operators import logs as G
from tapeflow.operators import metrics as M
from tapeflow.operators import quality as Q
from tapeflow.operators import ticker as K
from tapeflow.plans import driver_tables as D
from tapeflow.plans import market_board, ops_board
from tapeflow.plans import oracle as O
from tapeflow.plans.ticker_tables import refresh_from_slices, refresh_ticker
from tapeflow.scratch import shared_dir, staged
from tapeflow.sources import tables as S
from tapeflow.sources import zones as Z
from tapeflow.sources.growing import growing_log_stream
from tapeflow.sources.log_table import read_lines
from tapeflow.sources.topics import fan_in, log_files, log_stream, one_topic, text_stream
from tapeflow.streaming import ingest as I

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: QueryFn
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(ids: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        REGISTRY[fn.__name__] = Query(fn.__name__, ids, fn, oracle)
        return fn

    return add


def _plain(*columns: str) -> list[Column]:
    """Timestamps without a zone, as DuckDB returns them."""
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


# --- messages ---------------------------------------------------------------


@register("S3", f"WITH {O.MESSAGES} SELECT topic, value FROM messages")
def encode_wire(spark, sf_dir):
    messages = D.trade_messages(D.trades(spark, sf_dir))
    return messages.select("topic", F.col("value").cast("string").alias("value"))


@register(
    "S4 P1 P2 P3 P4 P5 P7 P8",
    f"""WITH {O.TRADES} SELECT trade_id, symbol, event_time, CAST(price AS VARCHAR) AS price,
    CAST(quantity AS VARCHAR) AS quantity FROM trades""",
)
def decode_trades(spark, sf_dir):
    messages = D.trade_messages(D.trades(spark, sf_dir))
    rows = Q.usable(read_messages(messages, TRADES), TRADES)
    return rows.select(
        "trade_id",
        "symbol",
        "event_time",
        plain_decimal(F.col("price")).alias("price"),
        plain_decimal(F.col("quantity")).alias("quantity"),
    )


@register(
    "P9 K3 S11",
    f"""WITH {O.TRADES} SELECT trade_id, symbol, event_time, CAST(price AS DOUBLE) AS price,
    CAST(quantity AS DOUBLE) AS quantity FROM trades""",
)
def trades_contract(spark, sf_dir):
    messages = D.trade_messages(D.trades(spark, sf_dir))
    rows = to_table_types(Q.usable(read_messages(messages, TRADES), TRADES), TRADES)
    return check_schema(rows, TRADES.table_schema)


@register(
    "S4 P1 P2 P3 P4 P6 P7 P8",
    f"""SELECT {O.MS.format("l_shipdate")} AS event_time, l_returnflag || l_linestatus AS symbol,
    l_discount AS price_change, l_tax AS price_change_percent, l_extendedprice AS last_price,
    l_extendedprice / 2 AS open_price, l_extendedprice * 2 AS high_price,
    l_extendedprice / 4 AS low_price, l_quantity AS volume, l_orderkey AS total_trades
    FROM lineitem""",
)
def decode_ticker(spark, sf_dir):
    rows = read_messages(D.ticker_messages(spark, sf_dir), TICKER_1H)
    return to_table_types(Q.usable(rows, TICKER_1H), TICKER_1H)


@register(
    "S2",
    f"""WITH {O.TRADES}, {O.LINE_TRADES} SELECT symbol, trade_id, quantity FROM (
      SELECT symbol, trade_id, CAST(quantity AS DOUBLE) AS quantity FROM trades
      UNION ALL SELECT symbol, trade_id, quantity FROM line_trades)""",
)
def fan_in_union(spark, sf_dir):
    """Two sources into one topic, read back from it."""
    sources = [D.trades(spark, sf_dir), D.line_trades(spark, sf_dir)]
    topic = fan_in([D.trade_messages(s).select("topic", "value") for s in sources])
    rows = read_messages(one_topic(topic, TRADES.topic), TRADES)
    return to_table_types(Q.usable(rows, TRADES), TRADES).select("symbol", "trade_id", "quantity")


# --- keys and quarantine ----------------------------------------------------

_MIXED = """
  SELECT 'good' AS outcome, count(*) AS messages FROM events
  UNION ALL SELECT 'null_key', count(*) FROM events
  UNION ALL SELECT CASE WHEN trim(text) = '' THEN 'empty' ELSE 'malformed' END, count(*)
    FROM documents GROUP BY 1
  UNION ALL SELECT 'bad_number', count(*) FROM orders
  UNION ALL SELECT 'empty', count(*) FROM customer"""


@register(
    "P1 K2",
    f"""SELECT outcome, CAST(sum(messages) AS BIGINT) AS messages FROM ({_MIXED})
    GROUP BY outcome""",
)
def quarantine_counts(spark, sf_dir):
    rows = read_messages(D.mixed_messages(spark, sf_dir), TRADES)
    return rows.groupBy(F.coalesce("reason", F.lit("good")).alias("outcome")).agg(
        F.count("*").alias("messages")
    )


@register(
    "P1 K2",
    """SELECT 'null_key' AS reason, props AS raw FROM events
    UNION ALL SELECT CASE WHEN trim(text) = '' THEN 'empty' ELSE 'malformed' END, text
      FROM documents
    UNION ALL SELECT 'bad_number', '{"s":"' || o_orderstatus || '","t":' || o_orderkey
      || ',"p":"' || o_orderpriority || '","q":"' || o_totalprice || '","T":'
      || epoch_us(o_orderdate) // 1000 || '}' FROM orders
    UNION ALL SELECT 'empty', '' FROM customer""",
)
def quarantine_rows(spark, sf_dir):
    return Q.quarantined(read_messages(D.mixed_messages(spark, sf_dir), TRADES))


@register("K1", f"WITH {O.LINE_TRADES} {O.first_write('line_trades')}")
def dedup_first_write(spark, sf_dir):
    return Q.first_per_key(D.line_trades(spark, sf_dir), TRADES.key)


@register(
    "K1",
    f"""WITH {O.LINE_TRADES}, known AS (SELECT * FROM line_trades WHERE price < 1500),
    fresh AS (SELECT * FROM line_trades t WHERE NOT EXISTS (
      SELECT 1 FROM known k WHERE k.trade_id = t.trade_id AND k.symbol = t.symbol))
    {O.first_write('fresh')}""",
)
def reject_known_keys(spark, sf_dir):
    rows = D.line_trades(spark, sf_dir)
    known = rows.where(F.col("price") < 1500)
    return Q.reject_known(Q.first_per_key(rows, TRADES.key), known, TRADES.key)


@register(
    "K1",
    f"""WITH {O.LINE_TRADES}, ends AS (
      SELECT trade_id, symbol, min((event_time, price, quantity)) AS kept,
        max((event_time, price, quantity)) AS last, count(*) AS copies
      FROM line_trades GROUP BY trade_id, symbol)
    SELECT trade_id, symbol, kept[1] AS kept_event_time, kept[2] AS kept_price,
      kept[3] AS kept_quantity, copies FROM ends WHERE kept <> last""",
)
def key_conflicts(spark, sf_dir):
    return Q.conflicts_within(D.line_trades(spark, sf_dir), TRADES.key)


@register(
    "K2",
    """SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'kept' END AS side,
    count(*) AS n FROM events GROUP BY 1""",
)
def not_null_split(spark, sf_dir):
    """Rows of one event type lose their key part and are set aside."""
    symbol = F.when(F.col("symbol") != "ERROR", F.col("symbol"))
    rows = D.trades(spark, sf_dir).withColumn("symbol", symbol)
    kept, rejected = Q.split_null_keys(rows, TRADES.key)
    sides = kept.select(F.lit("kept").alias("side")).unionByName(
        rejected.select(F.lit("rejected").alias("side"))
    )
    return sides.groupBy("side").agg(F.count("*").alias("n"))


# --- tables -----------------------------------------------------------------

_MID_MONTH = 1_705_300_000_000
_ONCE = f"WITH {O.LINE_TRADES} {O.first_write('line_trades')}"


def _appended(spark, sf_dir, *attempts: tuple[str, int]) -> str:
    path = shared_dir(spark, "trades")
    for writer, epoch in attempts:
        S.append_once(D.line_trades(spark, sf_dir), TRADES, path, writer, epoch)
    return path


@register("S5 S8 S9 K1 K3", _ONCE)
def append_to_table(spark, sf_dir):
    return S.read_table(spark, TRADES, _appended(spark, sf_dir, ("a", 0)))


@register("S5 K1", _ONCE)
def replay_adds_nothing(spark, sf_dir):
    """An epoch is retried, then replayed under another writer."""
    return S.read_table(spark, TRADES, _appended(spark, sf_dir, ("a", 0), ("a", 0), ("b", 0)))


@register("S9", _ONCE)
def compacted_table(spark, sf_dir):
    target = shared_dir(spark, "compacted")
    S.compact(spark, TRADES, _appended(spark, sf_dir, ("a", 0), ("b", 0)), target)
    return S.read_table(spark, TRADES, target)


@register("S9 T3", _ONCE)
def compacted_by_id_and_time(spark, sf_dir):
    """Rows near in id and time lie together, which changes no row."""
    target = shared_dir(spark, "compacted")
    source = _appended(spark, sf_dir, ("a", 0))
    S.compact(spark, TRADES, source, target, near=("trade_id", "event_time"))
    return S.read_table(spark, TRADES, target)


@register(
    "S9",
    f"""WITH {O.TICKER_1H} SELECT CAST(make_timestamp(event_time * 1000) AS DATE) AS event_date,
    count(*) AS ticks FROM ticker GROUP BY 1""",
)
def ticker_table_dates(spark, sf_dir):
    """The 1-hour ticker stored by date; the count needs no column of it."""
    path = shared_dir(spark, "ticker_1h")
    refresh_ticker(D.trades(spark, sf_dir), TICKER_1H, HOUR_MS, path, 0)
    stored = S.stored_rows(spark, TICKER_1H, path)
    return stored.groupBy("event_date").agg(F.count("*").alias("ticks"))


@register(
    "S9 K1 D1-D10",
    f"""WITH {O.TICKER_1D} SELECT event_time, symbol, price_change, price_change_percent,
    last_price, open_price, high_price, low_price, volume, total_trades FROM ticker""",
)
def ticker_table_in_two_runs(spark, sf_dir):
    """The first half of the month, then the second."""
    path = shared_dir(spark, "ticker_1d")
    trades = D.trades(spark, sf_dir)
    half = trades.where(F.col("event_time") < _MID_MONTH)
    refresh_ticker(half, TICKER_1D, DAY_MS, path, 0)
    refresh_ticker(trades, TICKER_1D, DAY_MS, path, 1, since=_MID_MONTH)
    return S.read_table(spark, TICKER_1D, path)


@register(
    "S9 K1 D1-D10",
    f"""WITH {O.TICKER_1D} SELECT event_time, symbol, price_change, price_change_percent,
    last_price, open_price, high_price, low_price, volume, total_trades FROM ticker""",
)
def ticker_table_from_slices(spark, sf_dir):
    """The first half of the month, six hours, the rest: each run after the first reads raw trades
    where its windows begin and end, and stored slices for what lies between."""
    path, slices = shared_dir(spark, "ticker_1d"), shared_dir(spark, "slices_1d")
    trades = D.trades(spark, sf_dir)
    since = None
    for run, until in enumerate((_MID_MONTH, _MID_MONTH + 6 * HOUR_MS, LAST_MS)):
        refresh_from_slices(trades, TICKER_1D, DAY_MS, path, slices, run, until, since)
        since = until
    return S.read_table(spark, TICKER_1D, path)


@register(
    "A3",
    f"""WITH {O.LINE_TRADES}, keys AS (
      SELECT trade_id, symbol, CASE WHEN min(price) < 1500 THEN 0 ELSE 1 END AS epoch
      FROM line_trades GROUP BY trade_id, symbol),
    parts AS (SELECT epoch, count(*) AS n FROM keys GROUP BY epoch)
    SELECT CAST(epoch AS BIGINT) AS epoch, n AS rows_inserted,
      CAST(sum(n) OVER (ORDER BY epoch) AS BIGINT) AS rows_inserted_total FROM parts""",
)
def rows_inserted(spark, sf_dir):
    """Cheap trades first, then all of them, which adds the other keys; a retry adds none.
    Counted from the zones, so the table is not read."""
    path = shared_dir(spark, "trades")
    rows = D.line_trades(spark, sf_dir)
    for epoch, batch in ((0, rows.where(F.col("price") < 1500)), (1, rows), (1, rows)):
        S.append_once(batch, TRADES, path, "a", epoch)
    return M.inserted_so_far(Z.rows_per_epoch(Z.read_zones(spark, TRADES, path))).drop("writer")


# --- market board -----------------------------------------------------------

_SYMBOL = "CLICK"
_LAST_DAYS = 1_706_400_000_000
_AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def _as_of() -> Column:
    return F.expr("timestamp_seconds(1706745600)")


def _hour(spark, sf_dir) -> DataFrame:
    return K.ticker_table(K.rolling_ticker(D.trades(spark, sf_dir), HOUR_MS))


def _day(spark, sf_dir) -> DataFrame:
    return K.ticker_table(K.rolling_ticker(D.trades(spark, sf_dir), DAY_MS))


def _latest_sql(ctes: str, value: str, extra: str = "") -> str:
    return f"""WITH {ctes} SELECT {value} AS value, {_AS_OF} AS time{extra} FROM ticker
    WHERE symbol = '{_SYMBOL}' ORDER BY event_time DESC LIMIT 1"""


def _timed(answer: DataFrame) -> DataFrame:
    return answer.withColumn("time", F.col("time").cast("timestamp_ntz"))


@register("T1 F1 P12 P14 P16 P19", _latest_sql(O.TICKER_1H, "round(last_price, 2)",
                                               ", 'gray' AS colour"))
def latest_price(spark, sf_dir):
    return _timed(market_board.price_now(_hour(spark, sf_dir), _SYMBOL, _as_of()))


_CLASS = """CASE WHEN price_change_percent >= 0 THEN 'green'
    WHEN price_change_percent < 0 THEN 'red' END"""


@register("T1 F1 P15", _latest_sql(O.TICKER_1H, "price_change_percent"))
def latest_change_pct_1h(spark, sf_dir):
    return _timed(
        L.latest_value(_hour(spark, sf_dir), _SYMBOL, "price_change_percent", _as_of())
    )


@register("T1 F1 P15", _latest_sql(O.TICKER_1D, "price_change_percent", f", {_CLASS} AS colour"))
def latest_change_pct_24h(spark, sf_dir):
    return _timed(market_board.change_1d(_day(spark, sf_dir), _SYMBOL, _as_of()))


@register("T1 F1", _latest_sql(O.TICKER_1D, "total_trades", ", 'gray' AS colour"))
def latest_total_trades(spark, sf_dir):
    return _timed(market_board.trade_count(_day(spark, sf_dir), _SYMBOL, _as_of()))


@register("T1 F1 S8 S9", _latest_sql(O.TICKER_1H, "last_price"))
def latest_price_from_table(spark, sf_dir):
    """From the stored ticker: the last days' folders are tried first."""
    path = shared_dir(spark, "ticker_1h")
    refresh_ticker(D.trades(spark, sf_dir), TICKER_1H, HOUR_MS, path, 0)
    stored = L.for_symbol(S.stored_rows(spark, TICKER_1H, path), _SYMBOL)
    near = L.newest_from(stored, 1, _LAST_DAYS)
    return _timed(L.latest_value(near, _SYMBOL, "last_price", _as_of()))


@register(
    "T1",
    f"""WITH {O.TICKER_1H} SELECT symbol, event_time, price_change, price_change_percent,
    last_price, open_price, high_price, low_price, volume, total_trades FROM ticker
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) = 1""",
)
def latest_per_symbol(spark, sf_dir):
    return L.latest_per_symbol(_hour(spark, sf_dir))


@register(
    "T2 T3",
    f"""WITH {O.TRADES} SELECT symbol, trade_id, event_time, CAST(price AS DOUBLE) AS price,
    CAST(quantity AS DOUBLE) AS quantity,
    row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC NULLS FIRST, trade_id DESC)
      AS place FROM trades QUALIFY place <= 100""",
)
def topn_per_symbol(spark, sf_dir):
    return L.last_n_per_symbol(D.served_trades(spark, sf_dir), 100, "trade_id").withColumn(
        "place", F.col("place").cast("bigint")
    )


@register(
    "T2 T3",
    f"""WITH {O.TRADES} SELECT symbol, trade_id,
    row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC NULLS FIRST, trade_id DESC)
      AS place FROM trades QUALIFY place <= 1500""",
)
def topn_per_symbol_salted(spark, sf_dir):
    rows = D.served_trades(spark, sf_dir).select("symbol", "trade_id", "event_time")
    return L.last_n_per_symbol(rows, 1500, "trade_id").select(
        "symbol", "trade_id", F.col("place").cast("bigint").alias("place")
    )


@register(
    "T2 F1 P10 P13",
    f"""WITH {O.TICKER_1H} SELECT {O.seconds("event_time")} AS time, last_price AS value
    FROM ticker WHERE symbol = '{_SYMBOL}' ORDER BY time DESC, event_time DESC LIMIT 500""",
)
def price_series_500(spark, sf_dir):
    return _timed(L.price_series(_hour(spark, sf_dir), _SYMBOL))


_RECENT = f"""WITH {O.TRADES} SELECT {O.seconds("event_time")} AS time, trade_id,
    CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
    CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE) AS notional
    FROM trades WHERE symbol = '{_SYMBOL}'
    ORDER BY time DESC NULLS FIRST, trade_id DESC LIMIT 100"""


@register(
    "T1 F1 P14 P15 P18 P19",
    _latest_sql(
        O.TICKER_1H,
        "coalesce(CAST(round(price_change_percent, 2) AS VARCHAR), 'No data')",
        f", {_CLASS} AS colour",
    ),
)
def panel_change_1h(spark, sf_dir):
    return _timed(market_board.change_1h(_hour(spark, sf_dir), _SYMBOL, _as_of()))


@register(
    "T2 F1 P10 P13 P14 P19",
    f"""WITH {O.TICKER_1H} SELECT {O.seconds("event_time")} AS time,
    round(last_price, 2) AS "Aktueller Kurswert {_SYMBOL} in USD"
    FROM ticker WHERE symbol = '{_SYMBOL}' ORDER BY time DESC, event_time DESC LIMIT 500""",
)
def panel_price_chart(spark, sf_dir):
    return _timed(market_board.price_chart(_hour(spark, sf_dir), _SYMBOL))


@register(
    "T3 F1 P10 P11 P13 P14 P19",
    f"""WITH {O.TRADES} SELECT {O.seconds("event_time")} AS "Timestamp", trade_id AS "Trade ID",
    round(CAST(price AS DOUBLE), 2) AS "Aktueller Kurswert (USD)",
    CAST(quantity AS DOUBLE) AS "Menge",
    round(CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE), 2) AS "Gesamtwert (USD)"
    FROM trades WHERE symbol = '{_SYMBOL}'
    ORDER BY 1 DESC NULLS FIRST, trade_id DESC LIMIT 100""",
)
def panel_recent_trades(spark, sf_dir):
    rows = market_board.recent_trades(D.served_trades(spark, sf_dir), _SYMBOL)
    return rows.withColumn("Timestamp", F.col("Timestamp").cast("timestamp_ntz"))


@register("F2 T3 F1 P13 S8", REGISTRY["panel_recent_trades"].oracle)
def board_recent_trades(spark, sf_dir):
    """A panel of the whole board, which takes its symbol out of a list."""
    hour, day = _hour(spark, sf_dir), _day(spark, sf_dir)
    tables = {"trades": D.served_trades(spark, sf_dir), "ticker_1h": hour, "ticker_1d": day}
    board = market_board.market_board(tables, _SYMBOL, _as_of(), choices=D.SYMBOLS)
    return board["recent_trades"].withColumn("Timestamp", F.col("Timestamp").cast("timestamp_ntz"))


@register("T3 F1 P10 P11", _RECENT)
def recent_trades_100(spark, sf_dir):
    return _timed(L.recent_trades(D.served_trades(spark, sf_dir), _SYMBOL))


@register("S3 S4 P1-P11 K1 K2 F1 T3", _RECENT)
def last_trades_from_messages(spark, sf_dir):
    """From messages to the last trades: decode, set bad rows aside, first write
    wins, newest hundred with their value."""
    messages = D.trade_messages(D.trades(spark, sf_dir))
    rows = Q.usable(read_messages(messages, TRADES), TRADES)
    table = to_table_types(Q.first_per_key(rows, TRADES.key), TRADES)
    return _timed(L.recent_trades(table, _SYMBOL))


@register("F1 P13 S8", _RECENT)
def recent_trades_sql(spark, sf_dir):
    """The panel as SQL text with a bound parameter."""
    S.register_views(spark, {"trades": D.served_trades(spark, sf_dir)})
    return _timed(market_board.panel_sql(spark, "recent_trades", _SYMBOL))


@register("T3 F1 P10 P11", _RECENT)
def recent_trades_since(spark, sf_dir):
    """From a time inside a second on, where that holds enough rows."""
    rows = L.for_symbol(D.served_trades(spark, sf_dir), _SYMBOL)
    return _timed(L.recent_trades(L.newest_from(rows, 100, _LAST_DAYS + 500), _SYMBOL))


def _sql_panel(panel: str, ids: str, oracle: str) -> None:
    """Registers a panel as SQL text with a bound parameter; its query time is left out."""

    def run(spark, sf_dir):
        S.register_views(spark, {"ticker_1h": _hour(spark, sf_dir), "ticker_1d": _day(spark, sf_dir)})
        answer = market_board.panel_sql(spark, panel, _SYMBOL)
        return _timed(answer) if panel == "price_chart" else answer.drop("time")

    run.__name__ = f"sql_{panel}"
    register(ids, oracle)(run)


def _newest_value_sql(ctes: str, column: str) -> str:
    return f"""WITH {ctes} SELECT {column} AS value FROM ticker WHERE symbol = '{_SYMBOL}'
    ORDER BY event_time DESC LIMIT 1"""


_sql_panel(
    "price_chart",
    "T2 F1 P10 S8",
    f"""WITH {O.TICKER_1H} SELECT {O.seconds("event_time")} AS time, last_price AS value
    FROM ticker WHERE symbol = '{_SYMBOL}' ORDER BY time DESC, event_time DESC LIMIT 500""",
)
_sql_panel("price_now", "T1 F1 S8", _newest_value_sql(O.TICKER_1H, "last_price"))
_sql_panel("change_1h", "T1 F1 S8", _newest_value_sql(O.TICKER_1H, "price_change_percent"))
_sql_panel("change_1d", "T1 F1 S8", _newest_value_sql(O.TICKER_1D, "price_change_percent"))
_sql_panel("trade_count", "T1 F1 S8", _newest_value_sql(O.TICKER_1D, "total_trades"))
for _panel_name, _value in (("low", "min(low_price)"), ("high", "max(high_price)")):
    _sql_panel(
        _panel_name,
        "A1 A2 F1 S8",
        f"WITH {O.TICKER_1D} SELECT {_value} AS value FROM ticker WHERE symbol = '{_SYMBOL}'",
    )


def _extreme_sql(expression: str, colour: str, where: str = "") -> str:
    return f"""WITH {O.TICKER_1D} SELECT round({expression}, 2) AS value, {_AS_OF} AS time,
    '{colour}' AS colour FROM ticker WHERE symbol = '{_SYMBOL}'{where}"""


@register("A1 F1 P12 P14 P16", _extreme_sql("min(low_price)", "red"))
def low_all(spark, sf_dir):
    return _timed(market_board.low(_day(spark, sf_dir), _SYMBOL, _as_of()))


@register("A2 F1 P12 P14 P16", _extreme_sql("max(high_price)", "green"))
def high_all(spark, sf_dir):
    return _timed(market_board.high(_day(spark, sf_dir), _SYMBOL, _as_of()))


# --- the board from stored tables, by their zones ---------------------------


def _stored_day(spark, sf_dir) -> str:
    """The 24-hour ticker, stored in two runs, the second of which is repeated."""
    path = shared_dir(spark, "ticker_1d")
    trades = D.trades(spark, sf_dir)
    first = K.ticker_table(K.rolling_ticker(trades, DAY_MS))
    for run, ticks in enumerate((first.where(F.col("event_time") < _MID_MONTH), first)):
        S.append_once(staged(ticks, "ticks"), TICKER_1D, path, "refresh", run)
    return path


@register("A1 F1 P12 P14 P16 S5", _extreme_sql("min(low_price)", "red"))
def low_all_stored(spark, sf_dir):
    """From one zone per date, run and symbol."""
    zones = Z.read_zones(spark, TICKER_1D, _stored_day(spark, sf_dir))
    return _timed(market_board.stat_of_extreme(Z.lowest(zones, _SYMBOL, _as_of()), "red"))


@register("A2 F1 P12 P14 P16 S5", _extreme_sql("max(high_price)", "green"))
def high_all_stored(spark, sf_dir):
    zones = Z.read_zones(spark, TICKER_1D, _stored_day(spark, sf_dir))
    return _timed(market_board.stat_of_extreme(Z.highest(zones, _SYMBOL, _as_of()), "green"))


@register("T1 F1 P15 S5", _latest_sql(O.TICKER_1D, "price_change_percent", f", {_CLASS} AS colour"))
def latest_change_pct_24h_stored(spark, sf_dir):
    """Reads the last date's folder."""
    path = _stored_day(spark, sf_dir)
    near = Z.newest(spark, TICKER_1D, path, _SYMBOL, 1)
    return _timed(market_board.change_1d(near, _SYMBOL, _as_of()))


@register("T1 S5", REGISTRY["latest_per_symbol"].oracle)
def latest_per_symbol_stored(spark, sf_dir):
    path = shared_dir(spark, "ticker_1h")
    refresh_ticker(D.trades(spark, sf_dir), TICKER_1H, HOUR_MS, path, 0)
    return Z.latest_per_symbol(spark, TICKER_1H, path)


@register("T2 F1 P10 P13 S5", REGISTRY["price_series_500"].oracle)
def price_series_500_stored(spark, sf_dir):
    """Reads the dates from which on zones count five hundred rows."""
    path = shared_dir(spark, "ticker_1h")
    refresh_ticker(D.trades(spark, sf_dir), TICKER_1H, HOUR_MS, path, 0)
    return _timed(L.price_series(Z.newest(spark, TICKER_1H, path, _SYMBOL, 500), _SYMBOL))


@register("T3 F1 P10 P11 S5 S8", _RECENT)
def recent_trades_stored(spark, sf_dir):
    """Two epochs of trades, a replay of the first, compacted; then the newest by zones."""
    path, compacted = shared_dir(spark, "trades"), shared_dir(spark, "compacted")
    trades = D.served_trades(spark, sf_dir)
    early = trades.where(F.col("event_time") < _MID_MONTH)
    for writer, epoch, rows in (("a", 0, early), ("a", 1, trades), ("b", 0, early)):
        S.append_once(rows, TRADES, path, writer, epoch)
    S.compact(spark, TRADES, path, compacted)
    return _timed(L.recent_trades(Z.newest(spark, TRADES, compacted, _SYMBOL, 100), _SYMBOL))


_SINCE = 1_706_000_000_000


@register("A1 F5", _extreme_sql("min(low_price)", "red", f" AND event_time >= {_SINCE}"))
def low_since(spark, sf_dir):
    return _timed(market_board.low(_day(spark, sf_dir), _SYMBOL, _as_of(), since=_SINCE))


@register(
    "P14 P15",
    f"""WITH {O.TICKER_1H} SELECT symbol, event_time, round(last_price, 2) AS last_price,
    {_CLASS} AS colour FROM ticker""",
)
def ticker_change_class(spark, sf_dir):
    return _hour(spark, sf_dir).select(
        "symbol",
        "event_time",
        shown(F.col("last_price")).alias("last_price"),
        change_class(F.col("price_change_percent")).alias("colour"),
    )


@register(
    "P18",
    f"""WITH {O.TRADES} SELECT coalesce(CAST(max(trade_id) AS VARCHAR), 'No data') AS value
    FROM trades WHERE symbol = 'SILENT'""",
)
def no_data_default(spark, sf_dir):
    newest = L.latest_value(D.trades(spark, sf_dir), "SILENT", "trade_id", _as_of())
    return or_no_data(newest.select("value"), "value")


@register(
    "P10",
    f"""WITH {O.TRADES} SELECT trade_id, {O.seconds("event_time")} AS at_seconds,
    make_timestamp(event_time * 1000) AS at_millis FROM trades""",
)
def epoch_times(spark, sf_dir):
    return D.trades(spark, sf_dir).select(
        "trade_id",
        L.seconds_time("event_time").cast("timestamp_ntz").alias("at_seconds"),
        millis_time("event_time").cast("timestamp_ntz").alias("at_millis"),
    )


# --- tickers from trades ----------------------------------------------------

_ALL_TICKER = "SELECT * FROM ticker"


@register("D1-D10", f"WITH {O.TICKER_1H} {_ALL_TICKER}")
def rolling_ticker_1h(spark, sf_dir):
    return K.rolling_ticker(D.trades(spark, sf_dir), HOUR_MS)


@register("D1-D10", f"WITH {O.TICKER_1D} {_ALL_TICKER}")
def rolling_ticker_24h(spark, sf_dir):
    return K.rolling_ticker(D.trades(spark, sf_dir), DAY_MS)


@register("D1-D10", f"WITH {O.TRADES}, {O.rolling(7 * DAY_MS)} {_ALL_TICKER}")
def rolling_ticker_7d(spark, sf_dir):
    return K.rolling_ticker(D.trades(spark, sf_dir), 7 * DAY_MS)


@register("D11", O.hopping(DAY_MS, HOUR_MS))
def hopping_ticker(spark, sf_dir):
    windows = K.hopping_ticker(D.trades(spark, sf_dir), DAY_MS, HOUR_MS)
    return _windows_plain(windows)


def _windows_plain(windows: DataFrame) -> DataFrame:
    for name in ("window_start", "window_end"):
        windows = windows.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return windows


# --- streams ----------------------------------------------------------------

_NOW = {"availableNow": True}


#: Messages in a file, at most: what one task of a stream reads does not grow with the input.
_FILE_MESSAGES = 200_000


def _message_files(messages: DataFrame, purpose: str, fewest: int = 6) -> str:
    """Messages as text files, one message per line.

    Each task writes its own, none of many messages.  Input that fills few files is spread
    over some more, so that a stream has several batches.
    """
    spark = messages.sparkSession
    path = shared_dir(spark, purpose)
    lines = messages.select(F.col("value").cast("string").alias("value"))
    lines.write.option("maxRecordsPerFile", _FILE_MESSAGES).text(path)
    if len(spark.read.text(path).inputFiles()) >= fewest:
        return path
    path = shared_dir(spark, purpose)
    lines.repartition(fewest).write.text(path)
    return path


def _message_stream(spark, path: str) -> DataFrame:
    """The files as a stream of about three batches, none of more than 1000 files."""
    files = len(spark.read.text(path).inputFiles())
    return text_stream(spark, path, max_files=max(1, min(1000, files // 3)))


def _ingested(spark, messages: DataFrame, replays: int = 0) -> tuple[str, str]:
    """Stream the messages into a table; paths of table and quarantine."""
    files = _message_files(messages, "topic")
    table, quarantine = shared_dir(spark, "table"), shared_dir(spark, "quarantine")
    S.create_table(spark, TRADES, table)
    for _ in range(1 + replays):
        query = I.start_ingest(
            _message_stream(spark, files),
            TRADES,
            I.parquet_sink(TRADES, table),
            quarantine,
            shared_dir(spark, "checkpoint"),
            _NOW,
        )
        query.awaitTermination()
    return table, quarantine


@register(
    "S1 S6 ST1-ST6",
    f"""WITH {O.TRADES} SELECT trade_id, symbol, event_time, CAST(price AS DOUBLE) AS price,
    CAST(quantity AS DOUBLE) AS quantity FROM trades""",
)
def decode_stream(spark, sf_dir):
    table, _ = _ingested(spark, D.trade_messages(D.trades(spark, sf_dir)))
    return S.read_table(spark, TRADES, table)


@register(
    "S6 K1 ST5",
    f"WITH {O.LINE_TRADES} SELECT DISTINCT trade_id, symbol FROM line_trades",
)
def dedup_stream(spark, sf_dir):
    """Repeated keys over several epochs, then all of it again under a new
    checkpoint: each key is stored once."""
    table, _ = _ingested(spark, D.trade_messages(D.line_trades(spark, sf_dir)), replays=1)
    return S.read_table(spark, TRADES, table).select("trade_id", "symbol")


@register(
    "S6 K2",
    f"""SELECT outcome AS reason, CAST(sum(messages) AS BIGINT) AS messages FROM (
      SELECT 'null_key' AS outcome, count(*) AS messages FROM events
      UNION ALL SELECT 'bad_number', count(*) FROM orders) GROUP BY outcome""",
)
def quarantine_stream(spark, sf_dir):
    """Good and bad one-line messages in one stream."""
    events = D.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    orders = D.table(spark, sf_dir, "orders").select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("t"),
                F.col("o_orderstatus").alias("s"),
                F.col("o_orderpriority").alias("p"),
            )
        ).alias("value")
    )
    good = D.trade_messages(D.trades(spark, sf_dir)).select(F.col("value").cast("string"))
    _, quarantine = _ingested(spark, fan_in([good.toDF("value"), events, orders]))
    bad = S.read_quarantine(spark, quarantine)
    return bad.groupBy("reason").agg(F.count("*").alias("messages"))


@register(
    "S1 S6 P1 K2",
    f"""SELECT outcome AS reason, CAST(sum(messages) AS BIGINT) AS messages FROM ({_MIXED})
    WHERE outcome <> 'good' GROUP BY outcome""",
)
def quarantine_whole_stream(spark, sf_dir):
    """Messages of every kind in one stream, those of several lines and empty ones as well: kept
    as bytes in Parquet files, which text files of a message per line could not hold."""
    files = shared_dir(spark, "messages")
    mixed = D.mixed_messages(spark, sf_dir).select(F.col("value").cast("binary").alias("value"))
    mixed.write.parquet(files)
    table, quarantine = shared_dir(spark, "table"), shared_dir(spark, "quarantine")
    S.create_table(spark, TRADES, table)
    stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 8).parquet(files)
    sink, checkpoint = I.parquet_sink(TRADES, table), shared_dir(spark, "checkpoint")
    I.start_ingest(stream, TRADES, sink, quarantine, checkpoint, _NOW).awaitTermination()
    return S.read_quarantine(spark, quarantine).groupBy("reason").agg(F.count("*").alias("messages"))


@register("K1", f"WITH {O.LINE_TRADES} SELECT DISTINCT trade_id, symbol FROM line_trades")
def dedup_watermark_stream(spark, sf_dir):
    """First write wins inside the stream; the delay spans the whole input."""
    files = _message_files(D.trade_messages(D.line_trades(spark, sf_dir)), "topic")
    rows = Q.usable(read_messages(_message_stream(spark, files), TRADES), TRADES)
    keys = Q.drop_late_copies(
        rows.withColumn("ts", millis_time("event_time")), TRADES.key, "ts", "4000 days"
    )
    out = shared_dir(spark, "keys")
    query = (
        keys.select("trade_id", "symbol")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(**_NOW)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("trade_id bigint, symbol string").parquet(out)


@register(
    "S2 S6 ST1 A3",
    f"""WITH {O.TRADES}, ticks AS (SELECT DISTINCT symbol, event_time FROM trades)
    SELECT 'trades' AS table_name, count(*) AS row_count FROM trades
    UNION ALL SELECT 'ticker_1h', count(*) FROM ticks
    UNION ALL SELECT 'ticker_1d', count(*) FROM ticks""",
)
def three_topics_stream(spark, sf_dir):
    """Three queries side by side, each from its topic to its table."""
    trades = D.trades(spark, sf_dir)
    topics = {
        TRADES: D.trade_messages(trades),
        TICKER_1H: D.rolling_messages(K.rolling_ticker(trades, HOUR_MS)),
        TICKER_1D: D.rolling_messages(K.rolling_ticker(trades, DAY_MS)),
    }
    tables, running = {}, []
    for spec, messages in topics.items():
        files = _message_files(messages, spec.name)
        path = shared_dir(spark, spec.name)
        S.create_table(spark, spec, path)
        query = I.start_ingest(
            _message_stream(spark, files),
            spec,
            I.parquet_sink(spec, path),
            shared_dir(spark, "quarantine"),
            shared_dir(spark, "checkpoint"),
            _NOW,
        )
        running.append(query)
        tables[spec.name] = (spec, path)
    for query in running:
        query.awaitTermination()
    stored = {name: S.read_table(spark, spec, path) for name, (spec, path) in tables.items()}
    return M.rows_per_table(stored)


@register("D11 ST1-ST6", O.hopping(DAY_MS, 6 * HOUR_MS))
def hopping_ticker_stream(spark, sf_dir):
    files = _message_files(D.trade_messages(D.trades(spark, sf_dir)), "topic")
    rows = Q.usable(read_messages(_message_stream(spark, files), TRADES), TRADES)
    windows = K.hopping_ticker_stream(rows, "24 hours", "6 hours", "40 days")
    out = shared_dir(spark, "hopping")
    I.start_versions(windows, out, shared_dir(spark, "checkpoint"), _NOW).awaitTermination()
    last = I.last_versions(spark.read.parquet(out), "window_start", "window_end", "symbol")
    return _windows_plain(last)


_CLOSED_WHERE = f"""
WHERE (start * {6 * HOUR_MS} + {DAY_MS}) <= (SELECT max(event_time) FROM trades) - {2 * HOUR_MS}"""


@register("D11 ST1-ST6", O.hopping(DAY_MS, 6 * HOUR_MS) + _CLOSED_WHERE)
def hopping_ticker_closed_stream(spark, sf_dir):
    """Windows that a watermark of two hours has closed.

    The first run reads half a month; the second the rest and, once more, the trades up to a day
    before that half month's end, which are late by then and left out.  Each run is one batch, as
    the messages of a run are not in the order of time.
    """
    trades = D.trades(spark, sf_dir)
    inbox, checkpoint = shared_dir(spark, "topic"), shared_dir(spark, "checkpoint")
    out = shared_dir(spark, "closed")
    time = F.col("event_time")
    for rows in (
        trades.where(time < _MID_MONTH),
        trades.where((time >= _MID_MONTH) | (time < _MID_MONTH - DAY_MS)),
    ):
        lines = D.trade_messages(rows).select(F.col("value").cast("string").alias("value"))
        lines.write.mode("append").text(inbox)
        messages = Q.usable(read_messages(text_stream(spark, inbox), TRADES), TRADES)
        windows = K.closed_windows_stream(messages, DAY_MS, 6 * HOUR_MS, "2 hours")
        I.start_closed(windows, out, checkpoint, _NOW).awaitTermination()
    return _windows_plain(spark.read.schema(windows.schema).parquet(out))


@register(
    "K2 P5 D6 L6",
    f"""WITH {O.TRADES}, {O.LINE_TRADES} SELECT * FROM (
      SELECT 'priced' AS step, 'seen' AS what, count(*) AS n FROM trades
      UNION ALL SELECT 'priced', 'no_time', count(*) FROM trades WHERE symbol = 'VIEW'
      UNION ALL SELECT 'priced', 'no_price', count(*) FROM trades WHERE symbol = 'ERROR'
      UNION ALL SELECT 'priced', 'no_quantity', 0
      UNION ALL SELECT 'logs', 'seen', 2 * count(*) FROM documents
      UNION ALL SELECT 'logs', 'unparsed', count(*) + count(*) FILTER (text IS NULL) FROM documents
      UNION ALL SELECT 'logs', 'without_time', count(*) FROM documents
      UNION ALL SELECT 'copies', 'seen', count(*) FROM line_trades
      UNION ALL SELECT 'copies', 'kept', count(*) FROM (SELECT DISTINCT trade_id, symbol FROM line_trades))""",
)
def rows_left_out(spark, sf_dir):
    """What three steps leave out, reported by the rows on their way."""
    of = {"priced": Observation(), "logs": Observation()}
    symbol = F.col("symbol")
    trades = D.trades(spark, sf_dir).withColumns(
        {
            "event_time": F.when(symbol != "VIEW", F.col("event_time")),
            "price": F.when(symbol != "ERROR", F.col("price")),
        }
    )
    K.priced(trades, of["priced"]).write.format("noop").mode("overwrite").save()
    records = D.log_records(spark, sf_dir)
    texts = D.table(spark, sf_dir, "documents").select(F.col("text").alias("value"), F.lit("").alias("path"))
    shaped = G.shape_logs(records.unionByName(texts), observed=of["logs"])
    shaped.write.format("noop").mode("overwrite").save()
    files = _message_files(D.trade_messages(D.line_trades(spark, sf_dir)), "topic")
    rows = Q.usable(read_messages(_message_stream(spark, files), TRADES), TRADES)
    timed = rows.withColumn("ts", millis_time("event_time"))
    keys = Q.drop_late_copies(timed, TRADES.key, "ts", "4000 days", "copies")
    query = I.start_closed(keys, shared_dir(spark, "keys"), shared_dir(spark, "checkpoint"), _NOW)
    query.awaitTermination()
    numbers = {step: o.get for step, o in of.items()}
    numbers["copies"] = I.reported(query, "copies")
    numbers["copies"]["kept"] = I.reported(query, "copies kept")["seen"]
    found = [(step, what, n) for step, figures in numbers.items() for what, n in figures.items()]
    return spark.createDataFrame(found, "step string, what string, n bigint")


# --- operations -------------------------------------------------------------


def _messages(spark, sf_dir) -> DataFrame:
    return D.trade_messages(D.trades(spark, sf_dir))


def _by_event_type(spark, sf_dir) -> DataFrame:
    """The same messages, one topic per symbol."""
    return _messages(spark, sf_dir).withColumn("topic", F.col("symbol"))


@register(
    "A4",
    f"""WITH {O.MESSAGES} SELECT date_trunc('minute', ts) AS window_start, symbol AS topic,
    count(*) / 60.0::DOUBLE AS msgs_per_sec_1m FROM messages GROUP BY 1, 2""",
)
def msgs_per_sec_1m(spark, sf_dir):
    rates = M.messages_per_second(_by_event_type(spark, sf_dir))
    return rates.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register(
    "A4",
    f"""WITH {O.MESSAGES}, ticks AS (
      SELECT symbol AS topic, epoch_us(ts) // 5000000 AS tick, count(*) AS n
      FROM messages GROUP BY 1, 2), weighed AS (
      SELECT topic, tick, n / 5.0::DOUBLE * CASE
        WHEN tick = min(tick) OVER (PARTITION BY topic) THEN 1 ELSE 1 - exp(-1 / 12.0::DOUBLE) END AS rate
      FROM ticks), minutes AS (SELECT DISTINCT topic, tick // 12 AS minute FROM ticks)
    SELECT m.topic, make_timestamp(m.minute * 60000000) AS window_start,
      round(sum(w.rate * exp((w.tick - m.minute * 12 - 11) / 12.0::DOUBLE)), 9) AS one_minute_rate
    FROM minutes m JOIN weighed w ON w.topic = m.topic AND w.tick <= m.minute * 12 + 11
    GROUP BY m.topic, m.minute""",
)
def decayed_rate(spark, sf_dir):
    rates = M.decayed_rate(_by_event_type(spark, sf_dir))
    return rates.select(
        "topic", *_plain("window_start"), F.round("one_minute_rate", 9).alias("one_minute_rate")
    )


@register(
    "A4 ST1-ST6",
    f"""WITH {O.MESSAGES} SELECT date_trunc('minute', ts) AS window_start, topic,
    count(*) / 60.0::DOUBLE AS msgs_per_sec_1m FROM messages GROUP BY 1, 2""",
)
def msgs_per_sec_stream(spark, sf_dir):
    """The rate of a stream, by the execution time in the message."""
    files = _message_files(_messages(spark, sf_dir), "topic")
    rows = Q.usable(read_messages(_message_stream(spark, files), TRADES), TRADES)
    arrived = rows.select(
        F.lit(TRADES.topic).alias("topic"),
        F.col("symbol").alias("value"),
        millis_time("event_time").alias("ts"),
    ).withWatermark("ts", "40 days")
    out = shared_dir(spark, "rates")
    rates = M.messages_per_second(arrived)
    I.start_versions(rates, out, shared_dir(spark, "checkpoint"), _NOW).awaitTermination()
    last = I.last_versions(spark.read.parquet(out), "window_start", "topic")
    return last.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register(
    "A5",
    f"""WITH {O.MESSAGES} SELECT date_trunc('minute', ts) AS window_start, symbol AS topic,
    CAST(sum(strlen(value)) AS BIGINT) / 60.0::DOUBLE AS bytes_per_sec_1m
    FROM messages GROUP BY 1, 2""",
)
def bytes_in_1m(spark, sf_dir):
    rates = M.bytes_per_second(_by_event_type(spark, sf_dir))
    return rates.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register(
    "A5 A6",
    f"""WITH {O.MESSAGES}, minutes AS (
      SELECT symbol AS topic, date_trunc('minute', ts) AS window_start, count(*) AS n,
        sum(strlen(value)) AS b FROM messages GROUP BY 1, 2)
    SELECT topic, window_start,
      CAST(sum(n) OVER (PARTITION BY topic ORDER BY window_start) AS BIGINT) AS messages_total,
      CAST(sum(b) OVER (PARTITION BY topic ORDER BY window_start) AS BIGINT) AS bytes_total
    FROM minutes""",
)
def running_totals(spark, sf_dir):
    totals = M.running_totals(_by_event_type(spark, sf_dir))
    return totals.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register(
    "A5 A6",
    f"""WITH {O.MESSAGES} SELECT topic, count(*) AS messages_total,
    CAST(sum(strlen(value)) AS BIGINT) AS bytes_total FROM messages GROUP BY topic""",
)
def messages_per_topic(spark, sf_dir):
    return M.messages_per_topic(_messages(spark, sf_dir))


_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@register(
    "A3",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES
    ),
)
def rows_per_table(spark, sf_dir):
    return M.rows_per_table({t: D.table(spark, sf_dir, t) for t in _TABLES})


def _last_event(spark, sf_dir) -> Column:
    """The newest event time as a literal, so that range filters reach the scan."""
    newest = D.table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp").alias("ts"))
    micros = newest.select(F.unix_micros("ts").alias("us")).first().us
    return F.timestamp_micros(F.lit(micros))


@register(
    "A8 F5",
    """SELECT s.source, CAST(count(e.event_id) > 0 AS INTEGER) AS is_live
    FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('silent')) s(source)
    LEFT JOIN (SELECT * FROM events
      WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE) e ON e.event_type = s.source
    GROUP BY s.source""",
)
def liveness(spark, sf_dir):
    sources = [s.lower() for s in D.SYMBOLS] + ["silent"]
    # The column keeps the type it has in the file; a cast would hide it from the scan.
    as_of = _last_event(spark, sf_dir).cast("timestamp_ntz")
    return M.liveness(D.table(spark, sf_dir, "events"), sources, as_of, "event_type", "ts")


@register(
    "A8",
    """WITH e AS (SELECT event_type AS source, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS heard FROM events)
    SELECT source, ts + INTERVAL 5 MINUTE AS down_from, heard AS down_until FROM e
    WHERE heard > ts + INTERVAL 5 MINUTE
      OR (heard IS NULL AND ts + INTERVAL 5 MINUTE < (SELECT max(ts) FROM events))""",
)
def outages(spark, sf_dir):
    """When each event type was silent for more than five minutes."""
    as_of = _last_event(spark, sf_dir).cast("timestamp_ntz")
    down = M.outages(D.table(spark, sf_dir, "events"), as_of, "event_type", "ts")
    return down.select("source", *_plain("down_from", "down_until"))


@register("A7", "SELECT DISTINCT event_type AS label_value FROM events")
def label_values(spark, sf_dir):
    return M.label_values(D.table(spark, sf_dir, "events"), "event_type")


def _samples(spark, sf_dir) -> DataFrame:
    """Message rates of the last minutes, liveness and row counts as metric samples."""
    as_of = _last_event(spark, sf_dir)
    arrived = M.whole_minutes(D.table(spark, sf_dir, "events"), as_of)
    rates = M.as_samples(
        M.messages_per_second(D.trade_messages(D.as_trades(arrived))),
        ops_board.MESSAGES_IN,
        "msgs_per_sec_1m",
        F.col("window_start"),
        topic=F.lit(TRADES.topic),
    )
    up = M.as_samples(
        liveness(spark, sf_dir), ops_board.UP, "is_live", as_of, job=F.col("source")
    )
    rows = M.as_samples(
        M.rows_per_table({"trades": D.trades(spark, sf_dir)}),
        ops_board.ROWS_INSERTED,
        "row_count",
        as_of,
        datname="market",
        relname=F.col("table_name"),
        schemaname="public",
    )
    return fan_in([rates, up, rows])


def _panel(spark, sf_dir, metric: str, **labels: str) -> DataFrame:
    panel = ops_board.metric_panel(
        _samples(spark, sf_dir), metric, _last_event(spark, sf_dir), **labels
    )
    return panel.select("metric", "value", "colour")


@register(
    "F3 F5 P17 A8",
    """SELECT 'up' AS metric, 1.0::DOUBLE AS value, 'green' AS colour FROM (
      SELECT max(ts) AS ts, max(ts) FILTER (event_type = 'click') AS click FROM events)
    WHERE click >= ts - INTERVAL 5 MINUTE
    UNION ALL SELECT 'up', 0.0::DOUBLE, 'red' FROM (
      SELECT max(ts) AS ts, max(ts) FILTER (event_type = 'click') AS click FROM events)
    WHERE click < ts - INTERVAL 5 MINUTE""",
)
def panel_up(spark, sf_dir):
    return _panel(spark, sf_dir, ops_board.UP, job="click")


@register(
    "F3 F5 P17 A4",
    """SELECT 'kafka_server_messages_in_per_sec' AS metric, n / 60.0::DOUBLE AS value,
    CASE WHEN n >= 60 THEN 'green' ELSE 'red' END AS colour FROM (
      SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM events
      WHERE date_trunc('minute', ts) >= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE
      GROUP BY 1 ORDER BY 1 DESC LIMIT 1)""",
)
def panel_messages(spark, sf_dir):
    return _panel(spark, sf_dir, ops_board.MESSAGES_IN, topic=TRADES.topic)


@register(
    "F3 F5 P17 A3",
    """SELECT 'pg_stat_user_tables_n_tup_ins' AS metric, CAST(count(*) AS DOUBLE) AS value,
    CASE WHEN count(*) >= 1 THEN 'green' ELSE 'red' END AS colour FROM events""",
)
def panel_rows(spark, sf_dir):
    return _panel(
        spark, sf_dir, ops_board.ROWS_INSERTED,
        datname="market", relname="trades", schemaname="public",
    )


@register(
    "F3 F5 P17 P19 A3 A4",
    f"""SELECT 'messages binance.trades' AS panel, 'short' AS unit, * FROM ({REGISTRY["panel_messages"].oracle})
    UNION ALL SELECT 'rows trades', 'none', * FROM ({REGISTRY["panel_rows"].oracle})""",
)
def ops_panels(spark, sf_dir):
    """All metric panels at once."""
    board = ops_board.metric_panels(_samples(spark, sf_dir), "market", _last_event(spark, sf_dir))
    return board.select("panel", "unit", "metric", "value", "colour")


@register("A7 F3", "SELECT 'market' AS label_value FROM events GROUP BY 1")
def panel_databases(spark, sf_dir):
    return ops_board.databases(_samples(spark, sf_dir))


# --- logs -------------------------------------------------------------------


@register("L1-L6", f"WITH {O.LOGS} SELECT * FROM logs")
def log_shape(spark, sf_dir):
    lines = G.shape_logs(D.log_records(spark, sf_dir)).drop("time_text")
    return lines.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _last_log(spark, sf_dir) -> Column:
    """The time of the newest log record, as a literal."""
    newest = D.table(spark, sf_dir, "documents").agg(F.max("doc_id").alias("id")).first().id
    return F.timestamp_micros(F.lit((D.LOG_START_SECONDS + newest) * 1_000_000 + 123_456))


_TAIL = f"""WITH {O.LOGS} SELECT ts, line, container_id, compose_service FROM logs
    WHERE ts >= (SELECT max(ts) FROM logs) - INTERVAL 5 MINUTE"""


def _tail_columns(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "line", "container_id", "compose_service")


@register("F4 F5 T4", _TAIL)
def log_tail_5m(spark, sf_dir):
    lines = G.shape_logs(D.log_records(spark, sf_dir))
    return _tail_columns(G.tail(lines, _last_log(spark, sf_dir)))


_CONTAINER_FOLDER = r"/container=(.{12})[^/]*/"


def _log_folders(spark, sf_dir) -> str:
    """Log files, a folder for each container; a pattern of their paths."""
    return _add_logs(D.log_records(spark, sf_dir), shared_dir(spark, "containers"))


def _add_logs(records: DataFrame, folder: str) -> str:
    container = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("container")
    files = records.select("value", container).hint("rebalance", "container").write
    files.mode("append").partitionBy("container").text(folder)
    return f"{folder}/*/*"


@register("S10 L1-L6", f"WITH {O.LOGS} SELECT * FROM logs")
def log_files_shape(spark, sf_dir):
    """Log files read by a path pattern."""
    records = log_files(spark, _log_folders(spark, sf_dir))
    lines = G.shape_logs(records, container_path=_CONTAINER_FOLDER).drop("time_text")
    return lines.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("S10 ST7 L1-L6", f"WITH {O.LOGS} SELECT * FROM logs")
def log_lines_by_offset(spark, sf_dir):
    """Log files read up to a byte each, then more of them by the same query: each line once."""
    folder, table = shared_dir(spark, "containers"), shared_dir(spark, "log_lines")
    checkpoint = shared_dir(spark, "checkpoint")
    records = D.log_records(spark, sf_dir)
    early = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part in (records.where(early), records.where(~early)):
        found = growing_log_stream(spark, _add_logs(part, folder))
        lines = G.shape_logs(found, container_path=_CONTAINER_FOLDER)
        I.start_log_ingest(lines, table, checkpoint, _NOW).awaitTermination()
    stored = read_lines(spark, table).drop("time_text", "log_date", "log_hour", "writer", "epoch")
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("S10 ST7 F4 F5 T4 L1-L6", _TAIL)
def log_table_tail(spark, sf_dir):
    """Log files through a stream into the table of lines, then its last minutes."""
    records = log_stream(spark, _log_folders(spark, sf_dir))
    table = shared_dir(spark, "log_lines")
    lines = G.shape_logs(records, container_path=_CONTAINER_FOLDER)
    I.start_log_ingest(lines, table, shared_dir(spark, "checkpoint"), _NOW).awaitTermination()
    return _tail_columns(G.tail(read_lines(spark, table), _last_log(spark, sf_dir)))
