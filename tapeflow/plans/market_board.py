"""The market board: eight panels over the serving tables, for one symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.contracts import DEFAULT_SYMBOL, SPECS, SYMBOLS, check_symbol
from tapeflow.functions.display import change_class, constant_class, or_no_data, shown, with_unit
from tapeflow.functions.times import FIRST_MS, LAST_MS
from tapeflow.operators import latest as L
from tapeflow.sources import zones as Z

# Column titles of the board's table and chart.
CHART_TITLE = "Aktueller Kurswert {symbol} in USD"
TRADE_TITLES = {
    "time": "Timestamp",
    "trade_id": "Trade ID",
    "price": "Aktueller Kurswert (USD)",
    "quantity": "Menge",
    "notional": "Gesamtwert (USD)",
}


def _newest_sql(table: str, column: str) -> str:
    """One aggregation instead of a sort; no row when the symbol has none."""
    return f"""SELECT max_by({column}, event_time) AS value, now() AS time FROM {table}
        WHERE symbol = :symbol HAVING count(*) > 0"""


def _extreme_sql(function: str, column: str) -> str:
    return f"""SELECT {function}({column}) AS value, now() AS time FROM ticker_1d
        WHERE symbol = :symbol"""


#: As ``seconds_time``: NULL where the number is no time.
_CUT_TIME = f"""CASE WHEN event_time BETWEEN {FIRST_MS} AND {LAST_MS}
        THEN timestamp_seconds(event_time div 1000) END AS time"""

#: The panels as SQL on the views ``trades``, ``ticker_1h`` and ``ticker_1d``;
#: ``:symbol`` is the board's parameter.
PANEL_SQL = {
    "price_chart": f"""SELECT {_CUT_TIME}, last_price AS value FROM ticker_1h
        WHERE symbol = :symbol ORDER BY time DESC, event_time DESC LIMIT 500""",
    "price_now": _newest_sql("ticker_1h", "last_price"),
    "change_1h": _newest_sql("ticker_1h", "price_change_percent"),
    "change_1d": _newest_sql("ticker_1d", "price_change_percent"),
    "low": _extreme_sql("min", "low_price"),
    "high": _extreme_sql("max", "high_price"),
    "trade_count": _newest_sql("ticker_1d", "total_trades"),
    "recent_trades": f"""SELECT {_CUT_TIME}, trade_id, price, quantity,
        price * quantity AS notional FROM trades WHERE symbol = :symbol
        ORDER BY time DESC NULLS FIRST, trade_id DESC LIMIT 100""",
}


def panel_sql(spark: SparkSession, panel: str, symbol: str = DEFAULT_SYMBOL) -> DataFrame:
    return spark.sql(PANEL_SQL[panel], args={"symbol": symbol})


def _stat(answer: DataFrame, unit: str, colour: Column, decimals: int | None = 2) -> DataFrame:
    value = F.col("value") if decimals is None else shown(F.col("value"), decimals)
    return answer.select(with_unit(value, "value", unit), "time", colour.alias("colour"))


def price_chart(ticker_1h: DataFrame, symbol: str) -> DataFrame:
    return L.price_series(ticker_1h, symbol).select(
        "time", with_unit(shown(F.col("value")), CHART_TITLE.format(symbol=symbol), "$")
    )


def price_now(ticker_1h: DataFrame, symbol: str, as_of: Column | None = None) -> DataFrame:
    answer = L.latest_value(ticker_1h, symbol, "last_price", as_of)
    return _stat(answer, "$", constant_class("gray"))


def change_1h(ticker_1h: DataFrame, symbol: str, as_of: Column | None = None) -> DataFrame:
    """Percent change with its colour; the text for no data when there is none."""
    answer = L.latest_value(ticker_1h, symbol, "price_change_percent", as_of)
    return or_no_data(_stat(answer, "percent", change_class(F.col("value"))), "value")


def change_1d(ticker_1d: DataFrame, symbol: str, as_of: Column | None = None) -> DataFrame:
    answer = L.latest_value(ticker_1d, symbol, "price_change_percent", as_of)
    return _stat(answer, "percent", change_class(F.col("value")), decimals=None)


def stat_of_extreme(answer: DataFrame, colour: str) -> DataFrame:
    """The panel of a low or high, however it was found."""
    return _stat(answer, "$", constant_class(colour))


def low(
    ticker_1d: DataFrame, symbol: str, as_of: Column | None = None, since: int | None = None
) -> DataFrame:
    return stat_of_extreme(L.lowest(ticker_1d, symbol, as_of, since), "red")


def high(
    ticker_1d: DataFrame, symbol: str, as_of: Column | None = None, since: int | None = None
) -> DataFrame:
    return stat_of_extreme(L.highest(ticker_1d, symbol, as_of, since), "green")


def trade_count(ticker_1d: DataFrame, symbol: str, as_of: Column | None = None) -> DataFrame:
    answer = L.latest_value(ticker_1d, symbol, "total_trades", as_of)
    return _stat(answer, "none", constant_class("gray"), decimals=None)


def recent_trades(trades: DataFrame, symbol: str) -> DataFrame:
    rows = L.recent_trades(trades, symbol)
    titles = TRADE_TITLES
    return rows.select(
        F.col("time").alias(titles["time"]),
        F.col("trade_id").alias(titles["trade_id"]),
        with_unit(shown(F.col("price")), titles["price"], "$"),
        F.col("quantity").alias(titles["quantity"]),
        with_unit(shown(F.col("notional")), titles["notional"], "$"),
    )


def market_board(
    tables: dict[str, DataFrame],
    symbol: str = DEFAULT_SYMBOL,
    as_of: Column | None = None,
    choices: tuple[str, ...] = SYMBOLS,
    since: int | None = None,
) -> dict[str, DataFrame]:
    """All panels by name.

    With ``since`` (epoch ms) the panels of newest rows try the rows from then on
    first; the answers are the same, the scans shorter.  Low and high are over all
    rows either way.
    """
    check_symbol(symbol, choices)
    day = tables["ticker_1d"]

    def newest(table: str, n: int) -> DataFrame:
        rows = tables[table]
        return rows if since is None else L.newest_from(L.for_symbol(rows, symbol), n, since)

    hour_row, day_row = newest("ticker_1h", 1), newest("ticker_1d", 1)
    return {
        "price_chart": price_chart(newest("ticker_1h", 500), symbol),
        "price_now": price_now(hour_row, symbol, as_of),
        "change_1h": change_1h(hour_row, symbol, as_of),
        "change_1d": change_1d(day_row, symbol, as_of),
        "low": low(day, symbol, as_of),
        "high": high(day, symbol, as_of),
        "trade_count": trade_count(day_row, symbol, as_of),
        "recent_trades": recent_trades(newest("trades", 100), symbol),
    }


def stored_board(
    spark: SparkSession,
    paths: dict[str, str],
    symbol: str = DEFAULT_SYMBOL,
    as_of: Column | None = None,
    choices: tuple[str, ...] = SYMBOLS,
) -> dict[str, DataFrame]:
    """All panels from stored tables, by their zones: a refresh reads the newest partitions and
    a zone for each epoch, partition and symbol, however long the tables are."""
    check_symbol(symbol, choices)

    def newest(table: str, n: int) -> DataFrame:
        return Z.newest(spark, SPECS[table], paths[table], symbol, n)

    zones = Z.read_zones(spark, SPECS["ticker_1d"], paths["ticker_1d"])
    hour_row, day_row = newest("ticker_1h", 1), newest("ticker_1d", 1)
    return {
        "price_chart": price_chart(newest("ticker_1h", 500), symbol),
        "price_now": price_now(hour_row, symbol, as_of),
        "change_1h": change_1h(hour_row, symbol, as_of),
        "change_1d": change_1d(day_row, symbol, as_of),
        "low": stat_of_extreme(Z.lowest(zones, symbol, as_of), "red"),
        "high": stat_of_extreme(Z.highest(zones, symbol, as_of), "green"),
        "trade_count": trade_count(day_row, symbol, as_of),
        "recent_trades": recent_trades(newest("trades", 100), symbol),
    }
