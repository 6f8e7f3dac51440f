import datetime

import pytest
from pyspark.sql import functions as F

from tapeflow.operators import latest as L
from tapeflow.plans import market_board as B

TRADES = "trade_id bigint, symbol string, event_time bigint, price double, quantity double"
TICKER = (
    "event_time bigint, symbol string, price_change double, price_change_percent double, "
    "last_price double, open_price double, high_price double, low_price double, "
    "volume double, total_trades bigint"
)
HOUR = 3_600_000


@pytest.fixture(scope="module")
def trades(spark):
    return spark.createDataFrame(
        [
            (1, "BTCUSDT", 1000, 10.0, 1.0),
            (2, "BTCUSDT", 5100, 11.0, 2.0),
            (3, "BTCUSDT", 5900, 12.0, 0.5),
            (4, "BTCUSDT", None, 13.0, 1.0),
            (5, "BTCUSDT", 1999, 14.126, 1.0),
            (6, "ETHUSDT", 7000, 20.0, 3.0),
            (7, "ETHUSDT", 8000, None, 3.0),
        ],
        TRADES,
    )


def tick(t, symbol, percent, last=100.0, low=90.0, high=110.0, n=5):
    return (t, symbol, 1.0, percent, last, 99.0, high, low, 7.0, n)


@pytest.fixture(scope="module")
def ticker(spark):
    return spark.createDataFrame(
        [
            tick(1 * HOUR, "BTCUSDT", 1.0, 101.234, low=50.0),
            tick(30 * HOUR, "BTCUSDT", -1.0, 102.345, high=120.0),
            tick(31 * HOUR, "BTCUSDT", 0.0, 103.456, n=9),
            tick(31 * HOUR, "ETHUSDT", None, 9.0),
            tick(30 * HOUR, "ETHUSDT", 2.0, 8.0),
        ],
        TICKER,
    )


def at(seconds):
    return datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=seconds)


def plain(df):
    return df.withColumn("time", F.col("time").cast("timestamp_ntz"))


def test_recent_trades_order(trades):
    rows = plain(L.recent_trades(trades, "BTCUSDT")).collect()
    assert [r.trade_id for r in rows] == [4, 3, 2, 5, 1]
    assert [r.time for r in rows] == [None, at(5), at(5), at(1), at(1)]
    assert [r.notional for r in rows][:3] == [13.0, 6.0, 22.0]
    assert [r.trade_id for r in L.recent_trades(trades, "BTCUSDT", 2).collect()] == [4, 3]
    assert L.recent_trades(trades, "ETHUSDT").first().notional is None
    assert L.recent_trades(trades, "SOLUSDT").count() == 0


def test_latest_value(ticker):
    assert L.latest_value(ticker, "BTCUSDT", "last_price").first().value == 103.456
    assert L.latest_value(ticker, "BTCUSDT", "total_trades").first().value == 9
    assert L.latest_value(ticker, "SOLUSDT", "last_price").count() == 0
    row = L.latest_value(ticker, "ETHUSDT", "price_change_percent").first()
    assert row.value is None and row.time is not None


def test_latest_per_symbol(ticker):
    rows = {r.symbol: r for r in L.latest_per_symbol(ticker).collect()}
    assert rows["BTCUSDT"].event_time == 31 * HOUR and rows["BTCUSDT"].total_trades == 9
    assert rows["ETHUSDT"].price_change_percent is None
    plan = L.latest_per_symbol(ticker)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_low_and_high(ticker):
    assert L.lowest(ticker, "BTCUSDT").first().value == 50.0
    assert L.lowest(ticker, "BTCUSDT", since=7 * HOUR).first().value == 90.0
    assert L.highest(ticker, "BTCUSDT").first().value == 120.0
    empty = L.highest(ticker, "SOLUSDT").collect()
    assert len(empty) == 1 and empty[0].value is None


def test_price_series(ticker):
    rows = plain(L.price_series(ticker, "BTCUSDT", 2)).collect()
    assert [(r.time, r.value) for r in rows] == [
        (at(31 * 3600), 103.456),
        (at(30 * 3600), 102.345),
    ]


@pytest.mark.parametrize("threshold", ["1000", "2"])
def test_last_n_per_symbol(spark, trades, threshold):
    conf = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(conf, threshold)
    try:
        rows = L.last_n_per_symbol(trades.repartition(4), 2, "trade_id").collect()
    finally:
        spark.conf.set(conf, "1000")
    assert {(r.symbol, r.place, r.trade_id) for r in rows} == {
        ("BTCUSDT", 1, 4), ("BTCUSDT", 2, 3), ("ETHUSDT", 1, 7), ("ETHUSDT", 2, 6),
    }
    assert set(rows[0].asDict()) == {*trades.columns, "place"}


@pytest.mark.parametrize("since,n", [(5000, 2), (5000, 3), (5000, 4), (0, 99)])
def test_newest_from_gives_the_same_answer(trades, since, n):
    near = L.newest_from(L.for_symbol(trades, "BTCUSDT"), n, since)
    answer = L.recent_trades(near, "BTCUSDT", n).collect()
    assert answer == L.recent_trades(trades, "BTCUSDT", n).collect()
    assert (near.count() < 5) == (n <= 3)


def test_newest_from_cuts_where_seconds_do(spark):
    schema = "trade_id bigint, symbol string, event_time bigint, price double, quantity double"
    times = [(4, 1_700_000_000_700), (5, 1_700_000_000_600), (9, 1_700_000_000_100), (7, -(2**62)), (3, -1500), (2, -900)]
    rows = spark.createDataFrame([(i, "BTCUSDT", t, 1.0, 1.0) for i, t in times], schema)
    for since in (1_700_000_000_500, 0, -1000, -1600):
        for n in range(1, 7):
            near = L.newest_from(rows, n, since)
            assert L.recent_trades(near, "BTCUSDT", n).collect() == L.recent_trades(rows, "BTCUSDT", n).collect()


def test_panel_sql_survives_any_time(spark, ticker):
    schema = "trade_id bigint, symbol string, event_time bigint, price double, quantity double"
    rows = [(1, "BTCUSDT", 2**62, 1.0, 2.0), (2, "BTCUSDT", None, 1.0, 2.0), (3, "BTCUSDT", 1999, 1.0, 2.0)]
    trades = spark.createDataFrame(rows, schema)
    trades.createOrReplaceTempView("trades")
    for name in ("ticker_1h", "ticker_1d"):
        odd = ticker.withColumn("event_time", F.lit(2**62))
        ticker.unionByName(odd).createOrReplaceTempView(name)
    for panel in B.PANEL_SQL:
        B.panel_sql(spark, panel, "BTCUSDT").collect()
    got = [r.trade_id for r in B.panel_sql(spark, "recent_trades", "BTCUSDT").collect()]
    assert got == [r.trade_id for r in L.recent_trades(trades, "BTCUSDT").collect()] == [2, 1, 3]


def test_market_board(spark, trades, ticker):
    tables = {"trades": trades, "ticker_1h": ticker, "ticker_1d": ticker}
    as_of = F.expr("timestamp_seconds(10)")
    board = {n: df.collect() for n, df in B.market_board(tables, as_of=as_of).items()}
    assert len(board) == 8
    assert board["price_now"][0].value == 103.46 and board["price_now"][0].colour == "gray"
    assert board["change_1h"][0].value == "0.0" and board["change_1h"][0].colour == "green"
    assert board["change_1d"][0].colour == "green"
    assert (board["low"][0].value, board["low"][0].colour) == (50.0, "red")
    assert (board["high"][0].value, board["high"][0].colour) == (120.0, "green")
    assert board["trade_count"][0].value == 9
    assert [r["Trade ID"] for r in board["recent_trades"]] == [4, 3, 2, 5, 1]
    assert board["recent_trades"][3]["Gesamtwert (USD)"] == 14.13
    assert board["price_chart"][0]["Aktueller Kurswert BTCUSDT in USD"] == 103.46

    near = B.market_board(tables, as_of=as_of, since=25 * HOUR)
    assert {n: df.collect() for n, df in near.items()} == board

    silent = B.market_board(tables, "SOLUSDT")
    assert silent["change_1h"].first().value == "No data"
    assert silent["price_now"].count() == 0
    with pytest.raises(ValueError):
        B.market_board(tables, "DOGEUSDT")


def test_units_are_column_metadata(ticker):
    field = B.price_now(ticker, "BTCUSDT").schema["value"]
    assert field.metadata == {"unit": "$"}
    assert B.change_1d(ticker, "BTCUSDT").schema["value"].metadata == {"unit": "percent"}


def test_panel_sql_agrees_with_the_functions(spark, trades, ticker):
    from tapeflow.sources.tables import register_views

    register_views(spark, {"trades": trades, "ticker_1h": ticker, "ticker_1d": ticker})
    same = {
        "price_chart": L.price_series(ticker, "BTCUSDT"),
        "price_now": L.latest_value(ticker, "BTCUSDT", "last_price"),
        "change_1h": L.latest_value(ticker, "BTCUSDT", "price_change_percent"),
        "change_1d": L.latest_value(ticker, "BTCUSDT", "price_change_percent"),
        "low": L.lowest(ticker, "BTCUSDT"),
        "high": L.highest(ticker, "BTCUSDT"),
        "trade_count": L.latest_value(ticker, "BTCUSDT", "total_trades"),
        "recent_trades": L.recent_trades(trades, "BTCUSDT"),
    }
    assert set(same) == set(B.PANEL_SQL)
    for panel, frame in same.items():
        columns = [c for c in frame.columns if c != "time"]
        by_sql = B.panel_sql(spark, panel, "BTCUSDT").select(columns).collect()
        assert by_sql == frame.select(columns).collect(), panel
    injected = B.panel_sql(spark, "price_now", "x' OR '1'='1")
    assert injected.count() == 0


def test_top_rows_need_no_full_sort(trades):
    plan = L.recent_trades(trades, "BTCUSDT")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
