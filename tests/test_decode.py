import json

import pytest

from tapeflow.contracts import SPECS, TICKER_1H, TRADES, check_schema
from tapeflow.functions.decode import read_messages, to_table_types

S = '"s":"BTCUSDT"'

# message, (trade_id, event_time, price) or None, reason
TRADE_CASES = [
    ('{"t":1,"T":2,"p":"1.123456785","z":9,%s}' % S, (1, 2, "1.12345679"), None),
    ('{"t":6,"T":7,"p":1.50,%s}' % S, (6, 7, "1.50000000"), None),
    ('{"t":6,"t":7,"T":1,"p":"2",%s}' % S, (7, 1, "2.00000000"), None),
    ('{"t":5,%s}' % S, (5, None, None), None),
    ('{"t":"1","T":2,"p":"3",%s}' % S, None, "malformed"),
    ('{"t":1.5,"T":2,"p":"1",%s}' % S, None, "malformed"),
    ('{"t":8,"T":9,"p":"abc",%s}' % S, None, "bad_number"),
    ('{"t":8,"T":9,"p":"",%s}' % S, None, "bad_number"),
    ('{"t":8,"T":9,"p":"99999999999.1",%s}' % S, None, "bad_number"),
    ('{"t":8,"T":9,"p":" 1.5 ",%s}' % S, (8, 9, "1.50000000"), None),
    ('{"t":8,"T":9,"p":"1e3",%s}' % S, (8, 9, "1000.00000000"), None),
    ('{"t":1,"T":2,"p":"3"}', None, "null_key"),
    ('{"T":2,"p":"3",%s}' % S, None, "null_key"),
    ("garbage", None, "malformed"),
    ("null", None, "malformed"),
    ('[{"t":1,"T":2,"p":"1"}]', None, "malformed"),
    ("", None, "empty"),
    (None, None, "empty"),
]


@pytest.mark.parametrize("case_sensitive", ["false", "true"])
def test_trade_messages(spark, case_sensitive):
    spark.conf.set("spark.sql.caseSensitive", case_sensitive)
    try:
        rows = [(i, None if m is None else m.encode()) for i, (m, _, _) in enumerate(TRADE_CASES)]
        messages = spark.createDataFrame(rows, "i int, value binary")
        got = {r.i: r for r in read_messages(messages, TRADES, keep=("i",)).collect()}
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    for i, (message, expected, reason) in enumerate(TRADE_CASES):
        row = got[i]
        assert row.reason == reason, message
        assert row.raw == message
        if expected:
            price = None if row.price is None else f"{row.price:f}"
            assert (row.trade_id, row.event_time, price) == expected, message
            assert row.symbol == "BTCUSDT"


def test_upper_and_lower_case_fields_stay_apart(spark):
    message = json.dumps(
        {"e": "trade", "E": 11, "s": "ETHUSDT", "t": 12, "p": "1", "q": "2", "T": 13,
         "m": True, "M": False}
    )
    row = read_messages(spark.createDataFrame([(message,)], "value string"), TRADES).first()
    assert (row.trade_id, row.event_time) == (12, 13)
    assert (float(row.price), float(row.quantity)) == (1.0, 2.0)


def test_ticker_messages(spark):
    full = {
        "e": "1hTicker", "E": 1704067207000, "s": "ETHUSDT", "p": "-1.50", "P": "-0.065",
        "w": "2300.1", "c": "2299.0", "Q": "0.2", "o": "2300.5", "h": "2310.0", "l": "2290.0",
        "v": "1200.5", "q": "2761270.05", "O": 1, "C": 2, "F": 10, "L": 59, "n": 50,
    }
    messages = [
        json.dumps(full),
        json.dumps({"E": 5, "s": "X", "p": "NaN", "v": "1.5"}),
        json.dumps({"E": 6, "s": "X", "c": "n/a"}),
        json.dumps({"E": None, "s": "X"}),
    ]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    first, second, third, fourth = read_messages(df, TICKER_1H).collect()
    assert tuple(first)[:10] == (
        1704067207000, "ETHUSDT", -1.5, -0.065, 2299.0, 2300.5, 2310.0, 2290.0, 1200.5, 50,
    )
    assert first.reason is None
    assert second.price_change != second.price_change and second.reason is None
    assert (second.volume, second.last_price) == (1.5, None)
    assert third.reason == "bad_number"
    assert fourth.reason == "null_key"


def test_schemas(spark):
    for spec, fields, columns in ((TRADES, 9, 5), (TICKER_1H, 23, 10)):
        assert len(spec.fields) == fields and len(spec.columns) == columns
        rows = read_messages(spark.createDataFrame([], "value binary"), spec)
        check_schema(to_table_types(rows, spec), spec.table_schema)
        with pytest.raises(ValueError):
            check_schema(rows, spec.table_schema)
    assert set(SPECS) == {"trades", "ticker_1h", "ticker_1d"}
    assert len({s.topic for s in SPECS.values()}) == 3


def test_each_message_is_parsed_once(spark):
    df = read_messages(spark.createDataFrame([("{}",)], "value string"), TRADES)
    good = df.where("reason is null and price > 1 and symbol = 'X'")
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_nothing_is_lost(spark):
    df = spark.createDataFrame([(m,) for m, _, _ in TRADE_CASES], "value string")
    rows = read_messages(df, TRADES)
    good, bad = rows.where("reason is null").count(), rows.where("reason is not null").count()
    assert good + bad == len(TRADE_CASES)
