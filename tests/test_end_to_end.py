"""From messages on three topics to both boards."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tapeflow.contracts import SPECS, SYMBOLS
from tapeflow.operators import metrics as M
from tapeflow.plans import market_board as B
from tapeflow.plans import ops_board as OB
from tapeflow.sources import tables as S
from tapeflow.streaming import job

START = 1_746_093_600_000


def trade(i, rng):
    return {
        "e": "trade", "E": START + i * 250 + 1, "s": rng.choice(SYMBOLS), "t": i,
        "p": f"{rng.uniform(1, 100):.8f}", "q": f"{rng.uniform(0, 5):.8f}",
        "T": START + i * 250, "m": True, "M": True,
    }


def tick(kind, i, symbol, rng):
    last = rng.uniform(50, 60)
    return {
        "e": kind, "E": START + i * 1000, "s": symbol, "p": "1.0", "P": f"{rng.uniform(-2, 2):.3f}",
        "w": "55", "x": "1", "c": f"{last:.2f}", "Q": "1", "b": "1", "B": "1", "a": "1", "A": "1",
        "o": "55", "h": f"{last + 5:.2f}", "l": f"{last - 5:.2f}", "v": "10", "q": "550",
        "O": 1, "C": 2, "F": 3, "L": 4, "n": 100 + i,
    }


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    rng, root = random.Random(11), tmp_path_factory.mktemp("world")
    sent = {
        "trades": [trade(i, rng) for i in range(900)],
        "ticker_1h": [tick("1hTicker", i, s, rng) for i in range(600) for s in SYMBOLS],
        "ticker_1d": [tick("24hrTicker", i, s, rng) for i in range(50) for s in SYMBOLS],
    }
    tables = {}
    for name, messages in sent.items():
        lines = [json.dumps(m) for m in messages]
        lines += rng.sample(lines, 30) + ["{broken", ""]
        rng.shuffle(lines)
        inbox = root / f"{name}-inbox"
        inbox.mkdir()
        for n in range(3):
            (inbox / f"{n}.txt").write_text("\n".join(lines[n::3]) + "\n")
        paths = {p: str(root / f"{name}-{p}") for p in ("table", "quarantine", "checkpoint")}
        argv = [name, "--files", str(inbox), "--available-now"]
        for option, value in paths.items():
            argv += [f"--{option}", value]
        job.main(argv)
        tables[name] = S.read_table(spark, SPECS[name], paths["table"])
        assert S.read_quarantine(spark, paths["quarantine"]).count() == 2
    return sent, tables


def test_tables_hold_each_message_once(world):
    sent, tables = world
    for name, messages in sent.items():
        assert tables[name].count() == len(messages)
        assert tables[name].select(*SPECS[name].key).distinct().count() == len(messages)


@pytest.mark.parametrize("symbol", SYMBOLS)
def test_market_board(world, symbol):
    sent, tables = world
    board = {n: df.collect() for n, df in B.market_board(tables, symbol).items()}
    hour = sorted((m for m in sent["ticker_1h"] if m["s"] == symbol), key=lambda m: -m["E"])
    day = sorted((m for m in sent["ticker_1d"] if m["s"] == symbol), key=lambda m: -m["E"])
    trades = sorted((m for m in sent["trades"] if m["s"] == symbol), key=lambda m: -m["t"])

    chart = [r[f"Aktueller Kurswert {symbol} in USD"] for r in board["price_chart"]]
    assert chart == [float(m["c"]) for m in hour[:500]]
    assert board["price_now"][0].value == float(hour[0]["c"])
    change = float(hour[0]["P"])
    assert float(board["change_1h"][0].value) == pytest.approx(change, abs=0.0051)
    assert board["change_1h"][0].colour == ("green" if change >= 0 else "red")
    assert board["change_1d"][0].value == float(day[0]["P"])
    assert board["low"][0].value == min(float(m["l"]) for m in day)
    assert board["high"][0].value == max(float(m["h"]) for m in day)
    assert board["trade_count"][0].value == day[0]["n"]
    newest = board["recent_trades"]
    assert [r["Trade ID"] for r in newest] == [m["t"] for m in trades[:100]]
    for r, m in zip(newest, trades):
        assert r["Menge"] == float(m["q"])
        value = float(m["p"]) * float(m["q"])
        assert r["Gesamtwert (USD)"] == pytest.approx(value, abs=0.0051)


def test_ops_board(world, spark):
    sent, tables = world
    as_of = F.expr(f"timestamp_millis({START + 10**6})")
    counts = M.as_samples(
        M.rows_per_table(tables), OB.ROWS_INSERTED, "row_count", as_of,
        datname="market", relname=F.col("table_name"), schemaname="public",
    )
    lines = spark.createDataFrame(
        [], "ts timestamp, line string, job string, time_text string"
    )
    board = OB.ops_board(counts, lines, "market", as_of)
    for name, messages in sent.items():
        row = board[f"rows {name}"].first()
        assert (row.value, row.colour) == (float(len(messages)), "green")
    assert board["up kafka"].count() == 0
