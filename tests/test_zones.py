import datetime
import random

import pytest
from pyspark.sql import functions as F

from tapeflow.contracts import IDS_PER_RANGE, TICKER_1D, TICKER_1H, TRADES
from tapeflow.functions.times import DAY_MS
from tapeflow.operators import latest as L
from tapeflow.operators import metrics as M
from tapeflow.plans.market_board import market_board, stored_board
from tapeflow.sources import tables as S
from tapeflow.sources import zones as Z

ABSURD = 2**62


def as_of():
    return F.expr("timestamp_seconds(0)")


def random_trades(seed, count=400):
    rng = random.Random(seed)
    times = [None, ABSURD, -ABSURD, 0, -5]
    return [
        (rng.randrange(5) * IDS_PER_RANGE + rng.randrange(60), rng.choice("ABC"),
         rng.choice(times) if rng.random() < 0.02 else rng.randrange(10 * DAY_MS), rng.randint(1, 99) / 4, 1.0)
        for _ in range(count)
    ]


def random_ticks(seed, days=range(6), count=300):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        price = [rng.randint(1, 10_000) / 8 if rng.random() > 0.05 else None for _ in range(7)]
        out.append((rng.choice(days) * DAY_MS + rng.randrange(DAY_MS), rng.choice("AB"), *price, rng.randrange(9)))
    return out


@pytest.fixture
def stored(spark, path):
    """Trades in several epochs with a retry and a replay, and a compacted copy."""
    table, target = path("trades"), path("compacted")
    batches = [spark.createDataFrame(random_trades(s), TRADES.table_schema) for s in range(3)]
    for writer, epoch, rows in [("a", 0, 0), ("a", 1, 1), ("a", 1, 1), ("a", 2, 2), ("b", 0, 0), ("b", 1, 1)]:
        S.append_once(batches[rows], TRADES, table, writer, epoch)
    S.compact(spark, TRADES, table, target)
    S.compact(spark, TRADES, table, target, F.col("id_range") == 2)
    return table, target


def test_zones_are_those_of_the_rows(spark, stored):
    for table in stored:
        zones = Z.read_zones(spark, TRADES, table)
        fresh = Z.zones_of(S.stored_rows(spark, TRADES, table), TRADES).select(*zones.columns)
        assert zones.exceptAll(fresh).count() == 0 and fresh.exceptAll(zones).count() == 0
        counted = M.rows_inserted_total(S.stored_rows(spark, TRADES, table))
        assert sorted(M.inserted_so_far(Z.rows_per_epoch(zones)).collect()) == sorted(counted.collect())
        assert Z.row_count(zones).first()[0] == S.read_table(spark, TRADES, table).count()


@pytest.mark.parametrize("n", [1, 7, 100, 10_000])
def test_newest_rows(spark, stored, n):
    for table in stored:
        whole = S.read_table(spark, TRADES, table)
        for symbol in ("A", "C", "none"):
            near = Z.newest(spark, TRADES, table, symbol, n)
            expected = L.recent_trades(whole, symbol, n).collect()
            assert L.recent_trades(near, symbol, n).collect() == expected
            assert near.columns == TRADES.column_names


def test_ticker_panels(spark, path):
    table = path("ticker")
    for epoch, seed in enumerate((1, 2, 1)):
        S.append_once(spark.createDataFrame(random_ticks(seed), TICKER_1D.table_schema), TICKER_1D, table, "w", epoch)
    whole, zones = S.read_table(spark, TICKER_1D, table), Z.read_zones(spark, TICKER_1D, table)
    for symbol in ("A", "none"):
        assert Z.lowest(zones, symbol, as_of()).collect() == L.lowest(whole, symbol, as_of()).collect()
        assert Z.highest(zones, symbol, as_of()).collect() == L.highest(whole, symbol, as_of()).collect()
        for n in (1, 40, 500):
            near = Z.newest(spark, TICKER_1D, table, symbol, n)
            assert L.price_series(near, symbol, n).collect() == L.price_series(whole, symbol, n).collect()
        one = Z.newest(spark, TICKER_1D, table, symbol, 1)
        assert L.latest_value(one, symbol, "last_price", as_of()).collect() == L.latest_value(whole, symbol, "last_price", as_of()).collect()
    last = Z.latest_per_symbol(spark, TICKER_1D, table).select("symbol", "event_time", "last_price")
    expected = L.latest_per_symbol(whole).select("symbol", "event_time", "last_price")
    assert sorted(last.collect()) == sorted(expected.collect())


def test_only_new_partitions_are_read(spark, path):
    """Of a year of days, the newest rows read the last one."""
    days = range(300, 365)
    table = path("ticker")
    S.append_once(spark.createDataFrame(random_ticks(4, days, 2000), TICKER_1H.table_schema), TICKER_1H, table, "w", 0)
    near = Z.newest(spark, TICKER_1H, table, "A", 3)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters") :].split("]")[0]
    dates = {p.split("event_date=")[1][:10] for p in near.inputFiles()}
    assert dates == {str(datetime.date(1970, 1, 1) + datetime.timedelta(364))}
    last = Z.latest_per_symbol(spark, TICKER_1H, table).inputFiles()
    assert sum("/_zones/" not in f for f in last) <= 2


def test_no_rows_and_no_table(spark, path):
    table = path("trades")
    S.create_table(spark, TRADES, table)
    zones = Z.read_zones(spark, TRADES, table)
    assert zones.count() == 0 and Z.row_count(zones).first()[0] == 0
    assert Z.newest(spark, TRADES, table, "A", 5).count() == 0
    S.append_once(spark.createDataFrame([], TRADES.table_schema), TRADES, table, "w", 0)
    assert Z.newest(spark, TRADES, table, "A", 5).count() == 0
    assert Z.lowest(zones, "A", as_of()).first().value is None
    S.create_table(spark, TICKER_1H, path("ticker"))
    assert Z.latest_per_symbol(spark, TICKER_1H, path("ticker")).count() == 0
    with pytest.raises(ValueError):
        Z.latest_per_symbol(spark, TRADES, table)


def test_zones_do_not_show_in_the_table(spark, stored):
    table, _ = stored
    files = spark.read.parquet(table).inputFiles()
    assert files and not any("/_zones/" in f for f in files)


def test_board_from_stored_tables(spark, path):
    """All panels equal those over the whole tables."""
    specs = {"trades": TRADES, "ticker_1h": TICKER_1H, "ticker_1d": TICKER_1D}
    paths = {name: path(name) for name in specs}
    for epoch, seed in enumerate((5, 6)):
        S.append_once(spark.createDataFrame(random_trades(seed), TRADES.table_schema), TRADES, paths["trades"], "w", epoch)
        for name in ("ticker_1h", "ticker_1d"):
            ticks = spark.createDataFrame(random_ticks(seed + epoch), specs[name].table_schema)
            S.append_once(ticks, specs[name], paths[name], "w", epoch)
    whole = {name: S.read_table(spark, spec, paths[name]) for name, spec in specs.items()}
    for symbol in ("A", "none"):
        plain = market_board(whole, symbol, as_of(), choices=("A", "none"))
        board = stored_board(spark, paths, symbol, as_of(), choices=("A", "none"))
        assert list(board) == list(plain)
        for name, panel in board.items():
            assert panel.collect() == plain[name].collect(), name
    with pytest.raises(ValueError):
        stored_board(spark, paths, "B", choices=("A",))
