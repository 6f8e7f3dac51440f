import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeflow.functions.times import DAY_MS, HOUR_MS, floor_div
from tapeflow.operators import ticker as K
from tapeflow.operators.latest import recent_trades

SCHEMA = (
    "trade_id bigint, symbol string, event_time bigint, "
    "price decimal(18,8), quantity decimal(18,8)"
)


def random_trades(seed: int, cases: int = 60):
    """One random series per symbol: sparse and dense, with ties and zeros."""
    rng = random.Random(seed)
    rows = []
    for case in range(cases):
        span = rng.choice([5, 30, 200])
        start = rng.choice([-100, 0, 1000])
        for trade_id in range(rng.randint(1, 40)):
            price = Decimal(rng.choice([0, 1, 5, rng.randint(1, 999)])) / 8
            quantity = Decimal(rng.choice([0, 0, 1, rng.randint(1, 99)])) / 4
            rows.append((trade_id, f"S{case}", start + rng.randrange(span), price, quantity))
    rng.shuffle(rows)
    return rows


def brute_force(rows, period):
    """The definition, row by row."""
    expected = {}
    by_symbol = {}
    for r in rows:
        by_symbol.setdefault(r[1], []).append(r)
    for symbol, series in by_symbol.items():
        for t in {r[2] for r in series}:
            w = sorted((r for r in series if t - period <= r[2] <= t), key=lambda r: (r[2], r[0]))
            volume = sum(r[4] for r in w)
            quote = sum(r[3] * r[4] for r in w)
            opened, last = float(w[0][3]), float(w[-1][3])
            expected[symbol, t] = {
                "open_price": opened,
                "last_price": last,
                "last_quantity": float(w[-1][4]),
                "high_price": float(max(r[3] for r in w)),
                "low_price": float(min(r[3] for r in w)),
                "volume": float(volume),
                "quote_volume": float(quote),
                "vwap": float(quote) / float(volume) if volume else None,
                "price_change": last - opened,
                "price_change_percent": 100.0 * (last - opened) / opened if opened else None,
                "total_trades": len(w),
            }
    return expected


def as_dict(df, *key):
    return {
        tuple(r[k] for k in key): {c: r[c] for c in df.columns if c not in key}
        for r in df.collect()
    }


@pytest.mark.parametrize("period,slice_ms", [(10, 10), (10, 5), (10, 1), (24, 6), (7, 7)])
def test_rolling_equals_the_definition(spark, period, slice_ms):
    rows = random_trades(period * 100 + slice_ms)
    trades = spark.createDataFrame(rows, SCHEMA)
    got = as_dict(K.rolling_ticker(trades, period, slice_ms), "symbol", "event_time")
    assert got == brute_force(rows, period)


@pytest.mark.parametrize("fan_in,longest", [(2, 1), (3, 2), (5, 1), (48, 3)])
@pytest.mark.parametrize("period", [1, 7, 23, 101, 2000])
def test_any_period_equals_the_definition(spark, monkeypatch, fan_in, longest, period):
    """Blocks of blocks, and slices that do not divide the period."""
    monkeypatch.setattr(K, "FAN_IN", fan_in)
    monkeypatch.setattr(K, "LONGEST_SLICE_MS", longest)
    monkeypatch.setattr(K, "FEWEST_SLICES", 2)
    rows = random_trades(period + fan_in, cases=25)
    got = as_dict(K.rolling_ticker(spark.createDataFrame(rows, SCHEMA), period), "symbol", "event_time")
    assert got == brute_force(rows, period)


def test_slots_of_usual_periods():
    assert K.default_slots(HOUR_MS) == 12
    assert K.default_slots(DAY_MS) == 48
    assert K.default_slots(7 * DAY_MS) == 336
    assert K.default_slots(5) == 5


@pytest.mark.parametrize("period", [5_400_001, 86_399_999, 7 * DAY_MS, 90 * DAY_MS, 3650 * DAY_MS + 7])
def test_no_group_grows_with_the_period(spark, period):
    """A slice holds at most half an hour of milliseconds, a block ``FAN_IN`` rows."""
    slots = K.default_slots(period)
    numbers = spark.range(-50_000, 50_000)
    ends = (F.col("id") * 60_000).alias("t")
    minutes = numbers.select(ends).groupBy(K.slot(F.col("t"), period, slots).alias("s")).count()
    assert minutes.agg(F.max("count")).first()[0] <= K.LONGEST_SLICE_MS // 60_000 + 1
    # exactly a period back is exactly all slots back
    moved = K.slot(ends, period, slots) - K.slot(F.col("id") * 60_000 - period, period, slots)
    assert [r[0] for r in numbers.select(moved).distinct().collect()] == [slots]
    slots -= 1
    while slots >= K.FAN_IN:
        blocks = -(-slots // K.FAN_IN)
        held = numbers.groupBy(K.slot(F.col("id"), slots, blocks)).count()
        assert held.agg(F.max("count")).first()[0] <= K.FAN_IN
        slots = blocks - 1


def test_long_period_over_days(spark):
    """Ninety days through two steps of blocks, against the plain frame."""
    rng = random.Random(11)
    one = Decimal(1)
    rows = [(i, rng.choice("AB"), rng.randrange(300 * DAY_MS), Decimal(rng.randint(1, 999)), one) for i in range(3000)]
    trades = spark.createDataFrame(rows, SCHEMA)
    frame = Window.partitionBy("symbol").orderBy("event_time").rangeBetween(-90 * DAY_MS, 0)
    plain = trades.select(
        "symbol", "event_time",
        F.first("price").over(frame).cast("double").alias("open_price"),
        F.max("price").over(frame).cast("double").alias("high_price"),
        F.min("price").over(frame).cast("double").alias("low_price"),
        F.sum(F.col("price") * F.col("quantity")).over(frame).cast("double").alias("quote_volume"),
        F.count("*").over(frame).alias("total_trades"),
    )
    fast = K.rolling_ticker(trades, 90 * DAY_MS).select(plain.columns)
    assert fast.exceptAll(plain).count() == 0 and plain.exceptAll(fast).count() == 0


def test_rolling_equals_the_range_frame(spark):
    trades = spark.createDataFrame(random_trades(5), SCHEMA)
    frame = Window.partitionBy("symbol").orderBy("event_time").rangeBetween(-20, 0)
    order = F.struct("event_time", "trade_id")
    plain = trades.select(
        "symbol",
        "event_time",
        F.min_by("price", order).over(frame).cast("double").alias("open_price"),
        F.max_by("price", order).over(frame).cast("double").alias("last_price"),
        F.max("price").over(frame).cast("double").alias("high_price"),
        F.min("price").over(frame).cast("double").alias("low_price"),
        F.sum("quantity").over(frame).cast("double").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).over(frame).cast("double").alias("quote_volume"),
        F.count("*").over(frame).alias("total_trades"),
    ).distinct()
    fast = K.rolling_ticker(trades, 20, 4).select(plain.columns)
    assert fast.exceptAll(plain).count() == 0 and plain.exceptAll(fast).count() == 0


def test_absurd_times_do_not_fail_the_job(spark):
    one = Decimal(1)
    rows = [(1, "A", 5, one, one), (2, "A", 2**63 - 1, one, one), (3, "A", -(2**63), one, one)]
    trades = spark.createDataFrame(rows, SCHEMA)
    assert [r.event_time for r in K.rolling_ticker(trades, HOUR_MS).collect()] == [5]
    assert K.hopping_ticker(trades, HOUR_MS, HOUR_MS).count() == 1
    assert recent_trades(trades, "A").count() == 3


def test_doubles_that_are_no_decimals_are_left_out(spark):
    rows = [(1, "A", 5, 1.5, 2.0), (2, "A", 6, float("nan"), 1.0), (3, "A", 7, 1e300, 1.0)]
    schema = "trade_id long, symbol string, event_time long, price double, quantity double"
    (row,) = K.rolling_ticker(spark.createDataFrame(rows, schema), HOUR_MS).collect()
    assert (row.event_time, row.quote_volume) == (5, 3.0)


def test_largest_trades_add_up(spark):
    most = Decimal("9999999999")
    rows = [(i, "A", 5 + i // 300, most, most) for i in range(600)]
    rows.append((600, "A", 7, Decimal("0.5"), Decimal("0.25")))
    trades = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_time: r.quote_volume for r in K.rolling_ticker(trades, HOUR_MS).collect()}
    square = int(most) ** 2
    assert got == pytest.approx({5: 300.0 * square, 6: 600.0 * square, 7: 600.0 * square}, rel=1e-15)
    (window,) = K.hopping_ticker(trades, HOUR_MS, HOUR_MS).collect()
    assert window.quote_volume == pytest.approx(600.0 * square, rel=1e-15)


@pytest.mark.parametrize("since", [-50, 0, 17, 1100])
def test_rolling_since(spark, since):
    trades = spark.createDataFrame(random_trades(8), SCHEMA)
    part = K.rolling_ticker(trades, 20, 4, since=since)
    whole = K.rolling_ticker(trades, 20, 4).where(F.col("event_time") >= since)
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("period,longest", [(24, 2), (23, 5), (101, 1), (60, 100)])
def test_runs_from_stored_slices(spark, monkeypatch, tmp_path, period, longest):
    """Runs give the ticker of one run, though trades in the middle of their windows are not read."""
    monkeypatch.setattr(K, "LONGEST_SLICE_MS", longest)
    trades = random_trades(11)
    made = spark.createDataFrame(trades, SCHEMA).cache()
    want = as_dict(K.rolling_ticker(made, period), "symbol", "event_time")
    got, since = {}, None
    for run, until in enumerate((-40, 3, 4, 17, 90, 1003, 5000)):
        instants = K.instants_of_run(made, period, until, since)
        stored = spark.read.parquet(f"{tmp_path}/s").where(F.col("run") < run) if run else None
        got |= as_dict(K.rolling_of_run(instants, period, since, stored), "symbol", "event_time")
        K.slices_of_run(instants, period, until, since).coalesce(1).write.parquet(f"{tmp_path}/s/run={run}")
        since = until
    assert got == want


def test_slots_of_known_times(spark):
    for period, slices in ((24, 12), (23, 12), (101, 7), (86_400_000, 48)):
        times = [*range(-60, 60), period - 1, period, -period, 3 * period + 1]
        rows = spark.createDataFrame([(t,) for t in times], "t long").select("t", K.slot(F.col("t"), period, slices)).collect()
        assert all(K.slot_of(t, period, slices) == number for t, number in rows)
        for t, number in rows:
            start = K.slot_start(number, period, slices)
            assert start <= t < K.slot_start(number + 1, period, slices)
            assert K.slot_of(start, period, slices) == number > K.slot_of(start - 1, period, slices)


def test_a_run_reads_less_than_a_period(spark):
    """Two hours of a day's ticker: their windows' beginnings, themselves, and two slices."""
    trades = spark.range(0, 3 * DAY_MS, 60_000).selectExpr(
        "id trade_id", "'A' symbol", "id event_time", "cast(1 as decimal(18,8)) price", "cast(1 as decimal(18,8)) quantity"
    )
    read = K.instants_of_run(trades, DAY_MS, 2 * DAY_MS + 2 * HOUR_MS, 2 * DAY_MS).count()
    assert 240 <= read <= 240 + 2 * 30


def test_bounds_hold(spark):
    trades = spark.createDataFrame(random_trades(6), SCHEMA)
    rows = K.rolling_ticker(trades, 20, 4)
    ordered = (
        "low_price <= open_price and open_price <= high_price and low_price <= last_price "
        "and last_price <= high_price and (vwap is null or "
        "(low_price <= vwap + 1e-9 and vwap <= high_price + 1e-9))"
    )
    assert rows.where(f"not ({ordered})").count() == 0
    assert rows.groupBy("symbol", "event_time").count().where("count > 1").count() == 0


def test_slice_must_divide_the_period(spark):
    trades = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        K.rolling_ticker(trades, 10, 3)
    with pytest.raises(ValueError):
        K.hopping_ticker(trades, 10, 11)


def test_incomplete_trades_are_left_out(spark):
    one = Decimal(1)
    rows = [(1, "A", 5, one, one), (2, "A", None, one, one), (3, "A", 6, None, one),
            (4, "A", 6, one, None)]
    trades = spark.createDataFrame(rows, SCHEMA)
    (row,) = K.rolling_ticker(trades, 10, 5).collect()
    assert (row.event_time, row.total_trades) == (5, 1)


def test_one_instant_may_hold_a_third_of_the_trades(spark):
    n = 30_000
    trades = spark.range(n).select(
        F.col("id").alias("trade_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise("B").alias("symbol"),
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("event_time"),
        F.lit("2").cast("decimal(18,8)").alias("price"),
        F.lit("0.5").cast("decimal(18,8)").alias("quantity"),
    )
    rows = K.rolling_ticker(trades, HOUR_MS)
    (hot,) = rows.where("symbol = 'HOT'").collect()
    assert (hot.event_time, hot.total_trades, hot.quote_volume) == (500, 10_000, 10_000.0)
    plan = K.per_instant(trades)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan[plan.index("Exchange") :] and "SortAggregate" not in plan


def test_rolling_plan(spark):
    trades = spark.createDataFrame(random_trades(1), SCHEMA)
    rolling = K.rolling_ticker(trades, DAY_MS)
    rolling.collect()
    plan = rolling._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert "ReusedExchange" in final, "trades are read and reduced once"
    assert "SortAggregate" not in final and "Cartesian" not in final
    # symbol+slice serves both big windows
    shuffles = final.count("Exchange hashpartitioning(") - final.count("ReusedExchange")
    assert shuffles == 4


@pytest.mark.parametrize("period,slide", [(12, 4), (12, 12), (12, 5), (9, 6)])
def test_hopping_equals_the_definition(spark, period, slide):
    rows = random_trades(period * slide)
    trades = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in K.hopping_ticker(trades, period, slide).select(
        "*", F.unix_millis("window_start").alias("start")
    ).collect():
        got[r.symbol, r.start] = (
            r.open_price, r.last_price, r.high_price, r.low_price, r.volume, r.quote_volume,
            r.total_trades,
        )
    expected = {}
    for trade in rows:
        newest = trade[2] // slide * slide
        for start in range(newest, newest - period - slide, -slide):
            if start <= trade[2] < start + period:
                expected.setdefault((trade[1], start), []).append(trade)
    for key, w in expected.items():
        w.sort(key=lambda r: (r[2], r[0]))
        expected[key] = (
            float(w[0][3]), float(w[-1][3]), float(max(r[3] for r in w)),
            float(min(r[3] for r in w)), float(sum(r[4] for r in w)),
            float(sum(r[3] * r[4] for r in w)), len(w),
        )
    assert got == expected


def test_hopping_copies_slides_not_trades(spark):
    trades = spark.createDataFrame(random_trades(9), SCHEMA)
    plan = K.hopping_ticker(trades, DAY_MS, HOUR_MS)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.index("Generate explode") < text.rindex("HashAggregate")
    assert "SortAggregate" not in text


def test_floor_div(spark):
    df = spark.createDataFrame([(v,) for v in (-7, -5, -1, 0, 4, 5, 9)], "v bigint")
    assert [r[0] for r in df.select(floor_div(F.col("v"), 5)).collect()] == [
        -2, -1, -1, 0, 0, 1, 1,
    ]
