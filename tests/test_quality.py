from pyspark.sql import Observation
from pyspark.sql import functions as F

from tapeflow.contracts import TRADES
from tapeflow.operators import quality as Q
from tapeflow.operators import ticker as K
from tapeflow.operators.logs import shape_logs

SCHEMA = "trade_id bigint, symbol string, event_time bigint, price double, quantity double"
KEY = TRADES.key


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_first_per_key(spark):
    rows = trades(
        spark,
        (1, "A", 20, 5.0, 1.0),
        (1, "A", 10, 6.0, 1.0),
        (1, "A", 10, 5.5, 1.0),
        (1, "B", 1, 1.0, 1.0),
        (2, "A", None, 9.0, 1.0),
        (2, "A", 3, 1.0, 1.0),
    )
    got = {tuple(r) for r in Q.first_per_key(rows, KEY).collect()}
    assert got == {(1, "A", 10, 5.5, 1.0), (1, "B", 1, 1.0, 1.0), (2, "A", None, 9.0, 1.0)}


def test_copies_are_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 3).alias("trade_id"),
        F.col("id").cast("string").alias("symbol"),
        F.col("id").alias("event_time"),
    )
    plan = Q.first_per_key(rows, KEY)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:], "a limit below the exchange"


def test_null_keys_are_set_aside(spark):
    rows = trades(spark, (1, "A", 1, 1.0, 1.0), (None, "A", 1, 1.0, 1.0), (1, None, 1, 1.0, 1.0))
    kept, rejected = Q.split_null_keys(rows, KEY)
    assert (kept.count(), rejected.count()) == (1, 2)


def test_conflicts_within(spark):
    rows = trades(
        spark,
        (1, "A", 1, 5.0, 1.0),
        (1, "A", 1, 6.0, 1.0),
        (1, "A", 1, 6.0, 1.0),
        (2, "A", None, 5.0, 1.0),
        (2, "A", None, 5.0, 1.0),
        (3, "A", None, 5.0, 1.0),
        (3, "A", 7, 5.0, 1.0),
    )
    report = {r.trade_id: r for r in Q.conflicts_within(rows, KEY).collect()}
    assert set(report) == {1, 3}
    assert (report[1].kept_price, report[1].copies) == (5.0, 3)
    assert (report[3].kept_event_time, report[3].copies) == (None, 2)


def test_conflicts_with_stored_rows(spark):
    stored = trades(spark, (1, "A", 1, 5.0, 1.0), (2, "A", None, 5.0, 1.0))
    offered = trades(
        spark,
        (1, "A", 1, 5.0, 1.0),
        (1, "A", 1, 7.0, 1.0),
        (1, "A", 1, 7.0, 1.0),
        (2, "A", None, 5.0, 1.0),
        (3, "A", 1, 1.0, 1.0),
    )
    (row,) = Q.conflicts_with(offered, stored, KEY).collect()
    assert (row.trade_id, row.price, row.kept_price, row.copies) == (1, 7.0, 5.0, 2)


def test_hot_key(spark):
    """A third of the rows are one key."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("trade_id"),
        F.lit("A").alias("symbol"),
        (F.lit(30000) - F.col("id")).alias("event_time"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("quantity"),
    )
    first = Q.first_per_key(rows, KEY)
    assert first.count() == 20001
    assert first.where("trade_id = 0").first().event_time == 30000 - 29997
    report = Q.conflicts_within(rows, KEY).collect()
    assert [(r.trade_id, r.copies) for r in report] == [(0, 10000)]


def test_left_out_rows_are_counted(spark):
    rows = [("A", 1, 1, "1.5", "2"), ("A", None, 2, "1", "1"), ("A", 2**62, 3, None, "1"), ("A", 4, 4, "x", None), ("A", 5, 5, "1", "y")]
    trades = spark.createDataFrame(rows, "symbol string, event_time bigint, trade_id bigint, price string, quantity string")
    seen = Observation()
    assert [r.trade_id for r in K.priced(trades, seen).collect()] == [1]
    assert seen.get == {"seen": 5, "no_time": 2, "no_price": 1, "no_quantity": 1}
    records = spark.createDataFrame(
        [('{"log":"a","time":"2024-01-01T00:00:00Z"}', "p"), ('{"log":"b","time":"soon"}', "p"), ("plain", "p"), (None, "p")],
        "value string, path string",
    )
    logs = Observation()
    assert len(shape_logs(records, observed=logs).collect()) == 4
    assert logs.get == {"seen": 4, "unparsed": 2, "without_time": 3}
