import datetime
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeflow.contracts import IDS_PER_RANGE, TICKER_1H, TRADES
from tapeflow.operators import metrics as M
from tapeflow.operators.latest import newest_from
from tapeflow.operators.quality import first_per_key, reject_known
from tapeflow.scratch import shared_dir
from tapeflow.sources import tables as S

SCHEMA = "trade_id bigint, symbol string, event_time bigint, price double, quantity double"
FAR = 10**12


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, table):
    return sorted(tuple(r) for r in S.read_table(spark, TRADES, table).collect())


FIRST = [(1, "A", 1, 1.0, 1.0), (1, "A", 2, 9.0, 1.0), (2, "A", 1, 2.0, 1.0)]
SECOND = [(1, "A", FAR, 5.0, 1.0), (3, "A", FAR, 3.0, 1.0), (IDS_PER_RANGE, "A", 1, 4.0, 1.0)]
KEPT = [
    (1, "A", 1, 1.0, 1.0),
    (2, "A", 1, 2.0, 1.0),
    (3, "A", FAR, 3.0, 1.0),
    (IDS_PER_RANGE, "A", 1, 4.0, 1.0),
]


def test_first_write_wins_across_epochs_retries_and_replays(spark, path):
    table, conflicts = path("trades"), path("conflicts")
    first, second = trades(spark, *FIRST), trades(spark, *SECOND)
    S.append_once(first, TRADES, table, "w", 0, conflicts)
    S.append_once(second, TRADES, table, "w", 1, conflicts)
    assert content(spark, table) == KEPT
    for writer, epoch, rows in (("w", 1, second), ("x", 0, first), ("x", 1, second)):
        S.append_once(rows, TRADES, table, writer, epoch, conflicts)
        assert content(spark, table) == KEPT
    report = spark.read.parquet(conflicts).where("writer = 'w'")
    assert {(r.trade_id, r.price, r.kept_price) for r in report.collect()} == {
        (1, 9.0, 1.0),
        (1, 5.0, 1.0),
    }
    counts = M.rows_inserted_total(S.stored_rows(spark, TRADES, table)).orderBy("epoch").collect()
    assert [(r.writer, r.rows_inserted, r.rows_inserted_total) for r in counts] == [
        ("w", 2, 2),
        ("w", 2, 4),
    ]


def test_empty_reports_leave_no_file(spark, path):
    reports = path("bad")
    bad = spark.createDataFrame([("malformed", "x")], "reason string, raw string")
    S.write_report(bad.where("false"), reports, "w", 0)
    assert S.read_quarantine(spark, reports).count() == 0
    for rows in (bad, bad):
        S.write_report(rows, reports, "w", 1)
    found = S.read_quarantine(spark, reports)
    assert [tuple(r) for r in found.collect()] == [("malformed", "x", "w", 1)]
    assert len(found.inputFiles()) == 1


def test_retry_of_a_half_written_epoch(spark, path):
    table = path("trades")
    S.create_table(spark, TRADES, table)
    S.write_epoch(trades(spark, FIRST[0]), TRADES, table, "w", 0)
    S.append_once(trades(spark, *FIRST), TRADES, table, "w", 0)
    assert content(spark, table) == KEPT[:2]


def test_layout_and_pruning(spark, path):
    table = path("trades")
    S.append_once(trades(spark, *FIRST, *SECOND), TRADES, table, "w", 0)
    stored = S.stored_rows(spark, TRADES, table)
    assert {r.id_range for r in stored.select("id_range").collect()} == {0, 1}
    plan = stored.where("id_range = 0")._jdf.queryExecution().executedPlan().toString()
    assert "id_range" in plan[plan.index("PartitionFilters") :].split("]")[0]
    near = held(spark, table, (IDS_PER_RANGE + 5, "A"), (IDS_PER_RANGE - 0, "A"))
    assert [r.trade_id for r in near.collect()] == [IDS_PER_RANGE]
    assert len(near.inputFiles()) == 1
    assert held(spark, table, (IDS_PER_RANGE, "B")).count() == 0
    assert held(spark, table, (2, "A"), (2, "B")).count() == 1
    assert held(spark, table, (9 * IDS_PER_RANGE, "A")).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        near = held(spark, table, (IDS_PER_RANGE + 5, "A"), (IDS_PER_RANGE - 0, "A"))
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(symbol,A)" in pushed and "GreaterThanOrEqual(trade_id,1000000)" in pushed


def test_files_are_sorted_by_symbol_and_time(spark, path):
    table = path("trades")
    rows = spark.range(3000).select(
        F.col("id").alias("trade_id"),
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("event_time"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("quantity"),
    )
    S.append_once(rows, TRADES, table, "w", 0)
    for name in S.stored_rows(spark, TRADES, table).inputFiles():
        found = pq.read_table(name.removeprefix("file://"), partitioning=None).to_pylist()
        order = [(r["symbol"], r["event_time"]) for r in found]
        assert order and order == sorted(order)


def test_append_shuffles_each_side_once(spark, path):
    table = path("trades")
    every = [(i, f"S{i % 3}", 2 * i, 1.0, 1.0) for i in range(1000)]
    rows = spark.createDataFrame(every, SCHEMA)
    S.append_once(rows.where("trade_id < 500"), TRADES, table, "w", 0)
    known = S.held_within(spark, TRADES, table, S.reach_of(rows, TRADES))
    conf = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(conf, "-1")
    try:
        fresh = reject_known(first_per_key(rows, TRADES.key), known, TRADES.key)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(conf)
    assert plan.count("Exchange hashpartitioning(trade_id") == 2
    kept_side = plan[plan.index("SortMergeJoin") : plan.index("WindowGroupLimit")]
    assert "Sort [" not in kept_side, "the window's order serves the join"
    below = plan[plan.index("Exchange hashpartitioning(trade_id") :]
    assert below.index("WindowGroupLimit") < below.index("Scan ExistingRDD"), "copies are cut first"
    assert "ReadSchema: struct<trade_id:bigint,symbol:string>" in plan


def held(spark, table, *keys):
    rows = trades(spark, *[(i, symbol, 1, 1.0, 1.0) for i, symbol in keys])
    return S.held_within(spark, TRADES, table, S.reach_of(rows, TRADES))


def ids(spark, numbers):
    return numbers.select(
        F.col("id").alias("trade_id"),
        F.lit("A").alias("symbol"),
        F.lit(1).cast("bigint").alias("event_time"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("quantity"),
    )


@pytest.fixture(scope="module")
def wide_table(spark, tmp_path_factory):
    """A row in each of 500 partitions."""
    table = str(tmp_path_factory.mktemp("wide") / "trades")
    every = ids(spark, spark.range(500).select((F.col("id") * IDS_PER_RANGE).alias("id")))
    S.append_once(every, TRADES, table, "w", 0)
    return table


def test_look_up_is_one_plan_for_any_width(spark, wide_table):
    plans = []
    for width in (3, 500):
        number = F.expr(f"id div 2 * {IDS_PER_RANGE} + id % 2").alias("id")
        batch = ids(spark, spark.range(2 * width).select(number))
        known = S.held_within(spark, TRADES, wide_table, S.reach_of(batch, TRADES))
        assert known.count() == width
        fresh = reject_known(first_per_key(batch, TRADES.key), known, TRADES.key)
        assert fresh.count() == width
        nodes = [re.sub(r"[^A-Za-z]", "", line.split("(")[0].split("[")[0]) for line in
                 fresh._jdf.queryExecution().sparkPlan().toString().splitlines()]
        plans.append(nodes)
    assert plans[0] == plans[1] and any("LeftSemi" in n or "Join" in n for n in plans[0])


def test_replay_over_many_partitions(spark, wide_table):
    every = ids(spark, spark.range(500).select((F.col("id") * IDS_PER_RANGE).alias("id")))
    S.append_once(every, TRADES, wide_table, "x", 0)
    assert S.read_table(spark, TRADES, wide_table).count() == 500


def test_empty_batch_and_create_twice(spark, path):
    table = path("trades")
    S.append_once(trades(spark), TRADES, table, "w", 0)
    S.create_table(spark, TRADES, table)
    assert content(spark, table) == []
    S.append_once(trades(spark, *FIRST), TRADES, table, "w", 1)
    S.create_table(spark, TRADES, table)
    assert content(spark, table) == KEPT[:2]


def test_compaction_keeps_rows_and_blocks_replays(spark, path):
    table, target = path("trades"), path("compacted")
    S.append_once(trades(spark, *FIRST), TRADES, table, "w", 0)
    S.append_once(trades(spark, *SECOND), TRADES, table, "w", 1)
    for _ in range(2):
        S.compact(spark, TRADES, table, target)
        assert content(spark, target) == KEPT
    S.append_once(trades(spark, *SECOND), TRADES, target, "w", 1)
    assert content(spark, target) == KEPT


@pytest.mark.parametrize("absurd", [0, 10**14])
def test_compaction_by_id_and_time(spark, path, absurd):
    """A range of times and one of ids each touch about a tenth of the row groups."""
    table, target = path("trades"), path("compacted")
    rows = spark.range(20_000).selectExpr(
        "id trade_id", "concat('S', id % 7) symbol", "cast(id as double) price", "1.0D quantity",
        f"if(id = 5 and {absurd} > 0, {absurd}, pmod(xxhash64(id), 1000000)) event_time",
    )
    S.create_table(spark, TRADES, table)
    S.write_epoch(rows.select(*TRADES.column_names), TRADES, table, "w", 0)
    S.compact(spark, TRADES, table, target, near=("trade_id", "event_time"), rows_per_file=200)
    stored = S.read_table(spark, TRADES, target)
    assert sorted(stored.collect()) == sorted(S.read_table(spark, TRADES, table).collect())
    groups = stored.groupBy(F.input_file_name()).agg(
        F.min("event_time").alias("t0"), F.max("event_time").alias("t1"), F.min("trade_id").alias("i0"), F.max("trade_id").alias("i1")
    ).collect()
    assert len(groups) >= 100
    for low in (0, 480_000, 990_000):
        assert sum(g.t0 <= low + 9_999 and g.t1 >= low for g in groups) <= 0.17 * len(groups)
    for low in (0, 9_000, 19_900):
        assert sum(g.i0 <= low + 99 and g.i1 >= low for g in groups) <= 0.17 * len(groups)


def test_compaction_by_partition(spark, path):
    table, target = path("trades"), path("compacted")
    S.append_once(trades(spark, *FIRST), TRADES, table, "w", 0)
    S.append_once(trades(spark, *SECOND), TRADES, table, "w", 1)
    for chosen in ("id_range = 0", "id_range >= 1", "id_range = 0"):
        S.compact(spark, TRADES, table, target, F.expr(chosen))
    assert content(spark, target) == KEPT
    assert len(S.stored_rows(spark, TRADES, target).inputFiles()) == 2


def test_ticker_table_is_split_by_date(spark, path):
    day = 86_400_000
    rows = spark.createDataFrame(
        [(d * day + 5, "A", *[float(d)] * 7, d) for d in range(3)], TICKER_1H.table_schema
    )
    table = path("ticker")
    for writer in ("w", "x"):
        S.append_once(rows, TICKER_1H, table, writer, 0)
    stored = S.stored_rows(spark, TICKER_1H, table)
    assert {r.event_date for r in stored.select("event_date").collect()} == {
        datetime.date(1970, 1, 1 + d) for d in range(3)
    }
    assert S.read_table(spark, TICKER_1H, table).count() == 3
    recent = S.read_table(spark, TICKER_1H, table, since=2 * day)
    assert [r.total_trades for r in recent.collect()] == [2]
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert S.read_table(spark, TICKER_1H, table, since=day).count() == 2
        near = newest_from(S.stored_rows(spark, TICKER_1H, table), 2, day)
        assert sorted(r.total_trades for r in near.collect()) == [1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters") :].split("]")[0]


def test_jdbc_options():
    options = S.jdbc_options("jdbc:x", "trades", 8, 5000, user="u")
    assert options == {
        "url": "jdbc:x", "dbtable": "trades", "user": "u", "numPartitions": "8",
        "batchsize": "5000",
    }
    assert "numPartitions" not in S.jdbc_options("jdbc:x", "trades")


@pytest.fixture
def parquet_for_jdbc(spark, path, monkeypatch):
    """Stands in for the database; keeps the options it was asked with."""
    asked, folder = [], path("database")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)

    def read(spark, options):
        asked.append(options)
        return spark.read.schema(SCHEMA).parquet(folder)

    monkeypatch.setattr(S, "read_jdbc", read)
    monkeypatch.setattr(
        S, "write_jdbc", lambda rows, options: rows.write.mode("append").parquet(folder)
    )
    return asked, lambda: sorted(tuple(r) for r in spark.read.parquet(folder).collect())


def test_database_append_after_a_partial_write(spark, parquet_for_jdbc):
    asked, held = parquet_for_jdbc
    options = S.jdbc_options("jdbc:x", "trades", partitions=4)
    S.write_jdbc(trades(spark, FIRST[0]), options)
    for rows in (FIRST, FIRST, SECOND, FIRST + SECOND, []):
        S.append_jdbc(trades(spark, *rows), TRADES, options)
    assert held() == KEPT
    assert asked[0]["partitionColumn"] == "trade_id"
    assert (asked[0]["lowerBound"], asked[0]["upperBound"]) == ("1", "3")
    assert len(asked) == 4


def test_reach(spark, path):
    """What a table is asked for covers the batch, and little else."""
    rows = trades(spark, (1, "A", 1, 1.0, 1.0), (5, "A", 1, 1.0, 1.0), (90, "B", 1, 1.0, 1.0))
    reach = S.reach_of(rows, TRADES)
    wide = trades(spark, *[(i, s, 1, 1.0, 1.0) for i in range(100) for s in "AB"], (3, "C", 1, 1.0, 1.0))
    assert wide.where(reach.keys).count() == 180
    S.append_once(wide, TRADES, path("trades"), "w", 0)
    assert S.held_within(spark, TRADES, path("trades"), reach).count() == 6
    assert (reach.low, reach.high, reach.folders) == (1, 90, "id_range={0}")
    assert S.reach_of(trades(spark), TRADES) is None


@pytest.mark.parametrize("hot", [True, False])
def test_busy_partition_is_written_by_several_tasks(spark, path, hot):
    """Rebalancing may split one id range; its rows stay whole."""
    table = path("trades")
    rows = spark.range(20000).select(
        (F.col("id") if hot else F.col("id") * 100).alias("trade_id"),
        F.lit("A").alias("symbol"),
        F.col("id").alias("event_time"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("quantity"),
    )
    S.append_once(rows, TRADES, table, "w", 0)
    assert S.read_table(spark, TRADES, table).distinct().count() == 20000


class Session:
    """As much of a session as the choice of a scratch folder reads."""

    def __init__(self, master, conf=None, checkpoint=None):
        class Context:
            applicationId = f"app {master}"

            def getCheckpointDir(self):
                return checkpoint

        self.conf, self.sparkContext = conf or {}, Context()
        self.sparkContext.master = master


def test_scratch_folder():
    named = {"spark.checkpoint.dir": "s3a://lake/scratch/"}
    one, two = (shared_dir(Session("yarn", named), "x") for _ in range(2))
    assert one.startswith("s3a://lake/scratch/x-") and one != two
    assert shared_dir(Session("yarn", checkpoint="hdfs:/cp"), "x").startswith("hdfs:/cp/x-")
    with pytest.raises(ValueError):
        shared_dir(Session("yarn"), "x")
    local = Session("local[2]")
    first, second = shared_dir(local, "x"), shared_dir(local, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_null_keys_are_refused(spark, path):
    rows = spark.createDataFrame(
        [(None, "A", 1, 1.0, 1.0), (2, "A", 1, 1.0, 1.0)],
        "trade_id bigint, symbol string, event_time bigint, price double, quantity double",
    )
    with pytest.raises(ValueError, match="NULL key"):
        S.append_once(rows, TRADES, path("trades"), "w", 0)


def _plan(frame):
    return frame._jdf.queryExecution().toString()


def test_look_up_moves_and_sorts_no_stored_rows(spark, path):
    """The spans of a batch go to the stored rows, and are found without a sort, whatever a
    planner holds small."""
    table = path("table")
    trades = [(i, "AB"[i % 2], i, 1.0, 2.0) for i in (1, 2, 3, 10**7, 10**7 + 1)]
    rows = spark.createDataFrame(trades, TRADES.table_schema)
    S.append_once(rows, TRADES, table, "a", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reach = S.reach_of(rows.where("trade_id < 3"), TRADES)
        held = S.held_within(spark, TRADES, table, reach)
        assert sorted(r.trade_id for r in held.collect()) == [1, 2]
        assert "SortMergeJoin" not in _plan(held) and "BroadcastHashJoin" in _plan(held)
        assert "SortAggregate" not in _plan(reach.spans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_message_files_by_size(spark, monkeypatch):
    """Much input is written where it is, in files of bounded length; little is spread."""
    from tapeflow.plans import registry

    monkeypatch.setattr(registry, "_FILE_MESSAGES", 10, raising=False)
    messages = spark.range(0, 700, 1, 3).select(F.col("id").cast("string").alias("value"))
    lines = spark.read.text(registry._message_files(messages, "topic"))
    sizes = [r["count"] for r in lines.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 700 and max(sizes) <= 10
    assert sorted(int(r.value) for r in lines.collect()) == list(range(700))
    few = spark.read.text(registry._message_files(messages.limit(30), "topic"))
    assert len(few.inputFiles()) == 6 and few.count() == 30
