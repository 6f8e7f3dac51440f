import datetime
import json

import pytest
from pyspark.sql import functions as F

from tapeflow.contracts import TRADES
from tapeflow.functions import display
from tapeflow.functions.times import seconds_time
from tapeflow.operators import logs as G
from tapeflow.operators import metrics as M
from tapeflow.plans import ops_board as B
from tapeflow.sources import topics as T
from tapeflow.sources.log_table import read_lines, write_lines

UTC = datetime.timezone.utc


def ts(column="s"):
    return F.timestamp_seconds(F.col(column)).alias("ts")


@pytest.fixture(scope="module")
def messages(spark):
    day = 24 * 3600
    rows = [("a", "xx", 1), ("a", "yyy", 59), ("a", "z", 60), ("a", "ü", day + 5), ("b", "q", 61)]
    df = spark.createDataFrame(rows, "topic string, value string, s bigint")
    return df.select("topic", F.col("value").cast("binary").alias("value"), ts())


def rows_of(df, *columns):
    out = df.select(F.unix_seconds("window_start").alias("w"), *columns).collect()
    return sorted(tuple(r) for r in out)


def test_rates(messages):
    rates = M.messages_per_second(messages)
    assert rows_of(rates, "topic", "msgs_per_sec_1m") == [
        (0, "a", 2 / 60.0), (60, "a", 1 / 60.0), (60, "b", 1 / 60.0), (86400, "a", 1 / 60.0),
    ]
    rates = M.bytes_per_second(messages)
    assert rows_of(rates, "topic", "bytes_per_sec_1m")[0] == (0, "a", 5 / 60.0)
    assert rows_of(rates, "topic", "bytes_per_sec_1m")[-1] == (86400, "a", 2 / 60.0)


def test_running_totals_cross_days(messages):
    totals = M.running_totals(messages)
    assert rows_of(totals, "topic", "messages_total", "bytes_total") == [
        (0, "a", 2, 5), (60, "a", 3, 6), (60, "b", 1, 1), (86400, "a", 4, 8),
    ]
    last = {r.topic: (r.messages_total, r.bytes_total) for r in
            M.messages_per_topic(messages).collect()}
    assert last == {"a": (4, 8), "b": (1, 1)}


def test_rows_per_table(spark):
    counts = M.rows_per_table({"x": spark.range(3), "y": spark.range(0)})
    assert sorted(tuple(r) for r in counts.collect()) == [("x", 3), ("y", 0)]


def test_liveness_over_configured_sources(spark):
    as_of = F.expr("timestamp_seconds(1000)")
    rows = [("a", 1000), ("b", 700), ("c", 699), ("d", 1001), ("a", 5)]
    events = spark.createDataFrame(rows, "src string, s bigint").select("src", ts())
    live = M.liveness(events, ["a", "b", "c", "d", "silent"], as_of, "src", "ts")
    assert {r.source: r.is_live for r in live.collect()} == {
        "a": 1, "b": 1, "c": 0, "d": 0, "silent": 0,
    }


def test_label_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "x string")
    assert [r.label_value for r in M.label_values(df, "x").collect()] == ["a", "b"]


@pytest.fixture(scope="module")
def samples(spark):
    df = spark.createDataFrame(
        [
            ("up", {"job": "kafka"}, 900, 0.0),
            ("up", {"job": "kafka"}, 950, 1.0),
            ("up", {"job": "spark1"}, 950, 0.0),
            ("up", {"job": "old"}, 1, 1.0),
            (B.ROWS_INSERTED, {"datname": "m", "relname": "trades", "schemaname": "public"},
             999, 7.0),
            (B.ROWS_INSERTED, {"datname": "m", "relname": "trades", "schemaname": "x"}, 999, 8.0),
            (B.ROWS_INSERTED, {"datname": "k", "relname": "trades", "schemaname": "x"}, 999, 8.0),
        ],
        "metric string, labels map<string,string>, s bigint, value double",
    )
    return df.select("metric", "labels", ts(), "value")


def test_series_selection_and_last_sample(samples):
    as_of = F.expr("timestamp_seconds(1000)")
    (row,) = B.metric_panel(samples, "up", as_of, job="kafka").collect()
    assert (row.value, row.colour) == (1.0, "green")
    (row,) = B.metric_panel(samples, "up", as_of, job="spark1").collect()
    assert (row.value, row.colour) == (0.0, "red")
    assert B.metric_panel(samples, "up", as_of, job="old").count() == 0
    chosen = M.select_series(samples, B.ROWS_INSERTED, datname="m", relname="trades",
                             schemaname="public")
    assert [r.value for r in chosen.collect()] == [7.0]
    assert [r.label_value for r in B.databases(samples).collect()] == ["k", "m"]


def test_ops_board(spark, samples):
    lines = G.shape_logs(spark.createDataFrame([], "value string, path string"))
    board = B.ops_board(samples, lines, "m", F.expr("timestamp_seconds(1000)"))
    assert len(board) == 13
    assert board["up kafka"].first().value == 1.0
    assert board["rows trades"].first().value == 7.0
    assert board["messages binance.trades"].count() == 0


def test_all_metric_panels_in_one_pass(samples):
    as_of = F.expr("timestamp_seconds(1000)")
    board = B.metric_panels(samples, "m", as_of)
    assert sorted((r.panel, r.value, r.unit, r.colour) for r in board.collect()) == [
        ("rows trades", 7.0, "none", "green"), ("up kafka", 1.0, "short", "green"),
        ("up spark1", 0.0, "short", "red"),
    ]
    single = B.metric_panel(samples, B.ROWS_INSERTED, as_of, datname="m")
    assert single.schema["value"].metadata != B.metric_panel(samples, B.UP, as_of).schema["value"].metadata


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_range_of_a_rate_reaches_the_scan(spark, tmp_path, kind):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = [("a", s) for s in (0, 59, 60, 100, 359, 360, 419, 420, 500)]
    frame = spark.createDataFrame(rows, "topic string, s bigint").select(
        "topic", F.lit("x").alias("value"), F.timestamp_seconds("s").cast(kind).alias("ts")
    )
    frame.write.parquet(str(tmp_path / "messages"))
    messages = spark.read.parquet(str(tmp_path / "messages"))
    as_of = F.expr("timestamp_seconds(370)")
    near = M.whole_minutes(messages, as_of)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    bounds = F.col("window_start").between(F.expr("timestamp_seconds(70)"), as_of)
    some, every = M.messages_per_second(near).where(bounds), M.messages_per_second(messages).where(bounds)
    assert sorted(map(str, some.collect())) == sorted(map(str, every.collect())) and every.count() == 2


def record(i, **attrs):
    return json.dumps(
        {"log": f"line {i}\n", "stream": "stdout",
         "time": f"2025-05-01T10:00:00.1234567{i:02d}Z", "attrs": attrs}
    )


PATH = "/var/lib/docker/containers/abcdefabcdef999/abcdefabcdef999-json.log"


def test_log_shape(spark):
    rows = [
        (record(89, tag="t", **{"com.docker.compose.project": "p",
                                "com.docker.compose.service": "s",
                                "com.docker.swarm.task.name": "k"}), PATH),
        ("no json", "/elsewhere/x.log"),
    ]
    first, second = G.shape_logs(spark.createDataFrame(rows, "value string, path string")).collect()
    assert first.ts.astimezone(UTC) == datetime.datetime(
        2025, 5, 1, 10, 0, 0, 123456, tzinfo=UTC
    )
    assert (first.line, first.job, first.stream) == ("line 89\n", "containerlogs", "stdout")
    assert first.container_id == "abcdefabcdef"
    assert (first.tag, first.compose_project, first.compose_service) == ("t", "p", "s")
    assert (first.stack_name, first.swarm_service_name, first.swarm_task_name) == (None, None, "k")
    assert second.line and second.ts is None
    assert (second.container_id, second.job) == (None, "containerlogs")


def test_log_tail(spark):
    rows = [(record(i), PATH) for i in (1, 2, 3, 3)]
    lines = G.shape_logs(spark.createDataFrame(rows, "value string, path string"))
    as_of = F.to_timestamp(F.lit("2025-05-01T10:04:00Z"))
    got = [r.line for r in G.tail(lines, as_of).collect()]
    assert got == ["line 3\n", "line 3\n", "line 2\n", "line 1\n"]
    assert G.tail(lines, as_of, n=1).count() == 1
    assert G.tail(lines, F.to_timestamp(F.lit("2025-05-01T10:06:00Z"))).count() == 0
    assert G.tail(lines, as_of, job="other").count() == 0


def test_stored_lines_are_whole_and_pruned(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = [(record(i), PATH) for i in (1, 2)] + [("no json", PATH), (None, PATH)]
    late = record(3).replace("T10:00", "T12:30")
    early = record(4).replace("2025-05-01", "1969-12-31")
    frame = spark.createDataFrame([*rows, (late, PATH), (early, PATH)], "value string, path string")
    for _ in range(2):  # the second attempt of an epoch replaces the first
        write_lines(G.shape_logs(frame), path, "w", 0)
    stored = read_lines(spark, path)
    assert stored.count() == 6
    assert stored.where("ts IS NULL AND log_date IS NULL").count() == 2
    old = stored.where("log_date < date'1970-01-01'").first()
    assert (str(old.log_date), old.log_hour) == ("1969-12-31", 10)

    as_of = F.to_timestamp(F.lit("2025-05-01T10:04:00Z"))
    newest = G.tail(stored, as_of)
    assert [r.line for r in newest.collect()] == ["line 2\n", "line 1\n"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "log_date" in filters and "log_hour" in filters
    over_midnight = F.to_timestamp(F.lit("1970-01-01T00:30:00Z"))
    assert [r.line for r in G.tail(stored, over_midnight, "15 hours").collect()] == ["line 4\n"]


def test_tail_has_no_limit_of_its_own(spark):
    frame = spark.range(3000).select(F.lit(record(1)).alias("value"), F.lit(PATH).alias("path"))
    as_of = F.to_timestamp(F.lit("2025-05-01T10:04:00Z"))
    assert G.tail(G.shape_logs(frame), as_of).count() == 3000


def test_log_files_by_glob(spark, tmp_path):
    for name in ("abcdefabcdef1", "fedcbafedcba2"):
        folder = tmp_path / "containers" / name
        folder.mkdir(parents=True)
        (folder / f"{name}-json.log").write_text(record(1) + "\n" + record(2) + "\n")
        (folder / "other.txt").write_text("skipped\n")
    glob = f"{tmp_path}/containers/*/*log"
    lines = T.log_files(spark, glob)
    assert lines.count() == 4
    paths = {r.path for r in lines.collect()}
    assert all(p.startswith("/") and p.endswith("-json.log") for p in paths)

    out = str(tmp_path / "out")
    for expected in (4, 5):
        query = (
            G.shape_logs(T.log_stream(spark, glob)).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert spark.read.parquet(out).count() == expected
        folder = tmp_path / "containers" / "abcdefabcdef3"
        folder.mkdir(exist_ok=True)
        (folder / "abcdefabcdef3-json.log").write_text(record(9) + "\n")


def test_kafka_options():
    options = T.kafka_options("h:1", ["a", "b"], "earliest", 10)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }
    assert T.kafka_options("h:1", ["a"])["startingOffsets"] == "latest"


def test_fan_in_and_encode(spark):
    a = spark.createDataFrame([("binance.trades", "1")], "topic string, value string")
    b = spark.createDataFrame([("binance.trades", "1"), ("x", "2")], "topic string, value string")
    c = spark.createDataFrame([("3",)], "value string")
    topic = T.fan_in([a, b, c])
    assert topic.count() == 4
    assert [r.value for r in T.one_topic(topic, TRADES.topic).collect()] == ["1", "1"]
    row = spark.createDataFrame([(7, "A", "1.5")], "trade_id bigint, symbol string, price string")
    text = row.select(T.encode(row, TRADES).cast("string")).first()[0]
    assert json.loads(text) == {"t": 7, "s": "A", "p": "1.5"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plain_decimals(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = ["0.00000000", "0.00000001", "-1234567.50000000", "9999999999.99999999"]
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        out = df.select(display.plain_decimal(F.col("x").cast("decimal(18,8)"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [r[0] for r in out] == texts


def test_display(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,)], "x double")
    got = df.select(
        display.change_class(F.col("x")), display.up_class(F.col("x")),
        display.constant_class("gray"), display.shown(F.col("x") / 3),
    ).collect()
    assert [r[0] for r in got] == ["red", "green", "green", None]
    assert [r[1] for r in got] == [None, "red", "green", None]
    assert [r[2] for r in got] == ["gray"] * 4
    assert [r[3] for r in got] == [-0.33, 0.0, 0.33, None]


def test_seconds_are_cut(spark):
    df = spark.createDataFrame([(1999,), (2000,), (None,)], "ms bigint")
    assert [r[0] for r in df.select(F.unix_seconds(seconds_time("ms"))).collect()] == [1, 2, None]


def test_outages(spark):
    """Silences longer than five minutes, an open one at the end, ties, and rows without a time."""
    minute = 60
    times = {"a": [0, 0, 4 * minute, 9 * minute, 20 * minute, 58 * minute], "b": [minute, 59 * minute], "c": [30 * minute]}
    rows = [(name, t) for name, ts in times.items() for t in ts] + [("a", None), (None, 5), ("c", 90 * minute)]
    events = spark.createDataFrame(rows, "name string, s long").select("name", F.timestamp_seconds("s").alias("ts"))
    down = M.outages(events, F.timestamp_seconds(F.lit(60 * minute)), "name", "ts")
    seconds = [F.unix_seconds(c).alias(c) for c in ("down_from", "down_until")]
    got = {tuple(r) for r in down.select("source", *seconds).collect()}
    assert got == {
        ("a", 14 * minute, 20 * minute), ("a", 25 * minute, 58 * minute),
        ("b", 6 * minute, 59 * minute), ("c", 35 * minute, None),
    }
