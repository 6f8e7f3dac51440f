import json
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tapeflow.contracts import TICKER_1H, TRADES
from tapeflow.functions.decode import read_messages, to_table_types
from tapeflow.operators import metrics as M
from tapeflow.operators import quality as Q
from tapeflow.operators import ticker as K
from tapeflow.sources import tables as S
from tapeflow.sources.topics import text_stream
from tapeflow.streaming import ingest as I
from tapeflow.streaming import job

NOW = {"availableNow": True}


def message(i, t=None, symbol="BTCUSDT", price="1.5"):
    return json.dumps({"e": "trade", "s": symbol, "t": i, "p": price, "q": "2", "T": t or i})


def write_files(folder, messages, files):
    """Split the messages over files, one per line."""
    folder.mkdir(exist_ok=True)
    for n in range(files):
        name = f"{uuid.uuid4().hex}.txt"
        (folder / name).write_text("".join(m + "\n" for m in messages[n::files]))


class Job:
    def __init__(self, spark, tmp_path, spec=TRADES):
        self.spark, self.dir, self.spec = spark, tmp_path, spec
        self.inbox = tmp_path / "inbox"
        self.inbox.mkdir()
        self.table, self.bad = str(tmp_path / "table"), str(tmp_path / "bad")
        S.create_table(spark, spec, self.table)

    def run(self, checkpoint="checkpoint", sink=None, max_files=1):
        query = I.start_ingest(
            text_stream(self.spark, str(self.inbox), max_files),
            self.spec,
            sink or I.parquet_sink(self.spec, self.table, str(self.dir / "conflicts")),
            self.bad,
            str(self.dir / checkpoint),
            NOW,
        )
        query.awaitTermination()
        return query

    def rows(self):
        return sorted(tuple(r) for r in S.read_table(self.spark, self.spec, self.table).collect())

    def reasons(self):
        bad = S.read_quarantine(self.spark, self.bad)
        return sorted((r.reason, r.raw) for r in bad.collect())


def test_bad_messages_do_not_stop_the_query(spark, tmp_path):
    one = Job(spark, tmp_path)
    good = [message(i) for i in range(20)]
    bad = ["garbage", message(None), message(99, price="abc"), '{"t":"1","s":"A"}', ""]
    write_files(one.inbox, good + bad, 4)
    one.run()
    assert [r[0] for r in one.rows()] == list(range(20))
    assert [r for r, _ in one.reasons()] == [
        "bad_number", "empty", "malformed", "malformed", "null_key",
    ]
    assert ("malformed", "garbage") in one.reasons()


@pytest.mark.parametrize("files,max_files", [(1, 1), (5, 2), (7, 3)])
def test_stream_equals_batch(spark, tmp_path, files, max_files):
    rng = random.Random(files)
    messages = [message(rng.randrange(60), symbol=rng.choice("AB")) for _ in range(120)]
    one = Job(spark, tmp_path)
    write_files(one.inbox, messages, files)
    one.run(max_files=max_files)
    batch = read_messages(spark.createDataFrame([(m,) for m in messages], "value string"), TRADES)
    first = to_table_types(Q.first_per_key(Q.usable(batch, TRADES), TRADES.key), TRADES)
    assert one.rows() == sorted(tuple(r) for r in first.collect())


def test_restart_resumes_and_a_new_checkpoint_replays(spark, tmp_path):
    one = Job(spark, tmp_path)
    write_files(one.inbox, [message(i) for i in range(10)], 2)
    one.run()
    write_files(one.inbox, [message(i) for i in range(5, 15)], 1)
    second = one.run()
    assert sum(p["numInputRows"] for p in second.recentProgress) == 10
    before = one.rows()
    assert [r[0] for r in before] == list(range(15))
    one.run("another")
    assert one.rows() == before


def test_failure_after_the_write(spark, tmp_path):
    """The epoch is written, then the callback dies; the retry finds its own rows."""
    one = Job(spark, tmp_path)
    write_files(one.inbox, [message(i) for i in range(12)], 3)
    real = I.parquet_sink(TRADES, one.table)
    writers = []

    def dies_in_epoch_1(rows, epoch, writer):
        writers.append(writer)
        real(rows, epoch, writer)
        if epoch == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        one.run(sink=dies_in_epoch_1)
    assert len(one.rows()) == 8
    one.run()
    assert [r[0] for r in one.rows()] == list(range(12))
    assert len(set(writers)) == 1 and writers[0]
    total = M.rows_per_epoch(S.stored_rows(spark, TRADES, one.table))
    assert total.agg(F.sum("rows_inserted")).first()[0] == 12


def test_each_query_writes_under_its_own_id(spark, tmp_path):
    running = []
    for n in range(3):
        (tmp_path / str(n)).mkdir()
        one = Job(spark, tmp_path / str(n))
        write_files(one.inbox, [message(i) for i in range(40)], 8)
        query = I.start_ingest(
            text_stream(spark, str(one.inbox), 1), replace(TRADES, name=f"trades {n}"),
            I.parquet_sink(TRADES, one.table), one.bad, str(one.dir / "checkpoint"), NOW,
        )
        running.append((one, query))
    for one, query in running:
        query.awaitTermination()
        stored = S.stored_rows(spark, TRADES, one.table)
        assert {r.writer for r in stored.select("writer").collect()} == {query.id}
        assert {r.epoch for r in stored.select("epoch").collect()} == set(range(8))


def test_later_duplicate_loses_and_is_reported(spark, tmp_path):
    one = Job(spark, tmp_path)
    write_files(one.inbox, [message(1, price="1.0")], 1)
    one.run()
    write_files(one.inbox, [message(1, t=10**12, price="7.0")], 1)
    one.run()
    assert one.rows() == [(1, "BTCUSDT", 1, 1.0, 2.0)]
    (row,) = spark.read.parquet(str(tmp_path / "conflicts")).collect()
    assert (row.price, row.kept_price) == (7.0, 1.0)


@pytest.mark.parametrize("cuts", [[4], [1, 3], [2, 2], [1, 1, 1, 1]])
def test_first_write_is_the_first_in_the_topic(spark, tmp_path, cuts):
    """Messages with their offsets, as a topic gives them, cut into batches."""
    texts = [message(1, t=5, price="2"), message(1, t=4, price="1"), "x", message(2, t=1)]
    schema = "value string, partition int, offset bigint, timestamp timestamp"
    inbox, paths = str(tmp_path / "inbox"), [str(tmp_path / n) for n in ("table", "bad", "checkpoint")]
    S.create_table(spark, TRADES, paths[0])
    first = 0
    for n in cuts:
        rows = [(texts[i], 0, i) for i in range(first, first + n)]
        frame = spark.createDataFrame(rows, "value string, partition int, offset bigint")
        frame = frame.withColumn("timestamp", F.timestamp_seconds("offset"))
        frame.coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(schema).parquet(inbox)
        I.start_ingest(source, TRADES, I.parquet_sink(TRADES, paths[0]), paths[1], paths[2], NOW).awaitTermination()
        first += n
    stored = S.read_table(spark, TRADES, paths[0]).orderBy("trade_id").collect()
    assert [tuple(r) for r in stored] == [(1, "BTCUSDT", 5, 2.0, 2.0), (2, "BTCUSDT", 1, 1.5, 2.0)]
    (bad,) = S.read_quarantine(spark, paths[1], with_place=True).select("raw", "partition", "offset", F.unix_seconds("timestamp")).collect()
    assert tuple(bad) == ("x", 0, 2, 2)


def test_ticker_topic(spark, tmp_path):
    one = Job(spark, tmp_path, TICKER_1H)
    ticks = [json.dumps({"E": 86_400_000 * d, "s": "X", "c": "1.5", "n": d}) for d in range(3)]
    write_files(one.inbox, ticks + ticks, 2)
    one.run()
    assert [(r[0], r[4], r[9]) for r in one.rows()] == [
        (86_400_000 * d, 1.5, d) for d in range(3)
    ]


def test_absurd_ticker_times_are_stored_once(spark, tmp_path):
    one = Job(spark, tmp_path, TICKER_1H)
    times = [0, 2**63 - 1, -(2**63), 253_402_300_800_000]
    ticks = [json.dumps({"E": t, "s": "X", "c": "1.5"}) for t in times]
    write_files(one.inbox, ticks + ticks, 4)
    one.run()
    one.run("another")
    assert [r[0] for r in one.rows()] == sorted(times)


def test_hopping_stream_equals_batch(spark, tmp_path):
    rng = random.Random(3)
    messages = [
        message(i, t=rng.randrange(1, 10**8), price=str(rng.randrange(1, 99))) for i in range(200)
    ]
    inbox = tmp_path / "inbox"
    write_files(inbox, messages, 4)
    rows = Q.usable(read_messages(text_stream(spark, str(inbox), 1), TRADES), TRADES)
    stream = K.hopping_ticker_stream(rows, "6 hours", "2 hours", "30 days")
    out = str(tmp_path / "out")
    I.start_versions(stream, out, str(tmp_path / "checkpoint"), NOW).awaitTermination()
    last = I.last_versions(spark.read.parquet(out), "window_start", "window_end", "symbol")
    batch = read_messages(spark.createDataFrame([(m,) for m in messages], "value string"), TRADES)
    expected = K.hopping_ticker(Q.usable(batch, TRADES), 6 * 3_600_000, 2 * 3_600_000)
    columns = expected.columns
    assert sorted(map(tuple, last.select(columns).collect())) == sorted(
        map(tuple, expected.collect())
    )


def test_rows_beyond_the_watermark_are_counted(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_files(inbox, [message(1, t=10**9)], 1)
    rows = Q.usable(read_messages(text_stream(spark, str(inbox), 1), TRADES), TRADES)
    stream = K.hopping_ticker_stream(rows, "1 hour", "1 hour", "1 minute")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    I.start_versions(stream, out, checkpoint, NOW).awaitTermination()
    write_files(inbox, [message(2, t=1000)], 1)
    query = I.start_versions(stream, out, checkpoint, NOW)
    query.awaitTermination()
    dropped = sum(
        o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]
    )
    assert dropped == 1


def test_job_from_the_command_line(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_files(inbox, [message(i) for i in range(6)] + ["x"], 2)
    paths = {n: str(tmp_path / n) for n in ("table", "quarantine", "checkpoint")}
    argv = ["trades", "--files", str(inbox), "--max-bytes", "1000", "--available-now"]
    for name, where in paths.items():
        argv += [f"--{name}", where]
    for _ in range(2):
        job.main(argv)
        assert S.read_table(spark, TRADES, paths["table"]).count() == 6
        assert S.read_quarantine(spark, paths["quarantine"]).count() == 1

    with pytest.raises(SystemExit):
        job.arguments(["trades", "--files", "x", "--table", "y", "--checkpoint", "z"])
    args = job.arguments(
        ["ticker_1h", "--servers", "b:1", "--jdbc", "jdbc:x", "--jdbc-option", "user=u",
         "--quarantine", "q", "--checkpoint", "c", "--interval", "5 seconds"]
    )
    assert job.trigger(args) == {"processingTime": "5 seconds"}
    assert args.starting == "latest" and args.jdbc_option == ["user=u"]


def test_console_sink(spark, tmp_path):
    inbox = tmp_path / "inbox"
    write_files(inbox, [message(1)], 1)
    rows = read_messages(text_stream(spark, str(inbox)), TRADES)
    query = I.start_console(rows, str(tmp_path / "checkpoint"), NOW)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_closed_windows_leave_out_late_trades_and_count_them(spark, tmp_path):
    """Period 10 s, slide 4 s: steps of 2 s, closed once the watermark (1 s back) has passed them."""
    inbox, out, checkpoint = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    at = {1: 20_000, 2: 21_500, 3: 26_000, 4: 45_000}
    late = [message(9, t=20_100, price="99"), message(10, t=44_500, price="7")]
    dropped = 0
    for messages in ([message(i, t=t, price=str(i)) for i, t in at.items()], late, [message(11, t=80_000)]):
        write_files(inbox, messages, 1)
        rows = Q.usable(read_messages(text_stream(spark, str(inbox)), TRADES), TRADES)
        windows = K.closed_windows_stream(rows, 10_000, 4_000, "1 second")
        query = I.start_closed(windows, out, checkpoint, NOW)
        query.awaitTermination()
        dropped += I.late_rows(query)
    assert dropped == 1  # trade 9; trade 10 is older than the newest, but its step is open
    kept = [*at.values(), 44_500]
    expected = {}
    for start in range(0, 80_000, 4_000):
        inside = [t for t in kept if start <= t < start + 10_000]
        if inside and start + 10_000 <= 79_000:
            expected[start] = len(inside)
    got = spark.read.parquet(out).withColumn("start", F.unix_millis("window_start")).collect()
    assert {r["start"]: r["total_trades"] for r in got} == expected
    assert len(got) == len(expected) and max(r["high_price"] for r in got) == 7.0
    first = next(r for r in got if r["start"] == 16_000)
    assert (first["open_price"], first["last_price"], first["volume"]) == (1.0, 2.0, 4.0)
