"""Messages to tables, one query per topic."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeflow.contracts import ARRIVAL, POSITION, StreamSpec
from tapeflow.functions.decode import read_messages
from tapeflow.operators.quality import quarantined, usable
from tapeflow.sources.log_table import write_lines
from tapeflow.sources.tables import append_jdbc, append_once, write_report

BatchSink = Callable[[DataFrame, int, str], None]


def query_id(batch: DataFrame) -> str:
    """The id of the running query: bound to its checkpoint, the same on a retry."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def parquet_sink(spec: StreamSpec, table: str, conflicts: str | None = None) -> BatchSink:
    def write(rows: DataFrame, epoch: int, writer: str) -> None:
        append_once(rows, spec, table, writer, epoch, conflicts)

    return write


def jdbc_sink(spec: StreamSpec, options: dict[str, str]) -> BatchSink:
    def write(rows: DataFrame, epoch: int, writer: str) -> None:
        append_jdbc(rows, spec, options)

    return write


def _started(writer, trigger: dict | None) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_ingest(
    messages: DataFrame,
    spec: StreamSpec,
    sink: BatchSink,
    quarantine: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the query of one topic.

    Each micro-batch is decoded once, cached, and written as new rows and
    quarantined messages.  Without ``trigger`` the next batch starts when the last
    one ends.  A backfill runs the same query with ``{"availableNow": True}`` and a
    size limit on the source.

    Where the source says at which partition and offset a message is, the first write of
    a key is the first there, and messages set aside carry their place and time.
    """
    position = tuple(c for c in POSITION if c in messages.columns)
    place = (*position, *[c for c in (ARRIVAL,) if c in messages.columns])

    def on_batch(batch: DataFrame, epoch: int) -> None:
        writer = query_id(batch)
        # The text is kept for bad messages only, which keeps the cache small.
        raw = F.when(F.col("reason").isNotNull(), F.col("raw"))
        batch = batch.withColumn("raw", raw).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sink(usable(batch, spec, position), epoch, writer)
            write_report(quarantined(batch, place), quarantine, writer, epoch)
        finally:
            batch.unpersist()

    writer = (
        read_messages(messages, spec, place)
        .writeStream.queryName(f"ingest {spec.name}")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    return _started(writer, trigger)


def start_log_ingest(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store shaped log lines by date and hour; a retried batch replaces its own lines."""

    def on_batch(batch: DataFrame, epoch: int) -> None:
        write_lines(batch, path, query_id(batch), epoch)

    writer = (
        lines.writeStream.queryName("ingest logs")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    return _started(writer, trigger)


def start_console(
    rows: DataFrame, checkpoint: str, trigger: dict | None = None, n: int = 20
) -> StreamingQuery:
    """Print rows of a stream, for debugging."""
    writer = (
        rows.writeStream.outputMode("append")
        .format("console")
        .option("numRows", n)
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
    )
    return _started(writer, trigger)


def start_closed(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows that never change, such as closed windows, to a folder of Parquet files."""
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _started(writer, trigger)


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark left out, over the batches the session keeps the progress of.

    Late rows of one group and task are put together first and count once.
    """
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in json.loads(progress.json)["stateOperators"]
    )


def reported(query: StreamingQuery, name: str) -> dict[str, int]:
    """The numbers reported under ``name``, over the batches the session keeps the progress of."""
    total: Counter[str] = Counter()
    for progress in query.recentProgress:
        total.update(json.loads(progress.json).get("observedMetrics", {}).get(name, {}))
    return dict(total)


def start_versions(
    aggregate: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write every version of an aggregate's changed groups, one folder per epoch.

    ``path`` belongs to ``checkpoint``; another checkpoint needs another path.
    """

    def on_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/writer={query_id(batch)}/epoch={epoch}")

    writer = (
        aggregate.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    return _started(writer, trigger)


def last_versions(versions: DataFrame, *key: str) -> DataFrame:
    """The newest version of each group."""
    others = [c for c in versions.columns if c not in (*key, "writer", "epoch")]
    return versions.groupBy(*key).agg(*[F.max_by(c, "epoch").alias(c) for c in others])
