"""Container log records to labelled lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tapeflow.functions.times import floor_div, in_range
from tapeflow.operators.quality import counted

# Job label, file pattern, path pattern and attribute names.
LOG_JOB = "containerlogs"
LOG_GLOB = "/var/lib/docker/containers/*/*log"
CONTAINER_PATH = r"^/var/lib/docker/containers/(.{12}).+/.+-json.log$"
ATTRIBUTES = {
    "tag": "tag",
    "compose_project": "com.docker.compose.project",
    "compose_service": "com.docker.compose.service",
    "stack_name": "com.docker.stack.namespace",
    "swarm_service_name": "com.docker.swarm.service.name",
    "swarm_task_name": "com.docker.swarm.task.name",
}
RECORD = "log string, stream string, time string, attrs map<string,string>"


def shape_logs(
    records: DataFrame, job: str = LOG_JOB, container_path: str = CONTAINER_PATH,
    observed: Observation | str | None = None,
) -> DataFrame:
    """``value`` (one JSON record) and ``path`` to timestamp, line and labels.

    The first group of ``container_path`` is the container's id.

    A record that is not JSON, or holds no text, is its own line, without a time.  The
    time is cut to microseconds; its text is kept to order lines below that.  ``observed`` is told
    how many records there were, how many had no text and how many lines have no time.
    As in ``decode``, the generator keeps filters from parsing a record again.
    """
    record = F.from_json(F.col("value").cast("string"), RECORD)
    parsed = records.select("path", "value", F.explode(F.array(record)).alias("record"))
    container, time = F.regexp_extract("path", container_path, 1), F.try_to_timestamp("record.time")
    if observed is not None:
        unparsed = F.col("record.log").isNull()
        parsed = counted(parsed, observed, unparsed=unparsed, without_time=time.isNull())
    return parsed.select(
        time.alias("ts"),
        F.coalesce("record.log", F.col("value").cast("string")).alias("line"),
        F.lit(job).alias("job"),
        F.col("record.stream").alias("stream"),
        F.when(container != "", container).alias("container_id"),
        *[F.col("record.attrs").getItem(key).alias(name) for name, key in ATTRIBUTES.items()],
        F.col("record.time").alias("time_text"),
    )


def log_date(ts: Column) -> Column:
    """The UTC date of a time."""
    return F.date_from_unix_date(floor_div(F.unix_seconds(ts), 86_400).cast("int"))


def log_hour(ts: Column) -> Column:
    """The UTC hour of the day."""
    return F.pmod(floor_div(F.unix_seconds(ts), 3600), F.lit(24)).cast("int")


def _folders(first: Column, last: Column) -> Column:
    """Dates and hours that the range from ``first`` to ``last`` touches."""
    date, hour = F.col("log_date"), F.col("log_hour")
    since = (date > log_date(first)) | ((date == log_date(first)) & (hour >= log_hour(first)))
    until = (date < log_date(last)) | ((date == log_date(last)) & (hour <= log_hour(last)))
    return since & until


def tail(
    lines: DataFrame, as_of: Column, back: str = "5 minutes", n: int | None = None, job: str = LOG_JOB
) -> DataFrame:
    """The lines of a job in the range, newest first, copies kept; all, or the first ``n``.

    Of stored lines only the folders of the range's hours are read.
    """
    chosen = lines.where((F.col("job") == job) & in_range(F.col("ts"), as_of, back))
    if {"log_date", "log_hour"} <= set(lines.columns):
        chosen = chosen.where(_folders(as_of - F.expr(f"INTERVAL {back}"), as_of))
    chosen = chosen.orderBy(F.col("ts").desc(), F.col("time_text").desc(), F.col("line"))
    return chosen if n is None else chosen.limit(n)
