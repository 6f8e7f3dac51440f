"""Message sources: topics, text files, log files; and the message encoder."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tapeflow.contracts import StreamSpec
from tapeflow.functions.display import plain_decimal
from tapeflow.operators.logs import LOG_GLOB


def kafka_options(
    servers: str, topics: Iterable[str], starting: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    """Reader options.  ``starting`` counts for a new checkpoint only."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(
    spark: SparkSession, servers: str, topics: Iterable[str], starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Topics as a stream of ``key, value, topic, partition, offset, timestamp``.

    Needs the Kafka connector on the class path.
    """
    options = kafka_options(servers, topics, starting, max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def one_topic(messages: DataFrame, topic: str) -> DataFrame:
    return messages.where(F.col("topic") == topic)


def text_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """A folder of text files, one message per line, as a stream of ``value``.

    ``max_files`` or ``max_bytes`` limits what one batch takes in.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def log_stream(spark: SparkSession, glob: str = LOG_GLOB) -> DataFrame:
    """Log files as a stream of ``value, path``; the checkpoint keeps which were read.

    A file is read once, so the pattern should match files that no longer grow,
    such as rotated ones.
    """
    return with_path(spark.readStream.format("text").load(glob))


def log_files(spark: SparkSession, glob: str = LOG_GLOB) -> DataFrame:
    return with_path(spark.read.format("text").load(glob))


def with_path(lines: DataFrame) -> DataFrame:
    """File paths without their scheme, as the path pattern expects them."""
    path = F.regexp_replace("_metadata.file_path", r"^[a-z0-9]+:/+", "/")
    return lines.select("value", path.alias("path"))


def fan_in(frames: Iterable[DataFrame]) -> DataFrame:
    """Several sources into one topic; nothing is merged or dropped."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def encode(rows: DataFrame, spec: StreamSpec, constants: dict[str, Column] | None = None) -> Column:
    """A row as message bytes; message fields without a column are left out."""
    constants = constants or {}
    types = {f.name: f.dataType for f in rows.schema.fields}
    fields = []
    for wire, kind, name in spec.fields:
        if name in constants:
            fields.append(constants[name].cast(kind).alias(wire))
        elif name in types:
            column, found = F.col(name), types[name]
            if kind == "string" and isinstance(found, DecimalType):
                column = plain_decimal(column, found.scale)
            fields.append(column.cast(kind).alias(wire))
    return F.to_json(F.struct(*fields)).cast("binary")
