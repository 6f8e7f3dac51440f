"""Message text to typed columns.  No shuffle, no Python on the row path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeflow.contracts import CORRUPT, StreamSpec


def decode(messages: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` (bytes or text) to ``raw, message`` and the ``keep`` columns.

    ``from_json`` runs inside ``explode`` of a one-element array: a filter on the
    decoded fields stays above the generator, so each message is parsed once
    however many predicates are put on top.

    The cast renames the fields by position.  ``t``/``T`` and the like can then be
    told apart without the session-wide case-sensitivity flag.
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(
        text, spec.wire_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ).cast(spec.message_type)
    return messages.select(*keep, text.alias("raw"), F.explode(F.array(parsed)).alias("message"))


def project(decoded: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decoded messages to the table's columns plus ``raw`` and ``reason``.

    ``reason`` is NULL for a usable row, else the first of ``empty``,
    ``malformed``, ``null_key``, ``bad_number`` that applies.
    """
    columns = {
        c.name: F.col(f"message.{c.source}").try_cast(c.stream_type) for c in spec.columns
    }
    null_key = F.lit(False)
    for name in spec.key:
        null_key = null_key | columns[name].isNull()
    bad_number = F.lit(False)
    for c in spec.columns:
        if c.is_number_from_text:
            text = F.col(f"message.{c.source}")
            bad_number = bad_number | (text.isNotNull() & columns[c.name].isNull())
    reason = (
        F.when(F.col("message").isNull(), "empty")
        .when(F.col(f"message.{CORRUPT}").isNotNull(), "malformed")
        .when(null_key, "null_key")
        .when(bad_number, "bad_number")
    )
    return decoded.select(
        *keep, *[c.alias(name) for name, c in columns.items()], "raw", reason.alias("reason")
    )


def read_messages(messages: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages to classified rows, for batch and stream alike."""
    return project(decode(messages, spec, keep), spec, keep)


def to_table_types(rows: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The column set, order and types fixed by the table, and the ``keep`` columns."""
    columns = [F.col(c.name).cast(c.table_type).alias(c.name) for c in spec.columns]
    return rows.select(*columns, *keep)
