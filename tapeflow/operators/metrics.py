"""Operational figures: rates, totals, rows per table, liveness, labels.

``messages`` frames have ``topic``, ``value`` (bytes or text) and ``ts``, which is
what a topic source calls ``timestamp``; metric samples have ``metric``, ``labels`` (map), ``ts`` and ``value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.functions.times import floor_div, in_range

SAMPLE_COLUMNS = ("metric", "labels", "ts", "value")

# Fixed values of a decayed rate: its step, and the steps in which it decays to 1/e.
_TICK_MICROS = 5_000_000
_TICKS = 12

#: exp(-60) to this power is below the least double.
_HOURS_FELT = 13


def whole_minutes(messages: DataFrame, as_of: Column, back: str = "5 minutes") -> DataFrame:
    """The messages of all minutes that begin in the range, for rates that are asked over it.

    The bounds have the type of ``ts``, so that the filter reaches the scan.
    """
    kind = messages.schema["ts"].dataType
    first = F.date_trunc("minute", as_of - F.expr(f"INTERVAL {back}")).cast(kind)
    end = (F.date_trunc("minute", as_of) + F.expr("INTERVAL 1 MINUTE")).cast(kind)
    return messages.where((F.col("ts") >= first) & (F.col("ts") < end))


def _per_minute(messages: DataFrame) -> DataFrame:
    return messages.groupBy(F.window("ts", "1 minute"), "topic").agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("value")).alias("bytes")
    )


def messages_per_second(messages: DataFrame) -> DataFrame:
    """Messages per second of each topic and minute."""
    return _per_minute(messages).select(
        F.col("window.start").alias("window_start"),
        "topic",
        (F.col("messages") / F.lit(60.0)).alias("msgs_per_sec_1m"),
    )


def decayed_rate(messages: DataFrame) -> DataFrame:
    """The exponentially decayed one-minute rate of each topic, at the end of its minutes.

    The usual meter: every five seconds the rate moves by ``1 - exp(-5/60)`` towards the rate of
    these five seconds, from that of the topic's first five.  Minutes with messages have a row;
    ``s`` seconds later the rate is ``exp(-s/60)`` of it.

    The recurrence is linear, so it is run by blocks: a running sum inside an hour, with weights
    that stay far from the limits of a double, and what earlier hours leave to it.  An hour decays
    by ``exp(-60)``, so hours more than ``_HOURS_FELT`` back are zero as a double, and each hour's
    sum goes to so many later ones.  No task holds more than an hour's minutes of a topic.
    """
    tick = floor_div(F.unix_micros(F.col("ts").cast("timestamp")), _TICK_MICROS)
    ticks = messages.where(F.col("ts").isNotNull()).groupBy("topic", tick.alias("tick")).agg(F.count("*").alias("n"))
    first = ticks.groupBy("topic").agg(F.min("tick").alias("tick"), F.lit(True).alias("opens"))
    gain = F.lit(1.0) - F.exp(F.lit(-1.0 / _TICKS))
    rate = F.col("n") * F.lit(1e6 / _TICK_MICROS) * F.when(F.col("opens"), 1.0).otherwise(gain)
    minute = floor_div(F.col("tick"), _TICKS)
    # Sums over ticks j are kept as the sum of rate_j * exp(j - end of the minute).
    minutes = (
        ticks.join(first, ["topic", "tick"], "left")
        .groupBy("topic", minute.alias("minute"))
        .agg(F.sum(rate * F.exp((F.pmod("tick", F.lit(_TICKS)) - (_TICKS - 1)) / F.lit(float(_TICKS)))).alias("sum"))
        .withColumn("hour", floor_div(F.col("minute"), 60))
    )
    grown = F.col("sum") * F.exp((F.col("minute") - F.col("hour") * 60).cast("double"))
    carried = (
        minutes.groupBy("topic", "hour")
        .agg(F.sum(grown).alias("grown"))
        .withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(_HOURS_FELT))))
        .groupBy("topic", (F.col("hour") + F.col("ahead")).alias("hour"))
        .agg(F.sum(F.col("grown") * F.exp(F.col("ahead") * -60.0)).alias("grown"))
        .select("topic", "hour", F.lit(None).cast("bigint").alias("minute"), "grown")
    )
    inside = (
        Window.partitionBy("topic", "hour")
        .orderBy(F.col("minute").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        minutes.select("topic", "hour", "minute", grown.alias("grown"))
        .unionByName(carried)
        .withColumn("reached", F.sum("grown").over(inside))
        .where(F.col("minute").isNotNull())
        .select(
            "topic",
            F.timestamp_seconds(F.col("minute") * 60).alias("window_start"),
            (F.col("reached") * F.exp((F.col("hour") * 60 - F.col("minute")).cast("double"))).alias(
                "one_minute_rate"
            ),
        )
    )


def bytes_per_second(messages: DataFrame) -> DataFrame:
    """Message bytes per second of each topic and minute."""
    return _per_minute(messages).select(
        F.col("window.start").alias("window_start"),
        "topic",
        (F.col("bytes") / F.lit(60.0)).alias("bytes_per_sec_1m"),
    )


def _cumulative(
    rows: DataFrame, group: str, block: Column, order: str, values: dict[str, str]
) -> DataFrame:
    """Running totals of ``values`` (column to result name) per ``group``.

    Totals run inside a block.  What the blocks before it add up to comes in as the
    block's first row.  So no task holds more than one block's rows or one row per
    block of a group, and the rows are computed once.
    """
    rows = rows.withColumn("_block", block).withColumn("_carry", F.lit(False))
    before = (
        Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.groupBy(group, "_block")
        .agg(*[F.sum(v).alias(v) for v in values])
        .select(
            group, "_block", F.lit(True).alias("_carry"),
            *[F.sum(v).over(before).alias(v) for v in values],
        )
    )
    inside = (
        Window.partitionBy(group, "_block")
        .orderBy(F.col("_carry").desc(), order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumns({name: F.sum(v).over(inside) for v, name in values.items()})
        .where(~F.col("_carry"))
        .drop("_block", "_carry")
    )


def running_totals(messages: DataFrame) -> DataFrame:
    """Messages and bytes of a topic up to the end of each minute."""
    minutes = _per_minute(messages).select(
        "topic", F.col("window.start").alias("window_start"), "messages", "bytes"
    )
    names = {"messages": "messages_total", "bytes": "bytes_total"}
    day = F.to_date("window_start")
    totals = _cumulative(minutes, "topic", day, "window_start", names)
    return totals.drop("messages", "bytes")


def messages_per_topic(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(
        F.count("*").alias("messages_total"),
        F.sum(F.octet_length("value")).alias("bytes_total"),
    )


def rows_per_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; the scans need no columns."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def rows_per_epoch(stored: DataFrame) -> DataFrame:
    """Rows each writer inserted per epoch, counted in the table itself.

    A retried epoch replaces its own rows and is therefore never counted twice.
    """
    return stored.groupBy("writer", "epoch").agg(F.count("*").alias("rows_inserted"))


def rows_inserted_total(stored: DataFrame) -> DataFrame:
    """The running number of inserted rows of each writer."""
    return inserted_so_far(rows_per_epoch(stored))


def inserted_so_far(per_epoch: DataFrame) -> DataFrame:
    """``rows_per_epoch``, counted in the table or from its zones, with the running number."""
    block = floor_div(F.col("epoch"), 10_000)
    names = {"rows_inserted": "rows_inserted_total"}
    return _cumulative(per_epoch, "writer", block, "epoch", names)


def liveness(
    events: DataFrame, sources: list[str], as_of: Column, source: str, ts: str,
    back: str = "5 minutes",
) -> DataFrame:
    """1 for each configured source heard from in the range up to ``as_of``, else 0.

    The range filter comes first and reaches the scan; only recent rows are read.
    """
    spark = events.sparkSession
    heard = (
        events.where(in_range(F.col(ts), as_of, back)).select(F.col(source).alias("source"))
    ).distinct()
    expected = spark.createDataFrame([(s,) for s in sources], "source string")
    return expected.join(heard.withColumn("is_live", F.lit(1)), "source", "left").select(
        "source", F.coalesce("is_live", F.lit(0)).alias("is_live")
    )


def outages(
    events: DataFrame, as_of: Column, source: str, ts: str, gap: str = "5 minutes"
) -> DataFrame:
    """(source, down_from, down_until): when each source was silent for longer than ``gap``.

    A source is up from an event until ``gap`` after it, so its uptimes are session windows;
    an outage lies between the end of one and the start of the next.  The last one is open
    (NULL) where the source has not been heard from again by ``as_of``.  Events of one source and
    minute are merged before the shuffle, so a task gets a few rows per minute and source.
    """
    heard = events.where(F.col(ts).isNotNull() & F.col(source).isNotNull() & (F.col(ts) <= as_of))
    minutes = heard.groupBy(F.col(source).alias("source"), F.date_trunc("minute", F.col(ts)).alias("minute")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    ends = minutes.select("source", F.explode(F.array_distinct(F.array("first", "last"))).alias("at"))
    up = ends.groupBy("source", F.session_window("at", gap).alias("up")).agg(F.count("*").alias("n"))
    later = F.lead("up.start").over(Window.partitionBy("source").orderBy("up.start"))
    down = up.select("source", F.col("up.end").alias("down_from"), later.alias("down_until"))
    return down.where(F.col("down_until").isNotNull() | (F.col("down_from") < as_of))


def label_values(rows: DataFrame, label: Column | str) -> DataFrame:
    """The distinct values of a label in ascending order."""
    column = F.col(label) if isinstance(label, str) else label
    return rows.select(column.alias("label_value")).distinct().orderBy("label_value")


def as_samples(
    rows: DataFrame, metric: str, value: str, ts: Column, **labels: Column | str
) -> DataFrame:
    """Any figure as metric samples; a plain string is a constant label."""
    pairs = []
    for name, label in labels.items():
        pairs += [F.lit(name), F.lit(label) if isinstance(label, str) else label]
    return rows.select(
        F.lit(metric).alias("metric"),
        F.create_map(*pairs).alias("labels"),
        ts.alias("ts"),
        F.col(value).cast("double").alias("value"),
    )


def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Samples of one metric that carry all the given labels."""
    chosen = F.col("metric") == metric
    for name, value in labels.items():
        chosen = chosen & (F.col("labels").getItem(name) == value)
    return samples.where(chosen)


def last_sample(samples: DataFrame, as_of: Column, back: str = "5 minutes") -> DataFrame:
    """The newest sample in the range of every series.

    A map cannot be a grouping key, its sorted entries can.
    """
    entries = F.array_sort(F.map_entries("labels"))
    return (
        samples.where(in_range(F.col("ts"), as_of, back))
        .groupBy("metric", entries.alias("entries"))
        .agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
        .select("metric", F.map_from_entries("entries").alias("labels"), "ts", "value")
    )
