"""Serving tables: Parquet with first-write-wins epochs, and JDBC.

Layout of a Parquet table::

    table/<partition column>=<value>/writer=<query id>/epoch=<batch id>/part-*
    table/_zones/...    what each epoch holds, see ``sources.zones``

The partition column comes first, so a look-up for a few partitions lists their
folders only and does not slow down as the table grows.  One query writes to a
table at a time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.contracts import POSITION, StreamSpec
from tapeflow.functions.decode import to_table_types
from tapeflow.functions.times import utc_date
from tapeflow.operators.quality import conflicts_with, first_per_key, reject_known
from tapeflow.sources.zones import folders_of, read_folders, write_zones


#: A column by which rows lie together is cut into this power of two of ranges.
CELL_BITS = 6


class Reach(NamedTuple):
    """Where a table may hold the keys of some rows: which partitions and their folders, the
    ends of the keys, and as a table (p, s, low, high) their spans by partition and symbol."""

    named: list
    partitions: Column
    folders: str
    keys: Column
    low: int
    high: int
    spans: DataFrame


def _layout(spec: StreamSpec) -> list[str]:
    return [spec.partition, "writer", "epoch"]


def create_table(spark: SparkSession, spec: StreamSpec, path: str) -> None:
    """Create the table unless it exists."""
    empty = spark.createDataFrame([], spec.stored_schema)
    empty.write.mode("ignore").partitionBy(*_layout(spec)).parquet(path)


def stored_rows(
    spark: SparkSession, spec: StreamSpec, path: str, folders: str | None = None
) -> DataFrame:
    """All rows, or those in matching folders, with the partition column, ``writer``
    and ``epoch``."""
    reader = spark.read.schema(spec.stored_schema).option("basePath", path)
    return reader.parquet(f"{path}/{folders}" if folders else path)


def read_table(
    spark: SparkSession, spec: StreamSpec, path: str, since: int | None = None
) -> DataFrame:
    """The table's columns; ``since`` (epoch ms) leaves older rows out.

    Where the table is partitioned by date, older folders are not read.
    """
    rows = stored_rows(spark, spec, path)
    if since is not None:
        rows = rows.where(F.col("event_time") >= F.lit(since))
        if spec.partition == "event_date":
            rows = rows.where(F.col("event_date") >= utc_date(since))
    return rows.select(*spec.column_names)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make the tables known to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def reach_of(rows: DataFrame, spec: StreamSpec) -> Reach | None:
    """The partitions and the spans of the leading key that ``rows`` fall in; None
    for no rows.

    Rows with a NULL key are refused.  The partition depends on the key alone, so no
    equal key is elsewhere.  What comes to the driver is one row per partition that the
    batch touches, whose folders its write would list as well.
    """
    partition, lead = F.col(spec.partition), F.col(spec.key[0])
    placed = rows.select(F.col("symbol").alias("s"), lead.alias("k"), spec.partition_value().alias("p"))
    no_key = F.col("k").isNull() | F.col("s").isNull()
    # Symbols are a key here, not a figure, so the rows need no sort.
    spans = placed.groupBy("p", "s").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.max(no_key).alias("no_key")
    )
    touched = spans.groupBy("p").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("s").alias("first"),
        F.max("s").alias("last"), F.max("no_key").alias("no_key"),
    ).collect()
    if not touched:
        return None
    if any(t.no_key or t.p is None for t in touched):
        raise ValueError("rows with a NULL key cannot be appended; set them aside first")

    def value(p) -> Column:
        # By way of text, which carries dates of any year.
        return F.lit(str(p)).cast(spec.partition_type)

    named = sorted({t.p for t in touched})
    low, high = min(t.low for t in touched), max(t.high for t in touched)
    symbols = F.col("symbol").between(min(t.first for t in touched), max(t.last for t in touched))
    return Reach(
        named,
        partition.isin([value(p) for p in named]),
        folders_of(spec, named),
        lead.between(low, high) & symbols,
        low,
        high,
        spans.drop("no_key"),
    )


def held_within(spark: SparkSession, spec: StreamSpec, path: str, reach: Reach) -> DataFrame:
    """What the table holds there.

    The folders of the batch's partitions are listed; files are sorted by symbol and time and
    epochs are narrow in both, so the ends of the keys skip most row groups; a semi-join with
    the spans, a row per partition and symbol, leaves out what lies between them.  These few rows
    are sent to the tasks, so what is stored stays where it is read.
    """
    stored = read_folders(spark, path, reach.folders, spec.stored_schema)
    if stored is None:
        return spark.createDataFrame([], spec.stored_schema)
    inside = (
        (F.col(spec.partition) == F.col("p"))
        & (F.col("symbol") == F.col("s"))
        & F.col(spec.key[0]).between(F.col("low"), F.col("high"))
    )
    return stored.where(reach.partitions & reach.keys).join(F.broadcast(reach.spans), inside, "left_semi")


def write_epoch(
    rows: DataFrame, spec: StreamSpec, path: str, writer: str, epoch: int,
    cell: Column | None = None, rows_per_file: int = 0,
) -> None:
    """Write the rows of one epoch; folders it wrote before are replaced.

    Rebalancing splits a busy partition over several tasks and packs small ones;
    sorting by symbol and time makes row-group statistics selective.  With ``cell`` tasks take
    ranges of cells, and rows are sorted by them first.
    """
    rows = rows.withColumn(spec.partition, spec.partition_value())
    order = ["symbol", "event_time"]
    if cell is None:
        rows = rows.hint("rebalance", spec.partition)
    else:
        rows = rows.withColumn("_cell", cell)
        rows = rows.repartitionByRange(spec.partition, "_cell", *order)
        order = ["_cell", *order]
    (
        rows.withColumns({"writer": F.lit(writer), "epoch": F.lit(epoch).cast("bigint")})
        .sortWithinPartitions(spec.partition, "writer", "epoch", *order)
        .drop("_cell")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*_layout(spec))
        .parquet(path)
    )


def append_once(
    rows: DataFrame, spec: StreamSpec, path: str, writer: str, epoch: int,
    conflicts_path: str | None = None,
) -> None:
    """Append the rows whose key the table does not hold yet.

    Running it again with the same rows changes nothing: under the same writer and
    epoch it replaces its own rows, under another it finds every key taken.  For
    the former the look-up leaves out its own epoch; a half-written one would
    otherwise make the retry drop its rows.

    ``rows`` is read several times, so callers cache it.  Where it has the columns of
    ``POSITION``, the first of equal keys is the first in the topic; a topic keeps that
    order within a partition, so any cut into batches gives the same table where equal
    keys share a partition.
    """
    spark = rows.sparkSession
    create_table(spark, spec, path)
    position = tuple(c for c in POSITION if c in rows.columns)
    rows = to_table_types(rows, spec, position)
    reach = reach_of(rows, spec)
    if reach is None:
        return
    mine = (F.col("writer") == writer) & (F.col("epoch") == epoch)
    known = held_within(spark, spec, path, reach).where(~mine)
    firsts = first_per_key(rows, spec.key, position).drop(*position)
    write_epoch(reject_known(firsts, known, spec.key), spec, path, writer, epoch)
    write_zones(spark, spec, path, writer, epoch, reach.named)
    if conflicts_path:
        held = held_within(spark, spec, path, reach)
        write_report(conflicts_with(rows.drop(*position), held, spec.key), conflicts_path, writer, epoch)


def write_report(rows: DataFrame, path: str, writer: str, epoch: int) -> None:
    """Replace one epoch of a report (conflicts, quarantine); an empty one leaves no
    file."""
    (
        rows.hint("rebalance")
        .withColumns({"writer": F.lit(writer), "epoch": F.lit(epoch).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("writer", "epoch")
        .parquet(path)
    )


def read_quarantine(spark: SparkSession, path: str, with_place: bool = False) -> DataFrame:
    """Messages set aside, on demand with their place in the topic, NULL where the source
    has none."""
    place = "partition int, offset bigint, timestamp timestamp, " if with_place else ""
    schema = f"reason string, raw string, {place}writer string, epoch bigint"
    return spark.read.schema(schema).parquet(path)


def _cell(rows: DataFrame, names: tuple[str, ...]) -> Column:
    """The cell of a row in a grid of equally filled ranges of each column, numbered by the
    ranges' interleaved bits: rows of near numbers are near in all columns.

    The ranges are quantiles, so single absurd values do not widen them; one row of
    them comes to the driver.  Rows without a value are in the first range.
    """
    shares = [i / (1 << CELL_BITS) for i in range(1, 1 << CELL_BITS)]
    cuts = rows.agg(*[F.percentile_approx(name, shares, 1000).alias(name) for name in names]).first()

    def place_of(name: str) -> Column:
        given = F.lit(sorted(set(cuts[name] or []))).cast("array<bigint>")
        return F.size(F.filter(given, lambda cut: cut <= F.col(name)))

    cell = F.lit(0).cast("bigint")
    for at, name in enumerate(names):
        place = place_of(name)
        for bit in range(CELL_BITS):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            cell = cell.bitwiseOR(F.shiftleft(one, bit * len(names) + at))
    return cell


def compact(
    spark: SparkSession, spec: StreamSpec, source: str, target: str, chosen: Column | None = None,
    near: tuple[str, ...] = (), rows_per_file: int = 0,
) -> None:
    """Rewrite a table of many small epochs as one epoch of another table.

    ``near`` names whole-number columns by which rows lie together, such as the id and the time
    of trades: a read of a range of any of them then touches few row groups, whichever it is.
    Without it rows lie by symbol and time.  ``rows_per_file`` bounds files by rows.

    ``chosen``, a condition on the partition column, limits this to some partitions,
    such as dates that are over; the target's other partitions stay as they are.

    To go on with the target: stop the writing query, compact, start it again on the
    target.  Should its last epoch be retried there, every key is found taken.  The
    source stays as it is.
    """
    create_table(spark, spec, target)
    rows = stored_rows(spark, spec, source)
    if chosen is not None:
        rows = rows.where(chosen)
    rows = rows.select(*spec.column_names)
    write_epoch(rows, spec, target, "compacted", 0, _cell(rows, near) if near else None, rows_per_file)
    write_zones(spark, spec, target, "compacted", 0)


def jdbc_options(
    url: str, table: str, partitions: int | None = None, batch_size: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of the JDBC reader and writer (``user``, ``password``, ``driver``, …)."""
    options = {"url": url, "dbtable": table, **more}
    if partitions:
        options["numPartitions"] = str(partitions)
    if batch_size:
        options["batchsize"] = str(batch_size)
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("append").save()


def append_jdbc(rows: DataFrame, spec: StreamSpec, options: dict[str, str]) -> None:
    """Append to a database table what it does not hold yet.

    Each writing task commits alone, so a failed attempt may leave a part of its
    rows; the retry finds their keys taken.  The look-up is limited to the key
    spans of the batch, which the database evaluates, and is read in
    ``numPartitions`` ranges of the leading key.
    """
    position = tuple(c for c in POSITION if c in rows.columns)
    rows = to_table_types(rows, spec, position)
    reach = reach_of(rows, spec)
    if reach is None:
        return
    look_up = dict(options)
    if "numPartitions" in options:
        look_up |= {
            "partitionColumn": spec.key[0],
            "lowerBound": str(reach.low),
            "upperBound": str(min(reach.high + 1, 2**63 - 1)),
        }
    known = read_jdbc(rows.sparkSession, look_up).where(reach.keys)
    firsts = first_per_key(rows, spec.key, position).drop(*position)
    write_jdbc(reject_known(firsts, known, spec.key), options)
