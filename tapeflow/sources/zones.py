"""What each epoch of a table holds: rows, times, keys and extremes by symbol.

Zones lie beside the data, in a folder that table readers skip, one row for each partition,
epoch and symbol::

    table/_zones/<partition column>=<value>/writer=<query id>/epoch=<batch id>/part-*

They are made from the epoch's own files once these are there and replaced as those are, so
retries, replays and compaction leave them in step; an epoch counts for the functions here
once its zones are written.  Counts and extremes of a whole table are sums and extremes of its
zones, and the newest rows are found by reading only what zones say is new enough.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.contracts import StreamSpec
from tapeflow.functions.times import is_time, query_time
from tapeflow.operators.latest import from_time


def zone_path(path: str) -> str:
    return f"{path}/_zones"


def folders_of(spec: StreamSpec, partitions: list | None) -> str:
    """A pattern for the folders of some partitions, or of all."""
    return f"{spec.partition}=" + ("*" if partitions is None else f"{{{','.join(map(str, partitions))}}}")


def _extremes(spec: StreamSpec) -> tuple[str, str]:
    return ("low_price", "high_price") if "low_price" in spec.column_names else ("price", "price")


def _schema(spec: StreamSpec) -> str:
    return (
        "symbol string, rows bigint, untimed bigint, first_time bigint, last_time bigint, first_key bigint, "
        f"last_key bigint, low double, high double, {spec.partition} {spec.partition_type}, writer string, epoch bigint"
    )


def read_folders(spark: SparkSession, path: str, folders: str, schema) -> DataFrame | None:
    """The rows in some folders, None where there are none."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{folders}".rstrip("/"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def zones_of(stored: DataFrame, spec: StreamSpec) -> DataFrame:
    """Zones of stored rows.  Times that are none count as ``untimed``, as those that are NULL."""
    low, high = _extremes(spec)
    time, key = F.col("event_time"), F.col(spec.key[0])
    timed = F.coalesce(is_time(time), F.lit(False))
    return stored.groupBy(spec.partition, "writer", "epoch", "symbol").agg(
        F.count("*").alias("rows"),
        F.count_if(~timed).alias("untimed"),
        F.min(F.when(timed, time)).alias("first_time"),
        F.max(F.when(timed, time)).alias("last_time"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.min(low).cast("double").alias("low"),
        F.max(high).cast("double").alias("high"),
    )


def write_zones(
    spark: SparkSession, spec: StreamSpec, path: str, writer: str, epoch: int, partitions: list | None = None
) -> None:
    """Write or replace the zones of one epoch, of the partitions it may have written to."""
    layout = [spec.partition, "writer", "epoch"]
    stored = read_folders(spark, path, f"{folders_of(spec, partitions)}/writer={writer}/epoch={epoch}", spec.stored_schema)
    if stored is None:  # every key was known
        return
    (
        zones_of(stored, spec)
        .hint("rebalance", spec.partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(zone_path(path))
    )


def read_zones(spark: SparkSession, spec: StreamSpec, path: str) -> DataFrame:
    zones = read_folders(spark, zone_path(path), "", _schema(spec))
    return spark.createDataFrame([], _schema(spec)) if zones is None else zones


def rows_per_epoch(zones: DataFrame) -> DataFrame:
    """As the function of this name in ``operators.metrics``, from zones."""
    return zones.groupBy("writer", "epoch").agg(F.sum("rows").alias("rows_inserted"))


def row_count(zones: DataFrame) -> DataFrame:
    return zones.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"))


def _extreme(zones: DataFrame, symbol: str, figure: Column, as_of: Column | None) -> DataFrame:
    rows = zones.where(F.col("symbol") == F.lit(symbol))
    return rows.agg(figure.alias("value")).select("value", query_time(as_of).alias("time"))


def lowest(zones: DataFrame, symbol: str, as_of: Column | None = None) -> DataFrame:
    """Lowest price over all rows; one row, NULL when nothing matches."""
    return _extreme(zones, symbol, F.min("low"), as_of)


def highest(zones: DataFrame, symbol: str, as_of: Column | None = None) -> DataFrame:
    return _extreme(zones, symbol, F.max("high"), as_of)


def newest_bound(zones: DataFrame, symbol: str, n: int) -> int | None:
    """A time (epoch ms) from which on a symbol has ``n`` rows at least; None if it has fewer.

    A zone has a row at least, so the ``n`` zones that begin last are enough to look at.
    """
    timed = F.col("rows") - F.col("untimed")
    last = zones.where((F.col("symbol") == F.lit(symbol)) & (timed > 0)).select("first_time", timed.alias("timed"))
    found = 0
    for zone in last.orderBy(F.col("first_time").desc()).limit(n).collect():
        found += zone.timed
        if found >= n:
            return zone.first_time
    return None


def newest(spark: SparkSession, spec: StreamSpec, path: str, symbol: str, n: int) -> DataFrame:
    """The table's rows of a symbol among which its newest ``n`` are, rows without a time
    included.

    Only partitions are read that have such rows; what comes to the driver is their list, as
    it does for any read of them.
    """
    zones = read_zones(spark, spec, path).where(F.col("symbol") == F.lit(symbol))
    since = newest_bound(zones, symbol, n)
    if since is not None:
        # rows are ordered by the time shown, which is cut to seconds
        zones = zones.where((F.col("last_time") >= F.lit(since - 999)) | (F.col("untimed") > 0))
    partitions = [r[0] for r in zones.select(spec.partition).distinct().collect()]
    stored = read_folders(spark, path, folders_of(spec, partitions), spec.stored_schema) if partitions else None
    if stored is None:
        return spark.createDataFrame([], spec.stored_schema).select(*spec.column_names)
    rows = stored.where(F.col("symbol") == F.lit(symbol))
    rows = rows if since is None else from_time(rows, since)
    return rows.select(*spec.column_names)


def latest_per_symbol(spark: SparkSession, spec: StreamSpec, path: str) -> DataFrame:
    """The newest row of every symbol of a table with the time in its key."""
    if spec.key[0] != "event_time":
        raise ValueError("the table's key has no time")
    last = read_zones(spark, spec, path).groupBy("symbol").agg(F.max("last_key").alias("event_time"))
    placed = last.withColumn("at", spec.partition_value())
    partitions = [r[0] for r in placed.select("at").distinct().collect()]
    stored = read_folders(spark, path, folders_of(spec, partitions), spec.stored_schema) if partitions else None
    if stored is None:
        return spark.createDataFrame([], spec.stored_schema).select(*spec.column_names)
    return stored.join(last, ["symbol", "event_time"], "left_semi").select(*spec.column_names)
