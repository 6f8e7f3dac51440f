"""Latest, last N, extrema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.functions.times import FIRST_MS, is_time, query_time, seconds_time, utc_date

# The planner cuts groups before the shuffle only below this many rows
# (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def for_symbol(rows: DataFrame, symbol: str) -> DataFrame:
    return rows.where(F.col("symbol") == F.lit(symbol))


def latest_value(
    ticker: DataFrame, symbol: str, column: str, as_of: Column | None = None
) -> DataFrame:
    """``value, time`` of the newest ticker row; no row when there is none."""
    return (
        for_symbol(ticker, symbol)
        .orderBy(F.col("event_time").desc())
        .limit(1)
        .select(F.col(column).alias("value"), query_time(as_of).alias("time"))
    )


def latest_per_symbol(ticker: DataFrame) -> DataFrame:
    """The newest row of every symbol.

    ``event_time`` is unique per symbol in a ticker table.  One ``max_by`` per
    column keeps fixed-width aggregation buffers, hence a hash aggregate with a
    partial step instead of a sort.
    """
    others = [c for c in ticker.columns if c not in ("symbol", "event_time")]
    return ticker.groupBy("symbol").agg(
        F.max("event_time").alias("event_time"),
        *[F.max_by(c, "event_time").alias(c) for c in others],
    )


def last_n_per_symbol(rows: DataFrame, n: int, *tie_break: str) -> DataFrame:
    """The newest ``n`` rows of every symbol, NULL times first.

    Up to the planner's group-limit threshold the cut happens in every task before
    the shuffle.  Above it, the rows of a symbol are cut in three rounds: within an
    input partition, within a bundle of partitions, and as a whole.  No round sees
    more of one symbol at once than a partition or ``n`` rows of each part.
    """
    order = [F.col("event_time").desc_nulls_first(), *[F.col(c).desc() for c in tie_break]]

    def cut(frame: DataFrame, *groups: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        return frame.withColumn("place", place).where(F.col("place") <= n)

    threshold = int(rows.sparkSession.conf.get(_GROUP_LIMIT_CONF, "1000"))
    if n < threshold:
        return cut(rows, "symbol")
    parts = rows.withColumn("_part", F.spark_partition_id())
    parts = cut(parts, "symbol", "_part").withColumn("_part", F.col("_part") % 512)
    return cut(cut(parts, "symbol", "_part").drop("_part"), "symbol")


def from_time(rows: DataFrame, since: int) -> DataFrame:
    """``rows`` from ``since`` (epoch ms) on, and those without a time or with one out of range.

    Rows are ordered by the time that is shown, cut to seconds, so the whole second of
    ``since`` is in reach.  The filter skips old row groups, or old date folders where there is
    a date column.
    """
    second = int(abs(since) // 1000) * (1 if since >= 0 else -1)
    first = second * 1000 - (999 if second <= 0 else 0)  # division cuts towards zero
    time = F.col("event_time")
    near = rows.where((time >= F.lit(first)) | time.isNull() | ~is_time(time))
    if "event_date" in rows.columns:
        date = F.col("event_date")
        near = near.where((date >= utc_date(first)) | date.isNull() | (date <= utc_date(FIRST_MS)))
    return near


def newest_from(rows: DataFrame, n: int, since: int) -> DataFrame:
    """``rows`` from ``since`` (epoch ms) on if they hold the newest ``n``, else all.

    With ``n`` rows in reach nothing older can be among the newest ``n``; rows without a time,
    or with one out of range, rank first and stay in.  The probe stops at ``n`` rows.  For
    stored tables ``sources.zones.newest`` knows the time to start from without a probe.
    """
    near = from_time(rows, since)
    return near if near.limit(n).count() == n else rows


def price_series(
    ticker: DataFrame, symbol: str, points: int = 500, column: str = "last_price"
) -> DataFrame:
    """``time, value`` of the last points, newest first, times cut to seconds."""
    return (
        for_symbol(ticker, symbol)
        .select(
            seconds_time("event_time").alias("time"), F.col(column).alias("value"), "event_time"
        )
        .orderBy(F.col("time").desc(), F.col("event_time").desc())
        .limit(points)
        .select("time", "value")
    )


def recent_trades(trades: DataFrame, symbol: str, n: int = 100) -> DataFrame:
    """The last ``n`` trades of a symbol with their value.

    Trades without a time come first.  Times are cut to seconds, ties go to the
    higher trade id.
    """
    return (
        for_symbol(trades, symbol)
        .select(
            seconds_time("event_time").alias("time"),
            "trade_id",
            "price",
            "quantity",
            (F.col("price") * F.col("quantity")).alias("notional"),
        )
        .orderBy(F.col("time").desc_nulls_first(), F.col("trade_id").desc())
        .limit(n)
    )


def _window(ticker: DataFrame, symbol: str, since: int | None) -> DataFrame:
    chosen = for_symbol(ticker, symbol)
    return chosen if since is None else chosen.where(F.col("event_time") >= F.lit(since))


def lowest(
    ticker: DataFrame, symbol: str, as_of: Column | None = None, since: int | None = None
) -> DataFrame:
    """Lowest ``low_price`` over all rows, or those from ``since`` (epoch ms) on.

    One row, NULL when nothing matches.
    """
    return (
        _window(ticker, symbol, since)
        .agg(F.min("low_price").alias("value"))
        .select("value", query_time(as_of).alias("time"))
    )


def highest(
    ticker: DataFrame, symbol: str, as_of: Column | None = None, since: int | None = None
) -> DataFrame:
    """Highest ``high_price``, otherwise as ``lowest``."""
    return (
        _window(ticker, symbol, since)
        .agg(F.max("high_price").alias("value"))
        .select("value", query_time(as_of).alias("time"))
    )
