"""The supplied test tables seen as trades, messages and log records.

Expects a session in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.contracts import TICKER_1H, TRADES, TRADES_TOPIC
from tapeflow.sources.topics import encode, fan_in

SYMBOLS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(ts: str):
    return F.unix_millis(F.col(ts).cast("timestamp"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as trades, price and quantity as decimals."""
    return as_trades(table(spark, sf_dir, "events"))


def as_trades(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.upper("event_type").alias("symbol"),
        _millis("ts").alias("event_time"),
        F.col("value").cast("decimal(18,8)").alias("price"),
        F.get_json_object("props", "$.k").cast("decimal(18,8)").alias("quantity"),
    )


def served_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the trades table, numbers as doubles."""
    rows = trades(spark, sf_dir)
    return rows.withColumn("price", F.col("price").cast("double")).withColumn(
        "quantity", F.col("quantity").cast("double")
    )


def line_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trades with many repeated keys."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        _millis("l_shipdate").alias("event_time"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
    )


def trade_messages(rows: DataFrame) -> DataFrame:
    """Trades as topic messages: ``topic, value, ts`` and the trade id."""
    constants = {
        "event_type": F.lit("trade"),
        "emitted_at": F.col("event_time"),
        "executed_at": F.col("event_time"),
        "buyer_is_maker": F.col("trade_id") % 2 == 0,
        "flag_upper_m": F.lit(True),
    }
    return rows.select(
        "trade_id",
        "symbol",
        F.lit(TRADES_TOPIC).alias("topic"),
        encode(rows, TRADES, constants).alias("value"),
        F.timestamp_millis("event_time").alias("ts"),
    )


def ticker_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as ticker messages."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("1hTicker").alias("event_type"),
        _millis("l_shipdate").alias("emitted_at"),
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_discount").alias("price_change"),
        F.col("l_tax").alias("price_change_percent"),
        F.col("l_extendedprice").alias("last_price"),
        F.col("l_quantity").alias("last_quantity"),
        (F.col("l_extendedprice") / 2).alias("open_price"),
        (F.col("l_extendedprice") * 2).alias("high_price"),
        (F.col("l_extendedprice") / 4).alias("low_price"),
        F.col("l_quantity").alias("volume"),
        F.col("l_orderkey").alias("total_trades"),
    )
    return rows.select(encode(rows, TICKER_1H).alias("value"))


def rolling_messages(rolling: DataFrame) -> DataFrame:
    """A rolling ticker as ticker messages."""
    rows = rolling.withColumnsRenamed({"event_time": "emitted_at"})
    return rows.select(encode(rows, TICKER_1H).alias("value"))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty topic: good trades, objects of another kind, prose, prices that are
    no numbers, and empty texts."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trade_id"),
        F.col("o_orderstatus").alias("symbol"),
        _millis("o_orderdate").alias("executed_at"),
        F.col("o_orderpriority").alias("price"),
        F.col("o_totalprice").alias("quantity"),
    )
    return fan_in(
        [
            trade_messages(trades(spark, sf_dir)).select("value"),
            table(spark, sf_dir, "events").select(F.col("props").cast("binary").alias("value")),
            table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("value")),
            orders.select(encode(orders, TRADES).alias("value")),
            table(spark, sf_dir, "customer").select(F.lit("").cast("binary").alias("value")),
        ]
    )


# Log records: one per document, one second apart.
LOG_START_SECONDS = 1_746_093_600
LOG_NANOS = ".123456789Z"


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as log records of one container per source."""
    time = F.concat(
        F.date_format(
            F.timestamp_seconds(F.lit(LOG_START_SECONDS) + F.col("doc_id")),
            "yyyy-MM-dd'T'HH:mm:ss",
        ),
        F.lit(LOG_NANOS),
    )
    container = F.md5("source")
    record = F.struct(
        F.col("text").alias("log"),
        F.lit("stdout").alias("stream"),
        time.alias("time"),
        F.create_map(
            F.lit("tag"),
            F.col("lang"),
            F.lit("com.docker.compose.project"),
            F.lit("market"),
            F.lit("com.docker.compose.service"),
            F.col("source"),
        ).alias("attrs"),
    )
    path = F.concat(
        F.lit("/var/lib/docker/containers/"), container, F.lit("/"), container, F.lit("-json.log")
    )
    return table(spark, sf_dir, "documents").select(
        F.to_json(record).alias("value"), path.alias("path")
    )
