"""Stored log lines, in folders by UTC date and hour.

Layout: ``table/log_date=<date>/log_hour=<hour>/writer=<query id>/epoch=<batch id>/part-*``.
Lines without a time are kept under NULL date and hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.operators.logs import ATTRIBUTES, log_date, log_hour

SCHEMA = ", ".join(
    [
        "ts timestamp, line string, job string, stream string, container_id string",
        *[f"{name} string" for name in ATTRIBUTES],
        "time_text string, log_date date, log_hour int, writer string, epoch bigint",
    ]
)


def write_lines(lines: DataFrame, path: str, writer: str, epoch: int) -> None:
    """Write the lines of one epoch; folders it wrote before are replaced.

    Rebalancing splits a busy hour over several tasks and packs quiet ones.
    """
    placed = lines.withColumns({"log_date": log_date(F.col("ts")), "log_hour": log_hour(F.col("ts"))})
    (
        placed.hint("rebalance", "log_date", "log_hour")
        .withColumns({"writer": F.lit(writer), "epoch": F.lit(epoch).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("log_date", "log_hour", "writer", "epoch")
        .parquet(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
