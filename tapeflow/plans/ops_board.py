"""The operations board: twelve metric panels and one log panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeflow.contracts import TICKER_1D_TOPIC, TICKER_1H_TOPIC, TRADES_TOPIC
from tapeflow.functions.display import up_class, with_unit
from tapeflow.operators.logs import tail
from tapeflow.operators.metrics import label_values, last_sample, select_series

# Metric names, watched jobs and tables.
UP = "up"
MESSAGES_IN = "kafka_server_messages_in_per_sec"
ROWS_INSERTED = "pg_stat_user_tables_n_tup_ins"
JOBS = ("kafka", "spark1", "spark2", "spark3", "postgresql", "prometheus")
TOPICS = (TRADES_TOPIC, TICKER_1H_TOPIC, TICKER_1D_TOPIC)
TABLES = ("trades", "ticker_1h", "ticker_1d")


def panel_series(database: str) -> dict[str, tuple[str, dict[str, str]]]:
    """Metric and labels of every metric panel."""
    panels = {f"up {job}": (UP, {"job": job}) for job in JOBS}
    panels |= {f"messages {topic}": (MESSAGES_IN, {"topic": topic}) for topic in TOPICS}
    panels |= {
        f"rows {table}": (
            ROWS_INSERTED,
            {"datname": database, "relname": table, "schemaname": "public"},
        )
        for table in TABLES
    }
    return panels


def unit_of(metric: str) -> str:
    return "none" if metric == ROWS_INSERTED else "short"


def metric_panel(samples: DataFrame, metric: str, as_of: Column, **labels: str) -> DataFrame:
    """The newest value of the selected series, in its unit, and its colour."""
    newest = last_sample(select_series(samples, metric, **labels), as_of)
    return newest.select(
        "metric",
        "labels",
        "ts",
        with_unit(F.col("value"), "value", unit_of(metric)),
        up_class(F.col("value")).alias("colour"),
    )


def metric_panels(samples: DataFrame, database: str, as_of: Column) -> DataFrame:
    """The newest values of all metric panels from one pass over the samples."""
    panel, unit = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (metric, labels) in panel_series(database).items():
        is_it = F.col("metric") == metric
        for label, value in labels.items():
            is_it = is_it & (F.col("labels").getItem(label) == value)
        panel = F.when(is_it, name).otherwise(panel)
        unit = F.when(is_it, unit_of(metric)).otherwise(unit)
    newest = last_sample(samples.where(F.col("metric").isin(UP, MESSAGES_IN, ROWS_INSERTED)), as_of)
    return newest.select(
        panel.alias("panel"), "metric", "labels", "ts", "value", unit.alias("unit"),
        up_class(F.col("value")).alias("colour"),
    ).where(F.col("panel").isNotNull())


def databases(samples: DataFrame) -> DataFrame:
    """The choices of the board's database parameter."""
    rows = select_series(samples, ROWS_INSERTED)
    return label_values(rows, F.col("labels").getItem("datname"))


def ops_board(
    samples: DataFrame, lines: DataFrame, database: str, as_of: Column
) -> dict[str, DataFrame]:
    """All panels by name."""
    board = {
        name: metric_panel(samples, metric, as_of, **labels)
        for name, (metric, labels) in panel_series(database).items()
    }
    board["logs"] = tail(lines, as_of)
    return board
