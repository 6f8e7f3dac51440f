"""Wire schemas, table schemas and stream specifications.

One ``StreamSpec`` describes a topic from message to table.  Every job in the
library takes a spec instead of being written once per topic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeflow.functions.times import FIRST_MS, LAST_MS

# Topics, tables and selectable symbols.
TRADES_TOPIC = "binance.trades"
TICKER_1H_TOPIC = "binance.ticker_1h"
TICKER_1D_TOPIC = "binance.ticker_1d"
SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT")
DEFAULT_SYMBOL = "BTCUSDT"

#: Ids per ``id_range`` directory of the trades table.
IDS_PER_RANGE = 1_000_000

#: Column of ``from_json`` that receives the text of a record it cannot read.
CORRUPT = "_corrupt"

# Fields of a trade message, ``wire name, type, our name``.
TRADE_FIELDS = (
    ("e", "string", "event_type"),
    ("E", "bigint", "emitted_at"),
    ("s", "string", "symbol"),
    ("t", "bigint", "trade_id"),
    ("p", "string", "price"),
    ("q", "string", "quantity"),
    ("T", "bigint", "executed_at"),
    ("m", "boolean", "buyer_is_maker"),
    ("M", "boolean", "flag_upper_m"),
)

# Fields of a ticker message.  The letters without a documented
# meaning are read and kept under a neutral name.
TICKER_FIELDS = (
    ("e", "string", "event_type"),
    ("E", "bigint", "emitted_at"),
    ("s", "string", "symbol"),
    ("p", "string", "price_change"),
    ("P", "string", "price_change_percent"),
    ("w", "string", "vwap"),
    ("x", "string", "field_x"),
    ("c", "string", "last_price"),
    ("Q", "string", "last_quantity"),
    ("b", "string", "field_b"),
    ("B", "string", "field_upper_b"),
    ("a", "string", "field_a"),
    ("A", "string", "field_upper_a"),
    ("o", "string", "open_price"),
    ("h", "string", "high_price"),
    ("l", "string", "low_price"),
    ("v", "string", "volume"),
    ("q", "string", "quote_volume"),
    ("O", "bigint", "field_upper_o"),
    ("C", "bigint", "field_upper_c"),
    ("F", "bigint", "field_upper_f"),
    ("L", "bigint", "field_upper_l"),
    ("n", "bigint", "total_trades"),
)


@dataclass(frozen=True)
class OutputColumn:
    """A table column: the message field it comes from and its types."""

    name: str
    source: str
    stream_type: str
    table_type: str

    @property
    def is_number_from_text(self) -> bool:
        return self.stream_type.startswith("decimal") or self.stream_type == "double"


@dataclass(frozen=True)
class StreamSpec:
    name: str
    topic: str
    fields: tuple[tuple[str, str, str], ...]
    columns: tuple[OutputColumn, ...]
    key: tuple[str, ...]
    #: Partition column of the table.  It depends on the key alone, so two rows
    #: with one key always land in the same partition.
    partition: str
    partition_type: str
    partition_sql: str

    @property
    def wire_schema(self) -> T.StructType:
        schema = T.StructType()
        for wire, kind, _ in self.fields:
            schema.add(wire, T.DataType.fromDDL(kind))
        return schema.add(CORRUPT, T.StringType())

    @property
    def message_type(self) -> T.StructType:
        """The wire schema position by position under names that differ in more
        than upper and lower case."""
        schema = T.StructType()
        for _, kind, name in self.fields:
            schema.add(name, T.DataType.fromDDL(kind))
        return schema.add(CORRUPT, T.StringType())

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def payload(self) -> list[str]:
        return [c.name for c in self.columns if c.name not in self.key]

    @property
    def table_schema(self) -> T.StructType:
        schema = T.StructType()
        for c in self.columns:
            schema.add(c.name, T.DataType.fromDDL(c.table_type))
        return schema

    @property
    def stored_schema(self) -> T.StructType:
        """Table columns plus the directory columns of the Parquet layout."""
        return (
            self.table_schema.add(self.partition, T.DataType.fromDDL(self.partition_type))
            .add("writer", T.StringType())
            .add("epoch", T.LongType())
        )

    def partition_value(self) -> Column:
        return F.expr(self.partition_sql).cast(self.partition_type)


TRADES = StreamSpec(
    name="trades",
    topic=TRADES_TOPIC,
    fields=TRADE_FIELDS,
    columns=(
        OutputColumn("trade_id", "trade_id", "bigint", "bigint"),
        OutputColumn("symbol", "symbol", "string", "string"),
        OutputColumn("event_time", "executed_at", "bigint", "bigint"),
        OutputColumn("price", "price", "decimal(18,8)", "double"),
        OutputColumn("quantity", "quantity", "decimal(18,8)", "double"),
    ),
    key=("trade_id", "symbol"),
    partition="id_range",
    partition_type="bigint",
    partition_sql=f"trade_id div {IDS_PER_RANGE}",
)

_TICKER_COLUMNS = (
    OutputColumn("event_time", "emitted_at", "bigint", "bigint"),
    OutputColumn("symbol", "symbol", "string", "string"),
    OutputColumn("price_change", "price_change", "double", "double"),
    OutputColumn("price_change_percent", "price_change_percent", "double", "double"),
    OutputColumn("last_price", "last_price", "double", "double"),
    OutputColumn("open_price", "open_price", "double", "double"),
    OutputColumn("high_price", "high_price", "double", "double"),
    OutputColumn("low_price", "low_price", "double", "double"),
    OutputColumn("volume", "volume", "double", "double"),
    OutputColumn("total_trades", "total_trades", "bigint", "bigint"),
)


def _ticker_spec(name: str, topic: str) -> StreamSpec:
    return StreamSpec(
        name=name,
        topic=topic,
        fields=TICKER_FIELDS,
        columns=_TICKER_COLUMNS,
        key=("event_time", "symbol"),
        partition="event_date",
        partition_type="date",
        # Times outside the years 1 to 9999 go to the first or last day.
        partition_sql=(
            "date_from_unix_date(cast(floor("
            f"least(greatest(event_time, {FIRST_MS}), {LAST_MS}) / 86400000) as int))"
        ),
    )


TICKER_1H = _ticker_spec("ticker_1h", TICKER_1H_TOPIC)
TICKER_1D = _ticker_spec("ticker_1d", TICKER_1D_TOPIC)

SPECS = {s.name: s for s in (TRADES, TICKER_1H, TICKER_1D)}


#: Where a topic holds a message, as its source names it, and when it arrived.
POSITION = ("partition", "offset")
ARRIVAL = "timestamp"


def check_symbol(symbol: str, choices: tuple[str, ...] = SYMBOLS) -> str:
    """The symbol parameter takes one value out of a configured list."""
    if symbol not in choices:
        raise ValueError(f"unknown symbol {symbol!r}, expected one of {', '.join(choices)}")
    return symbol


def check_schema(df, expected: T.StructType):
    """Fail at plan time when column names, order or types are off."""
    found = [(f.name, f.dataType) for f in df.schema.fields]
    wanted = [(f.name, f.dataType) for f in expected.fields]
    if found != wanted:
        raise ValueError(
            f"schema mismatch: found {df.schema.simpleString()}, "
            f"expected {expected.simpleString()}"
        )
    return df
