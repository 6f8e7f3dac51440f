"""Key rules: not null, first write wins, conflict report; numbers of rows left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tapeflow.contracts import StreamSpec


def usable(classified: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    return classified.where(F.col("reason").isNull()).select(*spec.column_names, *keep)


def quarantined(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return classified.where(F.col("reason").isNotNull()).select("reason", "raw", *keep)


def split_null_keys(rows: DataFrame, key: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and the others."""
    complete = F.lit(True)
    for name in key:
        complete = complete & F.col(name).isNotNull()
    return rows.where(complete), rows.where(~complete)


def first_per_key(
    rows: DataFrame, key: tuple[str, ...], position: tuple[str, ...] = ()
) -> DataFrame:
    """The first row of each key by ``position``, then in the order of all other columns.

    The ``= 1`` filter lets the planner cut every key to one row per task before
    the shuffle, so copies of one key do not pile up in one partition.
    """
    others = [c for c in rows.columns if c not in (*key, *position)]
    order = Window.partitionBy(*key).orderBy(*((*position, *others) or key))
    return (
        rows.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def reject_known(rows: DataFrame, known: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows whose key is not in ``known``."""
    return rows.join(known.select(*key), list(key), "left_anti")


def counted(rows: DataFrame, observed: Observation | str, **chosen: Column) -> DataFrame:
    """``rows``, which report their number (``seen``) and those of the ``chosen`` when they are used.

    A batch reports to an ``Observation``; a stream, or a batch with a listener, under a name, batch
    by batch (``ingest.reported`` adds up).  The numbers are taken on the way, without another pass.
    """
    figures = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in chosen.items()]
    return rows.observe(observed, F.count(F.lit(1)).alias("seen"), *figures)


def drop_late_copies(
    stream: DataFrame, key: tuple[str, ...], ts: str, delay: str, observed: str | None = None
) -> DataFrame:
    """First write wins inside a stream, with state bounded by the watermark.

    Rows without a time count as late; where there are any, use the table look-up.  What is left
    out is the difference of the numbers reported as ``observed`` and ``observed`` + " kept".
    """
    if observed is not None:
        stream = counted(stream, observed)
    kept = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))
    return kept if observed is None else counted(kept, f"{observed} kept")


def conflicts_within(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per key that occurs with more than one payload: the first, and how
    many rows there are.

    A single aggregation, combined before its shuffle: a key has two payloads when
    its lowest and highest differ.
    """
    payload = F.struct(*[c for c in rows.columns if c not in key])
    ends = rows.groupBy(*key).agg(
        F.min(payload).alias("kept"), F.max(payload).alias("last"), F.count("*").alias("copies")
    )
    return ends.where(~F.col("kept").eqNullSafe(F.col("last"))).select(
        *key,
        *[F.col(f"kept.{c}").alias(f"kept_{c}") for c in rows.columns if c not in key],
        "copies",
    )


def conflicts_with(rows: DataFrame, stored: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows whose key is stored with another payload, each payload once."""
    payload = [c for c in rows.columns if c not in key]
    offered = rows.groupBy(*key, *payload).agg(F.count("*").alias("copies"))
    held = stored.select(*key, *[F.col(c).alias(f"kept_{c}") for c in payload])
    same = F.lit(True)
    for c in payload:
        same = same & F.col(c).eqNullSafe(F.col(f"kept_{c}"))
    return offered.join(held, list(key)).where(~same)
