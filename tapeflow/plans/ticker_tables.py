"""Ticker tables filled from trades instead of ticker messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeflow.contracts import StreamSpec
from tapeflow.operators.ticker import (
    instants_of_run,
    rolling_of_run,
    rolling_ticker,
    slices_of_run,
    ticker_table,
)
from tapeflow.scratch import staged
from tapeflow.sources.tables import append_once


def refresh_ticker(
    trades: DataFrame, spec: StreamSpec, period_ms: int, path: str, run: int,
    since: int | None = None,
) -> None:
    """Add the ticks of ``trades``, or those from ``since`` (epoch ms) on.

    Each run has its own number; repeating one replaces what it wrote.  A tick looks
    back only, so runs over successive spans of time give the table of one run over
    all of it.  Ticks that are there already stay.
    """
    ticks = ticker_table(rolling_ticker(trades, period_ms, since=since))
    append_once(staged(ticks, spec.name), spec, path, "refresh", run)


def refresh_from_slices(
    trades: DataFrame, spec: StreamSpec, period_ms: int, path: str, slices_path: str, run: int,
    until: int, since: int | None = None,
) -> None:
    """Add the ticks of the times in ``[since, until)``, and store the slices that ended in it.

    A run reads raw trades only where its windows begin and end (``instants_of_run``); the full
    slices between are the partial aggregates that earlier runs left at ``slices_path``, a
    folder each.  Runs are numbered upwards and each begins where the one before it
    ended, the first without ``since``; trades before ``until`` are taken to be complete.
    Repeating the last run replaces what it wrote.
    """
    instants = staged(instants_of_run(trades, period_ms, until, since), "instants")
    stored = None
    if since is not None:
        stored = trades.sparkSession.read.parquet(slices_path).where(F.col("run") < run)
    ticks = rolling_of_run(instants, period_ms, since, stored)
    slices_of_run(instants, period_ms, until, since).write.mode("overwrite").parquet(f"{slices_path}/run={run}")
    append_once(staged(ticker_table(ticks), spec.name), spec, path, "refresh", run)
