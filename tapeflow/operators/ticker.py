"""Rolling and hopping tickers computed from trades."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tapeflow.functions.times import MINUTE_MS, floor_div, is_time
from tapeflow.operators.quality import counted

#: Slices are at most this long, so one of a symbol holds a bounded number of rows
#: whatever the trade rate (see ``rolling_ticker``) and whatever the period.
LONGEST_SLICE_MS = 30 * MINUTE_MS

#: A period has this many slices at least.
FEWEST_SLICES = 12

#: Rows that a group of slices stands for, and the longest frame that is added up anew per row.
FAN_IN = 48

#: What a set of trades of one symbol is reduced to.
_FIGURES = (
    "open_price",
    "last_price",
    "last_quantity",
    "high_price",
    "low_price",
    "volume",
    "quote_whole",
    "quote_part",
    "total_trades",
)

# A quote volume is kept as whole units and the rest, each at most a half per trade, so
# that sums over any trades stay exact and within 38 digits.
_WHOLE = "decimal(36,0)"
_PART = "decimal(36,16)"

#: Types of the sums wherever parts are put together.
_SUM_TYPES = {"volume": "decimal(28,8)", "quote_whole": _WHOLE, "quote_part": _PART}

_MIN_LONG = -(2**63)
_MAX_LONG = 2**63 - 1

_TICKER_COLUMNS = (
    "event_time",
    "symbol",
    "price_change",
    "price_change_percent",
    "last_price",
    "open_price",
    "high_price",
    "low_price",
    "volume",
    "total_trades",
)


def priced(trades: DataFrame, observed: Observation | str | None = None) -> DataFrame:
    """Trades that have a time, a price and a quantity, the last two as decimals.

    ``observed`` is told how many there were and how many are left out for want of each.
    """
    typed = trades.select(
        "symbol",
        "event_time",
        "trade_id",
        F.col("price").try_cast("decimal(18,8)").alias("price"),
        F.col("quantity").try_cast("decimal(18,8)").alias("quantity"),
    )
    no_time = ~F.coalesce(is_time(F.col("event_time")), F.lit(False))
    no_price, no_quantity = F.col("price").isNull(), F.col("quantity").isNull()
    if observed is not None:
        typed = counted(
            typed, observed, no_time=no_time, no_price=~no_time & no_price,
            no_quantity=~no_time & ~no_price & no_quantity,
        )
    return typed.where(is_time(F.col("event_time"))).where(~no_price & ~no_quantity)


def _figures_of_trades(order: Column) -> list[Column]:
    quote = F.col("price") * F.col("quantity")
    whole = quote.cast("decimal(21,0)")
    return [
        F.min_by("price", order).alias("open_price"),
        F.max_by("price", order).alias("last_price"),
        F.max_by("quantity", order).alias("last_quantity"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.sum("quantity").alias("volume"),
        F.sum(whole).alias("quote_whole"),
        F.sum((quote - whole).cast("decimal(18,16)")).alias("quote_part"),
        F.count("*").alias("total_trades"),
    ]


def _figures_of_parts(order: str) -> list[Column]:
    """The same figures from disjoint parts in time order."""
    return [
        F.min_by("open_price", order).alias("open_price"),
        F.max_by("last_price", order).alias("last_price"),
        F.max_by("last_quantity", order).alias("last_quantity"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.sum("volume").alias("volume"),
        F.sum("quote_whole").alias("quote_whole"),
        F.sum("quote_part").alias("quote_part"),
        F.sum("total_trades").alias("total_trades"),
    ]


def _quote_volume() -> Column:
    """The nearest double up to 10^20, beyond that the sum of two doubles."""
    whole, part = F.col("quote_whole"), F.col("quote_part")
    exact = whole.try_cast("decimal(20,0)") + part.cast(_PART)
    return F.coalesce(exact.cast("double"), whole.cast("double") + part.cast("double"))


def _with_derived(parts: DataFrame, *lead: str) -> DataFrame:
    """Served columns: doubles, change and volume-weighted price added."""
    as_double = [
        F.col(c).cast("double").alias(c)
        for c in (
            "last_price",
            "last_quantity",
            "open_price",
            "high_price",
            "low_price",
            "volume",
        )
    ]
    change = F.col("last_price") - F.col("open_price")
    return parts.select(
        *lead,
        *as_double,
        _quote_volume().alias("quote_volume"),
        F.col("total_trades").cast("bigint").alias("total_trades"),
    ).select(
        *lead,
        change.alias("price_change"),
        F.try_divide(F.lit(100.0) * change, F.col("open_price")).alias("price_change_percent"),
        "last_price",
        "last_quantity",
        "open_price",
        "high_price",
        "low_price",
        "volume",
        "quote_volume",
        F.try_divide(F.col("quote_volume"), F.col("volume")).alias("vwap"),
        "total_trades",
    )


def per_instant(trades: DataFrame) -> DataFrame:
    """One row per symbol and millisecond."""
    return (
        priced(trades)
        .groupBy("symbol", "event_time")
        .agg(*_figures_of_trades(F.col("trade_id")))
        .withColumns(
            {"quote_whole": F.col("quote_whole").cast(_WHOLE), "quote_part": F.col("quote_part").cast(_PART)}
        )
    )


def slot(position: Column, period: int, slots: int) -> Column:
    """The number of the slot that holds a position, ``slots`` of them to a period.

    A position one period earlier is exactly ``slots`` earlier, whatever the period; slots
    differ in length by one at most where they do not divide it.
    """
    if period % slots == 0:
        return floor_div(position, period // slots)
    whole = floor_div(position, period)
    # the rest is below the period, so the product stays small
    return whole * slots + floor_div((position - whole * period) * slots, period)


def _bounded(parts: list[Column]) -> list[Column]:
    """Sums of sums, cut back to the types that all steps have."""
    return [
        c if name not in _SUM_TYPES else c.cast(_SUM_TYPES[name]).alias(name)
        for c, name in zip(parts, _FIGURES, strict=True)
    ]


def _before(totals: DataFrame, period: int) -> DataFrame:
    """Per symbol and slice: the figures of the ``period`` slices before it.

    Works on one row per symbol and slice.  A short period is a frame over these rows.  A
    long one is cut into blocks of at most ``FAN_IN`` slices, as a rolling window cuts time
    into slices: the end of one block, the blocks between, which are this step again on
    the blocks' own rows, and the start of the block that the slice is in.  So a window is put
    together from a few rows per power of ``FAN_IN``, and no group holds more than two blocks.
    """
    return _in_frame(totals, period) if period < FAN_IN else _by_blocks(totals, period)


def _in_frame(totals: DataFrame, period: int) -> DataFrame:
    """Rows go to groups one period long, each also to the next, so the number of tasks
    grows with the time span and not with the number of symbols."""
    own = floor_div(F.col("slice"), period)
    frame = Window.partitionBy("symbol", "_group").orderBy("slice").rangeBetween(-period, -1)
    return (
        totals.select("*", F.explode(F.array(own, own + 1)).alias("_group"))
        .select(
            "symbol",
            "slice",
            (F.col("_group") == floor_div(F.col("slice"), period)).alias("_own"),
            F.first("open_price").over(frame).alias("open_price"),
            F.last("last_price").over(frame).alias("last_price"),
            F.last("last_quantity").over(frame).alias("last_quantity"),
            F.max("high_price").over(frame).alias("high_price"),
            F.min("low_price").over(frame).alias("low_price"),
            F.sum("volume").over(frame).alias("volume"),
            F.sum("quote_whole").over(frame).alias("quote_whole"),
            F.sum("quote_part").over(frame).alias("quote_part"),
            F.sum("total_trades").over(frame).alias("total_trades"),
        )
        .where(F.col("_own") & F.col("total_trades").isNotNull())
        .drop("_own")
    )


def _by_blocks(totals: DataFrame, period: int) -> DataFrame:
    blocks = -(-period // FAN_IN)
    own, b = F.col("own"), F.col("slice")
    rows = totals.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("own")).select(
        "symbol",
        "own",
        (slot(b, period, blocks) + F.when(own, 0).otherwise(blocks)).alias("block"),
        F.when(own, b).otherwise(-b).alias("seq"),
        F.when(own, b).otherwise(b + period).alias("until"),
        *_FIGURES,
    )
    if blocks > 1:
        of_blocks = totals.withColumn("block", slot(b, period, blocks)).groupBy("symbol", "block")
        of_blocks = of_blocks.agg(*_bounded(_figures_of_parts("slice"))).withColumnRenamed("block", "slice")
        between = _before(of_blocks, blocks - 1).select(
            "symbol",
            F.lit(False).alias("own"),
            F.col("slice").alias("block"),
            F.lit(_MIN_LONG).alias("seq"),
            F.lit(_MAX_LONG).alias("until"),
            *_FIGURES,
        )
        rows = rows.unionByName(between)
    rows = rows.repartition("block", "symbol")

    by_seq = Window.partitionBy("block", "symbol", "own").orderBy("seq")
    upto = by_seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier_only = by_seq.rowsBetween(Window.unboundedPreceding, -1)

    def run(total, name: str, first=None) -> Column:
        # Forwards what lies before the slice, backwards the slice and all after it.
        backwards = F.col(name) if first else total(name).over(upto)
        return F.when(own, (first or total)(name).over(earlier_only)).otherwise(backwards).alias(name)

    runs = rows.select(
        "symbol", "own", "block", "seq", "until",
        run(F.first, "open_price", F.first),
        # the latest of a backward run is its first row
        F.when(own, F.last("last_price").over(earlier_only)).otherwise(F.first("last_price").over(upto)).alias("last_price"),
        F.when(own, F.last("last_quantity").over(earlier_only)).otherwise(F.first("last_quantity").over(upto)).alias("last_quantity"),
        run(F.max, "high_price"),
        run(F.min, "low_price"),
        *[run(F.sum, name).cast(kind).alias(name) for name, kind in _SUM_TYPES.items()],
        run(F.sum, "total_trades"),
    )
    leaving = (
        Window.partitionBy("block", "symbol")
        .orderBy(F.col("until").desc(), F.col("own"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = F.last(F.when(~own, F.struct(*_FIGURES)), ignorenulls=True).over(leaving)

    def plus(name: str) -> Column:
        both = F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"earlier.{name}"), F.lit(0))
        return both.cast(_SUM_TYPES.get(name, "bigint")).alias(name)

    return (
        runs.withColumn("earlier", earlier)
        .where("own AND (total_trades IS NOT NULL OR earlier IS NOT NULL)")
        .select(
            "symbol",
            F.col("seq").alias("slice"),
            F.coalesce("earlier.open_price", "open_price").alias("open_price"),
            F.coalesce("last_price", "earlier.last_price").alias("last_price"),
            F.coalesce("last_quantity", "earlier.last_quantity").alias("last_quantity"),
            F.greatest("high_price", "earlier.high_price").alias("high_price"),
            F.least("low_price", "earlier.low_price").alias("low_price"),
            plus("volume"),
            plus("quote_whole"),
            plus("quote_part"),
            plus("total_trades"),
        )
    )


def default_slots(period_ms: int) -> int:
    """Slices of a period: none longer than ``LONGEST_SLICE_MS``."""
    return min(period_ms, max(FEWEST_SLICES, -(-period_ms // LONGEST_SLICE_MS)))


def rolling_ticker(
    trades: DataFrame, period_ms: int, slice_ms: int | None = None, since: int | None = None
) -> DataFrame:
    """Exact figures of ``[t - period, t]`` for every symbol and trade time ``t``.

    A plain RANGE frame re-reads its whole window at every row, in one task per
    symbol.  Here time is cut into slices; with ``b`` the slice of ``t`` the window
    is the end of slice ``b - n`` from ``t - period`` on, the ``n - 1`` full slices
    after it, and the start of slice ``b`` up to ``t``:

    * ends and starts are running aggregates, one backwards and one forwards;
    * the full slices come from one row per slice;
    * the right end for each ``t`` is found by ordering both sides on the time at
      which an earlier trade leaves the window.

    The work is a sort of twice the rows.  Trades of one symbol and millisecond are
    merged first, so a group never holds more than two slices of milliseconds.  The length
    of a slice does not grow with the period (see ``slot`` for periods it does not divide).

    ``since`` (epoch ms) asks for the times from then on and reads one period more.
    """
    if slice_ms and period_ms % slice_ms:
        raise ValueError("the period must be a multiple of the slice")
    slices = period_ms // slice_ms if slice_ms else default_slots(period_ms)
    if since is not None:
        trades = trades.where(F.col("event_time") >= F.lit(since - period_ms))
    instants = per_instant(trades)
    whole = _windows(instants, _slice_totals(instants, period_ms, slices), period_ms, slices)
    if since is not None:
        whole = whole.where(F.col("event_time") >= F.lit(since))
    return _with_derived(whole, "event_time", "symbol")


def _slice_totals(instants: DataFrame, period_ms: int, slices: int) -> DataFrame:
    """One row per symbol and slice."""
    of = instants.groupBy("symbol", slot(F.col("event_time"), period_ms, slices).alias("slice"))
    return of.agg(*_bounded(_figures_of_parts("event_time")))


def slot_of(time_ms: int, period_ms: int, slices: int) -> int:
    """``slot`` of a known time."""
    whole, rest = divmod(time_ms, period_ms)
    return whole * slices + rest * slices // period_ms


def slot_start(number: int, period_ms: int, slices: int) -> int:
    """The first time of a slot."""
    whole, rest = divmod(number, slices)
    return whole * period_ms - (-rest * period_ms // slices)


def instants_of_run(trades: DataFrame, period_ms: int, until: int, since: int | None = None) -> DataFrame:
    """What a run over the times in ``[since, until)`` reads of the trades, one row per symbol and
    millisecond: the slices that its times are in and those that its windows begin in.

    However long the period, that is the run's own span twice and two slices; what lies
    between comes from stored slices.  Without ``since`` all trades before ``until``.
    """
    t = F.col("event_time")
    trades = trades.where(t < F.lit(until))
    if since is not None:
        slices = default_slots(period_ms)
        own = slot_start(slot_of(since, period_ms, slices), period_ms, slices)
        begin_until = slot_start(slot_of(until - 1, period_ms, slices) - slices + 1, period_ms, slices)
        begins = (t >= F.lit(since - period_ms)) & (t < F.lit(begin_until))
        trades = trades.where(begins | (t >= F.lit(own)))
    return per_instant(trades)


def slices_of_run(instants: DataFrame, period_ms: int, until: int, since: int | None = None) -> DataFrame:
    """The slices that end in ``[since, until]``, whole: (symbol, slice, figures)."""
    slices = default_slots(period_ms)
    totals = _slice_totals(instants, period_ms, slices)
    totals = totals.where(F.col("slice") < slot_of(until, period_ms, slices))
    if since is not None:
        totals = totals.where(F.col("slice") >= slot_of(since, period_ms, slices))
    return totals


def rolling_of_run(
    instants: DataFrame, period_ms: int, since: int | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """The rolling ticker from ``since`` on, from ``instants_of_run`` and the slices that earlier
    runs stored; without them that of all instants."""
    slices = default_slots(period_ms)
    totals = _slice_totals(instants, period_ms, slices)
    if since is not None:
        first = slot_of(since, period_ms, slices)
        earlier = stored.where(F.col("slice").between(first - slices, first - 1))
        # slices before the run's own are there in part only
        totals = totals.where(F.col("slice") >= first).unionByName(earlier.select(*totals.columns))
    whole = _windows(instants, totals, period_ms, slices)
    if since is not None:
        whole = whole.where(F.col("event_time") >= F.lit(since))
    return _with_derived(whole, "event_time", "symbol")


def _windows(instants: DataFrame, totals: DataFrame, period_ms: int, slices: int) -> DataFrame:
    """The windows of all instants, put together as ``rolling_ticker`` says."""
    figures = [F.col(c) for c in _FIGURES]
    t, own = F.col("event_time"), F.col("own")
    lead = ["symbol", "own", "slice", "seq", "until"]
    rows = instants.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("own")).select(
        "symbol",
        "own",
        (slot(t, period_ms, slices) + F.when(own, 0).otherwise(slices)).alias("slice"),
        F.when(own, t).otherwise(-t).alias("seq"),
        F.when(own, t).otherwise(t + period_ms).alias("until"),
        *figures,
    )
    if slices > 1:
        # The full slices open the backward run and never leave the window.
        between = _before(totals, slices - 1).select(
            "symbol",
            F.lit(False).alias("own"),
            "slice",
            F.lit(_MIN_LONG).alias("seq"),
            F.lit(_MAX_LONG).alias("until"),
            *figures,
        )
        rows = rows.unionByName(between)
    # One shuffle serves both windows below; left alone, the planner would shuffle
    # for the first by one more column and again for the second.
    rows = rows.repartition("slice", "symbol")

    run = (
        Window.partitionBy("slice", "symbol", "own")
        .orderBy("seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    runs = rows.select(
        *lead,
        # Forwards the first row opens; backwards each row is the earliest so far.
        F.when(own, F.first("open_price").over(run))
        .otherwise(F.col("open_price"))
        .alias("open_price"),
        "last_price",
        "last_quantity",
        F.max("high_price").over(run).alias("high_price"),
        F.min("low_price").over(run).alias("low_price"),
        F.sum("volume").over(run).cast("decimal(28,8)").alias("volume"),
        F.sum("quote_whole").over(run).cast(_WHOLE).alias("quote_whole"),
        F.sum("quote_part").over(run).cast(_PART).alias("quote_part"),
        F.sum("total_trades").over(run).alias("total_trades"),
    )

    earlier_rows = (
        Window.partitionBy("slice", "symbol")
        .orderBy(F.col("until").desc(), F.col("own"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    part = F.struct(
        "open_price", "high_price", "low_price", "volume", "quote_whole", "quote_part", "total_trades"
    )
    earlier = F.last(F.when(~own, part), ignorenulls=True).over(earlier_rows)

    def plus(name: str) -> Column:
        both = F.col(name) + F.col(f"earlier.{name}")
        return F.when(F.col("earlier").isNull(), F.col(name)).otherwise(both).alias(name)

    return (
        runs.withColumn("earlier", earlier)
        .where("own")
        .select(
            F.col("seq").alias("event_time"),
            "symbol",
            F.coalesce("earlier.open_price", "open_price").alias("open_price"),
            "last_price",
            "last_quantity",
            F.greatest("high_price", "earlier.high_price").alias("high_price"),
            F.least("low_price", "earlier.low_price").alias("low_price"),
            plus("volume"),
            plus("quote_whole"),
            plus("quote_part"),
            plus("total_trades"),
        )
    )


def ticker_table(rolling: DataFrame) -> DataFrame:
    """The stored ticker columns of a rolling ticker."""
    return rolling.select(*_TICKER_COLUMNS)


def trade_order() -> Column:
    """(event_time, trade_id) as one number.

    A number keeps the aggregation buffer fixed-width, so ``min_by``/``max_by`` run
    in a hash aggregate; ordering by a struct would sort all trades first.
    """
    shift = F.lit("20000000000000000000").cast("decimal(20,0)")  # spans every bigint
    return (F.col("event_time").cast("decimal(15,0)") * shift + F.col("trade_id")).cast(
        "decimal(38,0)"
    )


def hopping_ticker(trades: DataFrame, period_ms: int, slide_ms: int) -> DataFrame:
    """Figures of the windows ``[start, start + period)`` that begin every slide.

    Trades are reduced to one row per symbol and step, the longest that divides
    period and slide; only these rows are copied to the windows that contain them.
    """
    if not 0 < slide_ms <= period_ms:
        raise ValueError("the slide must not exceed the period")
    step_ms = math.gcd(period_ms, slide_ms)
    steps = (
        priced(trades)
        .withColumn("order", trade_order())
        .groupBy("symbol", floor_div(F.col("event_time"), step_ms).alias("step"))
        .agg(*_figures_of_trades(F.col("order")))
    )
    # A window contains a step when it starts no later and ends no earlier.
    begin = F.col("step") * step_ms
    last = floor_div(begin, slide_ms)
    first = floor_div(begin + (step_ms - period_ms + slide_ms - 1), slide_ms)
    windows = (
        steps.withColumn("start", F.explode(F.sequence(first, last)))
        .groupBy("symbol", "start")
        .agg(*_figures_of_parts("step"))
    )
    timed = windows.select(
        F.timestamp_millis(F.col("start") * slide_ms).alias("window_start"),
        F.timestamp_millis(F.col("start") * slide_ms + period_ms).alias("window_end"),
        "symbol",
        *_FIGURES,
    )
    return _with_derived(timed, "window_start", "window_end", "symbol")


def hopping_ticker_stream(
    trades: DataFrame, period: str, slide: str, delay: str
) -> DataFrame:
    """The hopping ticker of a stream; rows later than ``delay`` are left out.

    The copies to overlapping windows are combined in each task before the shuffle.
    """
    timed = (
        priced(trades)
        .withColumn("ts", F.timestamp_millis("event_time"))
        .withColumn("order", trade_order())
    )
    windows = (
        timed.withWatermark("ts", delay)
        .groupBy(F.window("ts", period, slide), "symbol")
        .agg(*_figures_of_trades(F.col("order")))
    )
    flat = windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        *_FIGURES,
    )
    return _with_derived(flat, "window_start", "window_end", "symbol")


def closed_windows_stream(
    trades: DataFrame, period_ms: int, slide_ms: int, delay: str
) -> DataFrame:
    """The hopping ticker of a stream, each window once, when the watermark has passed its end.

    Two stateful steps in a chain, for append mode: trades are reduced to one row per symbol and
    step, the longest that divides period and slide, and only closed steps are copied to the
    windows that contain them.  So the state holds open steps and open windows, no trades, and a
    trade is handled once however many windows overlap.  A trade whose step was closed when it
    came is left out; the query's progress counts it (``ingest.late_rows``).
    """
    if not 0 < slide_ms <= period_ms:
        raise ValueError("the slide must not exceed the period")
    period, slide, step = (
        f"{ms} milliseconds" for ms in (period_ms, slide_ms, math.gcd(period_ms, slide_ms))
    )
    timed = (
        priced(trades)
        .withColumn("ts", F.timestamp_millis("event_time"))
        .withColumn("order", trade_order())
    )
    steps = (
        timed.withWatermark("ts", delay)
        .groupBy(F.window("ts", step), "symbol")
        .agg(*_figures_of_trades(F.col("order")))
        .select(F.window_time("window").alias("at"), "symbol", *_FIGURES)
    )
    windows = steps.groupBy(F.window("at", period, slide), "symbol").agg(*_figures_of_parts("at"))
    flat = windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        *_FIGURES,
    )
    return _with_derived(flat, "window_start", "window_end", "symbol")
