import math
import random

from pyspark.sql import functions as F

from tapeflow.operators import metrics as M


def meter(seconds):
    """Tick by tick, as a meter counts: the rate at the end of each minute with messages."""
    ticks = sorted(s // 5 for s in seconds)
    gain, rate, out = 1 - math.exp(-5 / 60), None, {}
    for tick in range(ticks[0], (ticks[-1] // 12 + 1) * 12):
        now = ticks.count(tick) / 5
        rate = now if rate is None else rate + gain * (now - rate)
        if tick % 12 == 11 and any(t // 12 == tick // 12 for t in ticks):
            out[tick // 12] = rate
    return out


def test_decayed_rate_equals_the_meter(spark):
    rng = random.Random(5)
    topics = {
        "busy": [rng.randrange(20_000) for _ in range(800)],
        "gaps": [7, 8, 3_599, 3_600, 7_200, 40_000, 40_001, 54_000],
        "before": [-90, -61, -60, -1, 0, 5],
        "once": [123],
    }
    rows = [(t, float(s)) for t, seconds in topics.items() for s in seconds]
    messages = spark.createDataFrame(rows, "topic string, s double").select(
        "topic", F.timestamp_seconds("s").alias("ts"), F.lit("x").alias("value")
    )
    messages = messages.unionByName(messages.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    got = {}
    for r in M.decayed_rate(messages).select(
        "topic", F.unix_seconds("window_start").alias("s"), "one_minute_rate"
    ).collect():
        assert (r.topic, r.s // 60) not in got
        got[r.topic, r.s // 60] = r.one_minute_rate
    expected = {(t, m): rate for t, seconds in topics.items() for m, rate in meter(seconds).items()}
    assert got.keys() == expected.keys()
    for key, rate in expected.items():
        assert math.isclose(got[key], rate, rel_tol=1e-9), key


def test_decayed_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "topic string, ts timestamp, value string")
    assert M.decayed_rate(empty).collect() == []
