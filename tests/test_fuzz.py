"""Random messages: nothing fails, nothing is lost, good ones decode exactly."""

import json
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tapeflow.contracts import TICKER_1H, TRADES
from tapeflow.functions.decode import read_messages, to_table_types
from tapeflow.operators import quality as Q

REASONS = {None, "empty", "malformed", "null_key", "bad_number"}


def value(kind, rng, clean):
    if kind == "bigint":
        good = [0, 1, -5, 10**12, 2**63 - 1, -(2**63)]
        bad = [1.5, "7", True, 2**63, [1], {"x": 1}]
    elif kind == "boolean":
        good, bad = [True, False], ["true", 1, []]
    else:
        good = ["1", "0.00000001", "-2.5", "1e3", "BTCUSDT", "", " 3 ", "NaN", "ü", "99999999999"]
        bad = [good, {"a": 1}]
    return rng.choice(good if clean or rng.random() < 0.8 else [*bad, None])


def random_message(spec, rng, clean):
    fields = {w: value(k, rng, clean) for w, k, _ in spec.fields if rng.random() < 0.9}
    if rng.random() < 0.3:
        fields["unknown"] = {"deep": [1, {"x": None}]}
    names = list(fields)
    rng.shuffle(names)
    text = json.dumps({n: fields[n] for n in names}, ensure_ascii=rng.random() < 0.5)
    if not clean and rng.random() < 0.3:
        cut = rng.randrange(len(text))
        text = rng.choice([text[:cut], text[cut:], text + text, text.replace(":", "", 1), "\x00"])
    return text


def number(text, kind):
    """What the cast gives: a decimal, a float or None."""
    if text is None:
        return None
    text = text.strip()
    if kind == "double":
        try:
            return float(text)
        except ValueError:
            return None
    if text in ("", "NaN"):
        return None
    try:
        exact = Decimal(text).quantize(Decimal("1e-8"), ROUND_HALF_UP)
    except ArithmeticError:
        return None
    return exact if abs(exact) < 10**10 else None


def expected(spec, message):
    fields = json.loads(message)
    names = {name: fields.get(wire) for wire, _, name in spec.fields}
    row, bad = [], False
    for c in spec.columns:
        found = names[c.source]
        if c.is_number_from_text:
            cast = number(found, c.stream_type)
            bad = bad or (found is not None and cast is None)
            found = cast
        row.append(found)
    keys = [row[spec.column_names.index(k)] for k in spec.key]
    reason = "null_key" if None in keys else "bad_number" if bad else None
    return reason, [None if v is None else str(float(v)) if c.is_number_from_text else v
                    for v, c in zip(row, spec.columns)]


@pytest.mark.parametrize("spec", [TRADES, TICKER_1H], ids=lambda s: s.name)
def test_clean_messages_decode_exactly(spark, spec):
    rng = random.Random(1)
    messages = [random_message(spec, rng, clean=True) for _ in range(1500)]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    for row in read_messages(df, spec).collect():
        reason, values = expected(spec, row.raw)
        assert row.reason == reason, row.raw
        if reason is None:
            got = [
                None if row[c.name] is None
                else str(float(row[c.name])) if c.is_number_from_text else row[c.name]
                for c in spec.columns
            ]
            assert got == values, row.raw


@pytest.mark.parametrize("spec", [TRADES, TICKER_1H], ids=lambda s: s.name)
def test_any_text_gets_an_outcome(spark, spec):
    rng = random.Random(2)
    messages = [random_message(spec, rng, clean=False) for _ in range(3000)]
    messages += ["", " ", "\n", "1", '"x"', "[]", "{}", "{" * 50, "tru", "﻿{}", "\x00\x01"]
    raw = [(m.encode("utf-8", "surrogatepass"),) for m in messages] + [(b"\xff\xfe{",), (None,)]
    rows = read_messages(spark.createDataFrame(raw, "value binary"), spec).cache()
    assert rows.count() == len(raw)
    assert {r.reason for r in rows.select("reason").distinct().collect()} == REASONS
    good = Q.usable(rows, spec)
    for key in spec.key:
        assert good.where(F.col(key).isNull()).count() == 0
    assert good.count() + Q.quarantined(rows).count() == len(raw)
    placed = to_table_types(good, spec).withColumn(spec.partition, spec.partition_value())
    assert placed.where(F.col(spec.partition).isNull()).count() == 0
    rows.unpersist()
