"""Hard negatives against brute force: random, clustered and odd vectors."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeflow.llm import negatives
from tests.oracle_check import compare, duck

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    usable = set()
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not abs(x) < 2**19 for x in vector):
            continue
        moved = math.fmod(label + 1, 10) if vec_id is not None and vec_id % 7 == 0 else label
        usable.add((vec_id, int(moved), tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = Counter()
    rank = lambda pairs: sorted(pairs, key=lambda p: (-p[0], p[1] is None, p[1] or 0))
    for vec_id, label, v in usable:
        if vec_id is None or vec_id % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), i, m) for i, m, w in usable if len(w) == len(v)]
        positives = rank([(s, i) for s, i, m in scored if m == label and i != vec_id])[:5]
        for p, positive in positives:
            fits = [(s, i) for s, i, m in scored if m != label and 30 * p <= 100 * s <= 90 * p]
            for place, (s, i) in enumerate(rank(fits)[:10], 1):
                out[(vec_id, positive, place, i, p, s)] += 1
    return out


def mined(spark, rows, path, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    # columns of the names used inside
    frame = frame.withColumns({c: F.lit(1) for c in ("id", "row", "dim", "norm", "v", "part", "pack", "first", "last")})
    frame.write.parquet(f"{path}/embeddings.parquet")
    return Counter(tuple(r) for r in negatives.op11_hard_negatives(spark, path).select(*NAMES).collect())


def clustered(seed, count, dim, spread, lengths):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    rows = []
    for i in range(count):
        v = centres[i % 4] + spread * rng.normal(size=dim)
        rows.append((i * 5, (v / np.linalg.norm(v) * rng.choice(lengths)).astype(np.float32).tolist(), int(rng.integers(0, 4))))
    return rows


@pytest.mark.parametrize("seed,spread,lengths", [(1, 0.3, [1.0]), (2, 2.0, [0.1, 1.0, 5.0, 40.0]), (3, 0.01, [1.0, 1.05])])
def test_equals_brute_force(spark, path, monkeypatch, seed, spread, lengths):
    for name, value in (("BUCKET_ROWS", 16), ("GROUP_VALUES", 300), ("PACK_VALUES", 40)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(seed, 240, 8, spread, lengths)
    expected = brute(rows)
    assert expected and mined(spark, rows, path("vectors")) == expected


def test_odd_rows(spark, path):
    rng = random.Random(5)
    vec = lambda n=4: [rng.uniform(-1, 1) for _ in range(n)]
    rows = [(i * 10, vec(), rng.randrange(3)) for i in range(60)]
    same = [0.5, 0.5, 0.5, 0.5]
    rows += [(i, same, i % 2) for i in range(1000, 1300, 3)]  # ties, many copies of one vector
    rows += [(100, same, 1), (100, same, 1), (200, vec(), 2), (2000, [0.0] * 4, 0), (2100, [0.0] * 4, 1), (2101, [0.0] * 4, 1)]
    rows += [(3000, vec(2), 0), (3001, vec(2), 0), (3002, vec(2), 1), (3003, [], 1), (3100, [], 1), (3004, [], 0), (3005, [], 0)]
    rows += [(None, same, 1), (None, vec(), 0), (4000, None, 1), (4100, vec(), None), (4200, [1.0, None, 0.0, 0.0], 1)]
    rows += [(4300, [math.nan, 0.0, 0.0, 0.0], 1), (4400, [math.inf, 0.0, 0.0, 0.0], 1), (4500, [1e30, 0.0, 0.0, 0.0], 1)]
    rows += [(-100, vec(), -1), (-700, vec(), -5), (5000, [524287.0] * 4, 2), (5001, [524287.0] * 4, 2), (5002, [500000.0] * 4, 1), (5004, [400000.0] * 4, 1)]
    expected = brute(rows)
    assert {-100, 100, 2000, 3100, 5000} & {k[0] for k in expected}
    assert mined(spark, rows, path("odd")) == expected


def test_no_vectors_and_no_anchors(spark, path):
    assert not mined(spark, [], path("none"))
    assert not mined(spark, [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.5, 0.0], 2)], path("no_anchor"))


def test_pruning_loses_nothing_and_prunes():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    v = centres[rng.integers(0, 20, 2000)] + 0.1 * rng.normal(size=(2000, 16))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int32)  # a bucket's lengths are alike
    norm = np.sqrt((v.astype(float) ** 2).sum(1))
    names = [f.split()[0] for f in negatives._INDEX.split(", ")]
    bucket = negatives.Bucket(dict(zip(names, negatives._bucket(0, 1, np.arange(2000), v, norm), strict=True)))
    met = 0
    for i in range(0, 2000, 10):
        score = v.astype(np.int64) @ v[i].astype(np.int64)
        unit, least = v[i] / norm[i], np.sort(score)[-20]
        focus = np.argsort(-np.abs(unit))[: negatives.FOCUS]
        rows = bucket.candidates(unit, norm[i], focus, float(least))
        assert set(np.flatnonzero(score >= least)) <= set(rows)
        met += len(rows)
    assert met < 0.5 * 200 * 2000


def test_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf_dir), "op11", negatives.op11_hard_negatives, negatives.OP11_SQL, sf_dir) is None
