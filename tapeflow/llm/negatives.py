"""Hard negatives by inner product, with coordinate pruning in length buckets.

Vectors are laid out by label and length and cut into buckets of one label, of lengths
within ``RATIO`` of each other and of at most ``BUCKET_ROWS`` rows.  A bucket holds its unit
vectors' coordinates as sorted lists.  An anchor that wants scores of at least t needs, in a
bucket of lengths up to l, a cosine of at least t / (its own length * l); for each of its
``FOCUS`` largest coordinates that leaves a range of feasible values, found in the sorted
list by two binary searches.  Rows inside all of these ranges are candidates, and
their exact integer products decide.  The threshold is what is known to be needed: the
range asked for, and the k-th best score that the anchor has met in the buckets before.

Two searches go over the index.  The first meets each anchor with the buckets of its label
and keeps its ``POSITIVES`` best; the second, which knows their scores, meets it with all
buckets of other labels and keeps the ``NEGATIVES`` best of each range.  Anchors are dealt into
packs and buckets into groups of bounded size; a task holds one pack and one group, and sends
the best it met, of which a window keeps the best of all.

Defined cases: rows with a null label or vector, or with a component that is null, not
finite or at least ``LARGEST`` in size (products would leave 64 bits) take no part; rows without an id
are no anchors and come last among equal scores; equal rows count once; rows of one id
and different vectors are anchors of their own, and never each other's positive; vectors
meet those of their own dimension only; a positive of a negative score has no
negatives, one of score 0 those of score 0; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.scratch import staged

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT = 30
HIGH_PERCENT = 90
SCALE = 256
FOCUS = 6
RATIO = 0.9
BUCKET_ROWS = 2048
#: Components of the vectors that a group of buckets and a pack of anchors hold, about.
GROUP_VALUES = 1 << 19
PACK_VALUES = 1 << 16
#: Of a component before scaling: 2**27 after it, so that 512 products fit 63 bits.
LARGEST = float(1 << 19)
_NO_ID = 2**63 - 1
_SLACK = 1e-6

_INDEX = "part int, label long, dim int, shortest double, longest double, n int, ids binary, vectors binary, sorted binary, ranking binary"


def integer_vectors(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(id, row, label, dim, norm, v): the rows that take part, components as integers."""
    x = F.col(vector)
    usable = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(LARGEST), F.lit(False)))
    chosen = rows.filter(x.isNotNull() & label.isNotNull()).filter(usable)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("int"))
    kept = chosen.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return kept.withColumns(
        {"row": F.xxhash64("label", "v"), "dim": F.size("v"), "norm": F.sqrt(squares), "id": F.coalesce("id", F.lit(_NO_ID))}
    )


def _matrix(column: pa.Array, rows: int, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int32).reshape(rows, dim)


def _bucket(part: int, label: int, ids: np.ndarray, v: np.ndarray, norm: np.ndarray) -> list:
    """One index row: the vectors, and for each coordinate the sorted values of the unit
    vectors with the rows they belong to."""
    unit = v / np.maximum(norm, 1e-300)[:, None]
    ranking = np.argsort(unit, axis=0, kind="stable")
    ordered = np.take_along_axis(unit, ranking, axis=0)
    packed = [np.ascontiguousarray(a).tobytes() for a in (ids, v, ordered.T, ranking.T.astype(np.uint16))]
    return [part, label, v.shape[1], float(norm.min()), float(norm.max()), len(ids), *packed]


def _share(vectors: DataFrame, values: int) -> int:
    """Into how many parts of so many components some vectors go."""
    return max(1, -(-(vectors.agg(F.sum("dim")).first()[0] or 0) // values))


def build_index(vectors: DataFrame) -> DataFrame:
    """The buckets: rows in ranges of label, dimension and length, longest first; equal lengths
    are spread by a hash.

    ``part`` numbers the groups of buckets from 0.  Their number follows from the size of the
    vectors alone, also where these come in more ranges than that: neighbours then share one."""
    spread = F.xxhash64("id", "row")
    parts = _share(vectors, GROUP_VALUES)
    order = [F.col("label"), F.col("dim"), F.col("norm").desc(), spread]
    ranges = vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _INDEX.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 4]
        for batch in batches:
            ids, part, label, dim, norm = (batch.column(c).to_numpy() for c in ("id", "part", "label", "dim", "norm"))
            low = 0
            while low < len(ids):
                high = min(len(ids), low + BUCKET_ROWS)
                same = (label[low:high] == label[low]) & (dim[low:high] == dim[low]) & (norm[low:high] >= RATIO * norm[low])
                high = low + (len(same) if same.all() else int(np.argmin(same)))
                v = _matrix(batch.column("v").slice(low, high - low), high - low, int(dim[low]))
                row = _bucket(int(part[low]), int(label[low]), ids[low:high], v, norm[low:high])
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)
                low = high

    numbered = ranges.select("id", "label", "dim", "norm", "v", F.spark_partition_id().alias("part"))
    index = staged(numbered.mapInArrow(build, _INDEX), "negatives-index")
    ranges_made = (index.agg(F.max("part")).first()[0] or 0) + 1
    if ranges_made <= parts:
        return index
    return index.withColumn("part", F.floor(F.col("part") * parts / ranges_made).cast("int"))


class Bucket:
    """An index row in a task."""

    def __init__(self, row: dict):
        self.label, self.dim, self.n = row["label"], row["dim"], row["n"]
        self.shortest, self.longest = row["shortest"], row["longest"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.v = np.frombuffer(row["vectors"], np.int32).reshape(self.n, self.dim)
        self.sorted = np.frombuffer(row["sorted"], np.float64).reshape(self.dim, self.n)
        self.ranking = np.frombuffer(row["ranking"], np.uint16).reshape(self.dim, self.n)
        self.exact = None

    def candidates(self, unit: np.ndarray, length: float, focus: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that can score ``least`` with an anchor; None for all."""
        reach = length * (self.longest if least >= 0 else self.shortest)
        if reach == 0:  # all scores of a zero vector are 0
            return None if least <= 0 else np.empty(0, np.int64)
        cosine = least / reach - _SLACK
        if cosine > 1:
            return np.empty(0, np.int64)
        if cosine <= -1:
            return None
        # an angle of at most ``wide`` apart from the anchor's own, so on every axis
        wide = np.arccos(cosine)
        own = np.arccos(np.clip(unit[focus], -1, 1))
        highest = np.cos(np.maximum(own - wide, 0)) + _SLACK
        lowest = np.cos(np.minimum(own + wide, np.pi)) - _SLACK
        inside = np.zeros(self.n, np.uint8)
        for f, a, b in zip(focus, lowest, highest, strict=True):
            first, last = np.searchsorted(self.sorted[f], a), np.searchsorted(self.sorted[f], b, "right")
            inside[self.ranking[f, first:last]] += 1
        return np.flatnonzero(inside == len(focus))

    def scores(self, v: np.ndarray, length: float, rows: np.ndarray | None) -> np.ndarray:
        """Exact products; doubles are exact while all sums stay below 2**53."""
        if length * self.longest * (1 + 1e-6) < 2**52:
            if self.exact is None:
                self.exact = self.v.astype(np.float64)
            some = self.exact if rows is None else self.exact[rows]
            return (some @ v.astype(np.float64)).astype(np.int64)
        some = self.v if rows is None else self.v[rows]
        return some.astype(np.int64) @ v.astype(np.int64)


class Best:
    """The best k (score, id) pairs of one range of scores met so far."""

    def __init__(self, k: int, least: int | None = None, most: int | None = None):
        self.k, self.least, self.most = k, least, most
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)

    def threshold(self) -> float:
        """The least score that can still matter."""
        known = int(self.score[-1]) if len(self.score) == self.k else None
        return max((x for x in (known, self.least) if x is not None), default=-np.inf)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.threshold()
        if self.most is not None:
            keep &= score <= self.most
        if keep.any():
            score, ids = np.concatenate([self.score, score[keep]]), np.concatenate([self.id, ids[keep]])
            order = np.lexsort((ids, -score))[: self.k]
            self.score, self.id = score[order], ids[order]


def score_range(positive: int) -> tuple[int, int]:
    """The integer scores from ``LOW_PERCENT`` to ``HIGH_PERCENT`` of a positive's."""
    return -(-LOW_PERCENT * positive // 100), HIGH_PERCENT * positive // 100


def _search(index: pa.Table, anchors: pa.Table, same_label: bool) -> Iterator[tuple[dict, int, int, Best]]:
    """(anchor, number of its range, positive's id, best) over one group and one pack.

    Buckets come in turn, the longest first, so that thresholds rise early.
    """
    buckets = sorted((Bucket(row) for row in index.to_pylist()), key=lambda b: -b.longest)
    for anchor in anchors.to_pylist():
        v = np.array(anchor["v"], np.int64)
        length = anchor["norm"]
        unit = v / length if length else v.astype(np.float64)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        if same_label:
            wanted = [(1, 0, Best(POSITIVES))]
        else:
            wanted = [(p["place"], p["id"], Best(NEGATIVES, *score_range(p["score"]))) for p in anchor["positives"] if p["score"] >= 0]
        for bucket in buckets:
            if not wanted or bucket.dim != len(v) or (bucket.label == anchor["label"]) != same_label:
                continue
            least = min(best.threshold() for _, _, best in wanted)
            rows = bucket.candidates(unit, length, focus, least) if np.isfinite(least) else None
            if rows is not None and not len(rows):
                continue
            score = bucket.scores(v, length, rows)
            ids = bucket.ids if rows is None else bucket.ids[rows]
            if same_label:
                other = ids != anchor["id"]
                score, ids = score[other], ids[other]
            for _, _, best in wanted:
                best.add(score, ids)
        for place, positive, best in wanted:
            yield anchor, place, positive, best


_FOUND = "anchor_id long, row long, place int, positive_id long, id long, score long"


def _met(index: DataFrame, spans: DataFrame, anchors: DataFrame, same_label: bool) -> DataFrame:
    """What every group finds for the anchors that go there."""
    columns = [f.split()[0] for f in _FOUND.split(", ")]

    def search(key, group: pa.Table, pack: pa.Table) -> pa.Table:
        rows = [[] for _ in columns]
        for anchor, place, positive, best in _search(group, pack, same_label):
            n = len(best.id)
            for out, value in zip(rows, (anchor["id"], anchor["row"], place, positive), strict=False):
                out.append(np.full(n, value, np.int64))
            rows[4].append(best.id)
            rows[5].append(best.score)
        flat = [np.concatenate(r) if r else np.empty(0, np.int64) for r in rows]
        kinds = [pa.int32() if c == "place" else pa.int64() for c in columns]
        return pa.Table.from_arrays([pa.array(f, k) for f, k in zip(flat, kinds, strict=True)], columns)

    if same_label:
        # a label's rows lie in consecutive parts
        sent = anchors.join(spans, ["label", "dim"]).withColumn("part", F.explode(F.sequence("first", "last"))).drop("first", "last")
    else:
        last = spans.agg(F.max("last")).first()[0]
        sent = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last or 0))))
    sent = sent.withColumn("pack", F.pmod(F.xxhash64("id", "row"), F.lit(_share(anchors, PACK_VALUES))).cast("int"))
    # the index goes only where a pack has anchors for it
    needed = sent.select(F.col("part").alias("to_part"), F.col("pack").alias("to_pack")).distinct()
    there = index.join(needed, F.col("part") == F.col("to_part")).groupBy("to_part", "to_pack")
    return there.cogroup(sent.groupBy("part", "pack")).applyInArrow(search, _FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    """The best of all groups, with their ``rank``."""
    order = Window.partitionBy("anchor_id", "row", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from
    ``integer_vectors``; ``is_anchor`` is a condition on ``id``."""
    vectors = staged(vectors.distinct(), "negatives-vectors")
    index = build_index(vectors)
    spans = index.groupBy("label", "dim").agg(F.min("part").alias("first"), F.max("part").alias("last"))
    anchors = vectors.filter((F.col("id") != _NO_ID) & is_anchor)

    positive = _first(_met(index, spans, anchors, True), POSITIVES)
    listed = positive.select("anchor_id", "row", F.struct(F.col("rank").alias("place"), "id", "score").alias("p"))
    listed = staged(listed.groupBy("anchor_id", "row").agg(F.array_sort(F.collect_list("p")).alias("positives")), "negatives-positives")
    with_positives = anchors.join(listed.withColumnRenamed("anchor_id", "id"), ["id", "row"])

    negative = _first(_met(index, spans, with_positives, False), NEGATIVES)
    scores = listed.select("anchor_id", "row", F.explode("positives").alias("p"))
    scores = scores.select("anchor_id", "row", F.col("p.place").alias("place"), F.col("p.score").alias("positive_score"))
    no_id = lambda c: F.nullif(F.col(c), F.lit(_NO_ID))
    return negative.join(scores, ["anchor_id", "row", "place"]).select(
        "anchor_id",
        no_id("positive_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        no_id("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(integer_vectors(rows, "vec_id", "embedding", moved), F.col("id") % 100 == 0)


OP11_SQL = """
WITH usable AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) >= 524288)) = 0),
anchors AS (SELECT row_number() OVER () AS anchor, vec_id AS anchor_id, label, v FROM usable WHERE vec_id % 100 = 0),
scored AS (
    SELECT anchor, anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM anchors a JOIN usable b ON len(a.v) = len(b.v) AND (a.label <> b.label OR a.anchor_id IS DISTINCT FROM b.vec_id)),
positive AS (
    SELECT anchor, other_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST) AS place
    FROM scored WHERE same QUALIFY place <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER per AS INTEGER) AS rank, other_id AS negative_id,
    positive_score, score AS negative_score
FROM positive p JOIN scored s ON p.anchor = s.anchor AND NOT same
WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW per AS (PARTITION BY p.anchor, place ORDER BY score DESC, other_id NULLS LAST)
QUALIFY row_number() OVER per <= 10
"""
