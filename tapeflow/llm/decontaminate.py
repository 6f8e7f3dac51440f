"""Benchmark decontamination: n-grams of test items are looked up in training windows.

Items and documents are lower-cased and cut into alphanumeric words.  Every window of
``n`` item words, or the whole item if it is shorter, is one gram.  A task hashes all its
windows, looks the hashes up in the set of gram hashes, and compares the words of every
hit with the gram's words, so a hash never decides.  The set is broadcast if it takes less than
``BROADCAST_BYTES`` in a worker, reckoned from the number and the length of its grams before any of
them leaves its task; above it, windows and grams meet in a join on the hash.

Defined cases: null and empty texts have no words; items without words match nothing;
items with equal words count each; a null item_id is reported as no item but its words
are hit; rows are judged one by one, repeated or without id; an empty table of items
leaves every document clean; other columns pass through unchanged, but ``find`` replaces one
named ``hits``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeflow.llm import packed
from tapeflow.llm.columns import beside
from tapeflow.llm.words import Hasher, Words, alnum_words, chunks, grams
from tapeflow.scratch import staged

N = 10
BROADCAST_BYTES = 128 << 20

#: What a gram takes as a Python object beside its text, with its items, hash and bits.
GRAM_BYTES = 600

SPAN = T.StructType(
    [
        T.StructField("byte_start", T.LongType()),
        T.StructField("byte_end", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
    ]
)
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def _grams(texts: pa.Array, n: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(row, words, hash, words joined by spaces) of each gram."""
    hasher, table = Hasher(), alnum_words()
    for low, _, data, at in chunks(texts, lower=True):
        words = Words(data, at, table)
        hashes = hasher.spans(data, words.starts, words.ends)
        raw = data.tobytes()
        text = [raw[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]
        for row in range(len(at) - 1):
            first, last = int(words.word_at[row]), int(words.word_at[row + 1])
            size = min(n, last - first)
            if size:
                keys = grams(hashes[first:last], size).tolist()
                for i, key in enumerate(keys):
                    yield low + row, size, key, b" ".join(text[first + i : first + i + size])


class GramSet:
    """Grams by their text with the items they are from, and their hashes by length."""

    def __init__(self, rows: list[tuple[str | None, int, int, bytes]]):
        items: dict[bytes, set[str]] = {}
        sizes: dict[int, set[int]] = {}
        for item, size, key, text in rows:
            found = items.setdefault(text, set())
            if item is not None:
                found.add(item)
            sizes.setdefault(size, set()).add(key)
        self.items = {text: sorted(names) for text, names in items.items()}
        self.hashes = {size: np.sort(np.array(list(keys), np.uint64)) for size, keys in sizes.items()}
        self.bits = {}
        for size, keys in self.hashes.items():
            bits = np.zeros(1 << max(12, (16 * len(keys)).bit_length()), bool)
            bits[(keys & np.uint64(len(bits) - 1)).astype(np.int64)] = True
            self.bits[size] = bits

    def windows(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """First words of the windows of each gram length whose hash is in the set."""
        for size, keys in self.hashes.items():
            first = words.windows(size)
            if not len(first):
                continue
            key = grams(hashes, size)[first]
            bits = self.bits[size]
            maybe = np.flatnonzero(bits[(key & np.uint64(len(bits) - 1)).astype(np.int64)])
            near = np.minimum(np.searchsorted(keys, key[maybe]), len(keys) - 1)
            yield size, first[maybe[keys[near] == key[maybe]]]


def _hits(data: np.ndarray, at: np.ndarray, words: Words, found: Iterator[tuple[int, np.ndarray]], items: dict):
    """Per text: hit words, items, spans of hit words."""
    raw = data.tobytes()
    covered = np.zeros(len(words.starts) + 1, np.int64)
    names: dict[int, set[str]] = {}
    for size, firsts in found:
        for first in firsts.tolist():
            span = b" ".join(
                raw[a:b] for a, b in zip(words.starts[first : first + size], words.ends[first : first + size], strict=True)
            )
            known = items.get(span)
            if known is None:
                continue
            covered[first] += 1
            covered[first + size] -= 1
            row = int(np.searchsorted(words.word_at, first, "right")) - 1
            names.setdefault(row, set()).update(known)
    hit = np.cumsum(covered[:-1]) > 0
    spans: dict[int, list[dict]] = {}
    rows = words.rows()
    where = np.flatnonzero(hit)
    if len(where):
        breaks = np.flatnonzero((np.diff(where) > 1) | (np.diff(rows[where]) > 0)) + 1
        for run in np.split(where, breaks):
            row, first, last = int(rows[run[0]]), int(run[0]), int(run[-1])
            base, start = int(words.word_at[row]), int(at[row])
            spans.setdefault(row, []).append(
                {
                    "byte_start": int(words.starts[first]) - start,
                    "byte_end": int(words.ends[last]) - start,
                    "first_word": first - base,
                    "last_word": last - base,
                }
            )
    return [
        {
            "n_words": int(n),
            "n_hit": sum(s["last_word"] - s["first_word"] + 1 for s in spans.get(i, ())),
            "items": sorted(names.get(i, ())),
            "spans": spans.get(i, []),
        }
        for i, n in enumerate(words.counts)
    ]


_ARROW_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("byte_start", pa.int64()), ("byte_end", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
                )
            ),
        ),
    ]
)


def item_grams(items: DataFrame, n: int = N, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, size, hash, gram) of all items, made in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_grams(batch.column(1), n))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64)),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                ["item", "size", "hash", "gram"],
            )

    given = items.select(F.col(key).cast("string").alias("item"), text)
    return given.mapInArrow(run, "item string, size int, hash long, gram binary").distinct()


def find(
    docs: DataFrame,
    items: DataFrame,
    n: int = N,
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with a struct ``hits``: words, hit words, items, and spans of hit words."""
    known = staged(item_grams(items, n, item_key, item_text), "grams")
    needed = F.coalesce(F.sum(F.octet_length("gram") + F.octet_length(F.coalesce("item", F.lit(""))) + GRAM_BYTES), F.lit(0))
    if known.agg(needed).first()[0] <= broadcast_bytes:
        rows = [(r.item, r.size, r.hash & (1 << 64) - 1, bytes(r.gram)) for r in known.collect()]
        return beside(docs, lambda given: _scan(given, GramSet(rows), text), added=["hits"])
    return beside(docs, lambda given: _meet(given, known, text), ["row_key", "known"], ["hits"])


def _scan(docs: DataFrame, grams_of: GramSet, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(packed(grams_of))
    place = docs.columns.index(text)
    names = [*docs.columns, "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table, known = Hasher(), alnum_words(), pickle.loads(sent.value)
        for batch in batches:
            for low, high, data, at in chunks(batch.column(place), lower=True):
                words = Words(data, at, table)
                hashes = hasher.spans(data, words.starts, words.ends)
                hits = _hits(data, at, words, known.windows(words, hashes), known.items)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(hits, _ARROW_HITS)], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("hits", HITS)]))


def _meet(docs: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """The same without a broadcast: hashes of windows meet those of grams in a join, and
    each document gets the grams it may hold."""
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # at most n numbers
    row_key = F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)
    keyed = docs.withColumn("row_key", F.struct(*row_key))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_words()
        for batch in batches:
            for low, _, data, at in chunks(batch.column(1), lower=True):
                words = Words(data, at, table)
                hashes = hasher.spans(data, words.starts, words.ends)
                rows = words.rows()
                for size in sizes:
                    first = words.windows(size)
                    key = grams(hashes, size)[first]
                    pairs = np.unique(np.stack([rows[first].astype(np.uint64), key]), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(pairs[0].astype(np.int64) + low)),
                            pa.array(np.full(pairs.shape[1], size, np.int32)),
                            pa.array(pairs[1].view(np.int64)),
                        ],
                        ["row_key", "size", "hash"],
                    )

    kind = "row_key struct<col1:long,col2:long>, size int, hash long"
    seen = keyed.select("row_key", text).mapInArrow(windows, kind)
    gram = F.struct("item", "size", "hash", "gram")
    met = seen.join(known, ["size", "hash"]).groupBy("row_key").agg(F.collect_set(gram).alias("known"))
    joined = keyed.join(met, "row_key", "left").drop("row_key")
    place, names = docs.columns.index(text), [*docs.columns, "hits"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_words()
        for batch in batches:
            given = batch.column(len(names) - 1).to_pylist()
            for i in range(batch.num_rows):
                rows = [(g["item"], g["size"], g["hash"] & (1 << 64) - 1, g["gram"]) for g in given[i] or ()]
                own = GramSet(rows)
                part = batch.slice(i, 1)
                for _, _, data, at in chunks(part.column(place), lower=True):
                    words = Words(data, at, table)
                    hashes = hasher.spans(data, words.starts, words.ends)
                    hits = _hits(data, at, words, own.windows(words, hashes), own.items)
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(hits, _ARROW_HITS)], names)

    return joined.mapInArrow(verify, T.StructType([*docs.schema.fields, T.StructField("hits", HITS)]))


def remove_documents(docs: DataFrame, items: DataFrame, n: int = N, text: str = "text") -> DataFrame:
    """The documents in which no window of an item occurs."""
    return beside(docs, lambda rows: find(rows, items, n, text).filter("hits.n_hit = 0").drop("hits"), ["hits"])


def remove_spans(docs: DataFrame, items: DataFrame, n: int = N, text: str = "text") -> DataFrame:
    """All documents, without the words that lie in a window of an item."""
    return beside(docs, lambda rows: _remove_spans(rows, items, n, text), ["hits"])


def _remove_spans(docs: DataFrame, items: DataFrame, n: int, text: str) -> DataFrame:
    cut = F.col(text).cast("binary")
    pieces = F.aggregate(
        "hits.spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("kept")),
        lambda done, s: F.struct(
            s.byte_end.alias("at"),
            F.concat(done.kept, F.substr(cut, (done.at + 1).cast("int"), (s.byte_start - done.at).cast("int"))).alias("kept"),
        ),
        lambda done: F.concat(done.kept, F.substr(cut, (done.at + 1).cast("int"))),
    )
    found = find(docs, items, n, text)
    cleaned = F.when(F.size("hits.spans") > 0, pieces.cast("string")).otherwise(F.col(text))
    return found.withColumn(text, cleaned).drop("hits")


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.col("hits.n_hit").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


OP3_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
g AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: list_slice(w, i, i + least(10, len(w)) - 1))) AS gram
  FROM b WHERE len(w) > 0),
d AS (
  SELECT row_number() OVER () AS k, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
x AS (
  SELECT k, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
h AS (SELECT x.k, x.i, x.n, g.item_id FROM x JOIN g ON g.n = x.n AND g.gram = list_slice(x.w, x.i, x.i + x.n - 1)),
p AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM h) GROUP BY k),
q AS (SELECT k, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS s FROM h) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (k) LEFT JOIN q USING (k)"""
