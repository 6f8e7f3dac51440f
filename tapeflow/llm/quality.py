"""Quality rules: hashed n-gram log-likelihood ratio against the raw corpus, plus base rules.

Words and pairs of words are hashed to a fixed number of buckets.  One multinomial is
counted over trusted documents, one over the whole corpus; a document's score is the sum
of log(target / raw) over its grams, divided by their number.  The verdict is a fixed
comparison of every document's score with one threshold, set by labelled documents that
were left out of the target: no draw is involved, and all of the corpus is counted.

Defined cases: a null or empty text has no words, score 0 and fails the base rules; rows
are judged one by one, so repeated rows get equal verdicts and rows with a null or
repeated id are kept apart; labels with a null id match nothing; without trusted
documents every score is 0 and only the base rules decide; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeflow.llm.columns import beside
from tapeflow.llm.words import Hasher, Words, chunks, grams, space_words
from tapeflow.scratch import staged

BUCKETS = 1 << 14
PRIOR = 20.0
FOLDS = 5
KEPT = 0.99
_BRACKET = 10_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
_SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = T.StructType([*(T.StructField(m, T.LongType()) for m in MEASURES), T.StructField("score", T.DoubleType())])


def _buckets(words: Words, hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and pair of words."""
    rows = words.rows()
    pairs = words.windows(2)
    bucket = np.concatenate([mixed % np.uint64(buckets) for mixed in (grams(hashes, 1), grams(hashes, 2)[pairs])])
    return bucket.astype(np.int64), np.concatenate([rows, rows[pairs]])


def gram_counts(docs: DataFrame, text: str = "text", chosen: str | None = None, buckets: int = BUCKETS) -> np.ndarray:
    """Grams per bucket, of all documents and of those where ``chosen`` is true: every task
    sends one pair of counts per bucket it met."""
    picked = F.coalesce(F.col(chosen), F.lit(False)) if chosen else F.lit(False)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), space_words()
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            flags = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high, data, at in chunks(batch.column(0)):
                words = Words(data, at, table)
                bucket, row = _buckets(words, hasher.spans(data, words.starts, words.ends), buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                if flags[low:high].any():
                    total[1] += np.bincount(bucket[flags[low:high][row]], minlength=buckets)
        met = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(met), *(pa.array(t[met]) for t in total)], ["bucket", "n", "chosen"])

    rows = docs.select(text, picked).mapInArrow(count, "bucket long, n long, chosen long")
    counted = np.zeros((2, buckets), np.int64)
    for bucket, n, own in rows.groupBy("bucket").agg(F.sum("n"), F.sum("chosen")).collect():  # one row per bucket
        counted[:, bucket] = n, own
    return counted


def log_ratio(target: np.ndarray, raw: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log of the two multinomials' ratio per bucket, 0 where either has no gram at all.

    The raw counts are scaled to the size of the target first and both get the same
    prior, so a bucket that the target is too small to know says little.
    """
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / raw.sum())
    return np.log(target + prior) - np.log(expected + prior)


def _sums(rows: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=count)[:count]


def _repeated(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, key): whether it occurs twice or more, and whether it did earlier."""
    order = np.lexsort((keys, rows))
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    often, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    often[order] = same[1:] | same[:-1]
    again[order] = same[:-1]
    return often, again


def measure(data: np.ndarray, at: np.ndarray, hasher: Hasher, table: np.ndarray, ratio: np.ndarray | None):
    """The measures of some texts as numpy arrays, and their scores if a ratio is given."""
    words, count = Words(data, at, table), len(at) - 1
    hashes = hasher.spans(data, words.starts, words.ends)
    rows = words.rows()
    letter = words.inside & ((data & 0xC0) != 0x80)
    chars = np.concatenate([[0], np.cumsum(letter)])
    symbol = np.zeros(256, bool)
    symbol[list(_SYMBOLS)] = True
    symbols = np.concatenate([[0], np.cumsum(symbol[data])])

    # lines: every text is cut at line ends; those with a word are compared
    cut = np.flatnonzero(data == 10)
    line_start = np.union1d(at[:-1], cut + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start, len(data)).astype(np.int64)[1:]
    line_end = line_end - (data[line_end - 1] == 10)
    filled = np.searchsorted(words.starts, line_end) > np.searchsorted(words.starts, line_start)
    line_start, line_end = line_start[filled], line_end[filled]
    line_row = np.searchsorted(at, line_start, "right") - 1
    _, again = _repeated(hasher.spans(data, line_start, line_end), line_row)

    first = words.windows(3)
    often, _ = _repeated(grams(hashes, 3)[first], rows[first])
    covered = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(covered, first[often], 1)
    ends = np.minimum(first[often] + 3, len(words.starts))
    np.subtract.at(covered, ends, 1)
    repeated = np.cumsum(covered[:-1]) > 0

    measures = [
        words.counts,
        chars[at[1:]] - chars[at[:-1]],
        symbols[at[1:]] - symbols[at[:-1]],
        _sums(line_row, count, again).astype(np.int64),
        _sums(rows, count, repeated).astype(np.int64),
    ]
    if ratio is None:
        return measures, None
    bucket, gram_row = _buckets(words, hashes, len(ratio))
    total, n = _sums(gram_row, count, ratio[bucket]), _sums(gram_row, count)
    return measures, total / np.maximum(n, 1)


def measured(docs: DataFrame, ratio: np.ndarray, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``quality_of`` of the measures and the score."""
    return beside(docs, lambda rows: _measured(rows, ratio, text, keep_text), added=["quality_of"])


def _measured(docs: DataFrame, ratio: np.ndarray, text: str, keep_text: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(ratio)  # one number per bucket
    fields = docs.schema.fields if keep_text else [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in fields]
    columns, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), space_words()
        for batch in batches:
            for low, high, data, at in chunks(batch.column(place)):
                measures, score = measure(data, at, hasher, table, sent.value)
                quality = pa.StructArray.from_arrays(
                    [*(pa.array(m, pa.int64()) for m in measures), pa.array(score)], [*MEASURES, "score"]
                )
                part = batch.slice(low, high - low)
                kept = [part.column(i) for i, name in enumerate(columns) if name in names]
                yield pa.RecordBatch.from_arrays([*kept, quality], [*names, "quality_of"])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("quality_of", MEASURED)]))


def _quantile(scores: DataFrame, at: float) -> float | None:
    """The exact quantile of ``score``, as ``percentile`` has it, None without rows.

    Approximate quantiles below and above give a bracket; what comes to the driver are the
    distinct scores in it, a few in ``_BRACKET`` of all, and the number of those below it.
    """
    score = F.col("score")
    n, least, most = scores.agg(F.count("*"), F.min(score), F.max(score)).first()
    if not n:
        return None
    place = at * (n - 1)
    first = int(place)
    step = 2 / _BRACKET + 2 / n
    while True:
        shares = [max(at - step, 0.0), min(at + step, 1.0)]
        low, high = scores.agg(F.percentile_approx(score, shares, 2 * _BRACKET)).first()[0]
        low, high = least if shares[0] == 0 else low, most if shares[1] == 1 else high
        below = scores.filter(score < low).count()
        around = sorted(map(tuple, scores.filter(score.between(low, high)).groupBy(score).count().collect()))
        if below <= first and (high == most or below + sum(c for _, c in around) > first + 1):
            break
        step *= 2
    reached = np.cumsum([c for _, c in around]) + below
    one, other = (around[min(int(np.searchsorted(reached, i, "right")), len(around) - 1)][0] for i in (first, first + 1))
    return one if one == other else (first + 1 - place) * one + (place - first) * other


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, float]:
    """The log ratio per bucket and the threshold.

    ``labels`` holds keys and ``quality``, and may hold ``toxic``.  Documents of quality 1
    that are not toxic are trusted.  One in ``FOLDS`` of the labelled ones, by a hash of the
    key, is left out of the target and sets the threshold: half way between the score
    that ``KEPT`` of the trusted ones reach and the one that ``KEPT`` of those of
    quality 0 stay below; where these overlap or one is missing, what ``KEPT`` of the
    trusted ones reach.  Quantiles are exact, so the cut into partitions does not matter.  Every
    label counts; labels and documents are joined by key.
    """
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    good = F.min(F.when(F.col("quality") == 1, F.when(toxic == 0, 1)).otherwise(0)).alias("good")
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("marked_key")).agg(good).filter("good IS NOT NULL")
    marks = marks.withColumn("held", F.pmod(F.xxhash64(F.col("marked_key").cast("string")), F.lit(FOLDS)) == 0)
    marks = marks.filter("held OR good = 1").hint("merge")  # labels may be as many as documents
    marked = docs.select(key, text).join(marks, docs[key] == F.col("marked_key"))
    marked = staged(marked.select(text, "good", "held"), "labelled")
    raw = gram_counts(docs, text)[0]
    target = gram_counts(marked.filter("NOT held"), text)[0]
    ratio = log_ratio(target, raw)
    held = measured(marked.filter("held").select(text, "good"), ratio, text, keep_text=False)
    held = staged(held.select("good", "quality_of.score"), "held_scores")
    low = _quantile(held.filter("good = 1"), 1 - KEPT)
    high = _quantile(held.filter("good = 0"), KEPT)
    if low is None:
        return ratio, -np.inf
    return ratio, float(low if high is None or high > low else (low + high) / 2)


def judge(docs: DataFrame, ratio: np.ndarray, threshold: float, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``quality_of``: the measures, ``score``, ``base_failed`` and ``kept``."""
    scored = measured(docs, ratio, text, keep_text)
    q = F.col("quality_of")
    failed = (q.n_words < MIN_WORDS) | (100 * q.n_repeat_words > MAX_REPEATED_PERCENT * q.n_words)
    passed = ~failed & (q.score >= F.lit(threshold))
    return scored.withColumn("quality_of", q.withField("base_failed", failed).withField("kept", passed))


def keep_good(docs: DataFrame, ratio: np.ndarray, threshold: float, text: str = "text") -> DataFrame:
    """The documents that pass, with their columns as given."""

    def run(rows: DataFrame) -> DataFrame:
        return judge(rows, ratio, threshold, text).filter("quality_of.kept").drop("quality_of")

    return beside(docs, run, ["quality_of"])


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ratio, threshold = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, ratio, threshold, keep_text=False).select("doc_id", "quality_of.*")
