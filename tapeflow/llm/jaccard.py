"""N-gram Jaccard join: documents whose shingle sets overlap enough, and their groups.

Equal sets are one node from the start, so copies cost nothing further.  Nodes that may be
linked are brought together in three steps:

1. Every set is cut into parts by its shingles' hashes, so many that two linked sets have an
   equal part that is not tiny.  Nodes with an equal part are tied to the smallest of
   them: a row per node and part, never a pair.  Nodes that share fewer parts with others
   than a linked set must are left out.
2. The ties' connected components are split by set size; sets whose sizes exclude a link do
   not meet.  Large ones are dealt into chunks of bounded size, all pairs of which meet.
3. In a chunk pair the incidence matrix of sets by shingles is multiplied with its own
   transpose, block by block of rows, dense for shingles most rows hold and sparse for the
   rest; pairs below the bound of their sizes are discarded.  The rest are links, of which
   a spanning forest is kept: every link between different sets joins its groups.

Defined cases: null and empty texts and texts without words have an empty set, which links
with nothing; fewer words than a shingle's are one shingle; rows are documents: repeated ids
and null ids are kept, and a group's id is the smallest of its ids that are not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeflow.llm.components import bitmap, components, marked, pair_groups
from tapeflow.llm.words import Hasher, Words, chunks, grams, mix, space_words
from tapeflow.scratch import staged

SHINGLE = 4
PERCENT = 85
SMALL_PART = 3
CUT_SHINGLES = 1 << 20
GROUP_SHINGLES = 4 << 20
MERGED_BYTES = 1 << 20
_ROWS = 512
_PAIRS = 1 << 22


def shingle_sets(texts: pa.Array, hasher: Hasher, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    table = space_words()
    for _, _, data, at in chunks(texts, lower=True):
        words = Words(data, at, table)
        hashes = hasher.spans(data, words.starts, words.ends)
        every = grams(hashes, n)
        for a, b in zip(words.word_at[:-1].tolist(), words.word_at[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(every[a : b - n + 1])
            elif b > a:
                yield grams(hashes[a:b], b - a)
            else:
                yield np.empty(0, np.uint64)


def _node(shingles: np.ndarray) -> int:
    """One number for a set; sets of different shingles differ but for a chance of 2**-64."""
    seed = np.array([len(shingles)], np.uint64)
    return int(mix(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64, keepdims=True) + mix(seed)).view(np.int64)[0])


class Parts:
    """How sets are cut into parts by the hashes of their shingles, by class of size.

    Sets of sizes that allow a link are at most one class apart; each is cut for its own
    class and for the next.  In a class of sizes up to u a linked pair differs in no more than
    ``differ(u)`` shingles, so all other parts are equal.  There are so many parts that
    the equal ones cannot all be among those of few shingles, which say little.
    """

    def __init__(self, percent: int):
        self.percent = percent
        # a little wider than the ratio of sizes, for rounding
        self.width = math.log(100 / (percent - 0.01)) if percent > 1 else 64.0
        at_least = lambda m, rate: 1 - sum(rate**i / math.factorial(i) for i in range(m)) * math.exp(-rate)
        per_shingle = 2 * (100 - percent) / (100 + percent)
        wanted = [
            rate / 10
            for m in (SMALL_PART, 2, 1)
            for rate in range(60, 9, -1)
            if at_least(m, rate / 10 * percent / 100) >= rate / 10 * per_shingle
        ]
        self.rate = wanted[0] if wanted else 1.0

    def classes(self, sizes: np.ndarray) -> np.ndarray:
        return np.floor(np.log(sizes) / self.width).astype(np.int64)

    def differ(self, size_class: np.ndarray) -> np.ndarray:
        largest = np.ceil(np.exp((size_class + 1) * self.width)).astype(np.int64)
        return 2 * (100 - self.percent) * largest // (100 + self.percent)

    def keys(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(set, key, need) for the parts of some sets.

        ``need`` is twice the least number of these parts that a linked set, whatever it leaves
        out, has as well, plus one for the next class."""
        sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        spread = mix(flat ^ np.uint64(0x3C6EF372FE94F82B))
        owners, keys, needs = [], [], []
        for visit in (0, 1):
            size_class = self.classes(sizes) + visit
            differ = self.differ(size_class)
            largest = np.exp((size_class + 1) * self.width)
            parts = np.maximum(differ + 1, np.ceil(largest / self.rate).astype(np.int64))
            first = np.cumsum(parts) - parts
            place = (spread % np.repeat(parts, sizes).astype(np.uint64)).astype(np.int64) + np.repeat(first, sizes)
            total = int(parts.sum())
            sums = np.zeros(total, np.uint64)
            np.add.at(sums, place, mix(flat))
            held = np.bincount(place, minlength=total)
            owner = np.repeat(np.arange(len(sets)), parts)
            # parts below a size may go as long as few go beside those equal in a linked set
            least, gone = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            for m in range(1, SMALL_PART + 1):
                small = np.bincount(owner, held < m, len(sets)).astype(np.int64)
                few = small <= (parts - differ - 1) // (1 if m == 1 else 2)
                least, gone = np.where(few, m, least), np.where(few, small, gone)
            # a linked set leaves out equal parts too, more of them if its ``least`` is higher
            room = parts - differ - 1
            others = np.where(least == 0, room, np.maximum(gone, room // 2))
            need = parts - differ - np.where(least == SMALL_PART, gone, others)
            kept = np.flatnonzero(held >= least[owner])
            number = (kept - first[owner[kept]]).astype(np.uint64)
            seat = mix(number * np.uint64(1024) + size_class[owner[kept]].astype(np.uint64))
            owners.append(owner[kept])
            keys.append(mix(sums[kept] ^ seat).view(np.int64))
            needs.append(2 * need[owner[kept]] + visit)
        return np.concatenate(owners), np.concatenate(keys), np.concatenate(needs).astype(np.int32)


def describe(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(doc, text_key, n_shingles, node) of every document."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sizes, nodes = [], []
            for shingles in shingle_sets(batch.column(1), hasher, n):
                sizes.append(len(shingles))
                nodes.append(_node(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                ["doc", "text_key", "n_shingles", "node"],
            )

    given = docs.select(key, text, F.xxhash64(text))
    return given.mapInArrow(run, f"doc {kind}, text_key long, n_shingles long, node long")


def _ties(docs: DataFrame, text: str, n: int, parts: Parts) -> DataFrame:
    """(a, b): nodes with an equal part, each tied to the smallest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, sets, nodes, size = Hasher(), set(), [], [], 0

        def rows() -> pa.RecordBatch:
            owner, key, need = parts.keys(sets)
            own = np.array(nodes, np.int64)[owner]
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(own), pa.array(need)], ["key", "node", "need"])

        for batch in batches:
            for shingles in shingle_sets(batch.column(0), hasher, n):
                node = _node(shingles) if len(shingles) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                sets.append(shingles)
                nodes.append(node)
                size += len(shingles)
                if size >= CUT_SHINGLES:
                    yield rows()
                    sets, nodes, size = [], [], 0
        if sets:
            yield rows()

    rows = docs.select(text).mapInArrow(run, "key long, node long, need int")
    by_key = Window.partitionBy("key")
    met = rows.withColumn("low", F.min("node").over(by_key)).withColumn("high", F.max("node").over(by_key))
    met = staged(met.filter("low != high").select("key", "node", "need"), "parts")
    # a node that meets others in fewer parts than a linked one must is linked with none
    enough = met.groupBy("node", "need").agg(F.count("*").alias("n")).filter("n >= need div 2").select("node", "need")
    kept = met.join(enough, ["node", "need"]).withColumn("least", F.min("node").over(by_key))
    return kept.filter("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()


def overlaps(sets: list[np.ndarray], rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, counts of common shingles with every set), a block of rows at a time."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    dense_from = max(32, m // 8)
    number = np.cumsum(df >= dense_from) - 1
    is_dense = df[column] >= dense_from
    dense = np.zeros((m, int((df >= dense_from).sum())), np.float32)
    dense[owner[is_dense], number[column[is_dense]]] = 1

    shared = (df[column] > 1) & ~is_dense
    owner, column = owner[shared], column[shared]
    by_column = np.argsort(column, kind="stable")
    posted = owner[by_column]
    col_at = np.searchsorted(column[by_column], np.arange(len(df) + 1))
    row_at = np.searchsorted(owner, np.arange(m + 1))

    for low in range(0, len(rows), _ROWS):
        part = rows[low : low + _ROWS]
        counts = np.rint(dense[part] @ dense.T).astype(np.int32) if dense.shape[1] else np.zeros((len(part), m), np.int32)
        flat = counts.reshape(-1)
        own = np.concatenate([column[row_at[r] : row_at[r + 1]] for r in part.tolist()])
        local = np.repeat(np.arange(len(part)), row_at[part + 1] - row_at[part])
        reach = col_at[own + 1] - col_at[own]
        ends = np.cumsum(reach)
        first = 0
        while first < len(own):
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + _PAIRS, "right")))
            span = reach[first:last]
            inside = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
            met = posted[np.repeat(col_at[own[first:last]], span) + inside]
            flat += np.bincount(np.repeat(local[first:last], span) * m + met, minlength=len(flat)).astype(np.int32)
            first = last
        yield part, counts


def join_labels(labels: np.ndarray, row: int, linked: np.ndarray) -> None:
    """Gives ``row`` and the rows linked to it, with all that these were joined to, one label."""
    found = np.unique(labels[np.append(linked, row)])
    if len(found) > 1:
        labels[np.isin(labels, found)] = found[0]


def _links(nodes: np.ndarray, sets: list[np.ndarray], own: np.ndarray, chunk: np.ndarray, percent: int):
    """Links of a group as edges of a spanning forest."""
    sizes = np.array([len(s) for s in sets], np.int64)
    labels = np.arange(len(sets))
    apart = chunk.min() != chunk.max()
    for part, counts in overlaps(sets, np.flatnonzero(own)):
        common = counts.astype(np.int64)
        union = sizes[part][:, None] + sizes[None, :] - common
        linked = 100 * common >= percent * union
        linked[np.arange(len(part)), part] = False
        if apart:
            linked &= chunk[part][:, None] != chunk[None, :]
        for i in np.flatnonzero(linked.any(axis=1)).tolist():
            join_labels(labels, int(part[i]), np.flatnonzero(linked[i]))
    moved = np.flatnonzero(labels != np.arange(len(sets)))
    return nodes[moved], nodes[labels[moved]]


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows of equal values in the first ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for values in columns:
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            here = tuple(values[a] for values in columns)
            if last is not None and here != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = here
    if held:
        yield _joined(held)


def merged(groups: Iterator[pa.RecordBatch], first: int, content: int, most: int) -> Iterator[pa.RecordBatch]:
    """Small groups put together, as they do not interfere; those of several chunks stay alone.

    ``first`` is the place of the first of two chunk numbers, ``content`` that of the text or set.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for group in groups:
        if group.num_rows < 2:
            continue
        if group.column(first)[0].as_py() or group.column(first + 1)[0].as_py():
            yield group
            continue
        held.append(group)
        size += group.column(content).nbytes
        if size >= most:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc, text_key, n_shingles, group, component_id): the group of every document."""
    kind = dict(docs.dtypes)[key]
    rows = staged(describe(docs, key, text, n), "shingles")
    parts = Parts(percent)
    cluster = components(_ties(docs, text, n, parts)).withColumnRenamed("component", "cluster")

    nodes = rows.filter("node IS NOT NULL").groupBy("node", "n_shingles").agg(F.min("doc").alias("doc"))
    size_class = F.floor(F.log(F.col("n_shingles")) / parts.width).cast("int")
    seats = F.explode(
        F.array(
            F.struct(size_class.alias("size_class"), F.lit(True).alias("own")),
            F.struct((size_class + 1).alias("size_class"), F.lit(False).alias("own")),
        )
    )
    seated = cluster.join(nodes, "node").select("node", "cluster", "n_shingles", seats.alias("s")).select(
        "node", "cluster", "n_shingles", "s.*"
    )
    seated = staged(seated, "seats")
    met = seated.groupBy("cluster", "size_class").agg(F.max("own").alias("any_own"), F.count("*").alias("members"))
    met = met.filter("any_own AND members > 1").select("cluster", "size_class")
    keys = ["cluster", "size_class"]
    placed = pair_groups(seated.join(met, keys), keys, "n_shingles", GROUP_SHINGLES)
    goes = F.struct("cluster", "size_class", "own", "chunk", "groups")
    wanted = placed.groupBy("node").agg(F.collect_list(goes).alias("goes"))  # two entries at most
    wanted = staged(wanted, "wanted")

    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            nodes, held = [], []
            for shingles in shingle_sets(batch.column(0), hasher, n):
                node = _node(shingles) if len(shingles) else None
                if node is None or node in seen or not marked(bits.value, np.array([node]))[0]:
                    continue
                seen.add(node)
                nodes.append(node)
                held.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(held, pa.binary())], ["node", "shingles"])

    sized = docs.select(text).mapInArrow(sets, "node long, shingles binary").join(wanted, "node")
    spread = sized.select("node", "shingles", F.explode("goes").alias("g")).select("node", "shingles", "g.*")
    spread = spread.select(
        "cluster", "size_class", F.explode("groups").alias("pair"), "node", "own", "chunk", "shingles"
    ).select("cluster", "size_class", "pair.first", "pair.second", "node", "own", "chunk", "shingles")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in merged(runs(batches, 4), 2, 7, MERGED_BYTES):
            # copies in several tasks bring a set more than once; it may sit in two classes
            seat = np.stack([run.column(4).to_numpy(), run.column(1).to_numpy().astype(np.int64)])
            _, first = np.unique(seat, axis=1, return_index=True)
            run = run.take(pa.array(first))
            nodes = run.column(4).to_numpy()
            held = [np.frombuffer(b.as_buffer(), np.uint64) for b in run.column(7)]
            own = run.column(5).to_numpy(zero_copy_only=False)
            a, b = _links(nodes, held, own, run.column(6).to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    where = ["cluster", "size_class", "first", "second"]
    links = spread.repartition(*where).sortWithinPartitions(*where).mapInArrow(verify, "a long, b long")
    group = components(links).withColumnRenamed("component", "group")
    labelled = rows.join(group, "node", "left").withColumn("group", F.coalesce("group", "node"))
    least = nodes.join(group, "node", "left").groupBy(F.coalesce("group", "node").alias("group")).agg(F.min("doc").alias("least"))
    joined = labelled.join(least, "group", "left")
    return joined.select("doc", "text_key", "n_shingles", "group", F.coalesce("least", "doc").cast(kind).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that of the smallest id; documents without words stay.

    Rows of equal id and text stay once.
    """
    found = staged(similar(docs, key, text, n, percent), "similar")
    this = F.struct(F.col("doc").isNull().alias("last"), "doc", "text_key")
    firsts = found.filter("group IS NOT NULL").groupBy("group").agg(F.min(this).alias("first")).select("group", "first.*")
    ids = found.groupBy("doc", "text_key").agg(F.first("group").alias("group"), F.count("*").alias("copies"))
    same = (ids["group"] == firsts["group"]) & ids["doc"].eqNullSafe(firsts["doc"]) & (ids["text_key"] == firsts["text_key"])
    others = ids.filter("group IS NOT NULL").join(firsts, same, "left_anti").select("doc", "text_key")
    twice = ids.filter("copies > 1").select("doc", "text_key")
    repeated = twice.exceptAll(others)  # rows of both are distinct; null ids are equal here
    # what goes, and what is there more than once, is little beside the documents
    is_row = lambda rows: docs[key].eqNullSafe(rows["doc"]) & (F.xxhash64(docs[text]) == rows["text_key"])
    goes = others.union(repeated).distinct()
    once = docs.join(goes, is_row(goes), "left_anti")
    return once.unionByName(docs.join(repeated, is_row(repeated), "left_semi").dropDuplicates([key, text]))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar(docs).select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - least(4, len(w)) + 2),
    lambda i: list_slice(w, i, i + least(4, len(w)) - 1))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, k) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.k)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.k AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(k) AS k FROM r GROUP BY doc_id) m USING (doc_id)"""
