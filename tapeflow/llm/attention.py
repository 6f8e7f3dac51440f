"""LM scoring with a causal self-attention model, trained in numpy on subword ids.

Words are encoded one by one with a public byte-level tokenizer, each with a space before
it, and every text ends with one end id.  The ``SLOTS - 1`` most frequent ids have a slot of their
own, all others share one; slots are grouped into ``CLASSES``.  The probability of an
id is that of its class, from masked attention over the ids before it; times that of its
slot within the class after the slot before it; times that of the id within its slot.  Each
factor sums to one, so the score is the log10 probability of the text's ids.

What is learned comes from all training documents.  Their words are counted exactly, in the
tasks first; slots, classes and the second and third factor follow from those counts.
The attention is trained on all ids of every training document, each of them once: texts are cut into
runs of ``WINDOW`` ids, a run is trained on in the round its document and place hash to; each
task trains on its share from the same weights, the weighted mean of the results is the start
of the next round.  Driver and broadcasts hold numbers per slot and class, and at most
``FREQUENT_WORDS`` words; the counts of all other words come by a join.

Texts are cut into windows of ``STRIDE`` ids to score, each with ``WINDOW - STRIDE`` ids or more of
context before it, so windows overlap and every id is scored once, in batches of windows.

Defined cases: a null or empty text is one end; a document with a null id trains and is not
held out; a word is encoded in pieces of about ``PIECE`` bytes, so its length does not matter;
repeated rows train and are scored each; without training documents all counts are 0 and
probabilities come from the priors; other columns are ignored.
"""

from __future__ import annotations

import base64
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeflow.llm import packed
from tapeflow.llm.words import Hasher, Words, chunks, mix, ragged, space_words
from tapeflow.scratch import staged

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern the tokenizer's ranks were made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 128
CHUNK = 2 << 20

SLOTS = 1024
CLASSES = 96
WIDTH = 16
WINDOW = 32
STRIDE = 24
ROUNDS = 2
BATCH = 256
SCORED = 128
RATE = 0.02
FREQUENT_WORDS = 1 << 20
_HELD_WORDS = 1 << 20
_CACHED_WORDS = 1 << 18
_ADDED = 0.1
#: Rows of a slot from which they are summed by a product.
_OFTEN = 64
_LIMIT = np.float32(30)


def held_out(key: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(key.cast("string")) % 10 == 0, F.lit(False))


class Subwords:
    """Ids of words, found by the words' hashes where they were met before."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.end = len(table)
        self.bytes = np.zeros(self.end + 1, np.int64)
        self.bytes[list(table.values())] = [len(piece) for piece in table]
        self.coder = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.first = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word).

        Words are encoded as one text, as a space before a word always begins a new piece; where
        the words lie in it follows from the lengths of the ids.  Only long words are cut first."""
        parts, of = words, None
        if max(map(len, words), default=0) > PIECE:
            cut = [_pieces(w) for w in words]
            parts = [p for pieces in cut for p in pieces]
            of = np.array([len(pieces) for pieces in cut])
        if not parts:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        ids, at = self._coded(b" " + b" ".join(parts), ends)
        if of is not None:
            at = at[np.cumsum(of) - 1]
        return ids, np.diff(at, prepend=0)

    def _coded(self, text: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a text, and how many there are up to each of some ends of words."""
        ids = np.array(self.coder.encode_ordinary(text.decode("utf-8", "replace")), np.int32)
        return ids, np.searchsorted(np.cumsum(self.bytes[ids]), ends, "left") + 1

    def encode_spans(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of words that lie in ``data``."""
        if not len(starts):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        if sizes.max() > PIECE:
            return self.encode([data[a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)])
        ends = np.cumsum(sizes + 1)
        text = np.full(ends[-1], 32, np.uint8)
        text[_spans(ends - sizes, sizes)] = data[_spans(starts, sizes)]
        ids, at = self._coded(text.tobytes(), ends)
        return ids, np.diff(at, prepend=0)

    def places(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ids of distinct words, given by sorted hashes and spans, are held."""
        if len(self.known) > _CACHED_WORDS:
            self._clear()
        near = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = near < len(self.known)
        new[inside] = self.known[near[inside]] != hashes[inside]
        place = near + np.cumsum(new) - new  # new ones come before those of larger hashes
        if new.any():
            first, sizes = starts[new], ends[new] - starts[new]
            coded, own = self.encode_spans(data, first, sizes)
            begin = len(self.ids) + np.cumsum(own) - own
            at = near[new]
            self.known = np.insert(self.known, at, hashes[new])
            self.first = np.insert(self.first, at, begin)
            self.size = np.insert(self.size, at, own)
            self.ids = np.concatenate([self.ids, coded])
        return place


def _pieces(word: bytes) -> list[bytes]:
    """A word cut after ``PIECE`` bytes or the character that lies there."""
    pieces, low = [], 0
    while low < len(word):
        high = min(low + PIECE, len(word))
        while high < len(word) and word[high] & 0xC0 == 0x80:
            high += 1
        pieces.append(word[low:high])
        low = high
    return pieces


def _spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of spans of the given sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _distinct(words: Words, hashes: np.ndarray):
    """Sorted distinct hashes, where each word is among them, and one span of each."""
    coded = pa.array(hashes).dictionary_encode()
    codes, names = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    first = np.empty(len(names), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    order = np.argsort(names)  # few beside the words
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    first = first[order]
    return names[order], place[codes], words.starts[first], words.ends[first]


# counting


def _word_counts(held: list[tuple[np.ndarray, np.ndarray, list[bytes]]], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    hashes = np.concatenate([h[0] for h in held])
    counts = np.concatenate([h[1] for h in held])
    texts = pa.concat_arrays([h[2] for h in held])
    names, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    total = np.bincount(inverse, counts).astype(np.int64)
    none = pa.nulls(len(names), kind)
    yield pa.RecordBatch.from_arrays(
        [pa.array(names.view(np.int64)), texts.take(pa.array(first)).cast(pa.string()), pa.array(total), none], _COUNTED
    )


_COUNTED = ["hash", "word", "c", "ids"]


def _cut_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    flat = data[_spans(starts, size)] if len(size) else np.empty(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at), pa.py_buffer(flat))


def gather(training: DataFrame, text: str, ranks, as_bytes: bool = False) -> DataFrame:
    """Rows (hash, word, c) of word counts by task, and rows (c, ids) of training runs, where c is
    the round to train in.  ``as_bytes`` gives the ids of a run as one value, for ``_unpacked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table, subwords = Hasher(), space_words(), Subwords(ranks.value)
        held, size = [], 0
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0), lower=True, most=CHUNK):
                words = Words(data, at, table)
                hashes = hasher.spans(data, words.starts, words.ends)
                names, inverse, starts, ends = _distinct(words, hashes)
                held.append((names, np.bincount(inverse, minlength=len(names)), _cut_words(data, starts, ends)))
                size += len(names)
                if size > _HELD_WORDS:
                    yield from _word_counts(held, kind)
                    held, size = [], 0
                yield _runs(words, hashes, *_ids(words, names, inverse, starts, ends, data, subwords), subwords.end, as_bytes)
        yield from _word_counts(held, kind)

    kind = pa.binary() if as_bytes else pa.list_(pa.int32())
    return training.select(text).mapInArrow(run, f"hash long, word string, c long, ids {'binary' if as_bytes else 'array<int>'}")


def _number(end: int) -> type:
    """The kind of number that ids are held in."""
    return np.uint16 if end < 1 << 16 else np.int32


def _unpacked(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of runs as bytes, and where those of each run are."""
    column = column.cast(pa.large_binary())
    kind = np.dtype(_number(end))
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // kind.itemsize
    return np.frombuffer(column.buffers()[2], kind), at


def _ids(words: Words, names, inverse, starts, ends, data: np.ndarray, subwords: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, each with its end, and where those of each text are."""
    place = np.append(subwords.places(names, data, starts, ends)[inverse], -1)
    sizes = np.append(subwords.size, 1)
    begins = np.append(subwords.first, len(subwords.ids))
    stream = place[np.insert(np.arange(len(words.starts)), words.word_at[1:], -1)]
    ids = np.append(subwords.ids, subwords.end)[_spans(begins[stream], sizes[stream])]
    token_at = np.concatenate([[0], np.cumsum(sizes[stream])])
    return ids, token_at[words.word_at + np.arange(len(words.word_at))]


def _runs(words: Words, hashes: np.ndarray, ids: np.ndarray, at: np.ndarray, end: int, as_bytes: bool = False) -> pa.RecordBatch:
    """The ids of every text as runs of ``WINDOW`` at most, each after the id before it."""
    sizes = np.diff(at)
    n_runs = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), n_runs)
    place = _spans(np.zeros(len(sizes), np.int64), n_runs) * WINDOW
    begin = at[:-1][owner] + place
    before = np.where(place > 0, ids[begin - 1], end) if len(ids) else np.empty(0, np.int32)
    lengths = np.minimum(sizes[owner] - place, WINDOW) + 1
    seeds = np.append(hashes, np.uint64(0))[words.word_at[:-1]] + words.counts.astype(np.uint64)
    number = mix(seeds[owner] + place.astype(np.uint64)) % np.uint64(ROUNDS)
    none = pa.nulls(len(owner))
    flat, ends = np.insert(ids, begin, before), np.concatenate([[0], np.cumsum(lengths)])
    if as_bytes:
        flat = flat.astype(_number(end))
        ends = (ends * flat.itemsize).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    else:
        column = ragged(flat.astype(np.int32), ends, pa.int32())
    return pa.RecordBatch.from_arrays(
        [none.cast(pa.int64()), none.cast(pa.string()), pa.array(number.astype(np.int64)), column], _COUNTED
    )


def _collect(rows: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Sums by flat index as an array; the shape bounds the number of rows."""
    table = rows.groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(int(np.prod(shape)))
    out[table.column("i").to_numpy()] = table.column("n").to_numpy()
    return out.reshape(shape)


def _coded(counts: DataFrame, ranks, size: int, weigh) -> DataFrame:
    """Sums (i, n) over the ids of counted words; ``i`` is below ``size``, so a task gives as many rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, total = Subwords(ranks.value), np.zeros(size)
        held, n_held = [], 0

        def add() -> None:
            if held:
                where, n = (np.concatenate(x) for x in zip(*held, strict=True))
                np.add(total, np.bincount(where, n, size), out=total)
                held.clear()

        for batch in batches:
            for low, high, data, at in chunks(batch.column(0)):
                ids, sizes = subwords.encode_spans(data, at[:-1], np.diff(at))
                held.append(weigh(ids.astype(np.int64), sizes, batch.column(1)[low:high].to_numpy().astype(np.float64)))
                n_held += len(held[-1][0])
                if n_held > size:
                    add()
                    n_held = 0
        add()
        names = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total[names])], ["i", "n"])

    return counts.select("word", "c").mapInArrow(run, "i long, n double")


# the model


@dataclass
class Model:
    """All that scoring needs; every array is bounded by ids, slots, classes and WINDOW."""

    slot: np.ndarray  # of each id
    kind: np.ndarray  # class of each slot
    log_slot: np.ndarray  # log of slot given its class and the slot before
    log_id: np.ndarray  # log of id given its slot
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray
    direct: np.ndarray
    near: np.ndarray  # score added for each distance

    @cached_property
    def top(self) -> float:
        """The largest direct part, which is not trained."""
        return float(self.direct.max())

    TRAINED = ("query", "key", "value", "out", "near")

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).reshape(-1) for n in self.TRAINED])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.TRAINED:
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size


def _clusters(bigrams: np.ndarray, fixed: list[int], rng: np.random.Generator) -> np.ndarray:
    """A class for each slot by what comes before and after it; ``fixed`` slots stay alone."""
    slots = len(bigrams)
    share = lambda x: np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1e-9))
    looks = np.concatenate([share(bigrams), share(bigrams.T)], axis=1) @ rng.standard_normal((2 * slots, 48))
    weight = np.sqrt(bigrams.sum(axis=0) + 1)
    free = np.setdiff1d(np.arange(slots), fixed)
    n = CLASSES - len(fixed)
    centers = looks[free[np.argsort(-weight[free], kind="stable")[:n]]]
    for _ in range(20):
        far = (looks[free] ** 2).sum(1)[:, None] - 2 * looks[free] @ centers.T + (centers**2).sum(1)[None, :]
        nearest = far.argmin(axis=1)
        for c in range(len(centers)):
            members = free[nearest == c]
            if len(members):
                centers[c] = np.average(looks[members], axis=0, weights=weight[members])
    kind = np.zeros(slots, np.int64)
    kind[free] = nearest + len(fixed)
    kind[fixed] = np.arange(len(fixed))
    return kind


def start_model(counts: DataFrame, ranks, end: int, documents: int, rng: np.random.Generator) -> Model:
    """Slots, classes and the count factors from word counts; the attention starts small."""
    total_ids = end + 1

    def unigrams(ids, sizes, n):
        return ids, np.repeat(n, sizes)

    by_id = _collect(_coded(counts, ranks, total_ids, unigrams), (total_ids,))
    by_id[end] = documents
    frequent = np.argsort(-by_id[:end], kind="stable")[: SLOTS - 2]
    slot = np.full(total_ids, SLOTS - 1, np.int64)  # the last slot holds the others
    slot[frequent] = np.arange(len(frequent))
    slot[end] = end_slot = SLOTS - 2

    # sums over slots: one after the other in a word, first of a word, last of a word
    def neighbours(ids, sizes, n, slot=slot):
        s, weight = slot[ids], np.repeat(n, sizes)
        last = np.cumsum(sizes) - 1
        inner = np.ones(len(ids), bool)
        inner[last] = False
        pairs = np.flatnonzero(inner)
        where = [s[pairs] * SLOTS + s[pairs + 1], SLOTS * SLOTS + s[last - sizes + 1], SLOTS * SLOTS + SLOTS + s[last]]
        return np.concatenate(where), np.concatenate([weight[pairs], n, n])

    n_sums = SLOTS * SLOTS + 2 * SLOTS
    sums = _collect(_coded(counts, ranks, n_sums, neighbours), (n_sums,))
    bigrams = sums[: SLOTS * SLOTS].reshape(SLOTS, SLOTS)
    first, last = sums[SLOTS * SLOTS : SLOTS * (SLOTS + 1)], sums[SLOTS * (SLOTS + 1) :]
    words = max(first.sum(), 1.0)
    ends = min(1.0, documents / words)
    bigrams = bigrams + np.outer(last, first / words) * (1 - ends)
    bigrams[:, end_slot] += last * ends
    bigrams[end_slot] += documents * (first + 1e-3) / (first + 1e-3).sum()

    kind = _clusters(bigrams, [SLOTS - 1, end_slot], rng)
    member = np.zeros((SLOTS, CLASSES))
    member[np.arange(SLOTS), kind] = 1
    alone = bigrams.sum(axis=0) + _ADDED
    in_class = alone / (alone @ member)[kind]
    after = bigrams @ member  # slot before, class
    strength = 5.0
    log_slot = np.log((bigrams + strength * in_class[None, :]) / (after + strength)[:, kind])
    smoothed = by_id + _ADDED
    log_id = np.log(smoothed / np.bincount(slot, smoothed, SLOTS)[slot])
    prior = (alone @ member) / alone.sum()
    direct = np.log((after + 5.0 * prior) / (after.sum(axis=1, keepdims=True) + 5.0))
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return Model(
        slot=slot,
        kind=kind,
        log_slot=log_slot.astype(np.float32),
        log_id=log_id.astype(np.float32),
        query=small(SLOTS, WIDTH),
        key=small(SLOTS, WIDTH),
        value=small(SLOTS, WIDTH),
        out=small(WIDTH, CLASSES),
        direct=direct.astype(np.float32),
        near=np.zeros(WINDOW, np.float32),
    )


def _bias(model: Model, rows: np.ndarray, length: int) -> np.ndarray:
    """What is added to the score of each place for a query place; later ones are masked."""
    back = rows[:, None] - np.arange(length)[None, :]
    return np.where(back >= 0, model.near[np.clip(back, 0, WINDOW - 1)], np.float32(-1e9)).astype(np.float32)


def _fixed(model: Model, from_place: int, length: int):
    """What ``attend`` needs that is the same for all windows of a length: what is added to the scores,
    the values with a column of ones, and whether scores and logits stay below the limit."""
    bias = _bias(model, np.arange(from_place, length), length)
    value = np.concatenate([model.value, np.ones((SLOTS, 1), np.float32)], axis=1)
    low_scores = _most(model.query, model.key) + model.near.max() < _LIMIT
    return bias, value, low_scores, _most(model.value, model.out.T) + model.top < _LIMIT


def attend(model: Model, slots: np.ndarray, from_place: int, fixed=None):
    """(attention, its sums, mixed values, logits) for the places from ``from_place`` of each window.

    The logits hold what speaks for each class of the next id."""
    bias, value, low_scores, low_logits = fixed or _fixed(model, from_place, slots.shape[1])
    asked = slots[:, from_place:]
    scores = model.query.take(asked, axis=0) @ _turned(model.key.take(slots, axis=0))
    scores += bias
    if not low_scores:
        np.minimum(scores, _LIMIT, out=scores)
    np.exp(scores, out=scores)
    # the sums of the scores come out of the product, as values of 1
    mixed = scores @ value.take(slots, axis=0)
    total = mixed[:, :, WIDTH:]
    mixed = mixed[:, :, :WIDTH] / total
    logits = (mixed.reshape(-1, WIDTH) @ model.out).reshape(*asked.shape, CLASSES)
    logits += model.direct.take(asked, axis=0)
    if not low_logits:
        np.minimum(logits, _LIMIT, out=logits)
    return scores, total, mixed, logits


def _turned(x: np.ndarray) -> np.ndarray:
    """The matrices of ``x`` transposed and copied, which makes products of small ones faster."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


def _most(one: np.ndarray, other: np.ndarray) -> float:
    """No product of rows is more than this, by their lengths and a little for rounding."""
    square = lambda rows: float(np.einsum("ij,ij->i", rows, rows).max())
    return 1.001 * (square(one) * square(other)) ** 0.5


def _by_slot(where: np.ndarray, what: np.ndarray) -> np.ndarray:
    """Sums of rows by slot."""
    order = np.argsort(where.astype(np.int16), kind="stable")  # as short numbers, by their digits
    ordered = where[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    size = np.diff(np.append(first, len(ordered)))
    out = np.zeros((SLOTS, what.shape[1]), np.float32)
    # the rows of a frequent slot are summed by a product, which is faster
    often = size >= _OFTEN
    for low, n in zip(first[often].tolist(), size[often].tolist(), strict=True):
        out[ordered[low]] = np.ones(n, np.float32) @ what.take(order[low : low + n], axis=0)
    if not often.all():
        rest, few = order[np.repeat(~often, size)], size[~often]
        out[ordered[first[~often]]] = np.add.reduceat(what.take(rest, axis=0), np.cumsum(few) - few, axis=0)
    return out


def gradients(model: Model, slots: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
    """The gradients of the trained arrays for the mean loss over the counted places.

    Parts of the batch are taken one by one, as short arrays stay in the processor's cache; what
    they have in common, and the sums by slot, are made once."""
    n, length = max(1, int(counted.sum())), slots.shape[1]
    fixed = _fixed(model, 0, length)
    rows = np.empty((*slots.shape, 3 * WIDTH), np.float32)
    out, scored = np.zeros_like(model.out), np.zeros((length, length), np.float32)
    for low in range(0, len(slots), SCORED):
        part = slice(low, low + SCORED)
        d_out, d_scored = _slopes(model, slots[part], targets[part], counted[part], n, fixed, rows[part])
        out += d_out
        scored += d_scored
    by_slot = _by_slot(slots.reshape(-1), rows.reshape(-1, 3 * WIDTH))
    back = np.arange(length)[:, None] - np.arange(length)[None, :]
    seen = back >= 0
    near = np.bincount(np.clip(back, 0, WINDOW - 1)[seen], scored[seen], WINDOW)
    return {
        "query": by_slot[:, :WIDTH],
        "key": by_slot[:, WIDTH : 2 * WIDTH],
        "value": by_slot[:, 2 * WIDTH :],
        "out": out,
        "near": near.astype(np.float32),
    }


def _slopes(model: Model, slots: np.ndarray, targets: np.ndarray, counted: np.ndarray, n: int, fixed, rows: np.ndarray):
    """Fills ``rows`` with the slopes of the query, key and value of each place; gives those of
    ``out`` and of the scores by place."""
    weights, total, mixed, share = attend(model, slots, 0, fixed)
    share = share.reshape(-1, CLASSES)
    np.exp(share, out=share)
    mass = share @ np.ones(CLASSES, np.float32)
    share.reshape(-1)[np.arange(len(share)) * CLASSES + targets.reshape(-1)] -= mass
    # the slope of a place is its row by this; the narrow factors are scaled, not the rows
    scale = (counted.reshape(-1) / (n * mass)).reshape(*counted.shape, 1)
    d_mixed = (share @ model.out.T).reshape(mixed.shape)
    # the attention is left undivided, and what meets it is divided by its sums
    d_mixed *= scale / total
    value, key, query = (x.take(slots, axis=0) for x in (model.value, model.key, model.query))
    turned = weights.transpose(0, 2, 1)
    np.matmul(turned, d_mixed, out=rows[:, :, 2 * WIDTH :])
    d_score = d_mixed @ _turned(value)
    # the mean of what comes to the places of a row, by their weights, is what comes through the mixed values
    d_score -= np.einsum("btw,btw->bt", d_mixed, mixed)[:, :, None]
    d_score *= weights
    np.matmul(d_score, key, out=rows[:, :, :WIDTH])
    np.matmul(d_score.transpose(0, 2, 1), query, out=rows[:, :, WIDTH : 2 * WIDTH])
    mixed *= scale
    # by windows, as one product over all places is slower
    d_out = (mixed.transpose(0, 2, 1) @ share.reshape(*slots.shape, CLASSES)).sum(axis=0)
    return d_out, d_score.sum(axis=0)


class Trainer:
    """Adam over batches of runs, on through all that a task is given."""

    def __init__(self, model: Model, end: int, rate: float):
        self.model, self.end, self.rate, self.step = model, end, rate, 0
        self.mean = {n: np.zeros_like(getattr(model, n)) for n in Model.TRAINED}
        self.square = {n: np.zeros_like(getattr(model, n)) for n in Model.TRAINED}

    def train(self, flat: np.ndarray, at: np.ndarray) -> int:
        """Train on the runs ``flat[at[i]:at[i + 1]]``; gives the number of ids trained on."""
        model, total = self.model, 0
        place, all_sizes = np.arange(WINDOW + 1)[None, :], np.diff(at)
        slot = np.append(model.slot[flat], model.slot[self.end])  # the last is where a run has ended
        for low in range(0, len(at) - 1, BATCH):
            first, sizes = at[:-1][low : low + BATCH], all_sizes[low : low + BATCH]
            inside = place < sizes[:, None]
            slots = slot.take(np.where(inside, first[:, None] + place, len(flat)))
            counted = inside[:, 1:]
            self._change(gradients(model, slots[:, :-1], model.kind.take(slots[:, 1:]), counted))
            total += int(counted.sum())
        return total

    def _change(self, slopes: dict[str, np.ndarray]) -> None:
        self.step += 1
        for name, g in slopes.items():
            mean, square = self.mean[name], self.square[name]
            mean *= np.float32(0.9)
            mean += np.float32(0.1) * g
            square *= np.float32(0.99)
            g = g * g
            g *= np.float32(0.01)
            square += g
            change = np.sqrt(square / np.float32(1 - 0.99**self.step))
            change += np.float32(1e-6)
            np.divide(mean, change, out=change)
            change *= np.float32(self.rate / (1 - 0.9**self.step))
            setattr(self.model, name, getattr(self.model, name) - change)


def train(runs: DataFrame, model: Model, end: int) -> Model:
    """``ROUNDS`` rounds of training in every task and averaging; each takes the runs of its number."""
    context = runs.sparkSession.sparkContext
    for number in range(ROUNDS):
        sent = context.broadcast(packed(model))
        rate = RATE / (1 + number)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            trainer, weight = Trainer(pickle.loads(sent.value), end, rate), 0
            for batch in batches:
                weight += trainer.train(*_unpacked(batch.column(0), end))
            if weight:
                total = weight * trainer.model.weights().astype(np.float64)
                index = np.arange(len(total) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(index), pa.array(np.append(total, weight))], ["i", "n"])

        chosen = runs.filter(F.col("c") == number).select("ids")
        sums = _collect(chosen.mapInArrow(run, "i long, n double"), (len(model.weights()) + 1,))
        if sums[-1]:
            model.load(sums[:-1] / sums[-1])
    return model


# scoring


def _short(rows: np.ndarray) -> np.ndarray:
    """Rows, none of them longer than the root of ``_LIMIT``."""
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return (rows * np.minimum(1, np.sqrt(_LIMIT) / np.maximum(length, 1e-9))).astype(np.float32)


class Scorer:
    """``attend`` for scoring alone: scores and logits are only used as powers of e, so masks,
    distances and the direct part are multiplied, and the sums come out of the products."""

    def __init__(self, model: Model, end: int):
        self.model, self.end_slot = model, int(model.slot[end])
        place, context = np.arange(WINDOW), WINDOW - STRIDE
        self.near = np.exp(_bias(model, place[context:], WINDOW))
        self.lift = np.exp(model.direct - model.direct.max(axis=1, keepdims=True))
        # with rows of bounded length no power of e runs over
        self.query, self.key = _short(model.query), _short(model.key)
        self.value = np.concatenate([_short(model.value), np.ones((SLOTS, 1), np.float32)], axis=1)
        self.out = np.ascontiguousarray(_short(model.out.T).T)

    def share(self, slots: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Probability of the given classes at the scored places of each window."""
        asked = slots[:, WINDOW - STRIDE :]
        scores = self.query.take(asked, axis=0) @ _turned(self.key.take(slots, axis=0))
        np.exp(scores, out=scores)
        scores *= self.near
        mixed = scores @ self.value.take(slots, axis=0)
        mass = (mixed[:, :, :WIDTH] / mixed[:, :, WIDTH:]) @ self.out
        np.exp(mass, out=mass)
        lift = self.lift.take(asked, axis=0)
        total = np.einsum("btc,btc->bt", mass, lift)
        flat = np.arange(mass.shape[0] * STRIDE) * CLASSES + kinds.reshape(-1)
        return (mass.reshape(-1)[flat] * lift.reshape(-1)[flat]).reshape(total.shape) / total


def score_streams(scorer: Scorer, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 probability of each id stream, ``ids[at[i]:at[i + 1]]``, all of which end with the end."""
    model, end_slot = scorer.model, scorer.end_slot
    slots, count = model.slot.take(ids), len(at) - 1
    kinds = model.kind.take(slots)
    before = np.empty(len(ids), np.int64)
    before[1:] = slots[:-1]
    before[at[:-1]] = end_slot
    total = (model.log_slot.take(before * SLOTS + slots) + model.log_id.take(ids)).astype(np.float64)
    sizes = np.diff(at)
    n_windows = -(-sizes // STRIDE)
    window_at = np.cumsum(n_windows) - n_windows
    # every stream is padded to whole strides; a window is a stride and the end of the one before
    place = _spans(window_at * STRIDE, sizes)
    asked = np.full((int(n_windows.sum()), STRIDE), end_slot)
    asked.reshape(-1)[place] = before
    wanted = np.zeros(asked.shape, np.int64)
    wanted.reshape(-1)[place] = kinds
    context = WINDOW - STRIDE
    window = np.empty((len(asked), WINDOW), np.int64)
    window[:, context:] = asked
    window[1:, :context] = asked[:-1, STRIDE - context :]
    window[window_at, :context] = end_slot
    share = np.empty(asked.shape, np.float32)
    for low in range(0, len(asked), SCORED):
        part = slice(low, low + SCORED)
        share[part] = scorer.share(window[part], wanted[part])
    total += np.log(share.reshape(-1)[place])
    return np.add.reduceat(total, at[:-1]) / np.log(10) if count else np.empty(0)


def _score_rows(docs: DataFrame, key: str, text: str, model: Model, ranks, frequent, n_train: int, distinct: int):
    """Per document: counts, the base over frequent words, the score, and its other words."""
    context = docs.sparkSession.sparkContext
    sent, known = context.broadcast(packed(model)), context.broadcast(frequent)
    kind = dict(docs.dtypes)[key]
    documents = float(frequent[2])
    scale = np.log10(n_train + _ADDED * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table, subwords = Hasher(), space_words(), Subwords(ranks.value)
        names_known, counts_known, _ = known.value
        scorer = Scorer(pickle.loads(sent.value), subwords.end)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, high, data, at in chunks(batch.column(2), lower=True, most=CHUNK):
                words, count = Words(data, at, table), high - low
                hashes = hasher.spans(data, words.starts, words.ends)
                names, inverse, starts, ends = _distinct(words, hashes)
                near = np.minimum(np.searchsorted(names_known, names), max(len(names_known) - 1, 0))
                found = names_known[near] == names if len(names_known) else np.zeros(len(names), bool)
                c = np.where(found, counts_known[near], 0) if len(names_known) else np.zeros(len(names))
                rows = words.rows()
                value = np.where(found, np.log10(c + _ADDED) - scale, 0.0)
                base = np.bincount(rows, value[inverse], count)
                n_known = np.bincount(rows, (found & (c > 0))[inverse], count).astype(np.int64)
                base += np.log10(documents + _ADDED) - scale  # the end
                n_known += int(documents > 0)
                other = np.flatnonzero(~found[inverse])
                other_at = np.searchsorted(other, words.word_at)

                ids, doc_at = _ids(words, names, inverse, starts, ends, data, subwords)
                score = score_streams(scorer, ids, doc_at)
                part = batch.slice(low, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + count)),
                        part.column(0),
                        part.column(1),
                        pa.array(words.counts + 1, pa.int64()),
                        pa.array(n_known),
                        pa.array(base),
                        pa.array(score),
                        ragged(hashes[other].view(np.int64), other_at, pa.int64()),
                    ],
                    ["row", "doc", "held_out", "n_tokens", "n_known", "base_score", "score", "others"],
                )
                number += count

    kinds = (
        f"row long, doc {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, others array<long>"
    )
    return docs.select(key, held_out(F.col(key)), text).mapInArrow(run, kinds)


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        raw = file.read()
    ranks = spark.sparkContext.broadcast(raw)  # the tokenizer's ranks, one megabyte
    end = len([line for line in raw.splitlines() if line])
    training = docs.filter(~held_out(F.col(key)))
    gathered = staged(gather(training, text, ranks, as_bytes=True), "gathered")
    counts = gathered.filter("hash IS NOT NULL").groupBy("hash", "word").agg(F.sum("c").alias("c"))  # by both, as a text among the sums would be sorted for
    counts = staged(counts.withColumn("level", F.floor(F.log2("c")).cast("int")), "counts")
    runs = gathered.filter("ids IS NOT NULL").select("c", "ids")
    documents = training.count()
    levels = sorted((tuple(r) for r in counts.groupBy("level").agg(F.count("*"), F.sum("c")).collect()), reverse=True)
    distinct = sum(r[1] for r in levels) + int(documents > 0)
    n_train = sum(r[2] for r in levels) + documents

    model = start_model(counts, ranks, end, documents, np.random.default_rng(11))
    model = train(runs, model, end)

    least, kept = 64, 0
    for level, n, _ in levels:
        kept += n
        if kept > FREQUENT_WORDS:
            break
        least = level
    table = counts.filter(F.col("level") >= least).select("hash", "c").toArrow()
    names = table.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(names)
    frequent = (names[order], table.column("c").to_numpy()[order], documents)

    rows = staged(_score_rows(docs, key, text, model, ranks, frequent, n_train, distinct), "scored")
    others = rows.select("row", F.explode("others").alias("hash")).groupBy("row", "hash").agg(F.count("*").alias("n"))
    rare = counts.filter(F.col("level") < least).select("hash", "c")
    c = F.coalesce("c", F.lit(0))
    scale = float(np.log10(n_train + _ADDED * (distinct + 1)))
    sums = others.join(rare, "hash", "left").groupBy("row").agg(
        F.sum(F.col("n") * (F.log10(c + _ADDED) - scale)).alias("more_base"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known")
    )
    joined = rows.drop("others").join(sums, "row", "left")
    return joined.select(
        "doc",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return lm_scores(docs).withColumnRenamed("doc", "doc_id")
