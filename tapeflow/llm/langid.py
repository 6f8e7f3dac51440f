"""Language of every word by a linear-chain conditional random field, and so of every text.

A word's features are its prefixes and suffixes of up to three bytes, its n-grams of bytes,
all hashed to a fixed number of buckets, and its lexicon entry: how often the training texts
of each language hold the word.  Weights for the features and for going from one
language to the next are learned together, from windows of labelled texts spliced at random
places, so that transitions see texts that switch.  Words are labelled by forward-backward over
the whole text; a text's language is the one its words expect most, and the score is the
mean probability of that language over its words.

The lexicon counts all words of all training texts.  The field itself is fitted, on the
driver, to about ``TRAIN_WINDOWS`` windows of ``WINDOW_CHARS`` characters per language, chosen by a hash
among all windows of all training texts, whatever their length.

In a task a text is handled as stretches of ``STRETCH`` words: the product of a stretch's
steps takes its forward message from one end to the other, so messages run along all stretches
of all texts at once, and a text of any length is labelled whole.

Words are runs of ASCII letters and of bytes above 0x7F; A-Z are lower-cased.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every
text if no training text has a language; rows with a null key count as held out; equal
texts get equal results, whatever their row; ties go to the first language in order; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeflow.llm.words import CHUNK_BYTES, Hasher, Words, chunks, lower_az, mix

TRAIN_WINDOWS = 1200
WINDOW_CHARS = 320
LEXICON = 1 << 16
FEATURES = 1 << 16
GRAMS = (2, 3, 4)
AFFIXES = (1, 2, 3)
EPOCHS = 4
BATCH = 64
RATE = 0.02
DECAY = 1e-4
DROPPED = 0.3
STRETCH = 32
UNKNOWN = "und"
_LIKELY = 6.0


def letter_words() -> np.ndarray:
    """Word bytes: ASCII letters and all bytes of other characters."""
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = table[128:] = True
    return table


class Vocabulary:
    """The different words of some words: ``first`` is where each occurs first, ``number`` which
    one each word is."""

    def __init__(self, words: Words, hashes: np.ndarray):
        self.hash, first, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.starts, self.ends = words.starts[first], words.ends[first]


def features(data: np.ndarray, sums: np.ndarray, hasher: Hasher, starts: np.ndarray, ends: np.ndarray):
    """(word, feature) of every affix and n-gram of some words."""
    words, keys = [], []

    def add(kind: int, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        text = hasher.cut(sums, low, high)
        words.append(word)
        keys.append(mix(text ^ mix(np.array([kind], np.uint64))) % np.uint64(FEATURES))

    all_words = np.arange(len(starts))
    length = ends - starts
    for n in AFFIXES:
        fits = all_words[length >= n]
        add(n, fits, starts[fits], starts[fits] + n)
        add(16 + n, fits, ends[fits] - n, ends[fits])
    for n in GRAMS:
        count = np.maximum(0, length - n + 1)
        word = np.repeat(all_words, count)
        place = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + starts[word]
        add(32 + n, word, place, place + n)
    add(64, all_words, starts, ends)
    return np.concatenate(words), np.concatenate(keys).astype(np.int64)


class Lexicon:
    """Words' log shares in each language against the mean, from counts per bucket."""

    def __init__(self, counts: np.ndarray):
        total = counts.sum(axis=0, keepdims=True)
        # the same prior share everywhere, so an unknown word says nothing
        share = np.log((counts + 0.1) / (total + 0.1 * len(counts)))
        table = share - share.mean(axis=1, keepdims=True)
        table[counts.sum(axis=1) == 0] = 0
        self.table = np.clip(table, -_LIKELY, _LIKELY).astype(np.float32)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.table[(hashes % np.uint64(LEXICON)).astype(np.int64)]


class Field:
    """The weights: features by language, what a lexicon entry says of each language,
    transitions and first languages."""

    def __init__(self, languages: int):
        self.feature = np.zeros((FEATURES, languages), np.float32)
        self.lexicon = np.eye(languages, dtype=np.float32) * np.float32(0.1)
        self.step = np.zeros((languages, languages), np.float32)
        self.start = np.zeros(languages, np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.feature, self.lexicon, self.step, self.start]

    def emissions(self, word: np.ndarray, key: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Scores of some words by language; a word's features count by their mean, scaled."""
        n = len(entries)
        held = np.maximum(1, np.bincount(word, minlength=n))
        out = np.empty((n, self.feature.shape[1]))
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(word, self.feature[key, k], minlength=n)
        return out / np.sqrt(held)[:, None] + entries @ self.lexicon


def chain(emission: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward messages of equally long chains (chain, place, language), each
    scaled to add up to one; the words' marginals; the expected transitions, added up."""
    chains, places, languages = emission.shape
    likely = np.exp(emission - emission.max(axis=2, keepdims=True))
    move = np.exp(step)
    forward, backward = np.empty_like(likely), np.ones_like(likely)
    message = likely[:, 0] * np.exp(start - start.max())
    for t in range(places):
        if t:
            message = (message @ move) * likely[:, t]
        message /= message.sum(axis=1, keepdims=True)
        forward[:, t] = message
    message = np.ones((chains, languages))
    for t in range(places - 2, -1, -1):
        message = (message * likely[:, t + 1]) @ move.T
        message /= message.sum(axis=1, keepdims=True)
        backward[:, t] = message
    marginal = forward * backward
    marginal /= marginal.sum(axis=2, keepdims=True)
    expected = np.zeros_like(step, dtype=np.float64)
    for t in range(1, places):
        pair = forward[:, t - 1, :, None] * move * (likely[:, t] * backward[:, t])[:, None, :]
        expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return forward, backward, marginal, expected


def fit(windows: list[tuple[str, int]], lexicon: Lexicon, languages: int, seed: int = 3) -> Field:
    """A field from windows and their languages' numbers.

    The windows' words are laid end to end in an order drawn from ``seed``, in pieces of random
    length, and cut into chains; a chain so holds pieces of several languages.
    """
    rng = np.random.default_rng(seed)
    hasher, table, lower = Hasher(), letter_words(), lower_az()
    texts = [lower[np.frombuffer(text.encode(), np.uint8)] for text, _ in windows]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.concatenate([*texts, np.empty(0, np.uint8)])
    words = Words(data, at, table)
    field = Field(languages)
    if not len(words.starts):
        return field
    sums = hasher.sums(data)
    vocabulary = Vocabulary(words, hasher.cut(sums, words.starts, words.ends))
    word, key = features(data, sums, hasher, vocabulary.starts, vocabulary.ends)
    by_word = np.argsort(word, kind="stable")
    word_at, key = np.searchsorted(word[by_word], np.arange(len(vocabulary.hash) + 1)), key[by_word]
    entries = lexicon.of(vocabulary.hash)
    label_of = np.array([k for _, k in windows])
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in field.parts()]
    turn = 0
    for _ in range(EPOCHS):
        pieces = []
        for i in rng.permutation(len(windows)):
            low, high = words.word_at[i], words.word_at[i + 1]
            while low < high:
                cut = min(high, low + rng.integers(1, STRETCH + 1))
                pieces.append((low, cut, label_of[i]))
                low = cut
        pieces = [pieces[i] for i in rng.permutation(len(pieces))]
        order = np.concatenate([np.arange(a, b) for a, b, _ in pieces])
        labels = np.concatenate([np.full(b - a, k) for a, b, k in pieces])
        chains = len(order) // STRETCH
        if not chains:  # fewer words than one chain has
            order, labels, chains = np.resize(order, STRETCH), np.resize(labels, STRETCH), 1
        order, labels = (x[: chains * STRETCH].reshape(chains, STRETCH) for x in (order, labels))
        for first in range(0, chains, BATCH):
            turn += 1
            number = vocabulary.number[order[first : first + BATCH]]
            _learn(field, moments, turn, number, labels[first : first + BATCH], word_at, key, entries, rng)
    return field


def _learn(field, moments, turn, number, label, word_at, key, entries, rng) -> None:
    """One step of Adam on the log likelihood of some chains."""
    languages = len(field.start)
    used, place = np.unique(number, return_inverse=True)
    place = place.reshape(number.shape)
    count = word_at[used + 1] - word_at[used]
    word = np.repeat(np.arange(len(used)), count)
    feature = key[np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(word_at[used], count)]
    # some words go without their entry, so that the other features learn to say it too
    known = np.where(rng.random(len(used)) < DROPPED, 0, 1)[:, None] * entries[used]
    emission = field.emissions(word, feature, known)[place]
    _, _, marginal, expected = chain(emission, field.step, field.start)
    truth = np.eye(languages)[label]
    slope = truth - marginal
    by_word = np.stack([np.bincount(place.ravel(), slope[:, :, k].ravel(), len(used)) for k in range(languages)], axis=1)
    scaled = by_word / np.sqrt(np.maximum(1, count))[:, None]
    met, back = np.unique(feature, return_inverse=True)
    on_feature = np.stack([np.bincount(back, scaled[word, k], len(met)) for k in range(languages)], axis=1)
    seen = np.einsum("cti,ctj->ij", truth[:, :-1], truth[:, 1:])
    n = label.shape[0]
    slopes = [on_feature / n, known.T @ by_word / n, (seen - expected) / n, slope[:, 0].sum(axis=0) / n]
    for i, (part, slope_of, (m, v)) in enumerate(zip(field.parts(), slopes, moments, strict=True)):
        rows = met if i == 0 else slice(None)
        g = slope_of - DECAY * part[rows]
        m[rows] += 0.1 * (g - m[rows])
        v[rows] += 0.01 * (g * g - v[rows])
        part[rows] += RATE * (m[rows] / (1 - 0.9**turn)) / (np.sqrt(v[rows] / (1 - 0.99**turn)) + 1e-6)


def posteriors(emission: np.ndarray, counts: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of all words; ``counts`` words belong to each text, in turn.

    Every text is padded to whole stretches.  A first pass over the places of a stretch makes
    each stretch's product of steps; a second hands messages from stretch to stretch, for
    all texts at once; a third goes through the places again, with the messages known.
    """
    total, languages = emission.shape
    stretches = -(-counts // STRETCH)
    n = int(stretches.sum())
    if not n:
        return np.empty((0, languages))
    first_stretch = np.cumsum(stretches) - stretches
    first_word = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(total) - first_word[text]
    slot = first_stretch[text] * STRETCH + inside
    likely = np.ones((n * STRETCH, languages))
    likely[slot] = np.exp(emission - emission.max(axis=1, keepdims=True))
    real = np.zeros(n * STRETCH, bool)
    real[slot] = True
    likely, real = likely.reshape(n, STRETCH, languages), real.reshape(n, STRETCH)
    move = np.exp(step - step.max()).astype(np.float64)
    still = np.eye(languages)
    opens = np.zeros(n, bool)
    opens[first_stretch[stretches > 0]] = True
    # the first word of a text is reached by no step
    steps = lambda t: np.where((real[:, t] & ~(opens & (t == 0)))[:, None, None], move, still)

    product = np.broadcast_to(still, (n, languages, languages)).copy()
    for t in range(STRETCH):
        product = product @ steps(t) * likely[:, t, None, :]
        product /= product.max(axis=(1, 2), keepdims=True)

    enter = np.empty((n, languages))  # forward message before a stretch, with its first step to do
    leave = np.ones((n, languages))  # backward message behind it
    enter[opens] = np.exp(start - start.max())
    for k in range(1, int(stretches.max())):
        s = first_stretch[stretches > k] + k
        message = np.einsum("ni,nij->nj", enter[s - 1], product[s - 1])
        enter[s] = message / message.sum(axis=1, keepdims=True)
    for k in range(int(stretches.max()) - 2, -1, -1):
        s = first_stretch[stretches > k + 1] + k
        message = np.einsum("nij,nj->ni", product[s + 1], leave[s + 1])
        leave[s] = message / message.sum(axis=1, keepdims=True)

    forward = np.empty((n, STRETCH, languages))
    message = enter
    for t in range(STRETCH):
        message = np.einsum("ni,nij->nj", message, steps(t)) * likely[:, t]
        message /= message.sum(axis=1, keepdims=True)
        forward[:, t] = message
    message = leave
    for t in range(STRETCH - 1, -1, -1):
        forward[:, t] *= message
        if t:
            message = np.einsum("nij,nj->ni", steps(t), message * likely[:, t])
            message /= message.sum(axis=1, keepdims=True)
    marginal = forward.reshape(n * STRETCH, languages)[slot]
    return marginal / marginal.sum(axis=1, keepdims=True)


def label_words(data: np.ndarray, at: np.ndarray, hasher: Hasher, table: np.ndarray, lexicon: Lexicon, field: Field):
    """(words of some texts, their marginals)."""
    words = Words(data, at, table)
    sums = hasher.sums(data)
    vocabulary = Vocabulary(words, hasher.cut(sums, words.starts, words.ends))
    word, key = features(data, sums, hasher, vocabulary.starts, vocabulary.ends)
    emission = field.emissions(word, key, lexicon.of(vocabulary.hash))[vocabulary.number]
    return words, posteriors(emission, words.counts, field.step, field.start)


def count_words(texts: DataFrame, languages: list[str], text: str = "text", lang: str = "lang") -> np.ndarray:
    """Words per lexicon bucket and language, over all of ``texts``."""
    numbers = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), letter_words()
        total = np.zeros(LEXICON * len(numbers), np.int64)
        for batch in batches:
            number = np.array([numbers[name] for name in batch.column(1).to_pylist()], np.int64)
            for low, high, data, at in chunks(batch.column(0), lower=True):
                words = Words(data, at, table)
                bucket = (hasher.spans(data, words.starts, words.ends) % np.uint64(LEXICON)).astype(np.int64)
                total += np.bincount(bucket * len(numbers) + number[low:high][words.rows()], minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["cell", "n"])

    # one row per bucket and language at most
    cells = texts.select(text, lang).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LEXICON * len(languages), np.int64)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return counts.reshape(LEXICON, len(languages))


def sample_windows(texts: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """(text, language) of about ``TRAIN_WINDOWS`` windows per language, whole words only.

    Windows are chosen by a hash of their row's key and their number, at a rate that the number
    of all windows of the language sets; equal windows count once.
    """
    windows = F.ceil(F.length(text) / WINDOW_CHARS).cast("long")
    rates = texts.groupBy(lang).agg(F.sum(windows).alias("windows"))
    rates = {r[0]: min(1.0, TRAIN_WINDOWS / r.windows) for r in rates.collect() if r.windows}  # a row per language
    if not rates:
        return []
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), F.col(lang))
    drawn = lambda i: F.pmod(F.shiftright(F.xxhash64(F.lit(17), key, i), 8), F.lit(1 << 40)) < rate * float(1 << 40)
    number = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), windows - 1), drawn))
    chosen = texts.filter(F.length(text) > 0).select(F.col(text).alias("t"), F.col(lang).alias("l"), number.alias("i"))
    # the words that the ends cut go
    piece = F.substring("t", (F.col("i") * WINDOW_CHARS + 1).cast("int"), F.lit(WINDOW_CHARS))
    whole = F.regexp_replace(piece, r"^\S+\s(?=\s*\S)|(?<=\S)\s\S+$", "")
    rows = chosen.select(F.when(F.length("t") > WINDOW_CHARS, whole).otherwise(piece).alias("w"), "l").distinct().orderBy("l", "w")
    return [(r.w, r.l) for r in rows.collect()]


def train(
    texts: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> tuple[list[str], Lexicon | None, Field | None]:
    """Languages in order, lexicon and field from labelled texts."""
    usable = texts.select(key, text, lang).filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    windows = sample_windows(usable, key, text, lang)
    languages = sorted({name for _, name in windows})
    if not languages:
        return [], None, None
    lexicon = Lexicon(count_words(usable.filter(F.length(text) > 0), languages, text, lang))
    numbered = [(window, languages.index(name)) for window, name in windows]
    return languages, lexicon, fit(numbered, lexicon, len(languages))


def identify(texts: DataFrame, languages: list[str], lexicon: Lexicon | None, field: Field | None, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns with ``lang_pred`` and ``score``."""
    kinds = [f for f in texts.schema.fields if f.name in keep]
    columns = [f.name for f in kinds]
    given = texts.select(text, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)), *columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "lang_pred string, score double"])
    arrays = None if lexicon is None else (lexicon.table, *field.parts())
    sent = texts.sparkSession.sparkContext.broadcast(arrays)  # buckets by languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), letter_words()
        model = None
        if sent.value is not None:
            model = Lexicon.__new__(Lexicon), Field.__new__(Field)
            model[0].table, model[1].feature, model[1].lexicon, model[1].step, model[1].start = sent.value
        for batch in batches:
            has_letter = batch.column(1).to_numpy(zero_copy_only=False)
            names, scores = np.full(len(has_letter), UNKNOWN, object), np.zeros(len(has_letter))
            if model is not None:
                for low, _, data, at in chunks(batch.column(0), lower=True, most=CHUNK_BYTES * 16 // max(16, len(languages) ** 2)):
                    words, marginal = label_words(data, at, hasher, table, *model)
                    rows = words.rows()
                    sums = np.stack([np.bincount(rows, marginal[:, k], len(at) - 1) for k in range(len(languages))], axis=1)
                    best = sums.argmax(axis=1)
                    mean = sums[np.arange(len(best)), best] / np.maximum(1, words.counts)
                    judged = np.flatnonzero(has_letter[low : low + len(best)] & (words.counts > 0))
                    names[low + judged] = np.array(languages, object)[best[judged]]
                    scores[low + judged] = np.minimum(1.0, mean[judged])
            kept = [batch.column(2 + i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores)], [*columns, "lang_pred", "score"])

    return given.mapInArrow(run, schema)


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is left out of training; one without a key is."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(True))


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs, *model, "doc_id", "held_out")
