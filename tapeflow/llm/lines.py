"""Line dedup: lines within a small edit distance of a line seen before are removed.

Lines of ``FLOOR_CHARS`` characters and more may differ in ``SHARE`` per cent of the shorter one's
characters, at least in one (two from ``TWO_FROM`` characters on) and at most in ``MOST_EDITS``; see
``limits``.  Lengths fall into classes.  In a class with threshold k a line is cut into k + 1
segments of one length, the first half counted from the line's start, the others from its end.
Of two lines within k edits, one segment of the shorter occurs unedited in the longer, moved by no
more places than there are segments before it (behind it, for those counted from the end): were it
otherwise, each half would hold an edit per segment, k + 1 in all.  So a line is indexed under its
segments, and probes its class, and the one below if a line there can be near, with the
substrings at those places only.  Of a segment of ``SPAN`` characters and more the key is the least
hash of the ``GRAM``-character pieces that begin in its first ``WINDOW`` characters: an unedited segment
has the same one wherever it is, and places next to each other mostly share theirs, so that
the keys of a line are about as many as its segments.

Keys are packed in the task and dealt by their first bits to ranges that each hold a share of all
lines.  With each goes its line's length and a count of ``LANES`` kinds of characters, so that lines that meet
on a key by chance, whose number grows with the square of the table, are not tied.  The ties' connected
components are brought together in groups of bounded size, where candidates come from the same
keys, a finer count of characters rules most out, and the rest are verified with an edit distance
that follows the diagonals of the matrix from edit to edit, for many pairs at once.  Lines joined by such links are one class; its
first line, by document and line number, stays.

Shorter lines are never removed, whether equal or near: a few words recur by chance in clean text.

Defined cases: a null text stays null, an empty one empty; lines are compared without the
white space around them; documents without an id come last, ordered by their text; rows of
one id and text count as one document, of which the copies lose what repeats the first
of them; an empty table stays empty; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeflow.llm.columns import beside
from tapeflow.llm.components import bitmap, components, marked, pair_groups
from tapeflow.llm.jaccard import join_labels, merged, runs
from tapeflow.llm.words import Hasher, chunks, mix, text_buffer
from tapeflow.scratch import staged

FLOOR_CHARS = 20
TWO_FROM = 40
SHARE = 2
MOST_EDITS = 31
GROUP_CHARS = 4 << 20
MERGED_CHARS = 1 << 20
_PAIRS = 1 << 17
_AT_ONCE = 1 << 18
#: Pairs compared at a time, and characters compared one by one before hashes are.
_AT_A_TIME = 1 << 13
_LOOK = 4
_NOWHERE = -(1 << 40)
_SOON = 1 << 13
_ALL_PAIRS = 1 << 20
_FEW_LINES = 1 << 13
_CLASS_RATIO = 1.2
#: Pieces whose least hash stands for a segment, and the places of a segment where they begin.
GRAM = 24
WINDOW = 15
SPAN = GRAM + WINDOW - 1
#: Of a key 43 bits are kept: the first tell its range, the others are packed with the line.  Lines
#: that meet on them by chance are only compared.
RANGE_BITS = 12
_REST_BITS = 31
#: Kinds of characters counted for a tie, in 6 bits each: lines within ``MOST_EDITS`` differ by at most 31 in each.
LANES = 8
_MIDDLE = np.uint64(sum(32 << 6 * lane for lane in range(LANES)))
_CHARS = np.uint64(6 * LANES)
_PACKED = np.dtype([("rest", "<u4"), ("look", "<u8"), ("node", "<i8")])
#: Keys packed, or compared, at a time; lines of a key of which all pairs are compared at once, and
#: above which lines of like lengths are tied without a count.
_HELD = 1 << 20
_FEW = 64
_IN_FULL = 1 << 13
_SEEN = 1 << 18


def _is_space(code: np.ndarray) -> np.ndarray:
    return (code == 32) | ((code >= 9) & (code <= 13))


class Lines:
    """Lines of some texts without the space around them, as code points."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        begins = first[at]
        breaks = np.flatnonzero(self.code == 10) + 1
        # a text of k line ends has k + 1 lines, also if the last is empty
        count = np.searchsorted(breaks, begins[1:], "right") - np.searchsorted(breaks, begins[:-1], "right") + 1
        self.row = np.repeat(np.arange(len(at) - 1), count)
        self.row_at = np.concatenate([[0], np.cumsum(count)])
        is_first = np.zeros(len(self.row), bool)
        is_first[self.row_at[:-1]] = True
        start = np.empty(len(self.row), np.int64)
        start[is_first] = begins[:-1]
        start[~is_first] = breaks
        is_last = np.append(is_first[1:], True)[: len(is_first)]
        end = np.empty(len(self.row), np.int64)
        end[is_last] = begins[1:]
        end[~is_last] = breaks - 1
        self.full_start, self.full_end = start, end
        self.start, self.end = start.copy(), end.copy()
        todo = np.flatnonzero(start < end)
        while len(todo):  # once for each space before the line with the most
            todo = todo[_is_space(self.code[self.start[todo]])]
            self.start[todo] += 1
            todo = todo[self.start[todo] < end[todo]]
        todo = np.flatnonzero(self.start < end)
        while len(todo):
            todo = todo[_is_space(self.code[self.end[todo] - 1])]
            self.end[todo] -= 1

    @property
    def length(self) -> np.ndarray:
        return self.end - self.start


def _line_key(hasher: Hasher, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(hasher.cut(sums, start, end) + (end - start).astype(np.uint64)).view(np.int64)


def limits(length: np.ndarray, share: int = SHARE) -> np.ndarray:
    """How many edits lines may be apart, by the length of the shorter one."""
    return np.minimum(np.maximum(np.where(length < TWO_FROM, 1, 2), length * share // 100), MOST_EDITS)


def _class_edges() -> np.ndarray:
    """Where classes of lengths begin; none has lengths below and above ``TWO_FROM``."""
    edges = [FLOOR_CHARS]
    while edges[-1] < 1 << 40:
        after = max(edges[-1] + 1, int(edges[-1] * _CLASS_RATIO))
        edges.append(TWO_FROM if edges[-1] < TWO_FROM < after else after)
    return np.array(edges)


_EDGES = _class_edges()


def _substrings(k: int, indexes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, move, is indexed) of what a line looks at in a class of threshold ``k``."""
    segment, move = [], []
    for j in range(k + 1):
        reach = j if j <= k // 2 else k - j
        segment += [j] * (2 * reach + 1)
        move += range(-reach, reach + 1)
    segment, move = np.array(segment), np.array(move)
    return segment, move, (move == 0) & indexes


def _least_grams(hasher: Hasher, sums: np.ndarray) -> np.ndarray:
    """For every place, the least hash of the grams that begin there or in the places after it, ``WINDOW`` in all."""
    least = sums[GRAM:] - sums[: max(0, len(sums) - GRAM)]
    least *= hasher.inverse[: len(least)]
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        width += step
    return least


def segment_keys(hasher: Hasher, sums: np.ndarray, start: np.ndarray, end: np.ndarray, share: int = SHARE):
    """(line, key, is indexed) for all keys of some lines, a class of lengths at a time."""
    length = end - start
    own = np.searchsorted(_EDGES, length, "right") - 1
    reaches_down = (own > 0) & (length - limits(length, share) < _EDGES[own])
    visits = [(c, np.flatnonzero(own == c), True) for c in np.unique(own).tolist()]
    visits += [(c - 1, np.flatnonzero(reaches_down & (own == c)), False) for c in np.unique(own[reaches_down]).tolist()]
    least = _least_grams(hasher, sums)
    for c, lines, indexes in visits:
        k = int(limits(_EDGES[c + 1 : c + 2] - 1, share)[0])
        width = int(_EDGES[c]) // (k + 1)
        segment, move, indexed = _substrings(k, indexes)
        behind = segment > k // 2
        offset = np.where(behind, (segment - k - 1) * width, segment * width) + move
        name = mix((c * 64 + segment).astype(np.uint64))
        step = max(1, _AT_ONCE // len(offset))
        for first in range(0, len(lines), step):
            some = lines[first : first + step]
            begin = np.where(behind, end[some][:, None], start[some][:, None]) + offset
            use = (begin >= start[some][:, None]) & (begin + width <= end[some][:, None])
            if width >= SPAN:
                found = least[np.where(use, begin, 0)]
                # moves in a row with one key: the one nearest to the segment's own place is enough
                again = (found[:, 1:] == found[:, :-1]) & use[:, 1:] & use[:, :-1]
                use[:, 1:] &= ~(again & (move[1:] > 0))
                use[:, :-1] &= ~(again & (move[:-1] < 0))
                which, column = np.nonzero(use)
                found = found[which, column]
            else:
                which, column = np.nonzero(use)
                begin = begin[which, column]
                found = hasher.cut(sums, begin, begin + width)
            yield some[which], mix(found ^ name[column]).view(np.int64), indexed[column]


def _in_common(hasher: Hasher, sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, side: int) -> np.ndarray:
    """How many characters from ``a`` and ``b`` on (``side`` 1) or before them (-1) are equal, at
    most ``most``; by halving, with hashes."""
    found = np.zeros(len(a), np.int64)
    for bit in range(int(most.max(initial=0)).bit_length() - 1, -1, -1):
        step = np.int64(1 << bit)
        fits = np.flatnonzero(found + step <= most)
        x, y = a[fits] + side * found[fits], b[fits] + side * found[fits]
        if side < 0:
            x, y = x - step, y - step
        found[fits[hasher.cut(sums, x, x + step) == hasher.cut(sums, y, y + step)]] += step
    return found


def _common_from(code: np.ndarray, sums: np.ndarray, hasher: Hasher, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """``_in_common`` from ``a`` and ``b`` on; most have little, so the first characters are compared as such."""
    found = np.zeros(len(a), np.int64)
    left = np.flatnonzero(room > 0)
    for _ in range(_LOOK):
        left = left[code[a[left] + found[left]] == code[b[left] + found[left]]]
        found[left] += 1
        left = left[found[left] < room[left]]
    if len(left):
        at = found[left]
        found[left] += _in_common(hasher, sums, a[left] + at, b[left] + at, room[left] - at, 1)
    return found


def edits_within(code: np.ndarray, sums: np.ndarray, hasher: Hasher, a: tuple, b: tuple, within: np.ndarray) -> np.ndarray:
    """Whether pairs of spans of ``code`` are within some edits of each other, a number for each pair.

    ``a`` and ``b`` are (starts, ends).  See ``_reached``."""
    result = np.zeros(len(within), bool)
    for low in range(0, len(within), _AT_A_TIME):
        some = slice(low, low + _AT_A_TIME)
        result[some] = _reached(code, sums, hasher, (a[0][some], a[1][some]), (b[0][some], b[1][some]), within[some])
    return result


def _reached(code: np.ndarray, sums: np.ndarray, hasher: Hasher, a: tuple, b: tuple, within: np.ndarray) -> np.ndarray:
    """``edits_within`` by diagonals of the distance matrix: with each further edit, how far down each
    diagonal one comes; equal characters that follow cost nothing and are found by their hashes.
    So a pair takes about the square of its edits, whatever its length, and diagonals too far from
    the last one for the edits that are left are not looked at."""
    result = np.zeros(len(within), bool)
    a_at, b_at, a_size, b_size = a[0], b[0], a[1] - a[0], b[1] - b[0]
    pair = np.flatnonzero(np.abs(b_size - a_size) <= within)
    a_at, b_at, a_size, b_size, within = (x[pair] for x in (a_at, b_at, a_size, b_size, within))
    middle = int(within.max(initial=0)) + 1
    reach = np.full((len(pair), 2 * middle + 1), _NOWHERE)
    reach[:, middle] = 0
    edits = 0
    while len(pair):
        moves = np.arange(-edits, edits + 1)
        here = reach[:, middle - edits : middle + edits + 1]
        if edits:
            before = reach[:, middle - edits - 1 : middle + edits + 2]
            here = np.maximum(np.maximum(before[:, 1:-1], before[:, 2:]) + 1, before[:, :-2])
        last = np.minimum(a_size[:, None], b_size[:, None] - moves)
        here = np.minimum(here, last)
        usable = here >= np.maximum(0, -moves)
        usable &= np.abs((b_size - a_size)[:, None] - moves) <= (within - edits)[:, None]
        here = np.where(usable, here, _NOWHERE)
        row, column = np.nonzero(usable)
        at = here[row, column]
        here[row, column] += _common_from(
            code, sums, hasher, a_at[row] + at, b_at[row] + at + moves[column], last[row, column] - at
        )
        reach[:, middle - edits : middle + edits + 1] = here
        done = reach[np.arange(len(pair)), middle + b_size - a_size] >= a_size
        result[pair[done]] = True
        stay = ~done & (within > edits)
        pair, reach, a_at, b_at, a_size, b_size, within = (x[stay] for x in (pair, reach, a_at, b_at, a_size, b_size, within))
        edits += 1
    return result


class _Seen:
    """Nodes met lately in a task, in a table of fixed size: what it forgets is sent again."""

    def __init__(self):
        self.table = np.zeros(_SEEN, np.int64)

    def new(self, node: np.ndarray) -> np.ndarray:
        """Places of the nodes that are new, each once."""
        _, first = np.unique(node, return_index=True)
        seat = (mix(node[first].view(np.uint64)) & np.uint64(_SEEN - 1)).astype(np.int64)
        fresh = self.table[seat] != node[first]
        self.table[seat] = node[first]
        return first[fresh]


def _look(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length, at most 16 bits of it, and counts of ``LANES`` kinds of characters, as digits that carry over, of each span."""
    lane = (np.arange(1 << 16, dtype=np.uint32) * np.uint32(2654435761) >> np.uint32(16)).astype(np.uint64) % np.uint64(LANES)
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((np.uint64(1) << np.uint64(6) * lane)[code & np.uint32(0xFFFF)], out=sums[1:])
    counts = (sums[end] - sums[start]) & np.uint64((1 << 6 * LANES) - 1)
    return counts | np.minimum(end - start, 0xFFFF).astype(np.uint64) << _CHARS


def _alike(x: np.ndarray, y: np.ndarray, share: int) -> np.ndarray:
    """Whether lines may be within their limits, by their looks: never false if they are."""
    a, b = (x >> _CHARS).astype(np.int64), (y >> _CHARS).astype(np.int64)
    within = limits(np.minimum(a, b), share)
    result = np.abs(a - b) <= within
    place = np.flatnonzero(result)
    apart, total = (x - y + _MIDDLE)[place], np.zeros(len(place), np.int64)
    for lane in range(LANES):
        total += np.abs(((apart >> np.uint64(6 * lane)) & np.uint64(63)).astype(np.int64) - 32)
    result[place] = total <= 2 * within[place]
    return result


def _packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """(range, content): for each range the rest of its keys, with a bit for indexed ones, and their lines."""
    key, look, node, indexed = (np.concatenate([h[i] for h in held]) for i in range(4))
    key = key.view(np.uint64) >> np.uint64(64 - RANGE_BITS - _REST_BITS)
    order = np.argsort(key >> np.uint64(_REST_BITS))
    key = key[order]
    rows = np.empty(len(key), _PACKED)
    rows["rest"] = ((key << np.uint64(1)) | indexed[order]).astype(np.uint32)
    rows["look"], rows["node"] = look[order], node[order]
    part = (key >> np.uint64(_REST_BITS)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)] if len(part) else [0]
    content = [rows[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int32()), pa.array(content, pa.binary())], ["range", "content"])


def _ties_of(name: list[int], content: list[bytes], share: int) -> pa.RecordBatch:
    """(a, b): lines of whole ranges that meet on a key and are alike, each tied to one of them."""
    rows = np.frombuffer(b"".join(content), _PACKED)
    part = np.repeat(np.array(name, np.uint64), [len(c) // _PACKED.itemsize for c in content])
    key, indexed = part << np.uint64(_REST_BITS) | rows["rest"] >> np.uint32(1), rows["rest"] & np.uint32(1)
    order = np.argsort(key)
    firsts = np.flatnonzero(np.concatenate([[True], key[order[1:]] != key[order[:-1]]]))
    size = np.diff(np.append(firsts, len(key)))
    order = order[np.repeat((size > 1) & (np.maximum.reduceat(indexed[order], firsts) > 0), size)]
    key, rows = key[order], rows[order]
    order = np.lexsort((rows["node"], key))  # a line may have a key several times
    key, rows = key[order], rows[order]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (rows["node"][1:] != rows["node"][:-1])])[: len(key)]
    key, look, node = key[once], rows["look"][once], rows["node"][once]
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    size = np.diff(cuts)
    labels = np.arange(len(key))
    # few lines: each with all that come after it
    after = np.where(np.repeat(size, size) <= _FEW, np.repeat(cuts[1:], size) - labels - 1, 0)
    upto = np.cumsum(after)
    low = 0
    while low < len(key):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] - after[low] + _HELD, "right")))
        x = np.repeat(np.arange(low, high), after[low:high])
        y = x + 1 + np.arange(len(x)) - np.repeat(upto[low:high] - after[low:high] - (upto[low] - after[low]), after[low:high])
        near = _alike(look[x], look[y], share)
        _settle(labels, x[near], y[near])
        low = high
    for first, n in zip(cuts[:-1][size > _FEW].tolist(), size[size > _FEW].tolist(), strict=True):
        _spread(labels, look, np.arange(first, first + n), share)
    moved = labels != np.arange(len(labels))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[labels[moved]])], ["a", "b"])


def _settle(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """The smallest place of a component becomes the label of all its places, with links added."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _spread(labels: np.ndarray, look: np.ndarray, places: np.ndarray, share: int) -> None:
    """Labels of many lines of one key: from a line to all that are like it, and on from them."""
    if len(places) > _IN_FULL:
        places = places[np.argsort(look[places])]
        chars = (look[places] >> _CHARS).astype(np.int64)
        near = np.diff(chars) <= limits(chars[:-1], share)
        _settle(labels, places[:-1][near], places[1:][near])
        return
    while len(places):
        root, todo, places = places[0], [places[0]], places[1:]
        while todo and len(places):
            near = _alike(look[todo.pop()], look[places], share)
            labels[places[near]] = root
            todo += places[near].tolist()
            places = places[~near]


def scan_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text_key, line_number, node) of every line of ``FLOOR_CHARS`` and more, written."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for low, _, data, at in chunks(batch.column(2)):
                lines = Lines(data, at)
                pick = np.flatnonzero(lines.length >= FLOOR_CHARS)
                node = _line_key(hasher, hasher.sums(lines.code), lines.start[pick], lines.end[pick])
                number = lines.row[pick]
                row = pa.array(number + low)
                columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(pick - lines.row_at[number], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(node)], ["doc", "text_key", "line_number", "node"])

    given = docs.select(key, F.xxhash64(text).alias("text_key"), text)
    return staged(given.mapInArrow(run, f"doc {kind}, text_key long, line_number long, node long"), "lines")


def _ties(docs: DataFrame, text: str, share: int) -> DataFrame:
    """(a, b): lines that share a key that one of them is indexed under, and are alike."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, held, size = Hasher(), _Seen(), [], 0
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0)):
                lines = Lines(data, at)
                sums = hasher.sums(lines.code)
                pick = np.flatnonzero(lines.length >= FLOOR_CHARS)
                node = _line_key(hasher, sums, lines.start[pick], lines.end[pick])
                new = seen.new(node)
                start, end, node = lines.start[pick[new]], lines.end[pick[new]], node[new]
                look = _look(lines.code, start, end)
                for which, key, indexed in segment_keys(hasher, sums, start, end, share):
                    held.append((key, look[which], node[which], indexed))
                    size += len(key)
                    if size >= _HELD:
                        yield _packed(held)
                        held, size = [], 0
        if held:
            yield _packed(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, content, size = [], [], 0
        for run in runs(batches, 1):
            name += run.column(0).to_pylist()
            content += run.column(1).to_pylist()
            size += run.column(1).nbytes
            if size >= _PACKED.itemsize * _HELD:
                yield _ties_of(name, content, share)
                name, content, size = [], [], 0
        if name:
            yield _ties_of(name, content, share)

    packed = docs.select(text).mapInArrow(keys, "range int, content binary")
    return packed.repartition("range").sortWithinPartitions("range").mapInArrow(meet, "a long, b long")


def _histogram(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Counts of 16 kinds of characters in each span."""
    kinds = (code * np.uint32(2654435761)) >> np.uint32(28)
    length = end - start
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    owner = np.repeat(np.arange(len(start)), length)
    flat = np.bincount(owner * 16 + kinds[np.repeat(start, length) + inside], minlength=16 * len(start))
    return flat.reshape(-1, 16).astype(np.int32)


def _links(nodes: np.ndarray, code: np.ndarray, at: np.ndarray, chunk: np.ndarray, share: int, hasher: Hasher):
    """Links among the lines of a group as edges of a spanning forest."""
    start, end = at[:-1], at[1:]
    length = end - start
    kinds = _histogram(code, start, end)
    labels = np.arange(len(nodes))
    apart = chunk.min() != chunk.max()
    sums = hasher.sums(code)
    found = list(segment_keys(hasher, sums, start, end, share))
    line, key, indexed = (np.concatenate([f[i] for f in found]) for i in range(3))
    # a repetitive line has a key at several places: once is enough, where it is indexed if it is
    order = np.lexsort((~indexed, line, key))
    order = order[np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(line[order]) != 0)])]
    order = order[np.lexsort((~indexed[order], key[order]))]
    line, key, indexed = line[order], key[order], indexed[order]
    cuts = np.unique(np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]))

    def verify(a: np.ndarray, b: np.ndarray) -> None:
        pair = np.unique(np.minimum(a, b) * len(nodes) + np.maximum(a, b))
        a, b = pair // len(nodes), pair % len(nodes)
        within = limits(np.minimum(length[a], length[b]), share)
        keep = (labels[a] != labels[b]) & (np.abs(length[a] - length[b]) <= within)
        if apart:
            keep &= chunk[a] != chunk[b]
        a, b, within = a[keep], b[keep], within[keep]
        keep = np.abs(kinds[a] - kinds[b]).sum(axis=1) <= 2 * within
        a, b, within = a[keep], b[keep], within[keep]
        linked = edits_within(code, sums, hasher, (start[a], end[a]), (start[b], end[b]), within)
        a, b = a[linked], b[linked]
        if not len(a):
            return
        firsts, at_first = np.unique(a, return_index=True)
        for row, near in zip(firsts.tolist(), np.split(b, at_first[1:]), strict=True):
            join_labels(labels, row, near)

    size, led = np.diff(cuts), indexed[cuts[:-1]]  # indexed ones come first
    lows, highs = cuts[:-1][(size > 1) & led], cuts[1:][(size > 1) & led]
    before = np.concatenate([[0], np.cumsum(indexed)])
    n_indexed = before[highs] - before[lows]
    total = n_indexed * (highs - lows)
    if total.sum() <= _ALL_PAIRS:
        # every pair once, however many keys it shares
        key_of = np.repeat(np.arange(len(lows)), total)
        inner = np.arange(len(key_of)) - np.repeat(np.cumsum(total) - total, total)
        x = line[lows[key_of] + inner // n_indexed[key_of]]
        y = line[lows[key_of] + inner % n_indexed[key_of]]
        pair = np.unique(np.minimum(x, y) * len(nodes) + np.maximum(x, y))
        a, b = pair // len(nodes), pair % len(nodes)
        first, step = 0, _SOON
        while first < len(a):
            verify(a[first : first + step], b[first : first + step])
            first, step = first + step, min(2 * step, _PAIRS)
    else:
        tried = np.zeros((len(nodes), len(nodes)), bool) if len(nodes) <= _FEW_LINES else None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting, enough = 0, _SOON
        for low, high, n in zip(lows.tolist(), highs.tolist(), n_indexed.tolist(), strict=True):
            members, targets = line[low:high], line[low : low + n]
            for at in range(0, len(members), max(1, _PAIRS // n)):
                probes = members[at : at + max(1, _PAIRS // n)]
                open_pairs = labels[probes][:, None] != labels[targets]
                if tried is not None:
                    open_pairs &= ~tried[probes[:, None], targets]
                    tried[probes[:, None], targets] = tried[targets, probes[:, None]] = True
                p, t = np.nonzero(open_pairs)
                held.append((probes[p], targets[t]))
                waiting += len(p)
                if waiting >= enough:  # few at first: what they link needs no further look
                    verify(*(np.concatenate([h[i] for h in held]) for i in range(2)))
                    held, waiting, enough = [], 0, min(2 * enough, _PAIRS)
        if held:
            verify(*(np.concatenate([h[i] for h in held]) for i in range(2)))
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def line_classes(docs: DataFrame, text: str = "text", share: int = SHARE) -> DataFrame:
    """(node, line_class): lines that are within their ``limits`` of others, by their keys."""
    cluster = staged(components(_ties(docs, text, share)).toDF("node", "cluster"), "clusters")
    tied = docs.sparkSession.sparkContext.broadcast(bitmap(cluster))

    def distinct_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), _Seen()
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0)):
                lines = Lines(data, at)
                node = _line_key(hasher, hasher.sums(lines.code), lines.start, lines.end)
                pick = np.flatnonzero(lines.length >= FLOOR_CHARS)
                pick = pick[marked(tied.value, node[pick])]
                pick = pick[seen.new(node[pick])]
                words = [lines.code[a:b].tobytes().decode("utf-32-le") for a, b in zip(lines.start[pick], lines.end[pick], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(node[pick]), pa.array(words, pa.string())], ["node", "line"])

    lines = docs.select(text).mapInArrow(distinct_lines, "node long, line string")
    members = lines.join(cluster, "node").groupBy("cluster", "node").agg(F.first("line").alias("line"))
    members = staged(members.withColumn("chars", F.length("line").cast("long")), "tied-lines")
    placed = pair_groups(members, ["cluster"], "chars", GROUP_CHARS)
    spread = placed.select("cluster", F.explode("groups").alias("pair"), "node", "chunk", "line")
    spread = spread.select("cluster", "pair.first", "pair.second", "node", "chunk", "line")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for run in merged(runs(batches, 3), 1, 5, MERGED_CHARS):
            data, at = text_buffer(run.column(5))
            place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
            code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            a, b = _links(run.column(3).to_numpy(), code, place, run.column(4).to_numpy(), share, hasher)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    where = ["cluster", "first", "second"]
    links = spread.repartition(*where).sortWithinPartitions(*where).mapInArrow(verify, "a long, b long")
    return components(links).withColumnRenamed("component", "line_class")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """(doc, text_key, removed): numbers, from 0, of the lines to remove, by document.

    A document is its id and a hash of its text; only documents that lose a line occur.
    """
    rows = scan_lines(docs, key, text)
    classes = line_classes(docs, text, share)
    # most lines are the only one of their class: they go before anything is ordered
    often = rows.groupBy("node").agg(F.count("*").alias("copies")).filter("copies > 1").select("node")
    classed = often.withColumn("line_class", F.lit(None).cast("long")).union(classes).groupBy("node")
    classed = classed.agg(F.coalesce(F.max("line_class"), F.col("node")).alias("line_class"))
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "text_key", "line_number")
    rows = staged(rows.join(classed, "node").select("line_class", place.alias("place")), "repeated-lines")
    firsts = rows.groupBy("line_class").agg(F.min("place").alias("first"))
    later = rows.join(firsts, "line_class").filter("place != first").select("place.*")
    return later.groupBy("doc", "text_key").agg(F.collect_set("line_number").alias("removed"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; ``line_count`` is added, or
    replaced, and ``removed_lines`` added: an earlier run's, which tells what is gone, is not replaced."""
    if "removed_lines" in map(str.lower, docs.columns):
        raise ValueError("rename the column removed_lines")
    return beside(docs, lambda rows: _dedup_lines(rows, key, text, share), ["text_key", "removed", "doc"], ["line_count"])


def _dedup_lines(docs: DataFrame, key: str, text: str, share: int) -> DataFrame:
    removed = repeated_lines(docs, key, text, share)
    same = F.col(key).eqNullSafe(F.col("doc")) & (F.xxhash64(text) == F.col("text_key"))
    joined = docs.join(removed, same, "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("removed", i.cast("long"))), "\n")
    new_text = F.when(F.col("removed").isNull(), F.col(text)).otherwise(kept)
    others = [F.col(c) for c in docs.columns if c != text]
    out = joined.select(
        *others,
        new_text.alias(text),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("line_count"),
        F.array_sort(F.coalesce("removed", F.array().cast("array<bigint>"))).alias("removed_lines"),
    )
    return out.select(*docs.columns, "line_count", "removed_lines")


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = dedup_lines(docs)
    return done.select(
        "doc_id",
        F.col("line_count").alias("n_lines"),
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
    )
