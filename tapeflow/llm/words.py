"""Words of Arrow text columns as numpy arrays: spans, counts and 64-bit hashes.

Texts are handled as UTF-8 bytes.  A word is a run of bytes for which a table says so;
all bytes of characters above 0x7F count as word bytes, so a run never cuts a character.
A null text has no words.  Work is done over about a megabyte of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_STEP = 0xD1342543DE82EF95


def space_words() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def alnum_words() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, in lower-cased text."""
    table = np.ones(256, bool)
    for low, high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
        table[low : high + 1] = False
    return table


def lower_az() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words; windows across texts are the caller's to drop."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    factor = _ODD
    for j in range(n):
        total += hashes[j : j + count] * np.uint64(factor)
        factor = factor * _STEP % (1 << 64) | 1
    return mix(total + np.uint64(n))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the ``len + 1`` places where texts begin and end."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


class Words:
    """Words of some texts: ``starts`` and ``ends`` in ``data``; those of text ``i`` are
    ``word_at[i]`` to ``word_at[i + 1]``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, is_word: np.ndarray):
        self.data, self.at = data, at
        inside = is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.word_at = np.searchsorted(self.starts, at)
        self.inside = inside

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.word_at)

    def rows(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.at) - 1), self.counts)

    def windows(self, n: int) -> np.ndarray:
        """First words of the windows of ``n`` words that stay inside one text."""
        count = max(0, len(self.starts) - n + 1)
        end = np.repeat(self.word_at[1:], self.counts)[:count]
        first = np.arange(count)
        return first[first + n <= end]


class Hasher:
    """Polynomial hashes of byte spans modulo 2**64 over a random value for each byte.

    Equal spans have equal hashes; different ones meet with a chance of about 2**-60.
    """

    def __init__(self):
        self.values = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * np.uint64(_ODD))
        self.power = np.empty(0, np.uint64)
        self.inverse = np.empty(0, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, CHUNK_BYTES)
            base = 0x5851F42D4C957F2D
            for name, number in (("power", base), ("inverse", pow(base, -1, 1 << 64))):
                steps = np.full(n, number, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums of bytes or code points, for ``cut``."""
        self._reach(len(data) + 1)
        if data.dtype == np.uint8 or not len(data) or data.max() < len(self.values):
            values = self.values[data]
        else:
            values = self.values[data & 0xFFFF] + mix((data >> np.uint32(16)).astype(np.uint64))
        values *= self.power[: len(data)]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        return sums

    def cut(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverse[starts])

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.cut(self.sums(data), starts, ends)


def chunks(column: pa.Array, lower: bool = False, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts ``low`` to ``high`` of about ``most`` bytes with their bytes."""
    data, at = text_buffer(column)
    table = lower_az() if lower else None
    low, rows = 0, len(at) - 1
    while low < rows:
        high = int(np.searchsorted(at, at[low] + most, "right")) - 1
        high = min(max(high, low + 1), rows)
        part = data[at[low] : at[high]]
        yield low, high, table[part] if lower else part, at[low : high + 1] - at[low]
        low = high


def ragged(values: np.ndarray, at: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column whose row ``i`` holds ``values[at[i]:at[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
