"""Words and n-gram hashes of whole texts, many texts at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The separators of the contract's words: space and \x09-\x0D.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes that end a letter-or-digit word: all ASCII but 0-9 and a-z.
NOT_WORD = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEED = 0x9E3779B97F4A7C15


def _mask(separators: bytes) -> np.ndarray:
    mask = np.ones(256, dtype=bool)
    mask[list(separators)] = False
    return mask


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers, the same in every process."""
    start = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)
    return mix(start * np.uint64(_SEED)) | np.uint64(1)


_BYTE_VALUES = constants(256, 1)
_BASE = int(constants(1, 2)[0])
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


class Hasher:
    """Splits texts into words and hashes the words; keeps the tables of powers between calls."""

    def __init__(self, separators: bytes, lower: bool):
        self.keep = _mask(separators)
        self.lower = lower
        self.up = _powers(_BASE, 1 << 16)
        self.down = _powers(_BASE_INVERSE, 1 << 16)

    def words(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word of the texts in order, and the first word of each text.

        The second array has one entry more than texts: text i has the words
        ``starts[i]:starts[i + 1]``.
        """
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if self.lower:
            data = _LOWER[data]
        if len(data) + 1 > len(self.up):
            size = 1 << len(data).bit_length()
            self.up, self.down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
        inside = self.keep[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        first, last = edge[0::2], edge[1::2]
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE_VALUES[data] * self.up[: len(data)], out=total[1:])
        hashes = mix((total[last] - total[first]) * self.down[first])
        ends = np.cumsum([len(t) + 1 for t in texts])
        return hashes, np.concatenate(([0], np.searchsorted(first, ends)))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on; shorter than ``hashes`` by n - 1."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for offset, factor in enumerate(constants(n, 3)):
        total += hashes[offset : offset + size] * factor
    return mix(total)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window of ``width`` values.

    A window of no full width has its own smallest; ``values`` must not be empty.
    """
    width = min(width, len(values))
    size = len(values) - width + 1
    best = values[:size].copy()
    where = np.arange(size)
    for offset in range(1, width):
        other = values[offset : offset + size]
        smaller = other < best
        best[smaller] = other[smaller]
        where[smaller] = np.flatnonzero(smaller) + offset
    return where


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def slices(batches: Iterable, column: str = "text", size: int = 2_000_000) -> Iterator[tuple[object, list[bytes]]]:
    """Arrow batches cut so that each part holds about ``size`` bytes of text, or one text.

    Only the texts of one part are Python objects at a time.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        start, total = 0, 0
        for i, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            if total and total + length > size:
                yield batch.slice(start, i - start), [t or b"" for t in texts.slice(start, i - start).to_pylist()]
                start, total = i, 0
            total += length
        if len(texts):
            yield batch.slice(start), [t or b"" for t in texts.slice(start).to_pylist()]


def ranges(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Numbers(dict):
    """Words numbered in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class WordTable:
    """Ids of distinct words, in one array; texts are put together from it without a step per word."""

    def __init__(self) -> None:
        self.number = _Numbers()
        # where each word's ids begin, and how many it has
        self.ids, self.first, self.sizes = (np.empty(0, dtype=t) for t in (np.int32, np.int64, np.int64))

    def numbers(self, split: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Numbers of all words, how many each text has, and the words not met before: give their ids to ``add``."""
        known = len(self.number)
        count = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        found = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(count.sum()))
        # new words are the last of the table
        return found, count, list(islice(reversed(self.number), len(self.number) - known))[::-1]

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of the new words one after the other, and how many each has."""
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def keep(self, on: np.ndarray) -> None:
        """Only the words of these ascending numbers stay; they are numbered anew."""
        names = list(self.number)
        self.number = _Numbers()
        for i in on.tolist():
            self.number[names[i]]
        sizes = self.sizes[on]
        self.ids = self.ids[np.repeat(self.first[on], sizes) + ranges(sizes)]
        self.first, self.sizes = np.cumsum(sizes) - sizes, sizes

    def put_together(self, numbers: np.ndarray, count: np.ndarray, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as ``count`` word numbers each, with the ids ``end`` after each text, and where each starts."""
        sizes = self.sizes[numbers]
        text = np.repeat(np.arange(len(count)), count)
        extra = len(end)
        own = np.bincount(text, weights=sizes, minlength=len(count)).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(own + extra)))
        out = np.empty(int(starts[-1]), dtype=np.int32)
        # each word's place in the table, less its place in the result
        shift = self.first[numbers] - (np.cumsum(sizes) - sizes)
        taken = self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
        if not extra:
            return taken, starts
        inside = np.ones(len(out), dtype=bool)
        for k, value in enumerate(end):
            out[starts[1:] - extra + k] = value
            inside[starts[1:] - extra + k] = False
        out[inside] = taken
        return out, starts
